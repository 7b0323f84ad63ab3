"""Moments and class counts of a growing folder of rows, kept up to date by Structured Streaming.

Every micro-batch writes its partial moments or counts under its number, so a repeated batch overwrites itself;
reading pools the parts. Each part has a row per variable or class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyforge.operators import normalisation


def watch(spark: SparkSession, source: str, schema: StructType, out: str, variables: Sequence[str], labels: Sequence[str] = ()) -> StreamingQuery:
    """Starts on all files not seen yet, and ends when they are done; called again it goes on from there."""

    def part(batch: DataFrame, number: int) -> None:
        normalisation.moments(batch, "jets", variables).write.mode("overwrite").parquet(f"{out}/moments/batch={number}")
        if labels:
            normalisation.class_counts(batch, labels).write.mode("overwrite").parquet(f"{out}/counts/batch={number}")

    rows = spark.readStream.schema(schema).parquet(source)
    return rows.writeStream.foreachBatch(part).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()


def moments(spark: SparkSession, out: str) -> DataFrame:
    """Moments of all rows so far."""
    return normalisation.pooled(spark.read.parquet(f"{out}/moments"))


def class_weights(spark: SparkSession, out: str) -> DataFrame:
    """Class weights of all rows so far."""
    counts = spark.read.parquet(f"{out}/counts").groupBy("variable", "label").agg(F.sum("n").alias("n"))
    return normalisation.class_weights(counts)
