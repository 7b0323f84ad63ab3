"""One scan, many outputs: rows routed to every component whose cuts they meet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.cuts import Cuts


def routes(components: Mapping[str, Cuts]) -> Column:
    """Names of all components that a row belongs to."""
    return F.array_compact(F.array(*[F.when(cuts.column(), F.lit(name)) for name, cuts in components.items()]))


def route(df: DataFrame, components: Mapping[str, Cuts], out: str = "component") -> DataFrame:
    """Each row once for every component it belongs to."""
    return df.withColumn(out, F.explode(routes(components)))


def summary(routed: DataFrame, by: str = "component") -> DataFrame:
    """Rows per component and their percentage of all written rows."""
    counts = routed.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("percent", 100 * F.col("rows") / counts.agg(F.sum("rows")).scalar())


def rollup(routed: DataFrame, key: str, by: str = "component") -> DataFrame:
    """Rows and distinct keys per component, and of all of them as "total"."""
    return routed.rollup(by).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("unique_rows")).withColumn(by, F.coalesce(by, F.lit("total")))


def shares(routed: DataFrame, region: str, label: str) -> DataFrame:
    """Each label's share of its region."""
    counts = routed.groupBy(region, label).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy(region)))


def check_shares(table: DataFrame, region: str, label: str, tolerance: float = 1e-5) -> None:
    """Raises if a label's share differs between regions."""
    bad = table.groupBy(label).agg(F.min("share").alias("low"), F.max("share").alias("high")).where(F.col("high") - F.col("low") > tolerance + tolerance * F.col("low")).head(1)
    if bad:
        raise ValueError(f"shares differ between the values of {region}: {bad[0].asDict()}")


def write_split(routed: DataFrame, path: str, *by: str) -> None:
    """One directory per split and component."""
    routed.write.option("compression", "zstd").mode("overwrite").partitionBy(*by).parquet(path)
