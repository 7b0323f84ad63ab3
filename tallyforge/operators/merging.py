"""Putting components together: labels, unions, shuffled files of bounded size, resumable writes."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.cuts import Cuts
from tallyforge.operators.ranking import random_order


def with_label(df: DataFrame, label: int, name: str = "flavour_label", overwrite: bool = False) -> DataFrame:
    """Adds a constant label; an existing one stays unless ``overwrite``."""
    return df if name in df.columns and not overwrite else df.withColumn(name, F.lit(label).cast("int"))


def label_by_cuts(classes: Sequence[tuple[str, Cuts]]) -> Column:
    """Place of the first class whose cuts hold; null if none."""
    return reduce(lambda c, i: c.when(classes[i][1].column(), F.lit(i)), range(1, len(classes)), F.when(classes[0][1].column(), F.lit(0))).cast("int")


def union_components(parts: Mapping[str, DataFrame], name: str = "component") -> DataFrame:
    """All rows of components of one schema, with the component's name."""
    rows = [df.withColumn(name, F.lit(c)) for c, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def file_index(df: DataFrame, key: str, rows_per_file: int, seed: object, by: Sequence[str] = (), out: str = "file_no", order: str | None = None) -> DataFrame:
    """Adds the number of the output file: rows in random order, ``rows_per_file`` to each file but the last of a group.

    ``order`` also keeps the place in the file, by which files are to be sorted when written.
    """
    placed = random_order(df.withColumn("__all", F.lit(0)), ["__all", *by], key, seed, "__place")
    placed = placed.withColumn(out, F.floor((F.col("__place") - 1) / rows_per_file).cast("int"))
    kept = placed.withColumn(order, F.pmod(F.col("__place") - 1, F.lit(rows_per_file))) if order else placed
    return kept.drop("__all", "u", "__place")


def equal_rows(df: DataFrame, source: str, key: str, seed: object) -> DataFrame:
    """As many random rows of each source as the smallest has."""
    least = df.groupBy(source).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).scalar()
    return random_order(df, [source], key, seed, "__place").where(F.col("__place") <= least).drop("u", "__place")


def select_elements(array: str, cuts: Cuts, valid: str = "valid") -> Column:
    """The valid elements that meet the cuts."""
    return F.filter(array, lambda e: e[valid] & cuts.element(e))


def write_files(df: DataFrame, path: str, file_no: str = "file_no", by: Sequence[str] = (), order: str | None = None) -> None:
    """One directory per file number (and group ``by``), rewritten alone where it exists: a failed run is resumed by ``missing_files``.

    A file is written by one task, its rows sorted by ``order``, which is left out.
    """
    rows = df.repartition(*by, file_no).sortWithinPartitions(*by, file_no, order).drop(order) if order else df
    rows.write.option("compression", "zstd").option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*by, file_no).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Does anything lie at ``path``, on whatever file system?"""
    try:
        return bool(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").head(1))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def missing_files(spark: SparkSession, df: DataFrame, path: str, file_no: str = "file_no", by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``df`` whose file does not hold as many rows at ``path`` as it should: all, if nothing is there."""
    if not exists(spark, path):
        return df
    names = [*by, file_no]
    want = df.groupBy(*names).agg(F.count(F.lit(1)).alias("want"))
    kinds = dict(df.dtypes)
    have = spark.read.parquet(path).groupBy(*[F.col(c).cast(kinds[c]).alias(c) for c in names]).agg(F.count(F.lit(1)).alias("have"))
    bad = want.join(have, names, "left").where(~F.col("want").eqNullSafe(F.col("have"))).select(*names)
    return df.join(bad, names, "left_semi")


def manifest(df: DataFrame, by: Sequence[str], **facts: object) -> str:
    """Row counts per output group and other facts, as JSON to lie beside the files."""
    rows = [r.asDict() for r in df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).orderBy(*by).collect()]  # a row per output group
    return json.dumps({"groups": rows, **facts}, sort_keys=True)
