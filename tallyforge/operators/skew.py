"""Aggregation by key where a few keys hold most rows (problem 1).

Two-stage salted aggregation: rows of heavy keys get a salt, partial results are computed per key and salt, and the
partials of a key are merged. Heavy keys are looked for in a bounded sample of the rows; the result does not depend
on which are found. They hold more than a given share of the sample, so they are few and may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How the partial results of each kind are made and merged. Equal values get equal salts where distinct ones are counted.
KINDS = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max), "distinct": (F.count_distinct, F.sum)}
#: Rows in which heavy keys are looked for: about this share of all, and at most so many.
SAMPLE_SHARE, SAMPLE_ROWS = 0.02, 100_000


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float, sample_share: float | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 17) -> DataFrame:
    """The keys that hold more than ``share`` of a random sample of the rows: fewer than 1 / ``share`` rows.

    A key of twice that share is found nearly always once there are thousands of rows. In few rows none may be found.
    """
    some = df.select(*keys).where(F.rand(seed) < (sample_share or SAMPLE_SHARE)).limit(sample_rows)
    counts = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum("n").alias("total"), F.collect_list(F.struct(*keys, "n")).alias("all")).select("total", F.inline("all")).where(F.col("n") > F.col("total") * F.lit(share)).select(*keys)


def salted_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    aggs: dict[str, tuple[str, Column]],
    share: float = 1 / 64,
    salts: int = 64,
    seed: int = 17,
) -> DataFrame:
    """One row per key with the aggregates named in ``aggs`` (name: (count, sum, min, max or distinct, expression)).

    Null keys form a group of their own, null values are skipped as SQL aggregates do (a sum of nulls only is
    null, a count 0). Repeated rows count each time, but for distinct (one aggregate at most), which counts
    different values. An empty table gives no rows. Other columns of ``df`` are left out, so their names cannot
    clash; only ``keys`` and the names in ``aggs`` must differ.
    """
    clash = set(keys) & set(aggs)
    if clash:
        raise ValueError(f"names used both as key and as aggregate: {sorted(clash)}")
    for name, (kind, _) in aggs.items():
        if kind not in KINDS:
            raise ValueError(f"{name}: unknown aggregate {kind!r}")
    different = [f"__v{j}" for j, (kind, _) in enumerate(aggs.values()) if kind == "distinct"]
    if len(different) > 1:
        raise ValueError("only one aggregate may count distinct values")
    rows = df.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[e.alias(f"__v{j}") for j, (_, e) in enumerate(aggs.values())],
    )
    ks = [f"__k{i}" for i in range(len(keys))]
    heavy = heavy_keys(rows, ks, share).select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(ks)], F.lit(True).alias("__heavy"))
    same = [F.col(k).eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(ks)]
    spread = F.pmod(F.xxhash64(different[0]), F.lit(salts)) if different else F.floor(F.rand(seed) * salts)
    salt = F.when(F.col("__heavy"), spread.cast("int")).otherwise(F.lit(0))
    partial = (
        rows.join(F.broadcast(heavy), on=same, how="left")
        .withColumn("__salt", salt)
        .groupBy(*ks, "__salt")
        .agg(*[KINDS[kind][0](f"__v{j}").alias(f"__v{j}") for j, (kind, _) in enumerate(aggs.values())])
    )
    return (
        partial.groupBy(*ks)
        .agg(*[KINDS[kind][1](f"__v{j}").alias(name) for j, (name, (kind, _)) in enumerate(aggs.items())])
        .select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], *aggs)
    )
