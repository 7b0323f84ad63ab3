"""Mixing sources to target weights (problem 3).

Systematic sampling: within a source the records stand in random order, every record has the same expected number
of copies, and a record is emitted once for every integer that its share of the running sum, moved by one random
offset per source, crosses. So a source gives its target size exactly (up to one record), and no record is used
more than ceil(expected copies) times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.randomness import hash_uniform
from tallyforge.operators.ranking import BUCKET_ROWS, bucketed_rank
from tallyforge.session import bounded


def source_plan(records: DataFrame, targets: DataFrame, mix: str, source: str, size: str) -> DataFrame:
    """What each source of each mix can give: adds n_records, available, supply_limit, given_size and capped.

    ``targets`` has one row per mix and source: ``mix``, ``source``, target_size (bigint) and max_repeat. A source is
    capped if its target exceeds max_repeat times the size of its records (null sizes count 0); it then gives that
    limit. A source without records is capped and gives 0; null or negative targets count as 0, a null max_repeat as
    no limit. Null sources match null sources.
    """
    have = records.groupBy(F.col(mix).alias("__m"), F.col(source).alias("__s")).agg(
        F.count(F.lit(1)).alias("n_records"), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("available")
    )
    same = F.col(mix).eqNullSafe(F.col("__m")) & F.col(source).eqNullSafe(F.col("__s"))
    joined = targets.select(
        mix, source, F.greatest(F.coalesce("target_size", F.lit(0)), F.lit(0)).cast("bigint").alias("target_size"), F.col("max_repeat").cast("bigint").alias("max_repeat")
    ).join(have, on=same, how="left")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_records", "available")]
    limit = F.when(F.col("available") == 0, 0).otherwise(F.coalesce(F.col("max_repeat") * F.col("available"), F.lit(2**62)))
    return (
        joined.select(mix, source, "target_size", "max_repeat", *zero)
        .withColumn("supply_limit", limit.cast("bigint"))
        .withColumn("given_size", F.least("target_size", "supply_limit"))
        .withColumn("capped", F.col("target_size") > F.col("supply_limit"))
    )


def mix_sources(records: DataFrame, plan: DataFrame, mix: str, source: str, key: Sequence[str], size: str, seed: int = 23) -> DataFrame:
    """The mixed records: ``mix``, ``source``, ``key``, ``size`` and copies (at least 1), by a plan of ``source_plan``.

    Records of no planned source, and those that get no copy, are left out. ``key`` must tell records apart; rows
    that repeat a key are records of their own, at adjacent places. All other columns are left out; join them by
    ``key``.
    """
    p = plan.select(F.col(mix).alias("__m"), F.col(source).alias("__s"), "given_size", "available", "n_records").where("given_size > 0 and available > 0")
    same = F.col(mix).eqNullSafe(F.col("__m")) & F.col(source).eqNullSafe(F.col("__s"))
    drawn = (
        records.select(mix, source, *key, size)
        .join(bounded(p), on=same, how="inner")
        .withColumn("__u", hash_uniform(seed, mix, *key))
    )
    bucket = F.floor(F.col("__u") * F.ceil(F.col("n_records") / F.lit(BUCKET_ROWS)))
    ranked = bucketed_rank(drawn, [mix, source], bucket, [F.col("__u"), *[F.col(k) for k in key]], "__rank")
    # given_size / available copies per record; whole numbers of 38 digits keep every boundary exact.
    share, whole = F.col("given_size").cast("decimal(19,0)"), F.col("available")
    offset = F.floor(hash_uniform(seed + 1, mix, source) * F.col("available"))
    crossed = lambda rank: F.expr(f"({rank} * cast(given_size as decimal(19,0)) + __offset) div available")
    return (
        ranked.withColumn("__offset", offset.cast("bigint"))
        .withColumn("copies", (crossed("cast(__rank as decimal(19,0))") - crossed("cast(__rank - 1 as decimal(19,0))")).cast("int"))
        .where("copies > 0")
        .select(mix, source, *key, size, "copies")
    )


def mix_report(mixed: DataFrame, plan: DataFrame, mix: str, source: str, size: str) -> DataFrame:
    """The plan with what came out: emitted (records with repeats), actual_size, target_share and actual_share of the mix.

    Shares are null in a mix of total 0.
    """
    got = mixed.groupBy(F.col(mix).alias("__m"), F.col(source).alias("__s")).agg(
        F.sum("copies").alias("emitted"), F.sum(F.coalesce(size, F.lit(0)) * F.col("copies")).alias("actual_size"), F.max("copies").alias("most_copies")
    )
    same = F.col(mix).eqNullSafe(F.col("__m")) & F.col(source).eqNullSafe(F.col("__s"))
    full = plan.join(got, on=same, how="left").select(
        *plan.columns, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("emitted", "actual_size", "most_copies")]
    )
    total = full.groupBy(F.col(mix).alias("__m")).agg(F.sum("target_size").alias("__t"), F.sum("actual_size").alias("__a"))
    return full.join(total, on=F.col(mix).eqNullSafe(F.col("__m")), how="inner").select(
        *full.columns,
        F.try_divide("target_size", "__t").alias("target_share"),
        F.try_divide("actual_size", "__a").alias("actual_share"),
    )
