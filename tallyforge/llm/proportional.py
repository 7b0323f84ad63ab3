"""A sample whose categories have given proportions (problem 4).

Divisor-method priorities: within a category records get random ranks, a record's priority is (rank - 1/2) / target,
the first records of a category up to its floor come before all others, and the globally smallest priorities are
kept. An exhausted category's seats thereby go to the others in proportion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.randomness import hash_uniform
from tallyforge.operators.ranking import BUCKET_ROWS, bucketed_rank
from tallyforge.session import bounded


def with_availability(records: DataFrame, targets: DataFrame, group: str, category: str, key: str) -> DataFrame:
    """``targets`` with ``available``, the distinct keys that each group and category has (0 if none)."""
    have = _distinct(records, group, category, key).groupBy("__g", "__c").agg(F.count(F.lit(1)).alias("__n"))
    same = F.col(group).eqNullSafe(F.col("__g")) & F.col(category).eqNullSafe(F.col("__c"))
    return targets.join(have, on=same, how="left").select(*targets.columns, F.coalesce("__n", F.lit(0)).alias("available"))


def _distinct(records: DataFrame, group: str, category: str, key: str) -> DataFrame:
    return records.where(F.col(key).isNotNull()).select(F.col(group).alias("__g"), F.col(category).alias("__c"), F.col(key).alias("__key")).distinct()


def proportional_sample(records: DataFrame, targets: DataFrame, group: str, category: str, key: str, by: str, seed: int = 31) -> DataFrame:
    """The sampled keys: ``by``, ``group``, ``category``, ``key``, rank, by_floor.

    ``targets`` (of ``with_availability``) has one row per sample ``by`` and category: ``group`` (whose records it
    draws from), ``category``, target (the category's weight, in any unit), floor (records that come first) and
    seats (records of the whole sample, the same in all rows of a sample). Records that repeat a key within a
    category count once, null keys never; a null category is a category if ``targets`` names it. A category with a
    null or non-positive target only gets its floor. Floors beyond the seats are served by priority. If all records
    together are fewer than the seats, all of them come.
    """
    t = targets.select(
        by,
        F.col(group).alias("__tg"),
        F.col(category).alias("__tc"),
        F.greatest(F.coalesce("target", F.lit(0)), F.lit(0)).cast("double").alias("__target"),
        F.coalesce("floor", F.lit(0)).alias("__floor"),
        F.coalesce("seats", F.lit(0)).alias("__seats"),
        "available",
    )
    same = F.col("__g").eqNullSafe(F.col("__tg")) & F.col("__c").eqNullSafe(F.col("__tc"))
    drawn = _distinct(records, group, category, key).join(bounded(t), on=same, how="inner").withColumn("__u", hash_uniform(seed, by, "__key"))
    rank_bucket = F.floor(F.col("__u") * F.ceil(F.col("available") / F.lit(BUCKET_ROWS)))
    ranked = bucketed_rank(drawn, [by, "__c"], rank_bucket, [F.col("__u"), F.col("__key")], "rank")
    # No category can get more than all seats; a category of weight 0 ends at its floor.
    able = ranked.where((F.col("rank") <= F.col("__seats")) & ((F.col("__target") > 0) | (F.col("rank") <= F.col("__floor"))))
    total = t.groupBy(F.col(by).alias("__b")).agg(F.sum("__target").alias("__sum"))
    ordered = (
        able.join(bounded(total), on=F.col(by).eqNullSafe(F.col("__b")), how="inner")
        .withColumn("by_floor", F.col("rank") <= F.col("__floor"))
        .withColumn("__share", F.coalesce(F.try_divide("__target", "__sum"), F.lit(0.0)))
        .withColumn("__priority", F.coalesce(F.try_divide(F.col("rank") - 0.5, "__share"), F.lit(float("inf"))))
    )
    # About one record per unit of priority: a bucket holds at most about BUCKET_ROWS records of a sample.
    bucket = F.when(F.col("by_floor"), F.lit(-1.0)).otherwise(F.floor(F.col("__priority") / F.lit(float(BUCKET_ROWS))).cast("double"))
    best = [F.col("__priority"), F.col("__c"), F.col("__key")]
    placed = bucketed_rank(ordered, [by], bucket, best, "__place")
    return placed.where(F.col("__place") <= F.col("__seats")).select(
        by, F.col("__g").alias(group), F.col("__c").alias(category), F.col("__key").alias(key), "rank", "by_floor"
    )


def sample_report(sample: DataFrame, targets: DataFrame, group: str, category: str, by: str) -> DataFrame:
    """One row per sample and category: available, taken, target_share, actual_share and short (target exceeds available).

    ``short`` compares the category's wanted records, its share of the seats and at least its floor, with those that exist.
    """
    got = sample.groupBy(F.col(by).alias("__b"), F.col(category).alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    same = F.col(by).eqNullSafe(F.col("__b")) & F.col(category).eqNullSafe(F.col("__c"))
    full = targets.join(got, on=same, how="left").withColumn("taken", F.coalesce("__n", F.lit(0))).drop("__b", "__c", "__n")
    total = full.groupBy(F.col(by).alias("__b")).agg(F.sum("target").alias("__t"), F.sum("taken").alias("__a"))
    return (
        full.join(total, on=F.col(by).eqNullSafe(F.col("__b")), how="inner")
        .withColumn("target_share", F.try_divide("target", "__t"))
        .withColumn("actual_share", F.try_divide("taken", "__a"))
        .withColumn("wanted", F.greatest(F.col("seats") * F.coalesce("target_share", F.lit(0.0)), F.coalesce("floor", F.lit(0)).cast("double")))
        .withColumn("short", F.col("wanted") > F.col("available"))
        .drop("__b", "__t", "__a")
    )
