"""Positions within groups of any size.

A plain window puts a whole group into one task. Here a group is cut into order-preserving buckets of bounded
size: bucket counts give each bucket's offset, and only buckets are sorted. Only the bucket counts of a group
(its rows divided by the bucket size) meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.randomness import md5_uniform
from tallyforge.session import cut_lineage

#: Rows that are sorted together, and the most buckets beside each group's first that a random order makes: of more rows, larger buckets.
BUCKET_ROWS, MOST_BUCKETS = 100_000, 100_000
#: Numbers of a run that one row makes.
RUN = 10_000


def bucketed_rank(df: DataFrame, group: Sequence[str], bucket: Column, order: Sequence[Column], out: str = "rank", few: bool = False) -> DataFrame:
    """Adds ``out``, the 1-based position by (``bucket``, ``order``) within ``group``.

    ``bucket`` must not contradict the wanted order: rows of a lower bucket come first. Null groups form a group
    of their own; ties in ``order`` are numbered in any order, so end it with a unique column where that matters.
    An empty table stays empty. Only buckets that rows of their group precede have an offset to join; ``few`` says
    that these are few enough, whatever the number of rows, to be broadcast.
    """
    keyed = df.withColumn("__bucket", bucket)
    where = [*group, "__bucket"]
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*where)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(
            *[F.col(c).alias(f"__g{i}") for i, c in enumerate(where)],
            F.sum("__n").over(before).alias("__before"),
        )
        .where("__before > 0")
    )
    same = [F.col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(where)]
    inside = Window.partitionBy(*where).orderBy(*order)
    return (
        keyed.withColumn("__in", F.row_number().over(inside))
        .join(F.broadcast(offsets) if few else offsets, on=same, how="left")
        .withColumn(out, F.col("__in") + F.coalesce("__before", F.lit(0)))
        .drop("__bucket", "__in", "__before", *[f"__g{i}" for i in range(len(where))])
    )


def random_order(df: DataFrame, group: Sequence[str], key: str, seed: object, out: str = "rank", bucket_rows: int | None = None) -> DataFrame:
    """Adds ``u``, a random number of ``key``, and ``out``, the 1-based place of each row by it within ``group``.

    A group of more than ``bucket_rows`` rows (or a MOST_BUCKETS-th of all rows, if that is more) is cut by ``u`` into as
    many buckets as it needs, all others stay whole. So at most MOST_BUCKETS groups are cut, into no more buckets
    beside their first than that: both tables are broadcast, and rows are shuffled once. Sizes are counted at once;
    where no group is to be cut, there are no offsets to look for.
    """
    sizes = cut_lineage(df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")))
    rows = max(bucket_rows or BUCKET_ROWS, -(-(sizes.agg(F.sum("__n")).first()[0] or 0) // MOST_BUCKETS))
    cut = sizes.where(F.col("__n") > rows)
    numbers = df.withColumn("u", md5_uniform(seed, key))
    order = [F.col("u"), F.col(key)]
    if cut.isEmpty():
        return numbers.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint"))
    buckets = cut.select(*[F.col(c).alias(f"__h{i}") for i, c in enumerate(group)], F.ceil(F.col("__n") / F.lit(rows)).alias("__buckets"))
    same = [F.col(c).eqNullSafe(F.col(f"__h{i}")) for i, c in enumerate(group)]
    keyed = numbers.join(F.broadcast(buckets), on=same, how="left")
    ranked = bucketed_rank(keyed, group, F.floor(F.col("u") * F.coalesce("__buckets", F.lit(1))), order, out, few=True)
    return ranked.drop("__buckets", *[f"__h{i}" for i in range(len(group))])


def numbered(df: DataFrame, first: Column, last: Column, out: str = "i") -> DataFrame:
    """Each row once for every number from ``first`` to ``last``; none if ``last`` is less.

    Runs of RUN numbers are spread over the partitions first, so that no row and no task makes them all.
    """
    runs = df.withColumns({"__first": first.cast("bigint"), "__last": last.cast("bigint")}).where("__first <= __last")
    runs = runs.withColumn("__run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__last") - F.col("__first")) / F.lit(RUN)))))
    start = F.col("__first") + F.col("__run") * F.lit(RUN)
    return runs.repartition("__run", *df.columns).withColumn(out, F.explode(F.sequence(start, F.least(F.col("__last"), start + F.lit(RUN - 1))))).drop("__first", "__last", "__run")
