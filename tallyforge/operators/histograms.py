"""n-dimensional histograms as tables of filled bins: b0, b1, ... with counts and probabilities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.binning import bin_index

Bins = Mapping[str, Sequence[float]]


def axes(bins: Bins) -> list[str]:
    return [f"b{i}" for i in range(len(bins))]


def with_bins(df: DataFrame, bins: Bins) -> DataFrame:
    """``df`` with the bin number of every variable; rows outside any range are left out."""
    out = df.withColumns({b: bin_index(v, e) for b, (v, e) in zip(axes(bins), bins.items(), strict=True)})
    return out.dropna(subset=axes(bins))


def histogram(df: DataFrame, by: Sequence[str], bins: Bins) -> DataFrame:
    """``by``, bins, n: one hash aggregate, whatever the number of classes."""
    return with_bins(df, bins).groupBy(*by, *axes(bins)).agg(F.count(F.lit(1)).alias("n"))


def probabilities(hist: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds p, the bin's share of its class."""
    return hist.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def ratio_to_target(hist: DataFrame, by: str, target: object, bins: Bins) -> DataFrame:
    """Adds ratio, the target class's probability of the bin by the own one; 0 where the target has none.

    A histogram has no more rows than classes times bins, so the target's part, of at most one row per bin, is joined.
    """
    p = probabilities(hist, [by])
    aim = p.where(F.col(by) == F.lit(target)).select(*axes(bins), F.col("p").alias("__aim"))
    return p.join(aim, axes(bins), "left").withColumn("ratio", F.coalesce(F.try_divide("__aim", "p"), F.lit(0.0))).drop("__aim")


def check_probabilities(hist: DataFrame, by: Sequence[str], tolerance: float = 1e-4) -> DataFrame:
    """The classes whose probabilities do not sum to 1; raises if there are any."""
    bad = hist.groupBy(*by).agg(F.sum("p").alias("total")).where(F.abs(F.col("total") - 1) > tolerance)
    if found := bad.head(1):
        raise ValueError(f"probabilities of {found[0].asDict()} do not sum to 1")
    return bad


def dense(hist: DataFrame, by: str, bins: Bins) -> DataFrame:
    """Every class with every bin that any class fills, n being 0 where a class has none.

    Grows a filled bin's row by the classes it lacks: classes are gathered per histogram, not per row.
    """
    classes = hist.agg(F.sort_array(F.collect_set(by)).alias("c")).scalar()
    have = hist.groupBy(*axes(bins)).agg(F.map_from_entries(F.collect_list(F.struct(by, "n"))).alias("__have"))
    return have.select(*axes(bins), F.explode(classes).alias(by), "__have").select(
        by, *axes(bins), F.coalesce(F.try_element_at("__have", F.col(by)), F.lit(0)).alias("n")
    )
