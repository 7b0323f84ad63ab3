"""Weights that bring every class's histogram to a common target."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.binning import bin_index
from tallyforge.operators.histograms import Bins, axes, dense
from tallyforge.session import bounded

TARGETS = ("mean", "min", "max", "uniform")
#: Most cells of a class whose weights are looked up by place.
MAX_CELLS = 1_000_000


def weight_name(group: str, variables: Sequence[str], class_var: str, target: object, func_name: str | None = None) -> str:
    """Name of the weight column of a reweighting."""
    if isinstance(target, (list, tuple)):
        return "_".join(["weight", group, *variables, "target", *([func_name] if func_name else []), *map(str, target)])
    aim = ["none"] if target is None else [str(target), class_var]
    return "_".join(["weight", group, *variables, "target", *([func_name] if func_name else []), *aim])


def target_histogram(hist: DataFrame, by: str, target: object, bins: Bins, func: Callable[[Column], Column] | None = None) -> DataFrame:
    """Bins with ``target``, from a histogram (by, bins, n) of all classes; a bin that a class lacks counts 0 for it.

    ``target``: a class, a list of classes (their mean), or mean, min, max or uniform over the classes seen.
    ``func`` changes the target at last. Raises for an unknown target.
    """
    full = dense(hist, by, bins)
    n = F.col("n").cast("double")
    if isinstance(target, (list, tuple)):
        value = F.sum(F.when(F.col(by).isin(*target), n).otherwise(0.0)) / F.lit(len(target))
    elif target in TARGETS:
        value = {"mean": F.avg(n), "min": F.min(n), "max": F.max(n), "uniform": F.max(F.lit(1.0))}[target]
    elif isinstance(target, int) and not isinstance(target, bool):
        value = F.sum(F.when(F.col(by) == F.lit(target), n).otherwise(0.0))
    else:
        raise ValueError(f"unknown target {target!r}: a class, a list of classes or one of {TARGETS}")
    out = full.groupBy(*axes(bins)).agg(value.alias("target"))
    return out.withColumn("target", func(F.col("target"))) if func else out


def check_target(target: DataFrame) -> None:
    """Raises if a bin's target is negative or no number."""
    bad = target.where(F.col("target").isNull() | F.isnan("target") | (F.col("target") < 0)).head(1)
    if bad:
        raise ValueError(f"negative or missing target in bin {bad[0].asDict()}")


def class_weights(hist: DataFrame, target: DataFrame, by: str, bins: Bins) -> DataFrame:
    """by, bins, weight: target / n; 0 for all classes in a bin that any class lacks."""
    full = dense(hist, by, bins)
    least = full.groupBy(*axes(bins)).agg(F.min("n").alias("least")).join(target, axes(bins))
    weight = F.when(F.col("least") == 0, 0.0).otherwise(F.try_divide("target", "n"))
    return full.join(least, axes(bins)).select(by, *axes(bins), weight.alias("weight"))


def _flat(places: Sequence[Column], bins: Bins) -> Column:
    """Number of a cell among all cells of the grid; null outside."""
    cell = F.lit(0)
    for place, e in zip(places, bins.values(), strict=True):
        cell = cell * (len(e) - 1) + place
    return cell


def weight_lists(weights: DataFrame, by: str, bins: Bins) -> Column:
    """All weights as one map from class to the list of its cells' weights, for lookups in nested rows by place.

    The list goes to every task: raises if a class has more than MAX_CELLS cells. Then explode the elements and use ``apply_weights``.
    """
    cells = 1
    for e in bins.values():
        cells *= len(e) - 1
    if cells > MAX_CELLS:
        raise ValueError(f"{cells} cells are too many for lists of weights")
    # Each class gets every cell, by sorting: looking cells up in a map would compare each with all others.
    cell = weights.select(by, _flat([F.col(b) for b in axes(bins)], bins).cast("bigint").alias("cell"), "weight")
    every = weights.select(by).distinct().select(by, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cells - 1).cast("bigint"))).alias("cell"))
    full = every.join(cell, [by, "cell"], "left").select(by, F.struct("cell", F.coalesce("weight", F.lit(0.0)).alias("w")).alias("c"))
    lists = full.groupBy(by).agg(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["w"]).alias("w"))
    return lists.agg(F.map_from_entries(F.collect_list(F.struct(by, "w")))).scalar()


def apply_weights(df: DataFrame, weights: DataFrame, by: str, bins: Bins, out: str) -> DataFrame:
    """``df`` with the weight of its class and bins, 0 outside the bins. The weight table, a row per class and filled bin, is broadcast only if it is small."""
    keyed = df.withColumns({b: bin_index(v, e) for b, (v, e) in zip(axes(bins), bins.items(), strict=True)})
    found = keyed.join(bounded(weights.withColumnRenamed("weight", "__w")), [by, *axes(bins)], "left")
    return found.withColumn(out, F.coalesce("__w", F.lit(0.0))).drop("__w", *axes(bins))


def nested_histogram(df: DataFrame, array: str, by: str, bins: Bins, valid: str = "valid") -> DataFrame:
    """Histogram of the valid elements of an array of structs, by a field of the elements."""
    rows = df.select(F.explode(array).alias("e")).where(F.col(f"e.{valid}"))
    cells = {b: bin_index(F.col(f"e.{v}"), e) for b, (v, e) in zip(axes(bins), bins.items(), strict=True)}
    return rows.select(F.col(f"e.{by}").alias(by), *[c.alias(b) for b, c in cells.items()]).dropna().groupBy(by, *axes(bins)).agg(F.count(F.lit(1)).alias("n"))


def nested_weights(df: DataFrame, array: str, weights: Column, by: str, bins: Bins, out: str, valid: str = "valid") -> DataFrame:
    """``df`` with ``out``, one weight per element, by the lists of ``weight_lists``: no explode, no shuffle. Invalid elements get 0."""

    def one(e: Column) -> Column:
        cell = _flat([bin_index(e[v], b) for v, b in bins.items()], bins)
        return F.when(e[valid], F.coalesce(F.get(F.try_element_at("__lists", e[by]), cell), F.lit(0.0))).otherwise(0.0)

    return df.withColumn("__lists", weights).withColumn(out, F.transform(array, one)).drop("__lists")
