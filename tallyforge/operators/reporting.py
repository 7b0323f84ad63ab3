"""Distributions and labels for reports, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.operators.histograms import Bins, axes


def plot_histogram(df: DataFrame, by: Sequence[str], value: str, low: float, high: float, bins: int = 50) -> DataFrame:
    """``by``, bin, n and share of the class: equal bins, values outside the range in the edge bins, NaN and nulls left out."""
    x = F.col(value).cast("double")
    place = F.least(F.greatest(F.floor((x - low) / F.lit((high - low) / bins)), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*by, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def stitching_windows(bounds: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """A window around every boundary of adjacent regions: 100,000 to either side, 100 where the boundary is at most 10,000."""
    ordered = sorted(bounds)
    out = []
    for (_, high), (low, _) in zip(ordered, ordered[1:], strict=False):
        half = 100 if high <= 10_000 else 100_000
        if high == low:
            out.append((high - half, high + half))
    return out


def full_range(bounds: Sequence[tuple[float, float]]) -> tuple[float, float]:
    return min(b[0] for b in bounds), max(b[1] for b in bounds)


def project_weights(weights: DataFrame, by: str, bins: Bins, keep: Sequence[int]) -> DataFrame:
    """Weights summed over all other axes."""
    return weights.groupBy(by, *[axes(bins)[i] for i in keep]).agg(F.sum("weight").alias("weight"))


def compact_count(n: Column) -> Column:
    """999, 100k, 1.5k, 10M: thousands and millions with at most six digits, without zeros at the end."""
    millions = n / 1_000_000
    short = F.when(millions < 10, F.round(millions, 5)).when(millions < 100, F.round(millions, 4)).when(millions < 1000, F.round(millions, 3)).otherwise(F.round(millions, 0))
    plain = lambda x: F.regexp_replace(F.format_string("%.6f", x.cast("double")), r"\.?0+$", "")
    return F.when(n >= 1_000_000, F.concat(plain(short), F.lit("M"))).when(n >= 1_000, F.concat(plain(n / 1_000), F.lit("k"))).otherwise(n.cast("string"))


def name_suffix(*parts: Column) -> Column:
    """Parts as the end of a file name, each after an underscore: anything but letters and digits becomes one, at a part's ends none; empty parts and nulls are left out."""
    each = [F.when(p != "", F.regexp_replace(F.regexp_replace(p, "[^A-Za-z0-9]+", "_"), "^_|_$", "")) for p in parts]
    return F.concat(F.lit("_"), F.concat_ws("_", *each))


def display_unit(name: str, value: Column | float) -> Column | float:
    """Momenta and masses in thousands."""
    return value / 1000 if "pt" in name.lower() or "mass" in name.lower() else value


def display_range(name: str, bounds: Sequence[float]) -> tuple[float, float]:
    """First and last edge in the unit of display; open edges give way to their finite neighbours."""
    finite = [e for e in bounds if abs(e) != float("inf")]
    if not finite:
        raise ValueError(f"no finite edge of {name}")
    return display_unit(name, min(finite)), display_unit(name, max(finite))
