"""Balancing classes by drawing rows: importance sampling, per-bin quotas, caps. Randomness is a function of seed and key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.randomness import md5_uniform
from tallyforge.operators.histograms import Bins, axes, probabilities, with_bins
from tallyforge.operators.ranking import numbered, random_order
from tallyforge.session import cut_lineage


def cap(df: DataFrame, by: str, caps: dict[object, int], key: str, seed: object) -> DataFrame:
    """At most ``caps[class]`` random rows of each class; -1 keeps all, classes without a cap are left out."""
    limit = F.coalesce(*[F.when(F.col(by) == F.lit(c), F.lit(n if n >= 0 else 2**62)) for c, n in caps.items()])
    return random_order(df.where(F.col(by).isin(*caps)), [by], key, seed).where(F.col("rank") <= limit).drop("rank", "u")


def check_supply(df: DataFrame, by: str, caps: dict[object, int], fraction: float = 1.0) -> None:
    """Raises if a class has fewer rows, times the sampling fraction, than its cap asks for."""
    have = {r[by]: r["n"] for r in df.where(F.col(by).isin(*caps)).groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per class asked for
    short = {c: (n, have.get(c, 0)) for c, n in caps.items() if n >= 0 and int(have.get(c, 0) * fraction) < n}
    if short:
        raise ValueError(f"fewer rows than requested (requested, available): {short}")


def auto_fraction(requested: Column, total: Column) -> Column:
    """The sampling fraction that gives a tenth more than requested, at least 0.1; null without rows."""
    return F.greatest(F.round(F.try_divide(requested * F.lit(1.1), total), 3), F.lit(0.1))


def check_fraction(fraction: float, method: str) -> str | None:
    """A warning for a fraction above 1; an error where rows are not drawn with replacement."""
    if fraction <= 1:
        return None
    text = f"sampling fraction {fraction} is above 1: rows will be repeated"
    if method == "countup":
        raise ValueError(text)
    return text


def bin_quotas(target: DataFrame, draws: int | Column, bins: Bins, seed: object, by: Sequence[str] = ()) -> DataFrame:
    """Bins with quota, floor(draws * p + u): the target's probabilities times the draws, rounded at random; and the draws.

    ``target`` has a row per bin, or per bin and group ``by``.
    """
    where = F.concat_ws("|", *by, *axes(bins))
    draws = F.lit(draws) if isinstance(draws, int) else draws
    return target.select(*by, *axes(bins), "p", F.floor(draws * F.col("p") + md5_uniform(seed, where)).cast("bigint").alias("quota"), draws.cast("bigint").alias("draws"))


def countup(df: DataFrame, quotas: DataFrame, bins: Bins, key: str, seed: object, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``key``, bins and copies: the first quota rows of every bin in random order, topped up with repeats.

    Groups ``by`` are drawn on their own, all in one plan. A bin of n < quota rows gives every row, and the rest of its
    quota by random repeats of its rows; a bin without rows gives none. If the bins of a group together give fewer than
    its draws, random places among the rows given so far are repeated. More than that, by the random rounding of the
    quotas, are left for the caller's cap.
    """
    cells = [*by, *axes(bins)]
    binned = with_bins(df, bins).select(key, *cells)
    have = binned.groupBy(*cells).agg(F.count(F.lit(1)).alias("have"))
    # A row per bin that has rows and a quota, stored: where the bin's places end, and the places of its group.
    of = Window.partitionBy(*by)
    need = have.join(quotas.select(*cells, "quota", "draws"), cells).where("quota > 0")
    need = cut_lineage(need.withColumns({"upto": F.sum("quota").over(of.orderBy(*axes(bins))), "total": F.sum("quota").over(of), "filled": F.count(F.lit(1)).over(of)}))
    where = F.concat_ws("|", *cells, "i")
    own = numbered(need.where("quota > have").select(*cells, "have", "quota"), F.col("have") + 1, F.col("quota")).select(
        *cells, (F.floor(md5_uniform(f"{seed}-bin", where) * F.col("have")) + 1).cast("bigint").alias("rank")
    )
    lacking = need.where("draws > total").select(*by, "draws", "total", "filled").distinct()
    # Bins and places meet by blocks as wide as a bin is on average: about two bins for every place.
    wide = F.greatest(F.floor(F.col("total") / F.col("filled")), F.lit(1))
    spot = F.concat_ws("|", *by, "i")
    again = numbered(lacking, F.lit(1), F.col("draws") - F.col("total")).select(*by, (F.floor(md5_uniform(f"{seed}-all", spot) * F.col("total")) + 1).alias("place"), wide.alias("wide"))
    blocks = F.sequence(F.floor((F.col("upto") - F.col("quota") + 1) / wide), F.floor(F.col("upto") / wide))
    bounds = need.select(*cells, "have", "quota", "upto", F.explode(blocks).alias("block"))
    inside = (F.col("place") <= F.col("upto")) & (F.col("place") > F.col("upto") - F.col("quota"))
    met = again.withColumn("block", F.floor(F.col("place") / F.col("wide"))).join(bounds, [*by, "block"]).where(inside).withColumn("i", (F.col("place") - (F.col("upto") - F.col("quota"))).cast("bigint"))
    # A place beyond the bin's rows is one of its repeats: that of the row it repeats.
    rank = F.when(F.col("i") <= F.col("have"), F.col("i")).otherwise(F.floor(md5_uniform(f"{seed}-bin", where) * F.col("have")) + 1)
    more = met.select(*cells, rank.cast("bigint").alias("rank"))
    extra = own.unionByName(more).groupBy(*cells, "rank").agg(F.count(F.lit(1)).alias("extra"))
    return (
        random_order(binned, cells, key, seed)
        .join(need.select(*cells, "quota"), cells)
        .where(F.col("rank") <= F.col("quota"))
        .join(extra, [*cells, "rank"], "left")
        .select(*by, key, *axes(bins), (F.lit(1) + F.coalesce("extra", F.lit(0))).cast("bigint").alias("copies"))
    )


def importance_sample(df: DataFrame, ratios: DataFrame, bins: Bins, key: str, draws: Column | int, seed: object, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``key``, bins and copies: ``draws`` rows of each group drawn with replacement, each with weight ratio of its bin.

    Weights are equal within a bin, so a bin's share of the draws is n * ratio of the total; draws are spread over
    the bins in proportion, the rest by largest remainder, and within a bin each draw picks a row by its random number.
    ``draws`` may be a column of ``ratios``, which has a row per bin, or per bin and group.
    """
    cells = [*by, *axes(bins)]
    binned = with_bins(df, bins).select(key, *cells)
    counts = binned.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy(*by)
    draws = F.lit(draws) if isinstance(draws, int) else draws
    mass = counts.join(ratios.select(*cells, "ratio", draws.alias("draws")), cells).withColumn("w", F.round(F.col("n") * F.col("ratio"), 9)).where("w > 0")
    # Bins only, no rows: at most as many as the histogram has.
    exact = mass.withColumn("want", F.col("draws") * F.col("w") / F.sum("w").over(of)).withColumn("base", F.floor("want"))
    place = F.row_number().over(of.orderBy(F.round(F.col("base") - F.col("want"), 6), *axes(bins)))
    spare = exact.withColumns({"spare": F.col("draws") - F.sum("base").over(of), "place": place})
    share = cut_lineage(spare.withColumn("k", (F.col("base") + F.when(F.col("place") <= F.col("spare"), 1).otherwise(0)).cast("bigint")).where("k > 0").select(*cells, "n", "k"))
    where = F.concat_ws("|", *cells, "i")
    picks = numbered(share, F.lit(1), F.col("k")).select(*cells, (F.floor(md5_uniform(f"{seed}-pick", where) * F.col("n")) + 1).cast("bigint").alias("rank"))
    drawn = picks.groupBy(*cells, "rank").agg(F.count(F.lit(1)).alias("copies"))
    return random_order(binned, cells, key, seed).join(drawn, [*cells, "rank"]).select(*by, key, *axes(bins), "copies")


def upsampling(drawn: DataFrame, by: Sequence[str], copies: str = "copies") -> DataFrame:
    """Per class: written rows, unique_rows, most_copies and their ratio. ``drawn`` has a row per chosen row."""
    return (
        drawn.groupBy(*by)
        .agg(F.sum(copies).alias("written"), F.count(F.lit(1)).alias("unique_rows"), F.max(copies).alias("most_copies"))
        .withColumn("upsampling_ratio", F.col("written") / F.col("unique_rows"))
    )


def validate(method: str | None, upscale: int | None) -> None:
    """Raises for an unknown method, and for upscaled bins with quotas."""
    if method not in (None, "none", "pdf", "countup"):
        raise ValueError(f"unknown resampling method {method!r}")
    if method == "countup" and upscale not in (None, 1):
        raise ValueError("countup takes no upscaled bins")


def target_probabilities(df: DataFrame, is_target: Column, bins: Bins) -> DataFrame:
    """The target class's histogram with probabilities."""
    hist = with_bins(df.where(is_target), bins).groupBy(*axes(bins)).agg(F.count(F.lit(1)).alias("n"))
    total = hist.agg(F.sum("n")).scalar()
    return hist.withColumn("p", F.col("n") / total)


__all__ = ["auto_fraction", "bin_quotas", "cap", "check_fraction", "check_supply", "countup", "importance_sample", "probabilities", "random_order", "target_probabilities", "upsampling", "validate"]
