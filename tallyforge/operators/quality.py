"""Checks of input samples: names, sizes, and sizes that differ too much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Production campaigns by reconstruction tag.
CAMPAIGNS = {
    "r13167": "MC20a", "r14859": "MC20a", "r13144": "MC20d", "r14860": "MC20d", "r13145": "MC20e", "r14861": "MC20e", "r14622": "MC23a",
    "r14932": "MC23a", "r15540": "MC23a", "r15224": "MC23d", "r15530": "MC23d", "r16083": "MC23e", "r14799": "MC23c - REMOVE",
}


def dataset_id(name: Column) -> Column:
    """Six digits between dots; null if there are none."""
    return F.nullif(F.regexp_extract(name, r"\.(\d{6})\.", 1), F.lit(""))


def reconstruction_tag(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"_(r\d+)", 1), F.lit(""))


def campaign(tag: Column) -> Column:
    """Campaign of a tag, the tag itself if unknown; null without a tag."""
    known = F.create_map(*[F.lit(x) for pair in CAMPAIGNS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, tag), tag)


def entry_name(name: Column) -> Column:
    """"id / campaign"; where one of them is missing the whole name takes its place, so that different files stay apart; without both, the name."""
    i, c = dataset_id(name), campaign(reconstruction_tag(name))
    return F.when(i.isNull() & c.isNull(), name).when(i.isNull(), F.concat_ws(" / ", name, c)).otherwise(F.concat_ws(" / ", i, F.coalesce(c, name)))


def sample_sizes(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def size_spread(sizes: DataFrame, group: str) -> DataFrame:
    """Per group of samples: smallest and largest size, geometric mean, their ratio and the largest deviation from the mean."""
    mean = F.exp(F.avg(F.ln("n")))
    return sizes.groupBy(group).agg(
        F.count(F.lit(1)).alias("samples"),
        F.min("n").alias("smallest"),
        F.max("n").alias("largest"),
        mean.alias("geometric_mean"),
        F.try_divide(F.max("n").cast("double"), F.min("n")).alias("spread"),
        F.greatest(F.try_divide(F.max("n").cast("double"), mean), F.try_divide(mean, F.min("n").cast("double"))).alias("deviation"),
    )


def check_sizes(spread: DataFrame, factor: float) -> None:
    """Raises for samples without rows, and for sizes that differ by more than ``factor``."""
    bad = spread.where((F.col("smallest") == 0) | (F.col("spread") > factor) | (F.col("deviation") > factor)).head(1)
    if bad:
        raise ValueError(f"sample sizes differ by more than {factor}: {bad[0].asDict()}")
