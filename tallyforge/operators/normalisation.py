"""Means, standard deviations and class weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Parts of names of whole-number columns that are no class labels.
NO_LABELS = ("VertexIndex", "ftagTruthParentBarcode", "barcode", "eventNumber", "jetFoldHash")


def _number(c: str | Column) -> Column:
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def moments(df: DataFrame, group: str, variables: Mapping[str, str | Column] | Sequence[str]) -> DataFrame:
    """A row per variable: group, variable, n, mean and std (of the population), over values that are numbers and finite, and n_infinite, how many are not finite."""
    cols = variables if isinstance(variables, Mapping) else {v: v for v in variables}
    infinite = lambda c: F.count_if(F.abs((F.col(c) if isinstance(c, str) else c).cast("double")) == float("inf"))
    one = df.agg(
        *[f(_number(c)).alias(f"{k}{i}") for i, c in enumerate(cols.values()) for k, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_pop))],
        *[infinite(c).alias(f"i{i}") for i, c in enumerate(cols.values())],
    )
    names = {"n": "n", "m": "mean", "s": "std", "i": "n_infinite"}
    rows = F.array(*[F.struct(F.lit(group).alias("group"), F.lit(v).alias("variable"), *[F.col(f"{k}{i}").alias(name) for k, name in names.items()]) for i, v in enumerate(cols)])
    return one.select(F.inline(rows))


def nested_moments(df: DataFrame, group: str, array: str, variables: Sequence[str], valid: str = "valid") -> DataFrame:
    """``moments`` over the valid elements of an array of structs."""
    return moments(df.select(F.explode(array).alias("e")).where(F.col(f"e.{valid}")).select("e.*"), group, variables)


def pooled(parts: DataFrame, by: Sequence[str] = ("group", "variable")) -> DataFrame:
    """Moments of all rows from moments (n, mean, std) of disjoint parts; parts without rows do not count."""
    of = Window.partitionBy(*by)
    rows = parts.where("n > 0").withColumn("__m", F.sum(F.col("n") * F.col("mean")).over(of) / F.sum("n").over(of))
    away = F.col("mean") - F.col("__m")
    n, square = F.sum("n"), F.sum(F.col("n") * (F.col("std") * F.col("std") + away * away))
    return rows.groupBy(*by).agg(n.alias("n"), F.first("__m").alias("mean"), F.sqrt(square / n).alias("std"))


def check_moments(table: DataFrame) -> None:
    """Raises unless every mean and standard deviation is finite and no deviation is 0."""
    bad = table.where(F.col("mean").isNull() | F.isnan("mean") | F.col("std").isNull() | F.isnan("std") | (F.col("std") == 0)).head(1)
    if bad:
        raise AssertionError(f"no usable moments: {bad[0].asDict()}")


def label_columns(df: DataFrame) -> list[str]:
    """Whole-number columns that may be class labels; letter case in names does not count."""
    return [n for n, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint") and not any(x.lower() in n.lower() for x in NO_LABELS)]


def class_counts(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """variable, label, n: one pass for all label columns; null labels are none."""
    each = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("bigint").alias("label")) for c in labels])
    return df.select(F.inline(each)).where("label is not null").groupBy("variable", "label").agg(F.count(F.lit(1)).alias("n"))


def nested_class_counts(df: DataFrame, array: str, no_labels: Sequence[str] = (), valid: str = "valid") -> DataFrame:
    """``class_counts`` of the whole-number fields of the valid elements of an array of structs; variables are named "array.field"."""
    each = df.select(F.explode(array).alias("e")).where(F.col(f"e.{valid}")).select("e.*")
    labels = [c for c in label_columns(each) if c not in no_labels]
    if not labels:
        return class_counts(each.withColumn("none", F.lit(None).cast("bigint")), ["none"])
    return class_counts(each, labels).withColumn("variable", F.concat(F.lit(f"{array}."), "variable"))


def merge_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Counts of both, label by label."""
    return a.unionByName(b).groupBy("variable", "label").agg(F.sum("n").alias("n"))


def class_weights(counts: DataFrame) -> DataFrame:
    """Adds weight: all rows by the class's rows, the smallest being 1, to two digits."""
    of = Window.partitionBy("variable")
    raw = counts.withColumn("__w", F.sum("n").over(of) / F.col("n"))
    return raw.withColumn("weight", F.round(F.col("__w") / F.min("__w").over(of), 2)).drop("__w")


def as_dict(table: DataFrame) -> dict[str, dict[str, dict[str, float]]]:
    """Moments as nested dictionaries, a row per variable: ready for a YAML or JSON file."""
    out: dict = {}
    for r in table.collect():  # a row per variable
        out.setdefault(r["group"], {})[r["variable"]] = {"mean": r["mean"], "std": r["std"]}
    return out
