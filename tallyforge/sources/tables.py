"""Reading samples and writing results."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.randomness import md5_uniform


def read_sample(spark: SparkSession, patterns: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """All files of a sample as one table; ``renames`` maps stored names to used ones."""
    df = spark.read.parquet(*patterns)
    return df.withColumnsRenamed(dict(renames)) if renames else df


def remap_ints(col: Column, to: Mapping[int, int]) -> Column:
    """Values of ``to`` for its keys; all others stay."""
    if not to:
        return col
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in to.items() for x in p]), col), col)


def _with_ints(kinds: Mapping[str, T.DataType], maps: Mapping[str, Mapping[int, int]]) -> Callable[[Column], Column]:
    def element(e: Column) -> Column:
        return F.when(e.isNotNull(), F.struct(*[(remap_ints(e[n], maps[n]).cast(t) if n in maps else e[n]).alias(n) for n, t in kinds.items()]))

    return element


def with_ints(df: DataFrame, maps: Mapping[str, Mapping[int, int]]) -> DataFrame:
    """Remaps the columns and the fields of nested tables that have a map in ``maps``; types stay, unknown names raise."""
    known = datasets(df)
    if unknown := set(maps) - {n for names in known.values() for n in names}:
        raise ValueError(f"no variables {sorted(unknown)} to remap")
    kinds = dict(df.dtypes)
    out = {v: remap_ints(F.col(v), maps[v]).cast(kinds[v]) for v in known["jets"] if v in maps}
    for array in (g for g in known if g != "jets" and set(known[g]) & set(maps)):
        out[array] = F.transform(array, _with_ints({f.name: f.dataType for f in df.schema[array].dataType.elementType}, maps))
    return df.withColumns(out) if out else df


def datasets(df: DataFrame) -> dict[str, list[str]]:
    """Names of the variables by table: the plain columns ("jets"), and the fields of every array of structs."""
    out: dict[str, list[str]] = {"jets": []}
    for f in df.schema:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            out[f.name] = f.dataType.elementType.names
        else:
            out["jets"].append(f.name)
    return out


def full_precision(name: str) -> bool:
    """Momenta, energies and masses."""
    return any(x in name.lower() for x in ("pt", "energy", "mass"))


def project(df: DataFrame, variables: Mapping[str, Sequence[str]], extra: Sequence[str] = ()) -> DataFrame:
    """The chosen columns and fields of nested tables; unknown names raise when the plan is made."""
    top = list(dict.fromkeys([*variables.get("jets", ()), *extra]))
    return df.select(*top, *[_fields(g, v) for g, v in variables.items() if g != "jets"])


def _fields(array: str, names: Sequence[str]) -> Column:
    def pick(e: Column) -> Column:
        return F.struct(*[e[n].alias(n) for n in names])

    return F.transform(array, pick).alias(array)


def nest(parent: DataFrame, child: DataFrame, key: str, name: str) -> DataFrame:
    """Rows of ``child`` as an array of structs of their parent; parents without children get an empty array."""
    rows = child.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*[c for c in child.columns if c != key]))).alias(name))
    out = parent.join(rows, key, "left")
    kind = rows.schema[name].dataType.simpleString()
    return out.withColumn(name, F.coalesce(name, F.expr(f"cast(array() as {kind})")))


def estimated_rows(df: DataFrame, cuts: Column, n: int, key: str, seed: object) -> DataFrame:
    """One row: how many rows meet the cuts (``rows``), counted exactly if ``n`` is not positive, else scaled up from about ``n`` rows.

    The rows looked at are those of small random number: a filter, with which the scan's other columns are not decoded twice.
    """
    if n <= 0:
        return df.where(cuts).agg(F.count(F.lit(1)).cast("double").alias("rows"))
    total = df.agg(F.count(F.lit(1))).scalar()
    some = df.where(md5_uniform(seed, key) < F.lit(float(n)) / total)
    seen, met = F.count(F.lit(1)), F.count(F.when(cuts, 1))
    return some.agg((F.try_divide(met, seen) * total).alias("rows"))
