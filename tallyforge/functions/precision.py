"""Numbers of fewer binary digits than Spark has types for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits after the first one of a half-precision number, its smallest exponent, and the least number that becomes infinite.
HALF_DIGITS, HALF_EXPONENT, HALF_LIMIT = 10, -14, 65520.0


def half(col: Column | str) -> Column:
    """The nearest half-precision number, as a float: ties go to the even one, large numbers become infinite; null, NaN and infinities stay."""
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    size = F.abs(x)
    # The logarithm may be off by one next to a power of two.
    near = F.greatest(F.floor(F.log2(F.when(size > 0, size).otherwise(1.0))), F.lit(HALF_EXPONENT))
    exponent = near + F.when(size >= F.pow(F.lit(2.0), near + 1), 1).when((size < F.pow(F.lit(2.0), near)) & (near > HALF_EXPONENT), -1).otherwise(0)
    unit = F.pow(F.lit(2.0), exponent - HALF_DIGITS)
    rounded = F.when(F.isnan(x) | (size == float("inf")), x).when(size >= HALF_LIMIT, F.signum(x) * float("inf")).otherwise(F.rint(x / unit) * unit)
    return rounded.cast("float")


def half_sql(x: str) -> str:
    """The same as DuckDB SQL."""
    x = f"cast({x} as double)"
    unit = f"pow(2.0, greatest(floor(log2(abs({x}))), {HALF_EXPONENT}) - {HALF_DIGITS})"
    return f"cast(case when isnan({x}) or isinf({x}) or {x} = 0 then {x} when abs({x}) >= {HALF_LIMIT} then sign({x}) * 'inf'::double else round_even({x} / {unit}, 0) * {unit} end as float)"
