"""Randomness as a function of a seed and a row key: the same in every run, for any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_uniform(seed: object, *key: Column | str) -> Column:
    """A double in [0, 1) from the first 32 bits of md5("seed:key:..."); other SQL engines give the same bits."""
    parts = [F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in key]]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def md5_uniform_sql(seed: object, *key: str) -> str:
    """The same number as DuckDB SQL."""
    parts = ", ".join([f"'{seed}'", *[f"cast({k} as varchar)" for k in key]])
    return f"(('0x' || substr(md5(concat_ws(':', {parts})), 1, 8))::bigint / 4294967296.0)"


def hash_uniform(seed: int, *key: Column | str) -> Column:
    """A double in [0, 1) from 53 bits of xxhash64: the cheap form, for what need not be compared elsewhere."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11)
    return bits.cast("double") / F.lit(float(1 << 53))
