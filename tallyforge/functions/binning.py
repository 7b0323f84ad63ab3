"""Bin edges and bin numbers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def edges(spec: Sequence) -> list[float]:
    """Edges from pieces [low, high, number of bins]; joints that two pieces share count once."""
    out: list[float] = []
    for low, high, n in spec:
        if n < 1 or high <= low:
            raise ValueError(f"not a range of bins: {[low, high, n]}")
        out += [x for x in np.linspace(low, high, int(n) + 1).tolist() if not out or x != out[-1]]
    if sorted(out) != out:
        raise ValueError("bins must ascend")
    return out


def with_overflow(bins: Sequence[float]) -> list[float]:
    """Edges with an open bin at either end."""
    return [*([] if bins[0] == -np.inf else [-np.inf]), *bins, *([] if bins[-1] == np.inf else [np.inf])]


def subdivide(bins: Sequence[float], n: int) -> list[float]:
    """Every bin cut into ``n`` equal ones."""
    return [a + (b - a) * k / n for a, b in zip(bins, bins[1:], strict=False) for k in range(n)] + [bins[-1]]


def bin_index(col: Column | str, bins: Sequence[float]) -> Column:
    """Number of the bin from 0; bins are closed below, the last one also above. Null outside, for NaN and for null.

    A binary search written out as nested conditions: log2(bins) comparisons a row, in generated code.
    """
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    last = len(bins) - 2

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(x < F.lit(bins[middle]), search(low, middle - 1)).otherwise(search(middle, high))

    return F.when(x.isNull() | F.isnan(x) | (x < F.lit(bins[0])) | (x > F.lit(bins[-1])), F.lit(None)).otherwise(search(0, last)).cast("int")
