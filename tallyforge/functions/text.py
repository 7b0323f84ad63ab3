"""Small string expressions: canonical spellings, ids in names, display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(col: Column | str) -> Column:
    """Lower case, without blanks, hyphens and underscores; null stays null."""
    return F.regexp_replace(F.lower(_c(col)), r"[\s_-]+", "")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def name_part(name: Column | str, place: int, default: str) -> Column:
    """Part of a name between dots, from 1, counted from the end if negative; ``default`` where there is none or an empty one."""
    return F.coalesce(F.nullif(F.try_element_at(F.split(_c(name), r"\."), F.lit(place)), F.lit("")), F.lit(default))


def match_label(name: str, labels: dict[str, str]) -> str:
    """Label of the longest key that the name holds, letter case aside; the name itself if none does."""
    found = [k for k in labels if k.lower() in name.lower()]
    return labels[max(found, key=len)] if found else name


def with_suffix(path: str, suffix: str) -> str:
    """``dir/name.ext`` becomes ``dir/name_suffix.ext``."""
    stem, dot, ext = path.rpartition(".")
    return f"{stem}_{suffix}.{ext}" if dot and "/" not in ext else f"{path}_{suffix}"
