"""The cut language: comparisons, membership and modulo comparisons, as data that turns into Spark columns."""

from __future__ import annotations

import ast
import operator
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPARE = {"==": operator.eq, "!=": operator.ne, "<=": operator.le, ">=": operator.ge, "<": operator.lt, ">": operator.gt}
_OPERATOR = re.compile(r"^(?:(?P<compare>==|!=|<=|>=|<|>)|(?P<member>in|notin)|%(?P<modulus>\d+)(?P<than>==|!=|<=|>=|<|>))$")
_TEXT = re.compile(r"^\s*(?P<variable>[A-Za-z_][\w.]*)\s*(?P<op>(?:%\d+)?(?:==|!=|<=|>=|<|>)|\bnotin\b|\bin\b)\s*(?P<value>.+?)\s*$")


def _numbers(op: str, value: object, col: Column, met: Column) -> Column:
    """``met``, but not for NaN, which is above all numbers for Spark."""
    return met & ~F.isnan(col) if op in (">", ">=") and isinstance(value, (int, float)) and not isinstance(value, bool) else met


@dataclass(frozen=True)
class Cut:
    """One condition on one variable. A null value meets no cut, NaN only those by ``!=`` and ``notin``, a modulo is never negative (as for floored division)."""

    variable: str
    op: str
    value: object

    def __post_init__(self) -> None:
        found = _OPERATOR.match(self.op)
        if not found:
            raise ValueError(f"unknown operator {self.op!r} in a cut on {self.variable}")
        if found["member"] and not isinstance(self.value, (list, tuple, set, frozenset)):
            raise ValueError(f"{self.op} needs a list of values, got {self.value!r}")
        if found["modulus"] and int(found["modulus"]) == 0:
            raise ValueError(f"modulo 0 in a cut on {self.variable}")

    @classmethod
    def of(cls, cut: Cut | str | Iterable) -> Cut:
        """From a cut, a triple (variable, operator, value), or a text such as ``"pt > 20"`` or ``"n %10<= 7"``."""
        if isinstance(cut, Cut):
            return cut
        if not isinstance(cut, str):
            variable, op, value = cut
            return cls(variable, op.replace(" ", ""), tuple(value) if isinstance(value, (list, set)) else value)
        found = _TEXT.match(cut)
        if not found:
            raise ValueError(f"not a cut: {cut!r}")
        try:
            value = ast.literal_eval(found["value"])
        except (ValueError, SyntaxError):
            value = found["value"]
        return cls(found["variable"], found["op"], tuple(value) if isinstance(value, (list, set)) else value)

    def column(self, of: Column | None = None) -> Column:
        """The condition as a column; ``of`` stands for the variable, if it is not a column of that name."""
        col = F.col(self.variable) if of is None else of
        found = _OPERATOR.match(self.op)
        if found["compare"]:
            return _numbers(found["compare"], self.value, col, COMPARE[found["compare"]](col, F.lit(self.value)))
        if found["member"]:
            inside = col.isin(*self.value)
            return inside if self.op == "in" else ~inside
        return _numbers(found["than"], self.value, col, COMPARE[found["than"]](F.pmod(col, F.lit(int(found["modulus"]))), F.lit(self.value)))


@dataclass(frozen=True)
class Cuts:
    """Conditions that must all hold."""

    cuts: tuple[Cut, ...] = ()

    @classmethod
    def of(cls, cuts: Cuts | Iterable | None) -> Cuts:
        if isinstance(cuts, Cuts):
            return cuts
        return cls(tuple(Cut.of(c) for c in cuts or ()))

    def __add__(self, other: Cuts) -> Cuts:
        return Cuts(self.cuts + other.cuts)

    def __radd__(self, other: object) -> Cuts:
        return self  # sum() starts with 0

    def __iter__(self) -> Iterator[Cut]:
        return iter(self.cuts)

    def __len__(self) -> int:
        return len(self.cuts)

    @property
    def variables(self) -> list[str]:
        return list(dict.fromkeys(c.variable for c in self.cuts))

    def ignore(self, variables: Iterable[str]) -> Cuts:
        """Without the cuts on these variables."""
        left_out = set(variables)
        return Cuts(tuple(c for c in self.cuts if c.variable not in left_out))

    def column(self) -> Column:
        return reduce(operator.and_, (c.column() for c in self.cuts), F.lit(True))

    def element(self, item: Column) -> Column:
        """The conditions on the fields of a nested element."""
        return reduce(operator.and_, (c.column(item[c.variable]) for c in self.cuts), F.lit(True))

    def bounds(self, variable: str) -> tuple[float | None, float | None]:
        """Largest lower and smallest upper bound that the cuts set for a variable."""
        own = [c for c in self.cuts if c.variable == variable]
        low = [c.value for c in own if c.op in (">", ">=")]
        high = [c.value for c in own if c.op in ("<", "<=")]
        return max(low, default=None), min(high, default=None)
