"""Proportional samples against seats given one by one."""

from collections import Counter

import pytest

from tallyforge.llm import proportional


def sample(spark, rows, targets):
    records = spark.createDataFrame(rows, "g string, c int, id int, rank string")
    t = spark.createDataFrame(targets, "s string, g string, c int, target double, floor int, seats int")
    t = proportional.with_availability(records, t, "g", "c", "id")
    got = proportional.proportional_sample(records, t, "g", "c", "id", "s")
    return got, t, {(r["s"], r["c"]): r for r in proportional.sample_report(got, t, "g", "c", "s").collect()}


def divisor_seats(have, target, floor, seats):
    """Brute force: seats one by one, floors first, then the smallest (rank - 1/2) / target."""
    total = sum(target.values())
    queue = [(r > floor[c], (r - 0.5) / (target[c] / total) if target[c] else float("inf"), c) for c in have for r in range(1, have[c] + 1) if target[c] or r <= floor[c]]
    return Counter(c for _, _, c in sorted(queue)[:seats])


@pytest.mark.parametrize("seats", [1, 10, 100, 333, 5000])
def test_sample_is_the_divisor_method(spark, seats):
    have, target, floor = {0: 500, 1: 40, 2: 7, 3: 90}, {0: 5.0, 1: 3.0, 2: 1.0, 3: 0.0}, {0: 0, 1: 0, 2: 5, 3: 4}
    rows = [("g", c, 1000 * c + i, "x") for c, n in have.items() for i in range(n)] * 2 + [("g", None, 1, "x"), ("g", 0, None, "x"), ("h", 0, 1, "x")]
    got, _, report = sample(spark, rows, [("s", "g", c, target[c], floor[c], seats) for c in have])
    want = divisor_seats(have, target, floor, seats)
    assert {c: report["s", c]["taken"] for c in have} == {c: want[c] for c in have}
    ids = [r["id"] for r in got.collect()]
    assert len(ids) == len(set(ids)) == sum(want.values())
    assert report["s", 2]["available"] == 7 and report["s", 2]["short"] == (seats / 9 > 7)


def test_sample_of_nothing(spark):
    got, _, report = sample(spark, [], [("s", "g", 1, 1.0, 1, 5), (None, "g", 1, None, None, None)])
    assert got.count() == 0 and report["s", 1]["taken"] == 0 and report["s", 1]["short"]
