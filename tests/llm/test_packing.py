import math
import random
from collections import Counter, defaultdict

import pytest

from tallyforge.llm import packing, queries


def least_bins(sizes, capacity):
    """Fewest bins, by search, for few items."""
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def loads(bins):
    out = Counter()
    large = Counter()
    for size, a, b, first, each in bins.plan:
        for j in range((b - a) // each):
            out[first + j] += each * size
            large[first + j] += each * (3 * size > bins.capacity)
    return out, large


@pytest.mark.parametrize("seed", range(30))
def test_every_item_once_within_capacity_and_near_the_best(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100])
    sizes = sorted((rng.randint(1, capacity) for _ in range(9)), reverse=True)
    bins = packing.match_histogram(Counter(sizes), capacity)
    full, large = loads(bins)
    assert len(full) == bins.next and max(full.values()) <= capacity and max(large.values()) <= 2
    assert Counter({s: n for s, n in bins.rank.items()}) == Counter(sizes)
    assert bins.next <= least_bins(sizes, capacity) + 1


def test_large_histogram():
    rng = random.Random(1)
    counts = Counter(min(512, int(rng.lognormvariate(5, 1)) + 1) for _ in range(50_000))
    bins = packing.match_histogram(counts, 512)
    full, _ = loads(bins)
    total = sum(s * n for s, n in counts.items())
    assert sum(full.values()) == total and bins.next <= 1.01 * max(math.ceil(total / 512), sum(n for s, n in counts.items() if s > 256))
    same = packing.match_histogram({s: 1000 * n for s, n in counts.items()}, 512)
    assert len(same.plan) < 6000


def packed(spark, rows, capacities=(10,)):
    sized = spark.createDataFrame(rows, "doc_id bigint, tokenizer string, n_tokens int, container string")
    boxes = spark.createDataFrame([(f"c{c}", "t", c) for c in capacities], "container string, tokenizer string, capacity_tokens int")
    return packing.pack(sized, boxes), boxes


def test_table(spark):
    rows = [(1, "t", 25, "x"), (2, "t", 5, "x"), (2, "t", 5, "x"), (3, "t", 0, "x"), (4, "t", None, "x"), (5, "t", 10, "x"), (None, "t", 2, "x"), (6, "other", 3, "x")]
    out, boxes = packed(spark, rows, (10, 40))
    got = out.collect()
    bins = defaultdict(int)
    for r in got:
        assert (r["bin_id"] is None) == (r["size"] == 0)
        bins[r["container"], r["bin_id"]] += r["size"]
    assert {b: s for (c, b), s in bins.items() if c == "c10" and b is not None} and max(s for (c, b), s in bins.items() if c == "c10") <= 10
    assert sorted(r["size"] for r in got if r["container"] == "c10" and r["doc_id"] == 1) == [5, 10, 10]
    assert [r["size"] for r in got if r["container"] == "c40" and r["doc_id"] == 1] == [25]
    report = {r["container"]: r for r in packing.pack_report(out, boxes).collect()}
    assert report["c10"]["tokens"] == 47 and report["c10"]["bins"] == 5 and report["c40"]["bins"] == 2
    assert not [r for r in got if r["doc_id"] == 6]


def test_nothing(spark):
    out, boxes = packed(spark, [])
    assert out.count() == 0 and packing.pack_report(out, boxes).count() == 0
    only_empty, boxes = packed(spark, [(1, "t", 0, "x")])
    assert packing.pack_report(only_empty, boxes).first()["bins"] == 0


def test_many_equal_sizes_in_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 50)
    out, _ = packed(spark, [(i, "t", 4 if i % 3 else 3, "x") for i in range(1000)])
    bins = defaultdict(list)
    for r in out.collect():
        bins[r["bin_id"]].append(r["size"])
    assert sum(map(len, bins.values())) == 1000 and max(map(sum, bins.values())) <= 10
    assert sorted(bins) == list(range(len(bins)))


def test_corpus(spark, data):
    rows = queries.p7_packed(spark, data).collect()
    size = Counter()
    for r in rows:
        if r["bin_id"] is not None:
            size[r["container"], r["bin_id"]] += r["size"]
    capacity = {"short": 512, "medium": 2048, "long": 8192}
    assert all(n <= capacity[c] for (c, _), n in size.items())
    for c, cap in capacity.items():
        total = sum(n for (k, _), n in size.items() if k == c)
        assert len([1 for k, _ in size if k == c]) <= math.ceil(total / cap) * 1.05 + 1
