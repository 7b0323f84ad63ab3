"""Filling containers of fixed capacity (problem 7).

Large-item matching: items above a third of the capacity pair at most twice per bin by greedy matching, the largest
with the largest that fits beside it; smaller items go, largest first, to the fullest bin that still holds them.

Sizes are whole numbers up to the capacity, so the number of items of each size says all that the matching needs:
it runs on that histogram of at most ``capacity`` rows, and gives for every size which ranks go to which bins. The
items themselves are only ranked within their size and joined with that plan; no task sees them all.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.randomness import hash_uniform
from tallyforge.operators.ranking import bucketed_rank

#: Items of a size that are sorted together.
BUCKET_ROWS = 100_000
PLAN = "container string, size int, rank_from bigint, rank_to bigint, bin_from bigint, per_bin int"


class Bins:
    """Bins by the room they have left, as ranges of bin numbers."""

    def __init__(self, capacity: int):
        self.capacity, self.next, self.gaps, self.ranges, self.plan, self.rank = capacity, 0, [], {}, [], {}

    def open(self, room: int, first: int, n: int) -> None:
        if n and room:
            if room not in self.ranges:
                insort(self.gaps, room)
            self.ranges.setdefault(room, []).append((first, n))

    def place(self, size: int, first: int, n_bins: int, per_bin: int = 1) -> None:
        """The next items of ``size`` go to the bins from ``first``, ``per_bin`` to each."""
        rank = self.rank.get(size, 0)
        self.rank[size] = rank + n_bins * per_bin
        self.plan.append((size, rank, rank + n_bins * per_bin, first, per_bin))

    def new(self, n: int) -> int:
        first, self.next = self.next, self.next + n
        return first

    def match(self, size: int, count: dict[int, int], sizes: list[int]) -> None:
        """All items of the large ``size``: pairs with the largest fitting large items, the rest alone."""
        while count[size]:
            k = bisect_right(sizes, min(self.capacity - size, size)) - 1
            while k >= 0 and (count[sizes[k]] == 0 or (sizes[k] == size and count[size] < 2)):
                k -= 1
            if k < 0:
                n, other = count[size], 0
            else:
                other = sizes[k]
                n = count[size] // 2 if other == size else min(count[size], count[other])
            first = self.new(n)
            if other == size:
                self.place(size, first, n, 2)
                count[size] -= 2 * n
            else:
                self.place(size, first, n)
                count[size] -= n
                if other:
                    self.place(other, first, n)
                    count[other] -= n
            self.open(self.capacity - size - other, first, n)

    def fill(self, size: int, n: int) -> None:
        """``n`` items of a small size: each to the fullest bin that holds it, else to a new one."""
        while n:
            k = bisect_left(self.gaps, size)
            if k == len(self.gaps):
                each = min(n, self.capacity // size)
                bins = n // each
                first, room = self.new(bins), self.capacity
            else:
                room = self.gaps[k]
                first, have = self.ranges[room].pop()
                each = min(n, room // size)
                bins = min(have, n // each)
                if have > bins:
                    self.ranges[room].append((first + bins, have - bins))
                elif not self.ranges[room]:
                    del self.ranges[room], self.gaps[k]
            self.place(size, first, bins, each)
            self.open(room - each * size, first, bins)
            n -= bins * each


def match_histogram(counts: dict[int, int], capacity: int) -> Bins:
    """Bins for ``counts`` items of each size from 1 to ``capacity``."""
    bins, count = Bins(capacity), {s: n for s, n in counts.items() if n > 0}
    large = sorted(s for s in count if 3 * s > capacity)
    for size in reversed(large):
        bins.match(size, count, large)
    for size in sorted((s for s in count if 3 * s <= capacity), reverse=True):
        bins.fill(size, count[size])
    return bins


def items(sized: DataFrame, containers: DataFrame, key: str) -> DataFrame:
    """The items of each container: a text as it is, or cut into full parts and a rest if it alone exceeds the capacity."""
    n, c = F.col("n_tokens"), F.col("capacity_tokens")
    parts = F.when(n > 0, F.sequence(F.lit(0), F.ceil(n / c).cast("int") - 1)).otherwise(F.array(F.lit(0)))
    return (
        sized.join(F.broadcast(containers.select("container", "tokenizer", "capacity_tokens")), "tokenizer")
        .withColumn("part_no", F.explode(parts))
        .withColumn("size", F.least(c, n - F.col("part_no") * c).cast("int"))
        .select("container", "capacity_tokens", key, "part_no", "size")
    )


def pack(sized: DataFrame, containers: DataFrame, key: str = "doc_id") -> DataFrame:
    """Where every text goes: container, ``key``, part_no, size (tokens of the part) and bin_id, from 0 per container.

    ``sized`` has ``key``, tokenizer and n_tokens (read twice: give it as a stored or checkpointed table);
    ``containers``, a few rows that are broadcast, container, tokenizer and capacity_tokens. Only texts that exceed
    the capacity are split: into full parts and a rest. Texts of no tokens take no room: their bin_id is null, as
    are null sizes (counted 0). Rows that repeat a key are items of their own. An empty table gives no rows; other
    columns are left out.
    """
    rows = items(sized.select(key, "tokenizer", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")), containers, key)
    count = rows.where("size > 0").groupBy("container", "capacity_tokens", "size").agg(F.count(F.lit(1)).alias("n"))

    def plan(part: pd.DataFrame) -> pd.DataFrame:
        capacity = int(part["capacity_tokens"].iloc[0])
        made = match_histogram(dict(zip(part["size"].tolist(), part["n"].tolist(), strict=True)), capacity).plan
        out = pd.DataFrame(made, columns=["size", "rank_from", "rank_to", "bin_from", "per_bin"])
        out.insert(0, "container", part["container"].iloc[0])
        return out

    steps = count.groupBy("container").applyInPandas(plan, PLAN)
    many = count.select(F.col("container").alias("__c"), F.col("size").alias("__s"), "n")
    keyed = rows.withColumn("__u", hash_uniform(41, "container", key, "part_no")).join(
        F.broadcast(many), on=(F.col("container") == F.col("__c")) & (F.col("size") == F.col("__s")), how="left"
    )
    bucket = F.floor(F.col("__u") * F.ceil(F.coalesce("n", F.lit(1)) / F.lit(BUCKET_ROWS)))
    ranked = bucketed_rank(keyed.drop("__c", "__s"), ["container", "size"], bucket, [F.col("__u"), F.col(key), F.col("part_no")], "rank")
    to = steps.select(F.col("container").alias("__c"), F.col("size").alias("__s"), "rank_from", "rank_to", "bin_from", "per_bin")
    at = (
        (F.col("container") == F.col("__c"))
        & (F.col("size") == F.col("__s"))
        & (F.col("rank") > F.col("rank_from"))
        & (F.col("rank") <= F.col("rank_to"))
    )
    bin_id = F.col("bin_from") + F.floor((F.col("rank") - 1 - F.col("rank_from")) / F.col("per_bin"))
    # The plan has a few rows per size, of which a container has at most its capacity.
    return ranked.join(F.broadcast(to), on=at, how="left").select("container", key, "part_no", "size", bin_id.cast("bigint").alias("bin_id"))


def pack_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """Per container: texts' parts, tokens, bins, the fewest bins that any packing needs at least, and the used share."""
    used = packed.groupBy("container").agg(F.count(F.lit(1)).alias("parts"), F.sum("size").alias("tokens"), (F.max("bin_id") + 1).alias("bins"))
    c = F.col("capacity_tokens")
    return used.join(F.broadcast(containers.select("container", "capacity_tokens")), "container").select(
        "container", "parts", "tokens", F.coalesce("bins", F.lit(0)).alias("bins"), F.ceil(F.col("tokens") / c).alias("bins_at_least"), F.try_divide("tokens", F.col("bins") * c).alias("used_share")
    )
