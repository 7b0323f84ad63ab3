"""Mixes of sources: targets, repeats, sizes, nulls."""

from pyspark.sql import functions as F

from tallyforge.llm import mixing


def test_mix_meets_its_targets(spark):
    rows = [("m", s, i, 1) for s, n in (("big", 5000), ("small", 30), ("tiny", 3)) for i in range(n)] + [("other", None, 1, 1), ("m", "unplanned", 1, 1)]
    records = spark.createDataFrame(rows, "mix string, source string, id int, size int")
    targets = spark.createDataFrame(
        [("m", "big", 700, 2), ("m", "small", 100, 4), ("m", "tiny", 50, 5), ("m", "absent", 9, 3), ("other", None, 3, None), ("void", "x", None, 1)], "mix string, source string, target_size bigint, max_repeat int"
    )
    plan = mixing.source_plan(records, targets, "mix", "source", "size")
    mixed = mixing.mix_sources(records, plan, "mix", "source", ["id"], "size")
    report = {r["source"]: r for r in mixing.mix_report(mixed, plan, "mix", "source", "size").collect()}
    assert {s: (r["emitted"], r["capped"]) for s, r in report.items()} == {"big": (700, False), "small": (100, False), "tiny": (15, True), "absent": (0, True), None: (3, False), "x": (0, False)}
    assert report["small"]["most_copies"] == 4 and report["tiny"]["most_copies"] == 5 and report["big"]["most_copies"] == 1
    assert abs(sum(r["actual_share"] for s, r in report.items() if s in ("big", "small", "tiny", "absent")) - 1) < 1e-9
    again = mixing.mix_sources(records.repartition(7), plan, "mix", "source", ["id"], "size")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, mixed.collect()), key=str)


def test_mix_of_nothing(spark):
    records = spark.createDataFrame([], "mix string, source string, id int, size int")
    targets = spark.createDataFrame([("m", "a", 5, 2)], "mix string, source string, target_size bigint, max_repeat int")
    plan = mixing.source_plan(records, targets, "mix", "source", "size")
    mixed = mixing.mix_sources(records, plan, "mix", "source", ["id"], "size")
    assert mixed.count() == 0 and mixing.mix_report(mixed, plan, "mix", "source", "size").collect()[0]["capped"]
    assert mixing.source_plan(records, targets.limit(0), "mix", "source", "size").count() == 0


def test_mix_with_sizes_and_nulls(spark):
    records = spark.createDataFrame([("m", "a", i, None if i % 10 == 0 else i % 7 + 1, "x") for i in range(2000)], "mix string, source string, id int, size int, copies string")
    total = records.agg(F.sum("size")).first()[0]
    targets = spark.createDataFrame([("m", "a", total // 3, 3)], "mix string, source string, target_size bigint, max_repeat int")
    plan = mixing.source_plan(records, targets, "mix", "source", "size")
    got = mixing.mix_report(mixing.mix_sources(records, plan, "mix", "source", ["id"], "size"), plan, "mix", "source", "size").first()
    assert abs(got["actual_size"] - total / 3) < 0.1 * total / 3 and not got["capped"]
