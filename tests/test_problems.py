"""Operators of the general problems on small fixtures: brute force, nulls, ties, repeats, empty tables, clashing names."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import archive, drift, skew
from tallyforge.operators.ranking import bucketed_rank
from tallyforge.operators.skew import heavy_keys, salted_aggregate


# --- skewed keys ---------------------------------------------------------------------------------------------------
def test_salted_aggregate_is_the_plain_one(spark):
    keys = [None if i % 97 == 0 else "hot" if i % 3 else f"k{i % 11}" for i in range(3000)]
    df = spark.createDataFrame([(k, float(i % 13) if i % 5 else None, i) for i, k in enumerate(keys)], "k string, v double, n int")
    got = {r["k"]: (r["rows"], r["total"], r["low"], r["high"], r["values"]) for r in salted_aggregate(
        df, ["k"], {"rows": ("count", F.lit(1)), "total": ("sum", F.col("v")), "low": ("min", F.col("v")), "high": ("max", F.col("n")), "values": ("count", F.col("v"))}, salts=7
    ).collect()}
    want = {}
    for k in set(keys):
        own = [(float(i % 13) if i % 5 else None, i) for i, x in enumerate(keys) if x == k]
        vs = [v for v, _ in own if v is not None]
        want[k] = (len(own), sum(vs), min(vs), max(i for _, i in own), len(vs))
    assert got == want
    assert {r["k"] for r in heavy_keys(df, ["k"], 0.3, 1.0).collect()} == {"hot"} and heavy_keys(df, ["k"], 0.3, 1.0, 500).count() == 1 and heavy_keys(df.limit(0), ["k"], 0.3).count() == 0


@pytest.mark.parametrize("salts", [1, 5])
def test_distinct_values_of_a_heavy_key(spark, monkeypatch, salts):
    monkeypatch.setattr(skew, "SAMPLE_SHARE", 1.0)
    df = spark.createDataFrame([("hot" if i % 4 else None, i % 321 if i % 7 else None) for i in range(4000)], "k string, v int")
    got = {r["k"]: (r["n"], r["d"]) for r in salted_aggregate(df, ["k"], {"n": ("count", F.lit(1)), "d": ("distinct", F.col("v"))}, salts=salts).collect()}
    want = {r["k"]: (r["n"], r["d"]) for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("d")).collect()}
    assert got == want
    with pytest.raises(ValueError):
        salted_aggregate(df, ["k"], {"a": ("distinct", F.col("v")), "b": ("distinct", F.col("k"))})


def test_salted_aggregate_edges(spark):
    df = spark.createDataFrame([], "k string, v double, __salt int, n int")
    assert salted_aggregate(df, ["k"], {"n": ("count", F.lit(1))}).count() == 0
    one = spark.createDataFrame([(None, None), (None, None)], "k string, v double")
    assert salted_aggregate(one, ["k"], {"s": ("sum", F.col("v")), "n": ("count", F.col("v"))}).collect() == [(None, None, 0)]
    clash = spark.createDataFrame([(1, 2, 3)], "__k0 int, __v0 int, __heavy int")
    assert salted_aggregate(clash, ["__k0"], {"s": ("sum", F.col("__v0"))}).collect() == [(1, 2)]
    with pytest.raises(ValueError):
        salted_aggregate(df, ["k"], {"k": ("count", F.lit(1))})
    with pytest.raises(ValueError):
        salted_aggregate(df, ["k"], {"x": ("median", F.col("v"))})


def test_bucketed_rank(spark):
    df = spark.createDataFrame([("a" if i % 3 else None, (i * 37) % 101) for i in range(100)], "g string, x int")
    got = bucketed_rank(df, ["g"], F.floor(F.col("x") / 10), [F.col("x")], "place").collect()
    for g in ("a", None):
        own = sorted((r["place"], r["x"]) for r in got if r["g"] == g)
        assert [p for p, _ in own] == list(range(1, len(own) + 1)) and [x for _, x in own] == sorted(x for _, x in own)


# --- archive -------------------------------------------------------------------------------------------------------
FILES = [
    (1, "a.csv", "csv", "jet_id,pt,eta,flavour_label\n5,1.50,0.1,2\n6,2.0,,2\n7,3.0,0.2"),
    (2, "b.json", "ndjson", '{"jet_id": 5, "pt": 1.5, "eta": 0.1, "flavour_label": 2}\r\n\r\n{"jet_id": 8, "pt": 2}\n{"jet_id": 9, "pt'),
    (3, "c.json", "ndjson", ""),
    (4, "d.json", "ndjson", None),
    (5, "e.csv", "csv", "eta,jet_id,pt,flavour_label\n0.3,9,4.0,1\nx,y,z,w\n"),
    (6, "f.csv", "csv", "pt,eta\n1,2\n"),
    (7, "g.xml", "xml", "<a>ünïcödé漢</a>"),
    (8, "h.json", "ndjson", '[1]\n"x"\n{"jet_id": null}\n{"jet_id": "12"}'),
]


def files(spark, rows=FILES):
    return spark.createDataFrame([(*r, 1 if r[0] % 2 else None, "extra") for r in rows], "file_id int, file_path string, file_format string, payload string, label int, block string")


@pytest.mark.parametrize("block_bytes", [1, 40, 1 << 20])
def test_archive_round_trip(spark, block_bytes):
    blocks = archive.pack(files(spark), "label", "file_path", "payload", ["file_id", "file_format"], block_bytes)
    back = {r["path"]: (r["payload"], r["intact"], r["file_id"]) for r in archive.unpack(blocks).collect()}
    assert back == {p: (s, True, i) for i, p, _, s in FILES}
    found = archive.lookup(blocks, spark.createDataFrame([("g.xml",), ("none",), ("g.xml",)], "path string")).collect()
    assert [(r["path"], r["payload"]) for r in found] == [("g.xml", FILES[6][3])]


def test_archive_is_stored(spark, tmp_path):
    blocks = archive.pack(files(spark), "label", "file_path", "payload", ["file_id"], 40)
    archive.write(blocks, str(tmp_path / "containers"))
    back = spark.read.parquet(str(tmp_path / "containers"))
    assert {r["path"]: (r["payload"], r["intact"]) for r in archive.unpack(back).collect()} == {p: (s, True) for _, p, _, s in FILES}
    got = {r["label"]: r for r in archive.report(back, "label").collect()}
    assert got[1]["n_files"] == 4 and got[None]["n_files"] == 4 and got[1]["n_blocks"] >= 2 and sum(r["n_bytes"] for r in got.values()) == sum(len((s or "").encode()) for *_, s in FILES)


def test_archive_checksum_shows_damage(spark):
    blocks = archive.pack(files(spark), "label", "file_path", "payload", ["file_id"])
    bad = blocks.withColumn("block", F.translate(F.col("block").cast("string"), "5", "6").cast("binary"))
    got = {r["path"]: r["intact"] for r in archive.unpack(bad).collect()}
    assert not got["a.csv"] and not got["b.json"] and got["f.csv"]


def test_archive_of_nothing(spark):
    blocks = archive.pack(files(spark).limit(0), "label", "file_path", "payload", ["file_id"])
    assert blocks.count() == 0 and archive.unpack(blocks).count() == 0


def test_records_and_compact(spark):
    recs = archive.records(files(spark).select("file_id", "file_format", "payload"))
    got = sorted((r["file_id"], r["jet_id"], r["pt"], r["eta"], r["flavour_label"]) for r in recs.select("file_id", "jet_id", "pt", F.coalesce("eta", F.lit(-9.0)).alias("eta"), F.coalesce("flavour_label", F.lit(-9)).alias("flavour_label")).collect())
    assert got == [(1, 5, 1.5, 0.1, 2), (1, 6, 2.0, -9.0, 2), (2, 5, 1.5, 0.1, 2), (2, 8, 2.0, -9.0, -9), (5, 9, 4.0, 0.3, 1), (8, 12, None, -9.0, -9)]
    once = archive.compact(recs.select("file_id", "pos", "jet_id", "pt", "flavour_label"), "jet_id", "flavour_label", ["file_id", "pos"], rows_per_file=1)
    assert sorted(r["jet_id"] for r in once.collect()) == [5, 6, 8, 9, 12]
    assert {r["jet_id"]: r["file_id"] for r in once.collect()}[5] == 2
    assert {r["file_no"] for r in once.collect()} <= {0, 1}


# --- drifting schemas ----------------------------------------------------------------------------------------------
def jets(spark, n=60):
    rows = [(i, *[float(1000 * i + k * 37) if k in (0, 3, 4) else (i % 23) / 7 + k for k in range(6)], 5000 + 13 * i, i % 5, 5, i % 4, [(bool((i + s) % 3), s / 10 + i / 1000, 0.5, 0.25, i / 500 - s, s) for s in range(4)]) for i in range(n)]
    return spark.createDataFrame(
        rows + rows[:5],
        "jet_id bigint, pt double, eta double, abs_eta double, mass double, pt_btagjes double, eta_btagjes double, eventnumber int, jetfoldhash int, hadronconeexcltruthlabelid int, flavour_label int, "
        "tracks array<struct<valid:boolean,dphi:double,deta:double,qoverp:double,d0:double,leptonid:int>>",
    )


def record(i, **names):
    """A record of jet i: names maps field to (quantity, how to write it)."""
    truth = {"pt": float(1000 * i), "mass": float(1000 * i + 111), "eventnumber": 5000 + 13 * i, "flavour_label": i % 4}
    return {"jet_id": i} | {f: w(truth[q]) for f, (q, w) in names.items()}


def changes(spark, dumps):
    table = spark.createDataFrame([(i, p, s, d, "x") for i, (p, s, d) in enumerate(dumps)], "dump_id bigint, producer string, seq_no int, payload string, field string")
    return sorted(tuple(r) for r in drift.schema_changes(table, jets(spark)).collect())


def test_schema_changes(spark):
    a = [record(i, pt=("pt", float), label=("flavour_label", int), mass=("mass", float)) for i in range(1, 9)]
    b = [record(i, ptJet=("pt", str), label=("flavour_label", int), mass=("mass", float)) for i in range(9, 20)]
    c = [record(i, ptJet=("pt", str), mass=("mass", int), event=("eventnumber", int)) for i in range(20, 30)]
    null = [record(i, ptJet=("pt", lambda v: None), mass=("mass", lambda v: None), event=("eventnumber", int)) for i in range(30, 33)]
    lines = lambda rs: "\n".join(map(json.dumps, rs))
    got = changes(spark, [("p", 1, lines(a)), ("p", 4, json.dumps(b)), ("p", 3, ""), ("p", 2, None), ("p", 2, "[]"), ("p", 5, lines(c)), ("p", 6, lines(null)), ("p", 7, lines(c)), (None, 1, lines(a)), (None, 2, lines(a))])
    assert got == [(1, "pt", "renamed"), (1, "pt", "retyped"), (5, "event", "added"), (5, "label", "removed"), (5, "mass", "retyped")]


def test_schema_changes_in_tracks(spark):
    def dump(name, write, i):
        return json.dumps([{"jet_id": i, "tracks": [{name: write(bool((i + s) % 3)), "d0": round(i / 500 - s, 3)} for s in range(4)]} for i in range(i, i + 9)])

    got = changes(spark, [("p", 1, dump("valid", bool, 1)), ("p", 2, dump("mask", int, 10)), ("p", 3, dump("mask", lambda v: "Y" if v else "N", 20)), ("q", 1, "no json\n{}\n[1]")])
    assert got == [(1, "tracks.valid", "renamed"), (1, "tracks.valid", "retyped"), (2, "tracks.mask", "retyped")]


def test_unified_table(spark):
    rs = [record(i, ptJet=("pt", str), cls=("flavour_label", float), odd=("mass", lambda v: "n/a")) | {"tracks": [{"ok": bool((i + s) % 3)} for s in range(4)]} for i in range(1, 12)]
    dumps = spark.createDataFrame([(1, "p", 1, json.dumps(rs)), (2, "p", 2, None)], "dump_id bigint, producer string, seq_no int, payload string")
    again = dumps.withColumn("dump_id", F.col("dump_id") + 10)
    assert drift.unified(dumps.union(again), jets(spark)).count() == 11
    got = {r["jet_id"]: r for r in drift.unified(dumps, jets(spark)).collect()}
    assert drift.unified(dumps, jets(spark)).schema["pt"].dataType.simpleString() == "float"
    assert len(got) == 11 and got[3]["pt"] == 3000.0 and got[3]["flavour_label"] == 3 and got[3]["mass"] is None
    assert [t["valid"] for t in got[3]["tracks"]] == [bool((3 + s) % 3) for s in range(4)] and got[3]["tracks"][0]["d0"] is None


def test_drift_of_nothing(spark):
    dumps = spark.createDataFrame([], "dump_id bigint, producer string, seq_no int, payload string")
    assert drift.schema_changes(dumps, jets(spark)).count() == 0 and drift.unified(dumps, jets(spark).limit(0)).count() == 0


def test_preceding_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(drift, "DUMPS_PER_BUCKET", 2)
    field = "array<struct<name string, kind string, quantity string>>"
    rows = [("p", s, s * 10, [(f"f{s}", "whole", None)]) for s in (None, 1, 2, 3, 8, 9, 20) if s is not None] + [("p", None, 5, [("f0", None, None)])]
    got = {r["dump_id"]: r["old"][0]["name"] if r["old"] else None for r in drift._with_preceding(spark.createDataFrame(rows, f"producer string, seq_no int, dump_id int, now {field}")).collect()}
    assert got == {5: None, 10: "f0", 20: "f1", 30: "f2", 80: "f3", 90: "f8", 200: "f9"}


def pairs_of(*rows):
    """Rows of ``choose``: (name, kind, quantity, n, hits, everywhere, fields of the same dumps)."""
    return pd.DataFrame([("p", *r) for r in rows], columns=["producer", "name", "kind", "quantity", "n", "hits", "everywhere", "together"])


def chosen(part):
    return dict(zip(drift.choose(part)["name"], drift.choose(part)["quantity"], strict=True))


def test_flooding_decides_where_values_and_names_do_not(monkeypatch):
    """Whole numbers that agree with a whole and a decimal column: the types of the graph tell, against the name."""
    part = pairs_of(("mass_no", "whole", "mass", 9, 9, 0.9, []), ("mass_no", "whole", "eventnumber", 9, 9, 0.9, []), ("w", "decimal", "pt", 9, 1, 0.1, []))
    assert chosen(part) == {"mass_no": "eventnumber"}
    monkeypatch.setattr(drift, "flood", lambda rows: rows["first"].to_numpy(float))
    assert chosen(part) == {"mass_no": "mass"}


def test_correspondences_are_one_to_one_within_a_dump():
    both = [("a", "decimal", q, 9, 9, e, ["b"]) for q, e in (("eta", 1.0), ("abs_eta", 0.9))] + [("b", "decimal", q, 9, 9, e, ["a"]) for q, e in (("eta", 0.99), ("abs_eta", 0.5))]
    assert chosen(pairs_of(*both)) == {"a": "eta", "b": "abs_eta"}
    later = [(n, k, q, a, b, e, []) for n, k, q, a, b, e, _ in both]
    assert chosen(pairs_of(*later)) == {"a": "eta", "b": "eta"}
    taken = [("a", "decimal", "eta", 9, 9, 1.0, ["b"]), ("b", "decimal", "eta", 9, 9, 0.9, ["a"]), ("b", "decimal", "pt", 9, 2, 0.0, ["a"])]
    assert chosen(pairs_of(*taken)) == {"a": "eta", "b": "eta"}


def test_fields_without_values_go_by_name_and_graph():
    part = pairs_of(("flavourLabel", None, "flavour_label", 0, 0, 0.95, []), ("flavourLabel", None, "jetfoldhash", 0, 0, 0.1, []), ("odd", None, "pt", 0, 0, None, []), ("pt", "decimal", "pt", 9, 9, 1.0, []))
    assert chosen(part) == {"flavourLabel": "flavour_label", "pt": "pt"}


def test_types_tell_a_renaming(spark):
    """mass and eventnumber have the same values here: whole numbers under a name like mass are the eventnumber all the same."""
    table = jets(spark).withColumn("mass", F.col("eventnumber").cast("double"))
    dump = lambda name, ids: json.dumps([{"jet_id": i, name: 5000 + 13 * i} for i in ids])
    dumps = spark.createDataFrame([(1, "p", 1, dump("mass_no", range(1, 9))), (2, "p", 2, dump("eventNumber", range(9, 20)))], "dump_id bigint, producer string, seq_no int, payload string")
    assert [tuple(r) for r in drift.schema_changes(dumps, table).collect()] == [(2, "mass_no", "renamed")]


def test_flooding_prefers_agreement_then_names():
    pairs = pd.DataFrame([("p", "flavourLabel", "whole", q, f) for q, f in (("flavour_label", 0.99), ("jetfoldhash", 0.4), ("pt", 0.0))] + [("q", "x", "decimal", "pt", 0.9), ("q", "x", "decimal", "mass", 0.2)], columns=["producer", "name", "kind", "quantity", "first"])
    score = drift.flood(pairs)
    assert score[0] > score[1] > score[2] and score[3] > score[4] and score.max() <= 1
    assert drift.name_similarity("flavourLabel", "flavour_label") == 1 and drift.name_similarity("abc", "xyz") == 0
