"""Configuration, the whole run on the test table, the command line, sources and streaming."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from tallyforge import cli
from tallyforge.config import cuts_of_all_splits, load_yaml, parse
from tallyforge.functions.text import match_label, with_suffix
from tallyforge.operators import normalisation
from tallyforge.plans.pipeline import Pipeline
from tallyforge.sources import tables
from tallyforge.streaming import moments

CONFIG = {
    "flavours": [{"name": "bjets", "cuts": ["hadronconeexcltruthlabelid == 5"]}, {"name": "cjets", "cuts": ["hadronconeexcltruthlabelid == 4"]}, {"name": "ujets", "cuts": [["hadronconeexcltruthlabelid", "in", [0, 1, 2, 3]]]}],
    "samples": [{"name": "all", "pattern": "SET"}],
    "regions": [{"name": "low", "cuts": ["pt < 100000"]}, {"name": "high", "cuts": ["pt > 100000"]}],
    "global_cuts": {"train": [["eventnumber", "%10<=", 7]], "val": [["eventnumber", "%10==", 8]], "test": [["eventnumber", "%10==", 9]]},
    "components": [{"region": r, "sample": "all", "flavours": ["bjets", "cjets", "ujets"], "num_jets": 40} for r in ("low", "high")],
    "resampling": {"method": "countup", "target": "bjets", "variables": {"pt": {"bins": [[0, 250000, 4], [250000, 6000000, 2]]}, "abs_eta": {"bins": [[0, 2.5, 2]]}}},
    "variables": {"jets": {"inputs": ["pt_btagjes", "jet_id"], "labels": ["mass"]}, "tracks": {"inputs": ["d0", "dphi"], "selection": ["d0 < 0.2"]}},
    "num_jets_per_output_file": 100,
}


@pytest.fixture
def config(data, spark, tmp_path):
    once = spark.read.parquet(f"{data}/jets.parquet").dropDuplicates(["jet_id"])
    once.write.parquet(str(tmp_path / "in"))
    out = copy.deepcopy(CONFIG)
    out["samples"][0]["pattern"] = str(tmp_path / "in")
    return out


@pytest.mark.parametrize("change", [{}, {"method": "pdf"}, {"method": "pdf", "upscale_pdf": 2}, {"method": "none"}])
def test_run(spark, config, tmp_path, change):
    config["resampling"] |= change
    run = Pipeline(spark, config, str(tmp_path / "out"))
    if change.get("method") == "none":
        for c in config["components"]:
            c["num_jets"] = 10
    run = Pipeline(spark, config, str(tmp_path / "out"))
    run.run()
    rows = run.merged()
    per = {r["component"]: r["count"] for r in rows.groupBy("component").count().collect()}
    want = 10 if change.get("method") == "none" else 40
    assert set(per) == {f"{r}_all_{f}" for r in ("low", "high") for f in ("bjets", "cjets", "ujets")}
    assert all(want <= n <= want + 6 if not change else n == want for n in per.values())
    assert {"pt", "abs_eta", "pt_btagjes", "mass", "flavour_label", "tracks"} <= set(rows.columns) and "campaign" not in rows.columns
    assert {r["flavour_label"] for r in rows.where("component like '%cjets'").collect()} == {1}
    assert rows.where(F.exists("tracks", lambda t: ~t["valid"] | (t["d0"] >= 0.2))).count() == 0
    assert max(r["count"] for r in rows.groupBy("file_no").count().collect()) <= 100
    stats = json.loads(spark.read.text(run.path("statistics")).first()[0])
    assert stats["norm"]["jets"]["pt"]["std"] > 0 and set(stats["norm"]["tracks"]) == {"d0", "dphi"} and len(stats["class"]["flavour_label"]) == 3


def test_resampled_distribution_is_the_targets(spark, config, tmp_path):
    run = Pipeline(spark, config, str(tmp_path / "out"))
    run.run(["histograms", "resample", "merge"])
    share = {r["flavour_label"]: r["s"] for r in run.merged().where("component like 'low%'").groupBy("flavour_label").agg(F.avg((F.col("pt") < 62500).cast("int")).alias("s")).collect()}
    assert abs(share[1] - share[0]) < 0.25 and abs(share[2] - share[0]) < 0.25


def test_other_splits(spark, config, tmp_path):
    for c in config["components"]:
        c |= {"num_jets_val": 5, "num_jets_test": 7}
    Pipeline(spark, config, str(tmp_path / "out")).run(["histograms"])
    val = Pipeline(spark, config, str(tmp_path / "out"), "val")
    val.run(["resample", "merge"])
    assert val.merged().where("component = 'low_all_bjets'").count() == 5
    test = Pipeline(spark, config, str(tmp_path / "out"), "test")
    assert not test.prep.resampling.method and len(test.prep.components[0].cuts) == 2
    test.run(["resample", "merge"])
    assert "campaign" in test.merged().columns


def test_too_few_rows(spark, config, tmp_path):
    for c in config["components"]:
        c["num_jets"] = 10**6
    run = Pipeline(spark, config, str(tmp_path / "out"))
    with pytest.raises(ValueError, match="fewer rows"):
        run.run(["histograms", "resample"])
    with pytest.raises(ValueError, match="unknown stages"):
        run.run(["nothing"])
    run.check()


def test_config_rules():
    quotas = {c.name: c.num_jets for c in parse(CONFIG, "val").components}
    assert set(quotas.values()) == {4}
    every = copy.deepcopy(CONFIG)
    every["components"][0]["num_jets"] = -1
    assert {c.num_jets for c in parse(every, "test").components if c.region == "low"} == {-1}
    assert parse(CONFIG).labels == {"bjets": 0, "cjets": 1, "ujets": 2} and parse(CONFIG).inputs["tracks"] == ("d0", "dphi", "valid")

    def broken(**change):
        out = copy.deepcopy(CONFIG)
        for k, v in change.items():
            block, _, name = k.partition("__")
            (out["components"][0] if block == "component" else out[block])[name] = v
        return out

    for bad, error in (
        (broken(component__equal_jets=True), AssertionError), (broken(component__region="none"), ValueError), (broken(component__sample="none"), ValueError), (broken(component__flavours=["none"]), ValueError),
        (broken(resampling__method="other"), ValueError), (broken(resampling__upscale_pdf=2), ValueError), (broken(resampling__target=None), ValueError), (broken(component__flavours=["cjets"]), AssertionError),
        (broken(component__flavours=["bjets", "cjets"]), ValueError),
    ):
        with pytest.raises(error):
            parse(bad)
    with pytest.raises(ValueError):
        parse(CONFIG, "other")


def test_yaml_and_arguments(tmp_path):
    (tmp_path / "part.yaml").write_text("- pt > 5\n")
    (tmp_path / "main.yaml").write_text("a: &x {b: 1}\nc: {<<: *x, d: 2}\ncuts: !include part.yaml\n")
    assert load_yaml(tmp_path / "main.yaml") == {"a": {"b": 1}, "c": {"b": 1, "d": 2}, "cuts": ["pt > 5"]}
    with pytest.raises(FileNotFoundError):
        load_yaml(tmp_path / "none.yaml")
    base = ["--config", "c", "--out", "o"]
    assert cli.arguments(base).stages is None and cli.arguments([*base, "--region", "low"]).region == "low"
    assert cli.arguments([*base, "--merge", "--split", "all"]).stages == ["merge"]
    assert cli.arguments([*base, "--no-check", "--no-weighted-merge"]).left_out == ["check", "weighted_merge"]


def test_sources(spark, data, tmp_path):
    jets = spark.read.parquet(f"{data}/jets.parquet")
    assert tables.datasets(jets)["tracks"][:2] == ["valid", "dphi"] and "pt" in tables.datasets(jets)["jets"]
    some = tables.project(jets, {"jets": ["pt", "pt"], "tracks": ["d0"]}, ["jet_id"])
    assert some.columns == ["pt", "jet_id", "tracks"] and some.schema["tracks"].dataType.elementType.names == ["d0"]
    assert tables.full_precision("pt_btagjes") and not tables.full_precision("eta")
    df = spark.createDataFrame([(1, 5), (2, 9), (3, None)], "id int, v int")
    assert [r[0] for r in df.select(tables.remap_ints(F.col("v"), {5: 7})).collect()] == [7, 9, None]
    child = spark.createDataFrame([(1, "b"), (1, "a")], "id int, w string")
    assert {r["id"]: [x["w"] for x in r["k"]] for r in tables.nest(df, child, "id", "k").collect()} == {1: ["a", "b"], 2: [], 3: []}
    df.write.parquet(str(tmp_path / "a"))
    assert tables.read_sample(spark, [str(tmp_path / "a")], {"v": "value"}).columns == ["id", "value"]


def test_names_and_estimates(spark):
    assert match_label("ttbar_pt", {"pt": "momentum", "PT": "x", "ttbar": "tt"}) == "tt" and match_label("x", {"y": "z"}) == "x"
    assert with_suffix("a.b/c.h5", "train") == "a.b/c_train.h5" and with_suffix("a.b/c", "v") == "a.b/c_v"
    df = spark.range(2000)
    assert tables.estimated_rows(df, F.col("id") < 500, 0, "id", 1).first()["rows"] == 500
    assert abs(tables.estimated_rows(df, F.col("id") < 500, 800, "id", 1).first()["rows"] - 500) < 100
    assert tables.estimated_rows(df.limit(0), F.col("id") < 500, 800, "id", 1).first()["rows"] is None
    assert len(cuts_of_all_splits(CONFIG)["all"]) == 18


def test_streaming(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.range(100).select((F.col("id") * 1.5).alias("x"), (F.col("id") % 3).cast("int").alias("label"))
    for part in (df.where("x < 60"), df.where("x >= 60")):
        part.write.mode("append").parquet(source)
        moments.watch(spark, source, df.schema, out, ["x"], ["label"]).awaitTermination()
    want, got = normalisation.moments(df, "jets", ["x"]).first(), moments.moments(spark, out).first()
    assert (got["n"], got["mean"], got["std"]) == (100, pytest.approx(want["mean"]), pytest.approx(want["std"]))
    assert {r["label"]: r["n"] for r in moments.class_weights(spark, out).collect()} == {0: 34, 1: 33, 2: 33}


def test_ints_are_remapped_in_columns_and_nested_tables(spark, config, tmp_path):
    config["transform"] = {"ints_map": {"hadronconeexcltruthlabelid": {4: 5, 5: 4}, "leptonid": {-11: 11, -13: 13}}}
    run = Pipeline(spark, config, str(tmp_path / "out"))
    stored, read = spark.read.parquet(config["samples"][0]["pattern"]), run.sample("all")
    assert read.dtypes == stored.dtypes
    got = {r["jet_id"]: r for r in read.select("jet_id", "hadronconeexcltruthlabelid", "tracks").collect()}
    for r in stored.select("jet_id", "hadronconeexcltruthlabelid", "tracks").collect():
        new = got[r["jet_id"]]
        old = r["hadronconeexcltruthlabelid"]
        assert new["hadronconeexcltruthlabelid"] == {4: 5, 5: 4}.get(old, old)
        assert [t["leptonid"] for t in new["tracks"]] == [{-11: 11, -13: 13}.get(t["leptonid"], t["leptonid"]) for t in r["tracks"]]
        assert [t["d0"] for t in new["tracks"]] == [t["d0"] for t in r["tracks"]]
    config["transform"] = {"ints_map": {"none": {1: 2}}}
    with pytest.raises(ValueError):
        Pipeline(spark, config, str(tmp_path / "out")).sample("all")


def unique_and_written(run):
    got = run.spark.read.parquet(run.path("upsampling", run.prep.split)).collect()
    return {r["component"]: (r["unique_rows"], r["written"]) for r in got}


def test_sampling_fraction(spark, config, tmp_path):
    """Drawn with a fraction f, n rows come from n / f rows."""
    config["resampling"] |= {"method": "pdf", "sampling_fraction": 2.0}
    run = Pipeline(spark, config, str(tmp_path / "out"))
    run.run(["histograms", "resample"])
    got = unique_and_written(run)
    assert all(n <= 20 and w == 40 for c, (n, w) in got.items() if "bjets" not in c) and all(v == (40, 40) for c, v in got.items() if "bjets" in c)
    config["resampling"]["sampling_fraction"] = 0.001
    with pytest.raises(ValueError, match="fewer rows"):
        Pipeline(spark, config, str(tmp_path / "out")).run(["resample"])
    config["resampling"] |= {"method": "countup", "sampling_fraction": "auto"}
    for c in config["components"]:
        c["num_jets"] = 100_000
    for c in config["components"]:
        c["flavours"] = ["bjets", "cjets", "ujets"]
    with pytest.raises(ValueError):
        Pipeline(spark, config, str(tmp_path / "out")).run(["resample"])


def test_region_and_component(spark, config, tmp_path):
    run = Pipeline(spark, config, str(tmp_path / "out"))
    run.run(["histograms"], component="low_all_cjets", region="low")
    assert {r[0] for r in spark.read.parquet(run.path("histograms")).select("component").distinct().collect()} == {"low_all_bjets", "low_all_cjets"}
    run.run(["resample"], region="low", component="low_all_cjets")
    assert set(unique_and_written(run)) == {"low_all_cjets"}
    run.run(["histograms"])
    run.run(["resample"], region="high")
    assert set(unique_and_written(run)) == {"low_all_cjets", *(f"high_all_{f}" for f in ("bjets", "cjets", "ujets"))}
    for region, component in ((None, "low_all_cjets"), ("none", None), ("low", "high_all_cjets")):
        with pytest.raises(ValueError):
            run.run(["resample"], region=region, component=component)
    with pytest.raises(ValueError):
        run.run(["histograms"], component="none")


def test_a_run_goes_on_where_it_ended(spark, config, tmp_path):
    config["resampling"] = {"method": "none"}
    config["resume"] = True
    run = Pipeline(spark, config, str(tmp_path / "out"))
    run.run(["resample", "merge"])
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "out/output/train").glob("file_no=*/*.parquet")}
    before, rows = files(), sorted(map(str, run.merged().collect()))
    assert len(before) == 3 and len(rows) == 240
    gone = next(p for p in before if "file_no=1" in str(p))
    gone.unlink()
    run.merge()
    after = files()
    assert sorted(map(str, run.merged().collect())) == rows and sum(before.get(p) != t for p, t in after.items()) == 1
    facts = json.loads(spark.read.text(run.path("manifest", "train")).first()[0])
    assert [g["rows"] for g in facts["groups"]] == [100, 100, 40]
    other = Pipeline(spark, config | {"num_jets_per_output_file": 120}, str(tmp_path / "out"))
    other.merge()
    assert {r["count"] for r in other.merged().where("file_no < 2").groupBy("file_no").count().collect()} == {120}


def test_equally_many_rows_of_each_pattern(spark, config, tmp_path):
    rows = spark.read.parquet(config["samples"][0]["pattern"])
    rows.where("jet_id % 5 = 0").write.parquet(str(tmp_path / "few"))
    rows.where("jet_id % 5 > 0").write.parquet(str(tmp_path / "many"))
    config["samples"][0]["pattern"] = [str(tmp_path / "few"), str(tmp_path / "many")]
    got = Pipeline(spark, config, str(tmp_path / "out")).sample("all")
    few = rows.where("jet_id % 5 = 0").count()
    assert got.where("jet_id % 5 = 0").count() == few == got.where("jet_id % 5 > 0").count() and got.columns == rows.columns
    config["samples"][0]["equal_jets"] = False
    assert Pipeline(spark, config, str(tmp_path / "out")).sample("all").count() == rows.count()
    Pipeline(spark, config, str(tmp_path / "out")).check()
    with pytest.raises(ValueError):
        Pipeline(spark, config | {"deviation_factor": 2.0}, str(tmp_path / "out")).check()


@pytest.mark.parametrize("together", [False, True])
def test_test_split_by_sample(spark, config, tmp_path, together):
    config["samples"].append(config["samples"][0] | {"name": "more"})
    config["components"].append({"region": "low", "sample": "more", "flavours": ["bjets", "cjets", "ujets"], "num_jets": 40})
    config["resampling"] = {"method": "none"}
    config["global"] = {"merge_test_samples": together}
    for c in config["components"]:
        c["num_jets_test"] = 5
    run = Pipeline(spark, config, str(tmp_path / "out"), "test")
    run.run(["resample", "merge"])
    assert ("sample_name" in run.merged().columns) != together and run.merged().count() == 45


WEIGHTS = [{"group": "jets", "reweight_vars": ["pt", "abs_eta"], "bins": {"pt": [[20000, 250000, 4]], "abs_eta": [[0, 2.5, 2]]}, "class_var": "flavour_label", "class_target": t} for t in ("mean", 0)]
WEIGHTS.append({"group": "tracks", "reweight_vars": ["dphi"], "bins": {"dphi": [[-0.1, 0.1, 2]]}, "class_var": "leptonid", "class_target": "mean"})


def test_weighted_run(spark, config, tmp_path):
    """In every bin that all classes fill, their weights add up to the same."""
    config["reweighting"] = {"reweights": WEIGHTS}
    del config["resampling"]
    for c in config["components"]:
        c["num_jets"] = -1
    run = Pipeline(spark, config, str(tmp_path / "out"))
    for stage in ("reweight", "weighted_merge"):
        with pytest.raises(AssertionError):
            run.run([stage])
    run.run(["split_components"])
    with pytest.raises(AssertionError):
        run.run(["weighted_merge"])
    run.run(["reweight", "weighted_merge", "normalise", "report"])
    mean, first, tracks = (r.name for r in run.prep.reweightings)
    rows = run.merged()
    assert {mean, first, "flavour_label", "component", "pt"} <= set(rows.columns) and tracks in rows.schema["tracks"].dataType.elementType.names
    binned = rows.withColumn("b", F.concat_ws("/", F.floor((F.col("pt") - 20000) / 57500), F.floor(F.col("abs_eta") / 1.25))).where("pt >= 20000 and pt < 250000 and abs_eta < 2.5")
    sums = binned.groupBy("b", "flavour_label").agg(F.sum(mean).alias("m"), F.sum(first).alias("f"), F.count(F.lit(1)).alias("n")).collect()
    for b in {r["b"] for r in sums}:
        own = [r for r in sums if r["b"] == b]
        if len(own) == 3:
            assert len({round(r["m"], 2) for r in own}) == 1 and own[0]["m"] == pytest.approx(sum(r["n"] for r in own) / 3, rel=1e-4)
            assert {round(r["f"], 1) for r in own} == {float(next(r["n"] for r in own if r["flavour_label"] == 0))}
        else:
            assert {r["m"] for r in own} == {0}
    split = json.loads(spark.read.text(run.path("split-components-manifest")).first()[0])
    assert sum(split["num_jets"]["train"].values()) == rows.count() and set(split["num_jets"]) == {"train", "val", "test"}
    assert "campaign" in run.split_rows("test").columns and "campaign" not in run.split_rows("val").columns
    val = Pipeline(spark, config, str(tmp_path / "out"), "val")
    val.run(["reweight", "weighted_merge"])
    assert val.merged().count() == sum(split["num_jets"]["val"].values()) and mean in val.merged().columns


def test_weights_from_few_rows(spark, config, tmp_path):
    """As many rows of each flavour as wanted, or all that there are."""
    config["reweighting"] = {"num_jets_estimate": 60, "reweights": WEIGHTS[:1]}
    run = Pipeline(spark, config, str(tmp_path / "out"))
    run.run(["split_components", "reweight"])
    have = {r["flavour_label"]: r["count"] for r in run.split_rows("train").groupBy("flavour_label").count().collect()}
    used = {r["flavour_label"]: r["n"] for r in spark.read.parquet(run.path("weights", run.prep.reweightings[0].name)).groupBy("flavour_label").agg(F.sum("n").alias("n")).collect()}
    assert all(used[f] <= min(60, n) for f, n in have.items()) and max(used.values()) >= 55
    for bad in ({"num_jets_estimate": 0, "reweights": WEIGHTS}, {"reweights": [WEIGHTS[0] | {"class_target": "median"}]}, {"reweights": [WEIGHTS[0] | {"class_target": None}]}):
        with pytest.raises(ValueError):
            parse(config | {"reweighting": bad})


def test_moments_of_no_use(spark, config, tmp_path):
    config["resampling"] = {"method": "none"}
    config["global_cuts"]["common"] = [["jetfoldhash", "==", 1]]
    config["variables"]["jets"]["labels"] = ["mass"]
    for c in config["components"]:
        c["num_jets"] = -1
    run = Pipeline(spark, config, str(tmp_path / "out"))
    run.run(["resample", "merge"])
    assert run.normalise()["norm"]["jets"]["mass"]["std"] > 0
    run.merged().withColumn("mass", F.lit(1.0)).write.parquet(str(tmp_path / "flat"))
    run.merged = lambda: spark.read.parquet(str(tmp_path / "flat"))
    with pytest.raises(AssertionError):
        run.normalise()


def test_checked_configuration():
    two = copy.deepcopy(CONFIG)
    two["samples"].append({"name": "more", "pattern": "x"})
    two["components"].append({"region": "low", "sample": "more", "flavours": ["bjets"], "num_jets": 40})
    with pytest.raises(AssertionError):
        parse(two)
    for change in ({"sampling_fraction": 0}, {"sampling_fraction": "most"}):
        with pytest.raises(ValueError):
            parse(copy.deepcopy(CONFIG) | {"resampling": CONFIG["resampling"] | change})
    with pytest.raises(ValueError):
        parse(copy.deepcopy(CONFIG) | {"global": {"num_jets_estimate_hist": -5}})
    assert parse(CONFIG).resampling.pieces == ((4, 2), (2,))
