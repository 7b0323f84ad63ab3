"""Preparation operators: golden values, numpy, errors, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.functions.binning import bin_index, edges, subdivide, with_overflow
from tallyforge.functions.cuts import Cut, Cuts
from tallyforge.functions.precision import half
from tallyforge.functions.randomness import hash_uniform, md5_uniform
from tallyforge.operators import histograms, interpolation, merging, normalisation, quality, ranking, reporting, resampling, reweighting, splitting


# --- cuts ----------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    ("cut", "want"),
    [
        ("x == 3", [3]), ("x != 3", [-7, -1, 0, 10]), ("x <= 0", [-7, -1, 0]), ("x >= 3", [3, 10]), ("x > 3", [10]), ("x < -1", [-7]),
        (("x", "in", [3, 10]), [3, 10]), (("x", "notin", [3, 10]), [-7, -1, 0]), ("x in [0, -1]", [-1, 0]), ("x %10== 3", [-7, 3]), ("x %4!= 3", [-7, 0, 10]), ("x %10<= 0", [0, 10]), (("x", "%10 >=", 9), [-1]),
    ],
)
def test_cut(spark, cut, want):
    df = spark.createDataFrame([(v,) for v in (-7, -1, 0, 3, 10, None)], "x int")
    assert sorted(r["x"] for r in df.where(Cuts.of([cut]).column()).collect()) == sorted(want)


@pytest.mark.parametrize("cut", ["x > 5", "x >= 5", "x < 5", "x <= 5", "x == 5", "x %4> 1", "x %4>= 1", "x %4< 3", ("x", "in", [5.0])])
def test_nan_is_in_no_range(spark, cut):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (6.0,), (5.0,), (2.0,), (None,)], "x double")
    got = [r["x"] for r in df.where(Cuts.of([cut]).column()).collect()]
    assert got and not any(np.isnan(got))
    nested = df.select(F.array(F.struct("x")).alias("t")).select(F.filter("t", lambda e: Cuts.of([cut]).element(e)).alias("k"))
    assert not any(np.isnan(e["x"]) for r in nested.collect() for e in r["k"])


def test_nan_is_unequal(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,)], "x double")
    for cut in ("x != 5", ("x", "notin", [5.0]), "x %4!= 1"):
        assert df.where(Cuts.of([cut]).column()).count() == 1
    assert spark.createDataFrame([("b",)], "x string").where(Cuts.of([("x", ">", "a")]).column()).count() == 1


def test_half_precision_is_numpys(spark):
    rng = np.random.default_rng(5)
    xs = [*rng.normal(0, 3, 2000), *(2.0 ** rng.uniform(-27, 17, 2000)), *[s * 2.0**k for k in range(-26, 17) for s in (1, -1)], 0.0, 65519.9, 65520.0, -70000.0, 1 + 2.0**-11, 1 + 3 * 2.0**-11, np.inf, -np.inf]
    got = [r["y"] for r in spark.createDataFrame([(float(x),) for x in xs], "x double").coalesce(1).select(half("x").alias("y")).collect()]
    with np.errstate(over="ignore"):
        assert got == np.array(xs).astype(np.float16).astype(float).tolist()
    rest = spark.createDataFrame([(None,), (float("nan"),)], "x double").coalesce(1).select(half("x").alias("y")).collect()
    assert rest[0]["y"] is None and np.isnan(rest[1]["y"])


def test_cut_algebra(spark):
    a, b = Cuts.of(["pt > 20", "eta < 2.5"]), Cuts.of([("eventNumber", "%10<=", 7)])
    assert sum([a, b, Cuts()]).variables == ["pt", "eta", "eventNumber"]
    assert (a + b).ignore(["eventNumber"]) == a and len(Cuts.of(None)) == 0
    assert Cuts.of(["pt > 5", "pt >= 7", "pt < 90", "pt <= 80"]).bounds("pt") == (7, 80) and a.bounds("none") == (None, None)
    assert spark.range(3).where(Cuts().column()).count() == 3
    for bad in ("pt ~ 3", "pt", ("x", "in", 3), ("x", "%0==", 1), ("x", "like", "a")):
        with pytest.raises(ValueError):
            Cut.of(bad)


# --- bins and histograms -------------------------------------------------------------------------------------------
def test_edges():
    assert edges([[0, 10, 2], [10, 30, 2]]) == [0, 5, 10, 20, 30]
    assert with_overflow([0, 1]) == [-np.inf, 0, 1, np.inf] and with_overflow([-np.inf, 0, np.inf]) == [-np.inf, 0, np.inf]
    assert subdivide([0, 1, 2, 3, 4], 2) == [0, 0.5, 1, 1.5, 2, 2.5, 3, 3.5, 4]
    for bad in ([[5, 5, 1]], [[0, 1, 0]], [[0, 5, 2], [3, 9, 2]]):
        with pytest.raises(ValueError):
            edges(bad)


@pytest.mark.parametrize("bins", [[0.0, 1.0], edges([[0, 10, 7], [10, 50, 4]]), [-np.inf, 0.0, 3.5, np.inf]])
def test_bins_are_numpys(spark, bins):
    xs = [*np.random.default_rng(3).uniform(-5, 60, 500).tolist(), *[b for b in bins if np.isfinite(b)], np.inf, -np.inf]
    got = spark.createDataFrame([(x,) for x in [*xs, float("nan"), None]], "x double").select("x", bin_index("x", bins).alias("b"))
    counts = {r["b"]: r["count"] for r in got.groupBy("b").count().collect()}
    inside = [x for x in xs if bins[0] <= x <= bins[-1]]
    want = np.histogram([np.clip(x, -1e9, 1e9) for x in inside], [np.clip(b, -1e9, 1e9) for b in bins])[0]
    assert [counts.get(i, 0) for i in range(len(bins) - 1)] == want.tolist()
    assert counts[None] == len(xs) + 2 - len(inside)


def classes(spark):
    rows = [(0, 1.0)] * 6 + [(0, 3.0)] * 2 + [(1, 1.0)] * 2 + [(1, 3.0)] * 6 + [(2, 1.0), (2, 9.0), (2, None)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, c int, x double"), {"x": [0.0, 2.0, 4.0, 10.0]}


def test_ratio(spark):
    df, bins = classes(spark)
    got = {(r["c"], r["b0"]): (r["n"], r["p"], r["ratio"]) for r in histograms.ratio_to_target(histograms.histogram(df, ["c"], bins), "c", 0, bins).collect()}
    assert got[1, 0] == (2, 0.25, 3.0) and got[1, 1] == (6, 0.75, 0.25 / 0.75) and got[2, 2] == (1, 0.5, 0.0) and got[0, 0][2] == 1
    p = histograms.probabilities(histograms.histogram(df, ["c"], bins), ["c"])
    assert histograms.check_probabilities(p, ["c"]).count() == 0
    with pytest.raises(ValueError):
        histograms.check_probabilities(p.withColumn("p", F.col("p") / 2), ["c"])
    assert histograms.histogram(df.limit(0), ["c"], bins).count() == 0


# --- resampling ----------------------------------------------------------------------------------------------------
def test_countup_follows_the_target(spark):
    df, bins = classes(spark)
    target = resampling.target_probabilities(df, F.col("c") == 0, bins)
    quotas = resampling.bin_quotas(target, F.lit(40), bins, "s")
    want = {r["b0"]: r["quota"] for r in quotas.collect()}
    assert want[0] in (30, 31) and want[1] in (10, 11)
    drawn = resampling.countup(df.where("c = 1"), quotas, bins, "id", "s")
    assert {r["b0"]: r["n"] for r in drawn.groupBy("b0").agg(F.sum("copies").alias("n")).collect()} == want
    stats = resampling.upsampling(drawn, []).first()
    assert stats["unique_rows"] == 8 and stats["written"] == sum(want.values())


def test_countup_fills_up_from_what_it_has(spark):
    df, bins = classes(spark)
    target = resampling.target_probabilities(df, F.col("c") == 0, bins)
    drawn = resampling.countup(df.where("c = 2"), resampling.bin_quotas(target, F.lit(40), bins, "s"), bins, "id", "s")
    assert drawn.agg(F.sum("copies")).first()[0] == 40 and drawn.count() == 1


def test_importance_sample(spark):
    df, bins = classes(spark)
    ratios = histograms.ratio_to_target(histograms.histogram(df, ["c"], bins), "c", 0, bins).where("c = 1")
    drawn = resampling.importance_sample(df.where("c = 1"), ratios, bins, "id", 101, "s")
    got = {r["b0"]: r["n"] for r in drawn.groupBy("b0").agg(F.sum("copies").alias("n")).collect()}
    assert sum(got.values()) == 101 and abs(got[0] - 75.75) < 1 and drawn.count() <= 8


def test_groups_are_drawn_in_one_plan(spark):
    """Each group as if it were alone: quotas, draws, rows to repeat."""
    df, bins = classes(spark)
    rows = df.where("c > 0").withColumn("g", F.concat(F.lit("g"), "c"))
    target = resampling.target_probabilities(df, F.col("c") == 0, bins)
    draws = spark.createDataFrame([("g1", 40), ("g2", 25)], "g string, d int")
    quotas = resampling.bin_quotas(target.crossJoin(draws), F.col("d"), bins, "s", ["g"])
    out = resampling.countup(rows, quotas, bins, "id", "s", ["g"]).groupBy("g").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    want = {r["g"]: r["n"] for r in quotas.groupBy("g").agg(F.greatest(F.sum("quota"), F.first("draws")).alias("n")).collect()}
    assert {r["g"]: (r["n"], r["rows"]) for r in out} == {"g1": (want["g1"], 8), "g2": (25, 1)}
    ratios = target.crossJoin(draws).withColumn("ratio", F.col("p"))
    got = resampling.importance_sample(rows, ratios, bins, "id", F.col("d"), "s", ["g"]).groupBy("g").agg(F.sum("copies").alias("n")).collect()
    assert {r["g"]: r["n"] for r in got} == {"g1": 40, "g2": 25}


def test_repeats_of_many_bins(spark):
    """Places that are drawn again find their bins, of very uneven quotas."""
    rng = np.random.default_rng(2)
    xs = [float(b) + 0.5 for b in range(40) for _ in range(int(rng.integers(1, 30)))]
    df = spark.createDataFrame(list(enumerate(xs)), "id int, x double")
    bins = {"x": [float(i) for i in range(41)]}
    p = rng.dirichlet(np.full(40, 0.3))
    target = spark.createDataFrame([(i, float(v)) for i, v in enumerate(p)], "b0 int, p double").where("b0 % 3 > 0")
    drawn = resampling.countup(df, resampling.bin_quotas(target, F.lit(3000), bins, "s"), bins, "id", "s")
    assert drawn.agg(F.sum("copies")).first()[0] == 3000 and drawn.where("b0 % 3 = 0").count() == 0


def test_order_in_small_buckets(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    places = [{r["id"]: r["rank"] for r in ranking.random_order(df, ["g"], "id", "s", bucket_rows=n).collect()} for n in (10, 100_000)]
    assert places[0] == places[1] and sorted(v for k, v in places[0].items() if k % 3 == 0) == list(range(1, 168))
    assert ranking.random_order(df.limit(0), ["g"], "id", "s").count() == 0


def test_numbered(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RUN", 7)
    df = spark.createDataFrame([("a", 3, 30), ("b", 5, 5), ("c", 5, 4), ("d", 1, None)], "k string, a int, b int")
    got = ranking.numbered(df, F.col("a"), F.col("b")).collect()
    assert sorted((r["k"], r["i"]) for r in got) == [*[("a", i) for i in range(3, 31)], ("b", 5)]


def test_cap_and_supply(spark):
    df, _ = classes(spark)
    assert {r["c"]: r["count"] for r in resampling.cap(df, "c", {0: 3, 1: -1}, "id", "s").groupBy("c").count().collect()} == {0: 3, 1: 8}
    resampling.check_supply(df, "c", {0: 8, 1: -1})
    for caps, fraction in (({0: 9}, 1.0), ({0: 8}, 0.9), ({7: 1}, 1.0)):
        with pytest.raises(ValueError):
            resampling.check_supply(df, "c", caps, fraction)


def test_resampling_rules():
    assert resampling.check_fraction(0.5, "countup") is None and "above 1" in resampling.check_fraction(1.5, "pdf")
    for call in (lambda: resampling.check_fraction(1.5, "countup"), lambda: resampling.validate("countup", 2), lambda: resampling.validate("other", None)):
        with pytest.raises(ValueError):
            call()
    resampling.validate("pdf", 2)


def test_randomness_is_spread_and_stable(spark):
    df = spark.range(4000).select("id", md5_uniform(1, "id").alias("a"), hash_uniform(1, "id").alias("b"))
    low, high, mean_a, mean_b = df.agg(F.min("b"), F.max("b"), F.avg("a"), F.avg("b")).first()
    assert 0 <= low and high < 1 and abs(mean_a - 0.5) < 0.02 and abs(mean_b - 0.5) < 0.02
    assert df.repartition(9).orderBy("id").collect() == df.orderBy("id").collect()


# --- reweighting ---------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(("target", "want"), [(0, [6, 2, 0]), ("mean", [3, 8 / 3, 1 / 3]), ("min", [1, 0, 0]), ("max", [6, 6, 1]), ("uniform", [1, 1, 1]), ([0, 9], [3, 1, 0])])
def test_targets(spark, target, want):
    df, bins = classes(spark)
    hist = histograms.histogram(df, ["c"], bins)
    got = {r["b0"]: r["target"] for r in reweighting.target_histogram(hist, "c", target, bins).collect()}
    assert [got[i] for i in range(3)] == pytest.approx(want)
    twice = reweighting.target_histogram(hist, "c", target, bins, func=lambda t: t * 2)
    assert {r["b0"]: r["target"] for r in twice.collect()}[0] == pytest.approx(2 * want[0])


def test_weights_meet_the_target(spark):
    df, bins = classes(spark)
    two = df.where("c < 2")
    hist = histograms.histogram(two, ["c"], bins)
    weights = reweighting.class_weights(hist, reweighting.target_histogram(hist, "c", "mean", bins), "c", bins)
    out = reweighting.apply_weights(two, weights, "c", bins, "w")
    got = {(r["c"], r["x"]): r["s"] for r in out.groupBy("c", "x").agg(F.sum("w").alias("s")).collect()}
    assert got == {(c, x): pytest.approx(4) for c in (0, 1) for x in (1.0, 3.0)}
    three = histograms.histogram(df, ["c"], bins)
    zero = reweighting.class_weights(three, reweighting.target_histogram(three, "c", "max", bins), "c", bins)
    assert {r["b0"] for r in zero.where("weight = 0").collect()} == {1, 2}
    with pytest.raises(ValueError):
        reweighting.target_histogram(hist, "c", "median", bins)
    with pytest.raises(ValueError):
        reweighting.check_target(reweighting.target_histogram(hist, "c", "mean", bins, func=lambda t: -t))


def test_nested_weights(spark):
    df = spark.createDataFrame([(1, [(True, 0.5, 0), (True, 1.5, 1), (False, 0.5, 0)]), (2, [(True, 0.5, 1), (True, 9.0, 0)]), (3, [])], "id int, t array<struct<valid:boolean,x:double,k:int>>")
    bins = {"x": [0.0, 1.0, 2.0]}
    hist = reweighting.nested_histogram(df, "t", "k", bins)
    assert sorted(map(tuple, hist.collect())) == [(0, 0, 1), (1, 0, 1), (1, 1, 1)]
    weights = reweighting.class_weights(hist, reweighting.target_histogram(hist, "k", "max", bins), "k", bins)
    out = reweighting.nested_weights(df, "t", reweighting.weight_lists(weights, "k", bins), "k", bins, "w")
    assert {r["id"]: list(r["w"]) for r in out.collect()} == {1: [1.0, 0.0, 0.0], 2: [1.0, 0.0], 3: []}


def test_weight_names():
    assert reweighting.weight_name("jets", ["pt", "eta"], "flavour", "mean") == "weight_jets_pt_eta_target_mean_flavour"
    assert reweighting.weight_name("jets", ["pt"], "flavour", [0, 1], "sqrt") == "weight_jets_pt_target_sqrt_0_1"
    assert reweighting.weight_name("jets", ["pt"], "flavour", None) == "weight_jets_pt_target_none" and reweighting.weight_name("jets", ["pt"], "flavour", 0) == "weight_jets_pt_target_0_flavour"


# --- merging and splitting -----------------------------------------------------------------------------------------
def test_file_index(spark):
    got = merging.file_index(spark.range(12), "id", 5, "s").groupBy("file_no").count().orderBy("file_no").collect()
    assert [tuple(r) for r in got] == [(0, 5), (1, 5), (2, 2)]
    by = merging.file_index(spark.range(20).withColumn("s", F.col("id") % 2), "id", 8, "s", by=["s"]).groupBy("s", "file_no").count()
    assert sorted(map(tuple, by.collect())) == [(0, 0, 8), (0, 1, 2), (1, 0, 8), (1, 1, 2)]


def test_labels_and_union(spark):
    df = spark.createDataFrame([(1, 5), (2, 4), (3, 9)], "id int, truth int")
    label = merging.label_by_cuts([("b", Cuts.of(["truth == 5"])), ("c", Cuts.of(["truth == 4"]))])
    assert {r["id"]: r["l"] for r in df.select("id", label.alias("l")).collect()} == {1: 0, 2: 1, 3: None}
    assert merging.with_label(df, 3).first()["flavour_label"] == 3
    assert merging.with_label(merging.with_label(df, 3), 4).first()["flavour_label"] == 3
    assert merging.with_label(merging.with_label(df, 3), 4, overwrite=True).first()["flavour_label"] == 4
    assert merging.union_components({"a": df, "b": df}).groupBy("component").count().count() == 2


def test_equal_rows(spark):
    df = spark.range(100).withColumn("s", F.when(F.col("id") < 10, "a").otherwise("b"))
    assert {r["s"]: r["count"] for r in merging.equal_rows(df, "s", "id", 1).groupBy("s").count().collect()} == {"a": 10, "b": 10}


def test_resume(spark, tmp_path):
    df = merging.file_index(spark.range(30), "id", 10, "s")
    path = str(tmp_path / "out")
    assert merging.missing_files(spark, df, path).count() == 30
    merging.write_files(df.where("file_no < 2"), path)
    left = merging.missing_files(spark, df, path)
    assert left.count() == 10
    merging.write_files(left, path)
    assert spark.read.parquet(path).count() == 30 and merging.missing_files(spark, df, path).count() == 0
    assert '"rows": 10' in merging.manifest(df, ["file_no"], seed="s")


def test_routes(spark):
    parts = {"low": Cuts.of(["id < 6"]), "even": Cuts.of(["id %2== 0"])}
    routed = splitting.route(spark.range(10), parts)
    assert {r["component"]: (r["rows"], r["unique_rows"]) for r in splitting.rollup(routed, "id").collect()} == {"low": (6, 6), "even": (5, 5), "total": (11, 8)}
    assert {r["component"]: r["percent"] for r in splitting.summary(routed).collect()} == {"low": pytest.approx(600 / 11), "even": pytest.approx(500 / 11)}
    same = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 1)], "r string, f int")
    splitting.check_shares(splitting.shares(same, "r", "f"), "r", "f")
    with pytest.raises(ValueError):
        splitting.check_shares(splitting.shares(same.union(spark.createDataFrame([("b", 1)], "r string, f int")), "r", "f"), "r", "f")


def test_select_elements(spark):
    df = spark.createDataFrame([([(True, 1.0), (False, 1.0), (True, 5.0)],)], "t array<struct<valid:boolean,d0:double>>")
    assert df.select(merging.select_elements("t", Cuts.of(["d0 < 3.5"])).alias("k")).first()["k"] == [(True, 1.0)]


# --- normalisation -------------------------------------------------------------------------------------------------
def test_pooled_moments(spark):
    parts = spark.createDataFrame([("g", "v", 100, 3.0, 1.0), ("g", "v", 200, 6.0, 5.0), ("g", "v", 0, 0.0, 0.0)], '`group` string, variable string, n int, mean double, std double')
    got = normalisation.pooled(parts).first()
    assert got["mean"] == 5 and got["std"] == pytest.approx(4.358898943540674)
    far = parts.withColumn("mean", F.col("mean") + 1e9)
    assert normalisation.pooled(far).first()["std"] == pytest.approx(4.358898943540674)


def test_moments_skip_what_is_no_number(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (float("inf"),), (None,)], "x double")
    got = normalisation.moments(df, "jets", ["x"]).first()
    assert (got["n"], got["mean"], got["std"], got["n_infinite"]) == (2, 2.0, 1.0, 1)
    assert normalisation.as_dict(normalisation.moments(df, "jets", ["x"])) == {"jets": {"x": {"mean": 2.0, "std": 1.0}}}
    normalisation.check_moments(normalisation.moments(df, "jets", ["x"]))
    for bad in (df.limit(1), df.where("x is null")):
        with pytest.raises(AssertionError):
            normalisation.check_moments(normalisation.moments(bad, "jets", ["x"]))


def test_class_counts_and_weights(spark):
    count = lambda d: spark.createDataFrame([("v", k, n) for k, n in d.items()], "variable string, label bigint, n bigint")
    merged = normalisation.merge_counts(count({0: 10, 1: 20}), count({0: 5, 1: 15, 2: 25}))
    assert {r["label"]: r["n"] for r in merged.collect()} == {0: 15, 1: 35, 2: 25}
    assert {r["label"]: r["weight"] for r in normalisation.class_weights(merged).collect()} == {0: 2.33, 1: 1.0, 2: 1.4}
    df = spark.createDataFrame([(1, 1, 1, 0.5), (None, 2, 1, 0.5)], "label int, eventNumber int, ftagTruthParentBarcode int, x double")
    assert normalisation.label_columns(df) == ["label"]
    assert [tuple(r) for r in normalisation.class_counts(df, ["label"]).collect()] == [("label", 1, 1)]


# --- checks, reports, grids ----------------------------------------------------------------------------------------
def test_names(spark):
    names = ["mc.user.601589.e8514_r13144.h5", "x.410470.y", "a_r99", "plain"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(quality.entry_name(F.col("n"))).collect()] == ["601589 / MC20d", "410470 / x.410470.y", "a_r99 / r99", "plain"]
    assert spark.createDataFrame([("user.sample.no_dsid_r13167.h5",)], "n string").select(quality.entry_name(F.col("n"))).first()[0] == "user.sample.no_dsid_r13167.h5 / MC20a"


def test_sizes(spark):
    sizes = spark.createDataFrame([("g", 100), ("g", 400)], "g string, n int")
    spread = quality.size_spread(sizes, "g")
    got = spread.first()
    assert (got["geometric_mean"], got["spread"], got["deviation"]) == (pytest.approx(200), 4, pytest.approx(2))
    quality.check_sizes(spread, 4)
    for bad, factor in ((spread, 3.9), (quality.size_spread(sizes.union(spark.createDataFrame([("g", 0)], "g string, n int")), "g"), 10)):
        with pytest.raises(ValueError):
            quality.check_sizes(bad, factor)


def test_reports(spark):
    assert reporting.stitching_windows([(250_000, 6_000_000), (20_000, 250_000)]) == [(150_000, 350_000)]
    assert reporting.stitching_windows([(0, 5_000), (5_000, 9_000)]) == [(4_900, 5_100)]
    assert reporting.full_range([(250_000, 6_000_000), (20_000, 250_000)]) == (20_000, 6_000_000)
    ns = [0, 999, 1_000, 1_500, 100_000, 123_456, 10_000_000, 168_968_784, 1_234_567]
    df = spark.createDataFrame([(n,) for n in ns], "n int").coalesce(1)
    assert [r[0] for r in df.select(reporting.compact_count(F.col("n"))).collect()] == ["0", "999", "1k", "1.5k", "100k", "123.456k", "10M", "168.969M", "1.23457M"]
    parts = spark.createDataFrame([("pt", "(low)", ""), ("pT-x", None, "a  b")], "a string, b string, c string").coalesce(1)
    assert [r[0] for r in parts.select(reporting.name_suffix(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["_pt_low", "_pT_x_a_b"]
    assert reporting.display_range("pt_btagJes", [20_000, 250_000]) == (20, 250) and reporting.display_range("abs_eta", [-np.inf, 0, 2.5, np.inf]) == (0, 2.5)
    with pytest.raises(ValueError):
        reporting.display_range("x", [-np.inf, np.inf])
    xs = spark.createDataFrame([(0, x) for x in (-5.0, 0.0, 0.4, 9.99, 50.0, float("nan"), None)], "c int, x double")
    assert sorted((r["bin"], r["n"]) for r in reporting.plot_histogram(xs, ["c"], "x", 0, 10, 10).collect()) == [(0, 3), (9, 2)]


def test_upscale():
    assert interpolation.upscale(np.array([[1, 2], [3, 4]]), 2, 1).tolist() == [[1, 1.25, 1.75, 2], [1.5, 1.75, 2.25, 2.5], [2.5, 2.75, 3.25, 3.5], [3, 3.25, 3.75, 4]]
    flat = np.full((4, 5), 2.0)
    assert np.allclose(interpolation.upscale(flat, 3, 3), 2) and interpolation.upscale(flat, 3).shape == (12, 15)
    smooth = np.sin(np.linspace(0, 3, 40))
    fine = interpolation.upscale(smooth, 4, 3)
    assert np.allclose(fine[30:130], np.interp(np.linspace(0, 39, 160), np.arange(40), smooth)[30:130], atol=0.02)
    assert interpolation.upscale(np.array([0, 0, 5.0, 0, 0]), 4).min() == 0
    blocks = interpolation.upscale_regions(np.arange(9.0).reshape(3, 3), [[2, 1], [2, 1]], 2, 1)
    assert blocks.shape == (6, 6) and (blocks[4:, 4:] == 8).all()
    with pytest.raises(ValueError):
        interpolation.upscale(flat, 2, 2)
    with pytest.raises(ValueError):
        interpolation.upscale_regions(flat, [[4], [4]], 2)
