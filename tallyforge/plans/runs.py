"""Queries over what whole preparation runs write, from the table of jets (each jet_id once), and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.binning import edges, with_overflow
from tallyforge.functions.precision import half_sql
from tallyforge.functions.randomness import md5_uniform_sql
from tallyforge.operators.reweighting import weight_name
from tallyforge.plans.pipeline import Pipeline
from tallyforge.plans.preparation import J, _bin
from tallyforge.session import read_table, shared_folder
from tallyforge.streaming import moments

PT, ETA, PHI = [[20_000, 100_000, 8], [100_000, 1_000_000, 6]], [[0, 2.5, 5]], [[-0.2, 0.2, 8]]
CAPS = {"bjets": 300, "cjets": 200, "ujets": -1}
WEIGHT = weight_name("jets", ["pt", "abs_eta"], "flavour_label", "mean")
TRACK_WEIGHT = weight_name("tracks", ["dphi"], "leptonid", "max")
PER_FILE = 1_000
#: Rows of each flavour in the resampled run.
DRAWN = 50


def _config(pattern: str, **more: object) -> dict:
    names = {"bjets": [["hadronconeexcltruthlabelid", "==", 5]], "cjets": [["hadronconeexcltruthlabelid", "==", 4]], "ujets": [["hadronconeexcltruthlabelid", "in", [0, 1, 2, 3]]]}
    return {
        "flavours": [{"name": f, "cuts": cuts} for f, cuts in names.items()],
        "samples": [{"name": "all", "pattern": pattern}],
        "regions": [{"name": "wide", "cuts": ["pt > 20000", "pt < 6000000"]}],
        "global_cuts": {"train": [["eventnumber", "%10<=", 7]], "val": [["eventnumber", "%10==", 8]], "test": [["eventnumber", "%10==", 9]]},
        "components": [{"region": "wide", "sample": "all", "flavours": list(names), "num_jets": -1}],
        "variables": {"jets": {"inputs": ["jet_id", "pt", "abs_eta"], "labels": []}, "tracks": {"inputs": ["dphi", "d0"], "labels": ["leptonid"]}},
        "num_jets_per_output_file": PER_FILE,
    } | more


def _run(spark: SparkSession, sf: str, stages: list[str] | None, **more: object) -> Pipeline:
    """A run in a folder of its own, over the jets stored once each."""
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    read_table(spark, sf, "jets").dropDuplicates(["jet_id"]).write.parquet(f"{folder}/in")
    pipeline = Pipeline(spark, _config(f"{folder}/in", **more), f"{folder}/out")
    pipeline.run(stages)
    return pipeline


def _weighting(spark: SparkSession, sf: str, *stages: str) -> Pipeline:
    block = {"reweights": [
        {"group": "jets", "reweight_vars": ["pt", "abs_eta"], "bins": {"pt": PT, "abs_eta": ETA}, "class_var": "flavour_label", "class_target": "mean"},
        {"group": "tracks", "reweight_vars": ["dphi"], "bins": {"dphi": PHI}, "class_var": "leptonid", "class_target": "max"},
    ]}
    return _run(spark, sf, list(stages), reweighting=block)


def run_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of a weighted run as written, with their weight and the sum of their tracks' weights."""
    rows = _weighting(spark, sf, "split_components", "reweight", "weighted_merge").merged()
    total = F.aggregate("tracks", F.lit(0.0), lambda a, t: a + t[TRACK_WEIGHT].cast("double"))
    return rows.select("jet_id", "flavour_label", "abs_eta", F.round(F.col(WEIGHT).cast("double"), 5).alias("weight"), F.round(total, 3).alias("track_weight"))


def run_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per split and flavour, as the manifest of the split stage has them."""
    pipeline = _weighting(spark, sf, "split_components")
    found = spark.read.text(pipeline.path("split-components-manifest")).select(F.from_json("value", "num_jets map<string, map<string, bigint>>").alias("m"))
    return found.select(F.explode("m.num_jets").alias("split", "of")).select("split", F.explode("of").alias("flavour", "n"))


def run_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Moments as a weighted run writes them."""
    pipeline = _weighting(spark, sf, "split_components", "reweight", "weighted_merge", "normalise")
    kind = "norm map<string, map<string, struct<mean double, std double>>>"
    rows = spark.read.text(pipeline.path("statistics")).select(F.explode(F.from_json("value", kind)["norm"]).alias("group", "of")).select("group", F.explode("of").alias("variable", "m"))
    return rows.select("group", "variable", F.round("m.mean", 4).alias("mean"), F.round("m.std", 4).alias("std"))


def run_weights(spark: SparkSession, sf: str) -> DataFrame:
    """The weight of every flavour and bin as a weighted run stores it."""
    pipeline = _weighting(spark, sf, "split_components", "reweight")
    stored = next(pipeline.weights(r) for r in pipeline.prep.reweightings if r.group == "jets")
    return stored.select("flavour_label", "b0", "b1", F.round("weight", 9).alias("weight"))


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    """The distribution of pt in every component, as a weighted run reports it of what it wrote."""
    pipeline = _weighting(spark, sf, "split_components", "reweight", "weighted_merge", "report")
    return spark.read.parquet(pipeline.path("report", "train", "pt")).withColumn("share", F.round("share", 9))


def _capped(spark: SparkSession, sf: str, *stages: str) -> Pipeline:
    components = [{"region": "wide", "sample": "all", "flavours": [f], "num_jets": n} for f, n in CAPS.items()]
    return _run(spark, sf, list(stages), components=components)


def run_components(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of every component as a run without resampling stores them before they are merged."""
    rows = spark.read.parquet(_capped(spark, sf, "resample").path("components", "train"))
    return rows.select("jet_id", "component", "copies")


def run_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every output file, as the manifest of a run tells them."""
    facts = spark.read.text(_capped(spark, sf, "resample", "merge").path("manifest", "train"))
    return facts.select(F.inline(F.from_json("value", "groups array<struct<file_no int, rows bigint>>")["groups"]))


def run_capped(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of a run without resampling as written: at most so many of each flavour, in shuffled files."""
    rows = _capped(spark, sf, "check", "resample", "merge").merged()
    return rows.select("jet_id", "component", "flavour_label", F.col("file_no").cast("int").alias("file_no"))


def run_resampled(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per flavour of a run that draws every flavour to the distribution of bjets: a whole run, checked by its totals."""
    pieces = {"pt": {"bins": [[20_000, 250_000, 5], [250_000, 6_000_000, 5]]}, "abs_eta": {"bins": [[0, 2.5, 5]]}}
    components = [{"region": "wide", "sample": "all", "flavours": list(CAPS), "num_jets": DRAWN}]
    pipeline = _run(spark, sf, None, components=components, resampling={"method": "pdf", "target": "bjets", "sampling_fraction": "auto", "variables": pieces})
    return pipeline.merged().groupBy("component", "flavour_label").agg(F.count(F.lit(1)).alias("n"))


def run_streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Moments of the jets as a stream of files gives them, a part per micro-batch."""
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    rows = read_table(spark, sf, "jets").select("jet_id", "pt", "mass").dropDuplicates(["jet_id"])
    rows.write.parquet(f"{folder}/in")
    moments.watch(spark, f"{folder}/in", rows.schema, f"{folder}/out", ["pt", "mass"]).awaitTermination()
    return moments.moments(spark, f"{folder}/out").select("variable", "n", F.round("mean", 3).alias("mean"), F.round("std", 3).alias("std"))


QUERIES = {f.__name__: f for f in (run_streamed, run_weighted, run_weights, run_split_counts, run_statistics, run_report, run_components, run_manifest, run_capped, run_resampled)}

_FLAVOUR = "case when hadronconeexcltruthlabelid = 5 then 0 when hadronconeexcltruthlabelid = 4 then 1 when hadronconeexcltruthlabelid in (0, 1, 2, 3) then 2 end"
_ROWS = f"{J}, f as (select *, {_FLAVOUR} as flavour from j)"
_TRAIN = f"{_ROWS}, r as (select jet_id, flavour as flavour_label, pt, {half_sql('abs_eta')} as abs_eta, tracks, eventnumber from f where flavour is not null and pt > 20000 and pt < 6000000 and eventnumber % 10 <= 7)"
_PT, _ETA, _PHI = with_overflow(edges(PT)), with_overflow(edges(ETA)), with_overflow(edges(PHI))

_WEIGHTS = f"""{_TRAIN}, b as (select *, {_bin('pt', _PT)} as b0, {_bin('abs_eta', _ETA)} as b1 from r),
h as (select flavour_label, b0, b1, count(*) as n from b where b0 is not null and b1 is not null group by all),
d as (select c.flavour_label, g.b0, g.b1, coalesce(n, 0) as n from (select distinct flavour_label from h) c cross join (select distinct b0, b1 from h) g left join h using (flavour_label, b0, b1)),
w as (select flavour_label, b0, b1, case when min(n) over (partition by b0, b1) = 0 then 0.0 else avg(n) over (partition by b0, b1) / n end as weight from d)"""
_CAPPED = f"""{_TRAIN}, c as (select jet_id, flavour_label, 'wide_all_' || ['bjets', 'cjets', 'ujets'][flavour_label + 1] as component from r),
k as (select *, row_number() over (partition by component order by {md5_uniform_sql(42, 'jet_id')}, jet_id) as rank from c),
g as (select * from k where rank <= [{', '.join(str(n if n >= 0 else 2**62) for n in CAPS.values())}][flavour_label + 1])"""
_FILED = f"""{_CAPPED}, filed as (select jet_id, component, flavour_label, cast((row_number() over (order by {md5_uniform_sql(42, "concat_ws('/', jet_id, component, 1)")}, concat_ws('/', jet_id, component, 1)) - 1) // {PER_FILE} as int) as file_no from g)"""

SQL = {
    "run_streamed": f"""
with {J}, x as (select 'pt' as variable, cast(pt as double) as x from j union all select 'mass', cast(mass as double) from j)
select variable, count(*) as n, round(avg(x), 3) as mean, round(stddev_pop(x), 3) as std from x where x is not null and isfinite(x) group by all""",
    "run_weighted": f"""
with {_WEIGHTS},
t as (select jet_id, t.valid as valid, t.leptonid as leptonid, {_bin('t.dphi', _PHI)} as k from (select jet_id, unnest(tracks) as t from r)),
th as (select leptonid, k, count(*) as n from t where valid and leptonid is not null and k is not null group by all),
td as (select c.leptonid, g.k, coalesce(n, 0) as n from (select distinct leptonid from th) c cross join (select distinct k from th) g left join th using (leptonid, k)),
tw as (select leptonid, k, case when min(n) over (partition by k) = 0 then 0.0 else cast(max(n) over (partition by k) as double) / n end as weight from td),
s as (select jet_id, sum(case when valid then coalesce(cast(cast(weight as float) as double), 0) else 0 end) as total from t left join tw using (leptonid, k) group by jet_id)
select jet_id, flavour_label, abs_eta, round(cast(cast(coalesce(weight, 0) as float) as double), 5) as weight, round(coalesce(total, 0), 3) as track_weight
from b left join w using (flavour_label, b0, b1) left join s using (jet_id)""",
    "run_split_counts": f"""
with {_ROWS}, s as (select case when eventnumber % 10 <= 7 then 'train' when eventnumber % 10 = 8 then 'val' else 'test' end as split, flavour, pt from f where flavour is not null),
c as (select split, flavour, count(*) as n from s where split = 'test' or (pt > 20000 and pt < 6000000) group by all)
select g.split, g.name as flavour, coalesce(n, 0) as n from (select unnest(['train', 'val', 'test']) as split, name, i from (values ('bjets', 0), ('cjets', 1), ('ujets', 2)) v(name, i)) g
left join c on c.split = g.split and c.flavour = g.i""",
    "run_statistics": f"""
with {_TRAIN}, v as (select t.* from (select unnest(tracks) as t from r) where t.valid), m as (
  select 'jets' as "group", 'pt' as variable, cast(pt as double) as x from r union all select 'jets', 'abs_eta', cast(abs_eta as double) from r
  union all select 'tracks', 'dphi', cast(dphi as double) from v union all select 'tracks', 'd0', cast(d0 as double) from v
) select "group", variable, round(avg(x), 4) as mean, round(stddev_pop(x), 4) as std from m where x is not null and isfinite(x) group by all""",
    "run_weights": f"with {_WEIGHTS} select flavour_label, b0, b1, round(weight, 9) as weight from w",
    "run_report": f"""
with {_TRAIN}, x as (select 'wide_all_' || ['bjets', 'cjets', 'ujets'][flavour_label + 1] as component, cast(least(greatest(floor((cast(pt as double) - 20000.0) / 19600.0), 0), 49) as int) as bin from r),
c as (select component, bin, count(*) as n from x group by all) select component, bin, n, round(n / sum(n) over (partition by component), 9) as share from c""",
    "run_components": f"with {_CAPPED} select jet_id, component, cast(1 as bigint) as copies from g",
    "run_manifest": f"with {_FILED} select file_no, count(*) as rows from filed group by file_no",
    "run_capped": f"""
with {_FILED} select * from filed""",
    "run_resampled": f"""
with {_TRAIN} select 'wide_all_' || ['bjets', 'cjets', 'ujets'][flavour_label + 1] as component, flavour_label, least(count(*), {DRAWN}) as n from r where abs_eta < 2.5 group by flavour_label""",
}
