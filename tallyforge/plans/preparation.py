"""Queries of the preparation operators over the table of jets (each jet_id once), and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.binning import edges, subdivide, with_overflow
from tallyforge.functions.cuts import Cuts
from tallyforge.functions.precision import half, half_sql
from tallyforge.functions.randomness import md5_uniform, md5_uniform_sql
from tallyforge.functions.text import canonical, name_part
from tallyforge.operators import histograms, merging, normalisation, quality, reporting, resampling, reweighting, splitting
from tallyforge.session import read_table
from tallyforge.sources import tables

PT = edges([[0, 250_000, 5], [250_000, 6_000_000, 5]])
ETA = edges([[0, 2.5, 5]])
BINS = {"pt": PT, "abs_eta": ETA}
OVER = {"pt": with_overflow(edges([[20_000, 100_000, 8], [100_000, 1_000_000, 6]])), "abs_eta": ETA}
TRACK_BINS = {"dphi": with_overflow(edges([[-0.2, 0.2, 8]]))}
REGIONS = {"lowpt": Cuts.of(["pt > 20000", "pt < 100000"]), "highpt": Cuts.of(["pt > 100000", "pt < 6000000"])}
SPLITS = {"train": Cuts.of(["eventnumber %10<= 7"]), "val": Cuts.of(["eventnumber %10== 8"]), "test": Cuts.of(["eventnumber %10== 9"])}
FLAVOURS = {
    "bjets": Cuts.of([("hadronconeexcltruthlabelid", "==", 5)]),
    "cjets": Cuts.of([("hadronconeexcltruthlabelid", "==", 4)]),
    "ujets": Cuts.of([("hadronconeexcltruthlabelid", "in", [0, 1, 2, 3, 21])]),
    "heavy": Cuts.of([("hadronconeexcltruthlabelid", "in", [4, 5, 54, 55])]),
}
COMPONENTS = {f"{r}_{f}": REGIONS[r] + FLAVOURS[f] for r in REGIONS for f in FLAVOURS}
TARGET, DRAWS, CAP = 0, 1_500, {0: 400, 1: 300, 2: 300, 3: -1, 4: -1, 5: -1, 6: -1, 7: -1}
#: Rows from which histograms and estimates are made, if there are more.
ENOUGH = 1_000_000

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _jets(spark: SparkSession, sf: str, *columns: str, where: Column | str | None = None) -> DataFrame:
    """Each jet once. Repeated rows have equal content, so conditions are applied first and reach the scan."""
    rows = read_table(spark, sf, "jets").select("jet_id", *columns)
    return (rows if where is None else rows.where(where)).dropDuplicates(["jet_id"])


def _labelled(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The jets with a label of the table flavours (of fixed size)."""
    known = F.broadcast(read_table(spark, sf, "flavours").select("flavour_label"))
    return _jets(spark, sf, "flavour_label", *columns, where="flavour_label is not null").join(known, "flavour_label", "left_semi")


# --- SQL parts -----------------------------------------------------------------------------------------------------
J = "j as (select * from (select *, row_number() over (partition by jet_id order by ingested_at) as copy from jets) where copy = 1)"
L = J + ", l as (select * from j where flavour_label in (select flavour_label from flavours))"
CANON_SAMPLE = "regexp_replace(lower(sample), '[\\s_-]+', '', 'g')"


def _bin(x: str, bins: list[float]) -> str:
    number = lambda e: f"'{e}'::double" if abs(e) == float("inf") else repr(float(e))
    x = f"cast({x} as double)"
    listed = "[" + ", ".join(map(number, bins)) + "]"
    return (
        f"cast(case when {x} is null or isnan({x}) or {x} < {number(bins[0])} or {x} > {number(bins[-1])} then null "
        f"else least(len(list_filter({listed}, lambda e: e <= {x})) - 1, {len(bins) - 2}) end as int)"
    )


def _binned(of: str, bins: dict, columns: str = "*") -> str:
    cols = ", ".join(f"{_bin(v, e)} as b{i}" for i, (v, e) in enumerate(bins.items()))
    return f"select * from (select {columns}, {cols} from {of}) where " + " and ".join(f"b{i} is not null" for i in range(len(bins)))


# --- sources and predicates ----------------------------------------------------------------------------------------
@_query(f"with {J} select jet_id, pt, mass from j where pt > 50000 and abs_eta <= 2.0 and flavour_label <> 3 and isfinite(mass) and mass >= 5000")
def cut_compare(spark: SparkSession, sf: str) -> DataFrame:
    """NaN is in no range: masses that are no number meet no lower bound."""
    cuts = Cuts.of(["pt > 50000", "abs_eta <= 2.0", "flavour_label != 3", "mass >= 5000"])
    return _jets(spark, sf, "pt", "abs_eta", "flavour_label", "mass", where=cuts.column()).select("jet_id", "pt", "mass")


@_query(f"with {J} select jet_id from j where hadronconeexcltruthlabelid in (5, 4) and flavour_label not in (6, 7)")
def cut_membership(spark: SparkSession, sf: str) -> DataFrame:
    cuts = Cuts.of([("hadronconeexcltruthlabelid", "in", [5, 4]), ("flavour_label", "notin", [6, 7])])
    return _jets(spark, sf, "hadronconeexcltruthlabelid", "flavour_label", where=cuts.column()).select("jet_id")


@_query(f"with {J} select jet_id from j where (((eventnumber - 3000) % 7) + 7) % 7 >= 5")
def cut_modulo(spark: SparkSession, sf: str) -> DataFrame:
    rows = _jets(spark, sf, "eventnumber").withColumn("moved", F.col("eventnumber") - 3000)
    return rows.where(Cuts.of(["moved %7>= 5"]).column()).select("jet_id")


@_query(f"""with {J} select case when eventnumber % 10 <= 7 then 'train' when eventnumber % 10 = 8 then 'val' else 'test' end as split,
jetfoldhash % 4 as fold, count(*) as n from j group by all""")
def split_predicate(spark: SparkSession, sf: str) -> DataFrame:
    split = F.coalesce(*[F.when(c.column(), F.lit(s)) for s, c in SPLITS.items()])
    return _jets(spark, sf, "eventnumber", "jetfoldhash").groupBy(split.alias("split"), F.pmod("jetfoldhash", F.lit(4)).alias("fold")).agg(F.count(F.lit(1)).alias("n"))


_ROUTES = {
    "bjets": "hadronconeexcltruthlabelid = 5", "cjets": "hadronconeexcltruthlabelid = 4",
    "ujets": "hadronconeexcltruthlabelid in (0, 1, 2, 3, 21)", "heavy": "hadronconeexcltruthlabelid in (4, 5, 54, 55)",
}
_ROUTED = " union all ".join(
    f"select jet_id, '{r}_{f}' as component from j where {p} and {w}" for r, p in {"lowpt": "pt > 20000 and pt < 100000", "highpt": "pt > 100000 and pt < 6000000"}.items() for f, w in _ROUTES.items()
)


def _routed(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    low, high = map(float, reporting.full_range([r.bounds("pt") for r in REGIONS.values()]))
    jets = _jets(spark, sf, "pt", "hadronconeexcltruthlabelid", *columns, where=(F.col("pt") > low) & (F.col("pt") < high))
    return splitting.route(jets, COMPONENTS)


@_query(f"with {J} {_ROUTED}")
def multi_route(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf).select("jet_id", "component")


@_query(f"with {J}, r as ({_ROUTED}) select split_part(component, '_', 1) as region, split_part(component, '_', 2) as flavour, count(*) as n from r group by all")
def region_flavour_select(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.split("component", "_")
    return _routed(spark, sf).groupBy(parts[0].alias("region"), parts[1].alias("flavour")).agg(F.count(F.lit(1)).alias("n"))


@_query(f"with {J}, r as ({_ROUTED}) select component, count(*) as rows, round(100.0 * count(*) / sum(count(*)) over (), 6) as percent from r group by component")
def split_summary(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.summary(_routed(spark, sf)).withColumn("percent", F.round("percent", 6))


@_query(f"with {J}, r as ({_ROUTED}) select coalesce(component, 'total') as component, count(*) as rows, count(distinct jet_id) as unique_rows from r group by rollup (component)")
def jet_counts_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.rollup(_routed(spark, sf), "jet_id")


@_query(f"""with {J}, r as ({_ROUTED}), c as (select split_part(component, '_', 1) as region, split_part(component, '_', 2) as flavour, count(*) as rows from r group by all)
select region, flavour, rows, round(rows / sum(rows) over (partition by region), 9) as share from c""")
def flavour_ratios(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.split("component", "_")
    rows = _routed(spark, sf).select(parts[0].alias("region"), parts[1].alias("flavour"))
    return splitting.shares(rows, "region", "flavour").withColumn("share", F.round("share", 9))


@_query(f"""with {J} select jet_id, len(list_filter(tracks, lambda t: t.valid and t.d0 < 0.05)) as n_kept,
round(list_sum(list_transform(list_filter(tracks, lambda t: t.valid and t.d0 < 0.05), lambda t: cast(t.d0 as double))), 6) as sum_d0 from j""")
def nested_select(spark: SparkSession, sf: str) -> DataFrame:
    kept = merging.select_elements("tracks", Cuts.of(["d0 < 0.05"]))
    rows = _tracked(spark, sf).withColumn("kept", kept)
    total = F.when(F.size("kept") > 0, F.aggregate("kept", F.lit(0.0), lambda a, t: a + t["d0"].cast("double")))
    return rows.select("jet_id", F.size("kept").cast("bigint").alias("n_kept"), F.round(total, 6).alias("sum_d0"))


def _tracked(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return _jets(spark, sf, "tracks", *columns)


@_query(f"""with {J}, e as (select jet_id, unnest(tracks) as t, generate_subscripts(tracks, 1) - 1 as slot from j)
select jet_id, cast(slot as int) as slot, t.d0 as d0, t.leptonid as leptonid from e where t.valid""")
def valid_flatten(spark: SparkSession, sf: str) -> DataFrame:
    rows = _tracked(spark, sf).select("jet_id", F.posexplode("tracks").alias("slot", "t"))
    return rows.where("t.valid").select("jet_id", "slot", "t.d0", "t.leptonid")


@_query(f"""with {J} select jet_id, cast(case when hadronconeexcltruthlabelid = 5 then 0 when hadronconeexcltruthlabelid = 4 then 1
when hadronconeexcltruthlabelid in (0, 1, 2, 3, 21) then 2 when hadronconeexcltruthlabelid in (4, 5, 54, 55) then 3 end as int) as label from j""")
def label_assign(spark: SparkSession, sf: str) -> DataFrame:
    return _jets(spark, sf, "hadronconeexcltruthlabelid").select("jet_id", merging.label_by_cuts(list(FLAVOURS.items())).alias("label"))


@_query(f"""with {J} select jet_id, case hadronconeexcltruthlabelid when 54 then 5 when 55 then 5 when 21 then 0 else hadronconeexcltruthlabelid end as truth,
list_transform(tracks, lambda t: case t.leptonid when -11 then 11 when -13 then 13 else t.leptonid end) as leptons from j""")
def transform_ints(spark: SparkSession, sf: str) -> DataFrame:
    rows = _tracked(spark, sf, "hadronconeexcltruthlabelid").withColumnRenamed("hadronconeexcltruthlabelid", "truth")
    return rows.select("jet_id", tables.remap_ints(F.col("truth"), {54: 5, 55: 5, 21: 0}).alias("truth"), F.transform("tracks", lambda t: tables.remap_ints(t["leptonid"], {-11: 11, -13: 13})).alias("leptons"))


@_query(f"with {J} select count(*) as n_rows, count(*) filter (pt > 50000 and abs_eta < 1.5) as n_after_cuts, min(jet_id) as first_id, max(jet_id) as last_id from j")
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    after = F.when(Cuts.of(["pt > 50000", "abs_eta < 1.5"]).column(), 1)
    return _jets(spark, sf, "pt", "abs_eta").agg(F.count(F.lit(1)).alias("n_rows"), F.count(after).alias("n_after_cuts"), F.min("jet_id").alias("first_id"), F.max("jet_id").alias("last_id"))


# --- histograms ----------------------------------------------------------------------------------------------------
@_query(f"with {L}, b as ({_binned('l', {'pt': PT})}) select flavour_label, b0, count(*) as n from b group by all")
def hist_1d(spark: SparkSession, sf: str) -> DataFrame:
    return histograms.histogram(_labelled(spark, sf, "pt"), ["flavour_label"], {"pt": PT})


_HIST = f"{L}, b as ({_binned('l', BINS)}), h as (select flavour_label, b0, b1, count(*) as n from b group by all)"
_P = _HIST + ", p as (select *, n / sum(n) over (partition by flavour_label) as p from h)"


@_query(f"with {_HIST} select * from h")
def hist_2d(spark: SparkSession, sf: str) -> DataFrame:
    return histograms.histogram(_labelled(spark, sf, "pt", "abs_eta"), ["flavour_label"], BINS)


@_query(f"with {_P} select flavour_label, b0, b1, n, round(p, 9) as p from p")
def pbin(spark: SparkSession, sf: str) -> DataFrame:
    return histograms.probabilities(hist_2d(spark, sf), ["flavour_label"]).withColumn("p", F.round("p", 9))


@_query(f"""with {_P} select flavour_label, b0, b1, n, round(p, 9) as p, round(coalesce(aim / p, 0), 9) as ratio from p
left join (select b0, b1, p as aim from p where flavour_label = {TARGET}) t using (b0, b1)""")
def pdf_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: ratio of every class's histogram to the target's."""
    out = histograms.ratio_to_target(hist_2d(spark, sf), "flavour_label", TARGET, BINS)
    return out.select("flavour_label", "b0", "b1", "n", F.round("p", 9).alias("p"), F.round("ratio", 9).alias("ratio"))


_SUB = subdivide(PT, 2)


@_query(f"with {L}, b as ({_binned('l', {'pt': _SUB})}) select b0, count(*) as n from b group by all")
def hist_subdivided(spark: SparkSession, sf: str) -> DataFrame:
    return histograms.histogram(_labelled(spark, sf, "pt"), [], {"pt": _SUB})


@_query(f"""with {L}, r as (select *, row_number() over (partition by flavour_label order by {md5_uniform_sql('some', 'jet_id')}, jet_id) as rank from l),
few as (select * from r where rank <= {ENOUGH}), b as ({_binned('few', BINS)}) select flavour_label, b0, b1, count(*) as n from b group by all""")
def hist_limited(spark: SparkSession, sf: str) -> DataFrame:
    """Histograms from at most ENOUGH random jets of each class."""
    jets = resampling.random_order(_labelled(spark, sf, "pt", "abs_eta"), ["flavour_label"], "jet_id", "some").where(F.col("rank") <= ENOUGH)
    return histograms.histogram(jets, ["flavour_label"], BINS)


@_query(f"""with {J}, t as (select count(*) as n from j), s as (select pt, abs_eta from j, t where {md5_uniform_sql('est', 'jet_id')} < {ENOUGH}.0 / n)
select round(count(*) filter (pt > 50000 and abs_eta < 1.5) / count(*) * (select n from t), 6) as rows from s""")
def estimate_available(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that meet cuts, estimated from about ENOUGH (exact if there are fewer)."""
    cuts = Cuts.of(["pt > 50000", "abs_eta < 1.5"]).column()
    return tables.estimated_rows(_jets(spark, sf, "pt", "abs_eta"), cuts, ENOUGH, "jet_id", "est").withColumn("rows", F.round("rows", 6))


# --- resampling ----------------------------------------------------------------------------------------------------
@_query(f"with {L} select flavour_label, count(*) as total, greatest(round(1000 * 1.1 / count(*), 3), 0.1) as fraction from l group by flavour_label")
def auto_fraction(spark: SparkSession, sf: str) -> DataFrame:
    counts = _labelled(spark, sf).groupBy("flavour_label").agg(F.count(F.lit(1)).alias("total"))
    return counts.withColumn("fraction", resampling.auto_fraction(F.lit(1000), F.col("total")))


_QUOTAS = f"""{_HIST}, t as (select b0, b1, n / sum(n) over () as p from h where flavour_label = {TARGET}),
q as (select b0, b1, p, cast(floor({DRAWS} * p + {md5_uniform_sql('quota', "concat_ws('|', b0, b1)")}) as bigint) as quota from t)"""


def _quotas(jets: DataFrame) -> DataFrame:
    target = resampling.target_probabilities(jets, F.col("flavour_label") == TARGET, BINS)
    return resampling.bin_quotas(target, F.lit(DRAWS), BINS, "quota")


@_query(f"with {_QUOTAS} select b0, b1, round(p, 9) as p, quota from q")
def countup_targets(spark: SparkSession, sf: str) -> DataFrame:
    return _quotas(_labelled(spark, sf, "pt", "abs_eta")).select("b0", "b1", F.round("p", 9).alias("p"), "quota")


_RANKED = f"r as (select jet_id, b0, b1, row_number() over (partition by b0, b1 order by {md5_uniform_sql('up', 'jet_id')}, jet_id) as rank from b where flavour_label = 1)"
_SPOT = md5_uniform_sql("up-bin", "concat_ws('|', b0, b1, i)")
_COUNTUP = f"""{_QUOTAS}, {_RANKED},
need as (select b0, b1, have, quota, cast(sum(quota) over (order by b0, b1) as bigint) as upto, cast(sum(quota) over () as bigint) as total
  from q join (select b0, b1, count(*) as have from r group by all) using (b0, b1) where quota > 0),
own as (select b0, b1, cast(floor({_SPOT} * have) + 1 as bigint) as rank from (select *, unnest(range(have + 1, quota + 1)) as i from need where quota > have)),
again as (select floor({md5_uniform_sql('up-all', 'i')} * total) + 1 as place from (select total, unnest(range(1, greatest({DRAWS} - total, 0) + 1)) as i from (select distinct total from need))),
more as (select b0, b1, cast(case when i <= have then i else floor({_SPOT} * have) + 1 end as bigint) as rank
  from (select n.*, cast(place - (upto - quota) as bigint) as i from again join need n on place <= upto and place > upto - quota)),
extra as (select b0, b1, rank, count(*) as extra from (select * from own union all select * from more) group by all),
drawn as (select jet_id, b0, b1, 1 + coalesce(extra, 0) as copies from r join need using (b0, b1) left join extra using (b0, b1, rank) where rank <= quota)"""


def _countup(spark: SparkSession, sf: str) -> DataFrame:
    jets = _labelled(spark, sf, "pt", "abs_eta")
    return resampling.countup(jets.where("flavour_label = 1"), _quotas(jets), BINS, "jet_id", "up")


@_query(f"with {_COUNTUP} select * from drawn")
def countup_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _countup(spark, sf)


@_query(f"""with {_COUNTUP} select 1 as flavour_label, cast(sum(copies) as bigint) as written, count(*) as unique_rows, max(copies) as most_copies,
round(sum(copies) / count(*), 9) as upsampling_ratio from drawn""")
def upsampling_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = resampling.upsampling(_countup(spark, sf).withColumn("flavour_label", F.lit(1)), ["flavour_label"])
    return out.withColumn("upsampling_ratio", F.round("upsampling_ratio", 9))


_SHARES = f"""{_P}, a as (select b0, b1, p as aim from p where flavour_label = {TARGET}),
m as (select b0, b1, n, round(n * (aim / p), 9) as w from p join a using (b0, b1) where flavour_label = 1),
e as (select *, {DRAWS} * w / (select sum(w) from m where w > 0) as want from m where w > 0),
s as (select *, floor(want) as base, row_number() over (order by round(floor(want) - want, 6), b0, b1) as place from e),
k as (select b0, b1, n, cast(base + case when place <= {DRAWS} - (select sum(base) from s) then 1 else 0 end as int) as k from s),
c as (select b0, b1, n, unnest(range(1, k + 1)) as i from k where k > 0),
x as (select b0, b1, cast(floor({md5_uniform_sql('imp-pick', "concat_ws('|', b0, b1, i)")} * n) + 1 as bigint) as rank, count(*) as copies from c group by all),
r as (select jet_id, b0, b1, row_number() over (partition by b0, b1 order by {md5_uniform_sql('imp', 'jet_id')}, jet_id) as rank from b where flavour_label = 1)"""


@_query(f"with {_SHARES} select jet_id, b0, b1, copies from r join x using (b0, b1, rank)")
def pdf_sample(spark: SparkSession, sf: str) -> DataFrame:
    jets = _labelled(spark, sf, "pt", "abs_eta")
    ratios = histograms.ratio_to_target(histograms.histogram(jets, ["flavour_label"], BINS), "flavour_label", TARGET, BINS).where("flavour_label = 1")
    return resampling.importance_sample(jets.where("flavour_label = 1"), ratios, BINS, "jet_id", DRAWS, "imp")


@_query(f"""with {L}, r as (select jet_id, flavour_label, row_number() over (partition by flavour_label order by {md5_uniform_sql('cap', 'jet_id')}, jet_id) as rank from l)
select jet_id, flavour_label from r where rank <= case flavour_label when 0 then 400 when 1 then 300 when 2 then 300 else 9223372036854775807 end""")
def component_cap(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.cap(_labelled(spark, sf), "flavour_label", CAP, "jet_id", "cap").select("jet_id", "flavour_label")


# --- reweighting ---------------------------------------------------------------------------------------------------
_OVER = f"{L}, b as ({_binned('l', OVER)}), h as (select flavour_label, b0, b1, count(*) as n from b group by all)"
_DENSE = (
    _OVER
    + """, d as (select c.flavour_label, g.b0, g.b1, coalesce(n, 0) as n from (select distinct flavour_label from h) c
cross join (select distinct b0, b1 from h) g left join h using (flavour_label, b0, b1))"""
)
_AIMS = {
    "class": (2, "sum(case when flavour_label = 2 then n else 0 end)"),
    "mean": ("mean", "avg(n)"),
    "min": ("min", "min(n)"),
    "max": ("max", "max(n)"),
    "uniform": ("uniform", "1.0"),
    "list": ([0, 1], "sum(case when flavour_label in (0, 1) then n else 0 end) / 2.0"),
}


def _class_hist(spark: SparkSession, sf: str) -> DataFrame:
    return histograms.histogram(_labelled(spark, sf, "pt", "abs_eta"), ["flavour_label"], OVER)


def _target_query(name: str, target: object):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return reweighting.target_histogram(_class_hist(spark, sf), "flavour_label", target, OVER).withColumn("target", F.round("target", 6))

    query.__name__ = f"rw_target_{name}"
    return query


for _name, (_target, _sql) in _AIMS.items():
    _query(f"with {_DENSE} select b0, b1, round(cast({_sql} as double), 6) as target from d group by b0, b1")(_target_query(_name, _target))

_WEIGHTS = _DENSE + """, w as (select flavour_label, b0, b1, case when min(n) over (partition by b0, b1) = 0 then 0.0
else (avg(n) over (partition by b0, b1)) / n end as weight from d)"""


def _weights(spark: SparkSession, sf: str) -> DataFrame:
    hist = _class_hist(spark, sf)
    return reweighting.class_weights(hist, reweighting.target_histogram(hist, "flavour_label", "mean", OVER), "flavour_label", OVER)


@_query(f"with {_WEIGHTS} select flavour_label, b0, b1, round(weight, 9) as weight from w")
def rw_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _weights(spark, sf).withColumn("weight", F.round("weight", 9))


_RW_NAME = reweighting.weight_name("jets", ["pt", "abs_eta"], "flavour_label", "mean")


@_query(f"""with {_WEIGHTS}, x as (select jet_id, flavour_label, {_bin('pt', OVER['pt'])} as b0, {_bin('abs_eta', OVER['abs_eta'])} as b1 from l)
select jet_id, round(coalesce(weight, 0), 9) as {_RW_NAME} from x left join w using (flavour_label, b0, b1)""")
def rw_apply(spark: SparkSession, sf: str) -> DataFrame:
    jets = reweighting.apply_weights(_labelled(spark, sf, "pt", "abs_eta"), _weights(spark, sf), "flavour_label", OVER, _RW_NAME)
    return jets.select("jet_id", F.round(_RW_NAME, 9).alias(_RW_NAME))


@_query(f"""with {_WEIGHTS} select flavour_label, b0, round(sum(weight), 6) as weight from w group by all""")
def weight_projection(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.project_weights(_weights(spark, sf), "flavour_label", OVER, [0]).withColumnRenamed("b0", "b0").withColumn("weight", F.round("weight", 6))


_TRACKS = f"""{J}, e as (select jet_id, unnest(tracks) as t from j),
b as (select jet_id, t.leptonid as leptonid, t.valid as valid, {_bin('t.dphi', TRACK_BINS['dphi'])} as b0 from e),
h as (select leptonid, b0, count(*) as n from b where valid and leptonid is not null and b0 is not null group by all),
d as (select c.leptonid, g.b0, coalesce(n, 0) as n from (select distinct leptonid from h) c cross join (select distinct b0 from h) g left join h using (leptonid, b0)),
w as (select leptonid, b0, case when min(n) over (partition by b0) = 0 then 0.0 else avg(n) over (partition by b0) / n end as weight from d)"""


@_query(f"""with {_TRACKS}, x as (select jet_id, sum(case when valid then coalesce(weight, 0) else 0 end) as total from b left join w using (leptonid, b0) group by jet_id)
select jet_id, round(coalesce(total, 0), 6) as total_weight from j left join x using (jet_id)""")
def rw_apply_nested(spark: SparkSession, sf: str) -> DataFrame:
    jets = _tracked(spark, sf)
    hist = reweighting.nested_histogram(jets, "tracks", "leptonid", TRACK_BINS)
    weights = reweighting.class_weights(hist, reweighting.target_histogram(hist, "leptonid", "mean", TRACK_BINS), "leptonid", TRACK_BINS)
    lists = reweighting.weight_lists(weights, "leptonid", TRACK_BINS)
    each = reweighting.nested_weights(jets, "tracks", lists, "leptonid", TRACK_BINS, "weights")
    total = F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)
    return each.select("jet_id", F.round(F.coalesce(total, F.lit(0.0)), 6).alias("total_weight"))


# --- merging -------------------------------------------------------------------------------------------------------
@_query(f"""with {L} select component, flavour_label, count(*) as n, sum(jet_id)::bigint as ids from (
select jet_id, flavour_label, 'lowpt' as component from l where pt > 20000 and pt < 100000 union all select jet_id, flavour_label, 'highpt' from l where pt > 100000 and pt < 6000000) group by all""")
def merge_union(spark: SparkSession, sf: str) -> DataFrame:
    jets = _labelled(spark, sf, "pt")
    parts = merging.union_components({r: jets.where(c.column()).select("jet_id", "flavour_label") for r, c in REGIONS.items()})
    return parts.groupBy("component", "flavour_label").agg(F.count(F.lit(1)).alias("n"), F.sum("jet_id").alias("ids"))


@_query(f"""with {J} select jet_id, cast((row_number() over (order by {md5_uniform_sql('merge', 'jet_id')}, jet_id) - 1) // 3000 as int) as file_no from j""")
def merge_file_index(spark: SparkSession, sf: str) -> DataFrame:
    return merging.file_index(_jets(spark, sf), "jet_id", 3000, "merge").select("jet_id", "file_no")


@_query(f"""with {J}, t as (select jet_id, {CANON_SAMPLE} as sample from j where eventnumber % 10 = 9 and sample is not null)
select jet_id, sample, cast((row_number() over (partition by sample order by {md5_uniform_sql('test', 'jet_id')}, jet_id) - 1) // 100 as int) as file_no from t""")
def test_by_sample(spark: SparkSession, sf: str) -> DataFrame:
    jets = _jets(spark, sf, "eventnumber", "sample", where=SPLITS["test"].column() & F.col("sample").isNotNull())
    return merging.file_index(jets.select("jet_id", canonical("sample").alias("sample")), "jet_id", 100, "test", by=["sample"])


@_query(f"""with {J}, s as (select jet_id, {CANON_SAMPLE} as sample from j where sample is not null),
r as (select jet_id, sample, row_number() over (partition by sample order by {md5_uniform_sql('equal', 'jet_id')}, jet_id) as rank from s)
select jet_id, sample from r where rank <= (select min(n) from (select count(*) as n from s group by sample))""")
def equal_rows(spark: SparkSession, sf: str) -> DataFrame:
    jets = _jets(spark, sf, "sample", where="sample is not null").select("jet_id", canonical("sample").alias("sample"))
    return merging.equal_rows(jets, "sample", "jet_id", "equal")


@_query(f"""with {J} select jet_id, pt, {half_sql('eta')} as eta, {half_sql('abs_eta')} as abs_eta, mass from j""")
def precision_policy(spark: SparkSession, sf: str) -> DataFrame:
    """Momenta, energies and masses keep their precision; other numbers get half precision."""
    names = ("pt", "eta", "abs_eta", "mass")
    return _jets(spark, sf, *names).select("jet_id", *[F.col(c) if tables.full_precision(c) else half(c).alias(c) for c in names])


# --- normalisation -------------------------------------------------------------------------------------------------
def _moment_sql(variables: list[str], of: str, group: str, digits: int) -> str:
    return " union all ".join(
        f"select '{group}' as \"group\", '{v}' as variable, count(x) filter (isfinite(x)) as n, round(avg(x) filter (isfinite(x)), {digits}) as mean, "
        f"round(stddev_pop(case when isfinite(x) then x end), {digits}) as std, count(*) filter (isinf(x)) as n_infinite from (select cast({c} as double) as x from {of})"
        for v, c in ((v.rpartition(".")[2], v) for v in variables)
    )


def _rounded(table: DataFrame, digits: int) -> DataFrame:
    return table.withColumns({c: F.round(c, digits) for c in ("mean", "std")})


@_query(f"with {J} {_moment_sql(['pt', 'eta', 'mass', 'pt_btagjes'], 'j', 'jets', 3)}")
def norm_moments(spark: SparkSession, sf: str) -> DataFrame:
    names = ["pt", "eta", "mass", "pt_btagjes"]
    return _rounded(normalisation.moments(_jets(spark, sf, *names), "jets", names), 3)


@_query(f"with {J}, e as (select unnest(tracks) as t from j), v as (select t.* from e where t.valid) {_moment_sql(['dphi', 'd0', 'qoverp'], 'v', 'tracks', 6)}")
def norm_nested(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(normalisation.nested_moments(_tracked(spark, sf), "tracks", "tracks", ["dphi", "d0", "qoverp"]), 6)


@_query(f"with {J} select 'pt' as variable, count(pt) as n, round(avg(cast(pt as double)), 3) as mean, round(stddev_pop(cast(pt as double)), 3) as std from j")
def norm_pooled(spark: SparkSession, sf: str) -> DataFrame:
    """The moments of all jets from those of each fold."""
    parts = _jets(spark, sf, "pt", "jetfoldhash").groupBy("jetfoldhash").agg(
        F.lit("pt").alias("variable"), F.count("pt").alias("n"), F.avg(F.col("pt").cast("double")).alias("mean"), F.stddev_pop(F.col("pt").cast("double")).alias("std")
    )
    return _rounded(normalisation.pooled(parts, ["variable"]), 3)


_COUNTS = f"""{J}, c as (select 'flavour_label' as variable, cast(flavour_label as bigint) as label, count(*) as n from j where flavour_label is not null group by all
union all select 'hadronconeexcltruthlabelid', cast(hadronconeexcltruthlabelid as bigint), count(*) from j where hadronconeexcltruthlabelid is not null group by all)"""


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    jets = _jets(spark, sf, "flavour_label", "hadronconeexcltruthlabelid", "eventnumber")
    return normalisation.class_counts(jets, [c for c in normalisation.label_columns(jets) if c != "jet_id"])


@_query(f"with {_COUNTS} select * from c")
def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf)


@_query(f"""with {_COUNTS}, w as (select *, sum(n) over (partition by variable) / n as r from c)
select variable, label, n, round(r / min(r) over (partition by variable), 2) as weight from w""")
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return normalisation.class_weights(_counts(spark, sf))


# --- checks and reports --------------------------------------------------------------------------------------------
_TAGS = list(quality.CAMPAIGNS)
_NAMES = f"""(select 'group.' || case when jetfoldhash % 4 in (0, 1) then cast(600000 + jetfoldhash as varchar) || '.' else '' end || 'py8.e8514' ||
case when jetfoldhash % 4 in (0, 2) then '_' || {_TAGS}[cast(eventnumber % {len(_TAGS)} as int) + 1] else '' end || '.h5' as name from j)"""


def _named(spark: SparkSession, sf: str) -> DataFrame:
    """Names of delivered files made of the jets' columns: every known tag, and names without id or tag."""
    form = F.col("jetfoldhash") % 4
    number = F.when(form.isin(0, 1), F.concat((600000 + F.col("jetfoldhash")).cast("string"), F.lit("."))).otherwise("")
    tag = F.when(form.isin(0, 2), F.concat(F.lit("_"), F.get(F.array(*map(F.lit, _TAGS)), (F.col("eventnumber") % len(_TAGS)).cast("int")))).otherwise("")
    return _jets(spark, sf, "jetfoldhash", "eventnumber").select(F.concat(F.lit("group."), number, F.lit("py8.e8514"), tag, F.lit(".h5")).alias("name"))


_CAMPAIGN = " ".join(f"when '{t}' then '{c}'" for t, c in quality.CAMPAIGNS.items())


@_query(f"""with {J}, n as {_NAMES}, x as (select name, nullif(regexp_extract(name, '\\.(\\d{{6}})\\.', 1), '') as dsid, nullif(regexp_extract(name, '_(r\\d+)', 1), '') as tag from n),
y as (select *, case tag {_CAMPAIGN} else tag end as campaign from x)
select dsid, tag, case when dsid is null and campaign is null then name when dsid is null then name || ' / ' || campaign else dsid || ' / ' || coalesce(campaign, name) end as entry, count(*) as n
from y group by all""")
def dsid_parse(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("name")
    return (
        _named(spark, sf)
        .groupBy(quality.dataset_id(name).alias("dsid"), quality.reconstruction_tag(name).alias("tag"), quality.entry_name(name).alias("entry"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@_query(f"""with {J}, x as (select string_split('user.' || campaign || '.' || coalesce({CANON_SAMPLE}, ''), '.') as p from j)
select p[2] as scope, coalesce(nullif(p[3], ''), 'unknown') as process, count(*) as n from x group by all""")
def name_parts(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("user."), "campaign", F.lit("."), F.coalesce(canonical("sample"), F.lit("")))
    rows = _jets(spark, sf, "campaign", "sample").select(name.alias("name"))
    return rows.groupBy(name_part("name", 2, "unknown").alias("scope"), name_part("name", 3, "unknown").alias("process")).agg(F.count(F.lit(1)).alias("n"))


@_query(f"""with {J}, c as (select campaign, {CANON_SAMPLE} as sample, count(*) as n from j where sample is not null group by all)
select campaign, count(*) as samples, min(n) as smallest, max(n) as largest, round(exp(avg(ln(n))), 6) as geometric_mean, round(max(n) / min(n), 6) as spread,
round(greatest(max(n) / exp(avg(ln(n))), exp(avg(ln(n))) / min(n)), 6) as deviation from c group by campaign""")
def sample_check(spark: SparkSession, sf: str) -> DataFrame:
    jets = _jets(spark, sf, "campaign", "sample", where="sample is not null")
    sizes = jets.groupBy("campaign", canonical("sample").alias("sample")).agg(F.count(F.lit(1)).alias("n"))
    return quality.size_spread(sizes, "campaign").withColumns({c: F.round(c, 6) for c in ("geometric_mean", "spread", "deviation")})


def _plot_sql(low: float, high: float, where: str) -> str:
    return f"""with {L}, x as (select flavour_label, cast(least(greatest(floor((cast(pt as double) - {low}) / {(high - low) / 50!r}), 0), 49) as int) as bin from l where {where}),
c as (select flavour_label, bin, count(*) as n from x group by all) select flavour_label, bin, n, round(n / sum(n) over (partition by flavour_label), 9) as share from c"""


def _plot(jets: DataFrame, low: float, high: float) -> DataFrame:
    return reporting.plot_histogram(jets, ["flavour_label"], "pt", low, high).withColumn("share", F.round("share", 9))


@_query(_plot_sql(20_000.0, 500_000.0, "pt is not null"))
def plot_hist(spark: SparkSession, sf: str) -> DataFrame:
    return _plot(_labelled(spark, sf, "pt"), 20_000.0, 500_000.0)


BOUNDS = [REGIONS[r].bounds("pt") for r in REGIONS]


@_query(_plot_sql(20_000.0, 6_000_000.0, "pt > 20000 and pt < 6000000"))
def plot_full_range(spark: SparkSession, sf: str) -> DataFrame:
    low, high = map(float, reporting.full_range(BOUNDS))
    return _plot(_labelled(spark, sf, "pt").where((F.col("pt") > low) & (F.col("pt") < high)), low, high)


@_query(_plot_sql(0.0, 200_000.0, "pt > 0 and pt < 200000"))
def stitching_hist(spark: SparkSession, sf: str) -> DataFrame:
    low, high = map(float, reporting.stitching_windows(BOUNDS)[0])
    return _plot(_labelled(spark, sf, "pt").where((F.col("pt") > low) & (F.col("pt") < high)), low, high)


@_query(f"""with {J}, c as (select campaign, count(*) as n, round(avg(cast(pt as double)) / 1000, 3) as mean_pt from j group by campaign)
select campaign, case when n >= 1000 then regexp_replace(printf('%.3f', n / 1000), '\\.?0+$', '') || 'k' else cast(n as varchar) end as caption,
'_pt_' || trim(regexp_replace(campaign, '[^A-Za-z0-9]+', '_', 'g'), '_') as suffix, mean_pt from c""")
def plot_captions(spark: SparkSession, sf: str) -> DataFrame:
    counts = _jets(spark, sf, "campaign", "pt").groupBy("campaign").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("pt").cast("double")).alias("pt"))
    return counts.select(
        "campaign", reporting.compact_count(F.col("n")).alias("caption"), reporting.name_suffix(F.lit("pt"), F.lit(""), F.col("campaign")).alias("suffix"), F.round(reporting.display_unit("pt", F.col("pt")), 3).alias("mean_pt")
    )


@_query(f"with {J} select jet_id, {md5_uniform_sql('s', 'jet_id')} as u from j")
def seeded_uniform(spark: SparkSession, sf: str) -> DataFrame:
    return _jets(spark, sf).select("jet_id", md5_uniform("s", "jet_id").alias("u"))


# --- smaller operators -----------------------------------------------------------------------------------------------
@_query(f"with {J} select jet_id from j where pt > 0 and pt < 6000000 and abs_eta > 0 and abs_eta < 2.5 and isfinite(pt) and isfinite(abs_eta)")
def bin_range_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Rows strictly within the first and last edge of every binned variable."""
    cuts = Cuts.of([(v, op, e) for v, bins in BINS.items() for op, e in ((">", bins[0]), ("<", bins[-1]))])
    return _jets(spark, sf, *BINS, where=cuts.column()).select("jet_id")


@_query(f"""with {J} select jet_id, momentum, len(tracks) as slots, round(list_sum(list_transform(tracks, lambda t: cast(t.d0 as double))), 5) as sum_d0
from (select jet_id, pt as momentum, tracks from j)""")
def projected_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A sample of several files read under other names, with chosen columns and nested fields alone."""
    rows = tables.read_sample(spark, [f"{sf}/jets.parquet"], {"pt": "momentum"}).dropDuplicates(["jet_id"])
    kept = tables.project(rows, {"jets": ["momentum"], "tracks": ["d0"]}, ["jet_id"])
    return kept.select("jet_id", "momentum", F.size("tracks").cast("bigint").alias("slots"), F.round(F.aggregate("tracks", F.lit(0.0), lambda a, t: a + t["d0"].cast("double")), 5).alias("sum_d0"))


@_query(f"with {J} select jet_id, coalesce(flavour_label, -1) as kept, cast(7 as int) as written from j")
def label_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A constant label leaves an existing column as it is, unless it is to be overwritten."""
    rows = _jets(spark, sf, "flavour_label")
    kept = merging.with_label(rows, 7)
    both = merging.with_label(kept.withColumn("written", F.lit(0)), 7, "written", overwrite=True)
    return both.select("jet_id", F.coalesce("flavour_label", F.lit(-1)).alias("kept"), "written")


@_query("""select o_orderkey, count(l_orderkey) as n_items, cast(coalesce(sum(l_linenumber), 0) as bigint) as numbers, round(coalesce(sum(l_quantity), 0), 4) as quantity
from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey""")
def nested_zip(spark: SparkSession, sf: str) -> DataFrame:
    """Flat tables zipped by key: every order with its items as an array, none left out."""
    items = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    rows = tables.nest(read_table(spark, sf, "orders").select("o_orderkey"), items, "o_orderkey", "items")
    total = lambda c, zero: F.aggregate("items", F.lit(zero), lambda a, i: a + i[c])
    return rows.select("o_orderkey", F.size("items").cast("bigint").alias("n_items"), total("l_linenumber", 0).cast("bigint").alias("numbers"), F.round(total("l_quantity", 0.0), 4).alias("quantity"))


@_query(f"with {_DENSE} select b0, b1, round(sqrt(avg(n)), 6) as target from d group by b0, b1")
def rw_target_hook(spark: SparkSession, sf: str) -> DataFrame:
    """A target that a function changes at last; it is also checked."""
    target = reweighting.target_histogram(_class_hist(spark, sf), "flavour_label", "mean", OVER, func=F.sqrt)
    reweighting.check_target(target)
    return target.withColumn("target", F.round("target", 6))


@_query(f"{'with ' + _COUNTS} select * from c where variable = 'flavour_label'")
def merged_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Class counts of two halves added label by label."""
    rows = _jets(spark, sf, "flavour_label", "jetfoldhash")
    halves = [normalisation.class_counts(rows.where(f"pmod(jetfoldhash, 2) = {i}"), ["flavour_label"]) for i in (0, 1)]
    return normalisation.merge_counts(*halves)


@_query(f"""with {J}, e as (select unnest(tracks) as t from j) select 'tracks.leptonid' as variable, cast(t.leptonid as bigint) as label, count(*) as n
from e where t.valid and t.leptonid is not null group by all""")
def nested_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Class counts of the labels inside the valid tracks."""
    return normalisation.nested_class_counts(_tracked(spark, sf), "tracks")


@_query(f"""with {_WEIGHTS}, x as (select flavour_label, {_bin('pt', OVER['pt'])} as b0, {_bin('abs_eta', OVER['abs_eta'])} as b1 from l),
v as (select flavour_label, coalesce(weight, 0) as weight from x left join w using (flavour_label, b0, b1)),
c as (select flavour_label, cast(least(greatest(floor((weight - 0.0) / 0.1), 0), 99) as int) as bin, count(*) as n from v group by all)
select flavour_label, bin, n, round(n / sum(n) over (partition by flavour_label), 9) as share from c""")
def weight_hist(spark: SparkSession, sf: str) -> DataFrame:
    """The distribution of the weights that the rows of each class get, in 100 bins."""
    jets = reweighting.apply_weights(_labelled(spark, sf, "pt", "abs_eta"), _weights(spark, sf), "flavour_label", OVER, "weight")
    return reporting.plot_histogram(jets, ["flavour_label"], "weight", 0.0, 10.0, 100).withColumn("share", F.round("share", 9))


@_query(f"""with {J}, r as ({_ROUTED}), x as (select component, {CANON_SAMPLE} as sample, cast(least(greatest(floor((cast(pt as double) - 20000.0) / 119600.0), 0), 49) as int) as bin from r join j using (jet_id) where sample is not null),
c as (select sample, component, bin, count(*) as n from x group by all) select sample, component, bin, n, round(n / sum(n) over (partition by sample, component), 9) as share from c""")
def initial_distributions(spark: SparkSession, sf: str) -> DataFrame:
    """Distributions before any balancing, per sample, region and flavour."""
    rows = _routed(spark, sf, "sample").where("sample is not null").select(canonical("sample").alias("sample"), "component", "pt")
    return reporting.plot_histogram(rows, ["sample", "component"], "pt", 20_000.0, 6_000_000.0).withColumn("share", F.round("share", 9))
