"""Queries of problems 3 and 4: mixes and samples of jets by configuration, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.text import canonical
from tallyforge.llm import mixing, proportional
from tallyforge.session import bounded, cut_lineage, read_table

CANON = "regexp_replace(lower({0}), '[\\s_-]+', '', 'g')"


def _components_once(spark: SparkSession, sf: str) -> DataFrame:
    """Components with a positive num_jets, each component_id once, in canonical spelling."""
    return (
        read_table(spark, sf, "components")
        .where("num_jets > 0")
        .select("component_id", "config_id", canonical("sample").alias("sample"), canonical("flavour").alias("flavour"), "num_jets", F.col("num_jets_estimate_available").alias("estimate"))
        .dropDuplicates(["component_id"])
    )


def _configs_once(spark: SparkSession, sf: str) -> DataFrame:
    return (
        read_table(spark, sf, "resampling_configs")
        .select("config_id", "campaign", canonical("target").alias("target_flavour"), "max_repeat")
        .dropDuplicates(["config_id"])
    )


def _mix_targets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Components that supply jets, and the target of each sample of a configuration."""
    parts = _components_once(spark, sf).where("estimate > 0 and sample is not null")
    limit = _configs_once(spark, sf).select("config_id", "max_repeat", "campaign")
    targets = parts.groupBy("config_id", "sample").agg(F.sum("num_jets").alias("target_size")).join(limit, "config_id")
    return parts, targets


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Samples of a configuration that cannot supply their share: the components are mixed by their estimates.

    Read off the mix: every component was used as often as may be, and the sample's size is still below its target.
    """
    parts, targets = _mix_targets(spark, sf)
    plan = cut_lineage(mixing.source_plan(parts, targets, "config_id", "sample", "estimate"))
    mixed = mixing.mix_sources(parts, plan, "config_id", "sample", ["component_id"], "estimate")
    report = mixing.mix_report(mixed, plan, "config_id", "sample", "estimate")
    return report.where("actual_size < target_size and emitted = max_repeat * n_records").select("config_id", "sample")


def _campaign_jets(spark: SparkSession, sf: str) -> DataFrame:
    """The jets of each campaign, each once: campaign, sample, jet_id."""
    return (
        read_table(spark, sf, "jets")
        .select("campaign", canonical("sample").alias("sample"), "jet_id")
        .where("jet_id is not null and sample is not null and campaign is not null")
        .distinct()
    )


def _mixed_jets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    targets = cut_lineage(_mix_targets(spark, sf)[1])
    wanted = targets.select("config_id", F.col("sample"), "campaign")
    jets = _campaign_jets(spark, sf).join(bounded(wanted), ["campaign", "sample"]).select("config_id", "sample", "jet_id", F.lit(1).alias("size"))
    plan = cut_lineage(mixing.source_plan(jets, targets, "config_id", "sample", "size"))
    return mixing.mix_sources(jets, plan, "config_id", "sample", ["jet_id"], "size"), plan


def p3_mixed_jets(spark: SparkSession, sf: str) -> DataFrame:
    """The jets that each configuration mixes, with their number of copies."""
    mixed, _ = _mixed_jets(spark, sf)
    return mixed.select("config_id", "sample", "jet_id", "copies")


def p3_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual share of each sample in each configuration's mix of jets."""
    mixed, plan = _mixed_jets(spark, sf)
    return mixing.mix_report(mixed, plan, "config_id", "sample", "size").select(
        "config_id", "sample", "target_size", "available", "actual_size", "most_copies", "capped", F.round("target_share", 9).alias("target_share"), F.round("actual_share", 9).alias("actual_share")
    )


def _sample_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Per configuration and flavour (that of its components, and its target): label, weight, floor and seats."""
    flavours = read_table(spark, sf, "flavours").select(canonical("flavour").alias("flavour"), "flavour_label", "min_jets")
    configs = _configs_once(spark, sf)
    parts = _components_once(spark, sf).where("flavour is not null").groupBy("config_id", "flavour").agg(F.sum("num_jets").alias("num_jets"))
    seats = parts.groupBy("config_id").agg(F.sum("num_jets").alias("seats"))
    aims = configs.where("target_flavour is not null").select("config_id", F.col("target_flavour").alias("flavour"), F.lit(0).cast("bigint").alias("num_jets"))
    rows = parts.unionByName(aims).groupBy("config_id", "flavour").agg(F.sum("num_jets").alias("target"))
    return (
        rows.join(seats, "config_id")
        .join(configs.select("config_id", "campaign"), "config_id")
        .join(F.broadcast(flavours), "flavour", "left")
        .select("config_id", "campaign", "flavour", "flavour_label", "target", F.coalesce("min_jets", F.lit(0)).alias("floor"), "seats")
    )


def _config_sample(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    jets = read_table(spark, sf, "jets").where("flavour_label is not null and campaign is not null")
    # Small and used several times: stored, as plans that hold it again and again need gigabytes on the driver.
    targets = cut_lineage(proportional.with_availability(jets, _sample_targets(spark, sf), "campaign", "flavour_label", "jet_id"))
    return proportional.proportional_sample(jets, targets, "campaign", "flavour_label", "jet_id", "config_id"), targets


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Flavours of which a configuration wants more jets than its campaign has.

    Candidates are the flavours of which fewer jets were drawn than wanted; it is checked that they are exhausted and
    not only displaced by the floors of others.
    """
    sample, targets = _config_sample(spark, sf)
    report = proportional.sample_report(sample, targets, "campaign", "flavour_label", "config_id")
    return report.where("taken < target and target > available").select("config_id", "flavour")


def p4_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The sampled jets of each configuration."""
    sample, _ = _config_sample(spark, sf)
    return sample.select("config_id", "flavour_label", "jet_id", "rank", "by_floor")


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual share of each flavour in each configuration's sample, and where it falls short."""
    sample, targets = _config_sample(spark, sf)
    report = proportional.sample_report(sample, targets, "campaign", "flavour_label", "config_id")
    return report.select("config_id", "flavour", "seats", "available", "taken", F.round("target_share", 9).alias("target_share"), F.round("actual_share", 9).alias("actual_share"), "short")


def p4_campaign_report(spark: SparkSession, sf: str) -> DataFrame:
    """Without a configuration: half of each campaign's labelled jets, in the proportions of flavours.target_share."""
    jets = read_table(spark, sf, "jets").where("flavour_label is not null and campaign is not null")
    flavours = read_table(spark, sf, "flavours").select("flavour_label", F.col("target_share").alias("target"), F.col("min_jets").alias("floor"))
    # Every campaign wants every flavour: 8 fixed rows attached as one array, not joined.
    rows = flavours.agg(F.collect_list(F.struct("flavour_label", "target", "floor")).alias("rows"))
    size = jets.groupBy("campaign").agg((F.count_distinct("jet_id") / 2).cast("bigint").alias("seats"))
    wanted = size.select("campaign", "seats", F.explode(rows.scalar()).alias("r")).select("campaign", "seats", "r.*").withColumn("sample_of", F.col("campaign"))
    targets = cut_lineage(proportional.with_availability(jets, wanted, "campaign", "flavour_label", "jet_id"))
    sample = proportional.proportional_sample(jets, targets, "campaign", "flavour_label", "jet_id", "sample_of")
    report = proportional.sample_report(sample, targets, "campaign", "flavour_label", "sample_of")
    return report.select("campaign", "flavour_label", "seats", "available", "taken", F.round("target_share", 9).alias("target_share"), F.round("actual_share", 9).alias("actual_share"), "short")


QUERIES = {f.__name__: f for f in (p3_found, p3_mixed_jets, p3_shares, p4_found, p4_sample, p4_report, p4_campaign_report)}

_PARTS = f"""parts as (
  select distinct component_id, config_id, {CANON.format('sample')} as sample, {CANON.format('flavour')} as flavour, num_jets, num_jets_estimate_available as estimate
  from components where num_jets > 0
), configs as (
  select distinct config_id, campaign, {CANON.format('target')} as target_flavour, max_repeat from resampling_configs
)"""


def _seats_sql(columns: str) -> str:
    """Seats one by one: floors first, then the smallest (rank - 1/2) / share; ``t`` has by_, category, label, target, floor, seats, available."""
    return f""", s as (select *, target / nullif(sum(target) over (partition by by_), 0) as share from t),
r as (select *, unnest(range(1, least(available, seats) + 1)) as rank from s),
o as (select by_, label, row_number() over (partition by by_ order by rank > floor, coalesce((rank - 0.5) / nullif(share, 0), 'inf'::double), label) as place, seats
  from r where target > 0 or rank <= floor),
k as (select by_, label, count(*) as taken from o where place <= seats group by all),
f as (select s.*, coalesce(taken, 0) as taken from s left join k on s.by_ = k.by_ and s.label is not distinct from k.label)
select {columns}, seats, available, taken, round(share, 9) as target_share, round(taken / nullif(sum(taken) over (partition by by_), 0), 9) as actual_share,
  greatest(seats * coalesce(share, 0), floor) > available as short from f"""


SQL = {
    "p3_found": f"""
with {_PARTS}, s as (
  select config_id, sample, sum(num_jets) as wanted, sum(estimate) as have from parts where estimate > 0 and sample is not null group by all
)
select s.config_id, s.sample from s join configs using (config_id) where wanted > max_repeat * have""",
    "p3_shares": f"""
with {_PARTS}, s as (
  select config_id, sample, cast(sum(num_jets) as bigint) as target_size from parts where estimate > 0 and sample is not null group by all
), have as (
  select campaign, {CANON.format('sample')} as sample, count(distinct jet_id) as n from jets where campaign is not null and sample is not null group by all
), p as (
  select s.config_id, s.sample, target_size, coalesce(n, 0) as available, max_repeat * coalesce(n, 0) as supply
  from s join configs c using (config_id) left join have h on h.campaign = c.campaign and h.sample = s.sample
), g as (
  select *, case when available = 0 then 0 else least(target_size, coalesce(supply, target_size)) end as given from p
)
select config_id, sample, target_size, available, cast(given as bigint) as actual_size,
  cast(case when given = 0 then 0 else ceil(given / available) end as bigint) as most_copies,
  target_size > case when available = 0 then 0 else coalesce(supply, target_size) end as capped,
  round(target_size / nullif(sum(target_size) over (partition by config_id), 0), 9) as target_share,
  round(given / nullif(sum(given) over (partition by config_id), 0), 9) as actual_share from g""",
    "p4_found": f"""
with {_PARTS}, w as (
  select config_id, flavour, sum(num_jets) as wanted from parts where flavour is not null group by all
), have as (
  select campaign, flavour_label, count(distinct jet_id) as n from jets where flavour_label is not null group by all
)
select w.config_id, w.flavour from w join configs using (config_id) left join flavours f on f.flavour = w.flavour
left join have h on h.campaign = configs.campaign and h.flavour_label = f.flavour_label
where wanted > coalesce(n, 0)""",
    "p4_report": f"""
with {_PARTS}, w as (
  select config_id, flavour, sum(num_jets) as num_jets from parts where flavour is not null group by all
), aims as (
  select config_id, flavour, sum(num_jets) as target from (select * from w union all select config_id, target_flavour, 0 from configs where target_flavour is not null) group by all
), have as (
  select campaign, flavour_label, count(distinct jet_id) as n from jets where flavour_label is not null and campaign is not null group by all
), t as (
  select a.config_id as by_, a.flavour as category, f.flavour_label as label, a.target, coalesce(f.min_jets, 0) as floor, cast(x.seats as bigint) as seats, coalesce(h.n, 0) as available
  from aims a join (select config_id, sum(num_jets) as seats from w group by all) x using (config_id) join configs c using (config_id)
  left join flavours f on {CANON.format('f.flavour')} = a.flavour left join have h on h.campaign = c.campaign and h.flavour_label = f.flavour_label
){_seats_sql("by_ as config_id, category as flavour")}""",
    "p4_campaign_report": f"""
with have as (
  select campaign, flavour_label, count(distinct jet_id) as n from jets where flavour_label is not null and campaign is not null group by all
), size as (
  select campaign, cast(floor(count(distinct jet_id) / 2) as bigint) as seats from jets where flavour_label is not null and campaign is not null group by all
), t as (
  select s.campaign as by_, f.flavour_label as label, f.target_share as target, coalesce(f.min_jets, 0) as floor, seats, coalesce(h.n, 0) as available
  from size s cross join flavours f left join have h on h.campaign = s.campaign and h.flavour_label = f.flavour_label
){_seats_sql("by_ as campaign, label as flavour_label")}""",
}
