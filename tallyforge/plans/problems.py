"""Queries of the general problems 1, 2 and 5 over the delivered tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.randomness import md5_uniform_sql
from tallyforge.functions.text import canonical
from tallyforge.operators import archive, drift
from tallyforge.operators.skew import salted_aggregate
from tallyforge.session import cut_lineage, read_table

CANON = "regexp_replace(lower({0}), '[\\s_-]+', '', 'g')"


def _label_values(spark: SparkSession, sf: str) -> DataFrame:
    jets = read_table(spark, sf, "jets").select(F.lit("jets.flavour_label").alias("field_name"), F.col("flavour_label").cast("string").alias("field_value"))
    parts = read_table(spark, sf, "components").select(F.lit("components.flavour").alias("field_name"), canonical("flavour").alias("field_value"))
    return jets.unionByName(parts)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Values that more than one eighth of their table's rows hold."""
    # A row per value, stored as it is used twice.
    per_value = cut_lineage(salted_aggregate(_label_values(spark, sf), ["field_name", "field_value"], {"n": ("count", F.lit(1))}))
    total = per_value.groupBy("field_name").agg(F.sum("n").alias("total"))
    return per_value.join(total, "field_name").where("field_value is not null and n * 8 > total").select("field_name", "field_value")


def p1_jets_by_label(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and sums of jets for every flavour_label, NaN masses and infinite values left out of the sums."""
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c).cast("double"))
    return salted_aggregate(
        read_table(spark, sf, "jets"),
        ["flavour_label"],
        {
            "n_rows": ("count", F.lit(1)),
            "n_jets": ("distinct", F.col("jet_id")),
            "sum_pt": ("sum", finite("pt")),
            "sum_mass": ("sum", finite("mass")),
            "sum_pt_btagjes": ("sum", finite("pt_btagjes")),
            "min_pt": ("min", F.col("pt")),
            "max_pt": ("max", F.col("pt")),
        },
    )


def p1_components_by_flavour(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and sums of components for every flavour in canonical spelling."""
    rows = read_table(spark, sf, "components").select(canonical("flavour").alias("flavour"), "num_jets", "num_jets_estimate_available")
    return salted_aggregate(
        rows,
        ["flavour"],
        {
            "n_rows": ("count", F.lit(1)),
            "sum_num_jets": ("sum", F.when(F.col("num_jets") > 0, F.col("num_jets"))),
            "sum_estimates": ("sum", F.when(F.col("num_jets_estimate_available") > 0, F.col("num_jets_estimate_available"))),
        },
    )


def _archive(spark: SparkSession, sf: str) -> DataFrame:
    """The stored archive of jet_files, a group of blocks per directory label."""
    files = read_table(spark, sf, "jet_files").withColumn("dir_label", F.col("flavour_label"))
    return archive.packed(files, "dir_label", "file_path", "payload", ["file_id", "file_format", "written_at"])


def _packed_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records of jet_files, read through archive blocks."""
    return archive.records(archive.unpack(_archive(spark, sf)).where("intact").drop("intact"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of files that hold a jet in common."""
    held = _packed_records(spark, sf).groupBy("jet_id", "file_id").agg(F.lit(1).alias("one")).select("jet_id", "file_id")
    a, b = held.withColumnRenamed("file_id", "file_a"), held.withColumnRenamed("file_id", "file_b")
    return a.join(b, "jet_id").where("file_a < file_b").select("file_a", "file_b").distinct()


def p2_jets_once(spark: SparkSession, sf: str) -> DataFrame:
    """Every jet of jet_files once, with the well-sized file of its label that it goes to."""
    recs = _packed_records(spark, sf).select("jet_id", "pt", "eta", "flavour_label", "written_at", "file_id", "pos")
    return archive.compact(recs, "jet_id", "flavour_label", ["written_at", "file_id", "pos"]).select("flavour_label", "file_no", "jet_id", "pt", "eta")


def p2_archive_index(spark: SparkSession, sf: str) -> DataFrame:
    """The archive's index as checked on reading it back: every file's length and whether its checksum holds."""
    return archive.unpack(_archive(spark, sf)).select("file_id", F.octet_length("payload").alias("n_bytes"), "intact")


def p2_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Single files fetched from the archive by their path: those of every file_id divisible by 100."""
    paths = read_table(spark, sf, "jet_files").where("file_id % 100 = 0").select(F.col("file_path").alias("path"))
    return archive.lookup(_archive(spark, sf), paths).select("file_id", "path", "payload", "intact")


def p2_containers(spark: SparkSession, sf: str) -> DataFrame:
    """Files before and blocks after, per directory label."""
    return archive.report(_archive(spark, sf), "dir_label")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every change of schema between consecutive dumps of a producer."""
    return drift.schema_changes(read_table(spark, sf, "jet_dumps"), read_table(spark, sf, "jets"))


def p5_jets_table(spark: SparkSession, sf: str) -> DataFrame:
    """The records of all dumps in the schema of jets."""
    return drift.unified(read_table(spark, sf, "jet_dumps"), read_table(spark, sf, "jets"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_jets_by_label, p1_components_by_flavour, p2_found, p2_jets_once, p2_archive_index, p2_lookup, p2_containers, p5_found, p5_jets_table)
}

SQL = {
    "p1_found": f"""
with v as (
  select 'jets.flavour_label' as field_name, cast(flavour_label as varchar) as field_value from jets
  union all select 'components.flavour', {CANON.format('flavour')} from components
), n as (select field_name, field_value, count(*) as n from v group by all),
t as (select field_name, count(*) as total from v group by all)
select field_name, field_value from n join t using (field_name) where field_value is not null and n * 8 > total""",
    "p1_jets_by_label": """
select flavour_label, count(*) as n_rows, count(distinct jet_id) as n_jets,
  sum(cast(pt as double)) filter (isfinite(pt)) as sum_pt,
  sum(cast(mass as double)) filter (isfinite(mass)) as sum_mass,
  sum(cast(pt_btagjes as double)) filter (isfinite(pt_btagjes)) as sum_pt_btagjes,
  min(pt) as min_pt, max(pt) as max_pt
from jets group by flavour_label""",
    "p1_components_by_flavour": f"""
select {CANON.format('flavour')} as flavour, count(*) as n_rows,
  cast(sum(num_jets) filter (num_jets > 0) as bigint) as sum_num_jets,
  cast(sum(num_jets_estimate_available) filter (num_jets_estimate_available > 0) as bigint) as sum_estimates
from components group by 1""",
    "p2_found": """
with l as (
  select file_id, file_format, string_split(payload, chr(10)) as lines from jet_files where payload is not null
), nd as (
  select file_id, unnest(lines) as line from l where file_format = 'ndjson'
), cs as (
  select file_id, list_position(string_split(lines[1], ','), 'jet_id') as place, len(string_split(lines[1], ',')) as width, unnest(list_slice(lines, 2, len(lines))) as line
  from l where file_format = 'csv'
), held as (
  select distinct file_id, jet_id from (
    select file_id, try_cast(json_extract_string(line, '$.jet_id') as bigint) as jet_id from nd where json_valid(line)
    union all
    select file_id, try_cast(list_extract(string_split(line, ','), place) as bigint) from cs where line <> '' and len(string_split(line, ',')) = width
  ) where jet_id is not null
)
select distinct a.file_id as file_a, b.file_id as file_b from held a join held b on a.jet_id = b.jet_id and a.file_id < b.file_id""",
    "p2_jets_once": f"""
with l as (
  select file_id, file_format, written_at, string_split(regexp_replace(payload, '\\r\\n?', chr(10), 'g'), chr(10)) as lines from jet_files where payload is not null
), x as (
  select file_id, file_format, written_at, unnest(lines) as line, generate_subscripts(lines, 1) - 1 as pos, string_split(trim(lines[1]), ',') as head from l
), nd as (
  select file_id, written_at, pos, try_cast(json_extract_string(line, '$.jet_id') as bigint) as jet_id, try_cast(json_extract_string(line, '$.pt') as double) as pt,
    try_cast(json_extract_string(line, '$.eta') as double) as eta, try_cast(json_extract_string(line, '$.flavour_label') as int) as flavour_label
  from x where file_format = 'ndjson' and trim(line) <> '' and json_valid(line)
), c as (
  select *, string_split(trim(line), ',') as cells from x where file_format = 'csv' and pos > 0 and trim(line) <> ''
), cs as (
  select file_id, written_at, pos, try_cast(list_extract(cells, list_position(head, 'jet_id')) as bigint) as jet_id, try_cast(list_extract(cells, list_position(head, 'pt')) as double) as pt,
    try_cast(list_extract(cells, list_position(head, 'eta')) as double) as eta, try_cast(list_extract(cells, list_position(head, 'flavour_label')) as int) as flavour_label
  from c where len(cells) = len(head)
), once as (
  select * from (select *, row_number() over (partition by jet_id order by written_at desc nulls last, file_id desc nulls last, pos desc) as version
    from (select * from nd union all select * from cs) where jet_id is not null) where version = 1
), n as (select flavour_label, ceil(count(*) / 1000000.0) as files from once group by flavour_label)
select once.flavour_label, cast(floor({md5_uniform_sql(11, 'jet_id')} * files) as int) as file_no, jet_id, pt, eta
from once join n on once.flavour_label is not distinct from n.flavour_label""",
    "p2_lookup": """
select file_id, file_path as path, payload, true as intact from jet_files where file_path in (select file_path from jet_files where file_id % 100 = 0)""",
    "p2_archive_index": """
select file_id, cast(octet_length(cast(payload as blob)) as int) as n_bytes, true as intact from jet_files""",
}
