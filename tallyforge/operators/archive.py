"""Many tiny files into few large ones (problem 2).

``pack`` lays the original bytes of many files into large blocks; every block carries an index of path, offset,
length and checksum. ``write`` stores blocks, a directory per group, and ``unpack`` gives every file back, byte for
byte, from any block on its own, so blocks are read in parallel; ``lookup`` fetches single files. ``records`` reads
the packed files, and ``compact`` lays their records out as a few well-sized files per label, each record once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.randomness import hash_uniform, md5_uniform
from tallyforge.session import bounded, stored

#: Bytes of a block, and blocks that are cut from one shard (the rows sorted together).
BLOCK_BYTES = 16 << 20
BLOCKS_PER_SHARD = 16


def pack(files: DataFrame, group: str, path: str, payload: str, meta: list[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks (``group``, shard, block_no, n_files, n_bytes, block, entries) of about ``block_bytes`` each.

    A group's files are hashed into shards of a bounded number of bytes, and each shard is cut into blocks, so
    that no group, however large, meets in one task. A file larger than a block stays whole. Null payloads are
    kept as such (length null, no bytes), empty ones as length 0; a null group is a group of its own. The columns
    named in ``meta`` travel in the index; all others are left out. An empty table gives no blocks.
    """
    data = files.select(
        F.col(group).alias("__group"),
        F.col(path).alias("__path"),
        F.struct(*meta).alias("__meta"),
        F.col(payload).cast("binary").alias("__bytes"),
    ).withColumn("__len", F.octet_length("__bytes"))
    shards = bounded(
        files.groupBy(F.col(group).alias("__g"))
        .agg(F.ceil(F.sum(F.octet_length(payload)) / F.lit(block_bytes * BLOCKS_PER_SHARD)).alias("__shards"))
    )
    before = Window.partitionBy("__group", "__shard").orderBy("__path", "__len").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        data.join(shards, on=F.col("__group").eqNullSafe(F.col("__g")), how="inner")
        .withColumn("__shard", F.floor(hash_uniform(5, "__path") * F.greatest(F.coalesce("__shards", F.lit(1)), F.lit(1))).cast("int"))
        .withColumn("__start", F.coalesce(F.sum("__len").over(before), F.lit(0)))
        .withColumn("__block", F.floor(F.col("__start") / F.lit(block_bytes)).cast("int"))
    )
    file = F.struct(
        F.col("__start").alias("start"),
        F.col("__path").alias("path"),
        F.col("__len").alias("length"),
        F.sha2(F.col("__bytes"), 256).alias("checksum"),
        F.col("__meta").alias("meta"),
        F.col("__bytes").alias("bytes"),
    )
    parts = placed.groupBy("__group", "__shard", "__block").agg(F.array_sort(F.collect_list(file), _by_start).alias("__files"))
    first = F.element_at("__files", 1)["start"]
    entries = F.transform(
        "__files",
        lambda f: F.struct(f["path"].alias("path"), (f["start"] - first).alias("offset"), f["length"].alias("length"), f["checksum"].alias("checksum"), f["meta"].alias("meta")),
    )
    bodies = F.filter(F.transform("__files", lambda f: f["bytes"].cast("string")), lambda s: s.isNotNull())
    return parts.select(
        F.col("__group").alias(group),
        F.col("__shard").alias("shard"),
        F.col("__block").alias("block_no"),
        F.size("__files").alias("n_files"),
        F.array_join(bodies, "").cast("binary").alias("block"),
        entries.alias("entries"),
    ).withColumn("n_bytes", F.octet_length("block"))


def write(blocks: DataFrame, path: str) -> None:
    """Stores blocks as containers: a row group has few blocks, so that readers take them one by one."""
    blocks.write.option("compression", "zstd").option("parquet.block.size", 4 * BLOCK_BYTES).mode("overwrite").parquet(path)


def packed(files: DataFrame, group: str, path: str, payload: str, meta: list[str]) -> DataFrame:
    """The files' blocks, written to the shared folder and read back."""
    return stored(pack(files, group, path, payload, meta), "archive")


def report(blocks: DataFrame, group: str) -> DataFrame:
    """Per ``group``: files put in, bytes of them, blocks that hold them, and the largest block."""
    return blocks.groupBy(group).agg(
        F.sum("n_files").cast("bigint").alias("n_files"), F.sum("n_bytes").cast("bigint").alias("n_bytes"), F.count(F.lit(1)).alias("n_blocks"), F.max("n_bytes").alias("largest_block")
    )


def _by_start(a: Column, b: Column) -> Column:
    """Order of files within a block: by start, files without bytes before the file that starts at the same place."""
    key = lambda f: F.struct(f["start"], F.coalesce(f["length"], F.lit(0)), f["path"])
    return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks, lists = batch.column("block"), batch.column("entries")
        entries, owner = lists.flatten(), pc.list_parent_indices(lists).to_pylist()
        column = lambda name: entries.field(entries.type.get_field_index(name))
        views = [memoryview(b.as_buffer()) if b.is_valid else memoryview(b"") for b in blocks]
        bodies, intact = [], []
        for i, offset, length, checksum in zip(owner, column("offset").to_pylist(), column("length").to_pylist(), column("checksum").to_pylist(), strict=True):
            body = None if length is None else views[i][offset : offset + length]
            bodies.append(body)
            intact.append(checksum is None if body is None else hashlib.sha256(body).hexdigest() == checksum)
        meta = column("meta")
        yield pa.RecordBatch.from_arrays(
            [column("path"), pa.array(bodies, pa.binary()), pa.array(intact), *meta.flatten()], names=["path", "bytes", "intact", *[f.name for f in meta.type]]
        )


def unpack(blocks: DataFrame) -> DataFrame:
    """Every file of the blocks: path, payload, ``intact`` (does the checksum hold) and the columns of its meta.

    Blocks are cut in Python: Spark's substring copies a whole block for every file in it.
    """
    entry = blocks.schema["entries"].dataType.elementType
    meta = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entry["meta"].dataType)
    path = entry["path"].dataType.simpleString()
    files = blocks.select("block", "entries").mapInArrow(_cut, f"path {path}, bytes binary, intact boolean, {meta}")
    return files.withColumn("payload", F.col("bytes").cast("string")).drop("bytes")


def lookup(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """The files whose path is in ``paths`` (one column, path): the index is searched, only blocks with hits are cut."""
    wanted = paths.select(F.col("path").alias("__p")).distinct()
    at = ["shard", "block_no", blocks.columns[0]]
    index = blocks.select(*at, F.explode("entries").alias("e"))
    hits = index.join(wanted, on=F.col("e.path") == F.col("__p"), how="left_semi").groupBy(*at).agg(F.collect_list("e").alias("entries"))
    same = [hits[c].eqNullSafe(blocks[c]) for c in at]
    return unpack(blocks.select(*at, "block").join(hits, on=same, how="inner").select("block", "entries"))


def records(files: DataFrame, payload: str = "payload", kind: str = "file_format") -> DataFrame:
    """The complete records of files of type ``ndjson`` or ``csv`` with a header line: adds jet_id, pt, eta, flavour_label, pos.

    A JSON line is complete if it parses and has a jet_id, a CSV line if it has as many fields as the header and a
    jet_id. Blank lines, cut-off records, null and empty files give no rows; fields may lie in any order, missing
    or unreadable numbers are null. Lines may end in CR LF.
    """
    keep = [c for c in files.columns if c != payload]
    is_json, is_csv = F.col(kind) == "ndjson", F.col(kind) == "csv"
    lines = files.where(is_json | is_csv).withColumn("__lines", F.split(F.regexp_replace(F.col(payload), "\r\n?", "\n"), "\n"))
    head = F.when(is_csv, F.split(F.trim(F.element_at("__lines", 1)), r"\s*,\s*"))
    each = (
        lines.select(*keep, head.alias("__head"), F.posexplode("__lines").alias("pos", "__line"))
        .where((F.trim("__line") != "") & (is_json | (F.col("pos") > 0)))
        .withColumn("__v", F.when(is_json, F.try_parse_json("__line")))
        .withColumn("__cells", F.when(is_csv, F.split(F.trim("__line"), r"\s*,\s*")))
        .where(F.col("__v").isNotNull() | (F.size("__cells") == F.size("__head")))
    )

    def field(name: str, to: str) -> Column:
        place = F.nullif(F.array_position("__head", F.lit(name)).cast("int"), F.lit(0))
        return F.when(is_json, F.try_variant_get("__v", f"$.{name}", to)).otherwise(F.get("__cells", place - 1).try_cast(to))

    return each.select(*keep, "pos", *[field(c, t).alias(c) for c, t in RECORD]).where(F.col("jet_id").isNotNull())


#: The fields of a record and their types.
RECORD = [("jet_id", "bigint"), ("pt", "double"), ("eta", "double"), ("flavour_label", "int")]


def compact(recs: DataFrame, key: str, label: str, newest: list[str], rows_per_file: int = 1_000_000) -> DataFrame:
    """Each ``key`` once, its newest version by the columns ``newest``, with ``file_no`` within its ``label``.

    A label's records are spread by md5 of seed and key over ceil(rows / ``rows_per_file``) files of nearly equal size; write them
    with ``partitionBy(label, "file_no")``. A null label is a label of its own; rows with a null key are dropped as
    they name no record. Ties in ``newest`` are broken by the values themselves.
    """
    rest = [c for c in recs.columns if c not in {key, *newest}]
    once = (
        recs.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(*newest, *rest)).alias("__r"))
        .select(key, *[F.col(f"__r.{c}").alias(c) for c in recs.columns if c != key])
    )
    n = bounded(once.groupBy(F.col(label).alias("__l")).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("__files")))
    return (
        once.join(n, on=F.col(label).eqNullSafe(F.col("__l")), how="inner")
        .withColumn("file_no", F.floor(md5_uniform(11, key) * F.col("__files")).cast("int"))
        .drop("__l", "__files")
    )
