"""Template residue and error-page text (problem 8).

Every document is taken apart into the pieces that may hold something else than content. Trusted labels come from
the form of a piece (``residue_rules``), never from its sentence. Near-duplicates of labelled sentences are found with
partitioned SimHash tables and with an exact join on prefixes of their sets of word shingles, verified by the
similarity of these sets, and the labels are passed on along these links, set by set, until a whole connected
component has them. Sentences too short for shingles are also alike if they are spliced of labelled ones. A document
with a labelled piece is residue, and so are its copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.commit_parts import pieces
from tallyforge.llm.residue_rules import judge
from tallyforge.session import bounded, cut_lineage, spread

#: Words of a shingle, and the least share of common shingles of near-duplicates.
SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Most bits in which signatures from the SimHash tables differ. 64 bits are cut into five blocks; two of them are then equal.
HAMMING = 3
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Least share of a sentence's pieces whose form must tell the label, for the sentence to have it.
TRUSTED = 0.05
#: Labelled sets that are tried first for each key, and most rows of a table of their keys that is broadcast.
SOME, BROADCAST_ROWS = 8, 100_000
#: Least words of a sentence that may be spliced of two labelled ones.
SPLICED_WORDS = 4
#: A worker keeps the labels of this many pieces.
CACHE_PIECES = 200_000
#: Bits are counted for this many shingles at a time.
SHINGLES_AT_ONCE = 100_000


def shingles(piece: str) -> list[int]:
    """Hashes of the piece's word shingles, lower case, digits alike; of all its words if they are fewer than a shingle."""
    words = "".join("0" if c.isdigit() else c for c in piece.lower()).split()
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    digest = xxhash.xxh64_intdigest
    return list(dict.fromkeys(digest(" ".join(words[i : i + SHINGLE_WORDS])) for i in range(n)))


def signatures(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SimHash of each run of ``hashes`` (64 bits each): a bit is set if most of the run's hashes have it."""
    votes = np.zeros((len(starts), 64), np.int64)
    owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(hashes)]))
    place = np.arange(64, dtype=np.uint64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at : at + SHINGLES_AT_ONCE, None]
        bits = ((part >> place) & np.uint64(1)).astype(np.int32) * 2 - 1
        whose, first = np.unique(owner[at : at + SHINGLES_AT_ONCE], return_index=True)
        votes[whose] += np.add.reduceat(bits, first, axis=0)
    return ((votes > 0).astype(np.uint64) << place).sum(axis=1, dtype=np.uint64)


def _int32(hashes: np.ndarray) -> pa.Array:
    return pa.array((hashes >> np.uint64(32)).astype(np.uint32).view(np.int32))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[str | None, str, bool]] = {}
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        source, parts, labels, runs, flat, word_ends, words = [], [], [], [], [], [0], []
        for row, text in enumerate(batch.column("__text").to_pylist()):
            for part, piece in pieces(text):
                if piece not in known:
                    if len(known) >= CACHE_PIECES:
                        known.clear()
                    known[piece] = judge(piece)
                found, sentence, alone = known[piece]
                source.append(row)
                parts.append(part)
                labels.append(found)
                runs.append(len(flat))
                flat.extend([digest(f"\0{sentence}")] if alone else shingles(sentence))
                words.extend([] if alone else map(digest, sentence.split()))
                word_ends.append(len(words))
        hashed = np.array(flat, np.uint64)
        signs = signatures(hashed, np.array(runs, np.int64)) if runs else np.array([], np.uint64)
        sets = pa.ListArray.from_arrays(pa.array([*runs, len(flat)], pa.int32()), _int32(hashed))
        spoken = pa.ListArray.from_arrays(pa.array(word_ends, pa.int32()), _int32(np.array(words, np.uint64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("__key").take(pa.array(source, pa.int32())), pa.array(parts, pa.string()), pa.array(labels, pa.string()), pa.array(signs.view(np.int64)), sets, spoken],
            names=["__key", "part", "label", "signature", "shingles", "words"],
        )


def signed_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of every document: ``key``, part, label (what the piece's form tells), and of its sentence signature, shingles and words.

    shingles and words are hashes. A piece that only equal texts are copies of has one shingle of its own and no words.
    """
    kind = docs.schema[key].dataType.simpleString()
    made = spread(docs.select(docs[key].alias("__key"), docs[text].alias("__text"))).mapInArrow(
        _signed, f"__key {kind}, part string, label string, signature bigint, shingles array<int>, words array<int>"
    )
    return made.withColumnRenamed("__key", key)


def _set() -> Column:
    """The shingles as a set in an order that all pieces share."""
    return F.sort_array(F.array_distinct("shingles"))


def _keys(rows: DataFrame) -> DataFrame:
    """Each set once per key that near-duplicates may share: set_id, key, signature (for slots of the SimHash tables), size (for shingles).

    A slot says which two blocks of the signature are meant and what they hold. Shingles are those of the set's prefix:
    sets of similarity s share at least s * size of either, so all but so many less one of the first shingles of each
    hold a common one, and pairs that are alike always meet.
    """
    cut = [F.shiftrightunsigned("signature", at).bitwiseAND(F.lit((1 << width) - 1)) for at, width in BLOCKS]
    slots = [F.shiftleft(F.lit(k + 1).cast("bigint"), 40) + F.shiftleft(cut[a], 13) + cut[b] for k, (a, b) in enumerate(combinations(range(len(BLOCKS)), 2))]
    of = rows.select("set_id", "signature", F.array(*slots).alias("slots"), _set().alias("set")).withColumn("size", F.size("set"))
    needed = F.ceil(SIMILARITY * F.col("size") - 1e-9).cast("int")
    prefix = F.slice("set", F.lit(1), F.col("size") - needed + 1).cast("array<bigint>")
    each = of.select("set_id", "signature", "size", F.explode(F.concat("slots", prefix)).alias("key"))
    return each.select("set_id", "key", F.when(_is_slot(), F.col("signature")).alias("signature"), F.when(~_is_slot(), F.col("size")).alias("size"))


def _is_slot() -> Column:
    return F.col("key") >= F.lit(1 << 40)


def _alike(keys: DataFrame, known: DataFrame, others: DataFrame) -> DataFrame:
    """set_id and label of ``others`` that share one of ``keys`` (of ``known``) and are alike in truth."""
    far = F.bit_count(F.col("signature").bitwiseXOR(F.col("known_signature"))) > HAMMING
    other_size = F.least("size", "known_size") < SIMILARITY * F.greatest("size", "known_size") - 1e-9
    theirs = keys.withColumnsRenamed({"set_id": "known_id", "signature": "known_signature", "size": "known_size"})
    met = _keys(others).join(bounded(theirs, BROADCAST_ROWS), "key").where(~F.coalesce(far, other_size)).select("set_id", "known_id").distinct()
    x = known.select(F.col("set_id").alias("known_id"), "label", F.col("shingles").alias("known_shingles"))
    y = others.select("set_id", "shingles")
    alike = F.size(F.array_intersect("shingles", "known_shingles")) >= SIMILARITY * F.size(F.array_union("shingles", "known_shingles")) - 1e-9
    return met.join(x, "known_id").join(y, "set_id").where(alike).groupBy("set_id").agg(F.min("label").alias("label"))


def near_labelled(known: DataFrame, others: DataFrame) -> DataFrame:
    """set_id and label of the ``others`` that are near-duplicates of ``known`` (both: set_id, signature, shingles; known: label).

    The SimHash tables give the pairs within HAMMING bits, the prefixes every pair of at least SIMILARITY. One set that
    is alike is enough for a label: first at most SOME sets of ``known`` are tried for each key, and for keys that more
    of them share, what is left of ``others`` is compared with all. The result is stored.
    """
    keys = cut_lineage(_keys(known))
    some = keys.groupBy("key", F.pmod(F.xxhash64("set_id"), F.lit(SOME)).alias("k")).agg(F.min(F.struct("set_id", "signature", "size")).alias("s"), F.count(F.lit(1)).alias("n"))
    first = cut_lineage(_alike(some.select("key", "s.*"), known, others))
    more = keys.join(some.where("n > 1").select("key").distinct(), "key", "left_semi")
    if more.isEmpty():
        return first
    return first.unionByName(cut_lineage(_alike(more, known, others.join(first, "set_id", "left_anti"))))


def _spread_labels(last: DataFrame, others: DataFrame) -> DataFrame:
    """set_id and label of ``last`` and of all ``others`` that labels reach along links.

    Labels move one link at a time from the sets that got one last, so every set is compared as a labelled one once;
    each round is checkpointed, so that neither plans nor lost executors bring rounds back. It ends with the first
    round that reaches nothing new.
    """
    reached = last.select("set_id", "label")
    while True:
        new = near_labelled(last, others)
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new)
        last = others.join(new, "set_id")
        others = others.join(new, "set_id", "left_anti")


def spliced(known: DataFrame, others: DataFrame) -> DataFrame:
    """set_id and label of the ``others`` made up of the beginning of one labelled sentence and the end of another.

    So the short messages of a server are alike though their word shingles are not: "the page hit a limit" has the
    beginning of "the page was moved" and the end of "the host hit a limit". Of at least SPLICED_WORDS words, and of
    errors and notices alone. First and last words are compared first, so that few sentences are cut at every place.
    """
    able = F.size("words") >= 2
    of = known.where(F.col("label").isin("error", "notice") & able).select("label", "words")
    open_, close = F.element_at("words", 1), F.element_at("words", -1)
    ends = others.where(F.size("words") >= SPLICED_WORDS).select("set_id", "words", open_.alias("open"), close.alias("close"))
    ends = ends.join(of.select(open_.alias("open")).distinct(), "open", "left_semi").join(of.select(close.alias("close")).distinct(), "close", "left_semi")
    places = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("at")
    head, tail = F.xxhash64(F.expr("slice(words, 1, at)")).alias("head"), F.xxhash64(F.expr("slice(words, at + 1, size(words))")).alias("tail")
    cut = of.select("label", "words", places)
    heads = cut.select(head).distinct()
    tails = cut.select(tail, "label").groupBy("tail").agg(F.min("label").alias("label"))
    tried = ends.select("set_id", "words", places).select("set_id", head, tail)
    return tried.join(heads, "head", "left_semi").join(tails, "tail").groupBy("set_id").agg(F.min("label").alias("label"))


def labelled_sets(signed: DataFrame) -> DataFrame:
    """set_id and label of every set of shingles that a trusted label reaches; ``signed``: stored rows of ``signed_pieces`` with set_id.

    Pieces of equal shingle sets are one node, so that many of them make no pairs. A set has the label that the form of
    its pieces tells if that is so for at least TRUSTED of them: a sentence that is mostly used otherwise was only quoted.
    Sentences spliced of such ones come next; from all of these, labels pass along the links.
    """
    told = F.count("label") >= TRUSTED * F.count(F.lit(1))
    one = signed.groupBy("set_id").agg(
        F.when(told, F.min("label")).alias("label"), F.first("signature").alias("signature"), F.min("shingles").alias("shingles"), F.min("words").alias("words")
    )
    nodes = cut_lineage(one)
    known, others = nodes.where("label is not null"), nodes.where("label is null").drop("label")
    more = cut_lineage(spliced(known, others))
    return _spread_labels(known.unionByName(others.join(more, "set_id"), allowMissingColumns=True), others.join(more, "set_id", "left_anti"))


def residue(docs: DataFrame, key: str = "doc_id", text: str = "text", links: bool = True) -> DataFrame:
    """The documents that hold residue: ``key`` and labels (sorted: error, filler, notice, placeholder), each key once.

    Null, empty and blank texts hold none. Whole texts are judged, of any length; rows that repeat a key count
    together; other columns are left out; an empty table gives no rows. A null key is a document of its own.
    Every link between pieces whose shingle sets are alike by SIMILARITY is followed; without ``links``, only pieces
    whose own form tells the label are found.
    """
    signed = signed_pieces(docs, key, text)
    label = F.col("label")
    if links:
        signed = cut_lineage(signed.withColumn("set_id", F.xxhash64(_set())))
        by_set = labelled_sets(signed).withColumnRenamed("label", "set_label")
        signed, label = signed.select(key, "set_id", "label").join(by_set, "set_id", "left"), F.coalesce("label", "set_label")
    return signed.where(label.isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(label)).alias("labels"))


def without_residue(docs: DataFrame, marked: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents of ``docs`` without residue, all their columns; null keys are kept unless marked."""
    return docs.join(marked.select(F.col(key).alias("__bad")), on=F.col(key).eqNullSafe(F.col("__bad")), how="left_anti")
