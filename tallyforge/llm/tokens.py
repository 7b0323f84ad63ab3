"""Encoding a corpus with a public byte-level BPE vocabulary (problem 6).

A text is cut by the vocabulary's pattern; a piece starts as its bytes, and the adjacent pair of lowest rank is
merged, the leftmost of equals, until no pair has a rank. The ranks of a piece's adjacent pairs are the leaves of a
segment tree whose root is the next merge; a merge changes three leaves, so a piece of n bytes takes n log n steps.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tallyforge.session import spread

#: Folder of the public vocabularies.
VOCABULARIES = "/opt/tokenizers"

# Fixed value: the public pattern that cuts a text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Rank of a pair that no merge makes: above all ranks.
NO_RANK = 1 << 30

#: A worker keeps the ids of this many pieces of at most this many characters; others are encoded again when met.
CACHE_PIECES, CACHE_CHARS = 300_000, 64


def load_ranks(name: str, folder: str = VOCABULARIES) -> dict[bytes, int]:
    """Token bytes to id of a vocabulary given as a rank file."""
    path = Path(folder) / f"{name}.tiktoken"
    if not path.exists():
        raise ValueError(f"no rank file for tokenizer {name!r} in {folder}")
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in path.read_bytes().splitlines() if line)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece by lowest-rank merges over a segment tree of its adjacent pairs."""
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    get, width = ranks.get, n - 1
    none = NO_RANK * width
    # Leaf width + i: rank of the pair that starts at byte i, then i as the tie-break; inner nodes: the smaller child.
    leaves = [get(piece[i : i + 2], NO_RANK) * width + i for i in range(width)]
    tree = leaves + leaves
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    end = list(range(1, n + 1))  # of the token that starts here
    before = list(range(-1, width))
    while (root := tree[1]) < none:
        i = root % width
        gone = end[i]
        stop = end[i] = end[gone]
        changed = [(i, get(piece[i : end[stop]], NO_RANK) if stop < n else NO_RANK)]
        if stop < n:
            before[stop] = i
        if gone < width:
            changed.append((gone, NO_RANK))
        if (left := before[i]) >= 0:
            changed.append((left, get(piece[left:stop], NO_RANK)))
        for leaf, rank in changed:
            k = width + leaf
            low = tree[k] = rank * width + leaf
            while k > 1:
                other = tree[k ^ 1]
                if other < low:
                    low = other
                k >>= 1
                if tree[k] == low:
                    break
                tree[k] = low
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


# White space and the word after it: pieces never cross from a word into the white space that follows.
# The four separators that only one of the two regex libraries takes for white space count as word here.
CHUNK = r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+\Z"


class Encoder:
    """Encodes texts in one worker, with the ids of the chunks and pieces met so far."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.chunks, self.pieces = ranks, re.compile(CHUNK).findall, regex.compile(PATTERN).findall
        self.known_chunks: dict[str, array] = {}
        self.known_pieces: dict[str, list[int]] = {}

    def chunk(self, text: str) -> array:
        ids = array("i")
        for p in self.pieces(text):
            if (made := self.known_pieces.get(p)) is None:
                made = self._keep(self.known_pieces, p, merge_piece(p.encode("utf-8"), self.ranks))
            ids.extend(made)
        return self._keep(self.known_chunks, text, ids)

    @staticmethod
    def _keep(known: dict, text: str, ids):
        if len(text) <= CACHE_CHARS:
            if len(known) >= CACHE_PIECES:
                known.clear()
            known[text] = ids
        return ids

    def extend(self, out: array, text: str) -> None:
        known, extend = self.known_chunks.get, out.extend
        for c in self.chunks(text):
            extend(known(c) or self.chunk(c))


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = VOCABULARIES, counts_only: bool = False) -> DataFrame:
    """``key`` and ids (array<int>) of every text, or n_tokens with ``counts_only``.

    Special tokens get no ids of their own: their strings are ordinary text. Null and empty texts give an empty list
    and 0 tokens. Whole texts are encoded, of any length; repeated rows come out repeated; other columns are left
    out, and an empty table gives no rows. The vocabulary, of fixed size, is broadcast.
    """
    spark: SparkSession = docs.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(tokenizer, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value)
        for batch in batches:
            ids, ends = array("i"), [0]
            for t in batch.column("__text").to_pylist():
                if t:
                    encoder.extend(ids, t)
                if counts_only:
                    ends.append(ends[-1] + len(ids))
                    del ids[:]
                else:
                    ends.append(len(ids))
            bounds = np.array(ends, np.int64)
            if counts_only:
                made = pa.array(np.diff(bounds).astype(np.int32))
            else:
                made = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(np.frombuffer(ids, np.int32) if ids else np.array([], np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("__key"), made], names=["__key", "__made"])

    kind = docs.schema[key].dataType.simpleString()
    made = spread(docs.select(docs[key].alias("__key"), docs[text].alias("__text"))).mapInArrow(run, f"__key {kind}, __made {'int' if counts_only else 'array<int>'}")
    return made.toDF(key, "n_tokens" if counts_only else "ids")
