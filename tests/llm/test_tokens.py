import random
from array import array

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import tokens

RANKS = tokens.load_ranks("byte_bpe_50k")
OTHER = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = tokens.Encoder(RANKS)


def ids(text):
    out = array("i")
    ENCODER.extend(out, text)
    return list(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=60))
def test_any_text(text):
    assert ids(text) == OTHER.encode_ordinary(text)


def test_white_space_and_specials():
    rng = random.Random(4)
    letters = list("ab c\n\t\r  .'s1é  \x1c\x1d\x85漢🙂<|endoftext|>_-Z")
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert ids(text) == OTHER.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "<|endoftext|>", " " * 999 + "x", "é" * 700, "=" * 2000, "\n" * 50])
def test_long_pieces(text):
    assert ids(text) == OTHER.encode_ordinary(text)


def test_merges_take_the_lowest_rank_and_then_the_leftmost():
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"bc": 3, b"aa": 4, b"abc": 5}
    assert tokens.merge_piece(b"aaabc", ranks) == [4, 5]
    assert tokens.merge_piece(b"aaa", ranks) == [4, 0]
    assert tokens.merge_piece(b"a", ranks) == [0] and tokens.merge_piece(b"", ranks) == []


def test_table(spark):
    rows = [(1, "hello world", 7), (2, None, 7), (3, "", 7), (3, "", 7), (None, " x", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = sorted(((r["doc_id"], list(r["ids"])) for r in tokens.encode(df).collect()), key=str)
    assert got == sorted([(1, OTHER.encode_ordinary("hello world")), (2, []), (3, []), (3, []), (None, OTHER.encode_ordinary(" x"))], key=str)
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.encode(df, counts_only=True).collect()}
    assert counts == {1: 2, 2: 0, 3: 0, None: len(OTHER.encode_ordinary(" x"))}
    assert tokens.encode(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        tokens.encode(df, tokenizer="none")


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 2)
    encoder = tokens.Encoder(RANKS)
    out = array("i")
    text = "one two three one two three " * 5 + "x" * 200
    encoder.extend(out, text)
    assert list(out) == OTHER.encode_ordinary(text)


def test_corpus(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r["doc_id"]: list(r["ids"]) for r in tokens.encode(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        assert got[r["doc_id"]] == OTHER.encode_ordinary(r["text"] or "")
