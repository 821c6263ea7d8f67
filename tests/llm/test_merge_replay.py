"""Merge replay against the tiktoken library, with the vocabulary file and with invented ones."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tracefold.llm import merge_replay, queries

ODD = "abcXYZ  \n\t'sdtrellm0123459!?.,<|endoftext|>é́ÉßΣσ ς  　\x1c\x85日本語👍İKẞ٣½ŉ\r\x0b"


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(merges, texts):
    ids, counts = merges.encode_array(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


@pytest.fixture(scope="module")
def merges():
    return merge_replay.Merges(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read(), public_tokenizers.PATTERN)


def test_equals_library(merges, texts):
    rng, lib = random.Random(1), library(merges.rank_of)
    all_ = [*texts, *("".join(rng.choice(ODD) for _ in range(rng.randrange(60))) for _ in range(3000))]
    all_ += ["it's IT'S !'s", "a" * 5000, "日" * 2000, "\n\n  \n x", " " * 300, "<|endoftext|>", "\xa0 x\xa0", "ab" * 40_000]
    for text, ids in zip(all_, encoded(merges, all_), strict=True):
        assert ids == lib.encode_ordinary(text or ""), text
    ids, counts = merges.encode_array(pa.array(all_, pa.string()))
    assert merges.decode_array(ids, counts).to_pylist() == [(t or "").encode() for t in all_]
    assert encoded(merges, ["x"]) == [lib.encode_ordinary("x")]
    assert [len(x) for x in merges.encode_array(pa.array([], pa.string()))] == [0, 0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=2, max_size=6), max_size=30, unique=True), st.lists(st.text("abc ", max_size=30), max_size=12), st.randoms())
def test_ranks_in_any_order(tokens, texts, rng):
    """Ids that aren't in order of training, so that a merge can bring up a pair of lower rank."""
    all_ = [bytes([b]) for b in range(256)] + [t.encode() for t in tokens]
    order = list(range(len(all_)))
    rng.shuffle(order)
    ranks = dict(zip(all_, order, strict=True))
    own = merge_replay.Merges(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items()), public_tokenizers.PATTERN)
    lib = library(ranks)
    for text, ids in zip(texts, encoded(own, texts), strict=False):
        assert ids == lib.encode_ordinary(text)


def test_only_touched_places_are_looked_up(merges):
    """Work follows the merges, not words times ranks: a long word and its copy cost what their symbols cost."""
    long = bytes(random.Random(2).choices(b"aeioustnr", k=20_000))
    ids, counts = merges.replay([long, b"", long[:10_000]])
    assert counts.sum() == len(ids) and counts[1] == 0
    assert b"".join(merges.tokens[i] for i in ids[: counts[0]]) == long


def test_unknown_ids_are_an_error(merges):
    with pytest.raises(ValueError):
        merges.decode_array(np.array([50256], np.int32), np.array([1]))


@pytest.mark.parametrize("slice_bytes", [1, 700, 1 << 20])
def test_columns(spark, docs, texts, monkeypatch, slice_bytes):
    monkeypatch.setattr(merge_replay, "SLICE_BYTES", slice_bytes)
    rows = [*enumerate(texts), (3, texts[3]), (None, "null id")]
    df = docs(rows)
    ranks = queries.ranks(spark)
    out = merge_replay.decode(merge_replay.encode(df, ranks), ranks)
    assert out.columns == [*(c for c in df.columns if c != "ids"), "ids", "decoded"]
    lib = library(ranks.get().rank_of)
    got = sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in out.collect())
    assert got == sorted((str(i), lib.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert merge_replay.decode(merge_replay.encode(docs([]), ranks), ranks).count() == 0


def test_slices_hold_every_row_once():
    rng = random.Random(5)
    values = [None if rng.random() < 0.1 else "x" * rng.choice([0, 1, 5, 40]) for _ in range(300)]
    batches = [pa.RecordBatch.from_pydict({"t": pa.array(values[k : k + 70], pa.string())}) for k in range(0, 300, 70)]
    for most in (1, 30, 100, 10_000):
        tables = list(merge_replay.in_slices(iter(batches), "t", most))
        assert [x for t in tables for x in t.column("t").to_pylist()] == values
        assert all(t.num_rows and (t.num_rows == 1 or sum(len(x or "") for x in t.column("t").to_pylist()) <= most) for t in tables)


def test_query(spark):
    got = {r.doc_id: r for r in queries.op12_merge_replay(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    lib = library(queries.ranks(spark).get().rank_of)
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = lib.encode_ordinary(text or "")
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
