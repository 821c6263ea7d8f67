"""Encoding, packing and the token store, against the tokenizers library and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from tracefold.llm import bpe, packing, token_store
from tracefold.llm.common import scratch_path
from tracefold.llm.queries import BYTE_BPE, END_ID, WORD_BPE, tokenizer

ODD = "abcXYZ  \n\t'sdtrellm0123459!?.,<|endoftext|>é́ÉßΣσ ς  　\x1c\x85日本語👍İKẞ٣½ŉ"


def library(name):
    return Library.from_file(str(public_tokenizers.path(name)))


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_encoder_equals_library(name, texts):
    own = bpe.ForcedBoundaryBPE(open(public_tokenizers.path(name), encoding="utf-8").read())
    lib, rng = library(name), random.Random(1)
    odd = ["".join(rng.choice(ODD) for _ in range(rng.randrange(60))) for _ in range(3000)]
    odd += ["a<|endoftext|>b<|startoftext|> c", "  <|endoftext|>  x", "it's IT'S !'s", "a" * 5000, "日" * 2000, "\n\n  \n x"]
    all_ = [t or "" for t in texts] + odd
    for text, ids in zip(all_, own.encode_many(all_), strict=True):
        want = lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        if name == BYTE_BPE:
            assert own.decode(ids) == lib.decode(want, skip_special_tokens=False)
    if name == BYTE_BPE:
        assert own.decode(np.array([200, 300], "<u4").tobytes()) == lib.decode([200, 300], skip_special_tokens=False)


def test_forced_pairs_never_lie_inside_a_token():
    own = bpe.ForcedBoundaryBPE(open(public_tokenizers.path(BYTE_BPE), encoding="utf-8").read())
    for token in own.token_bytes[:50256]:
        at = np.frombuffer(token, np.uint8)
        assert own.joined[at[:-1], at[1:]].all()


def test_small_memo_gives_the_same(monkeypatch, texts):
    monkeypatch.setattr(bpe, "MEMO_FRAGMENTS", 5)
    monkeypatch.setattr(bpe, "GROUP_BYTES", 100)
    own = bpe.ForcedBoundaryBPE(open(public_tokenizers.path(WORD_BPE), encoding="utf-8").read())
    lib = library(WORD_BPE)
    for text, ids in zip(texts * 2, own.encode_many(texts * 2), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text or "", add_special_tokens=False).ids


def test_encode_and_decode_columns(spark, docs, texts):
    df = docs(list(enumerate(texts)))
    own = tokenizer(spark, BYTE_BPE)
    out = bpe.decode(bpe.encode(df, own), own).collect()
    assert len(out) == len(texts)
    for row in out:
        assert row["decoded"] == (texts[row["doc_id"]] or "")
        assert row["kept"] == "xkept"
    assert bpe.encode(docs([]), own).count() == 0


def piece_ids(texts):
    lib = library(WORD_BPE)
    return {i: [*lib.encode(t or "", add_special_tokens=False).ids, END_ID] for i, t in enumerate(texts)}


@pytest.mark.parametrize("window", [7, 64, 4096])
def test_packing_covers_each_id_once(spark, docs, texts, window):
    want = piece_ids(texts)
    rows = packing.pack(docs(list(enumerate(texts))).repartition(3, "doc_id"), tokenizer(spark, WORD_BPE), END_ID, window).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(want)
    for doc, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            own = np.array(want[doc][at : at + p["length"]], "<u4").tobytes()
            assert (p["start"], p["ids_crc32"], p["doc_tokens"]) == (at, zlib.crc32(own), len(want[doc]))
            at += p["length"]
        assert at == len(want[doc])
    total = sum(map(len, want.values()))
    assert sorted(by_sequence) == list(range(-(-total // window)))
    for k, pieces in by_sequence.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == pieces[0]["sequence_tokens"] == min(window, total - k * window)


def test_packing_of_nothing_and_of_repeats(spark, docs):
    own = tokenizer(spark, WORD_BPE)
    assert packing.pack(docs([]), own, END_ID).count() == 0
    rows = packing.pack(docs([(None, "same"), (None, "same"), (1, None)]), own, END_ID).collect()
    assert len(rows) == 3 and sum(r["length"] for r in rows) == 2 + 2 + 1


def test_token_store_round_trip(spark, docs, texts, monkeypatch):
    want, ids = piece_ids(texts), list(enumerate(texts))
    random.Random(5).shuffle(ids)
    path = scratch_path(spark, "t")
    token_store.write_tokens(docs(ids), tokenizer(spark, WORD_BPE), END_ID, path, 3)
    tokens = token_store.read_tokens(spark, path)
    rows = {r["doc_id"]: r for r in token_store.token_digests(tokens).collect()}
    at = 0
    for doc in sorted(want):
        own = np.array(want[doc], "<u4").tobytes()
        assert (rows[doc]["start"], rows[doc]["n_tokens"], rows[doc]["ids_crc32"]) == (at, len(want[doc]), zlib.crc32(own))
        at += len(want[doc])
    one = tokens.where("doc_id = 20").collect()
    assert [x for r in sorted(one, key=lambda r: r["chunk"]) for x in r["ids"]] == want[20]


def test_token_store_chunks_long_documents(spark, docs):
    text = " ".join(str(k % 7) for k in range(token_store.CHUNK * 2 + 10))
    path = scratch_path(spark, "t")
    token_store.write_tokens(docs([(1, text), (0, None)]), tokenizer(spark, WORD_BPE), END_ID, path)
    tokens = token_store.read_tokens(spark, path)
    assert tokens.where("doc_id = 1").count() == 3
    want = np.array([*library(WORD_BPE).encode(text, add_special_tokens=False).ids, END_ID], "<u4").tobytes()
    row = token_store.token_digests(tokens).where("doc_id = 1").first()
    assert row["ids_crc32"] == zlib.crc32(want) and row["start"] == 1


def test_one_id_skips_strides(spark, docs):
    path = scratch_path(spark, "t")
    token_store.write_tokens(docs([(k, "a few words") for k in range(9000)]), tokenizer(spark, WORD_BPE), END_ID, path, 2)
    one = spark.read.orc(path).where("doc_id = 4321").select("doc_id", "ids")
    assert len(one.collect()) == 1
    scan = one._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().head()
    assert 0 < scan.metrics().apply("numOutputRows").value() <= 1000  # one stride of the 9,000 rows


def test_a_repeated_id_is_spread(spark, docs):
    path = scratch_path(spark, "t")
    token_store.write_tokens(docs([(None if k % 3 else 7, f"{k} words") for k in range(3000)]), tokenizer(spark, WORD_BPE), END_ID, path, 4)
    tokens = token_store.read_tokens(spark, path)
    parts = [r["n"] for r in spark.read.orc(path).groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert len(parts) == 4 and max(parts) < 1500
    rows = sorted(token_store.token_digests(tokens).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None] * 2000 + [7] * 1000
    assert all(x["start"] + x["n_tokens"] == y["start"] for x, y in zip(rows, rows[1:], strict=False))


def test_token_store_of_nothing(spark, docs):
    path = scratch_path(spark, "t")
    token_store.write_tokens(docs([]), tokenizer(spark, WORD_BPE), END_ID, path)
    assert token_store.token_digests(token_store.read_tokens(spark, path)).count() == 0


def test_checksums_combine():
    rng = random.Random(2)
    parts = [rng.randbytes(rng.randrange(50)) for _ in range(6)]
    assert token_store.combined([{"chunk": k, "crc": zlib.crc32(p), "bytes": len(p)} for k, p in enumerate(parts)]) == zlib.crc32(b"".join(parts))


def test_query_digests(spark, texts):
    own = tokenizer(spark, BYTE_BPE)
    row = bpe.encode(spark.createDataFrame([(1, "Hello  world")], "doc_id long, text string"), own).select(F.sha2("ids", 256)).first()[0]
    assert row == hashlib.sha256(np.array(library(BYTE_BPE).encode("Hello  world").ids, "<u4").tobytes()).hexdigest()
