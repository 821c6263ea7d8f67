"""Alignment of two tokenizers against a plain walk over byte offsets, with the libraries' own ids."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from tracefold.llm import alignment, bpe, queries

AWKWARD = ["<|endoftext|> a<|endoftext|>", "<s>x</s> <unk> <0x41>", "it's  two   spaces", "日本語 👍 x\n\ny\t", "ﬁ ligature ½ Å", "x" * 3000, "\x00 a \x1c", "▁ mark▁", " lead", "QmFzZTY0LXN0cmluZw==" * 40]


@pytest.fixture(scope="module")
def libraries():
    a = Library.from_file(str(public_tokenizers.path(queries.BYTE_BPE)))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(queries.PIECES)))


def walked(text, libraries):
    """(ids of A, ids of B, groups as pairs of lists) of a text, one byte offset after the other."""
    if not text:
        return [], [], []
    byte_of = {c: b for b, c in enumerate(bpe.byte_alphabet())}
    a, b = libraries
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
    parts_b = [bytes([int(p[3:5], 16)]) if (p := b.id_to_piece(i)).startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for i in ids_b]
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return [], [], []
    ends_a, ends_b = np.cumsum([len(x) for x in parts_a]).tolist(), np.cumsum([len(x) for x in parts_b]).tolist()
    groups, i, j = [], 0, 0
    for end in sorted({*ends_a} & {*ends_b}):
        k, m = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((ids_a[i:k], ids_b[j:m]))
        i, j = k, m
    return ids_a, ids_b, groups


def expected(rows, libraries):
    """The query's rows for (doc_id, text), links expanded one by one."""
    every = [(i, *walked(t, libraries)) for i, t in rows]
    links = [[(x, y) for a, b in groups for x in a for y in b] for _, _, _, groups in every]
    count, most = Counter(p for own in links for p in set(own)), defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (i, a, b, groups), own in zip(every, links, strict=True):
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(own), sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own), hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_pairs", [1, 40, alignment.HOT_PAIRS])
def test_equals_a_plain_walk(spark, docs, texts, libraries, monkeypatch, hot_pairs):
    monkeypatch.setattr(alignment, "SUMMED", 500)
    rows = [*enumerate([*texts, *AWKWARD]), (None, "a row without id"), (3, texts[12]), (3, texts[12])]
    out = alignment.alignment(docs(rows), queries.pair(spark), hot_pairs=hot_pairs)
    assert sorted(map(tuple, out.collect()), key=repr) == expected(rows, libraries)


def test_groups_are_the_real_output(spark, docs, texts, libraries):
    rows = list(enumerate([*texts, *AWKWARD]))
    df = docs(rows)
    out = alignment.groups(df, queries.pair(spark))
    assert out.columns == [*df.columns, "a_ids", "b_ids", "a_in", "b_in"]
    for r in out.collect():
        ids_a, ids_b, groups = walked(r.text, libraries)
        assert (r.a_ids, r.b_ids) == (ids_a, ids_b)
        assert [(len(a), len(b)) for a, b in groups] == list(zip(r.a_in, r.b_in, strict=True))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.randoms())
def test_groups_break_where_both_end(a, rng):
    b, left = [], sum(a)
    while left:
        b.append(rng.randrange(1, min(left, 6) + 1))
        left -= b[-1]
    group_a, group_b = alignment.coalesced(np.array(a), np.array(b))
    shared = sorted({*np.cumsum(a).tolist()} & {*np.cumsum(b).tolist()})
    assert group_a.tolist() == np.searchsorted(shared, np.cumsum(a)).tolist() and group_b.tolist() == np.searchsorted(shared, np.cumsum(b)).tolist()


def test_large_groups_are_summed_first(spark, libraries, monkeypatch):
    pair, texts = queries.pair(spark), pa.array(["QmFzZTY0LXN0cmluZw==" * 40, "x" * 999, None, "plain words here"])
    whole = [x.tolist() for x in alignment.Aligned(alignment.plain(texts), pair).links()]
    for large, links in ((0, 1 << 21), (3, 2)):
        monkeypatch.setattr(alignment, "LARGE_GROUP", large)
        monkeypatch.setattr(alignment, "LINKS", links)
        assert [x.tolist() for x in alignment.Aligned(alignment.plain(texts), pair).links()] == whole


def test_of_nothing(spark, docs):
    pair = queries.pair(spark)
    assert alignment.alignment(docs([]), pair).count() == 0
    assert [tuple(r) for r in alignment.alignment(docs([(1, None), (1, "")]), pair).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")] * 2


def test_query(spark, libraries):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op13_alignment(spark, sf).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(tuple, out.collect()), key=repr) == expected(rows, libraries)
    assert out.where(F.col("n_groups") > 0).count() > 100
