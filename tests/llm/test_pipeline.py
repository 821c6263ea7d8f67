"""The pipeline against its brute force, stage by stage."""

import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer as Library

import corpus_pipeline
from tracefold.llm import quality, queries
from tracefold.llm.common import cut

from .test_dedup import jaccard_components
from .test_rules import brute_linked


def brute(rows):
    rows = [r for r in rows if quality.accepted(quality.Text(r[1]), quality.RULES)]
    best = {}
    for i, t in rows:
        k = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        if k not in best or (-len(t), i) < (-len(best[k][1]), best[k][0]):
            best[k] = (i, t)
    rows = sorted(best.values())
    root = jaccard_components(rows)
    rows = [r for k, r in enumerate(rows) if root[k] == k]
    out = {}
    for i, t in rows:
        at, clean = 0, ""
        for s, _, e, _ in brute_linked(t):
            if s >= at:
                clean += t[at:s] + "[REDACTED]"
            at = max(at, e)
        out[i] = clean + t[at:]
    return out


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    df = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = cut(stage(spark, df, sf), "stage")
        assert df.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in df.collect()} == want
    lib = Library.from_file(str(public_tokenizers.path(queries.WORD_BPE)))
    ids = {i: [*lib.encode(t, add_special_tokens=False).ids, queries.END_ID] for i, t in want.items()}
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert sum(p["length"] for p in pieces) == sum(map(len, ids.values()))
    for p in pieces:
        own = np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4").tobytes()
        assert p["ids_crc32"] == zlib.crc32(own)
        assert p["offset"] + p["length"] <= 4096


def test_stages_take_clashing_columns_and_empty_tables(spark, docs):
    df = docs([(1, "a b c"), (None, None)])
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, df, None).collect()
        stage(spark, df.limit(0), None).collect()


def test_the_row_that_was_judged_stays(spark, docs):
    long_, alone, near = " ".join(f"w{k}" for k in range(30)), "a text of its own", " ".join(f"v{k}" for k in range(40))
    df = docs([(1, long_), (None, long_), (None, alone), (2, near), (7, near.upper() + " "), (7, "unlike any")])
    exact = corpus_pipeline.exact_copies(spark, df, None)
    assert exact.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in exact.collect()) == sorted([(0, alone), (1, long_), (2, near), (7, near.upper() + " "), (7, "unlike any")])
    nearly = corpus_pipeline.near_copies(spark, df, None)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in nearly.collect()) == sorted([(0, alone), (1, long_), (2, near), (7, "unlike any")])
