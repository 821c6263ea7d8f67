"""What near-duplicate detection leaves on disk, and what it sends."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from tracefold.llm import simhash
from tracefold.llm.common import cut, keep_rows
from tracefold.sources.scratch import passing, scratch_path, shared_dir


def tables(spark):
    return {p.name for p in Path(shared_dir(spark).removeprefix("file:"), "tracefold").resolve().glob("*")}


def test_tables_of_a_verdict_are_gone_after_it(spark, docs):
    scratch_path(spark, "any")
    before = tables(spark)
    kept = keep_rows(docs([(k, f"text {k}") for k in range(9)]), lambda rows, row: cut(cut(rows, "first").withColumn("kept", F.col("doc_id") % 3 > 0), "second"))
    assert {x.rpartition("-")[0] for x in tables(spark) - before} == {"numbered", "dropped"}
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5, 7, 8]


def test_scratch_of_an_error_is_gone_too_and_of_an_outer_block_stays(spark):
    df = spark.range(3)
    with passing(spark):
        outer = cut(df, "outer")
        try:
            with passing(spark):
                cut(df, "inner")
                raise ValueError
        except ValueError:
            pass
        assert outer.count() == 3 and not any(x.startswith("inner-") for x in tables(spark))
    assert not any(x.startswith("outer-") for x in tables(spark))


def test_compared_texts_are_sent_deflated(spark, docs, monkeypatch):
    rng, sent = random.Random(5), []

    def watched(df, name):
        out = cut(df, name)
        if name == "simhash-texts":
            sent.append(out.agg(F.coalesce(F.sum(F.length("packed")), F.lit(0))).first()[0])
        return out

    monkeypatch.setattr(simhash, "cut", watched)
    words = [f"w{rng.randrange(3000)}" for _ in range(300)]
    rows = [(k, " ".join([*words[:k], "ü日👍", *words[k + 1 :]])) for k in range(0, 240, 8)] + [(999, None)]
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs(rows), width=5, similar=0.8).collect()}
    assert got == {k: 0 for k in range(0, 240, 8)} | {999: 999}
    assert 0 < max(sent) < 30 * 296 * 8 / 2


def test_a_group_of_near_copies_is_compared_a_few_times_a_text(spark, docs, monkeypatch):
    rng, asked = random.Random(11), []
    similar_edges = simhash.similar_edges

    def watched(edges, *rest):
        edges = cut(edges, "asked")
        asked.append(edges.count())
        return similar_edges(edges, *rest)

    monkeypatch.setattr(simhash, "similar_edges", watched)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    rows = [(0, " ".join(base))]
    for k in range(1, 300):
        words = list(base)
        for at in rng.sample(range(150), rng.choice([1, 2, 3, 5, 6])):
            words[at] = f"own{rng.randrange(10**9)}"
        rows.append((k, " ".join(words)))
    sets = [set(simhash.shingle_set(t, 5).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def first(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if len(x & y) >= 0.8 * len(x | y):
                root[max(first(i), first(j))] = min(first(i), first(j))
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs(rows), width=5, similar=0.8).collect()}
    assert got == {k: first(k) for k in range(len(rows))} and 50 < len(set(got.values())) < 200
    assert sum(asked) < 5 * len(rows)
