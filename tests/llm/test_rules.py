"""Quality rules, language identification, sharding, secrets and licences against brute force and held-out accuracy."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracefold.llm import language_id, license_scan, quality, queries, secret_scan, sharding
from tracefold.llm.common import scratch_path

SPACE = r"[^\x20\x09-\x0D]+"


def brute_quality(t):
    t = t or ""
    w = re.findall(SPACE, t)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(SPACE, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark, docs, texts):
    rows = list(enumerate([*texts, "a b c " * 60, "x\n" * 80, "# | word " * 50, None, "no\x85split here " * 30]))
    out = quality.quality(docs(rows), sample_rows=10).collect()
    assert len(out) == len(rows)
    for r in out:
        n, chars, symbols, dups, repeats = brute_quality(rows[r["doc_id"]][1])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dups, repeats)
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (r["base_failed"] and r["kept"])


def test_order_of_the_cascade_does_not_change_the_verdict(texts):
    cases = [quality.Text(t) for t in [*texts, "# " * 100, "UP " * 100 + "x y z"]]
    want = [quality.accepted(t, quality.RULES) for t in cases]
    for order in itertools.permutations(quality.RULES):
        assert [quality.accepted(t, order) for t in cases] == want


def test_cascade_puts_cheap_rejections_first(spark, docs):
    rows = [(k, "word " * 5) for k in range(200)]
    order = quality.cascade_order(docs(rows))
    assert order[0].name == "few_words" and set(order) == set(quality.RULES)


def test_cascade_ranks_on_what_is_left(spark, docs):
    short = "no word twice in a line of so few words"  # rejected by two rules, the cheap one first
    rules = (quality.Rule("costly", ("words", "repeat_words"), lambda x: len(x.words) < 60), quality.Rule("cheap", ("words",), lambda x: len(x.words) < 50), quality.Rule("shouting", ("word_chars", "upper_chars"), lambda x: 2 * x.upper_chars > x.word_chars))
    rows = [(k, short) for k in range(100)] + [(k, " ".join(f"LOUD{j}X" for j in range(100))) for k in range(100, 130)]
    assert [r.name for r in quality.cascade_order(docs(rows), rules)] == ["cheap", "shouting", "costly"]
    assert {r.name for r in quality.cascade_order(docs([]), rules)} == {"costly", "cheap", "shouting"}


def test_the_sample_reads_a_few_files(spark, docs, texts):
    path = scratch_path(spark, "many")
    docs([(k, texts[k % len(texts)]) for k in range(400)], extra=False).repartition(60).write.parquet(path)
    df = spark.read.parquet(path)
    assert 0 < len(quality.sampled(df, 1000).inputFiles()) <= 60 and quality.sampled(df, 1000).count() < 200
    assert quality.sampled(df.where("doc_id >= 0").unionAll(df), 100).count() > 0


def test_filtered_keeps_clean_rows_and_columns(spark, docs, texts):
    df = docs(list(enumerate(texts)))
    out = quality.filtered(df)
    assert out.columns == df.columns
    assert {r["doc_id"] for r in out.collect()} == {k for k, t in enumerate(texts) if quality.accepted(quality.Text(t), quality.RULES)}
    assert quality.filtered(docs([])).count() == 0 and quality.quality(docs([])).count() == 0


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    third = language_id.crc_third(F.col("doc_id"))
    models = language_id.learn(docs.where(third != 1).select("doc_id", "text", "lang"), sample_docs=60)
    out = language_id.identify(docs, models).join(docs.select("doc_id", "lang"), "doc_id").where(third == 1)
    n, right, low, high = out.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred")), F.min("score"), F.max("score")).first()
    assert right / n > 0.97 and 0 <= low and high <= 1
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in out.collect())
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, "the " * 5000), (None, "der die das und nicht")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language_id.identify(odd, models).collect()}
    assert [got[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and got[1]["score"] == 0 and got[1]["rejected"]
    assert got[4]["lang_pred"] in models.langs and got[None]["lang_pred"] in models.langs
    assert language_id.identify(odd.limit(0), models).count() == 0


def test_language_without_labels(spark, docs):
    for rows in ([], [(1, None, None)], [(1, "text", None)], [(1, None, "en")], [(1, "12 !", "en")]):
        labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        out = language_id.identify(docs([(1, "some words"), (None, None)]), language_id.learn(labelled)).collect()
        assert len(out) == 2 and all(r["lang_pred"] == "und" and r["score"] == 0 and r["rejected"] for r in out if r["doc_id"] is None or not rows or rows[0][2] is None)


def test_language_sample_is_bounded_in_characters(spark):
    rows = [(k if k % 2 else None, "lange Wörter und Sätze " * 200 + str(k), "de") for k in range(60)] + [(k, "many short words here", "en") for k in range(60)]
    models = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_chars=40_000)
    assert models.langs == ["de", "en"]


def slow_kneser_ney(text_ngrams, order=4):
    """P(last | before) by the textbook: counts at the highest order, continuation counts below, one discount for each order."""
    grams = {order: Counter(text_ngrams)}
    for n in range(order - 1, 0, -1):
        grams[n] = Counter(g[1:] for g in grams[n + 1])
    alphabet = len(grams[1])

    def discount(n):
        c = Counter(grams[n].values())
        return c[1] / (c[1] + 2 * c[2]) if c[1] and c[2] else 0.5

    d = {n: discount(n) for n in grams}

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / (alphabet + 1)
        own = [c for h, c in grams[n].items() if h[:-1] == g[:-1]]
        if not own:
            return p(g[1:])
        return max(grams[n][g] - d[n], 0) / sum(own) + d[n] * len(own) / sum(own) * p(g[1:])

    return p


def test_models_are_kneser_ney():
    def ngrams(t):
        x = "\0\0\0" + "".join(c if c.isalpha() else "\0" for c in t.lower()) + "\0"
        x = x[:3] + re.sub("\0+", "\0", x[3:].lstrip("\0") if x[3:].lstrip("\0") else "\0")
        return [tuple(x[i : i + 4]) for i in range(len(x) - 3)]

    unpack = lambda v: tuple(chr(int(v) >> 16 * k & 0xFFFF) for k in (3, 2, 1, 0))
    for t in ("abracadabra alakazam abra cadabra", "hokus pokus fidibus hokus"):
        own = [unpack(v) for v in language_id.sequences([t])[0]]
        assert own == ngrams(t)
        p = slow_kneser_ney(own)
        m = language_id.fit(["x"], [np.unique(language_id.sequences([t])[0], return_counts=True)])
        for other in (t, "abrakus", "pokuscada zzz"):
            packed = language_id.sequences([other])[0]
            assert np.exp(m.logs(packed)[:, 0].astype(float)) == pytest.approx([p(unpack(v)) for v in packed], rel=1e-4)


def test_models_are_probabilities():
    counts = [np.unique(language_id.sequences([t])[0], return_counts=True) for t in ("abracadabra alakazam", "hokus pokus fidibus")]
    m = language_id.fit(["a", "b"], counts)
    inverse = np.uint64(pow(int(language_id.FACTOR), -1, 1 << 64))
    letters = m.keys[1] * inverse
    for context in ("abr", "zzz", "us "):
        c = language_id.sequences([context])[0][2] & np.uint64((1 << 48) - 1)
        all_ = np.array([(int(c) << 16 | int(x)) & (2**64 - 1) for x in letters] + [(int(c) << 16 | 0xFFFE) & (2**64 - 1)], np.uint64)
        assert np.exp(m.logs(all_).astype(float)).sum(axis=0) == pytest.approx([1, 1], abs=1e-5)


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_hilbert_visits_each_cell_and_moves_one_step(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    at = sharding.hilbert(cells, bits)
    assert sorted(at) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_shards(spark, docs, texts):
    rows = list(enumerate(texts * 3)) + [(None, "x"), (5, "again"), (5, "again")]
    out = sharding.shards(docs(rows), 7).collect()
    assert len(out) == len(rows)
    per = Counter(r["shard"] for r in out)
    assert len(per) == 7 and max(per.values()) - min(per.values()) <= 1
    for k in per:
        assert sorted(r["slot"] for r in out if r["shard"] == k) == list(range(per[k]))
    ordered = [r["hilbert"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    assert ordered == sorted(ordered)
    for r in out:
        if r["doc_id"] is not None and r["doc_id"] != 5:
            t = (texts * 3)[r["doc_id"]] or ""
            assert (r["size"], r["text_crc32"]) == (len(t.encode()) + 16, zlib.crc32(t.encode()))
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert sharding.shards(docs([]), 7).count() == 0
    assert sharding.shards(docs([(1, "a"), (2, None)]), 7).count() == 2


def test_shards_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), "x" * int(rng.integers(0, 300)), ["de", "en", None][rng.integers(3)], f"host{rng.integers(9)}.org") for k in rng.permutation(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")

    def cells(values, bits=5):
        own = sorted(v for v in values if v is not None)
        cuts = [own[math.ceil(len(own) * k / 2**bits) - 1] for k in range(1, 2**bits)]
        return [0 if v is None else sum(e < v for e in cuts) for v in values]

    dims = np.array([cells([r[2] for r in rows]), cells([r[3] for r in rows]), cells([len(r[1]) + 16 for r in rows])]).T
    at = sharding.hilbert(dims, 5)
    order = sorted(range(500), key=lambda k: (at[k], len(rows[k][1]) + 16, rows[k][0]))
    want = {}
    for rank, k in enumerate(order):
        shard = rank * 7 // 500
        want[rows[k][0]] = (shard, rank - -(-shard * 500 // 7), int(at[k]))
    assert {r["doc_id"]: (r["shard"], r["slot"], r["hilbert"]) for r in sharding.shards(df, 7).collect()} == want


def test_quantiles_are_of_all_rows(spark):
    """More rows than a sample would hold: each quantile is the one of the whole column, numbers and strings."""
    df = spark.range(50_000).select(F.concat(F.lit("s"), F.lpad((F.col("id") * 7919 % 49_999).cast("string"), 5, "0")).alias("name"), (F.col("id") * F.col("id") % 30_011).alias("size"))
    rows = df.collect()
    for name, got in zip(("name", "size"), sharding.edges(df, ["name", "size"], 5), strict=True):
        own = sorted(r[name] for r in rows)
        assert got == [own[math.ceil(len(own) * k / 32) - 1] for k in range(1, 32)]
    few = spark.createDataFrame([(None, 1.0), ("a", None)], "name string, size double")
    assert sharding.edges(few, ["name", "size"], 1) == [["a"], [1.0]] and sharding.edges(few.limit(0), ["name"], 2) == [[]]


def test_one_outlier_takes_no_dimension_away(spark):
    hosts = [f"www.host{k:02d}.org" for k in range(50)]
    for more in ([], ["a.org"]):
        df = spark.createDataFrame([(h,) for h in hosts * 20 + more], "host string")
        out, (cell,) = sharding.quantised(df, ["host"])
        assert out.select(cell).distinct().count() == 32


def test_written_shards_let_readers_skip_files(spark, docs):
    rng = np.random.default_rng(2)
    rows = [(None if k % 7 == 0 else int(k % 400), " ".join(["w"] * int(rng.integers(1, 200)))) for k in range(2000)]
    df = docs(rows).withColumn("lang", F.element_at(F.array(*map(F.lit, ("de", "en", "es", "fr"))), (F.abs(F.xxhash64("text")) % 4 + 1).cast("int")))
    df = df.withColumn("source", F.concat(F.lit("s"), F.abs(F.xxhash64("text", "lang")) % 20))
    path = scratch_path(spark, "shards")
    sharding.write_shards(df, path, 20)
    back = spark.read.parquet(path)
    assert back.count() == 2000 and back.select(*df.columns).exceptAll(df).count() == 0
    touched = back.groupBy("shard").agg(F.min("lang").alias("a"), F.max("lang").alias("b"), F.min("source").alias("c"), F.max("source").alias("d")).collect()
    share = np.mean([r["a"] <= lang <= r["b"] and r["c"] <= source <= r["d"] for r in touched for lang in ("de", "en", "es", "fr") for source in (f"s{k}" for k in range(20))])
    assert share < 0.25  # of all shards, by their statistics; without the curve a reader opens every one
    sharding.write_shards(df.limit(0), scratch_path(spark, "none"), 4)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_has_a_row_for_each_document(spark, name):
    sf = "/root/testdata/sf0.001"
    out = queries.QUERIES[name](spark, sf)
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert ids == {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}


def test_shards_narrow_every_dimension(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = sharding.shards(docs, 40).join(docs.select("doc_id", "lang", "source"), "doc_id")
    spread = out.groupBy("shard").agg(F.count_distinct("lang").alias("l"), F.count_distinct("source").alias("s")).agg(F.avg("l"), F.avg("s")).first()
    assert spread[0] < 2.2 and spread[1] < 12  # of 4 and 20


def brute_secrets(t):
    t, out = t or "", []
    a = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out += [(m.start(), 0, m.end(), "assign") for m in a.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def brute_linked(t, scope=secret_scan.SCOPE):
    t, base = t or "", brute_secrets(t)
    find = lambda p: [(m.start(), m.end()) for m in re.finditer(p, t, re.A)]
    names = find(secret_scan.IDENTIFIER) + [(s, e) for s, _, e, k in base if k == "access"]
    ends = find(secret_scan.ENDPOINT)
    out = []
    for s, e in find(secret_scan.WEAK):
        if any(b < e and s < c for b, _, c, _ in base):
            continue
        if all(any(s - scope <= x <= e + scope for x, _ in parts) for parts in (names, ends)):
            out.append((s, 3, e, "weak"))
    return sorted(base + out)


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


WEAK = "aB3dE5gH7jK9mN1pQ"
SECRETS = [
    None, "", "é👍 token = \"abcdef12\" secret: token: abcdefgh x", "AKIA" + "A" * 16 + " and " + "f" * 30 + " PASSWORD='x' apikey=12345678",
    f"user=bob host=db.example.com {WEAK} more", f"{WEAK} alone", f"user=bob https://x.example.com {'z ' * 500}{WEAK} far", f"user: bob {WEAK}",
    f"AKIA{'B' * 16} https://x.y {WEAK}", f"secret={WEAK} user=bob host=abcd.example", ("token=abcdefgh1 " * 700) + f"{'f' * 24} user=me9 https://a.b/ {WEAK}",
    "ſecret=abcdefgh toKen=abcdefgh", "AKIAAKIA" + "C" * 14, "0" * 23 + "g" + "a" * 24,
]


def test_secrets(spark, docs, texts):
    rows = list(enumerate([*SECRETS, *texts]))
    rows.append((4, SECRETS[4]))
    out = secret_scan.secrets(docs(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        t = rows[r["doc_id"]][1]
        base = brute_secrets(t)
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest(), t
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(x[3] == k for x in base) for k in ("assign", "access", "hex"))
        assert r["spans"] == joined(brute_linked(t)), t
    assert secret_scan.secrets(docs([])).count() == 0


def test_redaction_takes_every_span_and_nothing_else(spark, docs):
    df = docs([*enumerate(SECRETS), (4, SECRETS[4])])
    out = secret_scan.redacted(df)
    assert out.columns == df.columns
    for r in out.collect():
        t, at, want = SECRETS[r["doc_id"]], 0, ""
        if t is None:
            assert r["text"] is None
            continue
        for s, _, e, _ in brute_linked(t):
            if s >= at:
                want += t[at:s] + "[REDACTED]"
            at = max(at, e)
        assert r["text"] == want + t[at:] and r["n_chars"] == len(r["text"])


def test_native_plans_have_no_python(spark, docs):
    plan = secret_scan.secrets(docs([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def licence_words(s):
    return [w for w in (x.strip(".-") for x in re.split("[^a-z0-9.-]+", s.lower())) if w]


def brute_licences(texts, templates=license_scan.TEMPLATES, similar=license_scan.SIMILAR):
    """The best (licence, cosine) of each text over all windows, without any prefilter."""
    df = Counter(w for t in texts for w in set(licence_words(t or "")))
    idf = lambda w: math.log((len(texts) + 1) / (df[w] + 1)) + 1
    vector = lambda ws: {w: c * idf(w) for w, c in Counter(ws).items()}
    models = [(name, v, math.hypot(*v.values())) for name, v in ((name, vector(licence_words(t))) for name, t in templates)]
    out = []
    for t in texts:
        lines = [licence_words(x) for x in (t or "").split("\n")]
        units = {tuple(w for x in lines for w in x)}
        for size in license_scan.WINDOWS:
            for b in range(0, len(lines), max(1, size // 4)):
                units.add(tuple(w for x in lines[b : b + size] for w in x))
        best = None
        for u in units - {()}:
            v = vector(u)
            norm = math.hypot(*v.values())
            for name, m, length in models:
                c = round(sum(v.get(w, 0) * x for w, x in m.items()) / norm / length, 6)
                if c >= similar and (best is None or (-c, name) < (-best[1], best[0])):
                    best = (name, c)
        out.append(best)
    return out


def scan(spark, files):
    df = spark.createDataFrame([(k, p, t) for k, (p, t) in enumerate(files)], "id long, path string, text string").withColumn("licence", F.lit("clash")).withColumn("row", F.lit("r")).withColumn("name", F.lit(1))
    out = {r["id"]: r for r in license_scan.scanned(df, key="id").collect()}
    assert len(out) == len(files)
    return out


def test_licences_and_inheritance(spark):
    files = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", "code"), ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/c/y.py", "text\nlicensed under the apache license version 2.0\nmore"), ("a/b/c/z.py", None), ("a/w.py", "licence of no kind at all, my friend, just words"),
        ("q/r.py", ""), ("root.py", "x"), (None, "Released under the MIT License."), ("a/b/x.py", "second part"), (None, None), ("a/LICENSE", "Released under the MIT License."),
    ]
    got = scan(spark, files)
    assert [(got[k]["licence"], got[k]["origin"], got[k]["licence_path"], got[k]["licence_key"]) for k in range(len(files))] == [
        ("MIT", "own", "a/LICENSE", 0), ("GPL-3.0", "inherited", "a/b/COPYING", 2), ("GPL-3.0", "own", "a/b/COPYING", 2), ("Apache-2.0", "own", "a/b/c/y.py", 3),
        ("GPL-3.0", "inherited", "a/b/COPYING", 2), ("MIT", "inherited", "a/LICENSE", 0), (None,) * 4, (None,) * 4, ("MIT", "own", None, 8),
        ("GPL-3.0", "inherited", "a/b/COPYING", 2), (None,) * 4, ("MIT", "own", "a/LICENSE", 11),
    ]
    for k, want in enumerate(brute_licences([t for _, t in files])):
        assert (want is None) == (got[k]["origin"] != "own")
        assert want is None or (got[k]["licence"], got[k]["cosine"]) == (want[0], pytest.approx(want[1], abs=2e-6))
    empty = spark.createDataFrame([], "path string, text string")
    assert license_scan.scanned(empty).count() == 0


WRAPPED = """/*
 * Copyright (c) 2011 Some Body
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
int main() { return 0; }
"""


def wrapped(text, width, mark="# "):
    out, line = [], mark
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(line)
            line = mark
        line += w + " "
    return "\n".join([*out, line])


def test_headers_texts_and_tags_of_common_licences(spark):
    full = {name: max((t for n, t in license_scan.TEMPLATES if n == name), key=len) for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-3.0", "AGPL-3.0", "LGPL-3.0", "MPL-2.0", "Unlicense")}
    code = "\n".join(f"x{k} = compute(y{k}, z{k})" for k in range(40))
    cases = [("Apache-2.0", WRAPPED), ("MIT", "MIT License\n\nCopyright (c) 2020 Any One\n\n" + wrapped(full["MIT"], 76, "")), ("MIT", code + "\n// SPDX-License-Identifier: MIT\n" + code), ("GPL-2.0", "# SPDX-License-Identifier: GPL-2.0-or-later\nx = 1"),
             ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone is permitted to copy\n"), ("MIT", "The MIT License (MIT)"), ("Apache-2.0", "Apache License")]
    cases += [(name, code + "\n\n" + wrapped(text, 60) + "\n\n" + code) for name, text in full.items()]
    cases += [(None, code), (None, "A licence to print money, as the saying goes."), (None, "permission notice " * 30)]
    got = scan(spark, [(f"f/{k}.py", t) for k, (_, t) in enumerate(cases)])
    assert [got[k]["licence"] for k in range(len(cases))] == [name for name, _ in cases]
    for k, want in enumerate(brute_licences([t for _, t in cases])):
        assert want is None or got[k]["cosine"] == pytest.approx(want[1], abs=2e-6)


def test_a_notice_file_of_many_lines_ends_soon(spark):
    """A megabyte of short lines, a licence among them: lines are split once, not for each window."""
    rng = random.Random(15)
    lines = [" ".join(rng.choice(["license", "notice", "copyright", "software", "part", "of", "the"]) + str(rng.randrange(3) or "") for _ in range(7)) for _ in range(20_000)]
    lines[11_000] = "Released under the MIT License."
    files = spark.createDataFrame([("a/NOTICE", "\n".join(lines)), ("a/b.c", "x")], "path string, text string")
    began = time.time()
    got = {r.path: (r.licence, r.origin) for r in license_scan.scanned(files).collect()}
    assert got == {"a/NOTICE": ("MIT", "own"), "a/b.c": ("MIT", "inherited")} and time.time() - began < 120


def test_a_text_of_many_candidates_ends_soon(spark, docs):
    """Weak candidates meet base findings by their places, not all with all."""
    one = "user: someone1 host: db.example.com Ab3dEf6hIj9kLm2n0pQ password: secret{} "
    text = "".join(one.format(k) for k in range(6_000))
    began = time.time()
    got = secret_scan.secrets(docs([(1, text)])).select("n_assign", F.size(F.split("spans", ",")).alias("n")).first()
    assert tuple(got) == (6_000, 12_000) and time.time() - began < 120


def test_a_line_of_megabytes_and_a_hot_text(spark):
    line = "var a=1;license=" + "".join(f"function f{k}(){{return {k}}};" for k in range(150_000))
    assert len(line) > 4_000_000
    got = scan(spark, [("m/min.js", line), *[(f"m/{k}.py", "Released under the MIT License.") for k in range(300)]])
    assert got[0]["licence"] is None and all(got[k]["licence"] == "MIT" for k in range(1, 301))


def test_licence_files_with_endings_and_in_the_root_speak_for_what_is_below(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [("LICENSE", mit), ("b.py", "x"), ("src/a.py", None), ("LICENSE/c.py", "x"), ("p/LICENSE.md", gpl), ("p/q/d.py", "x"), ("r/COPYING.LESSER", gpl), ("r/e.py", ""), ("s/licenses.txt", gpl), ("s/f.py", "x")]
    got = {r["path"]: (r["licence"], r["origin"], r["licence_path"]) for r in license_scan.scanned(spark.createDataFrame(files, "path string, text string")).collect()}
    assert {p: g for p, g in got.items() if g[1] != "own"} == {
        "b.py": ("MIT", "inherited", "LICENSE"), "src/a.py": ("MIT", "inherited", "LICENSE"), "LICENSE/c.py": ("MIT", "inherited", "LICENSE"),
        "p/q/d.py": ("GPL-3.0", "inherited", "p/LICENSE.md"), "r/e.py": ("GPL-3.0", "inherited", "r/COPYING.LESSER"), "s/f.py": ("MIT", "inherited", "LICENSE"),
    }
