"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from tracefold.llm import queries, spelling


def one_edit(a, b):
    """Whether a and b differ by exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def lower(x):
    return "".join(c.lower() if c.isascii() else c for c in x)


def words_of(rows):
    """All runs of (doc_id, text), damaged as stated."""
    out = []
    for doc_id, text in rows:
        for run in map(lower, re.findall("[A-Za-zÀ-ÿ]+", text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out.append(run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run)
    return out


def expected(count):
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= 2 * n else None
    out = []
    for w, n in count.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], count[form[w]] if form[w] else None, root))
    return sorted(out)


def got(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def invented(seed, letters, n):
    """Words of few letters with their variants, so that near ones, repeated bigrams and chains abound."""
    rng, out = random.Random(seed), {}
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(4, 9)))
        out[w] = rng.randrange(1, 200)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:]])
            if len(v) >= 4:
                out.setdefault(v, rng.randrange(1, 20))
    return out


@pytest.mark.parametrize(("seed", "letters", "n"), [(1, "ab", 120), (2, "abcdeé", 400), (3, "aàáxyzþ日👍", 300)])
def test_equals_all_pairs(spark, seed, letters, n):
    count = invented(seed, letters, n)
    df = spark.createDataFrame([(w, c, "x") for w, c in count.items()], "word string, n long, size string")
    assert got(spelling.variants(df)) == expected(count)


def test_words_of_documents(spark, docs, texts):
    rows = [*enumerate([*texts, "Straße STRASSE ÀÉ àé", "aaaaa " * 5 + "aaaab " * 3 + "Aaaaab " * 9]), (None, "no id here, no id here, no id here"), (3, texts[12])]
    found = spelling.damaged(spelling.runs(docs(rows)))
    assert Counter(r.word for r in found.collect()) == Counter(words_of(rows))
    count = {w: n for w, n in Counter(words_of(rows)).items() if len(w) >= 5 and n >= 3}
    assert got(spelling.variants(spelling.counted(found))) == expected(count)


def test_pivots_are_disjoint_and_as_rare_as_can_be(spark):
    count = invented(4, "abc", 200)
    freq = Counter(w[k : k + 2] for w in count for k in range(len(w) - 1))
    for r in spelling.signatures(spark.createDataFrame([(w,) for w in count], "word string")).collect():
        grams = sorted((freq[r.word[k : k + 2]], r.word[k : k + 2], k) for k in range(len(r.word) - 1))
        prefix = [g for g in grams if g[:2] <= grams[2][:2]]
        assert [(x.freq, x.gram, x.at) for x in r.prefix] == prefix
        a, b = r.pivots
        assert b.at - a.at >= 2 and {(x.freq, x.gram, x.at) for x in r.pivots} <= {*prefix}
        assert a.freq + b.freq == min(x[0] + y[0] for x, y in combinations(prefix, 2) if abs(x[2] - y[2]) >= 2)


def test_of_nothing(spark, docs):
    assert spelling.variants(spelling.counted(spelling.damaged(spelling.runs(docs([(1, None), (2, ""), (3, "12 34")]))))).count() == 0
    alone = spelling.variants(spark.createDataFrame([("lonely", 7)], "word string, n long"))
    assert got(alone) == [("lonely", 7, 0, None, None, "lonely")]


def test_a_hot_beginning(spark):
    """A third of the words share their first letters: all links are found, candidates are fewer than pairs."""
    rng = random.Random(6)
    count = {"zzz" + "".join(rng.choice("abcdefgh") for _ in range(5)): rng.randrange(1, 50) for _ in range(300)} | invented(7, "abcdefgh", 500)
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    assert got(spelling.variants(df)) == expected(count)
    assert spelling.candidates(spelling.signatures(df)).count() < len(count) ** 2 / 40


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    count = {w: n for w, n in Counter(words_of(rows)).items() if len(w) >= 5 and n >= 3}
    out = got(queries.op11_spelling(spark, sf))
    assert [x[:2] for x in out] == sorted(count.items())
    brute = dict((x[0], x) for x in expected({w: n for w, n in count.items() if w[0] in "st"}))
    assert all(x[2] >= brute[x[0]][2] for x in out if x[0] in brute)
