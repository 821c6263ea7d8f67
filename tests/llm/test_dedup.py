"""Exact and near deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tracefold.llm import exact_dedup, simhash


def brute_exact(rows):
    plain = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for k, p in enumerate(plain):
        groups.setdefault(p, []).append(k)
    out = []
    for k, p in enumerate(plain):
        best = min(groups[p], key=lambda j: (-len(rows[j][1] or ""), rows[j][0] is None, rows[j][0] or 0))
        out.append((rows[k][0], rows[best][0], len(groups[p]), hashlib.sha256(p.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, docs, texts, weak):
    rows = list(enumerate(texts * 2)) + [(None, "null id"), (None, "nullid"), (900, "tie"), (899, "tie"), (3, "again"), (3, "again")]
    hashed = (lambda c: F.octet_length(c).cast("long") % 3) if weak else F.xxhash64
    out = exact_dedup.exact_groups(docs(rows), capacity=4, hashed=hashed).collect()
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out], key=repr) == brute_exact(rows)
    stays = {}
    for r in out:
        stays[r["text_sha256"]] = stays.get(r["text_sha256"], 0) + r["kept"]
    assert set(stays.values()) == {1}


def test_exact_of_nothing(spark, docs):
    assert exact_dedup.exact_groups(docs([])).count() == 0


def test_directory_doubles_until_no_bucket_is_overfull(spark):
    entries = spark.range(4000).select(F.xxhash64("id").alias("key"))
    where, depth = exact_dedup.directory(entries, 100)
    placed = entries.withColumn("prefix", exact_dedup.prefix(F.col("key"), depth)).join(where, "prefix")
    assert placed.count() == 4000
    assert placed.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 100
    assert where.count() == 1 << depth or where.count() <= 1 << depth


def test_owners_compare_their_ranges(spark, docs, texts):
    out = exact_dedup.exact_groups(docs(list(enumerate(texts * 2))), capacity=4)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = spark.range(3000).select(F.xxhash64(F.col("id") % 1000).alias("key"), F.lit(8).alias("length"))
    written = exact_dedup.index(rows, 50)
    buckets = written.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("members").alias("m")).collect()
    assert len(buckets) > 20 and max(r["n"] for r in buckets) <= 50 and sum(r["m"] for r in buckets) == 3000
    keys = sorted((r["key"] & (2**64 - 1), r["bucket"]) for r in written.collect())
    assert len([1 for x, y in zip(keys, keys[1:], strict=False) if x[1] != y[1]]) == len(buckets) - 1  # each bucket is one range of keys


def slow_fingerprint(t, width=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + width]), seed=42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_fingerprints(texts, monkeypatch):
    for t in texts:
        assert simhash.fingerprint(t) == slow_fingerprint(t)
    monkeypatch.setattr(simhash, "HASHED", 3)
    assert [simhash.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_fingerprint_is_sparks_hash_too(spark):
    row = spark.createDataFrame([("some words here",)], "t string").select(F.xxhash64("t")).first()[0]
    assert row & (2**64 - 1) == simhash.fingerprint("Some  words\nHERE")


def clustered(n, centres, flips, seed):
    rng = np.random.default_rng(seed)
    fp = rng.integers(0, 2**63, centres, dtype=np.uint64)[rng.integers(0, centres, n)]
    for _ in range(flips):
        fp = fp ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
    return np.unique(fp)


def brute_links(fp, distance=3):
    d = np.bitwise_count(fp[:, None] ^ fp[None, :])
    a, b = np.nonzero(np.triu(d <= distance, 1))
    return set(zip(a.tolist(), b.tolist(), strict=True))


@pytest.mark.parametrize(("n", "centres", "flips"), [(1, 1, 0), (2, 1, 1), (17, 1, 2), (400, 3, 2), (900, 40, 4), (600, 600, 0)])
def test_index_finds_all_links(n, centres, flips):
    fp = clustered(n, centres, flips, n)
    i, j = simhash.links(fp)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == brute_links(fp)


def brute_components(fp):
    root = list(range(len(fp)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in brute_links(fp):
        root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for k in range(len(fp)):
        groups.setdefault(find(k), []).append(int(fp[k]))
    return {tuple(sorted(g)) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("group_rows", [8, 2048])
def test_components_over_split_groups(spark, group_rows):
    fp = clustered(700, 12, 4, 5)
    df = spark.createDataFrame([(int(x.view(np.int64)),) for x in fp], "fp long")
    found = {}
    for r in simhash.components(simhash.near_edges(df, 3, group_rows)).collect():
        found.setdefault(r["root"], []).append(r["node"] & (2**64 - 1))
    assert {tuple(sorted(g)) for g in found.values()} == brute_components(fp)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    rows = simhash.components(edges).collect()
    assert len(rows) == 63 and len({r["root"] for r in rows}) == 2


def test_near_groups(spark, docs, texts):
    rows = list(enumerate(texts)) + [(None, texts[20]), (500, texts[20]), (500, texts[20]), (501, None)]
    out = simhash.near_groups(docs(rows)).collect()
    assert len(out) == len(rows)
    fp = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= 3:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    least = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None) for r in set(root)}
    want = sorted([(rows[k][0], f"{fp[k]:016x}", least[root[k]]) for k in range(len(rows))], key=repr)
    assert sorted([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in out], key=repr) == want
    assert sum(r["kept"] for r in out) == len(set(root))


def test_near_of_nothing(spark, docs):
    assert simhash.near_groups(docs([])).count() == 0


def test_hot_group_of_near_copies_stays_linear(spark, docs):
    rng = random.Random(4)
    base = [rng.choice("abcdefghij") + str(k) for k in range(400)]
    rows = []
    for k in range(300):
        words = list(base)
        words[rng.randrange(400)] = f"edit{k}"
        rows.append((k, " ".join(words)))
    df = simhash.fingerprints(docs(rows))
    assert simhash.near_edges(df.select("fp").distinct(), 3, 64).count() < 300 * 4 * 6


def jaccard_components(rows, similar=0.8, width=5):
    """Of (row, text): the component of each row by Jaccard similarity of shingle sets, over all pairs that share a shingle."""
    sets, by = [], {}
    for k, (_, t) in enumerate(rows):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else {b""})
        for x in sets[-1]:
            by.setdefault(x, []).append(k)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, own in enumerate(sets):
        shared = {}
        for x in own:
            for b in by[x]:
                if b < a:
                    shared[b] = shared.get(b, 0) + 1
        for b, n in shared.items():
            if n >= similar * (len(own) + len(sets[b]) - n):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(k) for k in range(len(rows))]


def edited(words, share, rng):
    return [rng.choice("pqrstuvw") + str(rng.randrange(10**6)) if rng.random() < share else w for w in words]


def test_similar_texts_are_found_whatever_their_fingerprints(spark, docs):
    rng = random.Random(8)
    rows = []
    for _ in range(150):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 400))]
        rows += [(len(rows) + k, " ".join(edited(words, share, rng))) for k, share in enumerate((0, 0.005, 0.01, 0.02, 0.06))]
    rows += [(None, rows[0][1]), (len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "three short words")]
    want = jaccard_components(rows)
    got = simhash.near_groups(docs(rows), width=5, similar=0.8).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r["component_id"] for r in got}
    pairs = [(rows[k][0], rows[want[k]][0]) for k in range(len(rows)) if rows[k][0] is not None and want[k] != k]
    assert len(pairs) > 300
    assert sum(by_id[a] == by_id[b] for a, b in pairs) >= 0.97 * len(pairs)
    component = dict(zip((i for i, _ in rows), want, strict=True))
    assert all(component[i] == component[c] for i, c in by_id.items() if i is not None)  # nothing else is linked


def test_no_similar_pair_is_left_out(spark, docs):
    """Dense families at the threshold itself, chains of copies of copies, passages shared by unlike texts: all links, as brute force has them."""
    rng = random.Random(21)
    passage = [f"common{k}" for k in range(60)]
    rows = []
    for _ in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(30, 250))]
        family = [words]
        for _ in range(14):
            family.append(edited(rng.choice(family), rng.choice((0.004, 0.015, 0.021, 0.024)), rng))
        rows += [(len(rows) + k, " ".join(w + passage * (k % 5 == 0))) for k, w in enumerate(family)]
    for n in (5, 6, 9, 10, 14, 35):  # sets whose share is 0.8 to the last shingle
        words = [f"x{n}y{k}" for k in range(n + 4)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[: n + 4 - n // 5]))]
    want = jaccard_components(rows)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(docs(rows), width=5, similar=0.8).collect()}
    assert sum(w != k for k, w in enumerate(want)) > 300
    assert got == {rows[k][0]: rows[w][0] for k, w in enumerate(want)}


def test_filler_links_nothing(spark, docs):
    """Unlike texts that share a filler: it decided all bits of their fingerprints when repeats counted."""
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(1000)) + " " + "= " * n for n in (150, 150, 150, 250, 250, 400)]
    texts += [texts[0].replace(" ", "  "), texts[3] + " end"]
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs(list(enumerate(texts))), width=5, similar=0.8).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 0, 7: 3}
    assert len({r.fingerprint for r in simhash.near_groups(docs(list(enumerate(texts[:3])))).collect()}) == 1  # with repeats, as op4 is asked to


def test_texts_of_one_fingerprint_are_told_apart(spark):
    rng = random.Random(12)
    kinds = [[f"k{c}w{rng.randrange(10**5)}" for _ in range(80)] for c in range(4)]
    texts = [" ".join(edited(kinds[k % 4], 0.004 * (k // 4), rng)) for k in range(40)]
    texts[5] = texts[1]
    sets = [simhash.shingle_set(t, 5) for t in texts]
    digest = [int(np.uint64(simhash.xxhash.xxh64_intdigest(x.tobytes(), 42)).view(np.int64)) for x in sets]
    rows = spark.createDataFrame([(100 + k, 7, k, digest[k]) for k in range(40)], "doc_id long, fp long, row long, digest long")
    other = spark.createDataFrame([(900, 8, 90, 5)], rows.schema)
    df = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    out = simhash.told_apart(rows.unionByName(other), df, 5, 0.8).collect()
    node = {r.digest: r.node for r in out}
    assert len(out) == len(set(digest)) + 1 and node[5] == 8 and node[digest[0]] == 7
    heads: dict = {}
    for k in range(40):  # the first of each node, and what is near enough to it
        heads.setdefault(node[digest[k]], k)
        h = heads[node[digest[k]]]
        both = len(np.intersect1d(sets[h], sets[k]))
        assert both >= 0.8 * (len(sets[h]) + len(sets[k]) - both)
    assert len(heads) >= 4 and all(k % 4 == heads[node[digest[k]]] % 4 for k in range(40))


def test_hot_bands_are_dealt_again(spark):
    rng = np.random.default_rng(3)
    fp = np.unique(rng.integers(0, 2**62, dtype=np.uint64) ^ (np.uint64(1) << rng.integers(0, 64, 900, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 900, dtype=np.uint64)))
    dealt = spark.createDataFrame([(int(x.view(np.int64)), 0, 7) for x in fp], "fp long, way long, block long")
    for group_rows in (100_000, 64):
        found = simhash.components(simhash.band_edges(dealt, 0.8, group_rows)).collect()
        assert len(found) == len(fp) and len({r["root"] for r in found}) == 1


@pytest.mark.parametrize("distance", [3, 18])
def test_groups_in_one_tree_stay_apart(distance):
    rng = np.random.default_rng(5)
    group = np.sort(rng.integers(0, 60, 500))
    fp = clustered(500, 4, 6, 6)
    group = group[: len(fp)]
    i, j = simhash.links(fp, distance, group=group)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a, b in brute_links(fp, distance) if group[a] == group[b]}


def test_spanning_forest_is_of_the_shortest_links():
    rng = np.random.default_rng(9)
    n, a, b = 60, rng.integers(0, 60, 300), rng.integers(0, 60, 300)
    a, b = a[a != b], b[a != b]
    d = rng.integers(0, 5, len(a))
    chosen = simhash.spanning(n, a, b, d)
    root = list(range(n))
    weight = edges = 0
    for k in sorted(range(len(a)), key=lambda k: d[k]):
        x, y = root[a[k]], root[b[k]]
        if x != y:
            root = [min(x, y) if r in (x, y) else r for r in root]
            weight, edges = weight + d[k], edges + 1
    assert len(chosen) == edges and d[chosen].sum() == weight
    rest, to = simhash.forest(n, a[chosen], b[chosen])
    assert len(rest) == edges
