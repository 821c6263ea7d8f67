"""Near-deduplication: SimHash fingerprints joined through a Gray-order hierarchical index.

Fingerprints are reduced to their distinct values and dealt to groups in which
those that may be near each other meet. The rows are dealt by ranges and sorted
by group and Gray rank, an order in which neighbours differ little; runs of
neighbours become the nodes of a tree, where a node keeps the bit pattern that
all below it share, less what its parent has already. Each run of groups is
joined with itself from the root down: differences add up level by level, and a
pair of nodes is dropped with all below it as soon as the sum passes the distance
or the two hold no group in common. Of the links found only a spanning forest of
the closest leaves the task, so a dense group costs as many rows as it has members.

Two ways of dealing:

- by blocks, for a small distance: two fingerprints within `distance` bits agree
  on at least one of distance + 1 blocks, so no link is lost. A group is the Gray
  rank of a block's bits. Groups of more than `group_rows` members are dealt
  again by the blocks of their remaining bits, which loses nothing either.
- by bands (`band_edges`), for a share of differing bits: pairs meet that agree on
  all of one band of bits, which most of the near ones do, but not all.

For a similarity of shingle sets (`similar`) the links within `distance` bits are
held against the sets themselves: the closest of each fingerprint first, then
those between texts that aren't in one group by then. At a Jaccard similarity of
0.8 about 15 % of the bits differ, which no few blocks and not all bands survive.
So all pairs of sets that aren't connected so far and share one of their first
shingles, in an order that is the same for all, are held against each other too:
a set of n has so many first ones that any similar set must have one of them.

Components come from the forests' edges by rounds of hanging each fingerprint on
its least neighbour and doubling the pointers, written to the shared folder.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, cut, slices

SHINGLE = 3
DISTANCE = 3
#: Members of a block's group that one task joins; larger groups are dealt again by further blocks.
GROUP_ROWS = 2048
#: Bits left to deal by at which a group is bounded by their number alone, 2 ** LAST_BITS.
LAST_BITS = 11
#: Members of a leaf, and children of a node, of the index.
FAN = 16
#: Rows whose tree is built at once, at least; a run ends where a group ends.
RUN = 1 << 12
#: Pairs of nodes whose children are compared at once.
PAIRS = 1 << 11
#: Members of a band's group, at most, of which all links are held against the texts.
ALL_OF = 8
#: Texts of a slice that a frequent shingle is in, the most such shingles, and the digests that a task remembers.
FREQUENT_IN, MOST_FREQUENT, SEEN = 4, 500_000, 200_000
#: Sets of a token of which all pairs are made where the token's rows lie; sets of a larger token that its others are held against first.
FEW, HEADS = 8, 4
#: Sets of a larger token meet by steps of their sizes; each is so many times the one before.
SIZE_STEP = 1.08
#: Shingles of sets that a task keeps while it compares pairs.
REMEMBERED = 1 << 20
#: Shingles that are hashed at once.
HASHED = 1 << 14
#: 64-bit words of fingerprint bits that bands are drawn from.
WORDS = 8
#: Share of the pairs at the similarity itself that meet in some band.
RECALL = 0.98
#: Standard deviations above the bits that pairs at the similarity differ in, at which the tree drops a pair.
SPARE = 3.5
#: Odd factors that make more words of one hash (2**64 over the golden ratio, and a prime of XXH64).
FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def shingles(text: str | None, width: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the shingles of a text, repeats included, HASHED at a time: words in ASCII lower case, width of them each."""
    words = (text or "").encode().lower().split()  # bytes.split: at [\\x20\\x09-\\x0D]+
    if not words:
        return
    joined, n = b" ".join(words), max(1, len(words) - width + 1)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    first, last, digest = starts[:n].tolist(), (starts[min(width, len(words)) :][:n] - 1).tolist(), xxhash.xxh64_intdigest
    for k in range(0, n, HASHED):
        yield np.array([digest(joined[i:j], 42) for i, j in zip(first[k : k + HASHED], last[k : k + HASHED], strict=True)], np.uint64)


def counted(h: np.ndarray) -> np.ndarray:
    """How many of the hashes (rows x words) have each bit set, highest bit of the first word first."""
    bits = np.unpackbits(np.ascontiguousarray(h).astype(">u8").view(np.uint8).reshape(len(h), -1), axis=1).view(np.uint64)
    return sum(np.add.reduce(bits[k : k + 255], axis=0).view(np.uint8).astype(np.int64) for k in range(0, len(h), 255))  # eight counts side by side in a word


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a text, by their hashes, ascending."""
    return np.unique(np.concatenate([*shingles(text, width), np.zeros(0, np.uint64)]))


def sketch(text: str | None, width: int = SHINGLE, words: int = 1) -> np.ndarray:
    """64 * words SimHash bits of a text, repeats included, as words; the first is made of the hashes themselves. Without a word all are zero."""
    return sketch_of(shingles(text, width), words)


def sketch_of(hashes: Iterable[np.ndarray], words: int) -> np.ndarray:
    """64 * words SimHash bits of all hashes, as words."""
    count, n = 0, 0
    for h in hashes:
        own = [h]
        for k in range(1, words):
            x = (h ^ np.uint64(k)) * FACTORS[0]
            own.append((x ^ x >> np.uint64(29)) * FACTORS[1])
            own[-1] ^= own[-1] >> np.uint64(32)
        count, n = count + counted(np.stack(own, axis=1)), n + len(h)
    if not n:
        return np.zeros(words, np.uint64)
    return np.packbits(count * 2 > n).view(">u8").astype(np.uint64)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text."""
    return int(sketch(text, width)[0])


@functools.cache
def band_bits(bits: int, bands: int, words: int) -> np.ndarray:
    """The places of each band's bits among 64 * words, the same for every call; all places are used about equally often."""
    rng, out = np.random.default_rng(42), []
    for _ in range(bands):
        out.append(rng.choice(64 * words, bits, replace=False))
    return np.array(out)


def fingerprints(docs: DataFrame, text: str = "text", width: int = SHINGLE, row: str | None = None, bits: int = 0, bands: int = 0, sets: bool = False) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each row of docs, `row` from the column of that name given.

    With sets, or bands, bits are made of the set of shingles, without repeats, as
    it is sets that are compared: a word that fills a text would decide all bits.
    Then there is a digest of the set too, and with bands their keys (array).
    """
    sets = sets or bands > 0
    more = [] if row is None else [T.StructField("row", T.LongType())]
    keyed = [T.StructField("digest", T.LongType())] * sets + [T.StructField("keys", T.ArrayType(T.LongType()))] * (bands > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, weigh = (band_bits(bits, bands, WORDS), np.uint64(1) << np.arange(bits, dtype=np.uint64)) if bands else (None, None)
        for batch in slices(batches):
            texts, digests = batch.column(1).to_pylist(), []
            if sets:
                words = WORDS if bands else 1
                own = np.zeros((batch.num_rows, words), np.uint64)
                for k, text_ in enumerate(texts):
                    h = shingle_set(text_, width)
                    own[k] = sketch_of((h[i : i + HASHED] for i in range(0, len(h), HASHED)), words)
                    digests.append(xxhash.xxh64_intdigest(h.tobytes(), 42))
            else:
                own = np.array([sketch(x, width) for x in texts], np.uint64).reshape(batch.num_rows, -1)
            columns = [batch.column(0), pa.array(np.ascontiguousarray(own[:, 0]).view(np.int64)), *batch.columns[2:]]
            if sets:
                columns.append(pa.array(np.array(digests, np.uint64).view(np.int64)))
            if bands:
                flat = np.unpackbits(own.astype(">u8").view(np.uint8).reshape(len(own), -1), axis=1)
                key = (flat[:, where].astype(np.uint64) * weigh).sum(axis=2, dtype=np.uint64) | np.arange(bands, dtype=np.uint64) << np.uint64(bits)
                columns.append(pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * bands), pa.array(key.ravel().view(np.int64))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", *(f.name for f in more + keyed)])

    return docs.select("doc_id", text, *([] if row is None else [row])).mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("fp", T.LongType()), *more, *keyed]))


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each fingerprint in the Gray code sequence."""
    rank = fp.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    return rank


def gray(fp: Column) -> Column:
    """gray_rank() of a column of signed longs."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp


def links(fp: np.ndarray, distance: int = DISTANCE, fan: int = FAN, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i, j), i < j, of the fingerprints fp that differ in distance bits or fewer and lie in one group.

    group: ascending numbers; the fingerprints of a group are distinct. Without it all are one group.
    """
    group = np.zeros(len(fp), np.int64) if group is None else group
    if len(fp) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((gray_rank(fp), group))
    levels = [(fp[order], np.full(len(fp), ~np.uint64(0)), group[order], group[order])]
    while len(levels[-1][0]) > 1:  # upward: what the members of each run have in common, and which groups it spans
        v, m, low, high = levels[-1]
        at = np.arange(0, len(v), fan)
        both = np.bitwise_and.reduceat(m, at) & ~(np.bitwise_or.reduceat(v, at) ^ np.bitwise_and.reduceat(v, at))
        levels.append((np.bitwise_and.reduceat(v, at) & both, both, low[at], np.maximum.reduceat(high, at)))
    i, j, sum_ = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    step = np.arange(fan)
    for level in range(len(levels) - 2, -1, -1):  # downward: children of the pairs that are left
        v, m, low, high = levels[level]
        up = levels[level + 1][1]
        found = []
        for k in range(0, len(i), PAIRS):
            a = (i[k : k + PAIRS, None, None] * fan + step[None, :, None]).repeat(fan, 2).ravel()
            b = (j[k : k + PAIRS, None, None] * fan + step[None, None, :]).repeat(fan, 1).ravel()
            s = sum_[k : k + PAIRS].repeat(fan * fan)
            ok = (a < len(v)) & (b < len(v)) & ((a < b) if level == 0 else (a <= b))
            a, b, s = a[ok], b[ok], s[ok]
            ok = low[b] <= high[a]  # as a comes first
            a, b, s = a[ok], b[ok], s[ok]
            known = up[a // fan] & up[b // fan]  # counted above already
            s = s + np.bitwise_count((v[a] ^ v[b]) & m[a] & m[b] & ~known)
            ok = s <= distance
            found.append((a[ok], b[ok], s[ok]))
        i, j, sum_ = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in zip(*found, strict=True)) if found else (i[:0], j[:0], sum_[:0])
    a, b = order[i], order[j]
    return np.minimum(a, b), np.maximum(a, b)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (a, b) among n members: each member that isn't the first of its component, with that first one."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    rest = np.flatnonzero(root != np.arange(n))
    return rest, root[rest]


def spanning(n: int, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Which of the links (a, b) of lengths d among n members make a forest of the shortest: each component picks its shortest way out until none is left."""
    root, rest, chosen = np.arange(n), np.arange(len(a)), [np.zeros(0, np.int64)]
    while True:
        rest = rest[root[a[rest]] != root[b[rest]]]
        if not len(rest):
            return np.concatenate(chosen)
        key, best = d[rest].astype(np.int64) * len(a) + rest, np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(best, root[a[rest]], key)
        np.minimum.at(best, root[b[rest]], key)
        picked = np.unique(best[best < np.iinfo(np.int64).max]) % len(a)
        chosen.append(picked)
        moved, to = forest(n, root[a[picked]], root[b[picked]])
        new = np.arange(n)
        new[moved] = to
        root = new[root]


def edges_of(batches: Iterator[pa.RecordBatch], distance: int, all_of: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows (way, block, fp, node) that come group by group (way and block), as edges (a, b, d) between nodes of each group's forest; all links of groups of all_of members at most."""
    left = tuple(np.zeros(0, np.int64) for _ in range(4))
    for batch in ended(batches):
        own = left if batch is None else tuple(np.concatenate([x, batch.column(c).to_numpy().astype(np.int64)]) for x, c in zip(left, ("way", "block", "fp", "node" if batch.num_columns > 3 else "fp"), strict=True))
        way, block, fp, node = own
        changes = np.concatenate([way[:1] == way[:1], (way[1:] != way[:-1]) | (block[1:] != block[:-1])])
        starts = np.flatnonzero(changes)
        done = len(fp) if batch is None else int(starts[-1]) if len(starts) else 0  # the last group may go on
        if batch is not None and done < RUN:
            left = own
            continue
        left = tuple(x[done:] for x in own)
        out = [(np.zeros(0, np.int64),) * 3]
        cuts = np.unique(starts[np.searchsorted(starts, np.arange(0, done, RUN)).clip(max=len(starts) - 1)]).tolist() if done else []
        for s, e in zip(cuts, [*cuts[1:], done], strict=False):
            if s >= e:
                continue
            keys, group = fp[s:e].view(np.uint64), np.cumsum(changes[s:e])
            x, y = links(keys, distance, group=group)
            d = np.bitwise_count(keys[x] ^ keys[y])
            small = np.bincount(group)[group[x]] <= all_of
            more = np.flatnonzero(~small)
            use = np.concatenate([np.flatnonzero(small), more[spanning(e - s, x[more], y[more], d[more])]])
            out.append((node[s:e][x[use]], node[s:e][y[use]], d[use].astype(np.int64)))
        a, b, d = (np.concatenate(c) for c in zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(d.astype(np.int32))], names=["a", "b", "d"])


def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def blocks_of(free: int, n: int) -> list[int]:
    """The bits of the mask free, cut into n masks of nearly equal size."""
    bits = [1 << k for k in range(64) if free >> k & 1]
    return [sum(bits[len(bits) * k // n : len(bits) * (k + 1) // n]) for k in range(n)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_edges(fps: DataFrame, distance: int = DISTANCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges (a, b, d) that connect the distinct fingerprints fps (fp) exactly as all links within distance do; with a column node, those of the nodes that have them."""
    more = [c for c in fps.columns if c == "node"]
    n, free, must, level = distance + 1, [(1 << 64) - 1], [0], 0
    rows, out = fps.select("fp", *more, F.lit(0).alias("path")), []
    while True:
        must = [m | b for m, f in zip(must, free, strict=True) for b in blocks_of(f, n)]
        free = [f & ~b for f in free for b in blocks_of(f, n)]
        agree = F.array(*(F.lit(signed(m)) for m in must))
        ways = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.col("path") * n + k)
        dealt = rows.select("fp", *more, F.explode(ways).alias("way")).withColumn("block", gray(F.col("fp").bitwiseAND(F.get(agree, "way"))))
        last = max(f.bit_count() for f in free) <= LAST_BITS
        hot = None if last else cut(dealt.groupBy("way", "block").agg(F.count("*").alias("n")).where(F.col("n") > group_rows).select("way", "block"), "simhash-hot")
        full = hot is not None and hot.limit(1).count() > 0
        cold = dealt.join(bounded(hot), ["way", "block"], "left_anti") if full else dealt
        out.append(tree_edges(cold, distance))
        if not full:
            return functools.reduce(DataFrame.unionAll, out)
        rows, level = cut(dealt.join(bounded(hot), ["way", "block"], "left_semi").select("fp", *more, F.col("way").alias("path")), "simhash-again"), level + 1


def tree_edges(dealt: DataFrame, distance: int, all_of: int = 0) -> DataFrame:
    """Edges of the groups (way, block) of dealt (way, block, fp, perhaps node): ranges of the order by group and Gray rank, a tree over each run."""
    ordered = dealt.select("way", "block", "fp", *(c for c in dealt.columns if c == "node")).repartitionByRange("way", "block").sortWithinPartitions("way", "block", gray(F.col("fp")))
    return cut(ordered.mapInArrow(lambda it: edges_of(it, distance, all_of), "a long, b long, d int"), "simhash-edges")


def differing(similar: float) -> float:
    """The share of SimHash bits that two equally long shingle sets of Jaccard similarity similar differ in."""
    return math.acos(2 * similar / (1 + similar)) / math.pi


def bands_for(rows: int, similar: float) -> tuple[int, int]:
    """Bits of a band, about those of the number of rows, and how many bands bring RECALL of the pairs at the similarity together."""
    bits = max(8, math.ceil(math.log2(max(2, rows))))
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - differing(similar)) ** bits))


def band_edges(dealt: DataFrame, similar: float, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges (a, b, d) of nodes that meet in a band's group: dealt (way, block, fp, perhaps node).

    A group of more than group_rows members is dealt again by eight more bits, in
    as many ways as keep the number of meetings of a pair at the similarity; after
    all 64 bits a group has one member.
    """
    p, out, more = differing(similar), [], [c for c in dealt.columns if c == "node"]
    distance, ways = int(64 * p + SPARE * math.sqrt(64 * p * (1 - p))), math.ceil((1 - p) ** -8)
    for level in range(9):
        hot = cut(dealt.groupBy("way", "block").agg(F.count("*").alias("n")).where(F.col("n") > group_rows).select("way", "block"), "simhash-hot")
        full = hot.limit(1).count() > 0
        out.append(tree_edges(dealt.join(bounded(hot), ["way", "block"], "left_anti") if full else dealt, distance, ALL_OF))
        if not full:
            break
        masks = F.array(*(F.lit(signed(sum(1 << int(k) for k in np.random.default_rng(r).permutation(64)[8 * level : 8 * level + 8]))) for r in range(ways)))
        again = dealt.join(bounded(hot), ["way", "block"], "left_semi").select("way", "block", "fp", *more, F.posexplode(masks).alias("k", "mask"))
        dealt = cut(again.select((F.col("way") * ways + F.col("k")).alias("way"), F.xxhash64("block", F.col("fp").bitwiseAND(F.col("mask"))).alias("block"), "fp", *more), "simhash-again")
    return functools.reduce(DataFrame.unionAll, out)


def similar_edges(edges: DataFrame, heads: DataFrame, texts: DataFrame, width: int, similar: float) -> DataFrame:
    """The edges (a, b) whose shingle sets have a Jaccard similarity of similar or more. heads: (node, row), one for each node; texts: (row, text).

    Only the texts that some edge ends in are read again. They meet deflated, in a third of
    the bytes that the hashes of their shingles have, which are made where a pair is compared.
    """
    edges = cut(edges.select("a", "b").distinct(), "simhash-pairs")

    def deflated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = [zlib.compress((x or "").encode(), 6) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["node", "packed"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        size = 0

        def of(node: int, packed: bytes) -> np.ndarray:
            nonlocal size
            if node not in sets:
                own = shingle_set(zlib.decompress(packed).decode(), width)
                if size + len(own) > REMEMBERED:
                    sets.clear()
                    size = 0
                sets[node], size = own, size + len(own)
            return sets[node]

        for batch in slices(batches):
            ok = []
            for a, b, x, y in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                x, y = of(a, x), of(b, y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= similar * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    ends = cut(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(heads, "node"), "simhash-ends")
    own = cut(texts.join(bounded(ends), "row").select("node", "text").mapInArrow(deflated, "node long, packed binary"), "simhash-texts")
    joined = edges.join(own.toDF("a", "x"), "a").join(own.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return cut(joined.mapInArrow(compare, "a long, b long"), "simhash-similar")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is one node of its component, the same for all of it.

    Each round hangs every node on its least neighbour, follows these pointers to
    their ends by doubling, and keeps the edges between different ends; at least
    half of the nodes that still have edges vanish in a round.
    """
    edges, found = cut(edges.select("a", "b").where("a != b").distinct(), "edges"), None
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root")), "pointers")
        while True:
            above = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = cut(up.join(above, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "pointers")
            up = jumped.select("node", "root")
            if not jumped.where("moved").limit(1).count():
                break
        if found is None:
            found = up
        else:
            above = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = cut(found.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        a, b = up.toDF("a", "ra"), up.toDF("b", "rb")
        edges = cut(edges.join(a, "a").join(b, "b").where("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    return found if found is not None else edges.toDF("node", "root")


def confirmed(edges: DataFrame, heads: DataFrame, texts: DataFrame, width: int, similar: float) -> DataFrame:
    """Edges (a, b) that connect nodes as all edges (a, b, d) do whose texts are similar enough.

    Of each node the closest edge is held against the texts first; then
    all others, but those whose ends are connected by then.
    """
    pairs = cut(edges.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("d").alias("d")), "simhash-candidates")
    ways = pairs.select(F.inline(F.array(F.struct(F.col("a").alias("end"), "a", "b", "d"), F.struct(F.col("b").alias("end"), "a", "b", "d"))))
    closest = cut(ways.groupBy("end").agg(F.min(F.struct("d", "a", "b")).alias("x")).select("x.a", "x.b").distinct(), "simhash-closest")
    first = similar_edges(closest, heads, texts, width, similar)
    group = components(first)
    others = pairs.join(closest, ["a", "b"], "left_anti").join(group.toDF("a", "ra"), "a", "left").join(group.toDF("b", "rb"), "b", "left")
    others = others.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")
    return first.unionByName(similar_edges(others, heads, texts, width, similar))


def told_apart(rows: DataFrame, texts: DataFrame, width: int, similar: float) -> DataFrame:
    """(fp, digest, node, first) for each distinct set of shingles of rows (doc_id, fp, row, digest): texts of one fingerprint share a node only if they are similar.

    The first set of a fingerprint is its node; the others are held against it.
    Those that aren't similar choose a first one among themselves, round by round.
    """
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    units = cut(rows.groupBy("fp", "digest").agg(F.min(first).alias("first")), "simhash-units")
    several = cut(units.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "simhash-several")
    single = units.join(bounded(several), "fp", "left_anti").select("fp", "digest", F.col("fp").alias("node"), "first")
    open_, out, named = cut(units.join(bounded(several), "fp", "left_semi").withColumn("unit", F.xxhash64("fp", "digest")), "simhash-open"), [single], F.col("fp")
    while open_.limit(1).count():
        heads = open_.groupBy("fp").agg(F.min_by(F.struct("unit", "first"), "first").alias("head")).select("fp", F.col("head.unit").alias("head"))
        paired = cut(open_.join(heads, "fp"), "simhash-paired")
        alike = similar_edges(paired.where("unit <> head").select(F.col("unit").alias("a"), F.col("head").alias("b")), paired.select(F.col("unit").alias("node"), F.col("first.row").alias("row")), texts, width, similar)
        judged = cut(paired.join(alike.select(F.col("a").alias("unit"), F.lit(True).alias("same")), "unit", "left").withColumn("same", F.col("same").isNotNull() | (F.col("unit") == F.col("head"))), "simhash-judged")
        out.append(judged.where("same").select("fp", "digest", (named if named is not None else F.col("head")).alias("node"), "first"))
        open_, named = judged.where("not same").select(*open_.columns), None
    return cut(functools.reduce(DataFrame.unionAll, out), "simhash-nodes")


def frequent(texts: DataFrame, width: int) -> list[int]:
    """Shingles that are in FREQUENT_IN texts or more of some slice of 500, rarest first, at most MOST_FREQUENT of them.

    They only decide which shingles a text is looked up by, so what it costs: prefixes() loses no pair in any order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = np.concatenate([np.zeros(0, np.uint64), *(shingle_set(x, width) for x in batch.column(0).to_pylist())])
            h, n = np.unique(own, return_counts=True)
            keep = n >= FREQUENT_IN
            yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], names=["token", "n"])

    found = texts.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return [row.token for row in reversed(found.orderBy(F.desc("n"), "token").limit(MOST_FREQUENT).collect())]


def least_shared(n: int, similar: float) -> int:
    """How many shingles of a set of n any set of that similarity to it has, at least."""
    return math.ceil(similar * n - 1e-9)


def prefixes(texts: DataFrame, width: int, similar: float) -> DataFrame:
    """Rows (token, unit, n, units, before): of each distinct set of shingles (unit: its digest, n: its size) as many as two similar sets can't differ in, so they share one of these.

    All sets take the first ones of one order, frequent shingles last. Tokens of a single set are left out. units: sets
    of the token; before: those (unit, n) that come before the row's own, of tokens of FEW sets at most.
    """
    last = texts.sparkSession.sparkContext.broadcast(np.array(frequent(texts, width), np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_value, seen = np.argsort(last.value), set()
        ordered = last.value[by_value]
        for batch in slices(batches):
            tokens, units, sizes, counts = [np.zeros(0, np.uint64)], [], [], []
            for text in batch.column(0).to_pylist():
                h = shingle_set(text, width)
                unit = xxhash.xxh64_intdigest(h.tobytes(), 42)
                if unit in seen or not len(h):
                    continue
                seen.add(unit)
                if len(ordered):
                    at = np.searchsorted(ordered, h).clip(max=len(ordered) - 1)
                    place = np.where(ordered[at] == h, by_value[at], -1)
                    h = h[np.argsort(place, kind="stable")]
                own = h[: len(h) - least_shared(len(h), similar) + 1]
                tokens.append(own)
                units.append(unit)
                sizes.append(len(h))
                counts.append(len(own))
            if len(seen) > SEEN:
                seen.clear()
            columns = [np.concatenate(tokens).view(np.int64), np.repeat(np.array(units, np.uint64), counts).view(np.int64), np.repeat(np.array(sizes, np.int64), counts).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "unit", "n"])

    dealt = texts.select("text").mapInArrow(run, "token long, unit long, n int").repartition("token").dropDuplicates(["token", "unit"])
    several = dealt.withColumn("units", F.count("*").over(Window.partitionBy("token"))).where("units > 1")
    last_few = F.collect_list(F.struct("unit", "n")).over(Window.partitionBy("token").orderBy("unit").rowsBetween(1 - FEW, -1))
    return cut(several.withColumn("before", F.when(F.col("units") <= FEW, last_few)).select("token", "unit", "n", "units", "before"), "simhash-prefixes")


def enough(shared: Column, n: Column, m: Column, similar: float) -> Column:
    """Whether sets of n and m shingles may be similar if they share so many tokens of prefixes(): what lies behind the prefix of the larger set is all that they can share besides."""
    larger, smaller = F.greatest(n, m), F.least(n, m)
    return (smaller + 1e-9 >= larger * similar) & (shared + F.ceil(larger * similar - 1e-9) - 1 + 1e-6 >= (n + m) * (similar / (1 + similar)))


def many_left(shared: DataFrame) -> DataFrame:
    """Rows (token, unit, n, left, many) of prefixes() for the tokens of more than FEW sets. many: so many of them the unit has; left: those from the row's on, rarest first."""
    by_unit = Window.partitionBy("unit")
    placed = shared.where("before is null").withColumn("many", F.count("*").over(by_unit).cast("int"))
    left = F.col("many") - F.row_number().over(by_unit.orderBy("units", "token")) + 1
    return cut(placed.select("token", "unit", "n", left.cast("int").alias("left"), "many"), "simhash-many")


def met_few(shared: DataFrame, many: DataFrame, similar: float) -> DataFrame:
    """(a, b, score) of all pairs of sets that share a token of FEW sets at most and may be similar, if they share all of those in more sets that one of them has."""
    sets = bounded(cut(many.groupBy("unit").agg(F.first("many").alias("many")), "simhash-crowd"))
    pairs = shared.select(F.col("unit").alias("unit_a"), F.col("n").alias("n_a"), F.explode("before").alias("x")).select("unit_a", "n_a", F.col("x.unit").alias("unit_b"), F.col("x.n").alias("n_b"))
    pairs = pairs.groupBy("unit_a", "n_a", "unit_b", "n_b").agg(F.count("*").cast("int").alias("c"))
    pairs = pairs.join(sets.toDF("unit_a", "many_a"), "unit_a", "left").join(sets.toDF("unit_b", "many_b"), "unit_b", "left")
    most = F.col("c") + F.least(F.coalesce("many_a", F.lit(0)), F.coalesce("many_b", F.lit(0)))
    pairs = pairs.where(enough(most, F.col("n_a"), F.col("n_b"), similar))
    return pairs.select(F.least("unit_a", "unit_b").alias("a"), F.greatest("unit_a", "unit_b").alias("b"), (F.col("c") / F.greatest("n_a", "n_b")).alias("score"))


def met_heads(many: DataFrame, similar: float) -> DataFrame:
    """(a, b, score) of the sets of many (many_left()) and HEADS sets of each of their tokens: of each share of the sets the one with the fewest shingles of its own."""
    room = F.struct((-F.col("many") / F.col("n")).alias("room"), "unit", "n", "left")
    heads = many.groupBy("token").agg(F.array_compact(F.array(*(F.min(F.when(F.pmod(F.xxhash64("unit"), F.lit(HEADS)) == k, room)) for k in range(HEADS)))).alias("heads"))
    fits = F.filter("heads", lambda x: (x["unit"] != F.col("unit")) & enough(F.least("left", x["left"]), F.col("n"), x["n"], similar))
    met = many.join(heads, "token").select("unit", "n", F.explode(fits).alias("x"))
    met = met.select(F.least("unit", "x.unit").alias("a"), F.greatest("unit", "x.unit").alias("b"), F.greatest("n", "x.n").alias("n"))
    return met.groupBy("a", "b").agg((F.count("*") / F.max("n")).alias("score"))


def met_apart(many: DataFrame, own: DataFrame, similar: float) -> DataFrame:
    """(a, b) of all pairs of sets of many (many_left()) that may be similar, share no token of FEW sets at most and have different roots in own (unit, root).

    The first token that such a pair shares leaves each set with `left` tokens to share. So the sets meet by
    token and by steps of both sizes, that of the smaller and that of the larger set, between which that
    is enough: a set with many shingles of its own, which only much larger or smaller
    ones could be similar to, doesn't meet the many sets that are as large as it is.
    Of the pairs that meet all shared tokens are counted.
    """
    rooted = cut(many.join(bounded(own), "unit"), "simhash-rooted")
    mixed = cut(rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token"), "simhash-mixed")
    rooted = cut(rooted.join(bounded(mixed), "token", "left_semi"), "simhash-rooted")
    n, left, part = F.col("n"), F.col("left"), similar / (1 + similar)

    def step(size: Column) -> Column:
        return F.floor(F.log(size) / math.log(SIZE_STEP)).cast("int")

    largest, smallest = F.floor(n / similar + 1e-6), F.ceil(n * similar - 1e-6)
    from_ = F.greatest(n, F.ceil((n * part - left) / (similar - part) - 1e-6))  # of the larger set, if the row's is the smaller
    to = F.least(n, F.floor((left + F.ceil(n * similar - 1e-9) - 1) / part - n + 1e-3))  # of the smaller set, if the row's is the larger
    smaller = rooted.where(from_ <= largest).select("token", step(n).alias("small"), F.explode(F.sequence(step(from_), step(largest))).alias("large"), *(F.col(c).alias(f"{c}_a") for c in ("unit", "n", "left", "root")))
    larger = rooted.where(to >= smallest).select("token", F.explode(F.sequence(step(smallest), step(to))).alias("small"), step(n).alias("large"), *(F.col(c).alias(f"{c}_b") for c in ("unit", "n", "left", "root")))
    ordered = (F.col("n_a") < F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (F.col("unit_a") < F.col("unit_b"))
    met = smaller.join(larger, ["token", "small", "large"]).where(ordered & (F.col("root_a") != F.col("root_b")) & enough(F.least("left_a", "left_b"), F.col("n_a"), F.col("n_b"), similar))
    met = cut(met.select("unit_a", "n_a", "unit_b", "n_b").distinct(), "simhash-met-apart")
    tokens = bounded(cut(many.groupBy("unit").agg(F.collect_list("token").alias("tokens")), "simhash-tokens"))
    met = met.join(tokens.toDF("unit_a", "tokens_a"), "unit_a").join(tokens.toDF("unit_b", "tokens_b"), "unit_b")
    met = met.where(enough(F.size(F.array_intersect("tokens_a", "tokens_b")), F.col("n_a"), F.col("n_b"), similar))
    return met.select(F.least("unit_a", "unit_b").alias("a"), F.greatest("unit_a", "unit_b").alias("b"))


def missing_edges(shared: DataFrame, units: DataFrame, edges: DataFrame, texts: DataFrame, width: int, similar: float) -> DataFrame:
    """Edges (a, b) of nodes for all pairs of sets of the similarity or more that edges don't connect. shared: of prefixes(); units: (unit, node, row).

    Of a token of few sets all pairs are made where its rows lie. First each group of connected sets is held
    against the set that it shares most with, of these pairs and of HEADS sets of each larger token; then all
    others of these that aren't connected by then; then all pairs that share larger tokens only, enough
    of them to be similar, and aren't connected by then, however large a token's group.
    """
    many = many_left(shared)
    pairs = cut(met_few(shared, many, similar).unionByName(met_heads(many, similar)).groupBy("a", "b").agg(F.max("score").alias("score")), "simhash-met")
    out, tried = [], []

    def own() -> DataFrame:
        roots = components(functools.reduce(DataFrame.unionAll, [edges.select("a", "b"), *out]))
        return cut(units.join(bounded(roots), "node", "left").select("unit", "node", F.coalesce("root", "node").alias("root")), "simhash-rooted-units")

    def compare(now: DataFrame) -> None:
        now = cut(now.select("a", "b"), "simhash-tried")
        tried.append(now)
        alike = similar_edges(now, units.select(F.col("unit").alias("node"), "row"), texts, width, similar)
        nodes = bounded(cut(units.select("unit", "node"), "simhash-unit-nodes"))
        out.append(cut(alike.join(nodes.toDF("a", "na"), "a").join(nodes.toDF("b", "nb"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b")), "simhash-missing"))

    def apart() -> DataFrame:
        rooted = bounded(own().select("unit", "root"))
        return cut(pairs.join(rooted.toDF("a", "ra"), "a").join(rooted.toDF("b", "rb"), "b").where("ra <> rb"), "simhash-apart")

    pairs = apart()
    best = F.struct("score", "a", "b")
    ways = pairs.select(F.explode(F.array("ra", "rb")).alias("root"), best.alias("x"))
    compare(ways.groupBy("root").agg(F.max("x").alias("x")).select("x.a", "x.b").distinct())
    pairs = pairs.select("a", "b", "score").join(tried[0], ["a", "b"], "left_anti")
    compare(apart())
    now = met_apart(many, own().select("unit", "root"), similar)
    compare(now.join(functools.reduce(DataFrame.unionAll, tried), ["a", "b"], "left_anti"))
    return functools.reduce(DataFrame.unionAll, out)


def near_groups(docs: DataFrame, text: str = "text", width: int = SHINGLE, distance: int = DISTANCE, group_rows: int = GROUP_ROWS, row: str | None = None, similar: float | None = None) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 lowercase hex digits), component_id, kept.

    component_id is the smallest doc_id that links lead to, its own included
    (null only if all of them are null). One row of each component is kept: the
    one with that doc_id that comes first. Texts without a word, null ones too,
    have fingerprint zero and link like any other; a text with fewer words than
    width is one shingle. Repeated rows and ties are members like any other. An
    empty table gives no rows. Other columns of docs are ignored.

    Without similar, fingerprints link at distance bits or fewer, all such links.
    With it, texts link whose sets of shingles have at least that Jaccard
    similarity, all such links, held against the texts themselves: first those
    within distance bits, then all pairs of sets not connected so far that share
    one of as many shingles as similar sets can't differ in. Texts of one
    fingerprint are held against the first of them, too, unless their sets are
    the same.

    row: a column of docs with an id (long) for each row, in the order of the
    files; the verdicts have it as well.
    """
    if similar is not None and row is None:
        docs = cut(docs.select("doc_id", F.col(text).alias(text), F.monotonically_increasing_id().alias("__row")), "simhash-docs")
    given = row or ("__row" if similar is not None else None)
    rows = fingerprints(docs, text, width, given, sets=similar is not None)
    rows = cut(rows if given is not None else rows.withColumn("row", F.monotonically_increasing_id()), "simhash-rows")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    if similar is None:
        key, nodes = ["fp"], cut(rows.groupBy("fp").agg(F.min(first).alias("first")), "simhash-fps")
        edges = near_edges(nodes, distance, group_rows)
        nodes = nodes.withColumn("node", F.col("fp"))
    else:
        texts = docs.select(F.col(given).alias("row"), F.col(text).alias("text"))
        key, nodes = ["fp", "digest"], told_apart(rows, texts, width, similar)
        firsts = cut(nodes.groupBy("node", "fp").agg(F.min("first").alias("first")), "simhash-fps")
        heads = firsts.select("node", F.col("first.row").alias("row"))
        edges = confirmed(near_edges(firsts.select("fp", "node"), distance, group_rows), heads, texts, width, similar)
        units = nodes.select(F.col("digest").alias("unit"), "node", F.col("first.row").alias("row"))
        edges = edges.unionByName(missing_edges(prefixes(texts, width, similar), units, edges, texts, width, similar))
    roots = cut(components(edges), "simhash-roots")
    if similar is None:
        grouped = nodes.join(roots, "node")
    else:  # sets of one node are one group, linked further or not
        grouped = nodes.join(bounded(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    linked = grouped.join(grouped.groupBy("root").agg(F.min("first").alias("least")), "root").select(*key, "least")
    heads = cut(nodes.join(bounded(cut(linked, "simhash-linked")), key, "left").select(*key, F.coalesce("least", "first").alias("head")), "simhash-heads")
    return rows.join(heads, key).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head.doc_id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("kept"),
        *([] if row is None else [F.col("row").alias(row)]),
    )
