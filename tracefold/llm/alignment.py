"""Cross-tokenizer alignment by interval coalescing.

A text encoded by two tokenizers, A and B, is tiled twice by byte ranges. The
tokens of both are sorted by start (lexsort: start, then tokenizer) and the
running maximum of their ends is taken; a group breaks where a start reaches it,
which is where a token of A and one of B end together. Within a group all A-B
pairs are linked. This is done for many texts at once, laid end to end.

The links of id pairs are counted over the corpus as the number of documents that
hold them. A task sums what it has read before anything is shuffled. Looking
the counts up again would send most rows to the few pairs that occur everywhere,
so the pairs with more than 1 / HOT_PAIRS of all rows, fewer than HOT_PAIRS by
their definition, go to every task as sorted arrays; the rest are joined.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import MAX_TOKENIZER_BYTES, RARE_SPACE, ForcedBoundaryBPE, bytes_of
from .common import cut, slices
from .merge_replay import summed

#: Pairs whose counts are sent to every task, at most: 17 bytes each.
HOT_PAIRS = 1_000_000
#: Bits of a B id in the key of an id pair.
B_BITS = 24
#: Links of a group above which its ids are summed before they are paired.
LARGE_GROUP = 4096
#: Links that are paired at once.
LINKS = 1 << 21
#: Links of a task's documents that are summed together before the shuffle.
SUMMED = 1 << 22
#: What stands for a space in pieces (fixed value).
SPACE_MARK = "▁"


class ByteLevel(ForcedBoundaryBPE):
    """Tokenizer A: a byte-level vocabulary in which the strings of special tokens are ordinary text."""

    def __init__(self, text: str):
        super().__init__(text)
        self._special, self._odd = None, RARE_SPACE


def piece_bytes(piece: str) -> bytes:
    """What a piece of tokenizer B stands for: a byte for <0xHH>, else its text with U+2581 as a space."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE_MARK, " ").encode()


class Tiles:
    """The byte strings of a vocabulary, or the texts of its ids."""

    def __init__(self, tokens: list[bytes]):
        self.sizes, self.tokens = np.fromiter(map(len, tokens), np.int64, len(tokens)), pa.array(tokens, pa.binary())

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The byte strings of ids one after the other, and where each begins and the last one ends."""
        return bytes_of(self.tokens.take(pa.array(ids)))


@functools.cache
def marked_ids(most: int) -> Tiles:
    """The decimal ids below most followed by a comma, then all followed by a bar, then by a semicolon."""
    return Tiles([f"{i}{mark}".encode() for mark in ",|;" for i in range(most)])


class Pair:
    """Both tokenizers, built from their files; sent once to each executor. The files' sizes are checked."""

    def __init__(self, spark: SparkSession, byte_level: str, pieces: str):
        with open(byte_level, encoding="utf-8") as f:
            text = f.read()
        with open(pieces, "rb") as f:
            model = f.read()
        if max(len(text), len(model)) > MAX_TOKENIZER_BYTES:
            raise ValueError("a tokenizer file is too large to be sent to every executor")
        self.sent, self.own = spark.sparkContext.broadcast((ByteLevel(text), model)), None

    def __getstate__(self) -> dict:
        return {"sent": self.sent, "own": None}

    def get(self) -> tuple[ForcedBoundaryBPE, sentencepiece.SentencePieceProcessor, Tiles, Tiles]:
        if self.own is None:
            a, model = self.sent.value
            b = sentencepiece.SentencePieceProcessor(model_proto=model)
            self.own = a, b, Tiles(a.token_bytes), Tiles([piece_bytes(b.id_to_piece(i)) for i in range(b.get_piece_size())])
        return self.own


def encoded(texts: pa.StringArray, pair: Pair) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ids of A (of space + text) and of B (of text, which adds the space itself), and how many each text has of either.

    Texts without a character, and those whose tokens of A or B don't join to the bytes of space + text, have none of either.
    """
    a, b, of_a, of_b = pair.get()
    spaced = pa.array([" " + x if x else "" for x in texts.to_pylist()], pa.string())
    ids_a, n_a = a.encode_array(spaced)
    lists = b.encode([x[1:] for x in spaced.to_pylist()], num_threads=1)
    n_b = np.fromiter(map(len, lists), np.int64, len(lists))
    ids_b = np.fromiter(chain.from_iterable(lists), np.int64, int(n_b.sum()))
    data, bounds = bytes_of(spaced)
    good = np.diff(bounds) > 0
    for tiles, ids, n in ((of_a, ids_a, n_a), (of_b, ids_b, n_b)):
        own, at = tiles.joined(ids)
        ends = at[np.concatenate([[0], np.cumsum(n)])]
        good &= np.diff(ends) == np.diff(bounds)
        if len(own) != len(data) or not np.array_equal(own, data):
            for k in np.flatnonzero(good).tolist():
                good[k] = np.array_equal(own[ends[k] : ends[k + 1]], data[bounds[k] : bounds[k + 1]])
    return ids_a[np.repeat(good, n_a)].astype(np.int64), np.where(good, n_a, 0), ids_b[np.repeat(good, n_b)], np.where(good, n_b, 0)


def coalesced(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the group of each token of A and of B, both given by their sizes and tiling the same bytes; tokens without bytes aside, groups are as small as can be."""
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    start = np.concatenate([a_end - a_sizes, b_end - b_sizes])
    which = np.repeat([0, 1], [len(a_sizes), len(b_sizes)])
    order = np.lexsort((which, start))
    reached = np.maximum.accumulate(np.concatenate([a_end, b_end])[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order[1:]] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[: len(a_sizes)], group[len(a_sizes) :]


class Aligned:
    """The groups of a slice of texts."""

    def __init__(self, texts: pa.StringArray, pair: Pair):
        _, _, of_a, of_b = pair.get()
        self.most = max(len(of_a.sizes), len(of_b.sizes))
        self.a, self.n_a, self.b, self.n_b = encoded(texts, pair)
        group_a, group_b = coalesced(of_a.sizes[self.a], of_b.sizes[self.b])
        n = int(group_a[-1]) + 1 if len(group_a) else 0
        self.a_in, self.b_in = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)  # tokens of each group
        owner = np.repeat(np.arange(len(texts)), self.n_a)
        self.text_of = owner[np.cumsum(self.a_in) - 1] if n else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self.text_of, minlength=len(texts))
        self.n_links = summed(self.a_in * self.b_in, self.n_groups)

    def spelled(self) -> list[str]:
        """For each text the SHA-256 (hex) of its groups, written a1,a2|b1;a3|b2,b3; '' where there are none."""
        most, marked = self.most, marked_ids(self.most)
        mark_a, mark_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        mark_a[np.cumsum(self.a_in) - 1], mark_b[np.cumsum(self.b_in) - 1] = 1, 2
        both = np.stack([self.a_in, self.b_in], axis=1).ravel()
        use = np.empty(len(self.a) + len(self.b), np.int64)
        of_a = np.repeat(np.tile([True, False], len(self.a_in)), both)
        use[of_a], use[~of_a] = self.a + most * mark_a, self.b + most * mark_b
        data, at = marked.joined(use)
        out, ends = memoryview(data), at[np.cumsum(self.n_a + self.n_b)].tolist()
        return [hashlib.sha256(out[i : j - 1]).hexdigest() if j > i else "" for i, j in zip([0, *ends], ends, strict=False)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times): each distinct id pair of each text and how many of its links are of that pair; pair is A id << B_BITS | B id. By text, then pair.

        In a group of many links equal ids are summed first.
        """
        n_links = self.a_in * self.b_in
        a_at, b_at = np.cumsum(self.a_in) - self.a_in, np.cumsum(self.b_in) - self.b_in
        parts = []
        usual = np.flatnonzero(n_links <= LARGE_GROUP)
        for use in np.split(usual, np.flatnonzero(np.diff(np.cumsum(n_links[usual]) // LINKS)) + 1) if len(usual) else []:
            n = n_links[use]
            k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            wide = np.repeat(self.b_in[use], n)
            key = self.a[np.repeat(a_at[use], n) + k // wide] << B_BITS | self.b[np.repeat(b_at[use], n) + k % wide]
            parts.append((np.repeat(self.text_of[use], n), key, np.ones(len(key), np.int64)))
        for g in np.flatnonzero(n_links > LARGE_GROUP).tolist():
            (a, m), (b, n) = (np.unique(ids[at[g] : at[g] + size[g]], return_counts=True) for ids, at, size in ((self.a, a_at, self.a_in), (self.b, b_at, self.b_in)))
            key = (a[:, None] << B_BITS | b[None, :]).ravel()
            parts.append((np.full(len(key), self.text_of[g]), key, (m[:, None] * n[None, :]).ravel()))
        if not parts:
            return (np.zeros(0, np.int64),) * 3
        text, key, times = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((key, text))
        text, key, times = text[order], key[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1])]))
        return text[first], key[first], np.add.reduceat(times, first)


def listed(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def plain(column: pa.Array) -> pa.StringArray:
    return column.cast(pa.string()).fill_null("")


def groups(df: DataFrame, pair: Pair, text: str = "text") -> DataFrame:
    """df with a_ids, b_ids (arrays of int) and a_in, b_in (arrays of int): the tokens of text by A and B, and how many of each make up each group, in order.

    All four are empty for texts that are null or empty or that either tokenizer
    changes (its tokens don't join to the bytes of space + text). Columns of these
    names are replaced; all others pass through. No shuffle.
    """
    names = ("a_ids", "b_ids", "a_in", "b_in")
    schema = T.StructType([*(f for f in df.schema if f.name not in names), *(T.StructField(n, T.ArrayType(T.IntegerType(), False), False) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = Aligned(plain(batch.column(text)), pair)
            own = [listed(v.astype(np.int32), n) for v, n in ((x.a, x.n_a), (x.b, x.n_b), (x.a_in, x.n_groups), (x.b_in, x.n_groups))]
            kept = [c for c in batch.schema.names if c not in names]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *own], names=[*kept, *names])

    return df.mapInArrow(run, schema)


#: The columns of each document, besides doc_id, that need no other document.
OWN = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def linked(docs: DataFrame, pair: Pair, text: str = "text") -> DataFrame:
    """doc_id, OWN, pairs (array of long: the distinct id pairs linked, ascending) and times (array of int: how often each) of each row of docs."""
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(f"{OWN}, pairs array<long>, times array<int>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = Aligned(plain(batch.column(1)), pair)
            text_of, key, times = x.links()
            n = np.bincount(text_of, minlength=batch.num_rows)
            own = [pa.array(v.astype(np.int64)) for v in (x.n_a, x.n_b, x.n_groups, x.n_links)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *own, pa.array(x.spelled(), pa.string()), listed(key, n), listed(times.astype(np.int32), n)], names=schema.names)

    return docs.select("doc_id", text).mapInArrow(run, schema)


def counts(links: DataFrame) -> DataFrame:
    """(pair, n, best) of links (pairs): how many rows hold each id pair, and whether no other pair of its A id is held by more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch.column(0).flatten().to_numpy())
                size += len(held[-1])
            if size >= SUMMED or batch is None and size:
                key, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["pair", "n"])
                held, size = [], 0

    n = cut(links.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    first = F.shiftright("pair", B_BITS)
    most = n.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return cut(n.withColumn("a", first).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def scored(links: DataFrame, known: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """links without pairs and times, with n_best (links whose count is the highest of their A id) and count_sum (the counts of all links).

    known: counts(links). No more than hot_pairs of its rows reach the driver and
    the tasks: those with more than 1 / hot_pairs of the sum of n.
    """
    spark = links.sparkSession
    total = known.agg(F.sum("n")).first()[0] or 0
    hot = known.where(F.col("n") * hot_pairs > total).toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast(tuple(hot.column(c).to_numpy() for c in ("pair", "n", "best")))
    kept = [f for f in links.schema if f.name not in ("pairs", "times")]
    schema = T.StructType([*kept, *T.StructType.fromDDL("n_best long, count_sum long, cold_pairs array<long>, cold_times array<int>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = sent.value
        for batch in slices(batches):
            own, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("pairs", "times"))
            sizes = batch.column("pairs").value_lengths().to_numpy()
            at = np.searchsorted(pair, own).clip(max=max(0, len(pair) - 1))
            hit = pair[at] == own if len(pair) else np.zeros(len(own), bool)
            some = lambda v: summed(np.where(hit, v, 0), sizes) if len(pair) else np.zeros(len(sizes), np.int64)
            rest = summed(~hit, sizes)
            columns = [some(best[at] * times), some(n[at] * times)] if len(pair) else [some(0)] * 2
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *map(pa.array, columns), listed(own[~hit], rest), listed(times[~hit].astype(np.int32), rest)], names=schema.names)

    out = cut(links.mapInArrow(run, schema).withColumn("__row", F.monotonically_increasing_id()), "pair-hot")
    cold = out.select("__row", F.inline(F.arrays_zip(F.col("cold_pairs").alias("pair"), F.col("cold_times").alias("times"))))
    more = cold.join(known, "pair").groupBy("__row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    both = out.join(more, "__row", "left")
    return both.select(*(f.name for f in kept), *((F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))))


def alignment(docs: DataFrame, pair: Pair, text: str = "text", hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum (long), groups_sha256.

    A pair's count is the number of rows (repeated ones too) that hold it linked.
    Texts that are null or empty, or that a tokenizer changes, have zeros and ''.
    An empty table gives no rows; other columns of docs are ignored.
    """
    links = cut(linked(docs, pair, text), "links")
    out = scored(links, counts(links), hot_pairs)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
