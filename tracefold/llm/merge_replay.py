"""Byte-level BPE by corpus-level merge replay.

The distinct words of a slice of the corpus are laid out side by side as linked
symbols. An inverted index leads from each pair of neighbouring symbols, named by
the token that it makes, to all places where the pair stands. The merges are
applied in rank order, each at all of its places in all words at once, from left
to right; only the neighbours of the places touched are looked up anew and enter
the index. Words that are tokens themselves need no merge.

A slice is what one task reads, up to SLICE_BYTES of text, so nothing is shuffled
and a lost task is simply run again. Texts are cut over their bytes where white
space follows something else, which no word spans; Arrow numbers the distinct
fragments, only these are split into words by the pattern, and the ids of the
texts are gathered by number.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .bpe import MAX_TOKENIZER_BYTES, RARE_SPACE, WHITE, WHITE_BYTE, bytes_of, replaced

#: Bytes of text whose words are replayed together.
SLICE_BYTES = 12 << 20
#: Bits of a token id in the key of a pair.
ID_BITS = 24
#: Rows that are given on together.
ROWS = 300
NONE = np.zeros(0, np.int32)
#: Places from which a merge is applied to all of them at once, as arrays.
MANY = 100
#: A run of white space and what follows it; only for texts with rare white space.
FRAGMENT = regex.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


@dataclass
class Replayed:
    """The ids of distinct fragments one after the other, how many each has, the fragments of all texts by number, and where those of each text begin."""

    ids: np.ndarray
    sizes: np.ndarray
    number: np.ndarray
    bounds: np.ndarray

    def of_texts(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts from first up to last one after the other, and how many each has."""
        bounds = self.bounds[first : last + 1]
        number = self.number[bounds[0] : bounds[-1]]
        return gathered(self.ids, self.sizes, number), summed(self.sizes[number], np.diff(bounds))


class Merges:
    """The tokens of a rank file: lines of a token in base64 and its rank, which is its id."""

    def __init__(self, lines: bytes, pattern: str):
        self.rank_of = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line.strip())}
        if max(self.rank_of.values()) >> ID_BITS:
            raise ValueError(f"ids of more than {ID_BITS} bits are not supported")
        self.pattern = regex.compile(pattern)
        self.base = np.array([self.rank_of[bytes([b])] for b in range(256)], np.int64)
        #: made: the token that a pair of tokens makes, by first id << ID_BITS | second id.
        self.made = {self.rank_of[token[:k]] << ID_BITS | self.rank_of[token[k:]]: rank for token, rank in self.rank_of.items() for k in range(1, len(token)) if token[:k] in self.rank_of and token[k:] in self.rank_of}
        self.keys = np.array(sorted(self.made), np.int64)
        self.made_by_key = np.array([self.made[k] for k in self.keys.tolist()], np.int64)
        self.of_bytes = np.array([[self.made.get(a << ID_BITS | b, -1) for b in self.base.tolist()] for a in self.base.tolist()], np.int64)
        self.tokens: list[bytes] = [b""] * (max(self.rank_of.values()) + 1)
        for token, rank in self.rank_of.items():
            self.tokens[rank] = token
        self.known = np.array([token in self.rank_of for token in self.tokens])
        self.sizes = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        self.data = np.frombuffer(b"".join(self.tokens), np.uint8)

    def alone(self, word: bytes) -> list[int]:
        """The ids of one word: the leftmost pair of the lowest rank is joined until none is left."""
        ids = self.base[np.frombuffer(word, np.uint8)].tolist()
        while True:
            ranks = [self.made.get(a << ID_BITS | b, -1) for a, b in zip(ids, ids[1:], strict=False)]
            least = min((r for r in ranks if r >= 0), default=-1)
            if least < 0:
                return ids
            k = ranks.index(least)
            ids[k : k + 2] = [least]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and how many each has.

        A merge may bring up a pair of a lower rank than its own, which a rank
        order over all words would apply too late for the word's other places;
        such words (none in vocabularies whose ids are in order of training) are
        done alone.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(words), np.uint8)
        n, made = len(data), self.made
        first, last = np.zeros(n, bool), np.zeros(n, bool)
        first[(ends - sizes)[sizes > 0]], last[ends[sizes > 0] - 1] = True, True
        number = np.arange(n)
        symbol, after, before = (array("i", x.astype(np.int32).tobytes()) for x in (self.base[data], np.where(last, -1, number + 1), np.where(first, -1, number - 1)))
        all_of = [np.frombuffer(x, np.int32) for x in (symbol, after, before)] if n else []  # the same memory, for many places at once

        rank = np.where(last, -1, self.of_bytes[data, np.append(data[1:], 0)[:n]])
        held = np.flatnonzero(rank >= 0)
        held = held[np.argsort(rank[held], kind="stable")]
        cuts = np.flatnonzero(np.diff(rank[held], prepend=-1))
        at_first = {int(r): p.astype(np.int32) for r, p in zip(rank[held][cuts], np.split(held, cuts[1:]), strict=True)} if len(held) else {}
        index: dict[int, list[int]] = {r: [] for r in at_first}
        waiting, late = list(index), []  # ascending, so a heap
        del number, first, last, rank, held, cuts
        while waiting:
            now = heapq.heappop(waiting)
            places, before_any = index.pop(now), at_first.pop(now, NONE)
            if len(places) + len(before_any) >= MANY:
                found = self._merge_all(now, np.sort(np.concatenate([before_any, np.array(places, np.int32)])), *all_of)
            else:
                found = []
                for i in sorted(places + before_any.tolist()):
                    j = after[i]
                    if j < 0 or symbol[i] < 0 or made.get(symbol[i] << ID_BITS | symbol[j]) != now:
                        continue  # the place has gone with another merge
                    symbol[i], symbol[j] = now, -1
                    k, h = after[j], before[i]
                    after[i] = k
                    if k >= 0:
                        before[k] = i
                        if (r := made.get(now << ID_BITS | symbol[k])) is not None:
                            found.append((r, (i,)))
                    if h >= 0 and (r := made.get(symbol[h] << ID_BITS | now)) is not None:
                        found.append((r, (h,)))
            for r, more in found:
                if r < now:
                    late += more
                if (own := index.get(r)) is not None:
                    own += more
                else:
                    index[r] = list(more)
                    heapq.heappush(waiting, r)
        out = np.array(symbol, np.int64)
        stays = out >= 0
        counts = np.diff(np.concatenate([[0], np.cumsum(stays)])[np.concatenate([[0], ends])])
        ids = out[stays]
        if late:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for w in np.unique(np.searchsorted(ends, late, side="right")).tolist():
                parts[w] = np.array(self.alone(words[w]), np.int64)
            ids, counts = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return ids, counts

    def _merge_all(self, now: int, i: np.ndarray, symbol: np.ndarray, after: np.ndarray, before: np.ndarray) -> list[tuple[int, list[int]]]:
        """The merge that makes now at all of the ascending places i where its pair still stands: the ranks of the pairs that come up, with their places."""
        i = i[np.concatenate([[True], i[1:] != i[:-1]])]
        i = i[(symbol[i] >= 0) & (after[i] >= 0)]
        i = i[self.ranks(symbol[i], symbol[after[i]]) == now]
        linked = np.concatenate([[False], after[i[:-1]] == i[1:]]) if len(i) else np.zeros(0, bool)
        if linked.any():  # of places that overlap, every second, the first of them included
            at = np.arange(len(i))
            i = i[(at - np.maximum.accumulate(np.where(linked, 0, at))) % 2 == 0]
        j = after[i]
        symbol[i], symbol[j] = now, -1
        k = after[j]
        after[i] = k
        before[k[k >= 0]] = i[k >= 0]
        h = before[i]
        right, left = i[k >= 0], h[h >= 0]
        place = np.concatenate([right, left])
        rank = self.ranks(symbol[place], symbol[after[place]])
        place, rank = place[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        place, rank = place[order], rank[order]
        cuts = np.flatnonzero(np.concatenate([rank[:1] >= 0, rank[1:] != rank[:-1]]))
        all_, edges = place.tolist(), [*cuts.tolist(), len(place)]
        return [(r, all_[a:b]) for r, a, b in zip(rank[cuts].tolist(), edges[:-1], edges[1:], strict=True)]

    def ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The token that each pair makes, -1 where there is none."""
        key = first.astype(np.int64) << ID_BITS | second
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made_by_key[at], -1) if len(self.keys) else np.full(len(key), -1)

    def words_encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """replay() of distinct words, but those that are tokens themselves are taken as they are."""
        whole = np.fromiter((self.rank_of.get(w, -1) for w in words), np.int64, len(words))
        ids, counts = self.replay([w for w, r in zip(words, whole.tolist(), strict=True) if r < 0])
        sizes = np.ones(len(words), np.int64)
        sizes[whole < 0] = counts
        out = np.empty(int(sizes.sum()), np.int64)
        own = np.repeat(whole >= 0, sizes)
        out[own], out[~own] = whole[whole >= 0], ids
        return out, sizes

    def replayed(self, texts: pa.StringArray) -> Replayed:
        """The ids of the distinct fragments of all texts (without nulls), and which fragments each text has."""
        fragments, counts = cut_up(texts)
        split = list(map(self.pattern.findall, fragments.dictionary.to_pylist()))
        words: dict[str, int] = {}
        of_fragment = np.array([words.setdefault(w, len(words)) for own in split for w in own], np.int32)
        per_fragment = np.fromiter(map(len, split), np.int64, len(split))
        del split
        encoded = [w.encode() for w in words]
        del words
        ids, sizes = self.words_encoded(encoded)
        number = fragments.indices.to_numpy(zero_copy_only=False)
        return Replayed(gathered(ids.astype(np.int32), sizes, of_fragment), summed(sizes[of_fragment], per_fragment), number, np.concatenate([[0], np.cumsum(counts)]))

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other (32-bit), and how many each text has; null counts as empty."""
        return self.replayed(texts.cast(pa.string()).fill_null("")).of_texts(0, len(texts))

    def decode_array(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes of each part of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.tokens) or not self.known[ids].all()):
            raise ValueError("an id stands for no token")
        ends = np.concatenate([[0], np.cumsum(summed(self.sizes[ids], counts))])
        data = gathered(self.data, self.sizes, ids)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def gathered(values: np.ndarray, sizes: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Of values, cut in parts of the given sizes, the parts numbered in use, one after the other."""
    starts, own = (np.cumsum(sizes) - sizes)[use], sizes[use]
    return values[np.repeat(starts - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))]


def summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each part of values, in parts of counts values each."""
    upto = np.concatenate([[0], np.cumsum(values)])
    return np.diff(upto[np.concatenate([[0], np.cumsum(counts)])])


def cut_up(texts: pa.StringArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The fragments of all texts in order, their distinct ones numbered, and how many each text has: white space and what follows it."""
    odd = pc.match_substring_regex(texts, RARE_SPACE).to_numpy(zero_copy_only=False)
    data, bounds = bytes_of(texts)
    white = WHITE_BYTE[data]
    begins = np.zeros(len(data), bool)
    begins[1:] = white[1:] & ~white[:-1]
    begins[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    for k in np.flatnonzero(odd).tolist():  # white space beyond ASCII
        begins[bounds[k] : bounds[k + 1]] = False
        found = FRAGMENT.findall(texts[k].as_py())
        begins[bounds[k] + np.cumsum([0, *(len(x.encode()) for x in found[:-1])])] = True
    starts = np.flatnonzero(begins).astype(np.int32)
    fragments = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, np.int32(len(data)))), pa.py_buffer(np.ascontiguousarray(data)))
    return fragments.dictionary_encode(), np.diff(np.searchsorted(starts, bounds))


class Ranks:
    """A rank file read and its tables built on the driver, sent once to each executor; the file's size is checked. pattern splits texts into words."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            lines = f.read()
        if len(lines) > MAX_TOKENIZER_BYTES:
            raise ValueError(f"{path} is too large to be sent to every executor")
        self.sent = spark.sparkContext.broadcast(Merges(lines, pattern))

    def get(self) -> Merges:
        return self.sent.value


def in_slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.Table]:
    """The batches put together or cut so that each table has about most bytes in column, one row at least."""
    held, size = [], 0
    for batch in batches:
        own = batch.column(column)
        sizes = pc.binary_length(own).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < len(sizes):
            upto = int(np.searchsorted(np.cumsum(sizes[at:]), most - size, side="right"))
            if upto < len(sizes) - at:
                upto = max(upto, 0 if held else 1)
                held.append(batch.slice(at, upto))
                yield pa.Table.from_batches([x for x in held if x.num_rows])
                held, size = [], 0
            else:
                held.append(batch.slice(at))
                size += int(sizes[at:].sum())
            at += upto
    if held:
        yield pa.Table.from_batches(held)


def encode(df: DataFrame, ranks: Ranks, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with a column ids (array of int): the tokens of text, each match of the pattern encoded by itself, without special tokens.

    Null and empty texts get an empty array. A column named ids is replaced; all
    other columns pass through. Repeated rows and empty tables are like any other.
    No shuffle; a task holds SLICE_BYTES of text, or one longer text.
    """
    schema = T.StructType([*(f for f in df.schema if f.name != ids), T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = ranks.get()
        for table in in_slices(batches, text, SLICE_BYTES):
            batch = table.combine_chunks().to_batches()[0]
            slice_ = merges.replayed(batch.column(text).cast(pa.string()).fill_null(""))
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                own, counts = slice_.of_texts(k, k + part.num_rows)
                yield replaced(part, ids, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(own)))
            del table, batch, slice_, part, own
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: Ranks, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """df with a binary column decoded: the bytes that the ids stand for. Null ids give no bytes; an id without a token is an error. A column named decoded is replaced."""
    schema = T.StructType([*(f for f in df.schema if f.name != decoded), T.StructField(decoded, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = ranks.get()
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                own = part.column(ids)
                counts = pc.list_value_length(own).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                yield replaced(part, decoded, merges.decode_array(own.flatten().to_numpy(zero_copy_only=False), counts))

    return df.mapInArrow(run, schema)
