"""Byte-pair encoding and decoding by forced-boundary splitting.

A pair of adjacent bytes that occurs inside no token of the vocabulary can
never be joined by a merge, so the text may be cut there and the fragments
encoded on their own; the ids of the whole are the ids of the fragments in
order. Texts repeat their fragments, so a group of texts is cut in one go over
its bytes, Arrow numbers the distinct fragments, and only those are looked up in
the task's bounded memo or encoded; the ids of the texts are gathered by number.

Two levels of cuts are used. Between a character that isn't white space and one
that is, no pre-tokenizer looks back and none joins the two, so these cuts hold
for the tokenizer's own splitting too. Inside the pieces that the
tokenizer's pattern makes, the forced pairs of the vocabulary cut again.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import slices

#: Unicode White_Space, as a class for re.
WHITE = "\t-\r \x85\xa0  -     　"
#: The pattern of the byte-level pre-tokenizer (fixed value of the file format).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space for Python but not for Unicode.
OTHER_SPACE = re.compile("[\x1c-\x1f]")
#: Texts with any of these are cut one by one: white space beyond ASCII, or what Python counts as such.
RARE_SPACE = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Marks that are words by themselves after letters, in either pattern.
MARKS = b".,;:!?"
#: For each byte, whether it is white space of ASCII, one of its letters, one of MARKS.
WHITE_BYTE = np.isin(np.arange(256), [*range(9, 14), 32])
LETTER_BYTE = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
MARK_BYTE = np.isin(np.arange(256), [*MARKS])
#: The first byte of the letters U+00C0 to U+00FF in UTF-8, and which second bytes are letters (all but the signs of times and division).
LATIN, LATIN_LETTER = 0xC3, np.isin(np.arange(256), [x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)])
#: Fragments after which a task starts a new memo.
MEMO_FRAGMENTS = 100_000
#: Bytes of text that are cut together, and whose new fragments are encoded side by side.
GROUP_BYTES = 1 << 18
#: Bytes of a run above which it is merged by itself.
LONG_RUN = 256
#: An odd factor that spreads pairs over the slots of the table (2**64 over the golden ratio).
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of the longest fragment that is remembered.
MEMO_BYTES = 64
#: Bytes of the largest tokenizer file that is sent to the tasks.
MAX_TOKENIZER_BYTES = 64 << 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(spare)
            spare += 1
    return [table[b] for b in range(256)]


class ForcedBoundaryBPE:
    """Encoder and decoder for one tokenizer file (its JSON text)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("only plain byte-level BPE files are supported")
        self.end = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        for x in spec["added_tokens"]:
            if x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"]:
                raise ValueError("added tokens with strip, word or normalisation rules are not supported")
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._odd = "|".join([RARE_SPACE, *(re.sub(r"([^\w\s])", r"\\\1", x) for x in self.special)])
        self._normalizers(spec.get("normalizer"))
        self._pattern(spec["pre_tokenizer"])

        alphabet = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        self.base = np.array([vocab[c] for c in alphabet], np.int64)
        self.base_end = np.array([vocab[c + self.end] for c in alphabet], np.int64)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.rank_of = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = np.array([*(vocab[a + b] for a, b in pairs), -1], np.int64)[:-1]
        self._rank_table([(vocab[a], vocab[b]) for a, b in pairs])
        #: joined[a, b]: the bytes a, b stand side by side inside some token.
        self.joined = np.zeros((256, 256), bool)
        self.token_bytes: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            body = token[: -len(self.end)] if self.end and token.endswith(self.end) and len(token) > len(self.end) else token
            own = bytes(self.byte_of[c] for c in body)
            self.token_bytes[i] = own + (b" " if body is not token else b"")
            at = np.frombuffer(own, np.uint8)
            self.joined[at[:-1], at[1:]] = True
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.token_sizes = np.fromiter(map(len, self.token_bytes), np.int64, len(self.token_bytes))
        self.token_data = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self._forget()

    def _normalizers(self, spec: dict | None) -> None:
        self.nfc = self.lower = self.drops_white = False
        for x in [] if spec is None else spec.get("normalizers", [spec]):
            if x["type"] == "NFC":
                self.nfc = True
            elif x["type"] == "Lowercase":
                self.lower = True
            elif x["type"] != "Replace" or x["pattern"] != {"Regex": "\\s+"} or x["content"] != " ":
                raise ValueError(f"unknown normalizer: {x}")

    def _pattern(self, spec: dict) -> None:
        kinds = spec.get("pretokenizers", [spec])
        if len(kinds) == 1 and kinds[0]["type"] == "ByteLevel" and kinds[0]["use_regex"] and not kinds[0]["add_prefix_space"]:
            self.pattern = regex.compile(BYTE_LEVEL_PATTERN)
            self.fragments = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
            self.simple = re.compile(r"\s*\S+|\s+").findall
            self.bare = False
        elif len(kinds) == 2 and kinds[0]["type"] == "Split" and kinds[0]["invert"] and kinds[0]["behavior"] == "Removed" and kinds[1]["type"] == "ByteLevel" and not kinds[1]["use_regex"]:
            self.pattern = regex.compile(kinds[0]["pattern"]["Regex"])
            self.fragments = re.compile(f"[^{WHITE}]+")  # what the pattern doesn't match is removed, white space above all
            self.simple = str.split
            self.bare = True
        else:
            raise ValueError(f"unknown pre-tokenizer: {spec}")

    def _rank_table(self, pairs: list[tuple[int, int]]) -> None:
        """An open hash table of the pairs, as arrays; probes: slots to look at until any pair is found."""
        rank = {}
        for k, (a, b) in enumerate(pairs):
            rank[a << 32 | b] = k
        size = 1 << max(4, (4 * len(rank)).bit_length())
        self.slot_shift = np.uint64(64 - (size.bit_length() - 1))
        self.slots, self.slot_rank, self.probes = np.full(size + 64, -1, np.int64), np.full(size + 64, len(pairs), np.int64), 1
        home = (np.array(list(rank), np.uint64) * SPREAD >> self.slot_shift).tolist()
        for (key, k), at in zip(rank.items(), home, strict=True):
            n = 0
            while self.slots[at + n] >= 0:
                n += 1
            self.slots[at + n], self.slot_rank[at + n] = key, k
            self.probes = max(self.probes, n + 1)
        self.slots, self.slot_rank = (np.concatenate([x, np.full(self.probes, x[-1], x.dtype)]) for x in (self.slots, self.slot_rank))

    def ranks(self, key: np.ndarray) -> np.ndarray:
        """The rank of each pair (first id << 32 | second id); the number of merges where there is none."""
        at = (key.view(np.uint64) * SPREAD >> self.slot_shift).view(np.int64)
        held = self.slots[at]
        out = np.where(held == key, self.slot_rank[at], len(self.made))
        rest = np.flatnonzero((held != key) & (held >= 0))
        for n in range(1, self.probes):
            if not len(rest):
                break
            held = self.slots[at[rest] + n]
            hit = held == key[rest]
            out[rest[hit]] = self.slot_rank[at[rest[hit]] + n]
            rest = rest[~hit & (held >= 0)]
        return out

    def merged(self, ids: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids after all merges, run by run, and for each the place of its first symbol. run: ascending numbers.

        All runs advance together: each round applies in every run the leftmost
        of its pairs of lowest rank; runs without a pair leave.
        """
        none, at = len(self.made), np.arange(len(ids))
        done_ids, done_at = [], []
        rank = np.full(len(ids), none, np.int64)  # of each symbol with the one after it
        side = np.flatnonzero(run[1:] == run[:-1])
        rank[side] = self.ranks(ids[side] << 32 | ids[side + 1])
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            sizes = np.diff(np.append(starts, len(ids)))
            least = np.minimum.reduceat(rank, starts)
            ends = least == none
            stays = np.repeat(~ends, sizes)
            over = ~stays
            done_ids.append(ids[over])
            done_at.append(at[over])
            best = np.flatnonzero((rank == np.repeat(least, sizes)) & stays)
            best = best[np.concatenate([best[:1] >= 0, run[best[1:]] != run[best[:-1]]])]
            ids[best] = self.made[rank[best]]
            stays[best + 1] = False
            moved = np.cumsum(stays)[best] - 1
            ids, run, at, rank = ids[stays], run[stays], at[stays], rank[stays]
            near = np.concatenate([moved, moved - 1])  # the pairs that the merges changed
            near = near[near >= 0]
            rank[near] = none
            near = near[near < len(ids) - 1]
            near = near[run[near] == run[near + 1]]
            rank[near] = self.ranks(ids[near] << 32 | ids[near + 1])
        all_at = np.concatenate(done_at) if done_at else at
        order = np.argsort(all_at, kind="stable")
        return (np.concatenate(done_ids)[order] if done_ids else ids), all_at[order]

    def _merged_long(self, ids: list[int]) -> list[int]:
        """One run over linked symbols and a heap of ranks, in n log n steps."""
        n, rank_of, made = len(ids), self.rank_of, self.made
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(rank, i) for i in range(n - 1) if (rank := rank_of.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or rank_of.get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = int(made[rank]), -1
            k, h = after[j], before[i]
            after[i] = k
            if k >= 0:
                before[k] = i
                if (rank := rank_of.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (rank, i))
            if h >= 0 and (rank := rank_of.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (rank, h))
        return [x for x in ids if x >= 0]

    def found(self, text: str) -> list[str]:
        """The fragments of a text. Python's own idea of white space has four characters more than Unicode's."""
        return self.fragments.findall(text) if OTHER_SPACE.search(text) else self.simple(text)

    def fragments_encoded(self, fragments: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all fragments one after the other, and how many each has: the tokenizer's own words, cut at forced pairs, merged side by side."""
        data, ends = bytes_of(fragments)
        letters = LETTER_BYTE[data]
        second = np.concatenate([[False], data[:-1] == LATIN]) & LATIN_LETTER[data]
        letters |= second
        letters[:-1] |= second[1:]
        plain = self.plain(data, ends, letters)
        owner = np.repeat(np.arange(len(fragments)), np.diff(ends))
        used = plain[owner]
        if self.bare:
            used &= ~WHITE_BYTE[data]
        own, owner, mark = data[used].astype(np.int64), owner[used], MARK_BYTE[data[used]]
        if self.lower:
            own += 32 * ((own >= 65) & (own <= 90) | second[used] & (own < 0x9F))
        first = np.concatenate([own[:1] >= 0, (owner[1:] != owner[:-1]) | mark[1:]])  # a mark is a word
        parts = [(own, np.cumsum(first), owner)]
        rest = np.flatnonzero(~plain)
        if len(rest):
            words, at = [], []
            for k, text in zip(rest.tolist(), fragments.take(pa.array(rest)).to_pylist(), strict=True):
                if self.nfc and not text.isascii():
                    text = unicodedata.normalize("NFC", text)
                if self.lower:
                    text = text.replace("Σ", "σ").lower()  # letter by letter, without the rule for a final sigma
                split = self.pattern.findall(text)
                words += split
                at += [k] * len(split)
            bodies = [w.encode() for w in words]
            word = np.repeat(np.arange(len(bodies)), np.fromiter(map(len, bodies), np.int64, len(bodies)))
            parts.append((np.frombuffer(b"".join(bodies), np.uint8).astype(np.int64), word, np.array(at, np.int64)[word]))
        made = [(ids, owner[at]) for own, word, owner in parts for ids, at in [self.words_encoded(own, word)]]
        ids, owner = (np.concatenate(x) for x in zip(*made, strict=True))
        return ids[np.argsort(owner, kind="stable")].astype("<u4"), np.bincount(owner, minlength=len(fragments))

    def plain(self, data: np.ndarray, ends: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Which fragments are letters up to U+00FF, perhaps with white space before and one of MARKS after: either pattern splits these alike."""
        if not len(data):
            return np.zeros(len(ends) - 1, bool)
        sizes = np.diff(ends)
        some = sizes > 0
        total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[ends])
        n = total(letters)
        ahead = total(WHITE_BYTE[data]) if self.bare else some & (data[np.minimum(ends[:-1], len(data) - 1)] == 32)
        return some & (n > 0) & (n + ahead + (some & MARK_BYTE[data[ends[1:] - 1]]) == sizes)

    def words_encoded(self, own: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words (bytes own, each with the ascending number of its word) and for each id the place of its first byte."""
        if not len(own):
            return own, own
        ids = self.base[own]
        if self.end:
            ends = np.flatnonzero(np.concatenate([word[1:] != word[:-1], [True]]))
            ids[ends] = self.base_end[own[ends]]
        run = np.cumsum(np.concatenate([[True], (word[1:] != word[:-1]) | ~self.joined[own[:-1], own[1:]]]))
        long = np.bincount(run)[run] > LONG_RUN
        out, at = self.merged(ids[~long], run[~long])
        at = np.flatnonzero(~long)[at]
        if long.any():
            for r in np.unique(run[long]).tolist():
                begin, end = np.searchsorted(run, [r, r + 1]).tolist()
                more = self._merged_long(ids[begin:end].tolist())
                out, at = np.concatenate([out, more]), np.concatenate([at, np.full(len(more), begin)])
            order = np.argsort(at, kind="stable")
            out, at = out[order], at[order]
        return out, at

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other (unsigned 32-bit), and how many each text has; null counts as empty."""
        texts = texts.cast(pa.string()).fill_null("")
        sizes = np.diff(bytes_of(texts)[1])
        odd = pc.match_substring_regex(texts, self._odd).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes, dtype=np.int64) - sizes) // GROUP_BYTES * 2 + odd  # texts cut one by one stand apart
        edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])).tolist() if len(texts) else [0]
        parts = [(self._one_by_one if odd[i] else self._together)(texts.slice(i, j - i)) for i, j in zip(edges[:-1], edges[1:], strict=True)]
        ids, counts = zip(*parts, strict=True) if parts else ((), ())
        return np.concatenate([*ids, np.zeros(0, np.uint32)]).astype("<u4", copy=False), np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.int64)

    def _together(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """encode_array() of texts without special tokens or rare white space: a fragment is white space and what follows it."""
        data, bounds = bytes_of(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        white = WHITE_BYTE[data]
        begins = np.empty(len(data), bool)
        begins[0] = True
        np.greater(white[1:], white[:-1], out=begins[1:])
        begins[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        starts = np.flatnonzero(begins).astype(np.int32)
        found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, np.int32(len(data)))), pa.py_buffer(data)).dictionary_encode()
        ids, sizes = self._gathered(found)
        return ids, np.diff(np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, bounds)])

    def _one_by_one(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """encode_array() of any texts."""
        out, counts = [], []
        for text in texts.to_pylist():
            parts = self._special.split(text) if self._special else [text]
            own = [np.array([self.special[x]]) if k % 2 else self._gathered(pa.array(self.found(x), pa.string()).dictionary_encode())[0] for k, x in enumerate(parts)]
            out += own
            counts.append(sum(map(len, own)))
        return np.concatenate(out), np.array(counts, np.int64)

    def _gathered(self, fragments: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all fragments in order, and how many each has. What the memo lacks is encoded; what occurs twice enters it."""
        distinct, number = fragments.dictionary, fragments.indices.to_numpy(zero_copy_only=False)
        at = pc.index_in(distinct, value_set=self.memo).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = np.flatnonzero(at < 0)
        fresh = distinct.take(pa.array(missing))
        made, n = self.fragments_encoded(fresh)
        at[missing] = np.arange(len(self.memo_sizes), len(self.memo_sizes) + len(missing))
        ids, held = np.concatenate([self.memo_ids, made]), np.concatenate([self.memo_sizes, n])
        starts = np.cumsum(held) - held
        use = at[number]
        sizes = held[use]
        place = np.repeat(starts[use] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        stays = (np.bincount(number, minlength=len(distinct))[missing] > 1) & (np.diff(bytes_of(fresh)[1]) <= MEMO_BYTES)
        if len(self.memo) + stays.sum() > MEMO_FRAGMENTS:
            self._forget()
        self.memo = pa.concat_arrays([self.memo, fresh.filter(pa.array(stays))])
        self.memo_ids, self.memo_sizes = np.concatenate([self.memo_ids, made[np.repeat(stays, n)]]), np.concatenate([self.memo_sizes, n[stays]])
        return ids[place], sizes

    def _forget(self) -> None:
        self.memo, self.memo_ids, self.memo_sizes = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        ids, counts = self.encode_array(pa.array(texts, pa.string()))
        return pieces(ids, counts)

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode_array(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each part of ids; bytes that aren't UTF-8 become U+FFFD."""
        sizes = self.token_sizes[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        data = self.token_data[np.repeat((np.cumsum(self.token_sizes) - self.token_sizes)[ids] - upto[:-1], sizes) + np.arange(upto[-1])]
        texts, ends = data.tobytes(), upto[np.cumsum(counts)].tolist()
        return [texts[i:j].decode("utf-8", "replace") for i, j in zip([0, *ends], ends, strict=False)]

    def decode(self, ids: bytes) -> str:
        own = np.frombuffer(ids, "<u4")
        return self.decode_array(own, np.array([len(own)]))[0]


def bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (without nulls) one after the other, and where each begins and the last one ends."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int32)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def closed(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with end_id after each text."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def pieces(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The bytes of each text's part of ids."""
    data, ends = memoryview(np.ascontiguousarray(ids)).cast("B"), (np.cumsum(counts) * ids.itemsize).tolist()
    return [bytes(data[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def as_binary(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary value for each text: its part of ids."""
    ends = np.concatenate([[0], np.cumsum(counts) * ids.itemsize])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(ids))]).cast(pa.binary())


class Tokenizer:
    """A tokenizer file read and its tables built on the driver, sent once to each executor; the file's size is checked."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if len(text) > MAX_TOKENIZER_BYTES:
            raise ValueError(f"{path} is too large to be sent to every executor")
        self.sent = spark.sparkContext.broadcast(ForcedBoundaryBPE(text))

    def get(self) -> ForcedBoundaryBPE:
        return self.sent.value


def replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """batch with the column name set to values, at the end."""
    kept = [c for c in batch.schema.names if c != name]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), values], names=[*kept, name])


def encode(df: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with a binary column ids: the tokens of text, as little-endian unsigned 32-bit integers.

    Null and empty texts get no ids (an empty value). A column named ids is
    replaced; all other columns pass through. No shuffle, no state between rows
    but the bounded memo.
    """
    schema = T.StructType([*(f for f in df.schema if f.name != ids), T.StructField(ids, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer.get()
        for batch in slices(batches):
            yield replaced(batch, ids, as_binary(*bpe.encode_array(batch.column(text))))

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: Tokenizer, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with a string column text: what the ids stand for. Null ids give the empty text. A column named text is replaced."""
    schema = T.StructType([*(f for f in df.schema if f.name != text), T.StructField(text, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer.get()
        for batch in slices(batches):
            own, ends = bytes_of(batch.column(ids).fill_null(b""))
            yield replaced(batch, text, pa.array(bpe.decode_array(np.frombuffer(own.tobytes(), "<u4"), np.diff(ends) // 4), pa.string()))

    return df.mapInArrow(run, schema)
