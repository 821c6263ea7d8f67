"""Language identification by interpolated Kneser-Ney character models.

Texts are read as letters in lower case with one space for every run of other
characters. One model per language is fitted on a bounded sample of labelled
rows (SAMPLE_DOCS for each label). Sequences of one to four characters are packed
in 64 bits, hashed by an odd factor (so no two collide) and kept in sorted hash
arrays, one for each order, with the log-probabilities of all languages side by
side; a sequence that no language has met backs off along its contexts. The
language of lowest cross-entropy per character wins. On the part of the sample
that the models did not learn from, the sharpness of the score and the
cross-entropy above which a text is rejected are calibrated.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, slices

ORDER = 4
#: Labelled documents of each language that are learned from, about.
SAMPLE_DOCS = 1500
#: Characters of each language's sample, about; with very long documents fewer are taken.
SAMPLE_CHARS = 8_000_000
#: Of the sample, one part in so many calibrates.
CALIBRATES = 5
#: Share of calibration texts whose winning cross-entropy stays below the limit of rejection.
ACCEPTED = 0.995
#: Values that are tried for the sharpness of the score.
SHARPNESS = (1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0)
#: Characters that are scored at once.
CHARS = 1 << 16
#: Any odd number maps 64-bit keys one to one; this one (2**64 over the golden ratio) spreads them.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"


@functools.cache
def alphabet() -> np.ndarray:
    """For each code point: its lower-case letter, 0 if it is no letter; beyond 16 bits one letter stands for all."""
    out = np.zeros(0x110000, np.uint64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = min(ord(c.lower()[0]), 0xFFFF)
    return out


def sequences(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The packed sequences of ORDER characters of all texts, the first one of each text, and each text's number of letters."""
    pad = ORDER - 1
    raw = [np.frombuffer(("\0" * pad + x + "\0").encode("utf-32-le", "replace"), "<u4") for x in texts]
    sizes = np.array([len(x) for x in raw])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    c = alphabet()[np.concatenate(raw)]
    stays = np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])
    letters = np.add.reduceat((c != 0).astype(np.int64), starts)
    for k in range(pad):
        stays[starts + k] = True
    stays[starts + sizes - 1] |= letters == 0  # each text has a sequence
    n = np.add.reduceat(stays.astype(np.int64), starts)
    c = c[stays]
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    packed = np.zeros(len(c), np.uint64)
    for k in range(ORDER):
        packed[k:] |= c[: len(c) - k] << np.uint64(16 * k)
    inside = np.ones(len(c), bool)
    for k in range(pad):
        inside[first + k] = False
    return packed[inside], first - pad * np.arange(len(texts)), letters


def low(packed: np.ndarray, order: int) -> np.ndarray:
    """The last `order` characters."""
    return packed & np.uint64((1 << 16 * order) - 1)


def find(keys: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each packed sequence is in the sorted hash array keys, and whether it is there."""
    h = packed * FACTOR
    at = np.searchsorted(keys, h)
    at[at == len(keys)] = 0
    return at, (keys[at] == h) if len(keys) else np.zeros(len(h), bool)


@dataclass
class Models:
    """By order: keys and logp of sequences, contexts and loglam (the weight of the shorter order) of what comes before."""

    langs: list[str]
    keys: dict[int, np.ndarray]
    logp: dict[int, np.ndarray]
    contexts: dict[int, np.ndarray]
    loglam: dict[int, np.ndarray]
    floor: np.ndarray
    sharpness: float = 10.0
    limit: float = float("inf")

    def logs(self, packed: np.ndarray, order: int = ORDER) -> np.ndarray:
        """log P of the last character after the ones before it, a column for each language."""
        at, ok = find(self.keys[order], packed)
        if ok.all():
            return self.logp[order][at]
        out = np.empty((len(packed), len(self.langs)), np.float32)
        out[ok] = self.logp[order][at[ok]]
        rest = packed[~ok]
        if order == 1:
            out[~ok] = self.floor
        else:
            at, known = find(self.contexts[order], rest >> np.uint64(16))
            out[~ok] = np.where(known[:, None], self.loglam[order][at], 0) + self.logs(low(rest, order - 1), order - 1)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character under each language, and the number of letters."""
        packed, first, letters = sequences(texts)
        logs = self.logs(packed)
        n = np.diff(np.append(first, len(packed)))
        return -np.add.reduceat(logs, first, axis=0, dtype=np.float64) / n[:, None], letters


def fit(langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]) -> Models:
    """Models from each language's packed sequences of ORDER characters and how often each occurs."""
    parts: dict[tuple[int, int], tuple] = {}
    for x, (grams, n) in enumerate(counts):
        for order in range(ORDER, 0, -1):
            once, twice = (n == 1).sum(), (n == 2).sum()
            d = once / (once + 2 * twice) if once and twice else 0.5
            context, at = np.unique(grams >> np.uint64(16), return_inverse=True)
            total, types = np.bincount(at, n), np.bincount(at)
            parts[x, order] = grams, (n - d) / total[at], context, d * types / total
            grams, n = np.unique(low(grams, order - 1), return_counts=True)  # in how many ways it is continued to the left
    by_hash = lambda arrays: np.sort(functools.reduce(np.union1d, arrays) * FACTOR)
    inverse = np.uint64(pow(int(FACTOR), -1, 1 << 64))
    out = Models(langs, {}, {}, {}, {}, np.zeros(0))
    below = None
    for order in range(1, ORDER + 1):
        own = [parts[x, order] for x in range(len(langs))]
        keys, contexts = by_hash([p[0] for p in own]), by_hash([p[2] for p in own])
        lam = np.ones((len(contexts), len(langs)))
        for x, p in enumerate(own):
            lam[find(contexts, p[2])[0], x] = p[3]
        packed = keys * inverse
        if order == 1:
            p_all = np.tile(lam[0] / (len(keys) + 1), (len(keys), 1))
            out.floor = np.log(lam[0] / (len(keys) + 1)).astype(np.float32)
        else:
            p_all = lam[find(contexts, packed >> np.uint64(16))[0]] * below[find(out.keys[order - 1], low(packed, order - 1))[0]]
        for x, p in enumerate(own):
            p_all[find(keys, p[0])[0], x] += p[1]
        below = p_all
        out.keys[order], out.contexts[order] = keys, contexts
        out.logp[order], out.loglam[order] = np.log(p_all).astype(np.float32), np.log(lam).astype(np.float32)
    return out


#: What is learned from nothing.
NO_MODELS = Models([], {}, {}, {}, {}, np.zeros(0))


def crc_third(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Models:
    """Models from labelled (doc_id, text, lang), on about sample_docs rows and sample_chars characters of each language at most.

    Rows are picked by a hash of id and text, so rows without an id are as likely
    as others and repeated rows are picked together. Null and empty texts teach
    nothing; rows without lang are left out. Without a labelled row that has a
    letter there is no language, and identify() calls every text `und`.
    """
    labelled = labelled.where("lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: min(1.0, sample_docs / r["n"], sample_chars / max(1, r["chars"] or 0)) for r in labelled.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()}
    if not sizes:
        return NO_MODELS
    langs = sorted(sizes)
    share = functools.reduce(lambda c, x: c.when(F.col("lang") == x, F.lit(sizes[x])), langs, F.when(F.lit(False), 0.0))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    picked = cut(labelled.where(place < share).select("lang", "text", (F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(CALIBRATES)) == 0).alias("calibrates")), "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                for chunk in chunks(own):
                    grams, n = np.unique(sequences(chunk)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    teaches = picked.where("not calibrates") if picked.where("not calibrates").groupBy("lang").count().count() == len(langs) else picked
    found = teaches.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    lang, gram, n = (found.column(k).to_numpy() for k in range(3))
    langs = [x for x in langs if (lang == x).any()]
    if not langs:
        return NO_MODELS
    models = fit(langs, [(gram[lang == x].view(np.uint64), n[lang == x]) for x in langs])
    sent = labelled.sparkSession.sparkContext.broadcast(models)

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = [sent.value.langs.index(x) if x in sent.value.langs else -1 for x in batch.column("lang").to_pylist()]
            h, letters = scored(sent.value, batch.column("text").to_pylist())
            ok = (letters > 0) & (np.array(own, np.int64) >= 0)
            h, own = h[ok], np.array(own, np.int64)[ok]
            loss = [-np.log(np.maximum(posterior(h, s)[np.arange(len(own)), own], 1e-12)) for s in SHARPNESS]
            yield pa.RecordBatch.from_arrays([pa.array(h.min(axis=1, initial=np.inf)), *map(pa.array, loss)], names=["entropy", *(f"loss{k}" for k in range(len(SHARPNESS)))])

    losses = [f"loss{k}" for k in range(len(SHARPNESS))]
    tried = picked.where("calibrates").select("lang", "text").mapInArrow(calibrate, "entropy double, " + ", ".join(f"{x} double" for x in losses))
    row = tried.agg(F.percentile_approx("entropy", ACCEPTED, 10000).alias("limit"), *(F.avg(x).alias(x) for x in losses)).first()
    if row["limit"] is not None:
        models.limit = row["limit"]
        models.sharpness = min(zip(SHARPNESS, losses, strict=True), key=lambda x: row[x[1]])[0]
    return models


def chunks(texts: list[str | None]) -> Iterator[list[str]]:
    """texts in order, in lists of about CHARS characters; null counts as empty."""
    own, n = [], 0
    for x in texts:
        own.append(x or "")
        n += len(own[-1])
        if n >= CHARS:
            yield own
            own, n = [], 0
    if own:
        yield own


def scored(models: Models, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    parts = [models.entropies(x) for x in chunks(texts)]
    if not parts:
        return np.zeros((0, len(models.langs))), np.zeros(0, np.int64)
    return np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])


def posterior(h: np.ndarray, sharpness: float) -> np.ndarray:
    e = np.exp(-sharpness * (h - h.min(axis=1, keepdims=True)))
    return e / e.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score (0 to 1), entropy, rejected.

    A text that is null or has no letter is `und` with score 0, rejected. The
    rest get the language of lowest cross-entropy, ties the first in
    alphabetical order; those above the calibrated limit are marked rejected.
    Only the text is read. A text of any length is read whole, a chunk of texts
    at a time. Repeated rows are judged each by itself. An empty table gives no
    rows; without models every row is `und`. Other columns are ignored.
    """
    if not models.langs:
        unknown = {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "entropy": F.lit(float("inf")), "rejected": F.lit(True)}
        return docs.select("doc_id", *(v.alias(k) for k, v in unknown.items()))
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in slices(batches):
            h, letters = scored(m, batch.column("text").to_pylist())
            best, any_ = h.argmin(axis=1), letters > 0
            score = np.where(any_, posterior(h, m.sharpness).max(axis=1, initial=0), 0.0)
            lowest = h.min(axis=1, initial=np.inf)
            lang = [m.langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), any_.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(lowest), pa.array(~any_ | (lowest > m.limit))], names=["doc_id", "lang_pred", "score", "entropy", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, entropy double, rejected boolean")
