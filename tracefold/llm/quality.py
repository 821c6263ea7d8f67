"""Quality rules as a short-circuit cascade.

A document stays when every rule accepts it. The rules are independent, so their
order changes the work but not the verdict. On a bounded sample the time of each
feature and the verdict of each rule are measured. The first rule is the one with
the most rejections per second; each next one is chosen by its rejections among
the documents that are left, and by the time of those of its features that no
rule before it has computed. A document meets a rule only if all before it let
it pass.
"""

from __future__ import annotations

import math
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: Rows of the sample that orders the rules, about; the verdict does not depend on it.
SAMPLE_ROWS = 1000
#: Files that the sample is taken from, about, where there are more.
SAMPLE_FILES = 4
#: Characters that count as symbols (fixed values).
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


class Text:
    """One text with what several rules need of it, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # bytes.split: at [\\x20\\x09-\\x0D]+

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, WHITE))

    @cached_property
    def symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x and x.strip(WHITE)]

    @cached_property
    def dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def upper_chars(self) -> int:
        return len(UPPER.findall(self.text))

    @cached_property
    def repeat_words(self) -> int:
        """Words that lie in a window of three words found twice or more."""
        n = len(self.words)
        if n < 4:
            return 0
        known: dict[bytes, int] = {}
        at = np.array([known.setdefault(w, len(known)) for w in self.words], np.int64)
        v = len(known)
        if v < 1 << 21:
            window = (at[:-2] * v + at[1:-1]) * v + at[2:]
        else:
            _, pair = np.unique(at[:-1] * v + at[1:], return_inverse=True)
            window = pair[:-1] * v + at[2:]
        order = np.argsort(window, kind="stable")
        same = window[order][1:] == window[order][:-1]
        twice = np.zeros(n - 2, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= twice
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Text], bool] = field(compare=False)


#: The two base rules of the contract, then the others. Shares are of words, characters or lines of the whole text.
RULES = (
    Rule("few_words", ("words",), lambda x: len(x.words) < 50),
    Rule("repeated_windows", ("words", "repeat_words"), lambda x: 100 * x.repeat_words > 50 * len(x.words)),
    Rule("symbols", ("words", "symbols"), lambda x: 10 * x.symbols > len(x.words)),
    Rule("repeated_lines", ("lines", "dup_lines"), lambda x: 2 * x.dup_lines > len(x.lines)),
    Rule("word_length", ("words", "word_chars"), lambda x: not 2 * len(x.words) <= x.word_chars <= 15 * len(x.words)),
    Rule("shouting", ("word_chars", "upper_chars"), lambda x: 2 * x.upper_chars > x.word_chars),
)
UPPER = re.compile("[A-Z]")
#: The features, each after those it is made of.
ORDER = ("words", "word_chars", "symbols", "lines", "dup_lines", "repeat_words", "upper_chars")


def sampled(docs: DataFrame, rows: int) -> DataFrame:
    """About rows texts of docs: from a few files spread over all of them where docs is read from files, so that the rest isn't read twice."""
    picked, files = docs.select("text"), docs.inputFiles()
    if len(files) > SAMPLE_FILES:
        chosen = sorted(files)[:: math.ceil(len(files) / SAMPLE_FILES)]
        try:
            picked = docs.where(F.col("_metadata.file_path").isin(chosen)).select("text")
        except AnalysisException:  # not a plain read of files
            picked = docs.select("text")
    n = picked.count()
    return picked.sample(False, rows / n, seed=7) if n > rows else picked


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """rules in the order of the cascade, from about sample_rows documents; ties in the order given."""
    kinds = "rejected long, " + ", ".join(f"{x} double" for x in ORDER)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for text in batch.column(0).to_pylist():
                x, spent = Text(text), []
                for feature in ORDER:
                    began = time.perf_counter()
                    getattr(x, feature)
                    spent.append(time.perf_counter() - began)
                found.append((sum(1 << k for k, rule in enumerate(rules) if rule.rejects(x)), *spent))
            columns = zip(*found, strict=True) if found else [()] * (1 + len(ORDER))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), *[pa.float64()] * len(ORDER)], strict=True)], names=["rejected", *ORDER])

    seen = sampled(docs, sample_rows).mapInArrow(measure, kinds).toArrow()  # one row for each of the sample
    rejected = seen.column("rejected").to_numpy().astype(np.int64)
    cost = {x: np.asarray(seen.column(x).to_numpy(), np.float64) for x in ORDER}
    left, known, out = np.ones(len(rejected), bool), set(), []
    while len(out) < len(rules):
        def worth(k: int) -> float:
            fresh = sum(cost[x][left].sum() for x in rules[k].needs if x not in known)
            return float((rejected[left] >> k & 1).sum()) / (fresh + 1e-7 * max(1, left.sum()))

        best = max((k for k in range(len(rules)) if rules[k] not in out), key=worth)
        out.append(rules[best])
        known.update(rules[best].needs)
        left &= (rejected >> best & 1) == 0
    return out


FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of docs: doc_id, the five counts, base_failed and kept.

    A null, empty or all-white text has no words and fails the base. A text of
    any length is read whole. Repeated rows are judged each by itself. An empty
    table gives no rows. Other columns of docs are ignored.
    """
    ordered = cascade_order(docs, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                x = Text(text)
                n = len(x.words)
                base = n < 50 or 100 * x.repeat_words > 50 * n
                rows.append((n, x.word_chars, x.symbols, x.dup_lines, x.repeat_words, base, not base and accepted(x, ordered)))
            columns = zip(*rows, strict=True) if rows else [()] * 7
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *(f.split()[0] for f in FEATURES.split(", "))])

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(FEATURES)]))


def accepted(x: Text, ordered: list[Rule]) -> bool:
    return not any(rule.rejects(x) for rule in ordered)


def filtered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that every rule accepts, all columns as they were; the cascade stops at the first rule that rejects.

    Null, empty and all-white texts are rejected (they have too few words). A
    text of any length is read whole. Repeated rows are judged each by itself and
    are kept or dropped alike. An empty table gives no rows.
    """
    ordered = cascade_order(docs, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([accepted(Text(x), ordered) for x in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
