"""Processors that fold the events of some kinds into one result for each capture, many of them in one pass.

A processor has an accumulator that can be started, added to, merged and finished.
Each task adds its batches to one accumulator for each processor and capture, so a
hot capture costs a task's worth of accumulators, not of rows; these are merged by
processor and capture, and the result is what finish makes of them.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import written

#: Accumulators that a task holds before it hands them on.
HELD = 10_000


@dataclass(frozen=True)
class Fold:
    """A processor of the events of some kinds.

    add takes an accumulator and a batch with `columns` of one capture, merge two
    accumulators; the order of either must not matter. finish gives a dict of the
    columns in result (DDL).
    """

    name: str
    kinds: tuple[str, ...]
    columns: tuple[str, ...]
    result: str
    start: Callable[[], Any]
    add: Callable[[Any, pa.RecordBatch], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], dict]


def by_key(batch: pa.RecordBatch, key: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of a batch key by key; null is a key like any other."""
    codes = np.zeros(batch.num_rows, np.int64)
    for k in key:
        own = batch.column(k).dictionary_encode(null_encoding="encode")
        codes = codes * len(own.dictionary) + own.indices.to_numpy(zero_copy_only=False)
        codes = np.unique(codes, return_inverse=True)[1]  # stays below the number of rows
    order = np.argsort(codes, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1) if len(order) else []:
        rows = batch.take(pa.array(own))
        yield tuple(rows.column(k)[0].as_py() for k in key), rows


def folded(events: DataFrame, folds: list[Fold], key: tuple[str, ...] = ("capture_id",), kind: str = "kind") -> dict[str, DataFrame]:
    """For each fold a table of key and its result's columns; captures without events of its kinds have no row. The events are read once for all folds."""
    key = list(key)
    needed = list(dict.fromkeys([*key, kind, *(c for f in folds for c in f.columns)]))
    keys = [events.schema[k] for k in key]
    partial_schema = T.StructType([T.StructField("fold", T.StringType()), *keys, T.StructField("held", T.BinaryType())])
    result_schema = T.StructType([T.StructField("fold", T.StringType()), *keys, T.StructField("result", T.StringType())])

    def rows_of(held: dict, schema: pa.Schema) -> pa.RecordBatch:
        columns = [[k[0] for k in held], *([k[1][i] for k in held] for i in range(len(key))), [pickle.dumps(v) for v in held.values()]]
        kinds = [pa.string(), *(schema.field(k).type for k in key), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=partial_schema.names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for f in folds:
                wanted = batch.filter(pc.is_in(batch.column(kind), value_set=pa.array(f.kinds)))
                for own, rows in by_key(wanted, key):
                    held[f.name, own] = f.add(held.get((f.name, own)) if (f.name, own) in held else f.start(), rows.select(list(f.columns)))
            if len(held) > HELD:
                yield rows_of(held, batch.schema)
                held = {}
            schema = batch.schema
        if held:
            yield rows_of(held, schema)

    by_name = {f.name: f for f in folds}

    def merged(table: pa.Table) -> pa.Table:
        f, total = by_name[table.column("fold")[0].as_py()], None
        for k, held in enumerate(table.column("held")):
            own = pickle.loads(held.as_py())  # made by partial() in this job
            total = own if k == 0 else f.merge(total, own)
        return table.slice(0, 1).drop_columns(["held"]).append_column("result", pa.array([json.dumps(f.finish(total))]))

    parts = events.where(F.col(kind).isin(*{k for f in folds for k in f.kinds})).select(*needed).mapInArrow(partial, partial_schema)
    done = written(parts.groupBy("fold", *key).applyInArrow(merged, result_schema), "folded")
    return {f.name: done.where(F.col("fold") == f.name).select(*key, F.from_json("result", f.result).alias("r")).select(*key, "r.*") for f in folds}
