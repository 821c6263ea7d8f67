"""Packing by concatenate-and-cut.

All token streams are thought of as one stream, which is cut into windows of a
fixed length. Where each document begins in it comes from prefix sums in two
passes: each partition sums its own documents as it writes them, then the totals
of the partitions (one number each) are summed. No token is shuffled. The stream
follows the partitions of the input and the order within each.

The written token table is what makes the offsets hold: partition numbers and
running sums are read from its files, not computed again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import Tokenizer, as_binary, closed
from .common import cut, slices

WINDOW = 4096
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


def prefix_totals(table: DataFrame, part: str, n: str) -> DataFrame:
    """One row per partition number: part, base (the sum of n over the partitions before it).

    One number per partition goes to the driver, which adds them up: a thousand
    tasks make a few kilobytes, whatever their size.
    """
    totals = sorted((row[0], row[1]) for row in table.groupBy(part).agg(F.sum(n)).collect())
    bases, at = [], 0
    for k, total in totals:
        bases.append((k, at))
        at += total
    return table.sparkSession.createDataFrame(bases, f"{part} int, base long")


def tokenized(docs: DataFrame, tokenizer: Tokenizer, end_id: int) -> DataFrame:
    """Columns doc_id, part, local (ids before it in its partition), n, width (bytes of an id: 2 where the vocabulary allows it, else 4), ids (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, at = tokenizer.get(), TaskContext.get().partitionId(), 0
        width = 2 if max(end_id, len(bpe.token_bytes) - 1) < 65536 else 4
        for batch in slices(batches):
            ids, n = closed(*bpe.encode_array(batch.column("text")), end_id)
            k, local = len(n), at + np.cumsum(n) - n
            at += len(ids)
            columns = [batch.column("doc_id"), pa.repeat(pa.scalar(part, pa.int32()), k), pa.array(local), pa.array(n), pa.repeat(pa.scalar(width, pa.int8()), k), as_binary(ids.astype(f"<u{width}"), n)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "local", "n", "width", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("part int, local long, n long, width byte, ids binary")]))


def pack(docs: DataFrame, tokenizer: Tokenizer, end_id: int, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """docs (doc_id, text) as pieces of windows: one boundary record per document and window that it touches.

    Columns: doc_id, start (ids of the document before the piece), length,
    ids_crc32 (of the piece), doc_tokens (with the end id), sequence_id, offset
    (in its sequence), sequence_tokens (filled places of the sequence), and with
    with_ids the piece's ids as little-endian 32-bit integers. Only the last
    sequence can be shorter than window. A null or empty text is its end id
    alone; a text of any length is cut wherever windows end; repeated rows are
    packed as often as they occur; an empty table gives no rows. Other columns
    of docs are ignored.
    """
    table = cut(tokenized(docs, tokenizer, end_id), "tokens")
    bases = prefix_totals(table, "part", "n")
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    fields = T._parse_datatype_string(PIECES + ", ids binary" * with_ids)
    fields = T.StructType([docs.schema["doc_id"], *fields.fields[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            for doc, at, width, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "width", "ids")), strict=True):
                own, start = np.frombuffer(ids, f"<u{width}").astype("<u4"), 0
                while start < len(own):
                    sequence, offset = divmod(at + start, window)
                    piece = own[start : start + window - offset].tobytes()
                    n = len(piece) // 4
                    out.append((doc, start, n, zlib.crc32(piece), len(own), sequence, offset, min(window, total - sequence * window), piece))
                    start += n
            columns = list(zip(*out, strict=True)) or [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], schema=pa.schema(list(zip(fields.names, kinds, strict=False))))

    kinds = [T_ARROW[f.dataType.typeName()] for f in fields]
    return table.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("local")).alias("at"), "width", "ids").mapInArrow(run, fields)


T_ARROW = {"long": pa.int64(), "integer": pa.int32(), "short": pa.int16(), "byte": pa.int8(), "string": pa.string(), "binary": pa.binary()}
