"""Frames inside a frame as a table function: SELECT ... FROM events, LATERAL frames_in(payload => events.payload, layout => 'short')."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

#: Layouts of the frames in a container: length and opcode, 16 bits each, or 32.
LAYOUTS = {"short": "<HH", "long": "<II"}
#: Bytes of frames that are copied at once.
COPIED = 1 << 22


@F.udtf(useArrow=True)
class FramesIn:
    """(sub, opcode, payload, length) of each frame in a container's payload, in order; what is cut off at the end is as long as it is. A null payload has none."""

    @staticmethod
    def analyze(payload: AnalyzeArgument, layout: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not isinstance(payload.dataType, T.BinaryType):
            raise ValueError("payload must be binary")
        if layout is not None and (not layout.isConstantExpression or layout.value not in LAYOUTS):
            raise ValueError(f"layout must be one of {', '.join(LAYOUTS)}")
        number = T.LongType() if layout is not None and layout.value == "long" else T.IntegerType()
        return AnalyzeResult(T.StructType([T.StructField("sub", T.IntegerType()), T.StructField("opcode", number), T.StructField("payload", T.BinaryType()), T.StructField("length", T.IntegerType())]))

    def eval(self, payload: bytes | None, layout: str | None = None) -> Iterator[tuple]:
        head = struct.Struct(LAYOUTS[layout or "short"])
        at, sub = 0, 0
        while payload is not None and at + head.size <= len(payload):
            n, opcode = head.unpack_from(payload, at)
            body = bytes(payload[at + head.size : at + head.size + n])
            yield sub, opcode, body, len(body)
            at, sub = at + head.size + n, sub + 1


def register(spark: SparkSession) -> None:
    """frames_in() for SQL."""
    spark.udtf.register("frames_in", FramesIn)


def taken_apart(payloads: pa.Array, layout: str) -> Iterator[pa.RecordBatch]:
    """(at, sub, opcode, payload, length) of the frames in all payloads, at being the payload's place; as FramesIn has them, but the n-th frames of all payloads at once."""
    width = struct.calcsize(LAYOUTS[layout]) // 2
    payloads = payloads.cast(pa.large_binary())
    offsets = np.frombuffer(payloads.buffers()[1], np.int64)[payloads.offset : payloads.offset + len(payloads) + 1]
    data = np.frombuffer(payloads.buffers()[2] or b"", np.uint8)
    number = lambda at: sum(data[at + k].astype(np.int64) << 8 * k for k in range(width))
    left, at, ends, found = np.flatnonzero(payloads.is_valid().to_numpy(zero_copy_only=False)), offsets[:-1].copy(), offsets[1:], []
    for sub in range(len(data) + 1):
        left = left[at[left] + 2 * width <= ends[left]]
        if not len(left):
            break
        n, start = number(at[left]), at[left] + 2 * width
        stop = np.minimum(start + n, ends[left])
        found.append((left, np.full(len(left), sub), number(at[left] + width), start, stop))
        at[left] = start + n
    if not found:
        return
    row, sub, opcode, start, stop = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((sub, row))
    row, sub, opcode, start, size = row[order], sub[order], opcode[order], start[order], (stop - start)[order]
    total, first = np.cumsum(size), 0
    while first < len(row):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + COPIED, "right")))
        own, begins = size[first:last], np.concatenate([np.zeros(1, np.int64), np.cumsum(size[first:last])])
        body = data[np.repeat(start[first:last] - begins[:-1], own) + np.arange(begins[-1])]
        column = pa.BinaryArray.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(begins.astype(np.int32)), pa.py_buffer(body)])
        kinds = (pa.int64(), pa.int32(), pa.int64() if layout == "long" else pa.int32(), pa.binary(), pa.int32())
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip((row[first:last], sub[first:last], opcode[first:last], column, own), kinds, strict=True)], names=["at", "sub", "opcode", "payload", "length"])
        first = last


def with_frames(df: DataFrame, payload: str = "payload", layout: str = "short") -> DataFrame:
    """df's rows joined to the frames in them: sub, opcode, payload and length are the frame's, all else is the container's. Rows without frames go."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {', '.join(LAYOUTS)}")
    own = ("sub", "opcode", "payload", "length")
    other = [c for c in df.columns if c not in own and c != payload]
    kept = df.select(*other, F.col(payload).alias("__container"))
    if not isinstance(kept.schema["__container"].dataType, T.BinaryType):
        raise ValueError("payload must be binary")
    number = "long" if layout == "long" else "int"
    schema = T.StructType([*(kept.schema[c] for c in other), *T._parse_datatype_string(f"sub int, opcode {number}, payload binary, length int")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for frames in taken_apart(batch.column(batch.num_columns - 1), layout):
                rows = [batch.column(k).take(frames.column(0)) for k in range(len(other))]
                yield pa.RecordBatch.from_arrays([*rows, *frames.columns[1:]], names=[*other, *own])

    return kept.mapInArrow(run, schema)
