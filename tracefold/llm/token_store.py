"""Token ids as ORC files, ordered by document id.

ORC keeps integers run-length encoded in stripes, with an index entry for every
row stride and a Bloom filter on the document ids, so one document is found by
reading stripe footers and one stride, and stripes are read in parallel. A long
document is kept as several rows of CHUNK ids at most, which bounds the rows a
reader holds at once.

Where a document begins in the whole comes from the files themselves: each row
has its file part and the ids before it in that part; the totals of the parts
(one number each) are summed when the table is opened.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import Tokenizer, closed
from .common import cut, slices
from .packing import prefix_totals

CHUNK = 4096
ORC = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(32 << 20), "compression": "zstd"}


#: The CRC-32 polynomial, lowest power in the highest bit (fixed value of zlib's crc32).
POLYNOMIAL = 0xEDB88320


def times(a: int, b: int) -> int:
    """The product of two polynomials over GF(2), modulo POLYNOMIAL."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


@functools.cache
def shift_of(n: int) -> int:
    """x to the power 8 n: what a checksum is multiplied by when n bytes follow."""
    out, square, n = 1 << 31, 1 << 30, n * 8
    while n:
        if n & 1:
            out = times(out, square)
        square, n = times(square, square), n >> 1
    return out


def combined(chunks: list) -> int:
    """The CRC-32 of a whole from {chunk, crc, bytes} of its parts in order."""
    crc = 0
    for x in chunks:
        crc = times(crc, shift_of(x["bytes"])) ^ x["crc"]
    return crc


def write_tokens(docs: DataFrame, tokenizer: Tokenizer, end_id: int, path: str, partitions: int | None = None) -> None:
    """Writes the ids of docs (doc_id, text), each followed by end_id, in ascending doc_id order.

    Texts are dealt by ranges of doc_id and of the place in the input, so that an
    id with a third of all rows is spread, sorted in their range and encoded
    where they lie; files in name order are in doc_id order. Null ids come
    first. Null and empty texts are the end id alone. Rows with the same doc_id
    are all kept, side by side in the order of the input. Other columns of docs
    are ignored; an empty table gives no rows.
    """
    fields = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("part int, local long, chunk int, n_tokens long, ids array<int>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, at = tokenizer.get(), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids, n = closed(*bpe.encode_array(batch.column("text")), end_id)
            chunks = -(-n // CHUNK)
            row = np.repeat(np.arange(len(n)), chunks)
            chunk = np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
            start = (np.cumsum(n) - n)[row] + chunk * CHUNK
            ends = pa.array(np.append(start, len(ids)).astype(np.int32))
            local = at + (np.cumsum(n) - n)[row]
            at += len(ids)
            columns = [batch.column("doc_id").take(pa.array(row)), pa.repeat(pa.scalar(part, pa.int32()), len(row)), pa.array(local), pa.array(chunk.astype(np.int32)), pa.array(n[row])]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))], names=fields.names)

    ranged = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    by = ["doc_id", "row"]
    ranged = ranged.repartitionByRange(partitions, *by) if partitions else ranged.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).select("doc_id", "text").mapInArrow(run, fields).write.options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows doc_id, start (ids of all documents before it), chunk, n_tokens (of its document), ids.

    A null or empty text is its end id alone; a long document is several chunks;
    rows of one doc_id, null too, stand side by side, each with a start of its
    own; a store of no documents gives no rows.
    """
    table = spark.read.orc(path)
    bases = prefix_totals(table.where("chunk = 0"), "part", "n_tokens")
    return table.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "chunk", "n_tokens", "ids")


def token_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document in what read_tokens() returns.

    A document of one chunk is done where it is read. The checksums of a longer
    one come from its chunks in order, brought together by (start, doc_id).
    """
    fields = T.StructType([tokens.schema["doc_id"], *T._parse_datatype_string("start long, n_tokens long, chunk int, crc long, bytes long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("ids")
            flat, at = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
            crc = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens", "chunk")), pa.array(crc, pa.int64()), pa.array(np.diff(at) * 4, pa.int64())], names=fields.names)

    @F.pandas_udf(T.LongType())
    def joined_crc(chunks: pd.Series) -> pd.Series:
        return chunks.map(combined)

    parts = cut(tokens.select("doc_id", "start", "n_tokens", "chunk", "ids").mapInArrow(run, fields), "token-digests")
    one = parts.where(F.col("n_tokens") <= CHUNK).select("doc_id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))
    more = parts.where(F.col("n_tokens") > CHUNK).groupBy("doc_id", "start", "n_tokens").agg(F.sort_array(F.collect_list(F.struct("chunk", "crc", "bytes"))).alias("chunks"))
    return one.unionByName(more.select("doc_id", "start", "n_tokens", joined_crc("chunks").alias("ids_crc32")))
