"""Sharding along a Hilbert curve.

Several metadata columns are quantised to a few bits each, in their own order.
The Hilbert curve visits the cells so that neighbours on it are neighbours in
all columns; rows sorted by their place on it and cut into runs give shards with
narrow ranges in every column, which file statistics then prune. Rows of one
cell are told apart by size and id, so a cell with a third of all rows is cut
like any other run.

Only the metadata are sorted. The sorted rows are written once; a row's rank is
its place in its part plus the sizes of the parts before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut
from .packing import prefix_totals

SHARDS = 40
#: Bits of each dimension.
BITS = 5
#: Bytes that count for each row besides its text.
ROW_BYTES = 16


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of cells (rows × dimensions, values below 2**bits)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for q in (1 << k for k in range(bits - 1, 0, -1)):  # undo the rotations of the coarser levels
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(turned, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        flips = np.where((x[n - 1] & q) != 0, flips ^ (q - 1), flips)
    x ^= flips
    out = np.zeros_like(x[0])
    for k in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | (x[i] >> k & 1)
    return out


def edges(df: DataFrame, names: list[str], bits: int) -> list[list]:
    """For each column its 2**bits - 1 quantiles in the column's own order, exact ones over all rows: value k is the one at place ceil(rows * k / 2**bits).

    Equal values are counted, and the counts summed up in ranges of the order; only the quantiles go to the driver.
    """
    return [quantiles(df.select((F.col(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c).cast("double")).alias("value")), 1 << bits) for c in names]


def quantiles(values: DataFrame, n: int) -> list:
    """The n - 1 exact quantiles of values (value) that aren't null, none of an empty table."""
    counts = values.where("value is not null").groupBy("value").agg(F.count("*").alias("rows"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, upto = TaskContext.get().partitionId(), 0
        for batch in batches:
            own = upto + np.cumsum(batch.column(1).to_numpy())
            upto = int(own[-1]) if len(own) else upto
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(own), pa.int32()), pa.array(own)], names=["value", "rows", "part", "upto"])

    kinds = T.StructType([*counts.schema, *T._parse_datatype_string("part int, upto long")])
    ordered = cut(counts.repartitionByRange("value").sortWithinPartitions("value").mapInArrow(summed, kinds), "shard-quantiles")
    bases = prefix_totals(ordered, "part", "rows")
    total = ordered.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if not total:
        return []
    end = F.col("base") + F.col("upto")
    reached = lambda place: F.least(F.lit(n - 1), F.expr(f"({place}) * {n} div {total}"))  # noqa: E731  quantiles at that place or before
    times = (reached("base + upto") - reached("base + upto - rows")).alias("times")
    held = ordered.join(F.broadcast(bases), "part").select("value", end.alias("end"), times).where("times > 0").collect()  # n - 1 rows at most
    return [row["value"] for row in sorted(held, key=lambda row: row["end"]) for _ in range(row["times"])]


def quantised(df: DataFrame, dims: list[str], bits: int = BITS) -> tuple[DataFrame, list[str]]:
    """df with a cell number for each of dims: how many of its quantiles lie below the value. Null is cell 0."""

    def cell(c: str, own: list) -> Column:
        text = isinstance(df.schema[c].dataType, T.StringType)
        cuts = F.array(*map(F.lit, own)).cast("array<string>" if text else "array<double>")  # a frequent value holds several quantiles and so takes more room
        value = F.col(c) if text else F.col(c).cast("double")
        return F.coalesce(F.size(F.filter(cuts, lambda e: e < value)), F.lit(0))

    cells = {f"__d{k}": cell(c, own) for k, (c, own) in enumerate(zip(dims, edges(df, dims, bits), strict=True))}
    return df.withColumns(cells), list(cells)


def shards(docs: DataFrame, n: int = SHARDS, dims: tuple[str, ...] = ("lang", "source", "size"), bits: int = BITS, row: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null), hilbert.

    dims are columns of docs, or "size" (UTF-8 bytes of the text plus 16). Runs
    along the curve hold the same number of rows, give or take one, so equal
    sizes of rows or one value with a third of all rows make no shard larger.
    A null text has size 16 and the CRC-32 of nothing; null dimensions lie in
    the first cell. Ties are cut in order of size and doc_id, and repeated rows
    take a slot each. With fewer rows than shards some shards stay empty; an
    empty table gives no rows. Columns of docs that are not named are ignored.

    row: a column of docs with an id for each row, which the result has as well.
    """
    more = [] if row is None else [row]
    own = [d for d in dims if d != "size"]
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", *own, *more, (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    rows, cells = quantised(cut(rows, "shard-rows"), list(dims), bits)

    @F.pandas_udf(T.LongType())
    def place(c: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert(c.to_numpy(), bits))

    slim = rows.select("doc_id", *more, "size", "text_crc32", place(F.struct(*cells)).alias("hilbert"))
    kinds = T.StructType([*slim.schema, *T._parse_datatype_string("part int, at long")])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * k, pa.int32()), pa.array(np.arange(at, at + k))], names=[*batch.schema.names, "part", "at"])
            at += k

    by = ["hilbert", "size", "doc_id", "text_crc32"]
    ordered = cut(slim.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(number, kinds), "shard-order")
    bases = prefix_totals(ordered.withColumn("one", F.lit(1)), "part", "one")
    total = max(1, ordered.count())
    rank = (F.col("base") + F.col("at")).alias("rank")
    ranked = ordered.join(F.broadcast(bases), "part").select("*", rank).withColumn("shard", F.expr(f"cast(rank * {n} div {total} as int)"))
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.expr(f"rank - (cast(shard as long) * {total} + {n - 1}) div {n}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert", *more)


def write_shards(docs: DataFrame, path: str, n: int = SHARDS, dims: tuple[str, ...] = ("lang", "source", "size"), bits: int = BITS) -> None:
    """docs as Parquet under path, a folder for each shard, rows in slot order; a large shard is several files.

    Every row is written once, whatever its doc_id is and however often it
    occurs. Nulls, ties and empty tables are dealt with as in shards().
    """
    numbered = cut(docs.withColumn("__row", F.monotonically_increasing_id()), "shard-docs")
    place = shards(numbered, n, dims, bits, "__row").select("__row", F.col("shard").alias("__shard"), "slot")
    ordered = numbered.join(place.withColumnRenamed("slot", "__slot"), "__row").repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot")
    ordered.withColumnRenamed("__shard", "shard").select(*docs.columns, "shard").write.partitionBy("shard").parquet(path)
