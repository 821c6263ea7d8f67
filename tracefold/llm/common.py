"""What the operators share: scratch tables in the cluster's shared folder and reading of the tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import passing, scratch_path

#: Rows and bytes (as JSON) below which a table whose size has been measured is broadcast; above either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 48 << 20

def cut(df: DataFrame, name: str) -> DataFrame:
    """df as a table written in the shared folder and read back: its lineage ends there.

    A lost executor costs no recomputation past this point, and every later
    read sees the same rows in the same files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of rows rows, so that few of their texts are Python objects at once; Arrow gives back what it no longer needs."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
        del batch
        pa.default_memory_pool().release_unused()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded(df: DataFrame) -> DataFrame:
    """df, a written table, marked for broadcast if it has no more than BROADCAST_ROWS rows and BROADCAST_BYTES; beyond that the join shuffles."""
    head = df.limit(BROADCAST_ROWS + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("bytes"))
    rows, size = head.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def keep_rows(docs: DataFrame, judge: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of docs that judge(docs, row) keeps, with docs' own columns.

    docs is written once with an id for each row; judge gets it with the name of
    that column and returns it with `kept`. So each verdict meets the row it was
    made for, whatever its doc_id is and however often that occurs. What judge
    writes on its way is deleted as soon as the verdicts are written.
    """
    row = "__row"
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    path, rows = scratch_path(docs.sparkSession, "dropped"), numbered.select(row)
    with passing(docs.sparkSession):
        judge(numbered, row).where(~F.col("kept")).select(row).write.parquet(path)
    dropped = docs.sparkSession.read.schema(rows.schema).parquet(path)
    return numbered.join(bounded(dropped), row, "left_anti").select(*docs.columns)
