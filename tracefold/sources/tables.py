"""Reference tables, dimensions, names, and the sinks of a load that may be run again."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.specs import TableSpec, visible
from ..operators.changes import VALID, latest_records
from ..operators.joins import small, written
from ..operators.windows import global_number
from .scratch import scratch_path


#: Keys up to which a scan is given the keys themselves; above, their smallest and largest.
LISTED_KEYS = 1000


def read_reference(table: DataFrame, spec: TableSpec, keys: DataFrame | None = None, version: int = 1, locale: str | None = None) -> DataFrame:
    """The visible columns of a reference table; only rows with one of keys, where keys are given.

    What the scan can test reaches it: for each key column its values if they are
    few, else their range, so row groups without any are not read. The keys
    themselves are joined after that. A null key matches nothing.
    """
    names = [c.name for c in visible(spec, version, locale)]
    out = table.select(*names)
    if keys is None:
        return out
    wanted = written(keys.select(*spec.key).distinct(), "reference-keys")
    few = [tuple(r) for r in wanted.limit(LISTED_KEYS + 1).collect()]
    bounds = wanted.agg(*(f(k).alias(f"{f.__name__}_{k}") for k in spec.key for f in (F.min, F.max))).first()
    for at, k in enumerate(spec.key):
        if len(few) <= LISTED_KEYS:
            out = out.where(F.col(k).isin(*{r[at] for r in few if r[at] is not None}))
        elif bounds[2 * at] is not None:
            out = out.where(F.col(k).between(bounds[2 * at], bounds[2 * at + 1]))
    return out.join(small(wanted), spec.key, "left_semi")


def read_reference_spawns(table: DataFrame, kind: str) -> DataFrame:
    """The narrow columns of a spawn table: seven for creatures, eleven for objects."""
    columns = ["guid", "entry", "map", "x", "y", "z", "o"] + (["r0", "r1", "r2", "r3"] if kind == "object" else [])
    return table.select(*columns)


def read_dimensions(tables: dict[str, DataFrame], records: dict[str, DataFrame], key: str = "id") -> dict[str, DataFrame]:
    """Each dimension table with its change records (record_id, status, number, unique_id, table_hash, row: struct) laid over it."""
    out = {}
    for name, df in tables.items():
        if name not in records:
            out[name] = df
            continue
        last = records[name].withColumnRenamed("row", "payload")
        last = latest_records(last).select(F.col("record_id").alias("__id"), "status", F.col("payload").alias("__row"))
        both = df.select(F.struct("*").alias("__old"), F.col(key).alias("__k")).join(last, F.col("__k") == F.col("__id"), "full")
        kept = both.where(F.col("status").isNull() | (F.col("status") == VALID))
        out[name] = kept.select(F.when(F.col("status").isNull(), F.col("__old")).otherwise(F.col("__row")).alias("r")).select("r.*")
    return out


def read_names(sources: list[DataFrame]) -> DataFrame:
    """(object_type, id, name) from sources in order of priority: the first source that has a name wins."""
    rows = functools.reduce(lambda a, b: a.unionByName(b), [s.select("object_type", "id", "name").withColumn("priority", F.lit(k)) for k, s in enumerate(sources)])
    named = rows.where("name is not null and name <> ''")
    return named.groupBy("object_type", "id").agg(F.min_by("name", F.struct("priority", "name")).alias("name"))


def write_typed_events(df: DataFrame, path: str, version: int) -> None:
    """Typed events (nested structs, one filled for each row's kind) with the version of their structure."""
    df.withColumn("structure_version", F.lit(version)).write.mode("append").partitionBy("kind").parquet(path)


def read_typed_events(spark: SparkSession, path: str, kinds: list[str] | None = None) -> DataFrame:
    """Typed events; only the folders of the wanted kinds are read."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return df if kinds is None else df.where(F.col("kind").isin(*kinds))


def split_by_opcode(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("opcode_name", "direction").parquet(path)


def split_by_direction(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("direction", "opcode_name").parquet(path)


def split_by_session(df: DataFrame, path: str) -> None:
    """A folder per endpoint, '0' for events without one."""
    df.withColumn("session", F.coalesce("endpoint", F.lit("0"))).write.mode("append").partitionBy("session").parquet(path)


def split_by_count(df: DataFrame, path: str, n: int) -> None:
    """Files of n events at most; on local disks without Hadoop's .crc file beside each, which costs as much as the file (Parquet's pages have checksums of their own)."""
    raw = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
    df.write.mode("append").options(**raw).option("maxRecordsPerFile", n).parquet(path)


def merge_captures(frames: list[DataFrame], path: str) -> None:
    """All inputs in one folder; its files are read as one."""
    functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).write.mode("append").parquet(path)


def compress_captures(df: DataFrame, path: str, codec: str = "gzip") -> None:
    df.write.mode("append").option("compression", codec).parquet(path)


def move_by_version(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("client_version").parquet(path)


def upserted_captures(old: DataFrame, new: DataFrame) -> DataFrame:
    """The captures table after an upsert by file_hash: new values win, an existing id stays, new hashes get ids after the largest one.

    old and new: id (null in new), file_hash, ingested_at_utc and the same other
    columns. The new captures are numbered in ranges, not in one task.
    """
    top = old.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    last = new.groupBy("file_hash").agg(F.max_by(F.struct(*new.columns), "ingested_at_utc").alias("n")).select("n.*")
    ids = old.select("file_hash", F.col("id").alias("old_id"))
    joined = last.drop("id").join(ids, "file_hash", "left")
    fresh = global_number(joined.where("old_id is null"), ["ingested_at_utc", "file_hash"], "k", scratch_path(old.sparkSession, "new-captures")).crossJoin(F.broadcast(top))
    numbered = fresh.withColumn("id", F.col("top") + F.col("k") + 1)
    known = joined.where("old_id is not null").withColumn("id", F.col("old_id"))
    untouched = old.join(last.select("file_hash"), "file_hash", "left_anti")
    return untouched.select(*old.columns).unionByName(known.select(*old.columns)).unionByName(numbered.select(*old.columns))


def replace_capture_rows(df: DataFrame, processed: DataFrame, path: str) -> None:
    """The rows of the processed captures (capture_id), replaced by those of df, in a table partitioned by capture_id.

    Partitions that get rows are overwritten, each as a whole. Captures that were
    processed and have no rows lose their partition: overwriting with nothing
    would leave it. A failed write raises; a load that fails half way is run again,
    and leaves the same rows as one that did not.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("capture_id").parquet(path)
    empty = [r[0] for r in processed.select("capture_id").distinct().join(df.select("capture_id").distinct(), "capture_id", "left_anti").collect()]
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for capture in empty:  # one name for each capture of this load
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/capture_id={capture}")
        where.getFileSystem(hadoop).delete(where, True)


def write_loot(loot: DataFrame, processed: DataFrame, items_path: str, instances_path: str) -> None:
    """Loot instances (capture_id, loot_index, ..., items: array): the items as rows first, then the instances; both replace their captures' rows."""
    items = loot.select("capture_id", "loot_index", F.posexplode("items").alias("slot", "item")).select("capture_id", "loot_index", "slot", "item.*")
    replace_capture_rows(items, processed, items_path)
    replace_capture_rows(loot.withColumn("item_count", F.size("items")).drop("items"), processed, instances_path)


def seed_if_absent(rows: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """The rows to append to table: those whose key it lacks."""
    return rows.join(table.select(*key), key, "left_anti")


def write_changes(changes: DataFrame, path: str) -> None:
    """Change rows by target database and kind."""
    changes.write.mode("append").partitionBy("target_db", "op").parquet(path)
