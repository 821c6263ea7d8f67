"""Tables whose rows are replaced by capture, all tables of a load at once.

A load writes its rows to new folders and a manifest, itself a table: which folder
holds the rows of each capture now. Then one small file is created under a number
that no load had before; readers take the manifest of the largest number. So until
that file is there readers see the old rows of all tables, after it the new ones,
and a load that is killed at any point has changed nothing. Two loads at once can't
both take a number: the second one fails and is run again.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import small, written

MANIFEST = "capture_id string, folder string"


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as the session sees them."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[str]:
    """The names of the commit files of path, oldest first: number and manifest folder."""
    where, system = hadoop_path(spark, f"{path}/_versions")
    return sorted(x.getPath().getName() for x in system.listStatus(where)) if system.exists(where) else []


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(capture_id, folder) of the newest version, or of the one with that number; without any, no rows."""
    own = [v for v in versions(spark, path) if version is None or int(v.split(".")[0]) == version]
    if not own:
        if version is not None:
            raise ValueError(f"{path} has no version {version}")
        return spark.createDataFrame([], MANIFEST)
    where, system = hadoop_path(spark, f"{path}/_versions/{own[-1]}")
    reader = system.open(where)
    try:
        folder = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(reader, "UTF-8")
    finally:
        reader.close()
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifests/{folder}")


def replace_rows(tables: dict[str, DataFrame], processed: DataFrame, path: str) -> int:
    """The rows of the processed captures (capture_id) in all tables, replaced by those given; the number of the new version.

    All tables have capture_id. A capture that was processed and has no rows has
    none afterwards; captures that weren't processed stay as they are.
    """
    spark = processed.sparkSession
    before = versions(spark, path)
    number, load = (int(before[-1].split(".")[0]) if before else 0) + 1, uuid.uuid4().hex[:12]
    done = written(processed.select(F.col("capture_id").cast("string").alias("capture_id")).distinct(), "processed")
    for name, df in tables.items():
        foreign = df.select(F.col("capture_id").cast("string").alias("capture_id")).join(small(done), "capture_id", "left_anti")
        if foreign.limit(1).count():
            raise ValueError(f"{name} has rows of captures that were not processed")
        df.write.partitionBy("capture_id").parquet(f"{path}/{name}/{load}")
    kept = manifest(spark, path).join(small(done), "capture_id", "left_anti")
    kept.unionByName(done.withColumn("folder", F.lit(load))).write.parquet(f"{path}/_manifests/{load}")
    commit(spark, path, number, load)
    return number


def commit(spark: SparkSession, path: str, number: int, load: str) -> None:
    """Makes a load visible: creates the file of its number, which fails if another load has it."""
    where, system = hadoop_path(spark, f"{path}/_versions/{number:012d}.json")
    writer = system.create(where, False)
    writer.write(bytearray(load.encode()))
    writer.close()


def read_rows(spark: SparkSession, path: str, table: str, version: int | None = None) -> DataFrame:
    """The rows of a table as of its newest version (or an older one that is still there).

    Only folders that the manifest names are opened, as many as loads whose rows
    still count; within them captures that a later load replaced are left out.
    """
    now = manifest(spark, path, version)
    folders = sorted(r[0] for r in now.select("folder").distinct().collect())  # one for each load
    parts = []
    for folder in folders:
        where, system = hadoop_path(spark, f"{path}/{table}/{folder}")
        if system.exists(where) and any(x.isDirectory() for x in system.listStatus(where)):
            rows = spark.read.option("basePath", where.toString()).parquet(where.toString())
            own = small(now.where(F.col("folder") == folder).select(F.col("capture_id").alias("__capture")))
            parts.append(rows.join(own, F.col("capture_id").cast("string") == F.col("__capture"), "left_semi"))
    if not parts:
        raise ValueError(f"{path} has no rows of {table}")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def vacuum(spark: SparkSession, path: str, tables: list[str], keep: int = 1) -> int:
    """Deletes what only versions before the newest `keep` need, and what killed loads have left; the number of folders deleted. Not while a load is under way."""
    names = versions(spark, path)
    for name in names[:-keep]:
        where, system = hadoop_path(spark, f"{path}/_versions/{name}")
        system.delete(where, False)
    used, manifests = set(), set()
    for name in names[-keep:]:
        where, system = hadoop_path(spark, f"{path}/_versions/{name}")
        now = manifest(spark, path, int(name.split(".")[0]))
        used |= {r[0] for r in now.select("folder").distinct().collect()}
        manifests.add(now.inputFiles()[0].rsplit("/", 2)[1] if now.inputFiles() else "")
    deleted = 0
    for folder, needed in [("_manifests", manifests), *((t, used) for t in tables)]:
        where, system = hadoop_path(spark, f"{path}/{folder}")
        for x in system.listStatus(where) if system.exists(where) else []:
            if x.getPath().getName() not in needed:
                deleted += system.delete(x.getPath(), True)
    return deleted


def write_loot_at_once(loot: DataFrame, processed: DataFrame, path: str) -> int:
    """Loot instances (capture_id, loot_index, ..., items: array) and their items as two tables that change together."""
    items = loot.select("capture_id", "loot_index", F.posexplode("items").alias("slot", "item")).select("capture_id", "loot_index", "slot", "item.*")
    return replace_rows({"items": items, "instances": loot.withColumn("item_count", F.size("items")).drop("items")}, processed, path)
