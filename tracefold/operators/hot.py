"""Windows over keys of which one may hold a third of all rows.

A key of more than HOT_ROWS rows is cut into parts at quantiles of its order, so
that no task sorts it whole. A window runs in each part; what it needs from the
parts before (their last value, their number of rows) is one row for each part,
brought together by key and joined back: a scan in segments for last values,
numbers, dense ranks and neighbours. Other keys have one part. The results are the
same whatever the cuts.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import scratch_path

#: Rows of a key that one task sorts at most, about.
HOT_ROWS = 5_000_000
#: Rows that a task gets of what is grouped by keys, about.
TASK_ROWS = 250_000
PART, DEALT = "__part", "__dealt"


def spread(df: DataFrame, key: list[str], counted: DataFrame | None = None, task_rows: int | None = None) -> DataFrame:
    """df with DEALT, a number made of key, dealt by it to one partition for every TASK_ROWS rows: what is grouped by DEALT and key needs no other shuffle, and a task holds no more however large the input is.

    The rows of counted (df, where none is given) are counted while the plan is
    built. What fits one task is left as it is. DEALT and not key, as Spark drops
    constants from the keys of a grouping but not from those rows are dealt by.
    """
    parts = -(-(df if counted is None else counted).count() // (task_rows or TASK_ROWS))
    return df.withColumn(DEALT, F.xxhash64(*key)).repartition(parts, DEALT) if parts > 1 else df.withColumn(DEALT, F.lit(0))


def parted(df: DataFrame, key: list[str], order: str, hot_rows: int | None = None) -> tuple[DataFrame, bool]:
    """df with PART, the part of its key that each row is in (rows of equal order share one), and whether any key has several.

    order: a column of numbers, dates, timestamps or strings (parted by their first bytes).
    """
    most = hot_rows or HOT_ROWS
    hot = df.groupBy(*key).agg(F.count("*").alias("__n")).where(F.col("__n") > most)
    path = scratch_path(df.sparkSession, "hot-keys")
    hot.write.parquet(path)
    hot = df.sparkSession.read.schema(hot.schema).parquet(path)  # no more rows than a total over `most`
    largest = hot.agg(F.max("__n")).first()[0]
    if largest is None:
        return df.withColumn(PART, F.lit(0)), False
    parts = -(-largest // most) + 1
    own = hot.select(*(F.col(k).alias(f"__hot{i}") for i, k in enumerate(key)))
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__hot{i}")) for i, k in enumerate(key)])
    number = ascending(F.col(order), df.schema[order].dataType)
    rows = df.select(*key, number.alias("__o")).join(F.broadcast(own), same).groupBy(*own.columns)
    cuts = rows.agg(F.percentile_approx("__o", [k / parts for k in range(1, parts)], 100 * parts).alias("__cuts"))
    path = scratch_path(df.sparkSession, "hot-cuts")
    cuts.write.parquet(path)  # approximate: all later steps must see the same cuts
    cuts = df.sparkSession.read.schema(cuts.schema).parquet(path)
    placed = df.join(F.broadcast(cuts), same, "left").withColumn(PART, F.coalesce(F.size(F.filter("__cuts", lambda c: c < number)), F.lit(0)))
    return placed.drop("__cuts", *own.columns), True


def ascending(c: Column, kind: T.DataType) -> Column:
    """A number that never falls where c rises: what rows are parted by."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.substring(F.hex(F.encode(c, "UTF-8")), 1, 14), 14, "0"), 16, 10).cast("long")
    return c if isinstance(kind, T.IntegralType) else c.cast("double")


def carried(df: DataFrame, key: list[str], order: list[str], value: Column, out: str, own: bool = True, hot_rows: int | None = None) -> DataFrame:
    """df with out: the last value that isn't null among the rows of the key up to each row (before it, if not own)."""
    rows, several = parted(df.withColumn("__v", value), key, order[0], hot_rows)
    w = Window.partitionBy(*key, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    rows = rows.withColumn(out, F.last("__v", ignorenulls=True).over(w))
    if several:
        ends = rows.groupBy(*key, PART).agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(*order))).alias("__end"))
        before = Window.partitionBy(*key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        rows = joined(rows, ends.withColumn("__earlier", F.last("__end", ignorenulls=True).over(before)).drop("__end").where("__earlier is not null"), key)
        rows = rows.withColumn(out, F.coalesce(out, "__earlier")).drop("__earlier")
    return rows.drop("__v", PART)


def numbered(df: DataFrame, key: list[str], order: list[str], out: str, hot_rows: int | None = None, last: str | None = None) -> DataFrame:
    """df with out: the place of each row in its key, from 0; and last, where a name is given: whether it is the key's last row."""
    rows, several = parted(df, key, order[0], hot_rows)
    w = Window.partitionBy(*key, PART).orderBy(*order)
    rows = rows.withColumn(out, (F.row_number().over(w) - 1).cast("long"))
    rows = rows.withColumn(last, F.lead(F.lit(True)).over(w).isNull()) if last else rows
    if several:
        parts = Window.partitionBy(*key).orderBy(PART)
        before = parts.rowsBetween(Window.unboundedPreceding, -1)
        sizes = rows.groupBy(*key, PART).agg(F.count("*").alias("__n")).select(*key, PART, F.sum("__n").over(before).alias("__earlier"), F.lead(F.lit(True)).over(parts).isNull().alias("__final"))
        rows = joined(rows, sizes.where("__earlier is not null or not __final"), key).withColumn(out, F.col(out) + F.coalesce("__earlier", F.lit(0)))
        rows = (rows.withColumn(last, F.col(last) & F.coalesce("__final", F.lit(True))) if last else rows).drop("__earlier", "__final")
    return rows.drop(PART)


def ranked(df: DataFrame, key: list[str], order: str, out: str, hot_rows: int | None = None) -> DataFrame:
    """df with out: how many smaller values of order the key has (its dense rank, from 0). Rows of one value lie in one part, so parts add up."""
    rows, several = parted(df, key, order, hot_rows)
    rows = rows.withColumn(out, F.dense_rank().over(Window.partitionBy(*key, PART).orderBy(order)) - 1)
    if several:
        before = Window.partitionBy(*key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        sizes = rows.groupBy(*key, PART).agg((F.max(out) + 1).alias("__n")).withColumn("__earlier", F.sum("__n").over(before)).drop("__n").where("__earlier is not null")
        rows = joined(rows, sizes, key).withColumn(out, (F.col(out) + F.coalesce("__earlier", F.lit(0))).cast("int")).drop("__earlier")
    return rows.drop(PART)


def beside(df: DataFrame, key: list[str], order: list[str], values: dict[str, Column], ahead: bool = False, hot_rows: int | None = None) -> DataFrame:
    """df with values of the row before each in its key's order (after it, if ahead), by the names given; null where there is none. order tells all rows of a key apart."""
    rows, several = parted(df, key, order[0], hot_rows)
    move, w = (F.lead if ahead else F.lag), Window.partitionBy(*key, PART).orderBy(*order)
    if not several:
        return rows.withColumns({out: move(c).over(w) for out, c in values.items()}).drop(PART)
    rows = rows.withColumn("__own", F.struct(*(c.alias(out) for out, c in values.items())))
    rows = rows.withColumn("__near", move("__own").over(w))
    edge = (F.min_by if ahead else F.max_by)("__own", F.struct(*order))  # what the neighbouring part ends or begins with
    ends = rows.groupBy(*key, PART).agg(edge.alias("__edge"))
    ends = ends.withColumn("__across", move("__edge").over(Window.partitionBy(*key).orderBy(PART))).drop("__edge").where("__across is not null")
    rows = joined(rows, ends, key).withColumn("__near", F.coalesce("__near", "__across"))
    return rows.withColumns({out: F.col("__near")[out] for out in values}).drop("__own", "__near", "__across", PART)


def joined(rows: DataFrame, parts: DataFrame, key: list[str]) -> DataFrame:
    """rows with the columns of parts, one row for each key and part but the first: none for keys in one part."""
    names = [*key, PART]
    right = parts.withColumnsRenamed({k: f"__on{i}" for i, k in enumerate(names)})
    on = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__on{i}")) for i, k in enumerate(names)])
    return rows.join(right, on, "left").drop(*(f"__on{i}" for i in range(len(names))))
