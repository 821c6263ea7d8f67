"""Numbering, movement paths, pauses, durations and order. Windows are keyed by capture and entity, never global where data grow."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .hot import beside, numbered, ranked


def global_number(df: DataFrame, order: list[str], out: str = "n", path: str | None = None) -> DataFrame:
    """df with its place (from 0) in the order of all rows, without one task that holds them all.

    Rows are dealt by ranges of order, numbered in their part, and the sizes of
    the parts are summed. The dealt rows are written (to path, or a new one in the
    shared folder) and read back, so that both passes see the same parts.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = dealt.withColumn("__id", F.monotonically_increasing_id())
    path = path or scratch_path(df.sparkSession, "global-order")
    marked.write.mode("overwrite").parquet(path)
    marked = df.sparkSession.read.schema(marked.schema).parquet(path)
    marked = marked.withColumn("__part", F.shiftright("__id", 33)).withColumn("__at", F.col("__id").bitwiseAND((1 << 33) - 1))
    sizes = marked.groupBy("__part").agg(F.count("*").alias("__n"))  # one row for each part
    bases = sizes.withColumn("__base", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    return marked.join(F.broadcast(bases), "__part").withColumn(out, F.col("__base") + F.col("__at")).drop("__part", "__at", "__id", "__base")


def number_spawns(spawns: DataFrame, prefix: str, path: str | None = None) -> DataFrame:
    """spawns with id text '@PREFIX+0', '@PREFIX+1', ... in order of time, number and guid."""
    return global_number(spawns, ["ts", "number", "guid"], "n", path).withColumn("spawn_id", F.concat(F.lit(f"@{prefix}+"), F.col("n").cast("string")))


def order_index(df: DataFrame, key: list[str], position: list[str], order: list[str], hot_rows: int | None = None) -> DataFrame:
    """One row for each distinct position of a key with its index, in the order first seen."""
    firsts = df.groupBy(*key, *position).agg(F.min(F.struct(*order)).alias("__o")).withColumn("__first", F.col("__o")[order[0]])
    return numbered(firsts, list(key), ["__first", "__o", *position], "order_index", hot_rows).withColumn("order_index", F.col("order_index").cast("int")).drop("__o", "__first")


#: Bits of a path's flags (fixed values of this schema) and types of paths.
ENTER_CYCLE, CYCLIC, FLYING, UNCOMPRESSED = 1, 2, 4, 8
PATH_NONE, EXACT, EXACT_FLYING, EXACT_CYCLIC, EXACT_JUMP, INVALID = 0, 1, 2, 3, 4, 100


def path_type(flags: Column, has_look_target: Column, jump_start: Column) -> Column:
    """Cyclic before flying before uncompressed before a look target (invalid) before a jump."""
    has = lambda m: flags.bitwiseAND(m) != 0
    return F.when(has(ENTER_CYCLE | CYCLIC), EXACT_CYCLIC).when(has(FLYING), EXACT_FLYING).when(has(UNCOMPRESSED), EXACT).when(has_look_target, INVALID).when(F.coalesce(jump_start, F.lit(0)) > 0, EXACT_JUMP).otherwise(PATH_NONE)


def waypoints(moves: DataFrame, skip_filler: bool = False, key: list[str] = ("capture_id", "guid"), hot_rows: int | None = None) -> DataFrame:
    """The points of move events as numbered nodes of each mover: key, number, node, x, y, z, o, filler, last, type.

    moves: key, number, packed (filler points), points, dest (null or all zero:
    none), look (the orientation at the end, or null), type. Moves without
    points or of invalid type go. Numbers run over all moves of a mover; filler
    points take numbers unless they are skipped.
    """
    key = list(key)
    kept = moves.where(((F.size("packed") > 0) | (F.size("points") > 0)) & (F.col("type") != INVALID))
    node = lambda p, o, filler: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["z"].alias("z"), o.cast("double").alias("o"), F.lit(filler).alias("filler"))
    none = F.lit(None)
    real = F.col("dest").isNotNull() & ~((F.col("dest.x") == 0) & (F.col("dest.y") == 0) & (F.col("dest.z") == 0))
    middle = F.concat(F.transform("packed", lambda p: node(p, none, True)), F.transform("points", lambda p: node(p, none, False)))
    nodes = F.when(F.coalesce(real, F.lit(False)), F.concat(middle, F.array(node(F.col("dest"), F.col("look"), False)))).otherwise(middle)
    rows = kept.select(*key, "number", "type", F.posexplode(nodes).alias("pos", "n")).select(*key, "number", "type", "pos", "n.*")
    if skip_filler:
        rows = rows.where("not filler")
    placed = numbered(rows, key, ["number", "pos"], "node", hot_rows, last="last")
    return placed.withColumn("node", (F.col("node") + 1).cast("int")).drop("pos")


def path_flags(moves: DataFrame, key: list[str] = ("capture_id", "guid")) -> DataFrame:
    """Per mover: 2 if all its paths share one exact type, else 0."""
    one = (F.count_distinct("type") == 1) & F.min("type").isin(EXACT, EXACT_FLYING, EXACT_CYCLIC)
    return moves.groupBy(*key).agg(F.when(one, 2).otherwise(0).alias("flags"))


def segment_ids(points: DataFrame, key: list[str] = ("capture_id", "guid"), order: tuple[str, str] = ("number", "pos"), hot_rows: int | None = None) -> DataFrame:
    """points with segment_id (per mover), point_index (in the segment) and segment_points on every row. A task holds a segment, not a mover."""
    seg = Window.partitionBy(*key, order[0])
    return ranked(points, list(key), order[0], "segment_id", hot_rows).withColumns({"point_index": F.row_number().over(seg.orderBy(order[1])) - 1, "segment_points": F.count("*").over(seg)})


def pauses(segments: DataFrame, key: list[str] = ("capture_id", "guid"), hot_rows: int | None = None) -> DataFrame:
    """Per mover: transitions between segments, and pauses: those where the earlier move had ended before the next began. segments: key, number, ts, move_time_ms."""
    rows = beside(segments, list(key), ["ts", "number"], {"__before": F.col("ts"), "__took": F.col("move_time_ms")}, hot_rows=hot_rows)
    rows = rows.select(*key, F.col("__before").isNotNull().alias("follows"), (F.unix_micros("ts") > F.unix_micros("__before") + F.col("__took") * 1000).alias("paused"))
    return rows.groupBy(*key).agg(F.count_if("follows").alias("transitions"), F.count_if("paused").alias("pauses"))


def relative_time(events: DataFrame, key: list[str] = ("capture_id",), ts: str = "ts") -> DataFrame:
    """events with rel_ms since the first event of the capture; the firsts are aggregated and joined, as a capture can hold a third of all rows."""
    firsts = events.groupBy(*key).agg(F.min(ts).alias("__first"))
    return events.join(firsts, list(key)).withColumn("rel_ms", F.floor((F.unix_micros(ts) - F.unix_micros("__first")) / 1000)).drop("__first")


def loot_ordinal(loot: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """loot with loot_index, its place in its capture by time and number, from 0."""
    return numbered(loot, ["capture_id"], ["ts", "number"], "loot_index", hot_rows)


def drop_after_aggro(segments: DataFrame, aggro: DataFrame) -> DataFrame:
    """segments without those of any mover that was aggroed anywhere in the capture."""
    return segments.join(aggro.select("capture_id", "guid").distinct(), ["capture_id", "guid"], "left_anti")


def line_durations(lines: DataFrame, known: DataFrame, key: list[str], order: str, start: str, text: str, end: str, extra: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """Durations of lines whose text has none yet: next start less own start less extra; the last line runs to end.

    Lines of known texts (text) are left out before the next line is looked for,
    so the line before them is measured to the one after.
    """
    rows = lines.join(known.select(text).distinct(), text, "left_anti")
    rows = beside(rows, list(key), [order], {"__after": F.col(start)}, ahead=True, hot_rows=hot_rows)
    return rows.withColumn("duration", F.coalesce("__after", end) - F.col(start) - (F.coalesce(extra, F.lit(0)) if extra else F.lit(0))).drop("__after")


def order_by_key(df: DataFrame, key: list[str]) -> DataFrame:
    return df.orderBy(*key)


def order_by_first_seen(df: DataFrame, ts: str = "ts", number: str = "number") -> DataFrame:
    return df.orderBy(ts, number)


def first_events(events: DataFrame, n: int, key: list[str] = ("capture_id",), number: str = "number") -> DataFrame:
    """The first n + 1 events of each capture (the limit is tested after an event is handed on); all of them for 0.

    A limit of n keeps at most n + 1 numbers for each capture in the
    aggregation, so a large capture is not sorted in one task.
    """
    if not n:
        return events
    # No row goes further than its partition's first n + 1: the window then sees these only.
    w = Window.partitionBy(*key).orderBy(number)
    return events.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n + 1).drop("__n")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Captures, scenes or other rows of the same columns, one after the other."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def intersect_lists(a: Column, b: Column) -> Column:
    return F.array_intersect(a, b)


def union_sets(a: Column, b: Column) -> Column:
    return F.array_union(a, b)
