"""Statistics, rollups, summaries and lookup tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .hot import DEALT, HOT_ROWS, numbered, spread
from .dedupe import first_of
from .joins import written

OUTCOMES = ("success", "with_errors", "not_parsed", "no_structure")

#: Buckets that values are counted in at a time, and rounds after which narrowing gives up.
BUCKETS, MAX_ROUNDS = 4096, 400
#: Keys that one row of grouped keys holds at most (fixed value: conditions of one statement).
BATCH = 5000


def parse_stats(events: DataFrame, key: list[str] = ("capture_id",)) -> DataFrame:
    """Per capture: counts by outcome and their share of the calculated total in percent (null where that is 0).

    An event that isn't written counts as not parsed whatever its status; status
    'none' counts nowhere.
    """
    outcome = F.when(~F.coalesce("write_to_file", F.lit(True)), "not_parsed").otherwise(F.col("status"))
    counted = events.groupBy(*key).agg(*(F.count_if(outcome == o).alias(o) for o in OUTCOMES))
    total = sum((F.col(o) for o in OUTCOMES[1:]), F.col(OUTCOMES[0]))
    return counted.withColumn("calculated_total", total).withColumns({f"{o}_pct": F.try_divide(F.lit(100.0) * F.col(o), F.col("calculated_total")) for o in OUTCOMES})


def stats_line(stats: DataFrame) -> DataFrame:
    """stats with line, a summary to show."""
    parts = [F.format_string(f"%d {o.replace('_', ' ')} (%.1f%%)", F.col(o), F.coalesce(f"{o}_pct", F.lit(0.0))) for o in OUTCOMES]
    return stats.withColumn("line", F.concat(F.format_string("%d packets: ", F.col("calculated_total")), F.concat_ws(", ", *parts)))


def exact_percentiles(df: DataFrame, key: list[str], p: float, values: dict[str, str], hot_rows: int | None = None) -> DataFrame:
    """Per key: the interpolated percentile p of each column of values (column: name of its result), nulls left out.

    Keys of up to hot_rows rows are aggregated as they are. Of larger ones the two
    middle values are found by narrowing: values are counted in BUCKETS buckets
    between the smallest and the largest, the bucket that holds the wanted place
    is cut in buckets again, until its values are one. Counts alone are shuffled,
    nothing is sorted, and no task holds a key. Results are those of F.percentile;
    a key without values has no row.
    """
    key, most = list(key), hot_rows or HOT_ROWS
    results = list(values.values())
    hot = written(df.groupBy(*key).agg(F.count("*").alias("__rows")).where(F.col("__rows") > most).withColumn("__id", F.monotonically_increasing_id()), "hot-percentiles")
    whole = lambda rows: rows.groupBy(*key).agg(*(F.percentile(F.col(c).cast("double"), p).alias(out) for c, out in values.items())).where(F.coalesce(*results).isNotNull())
    if not hot.limit(1).count():
        return whole(df)
    own = F.broadcast(hot.select("__id", *(F.col(k).alias(f"__hot{i}") for i, k in enumerate(key))))  # fewer rows than a total over `most`
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__hot{i}")) for i, k in enumerate(key)])
    each = F.array(*(F.struct(F.lit(out).alias("__of"), F.col(c).cast("double").alias("__v")) for c, out in values.items()))
    rows = written(df.join(own, same).select("__id", F.inline(each)).where("__v is not null"), "hot-values")
    found = narrowed(rows, ["__id", "__of"], p)
    between = (F.ceil("__at") - F.col("__at")) * F.col("__low") + (F.col("__at") - F.floor("__at")) * F.col("__high")
    result = F.when(F.col("__low") == F.col("__high"), F.col("__low")).otherwise(between)
    large = found.groupBy("__id").agg(*(F.max(F.when(F.col("__of") == out, result)).alias(out) for out in results))
    return whole(df.join(own, same, "left_anti")).unionByName(hot.join(large, "__id").select(*key, *results))


def narrowed(rows: DataFrame, group: list[str], p: float, buckets: int = BUCKETS) -> DataFrame:
    """(group, __at, __low, __high) of rows (group, __v): the place of the percentile p and the values around it, by counts in ever smaller buckets.

    There are few groups. A round keeps the smallest and largest value of the
    bucket that holds a place, so a far outlier costs one round.
    """
    first = rows.groupBy(*group).agg(((F.count("*") - 1) * F.lit(float(p))).alias("__at"), F.min("__v").alias("__from"), F.max("__v").alias("__to"))
    places = F.explode(F.array_distinct(F.array(F.floor("__at"), F.ceil("__at")))).alias("__place")
    state = written(first.select(*group, "__at", places, "__from", "__to", F.lit(0).cast("long").alias("__below")), "percentile-state")
    for _ in range(MAX_ROUNDS):
        open_ = state.where(F.col("__from") < F.col("__to"))
        if not open_.limit(1).count():
            return state.groupBy(*group, "__at").agg(F.min("__from").alias("__low"), F.max("__from").alias("__high"))
        inside = rows.join(F.broadcast(open_), group).where((F.col("__v") >= F.col("__from")) & (F.col("__v") <= F.col("__to")))
        share = (F.col("__v") / 2 - F.col("__from") / 2) / (F.col("__to") / 2 - F.col("__from") / 2)  # halves can't overflow
        counts = inside.groupBy(*group, "__at", "__place", "__below", F.least(F.floor(share * buckets), F.lit(buckets - 1)).alias("__bucket")).agg(F.count("*").alias("__n"), F.min("__v").alias("__from"), F.max("__v").alias("__to"))
        upto = F.col("__below") + F.sum("__n").over(Window.partitionBy(*group, "__place").orderBy("__bucket"))  # at most `buckets` rows
        held = counts.withColumn("__upto", upto).where((F.col("__place") < F.col("__upto")) & (F.col("__place") >= F.col("__upto") - F.col("__n")))
        state = written(state.where(F.col("__from") >= F.col("__to")).unionByName(held.select(*group, "__at", "__place", "__from", "__to", (F.col("__upto") - F.col("__n")).alias("__below"))), "percentile-state")
    raise ValueError("values that can't be told apart by halving, such as NaN")


def movement_summary(points: DataFrame, key: list[str] = ("capture_id", "guid")) -> DataFrame:
    """Per mover: points, segments, multi-point segments, median centre, largest and robust (99 %) distance from it, first and last time.

    Two passes: the centre, then the distances. Percentiles are exact at every
    size, and `exact` is always true. points: key, segment_id, segment_points, x, y, z, ts.
    """
    key = list(key)
    centre = points.groupBy(*key).agg(
        F.count("*").alias("points"),
        F.count_distinct("segment_id").alias("segments"),
        F.count_distinct(F.when(F.col("segment_points") > 1, F.col("segment_id"))).alias("multi_point_segments"),
        F.min("ts").alias("first_seen"),
        F.max("ts").alias("last_seen"),
    )
    medians = exact_percentiles(points, key, 0.5, {c: f"median_{c}" for c in "xyz"})
    path = scratch_path(points.sparkSession, "centres")
    centre = centre.join(medians, key, "left").select(*key, "points", "segments", "multi_point_segments", *(f"median_{c}" for c in "xyz"), "first_seen", "last_seen")
    centre.write.parquet(path)
    centre = points.sparkSession.read.schema(centre.schema).parquet(path)
    d = F.sqrt(sum(((F.col(c) - F.col(f"median_{c}")) * (F.col(c) - F.col(f"median_{c}")) for c in "yz"), (F.col("x") - F.col("median_x")) * (F.col("x") - F.col("median_x"))))
    far = points.select(*key, "x", "y", "z").join(centre.select(*key, *(f"median_{c}" for c in "xyz")), key).withColumn("d", d)
    radii = far.groupBy(*key).agg(F.max("d").alias("radius"))
    robust = exact_percentiles(far, key, 0.99, {"d": "radius_robust"})
    return centre.join(radii, key).join(robust, key, "left").withColumn("exact", F.lit(True))


def movement_kind(summary: DataFrame) -> DataFrame:
    """summary with kind: 'path' where a segment has several points, else 'wander'."""
    return summary.withColumn("kind", F.when(F.col("multi_point_segments") > 0, "path").otherwise("wander"))


def capture_map_rollup(facts: dict[str, DataFrame], key: list[str] = ("capture_id", "map")) -> DataFrame:
    """Per capture and map: the number of rows of each fact table, 0 where it has none."""
    rows = None
    for name, df in facts.items():
        own = df.groupBy(*key).agg(F.count("*").alias("n")).withColumn("kind", F.lit(name))
        rows = own if rows is None else rows.unionByName(own)
    return rows.groupBy(*key).agg(*(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in facts))


def coverage(captures: DataFrame, capabilities: DataFrame, counts: DataFrame, supported: DataFrame) -> DataFrame:
    """Per capture and capability: ok with rows, empty where it is supported but has none, unsupported without a handler.

    capabilities: (capability, collector_version), a short list; counts:
    (capture_id, capability, rows); supported: (capture_id, capability).
    """
    all_ = captures.select("capture_id").crossJoin(F.broadcast(capabilities))  # capabilities are a fixed list
    has = supported.distinct().withColumn("handled", F.lit(True))
    joined = all_.join(counts.groupBy("capture_id", "capability").agg(F.sum("rows").alias("rows")), ["capture_id", "capability"], "left").join(has, ["capture_id", "capability"], "left")
    rows = F.coalesce("rows", F.lit(0))
    status = F.when(rows > 0, "ok").when(F.coalesce("handled", F.lit(False)), "empty").otherwise("unsupported")
    return joined.select("capture_id", "capability", status.alias("status"), "collector_version", rows.alias("rows_written"), F.when(status == "unsupported", "no handler for this build").when(status == "empty", "no such event").alias("reason"))


def reparse_worklist(coverage_: DataFrame, current: DataFrame) -> DataFrame:
    """Captures to parse again: those with a capability that an older collector wrote, unsupported ones included."""
    c = current.select("capability", F.col("collector_version").alias("current_version"))
    old = coverage_.join(F.broadcast(c), "capability").where(F.col("collector_version") < F.col("current_version"))
    return old.groupBy("capture_id").agg(F.sort_array(F.collect_set("capability")).alias("capabilities"), F.min("collector_version").alias("oldest_version"))


def drop_rates(instances: DataFrame, items: DataFrame, key: list[str] = ("capture_id", "loot_index"), owner: str = "owner_entry", item: str = "item_id") -> DataFrame:
    """Per owner and item: the share of loot instances that hold it; empty instances count in the denominator."""
    key = list(key)
    total = instances.groupBy(owner).agg(F.count("*").alias("instances"))
    hits = instances.select(*key, owner).join(items.select(*key, item).distinct(), key).groupBy(owner, item).agg(F.count("*").alias("dropped"))
    return hits.join(total, owner).withColumn("chance", F.col("dropped") / F.col("instances"))


def loot_cooccurrence(items: DataFrame, key: list[str] = ("capture_id", "loot_index"), item: str = "item_id", task_rows: int | None = None) -> DataFrame:
    """Pairs of different items in the same instance, and in how many. An instance holds a few slots, so its pairs are few."""
    own = spread(items.select(*key, item), list(key), items, task_rows).groupBy(DEALT, *key).agg(F.sort_array(F.collect_set(item)).alias("s"))
    pairs = F.flatten(F.transform("s", lambda a, i: F.transform(F.slice("s", i + 2, F.greatest(F.size("s") - i - 1, F.lit(0))), lambda b: F.struct(a.alias("item_a"), b.alias("item_b")))))
    return own.select(F.inline(pairs)).groupBy("item_a", "item_b").agg(F.count("*").alias("instances"))


def spawn_point_odds(spawns: DataFrame, cell: float = 0.02, task_rows: int | None = None) -> DataFrame:
    """Per map, cell and entry: distinct guids (not sightings) and their share of the cell's."""
    place = ["map", "cx", "cy", "entry"]
    seen = spawns.select("map", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"), "entry", "guid")
    rows = spread(seen, [*place, "guid"], spawns, task_rows).distinct().groupBy(*place).agg(F.count("guid").alias("guids"))
    return rows.withColumn("share", F.col("guids") / F.sum("guids").over(Window.partitionBy("map", "cx", "cy")))


def batch_rows(df: DataFrame, n: int, key: list[str], order: list[str], hot_rows: int | None = None) -> DataFrame:
    """df with the number of its batch of n rows within each key."""
    return numbered(df, list(key), list(order), "__place", hot_rows).withColumn("batch", F.floor(F.col("__place") / n).cast("int")).drop("__place")


def compact_keys(df: DataFrame, a: str, b: str, most: int = BATCH) -> DataFrame:
    """A set of two-column keys grouped under the column with fewer distinct values (a on ties): on, value, batch, others (at most `most`, ascending)."""
    na, nb = df.agg(F.count_distinct(a), F.count_distinct(b)).first()
    one, other = (a, b) if na <= nb else (b, a)
    pairs = batch_rows(df.select(F.col(one).alias("value"), F.col(other).alias("other")).distinct(), most, ["value"], ["other"])
    return pairs.groupBy("value", "batch").agg(F.sort_array(F.collect_list("other")).alias("others")).select(F.lit(one).alias("on"), "value", "batch", "others")


def grouped_lists(df: DataFrame, key: str, value: str, out: str = "values") -> DataFrame:
    """Each key with its distinct values in order: difficulties by map, phases by group, durations by text."""
    return df.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias(out))


def zones_by_parent(areas: DataFrame) -> DataFrame:
    """Areas without a parent: id and name."""
    return areas.where("parent_id = 0").select("id", "name")


def criteria_descriptions(achievements: DataFrame, trees: DataFrame) -> DataFrame:
    """(criteria_id, description): the titles of achievements by tree, joined; then those of all trees of a criterion, joined with ' / '."""
    by_tree = achievements.groupBy("tree_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("id", "title")))["title"], ", ").alias("titles"))
    own = trees.join(by_tree, "tree_id", "left").withColumn("text", F.concat_ws(" ", "titles", "description"))
    return own.groupBy("criteria_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("tree_id", "text")))["text"], " / ").alias("description"))


def spawn_mask(difficulties: DataFrame, key: str = "map") -> DataFrame:
    """The difficulties of each map as a mask."""
    return difficulties.groupBy(key).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("difficulty").cast("int"))).alias("spawn_mask"))


def phase_groups(df: DataFrame, members: DataFrame, key: list[str], phases: str = "phases") -> DataFrame:
    """Each row's phase groups: all groups that any of its phases is in."""
    found = df.select(*key, F.explode(phases).alias("phase")).join(members, "phase").groupBy(*key).agg(F.sort_array(F.collect_set("group_id")).alias("groups"))
    return df.join(found, key, "left").withColumn("groups", F.coalesce("groups", F.array().cast("array<bigint>")))


def undefined_flags(values: DataFrame, masks: DataFrame) -> DataFrame:
    """Per enum: the set bits that its known mask lacks, each once, ascending. values: (enum, value); masks: (enum, mask)."""
    rows = values.join(F.broadcast(masks), "enum").select("enum", F.col("value").bitwiseAND(F.bitwise_not("mask")).alias("rest")).where("rest <> 0").distinct()
    bits = F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.call_function("shiftright", F.col("rest"), b).bitwiseAND(1) == 1)).alias("bit")
    return rows.select("enum", bits).groupBy("enum").agg(F.sort_array(F.collect_set("bit")).alias("bits"))


def sample_data(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Each (build, capture, type, id, data) once; those that known lacks, where it is given."""
    key = ["build", "capture_name", "object_type", "id", "data"]
    out = rows.select(*key).distinct()
    return out if known is None else out.join(known, key, "left_anti")


def connection_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("capture_id", "conn_idx", "direction").agg(F.count("*").alias("events"))


def prescan_stats(events: DataFrame, key: list[str] = ("capture_id",)) -> DataFrame:
    """Per capture: events, first and last time, without looking into them."""
    return events.groupBy(*key).agg(F.count("*").alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def capture_record(captures: DataFrame, events: DataFrame) -> DataFrame:
    """captures with first and last time, clock skew in seconds (first event less header start) and outcome counts."""
    own = prescan_stats(events).join(parse_stats(events).select("capture_id", *OUTCOMES), "capture_id")
    joined = captures.join(own, "capture_id", "left")
    return joined.withColumn("clock_skew_seconds", F.unix_seconds("first_ts") - F.unix_seconds("header_start"))


def collect_distinct_texts(lines: DataFrame, slots: int = 8) -> DataFrame:
    """Per menu: its text ids, each once, in the order first seen, 0 in the slots that are left."""
    firsts = lines.groupBy("menu_id", "text_id").agg(F.min("number").alias("number"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("number", "text_id"))), lambda x: x["text_id"].cast("long"))
    return firsts.groupBy("menu_id").agg(F.slice(F.concat(listed, F.array_repeat(F.lit(0).cast("long"), slots)), 1, slots).alias("text_ids"))


def template_addon(objects: DataFrame, templates: DataFrame, player_factions: list[int], cleared: int) -> DataFrame:
    """Per entry with a template: faction (0 for players' factions) and flags without the cleared bits, from its first sighting; none where both are 0."""
    firsts = first_of(objects, ["entry"], ["ts", "number"]).join(templates.select("entry"), "entry", "left_semi")
    rows = firsts.select("entry", F.when(F.col("faction").isin(*player_factions), 0).otherwise(F.col("faction")).alias("faction"), F.col("flags").bitwiseAND(~cleared).alias("flags"))
    return rows.where((F.col("faction") != 0) | (F.col("flags") != 0))


def merge_partial_rows(rows: DataFrame, key: list[str], parts: list[str], order: str = "number") -> DataFrame:
    """Per key: of each part the last value that isn't negative (null if none was); verified when all parts are known."""
    merged = rows.groupBy(*key).agg(*(F.max_by(F.when(F.col(p) >= 0, F.col(p)), F.when(F.col(p) >= 0, F.col(order))).alias(p) for p in parts))
    known = F.lit(True)
    for p in parts:
        known = known & F.col(p).isNotNull()
    return merged.withColumn("verified", known)


def vendor_items(lists: DataFrame) -> DataFrame:
    """Vendor rows from list events (entry, items: array of (item_id, type, stock, stack_count)): stock -1 is 0; type 2 (currency) takes the stack count as its amount."""
    rows = lists.select("entry", "ts", "number", F.posexplode("items").alias("slot", "i"))
    flat = rows.select("entry", "ts", "number", (F.col("slot") + 1).alias("slot"), F.col("i.item_id").alias("item_id"), F.col("i.type").alias("type"), F.when(F.col("i.type") == 2, F.col("i.stack_count")).otherwise(F.when(F.col("i.stock") == -1, 0).otherwise(F.col("i.stock"))).alias("max_count"))
    return first_of(flat, ["entry", "item_id", "type"], ["ts", "number", "slot"])


def exploded_list(df: DataFrame, key: list[str], values: str, item: str) -> DataFrame:
    """One row for each distinct element of a list: spell clicks, creature spells, points of interest."""
    return df.select(*key, F.posexplode(values).alias("pos", item)).groupBy(*key, item).agg(F.min("pos").alias("pos"))


def initial_and_added_auras(lists: DataFrame) -> DataFrame:
    """Aura lists with initial: the first list of each unit, the rest are additions."""
    firsts = lists.groupBy("capture_id", "guid").agg(F.min("number").alias("__first"))
    return lists.join(firsts, ["capture_id", "guid"]).withColumn("initial", F.col("number") == F.col("__first")).drop("__first")


def conversation_actors(df: DataFrame) -> DataFrame:
    """Conversations (id, lines: array of (line_id, actor_index), actors: array of (actor_id, creature_id)) as one row per line: pos, line_id, actor_id, creature_id, first_line_id."""
    line = df.select("id", F.posexplode("lines").alias("pos", "l"), "actors", F.get("lines", F.lit(0))["line_id"].alias("first_line_id"))
    actor = F.get("actors", F.col("l.actor_index"))
    return line.select("id", "pos", F.col("l.line_id").alias("line_id"), actor["actor_id"].alias("actor_id"), actor["creature_id"].alias("creature_id"), "first_line_id")


def conversation_creatures(rows: DataFrame) -> DataFrame:
    """The actors that are creatures, each once for each conversation."""
    return rows.where("creature_id > 0").select("id", "actor_id", "creature_id").distinct()


