"""Lookups, epsilon and interval joins, as-of state and request-response links."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .dedupe import first_of
from .hot import carried

#: Rows and bytes of a side that is broadcast after being measured; a larger one is shuffled.
SMALL_ROWS, SMALL_BYTES = 100_000, 48 << 20
#: Milliseconds within which a response answers a selection.
LINK_WINDOW_MS = 2500


def measured(df: DataFrame, rows: int = SMALL_ROWS, most_bytes: int = SMALL_BYTES) -> bool:
    """Whether df has no more than rows rows and most_bytes bytes (as JSON)."""
    head = df.limit(rows + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("bytes"))
    n, size = head.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return n <= rows and size <= most_bytes


def small(df: DataFrame, rows: int = SMALL_ROWS, most_bytes: int = SMALL_BYTES) -> DataFrame:
    """df marked for broadcast if it is small enough."""
    return F.broadcast(df) if measured(df, rows, most_bytes) else df


# --- names and texts (J01, J07-J11) ---


def lookup_name(df: DataFrame, names: DataFrame, dimension: DataFrame, kind: str, id_: str, with_id: bool = True, out: str = "name") -> DataFrame:
    """df with the name of id_: the dimension's, else that of names (object_type, id, name), else the id as text.

    Id 0 is '0' for all but maps. Where names has no such id and the id isn't
    shown, the name is -Unknown-.
    """
    own = small(dimension.select(F.col("id").alias("__id"), F.col("name").alias("__dim")))
    kept = small(names.where(F.col("object_type") == kind).select(F.col("id").alias("__nid"), F.col("name").alias("__name")))
    joined = df.join(own, F.col(id_) == F.col("__id"), "left").join(kept, F.col(id_) == F.col("__nid"), "left")
    text = F.col(id_).cast("string")
    shown = lambda n: F.concat(text, F.lit(" ("), n, F.lit(")")) if with_id else n
    value = F.when(F.coalesce("__dim", F.lit("")) != "", shown(F.col("__dim")))
    if kind != "Map":
        value = value.when(F.col(id_) == 0, "0")
    if not with_id:
        value = value.when(F.col("__nid").isNull(), "-Unknown-")
    value = value.when(F.coalesce("__name", F.lit("")) != "", shown(F.col("__name"))).otherwise(text)
    return joined.withColumn(out, value).drop("__id", "__dim", "__nid", "__name")


def text_ids(texts: DataFrame, text: str = "text", id_: str = "id") -> DataFrame:
    """Each text with the number of its ids and the least one."""
    return texts.groupBy(text).agg(F.count_distinct(id_).alias("n"), F.min(id_).alias("least"))


def match_text_unique(df: DataFrame, texts: DataFrame, first: str, second: str, out: str = "text_id") -> DataFrame:
    """df with the id of its text where exactly one id has it; the second text where the first is empty; 0 where both are; null otherwise."""
    key = F.when(F.coalesce(first, F.lit("")) != "", F.col(first)).otherwise(F.col(second))
    ids = text_ids(texts).where("n = 1").select(F.col("text").alias("__text"), F.col("least").alias("__least"))
    joined = df.withColumn("__key", key).join(ids, F.col("__key") == F.col("__text"), "left")
    return joined.withColumn(out, F.when(F.coalesce("__key", F.lit("")) == "", 0).otherwise(F.col("__least"))).drop("__key", "__text", "__least")


def match_text_slots(df: DataFrame, texts: DataFrame, key: list[str], first: str, second: str, slots: int = 8) -> DataFrame:
    """The same for numbered columns first1..firstN, second1..secondN: key and text_id1..text_idN."""
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("slot"), F.col(f"{first}{k}").alias("a"), F.col(f"{second}{k}").alias("b")) for k in range(1, slots + 1)))).alias("s")
    found = match_text_unique(df.select(*key, rows).select(*key, "s.*"), texts, "a", "b")
    return found.groupBy(*key).agg(*(F.max(F.when(F.col("slot") == k, F.col("text_id"))).alias(f"text_id{k}") for k in range(1, slots + 1)))


def match_text_first(df: DataFrame, texts: DataFrame, text: str, order: str = "pos") -> DataFrame:
    """df with the first id of its text (0 if none) and, where there are more, all of them joined with ' - '."""
    ids = texts.groupBy(F.col("text").alias("__text")).agg(F.transform(F.sort_array(F.collect_list(F.struct(order, "id"))), lambda x: x["id"]).alias("__ids"))
    joined = df.join(ids, F.col(text) == F.col("__text"), "left")
    several = F.when(F.size("__ids") > 1, F.array_join(F.transform("__ids", lambda x: x.cast("string")), " - "))
    return joined.withColumn("text_id", F.coalesce(F.get("__ids", F.lit(0)), F.lit(0))).withColumn("candidates", several).drop("__text", "__ids")


def lookup_text_by_menu(df: DataFrame, by_text: DataFrame, by_menu: DataFrame) -> DataFrame:
    """df (menu, text) with npc_text_id: the first id, in load order, of the text's list that is in the menu's list too.

    A menu without a list takes the text's first id; a text without one gives 0.
    by_text: (text, pos, id); by_menu: (menu, id).
    """
    firsts = by_text.groupBy("text").agg(F.min_by("id", "pos").alias("__first"))
    both = by_text.join(by_menu.distinct(), "id").groupBy("menu", "text").agg(F.min_by("id", "pos").alias("__both"))
    menus = by_menu.select("menu", F.lit(True).alias("__menu")).distinct()
    joined = df.join(firsts, "text", "left").join(both, ["menu", "text"], "left").join(menus, "menu", "left")
    value = F.when(F.col("__first").isNull(), 0).when(F.col("__menu").isNull(), F.col("__first")).otherwise(F.coalesce("__both", F.lit(0)))
    return joined.withColumn("npc_text_id", value).drop("__first", "__both", "__menu")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chains(edges: DataFrame) -> DataFrame:
    """(start, node, depth) for every node and all that its single parent pointers (child, parent) lead to, itself included, at its least depth.

    Paths double in length with each round, until a round finds no new pair; a
    ring is walked round once.
    """
    steps = edges.where("child is not null")
    reach = steps.select(F.col("child").alias("start"), F.col("child").alias("node"), F.lit(0).alias("depth")).unionByName(steps.where("parent is not null").select(F.col("child").alias("start"), F.col("parent").alias("node"), F.lit(1).alias("depth")))
    reach = written(reach.groupBy("start", "node").agg(F.min("depth").alias("depth")), "chains")
    n = reach.count()
    while True:
        more = reach.select(F.col("start").alias("node"), F.col("node").alias("next"), F.col("depth").alias("further"))
        longer = reach.join(more, "node").select("start", F.col("next").alias("node"), (F.col("depth") + F.col("further")).alias("depth"))
        reach = written(reach.unionByName(longer).groupBy("start", "node").agg(F.min("depth").alias("depth")), "chains")
        before, n = n, reach.count()
        if n == before:
            return reach


def roots(edges: DataFrame) -> DataFrame:
    """(start, root) for every child: where its single parent pointers (child, parent; null for none) end. Pointers double with each round; a ring is an error."""
    edges = written(edges.distinct(), "pointers")
    up = edges.select(F.col("child").alias("start"), F.coalesce("parent", "child").alias("root"))
    for _ in range(max(1, edges.count()).bit_length() + 1):
        above = up.select(F.col("start").alias("root"), F.col("root").alias("next"))
        jumped = written(up.join(above, "root", "left").select("start", F.coalesce("next", "root").alias("root"), (F.coalesce("next", "root") != F.col("root")).alias("moved")), "pointers")
        up = jumped.select("start", "root")
        if not jumped.where("moved").limit(1).count():
            break
    ends = edges.where("parent is not null and parent <> child").select(F.col("child").alias("root"))
    if up.join(ends, "root", "left_semi").limit(1).count():
        raise ValueError("parent pointers form a ring")
    return up


def fallback_lookup(df: DataFrame, reference: DataFrame, fallback: DataFrame) -> DataFrame:
    """df (entry, difficulty) with the reference value of the difficulty, else of the nearest one along its fallbacks (difficulty, next)."""
    steps = chains(fallback.select(F.col("difficulty").alias("child"), F.col("next").alias("parent")))
    own = df.select("difficulty").distinct().select(F.col("difficulty").alias("start"), F.col("difficulty").alias("node"), F.lit(0).alias("depth"))
    steps = small(written(steps.unionByName(own).distinct(), "fallbacks"))
    wanted = df.select("entry", "difficulty").distinct().join(steps, F.col("difficulty") == F.col("start"))
    found = wanted.select("entry", "difficulty", F.col("node").alias("__d"), "depth").join(reference.select(F.col("entry").alias("__e"), F.col("difficulty").alias("__rd"), "value"), (F.col("entry") == F.col("__e")) & (F.col("__d") == F.col("__rd")))
    best = found.groupBy("entry", "difficulty").agg(F.min_by(F.struct("value", F.col("__d").alias("from_difficulty")), "depth").alias("b")).select("entry", "difficulty", "b.*")
    return df.join(best, ["entry", "difficulty"], "left")


def resolve_root(df: DataFrame, maps: DataFrame) -> DataFrame:
    """df (map) with root: what parents, else cosmetic parents, lead to; the map itself if it has none.

    maps: (id, parent, cosmetic_parent), -1 for none. A parent that maps lacks is
    no parent. Parents in a ring are an error.
    """
    up = F.when(F.col("parent") >= 0, F.col("parent")).when(F.col("cosmetic_parent") >= 0, F.col("cosmetic_parent"))
    named = maps.select(F.col("id").alias("child"), up.alias("__up"))
    known = maps.select(F.col("id").alias("parent")).distinct()
    ends = roots(named.join(known, F.col("__up") == F.col("parent"), "left").select("child", "parent"))
    own = small(ends.withColumnRenamed("root", "__root"))
    return df.join(own, F.col("map") == F.col("start"), "left").withColumn("root", F.coalesce("__root", "map")).drop("start", "__root")


# --- spatial joins (J03-J06) ---


def near(left: DataFrame, right: DataFrame, same: list[str], eps: float, position: tuple[str, ...] = ("x", "y", "z"), extra: Column | None = None) -> DataFrame:
    """left semi joined to right: equal `same`, every coordinate nearer than eps, and extra (over l.* and r.*).

    Cells of twice eps on the first two coordinates; right is written to the
    nine cells around each of its rows, so equal cells meet all neighbours and
    the rest is a comparison. No more than nine rows for each of right's.
    """
    cell = 2 * eps
    at = lambda c, k: F.floor(F.col(c).cast("double") / cell) + k
    spread = F.explode(F.array(*(F.struct(at(position[0], i).alias("cx"), at(position[1], j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)))).alias("cell")
    r = right.select("*", spread).select("*", "cell.cx", "cell.cy").alias("r")
    l = left.select("*", at(position[0], 0).alias("__cx"), at(position[1], 0).alias("__cy")).alias("l")
    cond = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in same]
    cond += [F.col("l.__cx") == F.col("r.cx"), F.col("l.__cy") == F.col("r.cy")]
    cond += [F.abs(F.col(f"l.{p}").cast("double") - F.col(f"r.{p}").cast("double")) < eps for p in position]
    cond += [] if extra is None else [extra]
    return l.join(r, functools.reduce(lambda a, b: a & b, cond), "left_semi").drop("__cx", "__cy")


def near_pairs(left: DataFrame, right: DataFrame, same: list[str], eps: float, position: tuple[str, ...]) -> DataFrame:
    """All pairs (l, r) of structs that near() finds, for reports."""
    cell = 2 * eps
    at = lambda c, k: F.floor(F.col(c).cast("double") / cell) + k
    spread = F.explode(F.array(*(F.struct(at(position[0], i).alias("cx"), at(position[1], j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)))).alias("cell")
    r = right.select(F.struct("*").alias("r"), spread)
    l = left.select(F.struct("*").alias("l"), at(position[0], 0).alias("cx"), at(position[1], 0).alias("cy"))
    cond = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in same] + [F.col("cell.cx") == F.col("cx"), F.col("cell.cy") == F.col("cy")]
    cond += [F.abs(F.col(f"l.{p}").cast("double") - F.col(f"r.{p}").cast("double")) < eps for p in position]
    return l.join(r, functools.reduce(lambda a, b: a & b, cond)).select("l", "r")


def mark_existing_spawns(spawns: DataFrame, reference: DataFrame, key: list[str], eps: float = 0.02) -> DataFrame:
    """spawns with already_exists: a reference spawn of the same entry and map lies nearer than eps on each axis."""
    hits = near(spawns.select(*key, "entry", "map", "x", "y", "z"), reference.select("entry", "map", "x", "y", "z"), ["entry", "map"], eps).select(*key).distinct().withColumn("already_exists", F.lit(True))
    return spawns.join(hits, key, "left").withColumn("already_exists", F.coalesce("already_exists", F.lit(False)))


def mark_existing_objects(spawns: DataFrame, reference: DataFrame, key: list[str], eps: float = 0.02) -> DataFrame:
    """As mark_existing_spawns(), with orientation (normalised) and rotation nearer than eps too; z and w may both change sign, and reference entry 0 stands for any."""
    from ..functions.scalars import normalize_orientation

    close = lambda c: F.abs(F.col(f"l.{c}") - F.col(f"r.{c}")) < eps
    turned = functools.reduce(lambda a, b: a & b, [F.abs(F.col(f"l.{c}") + F.col(f"r.{c}")) < eps for c in ("r2", "r3")])
    facing = F.abs(normalize_orientation(F.col("l.o")) - normalize_orientation(F.col("r.o"))) < eps
    extra = facing & close("r0") & close("r1") & ((close("r2") & close("r3")) | turned)
    columns = ["entry", "map", "x", "y", "z", "o", "r0", "r1", "r2", "r3"]
    l, r = spawns.select(*key, *columns), reference.select(*columns)
    hits = near(l, r, ["entry", "map"], eps, extra=extra).select(*key).unionByName(near(l, r.where("entry = 0"), ["map"], eps, extra=extra).select(*key))
    return spawns.join(hits.distinct().withColumn("already_exists", F.lit(True)), key, "left").withColumn("already_exists", F.coalesce("already_exists", F.lit(False)))


def resolve_transport_map(df: DataFrame, templates: DataFrame) -> DataFrame:
    """Entities (guid, entry, entity_type, transport_guid, map) with transport_map (slot 6 of the template's data) and bad_transport."""
    carriers = df.where("entity_type = 'GameObject'").select(F.col("guid").alias("__guid"), F.col("entry").alias("__entry"))
    t = small(templates.select(F.col("entry").alias("__te"), F.get("data", F.lit(6)).alias("__map")))
    joined = df.join(carriers, F.col("transport_guid") == F.col("__guid"), "left").join(t, F.col("__entry") == F.col("__te"), "left")
    on = F.col("transport_guid").isNotNull()
    return joined.withColumn("transport_map", F.when(on & F.col("__te").isNotNull(), F.coalesce("__map", F.lit(0)))).withColumn("bad_transport", on & F.col("__te").isNull()).drop("__guid", "__entry", "__te", "__map")


def match_equipment(df: DataFrame, equipment: DataFrame, fields: list[str]) -> DataFrame:
    """df with equipment_id: the first (by pos) of the creature's sets that equals it in all fields."""
    firsts = equipment.groupBy("entry", *fields).agg(F.min_by("id", "pos").alias("equipment_id"))
    return df.join(firsts, ["entry", *fields], "left")


# --- as-of state (J12-J14, J30-J32, T07) ---


def asof(facts: DataFrame, states: DataFrame, key: list[str], fact_order: list[str], state_order: list[str], values: list[str], hot_rows: int | None = None) -> DataFrame:
    """facts with the values of the last state of their key at or before them (null before the first).

    Both are laid in one sequence, states before facts of the same place, and
    the values carried forward, in parts where a key is hot. The order columns
    must compare with each other.
    """
    order, on = [f"__o{k}" for k in range(len(fact_order))], [f"__k{i}" for i in range(len(key))]
    keys = [F.col(k).alias(o) for k, o in zip(key, on, strict=True)]
    f = facts.select(*keys, *(F.col(c).alias(o) for c, o in zip(fact_order, order, strict=True)), F.lit(1).alias("__side"), F.lit(None).cast(states.select(F.struct(*values).alias("s")).schema["s"].dataType).alias("__state"), F.struct(*facts.columns).alias("__fact"))
    s = states.select(*keys, *(F.col(c).alias(o) for c, o in zip(state_order, order, strict=True)), F.lit(0).alias("__side"), F.struct(*values).alias("__state"), F.lit(None).cast(f.schema["__fact"].dataType).alias("__fact"))
    both = carried(f.unionByName(s), on, [*order, "__side"], F.col("__state"), "__last", hot_rows=hot_rows).where("__side = 1")
    return both.select("__fact.*", *(F.col(f"__last.{v}").alias(v) for v in values))


def enrich_owner(loot: DataFrame, entities: DataFrame) -> DataFrame:
    """loot (capture_id, owner_guid) with entry, type, level and map of the entity seen, null where it never was."""
    seen = entities.select("capture_id", F.col("guid").alias("owner_guid"), F.col("entry").alias("owner_entry"), F.col("entity_type").alias("owner_type"), F.col("level").alias("owner_level"), F.col("map").alias("owner_map"))
    return loot.join(seen, ["capture_id", "owner_guid"], "left")


def asof_party_size(loot: DataFrame, parties: DataFrame, most: int = 1) -> DataFrame:
    """loot with the size of the party at its time; loot of parties above most goes."""
    sized = asof(loot, parties, ["capture_id"], ["ts"], ["ts"], ["player_count"])
    return sized.where(F.coalesce("player_count", F.lit(0)) <= most)


def asof_session_state(events: DataFrame, states: DataFrame, values: list[str] = ("map", "zone", "area", "difficulty")) -> DataFrame:
    """events with the session's map, zone, area and difficulty as of their number."""
    return asof(events, states, ["capture_id"], ["number"], ["number"], list(values))


def attach_near_create(entities: DataFrame, attributes: DataFrame, value: str, seconds: float = 1.0) -> DataFrame:
    """entities (capture_id, guid, ts) with value of the last attribute event (by number) within seconds of their first sighting, ends included."""
    seen = entities.groupBy("capture_id", "guid").agg(F.min("ts").alias("__first"))
    gap = F.abs(F.unix_micros("ts") - F.unix_micros("__first"))
    near_ = attributes.join(seen, ["capture_id", "guid"]).where(gap <= int(seconds * 1e6))
    last = near_.groupBy("capture_id", "guid").agg(F.max_by(value, "number").alias(value))
    return entities.drop(value).join(last, ["capture_id", "guid"], "left")


def start_data_by_first_login(rows: DataFrame, logins: DataFrame, characters: DataFrame) -> DataFrame:
    """rows with race and class of the character that is logged in, first logins only."""
    with_guid = asof(rows, logins.select("capture_id", "number", F.col("guid").alias("character_guid")), ["capture_id"], ["number"], ["number"], ["character_guid"])
    return with_guid.join(characters.where("first_login").select("capture_id", F.col("guid").alias("character_guid"), "race", "class"), ["capture_id", "character_guid"])


def mark_summoned(entities: DataFrame, effects: DataFrame) -> DataFrame:
    """entities with forced_temporary where a summon effect after their first sighting names them as its product."""
    last = effects.groupBy("capture_id", F.col("target_guid").alias("guid")).agg(F.max("number").alias("__effect"))
    return entities.join(last, ["capture_id", "guid"], "left").withColumn("forced_temporary", F.coalesce(F.col("__effect") > F.col("number"), F.lit(False))).drop("__effect")


def phase_override(entities: DataFrame, overrides: DataFrame) -> DataFrame:
    """entities with the phase of the last override after they were first seen."""
    seen = entities.select("capture_id", "guid", F.col("number").alias("__first"))
    last = overrides.join(seen, ["capture_id", "guid"]).where(F.col("number") > F.col("__first")).groupBy("capture_id", "guid").agg(F.max_by("phase", "number").alias("phase_override"))
    return entities.join(last, ["capture_id", "guid"], "left")


# --- request and response (J15-J18) ---

SELECTION, RESPONSE, RESET, DETAIL = "selection", "response", "reset", "detail"


def link_request_response(events: DataFrame, window_ms: int = LINK_WINDOW_MS, session: list[str] = ("capture_id",), hot_rows: int | None = None) -> DataFrame:
    """The responses among events (session, number, ts, kind), each with the number of the selection that it answers, or null.

    A selection waits for the next response: one within window_ms takes it, a
    later one clears it, a reset clears it, another selection replaces it. So a
    response is linked when the event before it, of these three kinds, is a
    selection that is near enough.
    """
    relevant = events.where(F.col("kind").isin(SELECTION, RESPONSE, RESET))
    rows = carried(relevant, list(session), ["number"], F.struct("kind", "number", "ts"), "__before", own=False, hot_rows=hot_rows).where(F.col("kind") == RESPONSE)
    gap = F.abs(F.unix_micros("ts") - F.unix_micros("__before.ts"))
    linked = (F.col("__before.kind") == SELECTION) & (gap <= window_ms * 1000)
    return rows.select(*events.columns, F.when(linked, F.col("__before.number")).alias("selection_number"))


def default_response(linked: DataFrame, key: str = "entity") -> DataFrame:
    """Responses that answer no selection, the first of each entity: what it says by default."""
    return first_of(linked.where("selection_number is null"), [key], ["ts", "number"])


def link_delayed_detail(events: DataFrame, window_ms: int = LINK_WINDOW_MS, session: list[str] = ("capture_id",), hot_rows: int | None = None) -> DataFrame:
    """The details among events with the number of the selection they still belong to, or null.

    A linked response keeps its selection for a detail that comes after it; a
    detail near enough (to the selection) takes and clears it, a late one or a
    reset clears it, another linked response replaces it.
    """
    links = link_request_response(events, window_ms, session, hot_rows).select(*session, "number", "selection_number")
    times = events.where(F.col("kind") == SELECTION).select(*session, F.col("number").alias("selection_number"), F.col("ts").alias("selection_ts"))
    responses = events.where(F.col("kind") == RESPONSE).join(links, [*session, "number"]).join(times, [*session, "selection_number"], "left")
    saved = F.when(F.col("selection_number").isNotNull(), "saved").otherwise("cleared")
    # A response without a pending selection leaves what is saved; a late one clears it.
    three = carried(events.where(F.col("kind").isin(SELECTION, RESPONSE, RESET)).select(*session, "number", "kind"), list(session), ["number"], F.col("kind"), "before", own=False, hot_rows=hot_rows)
    responses = responses.join(three.where(F.col("kind") == RESPONSE).select(*session, "number", "before"), [*session, "number"])
    steps = responses.where((F.col("selection_number").isNotNull()) | (F.col("before") == SELECTION)).select(*session, "number", saved.alias("step"), "selection_number", "selection_ts", F.lit(None).cast("timestamp").alias("ts"))
    resets = events.where(F.col("kind") == RESET).select(*session, "number", F.lit("cleared").alias("step"), F.lit(None).cast("long").alias("selection_number"), F.lit(None).cast("timestamp").alias("selection_ts"), F.lit(None).cast("timestamp").alias("ts"))
    details = events.where(F.col("kind") == DETAIL).select(*session, "number", F.lit("detail").alias("step"), F.lit(None).cast("long").alias("selection_number"), F.lit(None).cast("timestamp").alias("selection_ts"), "ts")
    rows = carried(steps.unionByName(resets).unionByName(details), list(session), ["number"], F.struct("step", "selection_number", "selection_ts"), "b", own=False, hot_rows=hot_rows).where("step = 'detail'")
    near_enough = (F.col("b.step") == "saved") & (F.abs(F.unix_micros("ts") - F.unix_micros("b.selection_ts")) <= window_ms * 1000)
    return rows.select(*session, "number", "ts", F.when(near_enough, F.col("b.selection_number")).alias("selection_number"))


def link_trainer(linked: DataFrame, selections: DataFrame, session: list[str] = ("capture_id",)) -> DataFrame:
    """Trainer lists with creature, menu and option of their selection; (menu, option) 0 where there is none."""
    s = selections.select(*session, F.col("number").alias("selection_number"), "creature_id", "menu_id", "option_id")
    joined = linked.join(s, [*session, "selection_number"], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("menu_id", "option_id")})


# --- other lookups (J19-J29, J33) ---


def propagate_parent(children: DataFrame, parents: DataFrame, columns: list[str] = ("spell_id", "properties_id", "is_custom")) -> DataFrame:
    """Child rows with columns of their parent entity; children without one go."""
    return children.join(parents.select("guid", *columns), "guid")


def spell_effect_targets(casts: DataFrame, effects: DataFrame, codes: tuple[int, int], effects_a_spell: int = 32) -> DataFrame:
    """Casts with a destination times those effects of the spell whose targets have either code; multiple: more than one such effect index."""
    wanted = effects.where((F.col("effect_index") < effects_a_spell) & F.exists("targets", lambda t: t.isin(*codes)))
    joined = casts.where("dest_x is not null").join(wanted, "spell_id")
    many = wanted.groupBy("spell_id").agg((F.count_distinct("effect_index") > 1).alias("multiple"))
    return joined.join(many, "spell_id")


def fill_from_first_instance(templates: DataFrame, entities: DataFrame, column: str = "size", source: str = "scale") -> DataFrame:
    """templates whose column is null take source of the first entity of their entry."""
    firsts = entities.groupBy("entry").agg(F.min_by(source, F.struct("ts", "number")).alias("__first"))
    return templates.join(firsts, "entry", "left").withColumn(column, F.coalesce(column, "__first")).drop("__first")


def keep_resolved(df: DataFrame, dimension: DataFrame, key: str, value: str) -> DataFrame:
    """df with value from the dimension where it lacks one, only rows that then have it."""
    d = small(dimension.select(key, F.col(value).alias("__v")))
    return df.join(d, key, "left").withColumn(value, F.coalesce(value, "__v")).drop("__v").where(F.col(value).isNotNull())


#: Least rank of reputation and its factor (fixed values).
DISCOUNTS = ((7, 0.80), (6, 0.85), (5, 0.90), (4, 0.95))


def discount_by_reputation(vendors: DataFrame, templates: DataFrame, factions: DataFrame, standing: DataFrame) -> DataFrame:
    """Vendors (guid, faction_template) with the factor that their faction's standing gives; 1 where unknown."""
    joined = vendors.join(small(templates.select("faction_template", "faction")), "faction_template", "left").join(small(factions.select("faction", "reputation_index")), "faction", "left").join(small(standing.select("reputation_index", "rank")), "reputation_index", "left")
    factor = functools.reduce(lambda c, x: c.when(F.col("rank") >= x[0], x[1]), DISCOUNTS, F.when(F.lit(False), 1.0)).otherwise(1.0)
    return joined.withColumn("factor", factor)


def terrain_valid(df: DataFrame, validity: DataFrame, target: str) -> DataFrame:
    """Rows (map, branch) whose branch is usable for target on that map; maps without an entry go."""
    v = small(validity.where(F.col("target") == target).select("map", F.split("usable_branches", ",").alias("__branches")))
    return df.join(v, "map").where(F.array_contains("__branches", F.col("branch"))).drop("__branches")


def resolve_handler(events: DataFrame, registry: DataFrame, fallbacks: DataFrame) -> DataFrame:
    """events (build, opcode) with the handler that covers them: of the exact build group, then its fallbacks, then any.

    registry: (opcode, group, added, removed, handler), valid for builds in
    [added, removed), a null end open; group null stands for any. fallbacks:
    (build_group, group, rank). events have build_group too. Nothing is decoded:
    the result says what is covered.
    """
    ranks = fallbacks.unionByName(events.select("build_group").distinct().select("build_group", F.col("build_group").alias("group"), F.lit(0).alias("rank")))
    named = registry.where("`group` is not null").join(ranks, "group").select("build_group", "opcode", "added", "removed", "handler", "rank")
    any_ = registry.where("`group` is null").crossJoin(F.broadcast(events.select("build_group").distinct())).select("build_group", "opcode", "added", "removed", "handler", F.lit(1_000_000).alias("rank"))
    kinds = events.select("build_group", "build", "opcode").distinct()
    r = small(named.unionByName(any_)).alias("r")
    k = kinds.alias("k")
    fits = k.join(r, (F.col("k.build_group") == F.col("r.build_group")) & (F.col("k.opcode") == F.col("r.opcode")) & (F.coalesce("r.added", F.lit(0)) <= F.col("k.build")) & (F.col("r.removed").isNull() | (F.col("k.build") < F.col("r.removed"))))
    best = fits.groupBy("k.build_group", "k.build", "k.opcode").agg(F.min_by("r.handler", F.struct("r.rank", "r.handler")).alias("handler"))
    return events.join(best, ["build_group", "build", "opcode"], "left")


def vehicle_accessories(df: DataFrame) -> DataFrame:
    """(vehicle_entry, accessory_entry, seat) of creatures that ride a vehicle, each once."""
    v = df.where("entity_type = 'Vehicle'").select(F.col("guid").alias("transport_guid"), F.col("entry").alias("vehicle_entry"))
    return df.where("entity_type <> 'Player'").join(v, "transport_guid").select("vehicle_entry", F.col("entry").alias("accessory_entry"), "seat").distinct()


def option_by_index_map(selections: DataFrame, options: DataFrame) -> DataFrame:
    """Selections (menu_id, option_id) with the order index first captured for them."""
    firsts = options.groupBy("menu_id", "option_id").agg(F.min_by("order_index", F.struct("ts", "number")).alias("order_index"))
    return selections.join(firsts, ["menu_id", "option_id"], "left")


def properties_id_from_spell(spells: DataFrame, effects: DataFrame, wanted: int, effects_a_spell: int = 32) -> DataFrame:
    """spells with properties_id: that of their only effect of the wanted kind, null where there are none or several."""
    own = effects.where((F.col("effect") == wanted) & F.col("effect_index").between(0, effects_a_spell - 1)).groupBy("spell_id").agg(F.count("*").alias("__n"), F.min("misc_value").alias("__misc"))
    return spells.join(own, "spell_id", "left").withColumn("properties_id", F.when(F.col("__n") == 1, F.col("__misc"))).drop("__n", "__misc")
