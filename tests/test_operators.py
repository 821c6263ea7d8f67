"""Joins, filters, aggregates and windows on hand-made rows and against brute force."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tracefold.operators import aggregates as A
from tracefold.operators import dedupe as D
from tracefold.operators import filters as L
from tracefold.operators import hot
from tracefold.operators import joins as J
from tracefold.operators import windows as W
from tracefold.plans import bindings

T0 = dt.datetime(2024, 1, 1)


def at(ms):
    return T0 + dt.timedelta(milliseconds=ms)


def df(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


SPAWN = "id int, entry int, map int, x double, y double, z double"


def test_spatial_match(spark):
    ref = df(spark, SPAWN, (0, 1, 0, 0.0, 0.0, 0.0))
    obs = df(spark, SPAWN, (1, 1, 0, 0.019, 0.0, 0.0), (2, 1, 0, 0.020, 0.0, 0.0), (3, 1, 0, -0.019, -0.019, 0.019), (4, 1, 1, 0.0, 0.0, 0.0), (5, 2, 0, 0.0, 0.0, 0.0), (6, 1, 0, 0.0, 0.0, 0.02))
    got = {r["id"]: r["already_exists"] for r in J.mark_existing_spawns(obs, ref, ["id"]).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False}


def test_spatial_match_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(k, rng.randrange(2), 0, rng.uniform(-0.2, 0.2), rng.uniform(-0.2, 0.2), 0.0) for k in range(300)]
    obs, ref = rows[:150], rows[150:]
    want = {o[0]: any(o[1] == r[1] and all(abs(o[k] - r[k]) < 0.02 for k in (3, 4, 5)) for r in ref) for o in obs}
    assert {r["id"]: r["already_exists"] for r in J.mark_existing_spawns(df(spark, SPAWN, *obs), df(spark, SPAWN, *ref), ["id"]).collect()} == want
    pairs = {(r["l"]["id"], r["r"]["id"]) for r in J.near_pairs(df(spark, SPAWN, *obs), df(spark, SPAWN, *ref), ["entry", "map"], 0.02, ("x", "y", "z")).collect()}
    assert pairs == {(o[0], r[0]) for o in obs for r in ref if o[1] == r[1] and all(abs(o[k] - r[k]) < 0.02 for k in (3, 4, 5))}


def test_object_match(spark):
    schema = SPAWN + ", o double, r0 double, r1 double, r2 double, r3 double"
    ref = df(spark, schema, (0, 0, 0, 0.0, 0.0, 0.0, 3.2 - 2 * math.pi, 0.0, 0.0, 0.6, 0.8))
    obs = df(spark, schema, (1, 9, 0, 0.0, 0.0, 0.0, 3.2, 0.0, 0.0, -0.6, -0.8), (2, 9, 0, 0.0, 0.0, 0.0, 3.2, 0.0, 0.0, -0.6, 0.8), (3, 9, 0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.6, 0.8))
    assert {r["id"]: r["already_exists"] for r in J.mark_existing_objects(obs, ref, ["id"]).collect()} == {1: True, 2: False, 3: False}


EVENTS = "capture_id int, number long, ts timestamp, kind string"


def scan_links(rows, window=2500):
    """The state machine over ordered rows: (responses, details), number to selection."""
    pending = saved = None
    responses, details = {}, {}
    for number, ms, kind in rows:
        if kind == "selection":
            pending = (number, ms)
        elif kind == "reset":
            pending = saved = None
        elif kind == "response":
            hit = pending and abs(ms - pending[1]) <= window
            responses[number] = pending[0] if hit else None
            if hit:
                saved = pending
            elif pending:
                saved = None
            pending = None
        else:
            details[number] = saved[0] if saved and abs(ms - saved[1]) <= window else None
            saved = None
    return responses, details


def test_links(spark):
    rows = [(1, 0, "selection"), (2, 2500, "response"), (3, 2500, "detail"), (4, 3000, "selection"), (5, 5501, "response"), (6, 5600, "response"), (7, 6000, "selection"), (8, 6001, "reset"), (9, 6002, "response"), (10, 7000, "selection"), (11, 7001, "selection"), (12, 7002, "response"), (13, 7003, "response"), (14, 9600, "detail")]
    e = df(spark, EVENTS, *((1, n, at(ms), k) for n, ms, k in rows))
    want, details = scan_links(rows)
    assert want == {2: 1, 5: None, 6: None, 9: None, 12: 11, 13: None}
    linked = J.link_request_response(e)
    assert {r["number"]: r["selection_number"] for r in linked.collect()} == want
    assert {r["number"]: r["selection_number"] for r in J.link_delayed_detail(e).collect()} == details
    first = J.default_response(linked.withColumn("entity", F.lit(1))).first()
    assert first["number"] == 5
    s = df(spark, "capture_id int, number long, creature_id int, menu_id int, option_id int", (1, 1, 5, 6, 7))
    assert {(r["number"], r["menu_id"], r["option_id"]) for r in J.link_trainer(linked, s).where("number < 6").collect()} == {(2, 6, 7), (5, 0, 0)}


@pytest.mark.parametrize("seed", range(3))
def test_links_equal_a_scan(spark, seed):
    rng, rows, all_ = random.Random(seed), [], {}
    for c in range(5):
        ms, own = 0, []
        for _ in range(60):
            ms += rng.choice([1, 500, 2000, 2500, 2501, 4000])
            own.append((len(rows) + len(own) + 1, ms, rng.choice(["selection", "response", "reset", "detail", "response", "selection"])))
        all_[c] = scan_links(own)
        rows += [(c, n, at(ms), k) for n, ms, k in own]
    e = df(spark, EVENTS, *rows)
    assert {r["number"]: r["selection_number"] for r in J.link_request_response(e).collect()} == {k: v for r, _ in all_.values() for k, v in r.items()}
    assert {r["number"]: r["selection_number"] for r in J.link_delayed_detail(e).collect()} == {k: v for _, d in all_.values() for k, v in d.items()}


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_a_hot_capture_is_cut_in_parts(spark, hot_rows):
    rng = random.Random(4)
    rows = [(1 if k % 10 else (None if k % 20 else 2), rng.randrange(400), at(k), rng.choice(["selection", "response", "reset"]), rng.choice([None, k])) for k in range(900)]
    e = df(spark, "capture_id int, at int, ts timestamp, kind string, value int", *rows).withColumn("number", F.monotonically_increasing_id())
    e = e.withColumn("number", F.col("at").cast("long") * 10_000 + F.unix_millis("ts") % 10_000)
    got = {(r["capture_id"], r["number"]): r["v"] for r in hot.carried(e, ["capture_id"], ["number"], F.col("value"), "v", hot_rows=hot_rows).collect()}
    linked = {(r["capture_id"], r["number"]): r["selection_number"] for r in J.link_request_response(e, hot_rows=hot_rows).collect()}
    places = {(r["capture_id"], r["number"]): r["n"] for r in hot.numbered(e, ["capture_id"], ["number"], "n", hot_rows).collect()}
    facts, states = e.where("value is null"), e.where("value is not null").select("capture_id", "number", F.col("value").alias("state"))
    state = {(r["capture_id"], r["number"]): r["state"] for r in J.asof(facts, states, ["capture_id"], ["number"], ["number"], ["state"], hot_rows).collect()}
    if hot_rows:
        parts, several = hot.parted(e, ["capture_id"], "number", hot_rows)
        sizes = [r["n"] for r in parts.groupBy("capture_id", hot.PART).agg(F.count("*").alias("n")).collect()]
        assert several and len(sizes) > 15 and max(sizes) <= 2 * hot_rows
    for capture in (None, 1, 2):
        own = sorted((r for r in e.collect() if r["capture_id"] == capture), key=lambda r: r["number"])
        last = before = None
        for k, r in enumerate(own):
            last = r["value"] if r["value"] is not None else last
            key = capture, r["number"]
            assert got[key] == last and places[key] == k and (r["value"] is not None or state[key] == last)
            if r["kind"] == "response":
                hit = before is not None and before["kind"] == "selection" and abs((r["ts"] - before["ts"]).total_seconds()) <= 2.5
                assert linked[key] == (before["number"] if hit else None)
            before = r


@pytest.mark.parametrize("kind", ["string", "date", "decimal(20,2)", "bigint"])
def test_parts_by_any_kind_of_order(spark, kind):
    rng = random.Random(6)
    e = df(spark, "k int, v int", *((1, rng.randrange(3000) if i else None) for i in range(500)))
    text = F.concat(F.chr((F.col("v") % 7 + 200).cast("long")), F.format_string("%05d", "v"))
    e = e.withColumn("o", {"string": text, "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("v"))}.get(kind, F.col("v").cast(kind))).withColumn("id", F.monotonically_increasing_id())
    want = {r["id"]: r["n"] for r in hot.numbered(e, ["k"], ["o", "id"], "n").collect()}
    assert sorted(want.values()) == list(range(500))
    parts, several = hot.parted(e, ["k"], "o", 60)
    assert several and parts.select(hot.PART).distinct().count() > 4
    assert {r["id"]: r["n"] for r in hot.numbered(e, ["k"], ["o", "id"], "n", 60).collect()} == want


def test_chains_of_any_length(spark):
    n = 150
    maps = df(spark, "id int, parent int, cosmetic_parent int", *[(k, k - 1, -1) for k in range(n)], (500, 777, -1), (501, 500, -1), (502, -1, 999), (503, -1, 500))
    rows = df(spark, "map int", (n - 1,), (500,), (501,), (502,), (503,), (888,), (None,))
    assert {r["map"]: r["root"] for r in J.resolve_root(rows, maps).collect()} == {n - 1: 0, 500: 500, 501: 500, 502: 502, 503: 500, 888: 888, None: None}
    for ring in ([(1, 2), (2, 1)], [(1, 2), (2, 3), (3, 1)], [(1, 2), (2, 3), (3, 4), (4, 1), (5, 1)]):
        with pytest.raises(ValueError, match="ring"):
            J.resolve_root(rows, df(spark, "id int, parent int, cosmetic_parent int", *[(a, b, -1) for a, b in ring])).collect()
    steps = df(spark, "difficulty int, next int", *[(k, k - 1) for k in range(1, n)], (0, None), (900, 901), (901, 900))
    ref = df(spark, "entry int, difficulty int, value int", (7, 3, 33), (8, 901, 44))
    want = df(spark, "entry int, difficulty int", (7, n - 1), (7, 2), (8, 900), (9, 5))
    assert {(r["entry"], r["difficulty"]): (r["value"], r["from_difficulty"]) for r in J.fallback_lookup(want, ref, steps).collect()} == {(7, n - 1): (33, 3), (7, 2): (None, None), (8, 900): (44, 901), (9, 5): (None, None)}


def test_asof(spark):
    parties = df(spark, "capture_id int, ts timestamp, player_count int", (1, at(10), 1), (1, at(20), 5), (2, at(0), 5))
    loot = df(spark, "capture_id int, ts timestamp, id int", (1, at(5), 1), (1, at(10), 2), (1, at(19), 3), (1, at(20), 4), (2, at(1), 5), (3, at(1), 6))
    assert {r["id"] for r in J.asof_party_size(loot, parties).collect()} == {1, 2, 3, 6}


def test_near_create(spark):
    e = df(spark, "capture_id int, guid string, ts timestamp", (1, "a", at(0)), (1, "b", at(0)))
    attr = df(spark, "capture_id int, guid string, ts timestamp, number int, emote int", (1, "a", at(1000), 1, 5), (1, "a", at(1001), 2, 6), (1, "a", at(-1000), 0, 4), (1, "b", at(1500), 3, 7))
    assert {r["guid"]: r["emote"] for r in J.attach_near_create(e, attr, "emote").collect()} == {"a": 5, "b": None}


def test_lookups(spark):
    names = df(spark, "object_type string, id int, name string", ("Map", 0, "Zero"), ("Unit", 5, "Wolf"), ("Unit", 6, ""))
    dims = df(spark, "id int, name string", (7, "Dim"))
    ids = df(spark, "id2 int", (0,), (5,), (6,), (7,), (9,))
    got = lambda kind, w: {r["id2"]: r["name"] for r in J.lookup_name(ids, names, dims, kind, "id2", w).collect()}
    assert got("Unit", True) == {0: "0", 5: "5 (Wolf)", 6: "6", 7: "7 (Dim)", 9: "9"}
    assert got("Unit", False) == {0: "0", 5: "Wolf", 6: "6", 7: "Dim", 9: "-Unknown-"}
    assert got("Map", True)[0] == "0 (Zero)"
    texts = df(spark, "text string, id int, pos int", ("a", 1, 1), ("b", 2, 2), ("b", 3, 1))
    rows = df(spark, "k int, f1 string, f2 string, m1 string, m2 string", (1, "a", "b", "", "a"), (2, "", None, None, None))
    got = {r["k"]: (r["text_id1"], r["text_id2"]) for r in J.match_text_slots(rows, texts, ["k"], "f", "m", 2).collect()}
    assert got == {1: (1, None), 2: (0, 0)}
    first = {r["text"]: (r["text_id"], r["candidates"]) for r in J.match_text_first(df(spark, "text string", ("a",), ("b",), ("c",)), texts, "text").collect()}
    assert first == {"a": (1, None), "b": (3, "3 - 2"), "c": (0, None)}


def test_other_joins(spark):
    e = df(spark, "guid string, entry int, entity_type string, transport_guid string, map int, seat int", ("s", 10, "GameObject", None, 1, 0), ("c", 5, "Unit", "s", 1, 0), ("d", 6, "Unit", "gone", 1, 2), ("v", 20, "Vehicle", None, 1, 0), ("r", 7, "Unit", "v", 1, 3), ("p", 0, "Player", "v", 1, 0))
    t = df(spark, "entry int, data array<int>", (10, [0, 0, 0, 0, 0, 0, 614]))
    got = {r["guid"]: (r["transport_map"], r["bad_transport"]) for r in J.resolve_transport_map(e, t).collect()}
    assert got["c"] == (614, False) and got["d"] == (None, True) and got["s"] == (None, False)
    assert [tuple(r) for r in J.vehicle_accessories(e).collect()] == [(20, 7, 3)]
    eq = df(spark, "id int, pos int, entry int, i1 int", (2, 2, 5, 9), (1, 1, 5, 9))
    assert J.match_equipment(df(spark, "entry int, i1 int", (5, 9)), eq, ["i1"]).first()["equipment_id"] == 1
    sp = df(spark, "spell_id int", (1,), (2,), (3,))
    fx = df(spark, "spell_id int, effect_index int, effect int, misc_value int, targets array<int>", (1, 0, 8, 77, [1]), (2, 0, 8, 1, [2, 9]), (2, 1, 8, 2, [3]))
    assert {r["spell_id"]: r["properties_id"] for r in J.properties_id_from_spell(sp, fx, 8).collect()} == {1: 77, 2: None, 3: None}
    casts = df(spark, "spell_id int, dest_x double", (2, 1.0), (2, None), (1, 1.0))
    assert [(r["spell_id"], r["effect_index"], r["multiple"]) for r in J.spell_effect_targets(casts, fx, (9, 3)).orderBy("effect_index").collect()] == [(2, 0, True), (2, 1, True)]
    summons = df(spark, "capture_id int, target_guid string, number int", (1, "c", 5), (1, "d", 1))
    ents = df(spark, "capture_id int, guid string, number int", (1, "c", 2), (1, "d", 2))
    assert {r["guid"]: r["forced_temporary"] for r in J.mark_summoned(ents, summons).collect()} == {"c": True, "d": False}
    over = df(spark, "capture_id int, guid string, number int, phase int", (1, "c", 1, 3), (1, "c", 3, 4), (1, "c", 4, 5))
    assert {r["guid"]: r["phase_override"] for r in J.phase_override(ents, over).collect()} == {"c": 5, "d": None}
    logins = df(spark, "capture_id int, number int, guid string", (1, 1, "A"), (1, 10, "B"))
    chars = df(spark, "capture_id int, guid string, race int, class int, first_login boolean", (1, "A", 2, 3, True), (1, "B", 4, 5, False))
    acts = df(spark, "capture_id int, number int, action int", (1, 5, 100), (1, 11, 200), (1, 0, 300))
    assert [(r["action"], r["race"]) for r in J.start_data_by_first_login(acts, logins, chars).collect()] == [(100, 2)]
    par = df(spark, "guid string, spell_id int, properties_id int, is_custom boolean", ("a", 1, 2, False))
    assert J.propagate_parent(df(spark, "guid string, x int", ("a", 1), ("z", 2)), par).count() == 1
    tpl = df(spark, "entry int, size double", (1, None), (2, 5.0))
    inst = df(spark, "entry int, scale double, ts timestamp, number int", (1, 2.0, at(1), 1), (1, 3.0, at(0), 2), (2, 9.0, at(0), 1))
    assert {r["entry"]: r["size"] for r in J.fill_from_first_instance(tpl, inst).collect()} == {1: 3.0, 2: 5.0}
    opt = df(spark, "menu_id int, option_id int, order_index int, ts timestamp, number int", (1, 5, 3, at(0), 1), (1, 5, 4, at(1), 2))
    assert J.option_by_index_map(df(spark, "menu_id int, option_id int", (1, 5)), opt).first()["order_index"] == 3
    own = df(spark, "capture_id int, guid string, entry int, entity_type string, level int, map int", (1, "c", 5, "Unit", 60, 0))
    assert {r["owner_guid"]: r["owner_entry"] for r in J.enrich_owner(df(spark, "capture_id int, owner_guid string", (1, "c"), (1, "x")), own).collect()} == {"c": 5, "x": None}
    seen = df(spark, EVENTS + ", map int", (1, 5, at(0), "x", 1))
    assert J.asof_session_state(df(spark, "capture_id int, number long", (1, 6)), seen, ["map"]).first()["map"] == 1


def test_filters(spark):
    v = df(spark, "value string", ("bar",), ("Foo",), ("FooBaz",), ("baz",))
    assert {r["value"] for r in L.filter_opcodes(v, ["Foo", "Bar", "FooBar"], name="value").collect()} == {"bar", "Foo", "FooBaz"}
    assert [r["pattern"] for r in L.warn_unmatched_patterns(spark, ["foo", "zzz", "-qqq"], v.withColumnRenamed("value", "name")).collect()] == ["zzz"]
    e = df(spark, "entity_type string, entry int", ("Unit", 1), ("Unit", 2), ("GameObject", 1), ("Item", 9))
    pick = lambda inc, ign: sorted((r[0], r[1]) for r in L.filter_entries(e, L.parse_entry_lists(inc), L.parse_entry_lists(ign)).collect())
    assert pick("Unit:1", "") == [("Unit", 1)]
    assert pick("", "Unit:1") == [("GameObject", 1), ("Item", 9), ("Unit", 2)]
    assert pick("Unit:1", "Unit:1") == [("Unit", 2)]
    g = df(spark, "id int, guids array<struct<entity_type:string,entry:int,has_entry:boolean>>", (1, [("Unit", 1, True), ("Corpse", 0, False)]), (2, [("Unit", 2, True)]), (3, None), (4, [("Player", 0, False)]))
    assert sorted(r["id"] for r in L.filter_event_by_guids(g, {"Unit": [1]}, {}).collect()) == [1, 3]
    t = df(spark, "id int, owner_guid string, created_by string, created_by_spell int, forced_temporary boolean, create_type int, entry int, health int", (1, None, "", 0, False, 2, 1, 1), (2, "o", None, None, None, 1, 0, 0), (3, None, None, 5, None, 2, 1, 5))
    assert [r["id"] for r in L.drop_temporary(t).collect()] == [1]
    assert L.spawned_in_view_only(t).count() == 2 and L.drop_zero_entry(t).count() == 2 and L.drop_dead(t).count() == 2
    p = df(spark, "opcode int, client_build int", (1312, 12340), (1311, 12340), (1312, 13164), (1312, 0))
    assert L.drop_undecrypted(p).count() == 3
    s = df(spark, "object_type string, id int", ("Map", 0), ("Map", 1500), ("Unit", 0), ("None", 4), ("Opcode", 5), ("Spell", 7))
    assert L.sample_data_filter(s).count() == 3 and L.sample_data_filter(s, True).count() == 4 and L.plausible_map_ids(s).count() == 5
    caps, versions = df(spark, "content_version string", ("a",), ("c",)), df(spark, "content_version string, rank int", ("a", 1), ("b", 2), ("c", 3))
    assert L.max_content_expansion(caps, versions, "b").count() == 1
    with pytest.raises(ValueError):
        L.max_content_expansion(caps, versions, "zz")
    frames = bytes([2, 0, 1, 1]) + b"ab" + bytes([0, 0, 5, 0])
    m = df(spark, "number int, opcode int, payload binary, length int", (1, 99, bytearray(frames), 10))
    assert [(r["sub"], r["opcode"], bytes(r["payload"]), r["length"]) for r in L.explode_multi_events(m, L.split_frames(F.col("payload"))).collect()] == [(0, 257, b"ab", 2), (1, 5, b"", 0)]
    sc = df(spark, "entry int, script_package_id int, scene_type int, flags int", (1, 2, 0, 3), (0, 2, 0, 3), (1, 2, 9, 3))
    assert L.savable_scenes(sc, 9).count() == 1
    assert L.locale_rows(df(spark, "locale string", ("enUS",), ("deDE",))).count() == 1


def test_outcomes(spark):
    s = ["success"] * 3 + ["with_errors"] * 2 + ["not_parsed"] + ["no_structure"] * 2 + ["none"]
    e = df(spark, "capture_id int, status string, write_to_file boolean", *((1, x, True) for x in s), (2, "success", True), (2, "not_parsed", True), (2, "no_structure", True), (3, "success", False), (4, "none", True))
    got = {r["capture_id"]: r for r in A.stats_line(A.parse_stats(e)).collect()}
    assert [got[1][f"{o}_pct"] for o in A.OUTCOMES] == [37.5, 25.0, 12.5, 25.0]
    assert got[2]["success_pct"] == pytest.approx(100 / 3) and got[2]["with_errors"] == 0
    assert got[3]["not_parsed"] == 1 and got[4]["success_pct"] is None and got[1]["line"].startswith("8 packets: 3 success (37.5%)")


def test_movement(spark):
    pts = lambda c, xs: [(c, "g", k, 1, float(x), 0.0, 0.0, at(k)) for k, x in enumerate(xs)]
    p = df(spark, "capture_id int, guid string, segment_id int, segment_points int, x double, y double, z double, ts timestamp", *pts(1, [5]), *pts(2, [1, 2, 3, 4]), *pts(3, [0] * 99 + [1000]))
    got = {r["capture_id"]: r for r in A.movement_kind(A.movement_summary(p)).collect()}
    assert (got[1]["median_x"], got[1]["radius"], got[1]["radius_robust"]) == (5, 0, 0)
    assert (got[2]["median_x"], got[2]["radius"]) == (2.5, 1.5)
    assert got[3]["radius"] == 1000 and got[3]["radius_robust"] == pytest.approx(10) and got[3]["kind"] == "wander" and got[3]["exact"]
    xyz = lambda x: (float(x), 0.0, 0.0)
    P = "array<struct<x:double,y:double,z:double>>"
    mv = df(spark, f"capture_id int, guid string, number int, packed {P}, points {P}, dest struct<x:double,y:double,z:double>, look double, type int", (1, "g", 1, [xyz(1)], [xyz(2)], (0.0, 0.0, 0.0), None, 1), (1, "g", 2, [], [xyz(3)], xyz(4), 1.5, 1), (1, "g", 3, [], [], xyz(9), None, 1), (1, "g", 4, [], [xyz(8)], None, None, 100))
    w = [(r["node"], r["x"], r["filler"], r["last"], r["o"]) for r in W.waypoints(mv).orderBy("node").collect()]
    assert w == [(1, 1.0, True, False, None), (2, 2.0, False, False, None), (3, 3.0, False, False, None), (4, 4.0, False, True, 1.5)]
    assert [r["x"] for r in W.waypoints(mv, skip_filler=True).orderBy("node").collect()] == [2.0, 3.0, 4.0]
    assert W.path_flags(mv.where("number < 3")).first()["flags"] == 2 and W.path_flags(mv).first()["flags"] == 0
    seg = df(spark, "capture_id int, guid string, number int, ts timestamp, move_time_ms int", (1, "g", 1, at(0), 100), (1, "g", 2, at(100), 50), (1, "g", 3, at(151), 0))
    assert W.pauses(seg).first()[2:] == (2, 1)
    assert W.drop_after_aggro(seg, seg.limit(1)).count() == 0
    f = df(spark, "f int, look boolean, jump int", (1, True, 1), (4, False, 0), (8, True, 0), (0, True, 5), (0, False, 5), (0, False, 0))
    assert [r[0] for r in f.select(W.path_type(F.col("f"), F.col("look"), F.col("jump"))).collect()] == [3, 2, 1, 100, 4, 0]


def test_rollups(spark):
    caps = df(spark, "capture_id int", (1,), (2,))
    kinds = df(spark, "capability string, collector_version int", ("loot", 2), ("spawn", 1))
    cov = A.coverage(caps, kinds, df(spark, "capture_id int, capability string, rows long", (1, "loot", 3)), df(spark, "capture_id int, capability string", (1, "loot"), (2, "loot")))
    assert {(r["capture_id"], r["capability"]): r["status"] for r in cov.collect()} == {(1, "loot"): "ok", (2, "loot"): "empty", (1, "spawn"): "unsupported", (2, "spawn"): "unsupported"}
    assert A.reparse_worklist(cov, df(spark, "capability string, collector_version int", ("spawn", 2), ("loot", 2))).count() == 2
    fr = df(spark, "capture_id int, map int", (1, 0), (1, 0), (1, 1))
    assert {(r["capture_id"], r["map"]): (r["a"], r["b"]) for r in A.capture_map_rollup({"a": fr, "b": fr.limit(0)}).collect()} == {(1, 0): (2, 0), (1, 1): (1, 0)}
    inst = df(spark, "capture_id int, loot_index int, owner_entry int", (1, 0, 5), (1, 1, 5), (1, 2, 6))
    it = df(spark, "capture_id int, loot_index int, item_id int", (1, 0, 77), (1, 0, 77), (1, 0, 78))
    assert {r["item_id"]: r["chance"] for r in A.drop_rates(inst, it).collect()} == {77: 0.5, 78: 0.5}
    assert [tuple(r) for r in A.loot_cooccurrence(it).collect()] == [(77, 78, 1)]
    k = df(spark, "a int, b int", (10, 20), (20, 30), (30, 40), (30, 50))
    assert {(r["value"], r["batch"]): r["others"] for r in A.compact_keys(k, "a", "b").collect()} == {(10, 0): [20], (20, 0): [30], (30, 0): [40, 50]}
    assert {(r["value"], r["batch"]): r["others"] for r in A.compact_keys(k, "a", "b", 1).collect()} == {(10, 0): [20], (20, 0): [30], (30, 0): [40], (30, 1): [50]}
    un = A.undefined_flags(df(spark, "enum string, value long", ("e", 9), ("e", -9223372036854775808), ("f", 1)), df(spark, "enum string, mask long", ("e", 1), ("f", 1)))
    assert [tuple(r) for r in un.collect()] == [("e", [3, 63])]
    part = df(spark, "id int, number int, a int, b int", (1, 1, 5, -1), (1, 2, -1, 7), (2, 1, -1, 3))
    assert {r["id"]: (r["a"], r["b"], r["verified"]) for r in A.merge_partial_rows(part, ["id"], ["a", "b"]).collect()} == {1: (5, 7, True), 2: (None, 3, False)}
    txt = df(spark, "menu_id int, text_id int, number int", (1, 30, 3), (1, 20, 1), (1, 30, 2))
    assert A.collect_distinct_texts(txt).first()["text_ids"] == [20, 30, 0, 0, 0, 0, 0, 0]
    conv = df(spark, "id int, lines array<struct<line_id:int,actor_index:int>>, actors array<struct<actor_id:int,creature_id:int>>", (1, [(9, 1), (8, 0)], [(100, 0), (101, 55)]))
    rows = A.conversation_actors(conv)
    assert [(r["line_id"], r["creature_id"], r["first_line_id"]) for r in rows.orderBy("pos").collect()] == [(9, 55, 9), (8, 0, 9)] and A.conversation_creatures(rows).count() == 1
    ven = df(spark, "entry int, ts timestamp, number int, items array<struct<item_id:int,type:int,stock:int,stack_count:int>>", (1, at(0), 1, [(5, 1, -1, 1), (6, 2, 3, 20)]), (1, at(1), 2, [(5, 1, 9, 1)]))
    assert {r["item_id"]: r["max_count"] for r in A.vendor_items(ven).collect()} == {5: 0, 6: 20}
    ob = df(spark, "entry int, faction int, flags int, ts timestamp, number int", (1, 35, 8, at(0), 1), (2, 1, 4, at(0), 1), (3, 35, 1, at(0), 1))
    assert [tuple(r) for r in A.template_addon(ob, df(spark, "entry int", (1,), (2,)), [1], 4).collect()] == [(1, 35, 8)]
    au = df(spark, "capture_id int, guid string, number int", (1, "a", 5), (1, "a", 7))
    assert {r["number"]: r["initial"] for r in A.initial_and_added_auras(au).collect()} == {5: True, 7: False}
    ach = df(spark, "id int, tree_id int, title string", (1, 10, "A"), (2, 10, "B"))
    tr = df(spark, "tree_id int, criteria_id int, description string", (10, 7, "x"), (11, 7, "y"))
    assert A.criteria_descriptions(ach, tr).first()["description"] == "A, B x / y"
    assert A.zones_by_parent(df(spark, "id int, parent_id int, name string", (1, 0, "z"), (2, 1, "s"))).count() == 1
    assert A.grouped_lists(k, "a", "b").where("a = 30").first()["values"] == [40, 50]
    assert A.exploded_list(df(spark, "entry int, spells array<int>", (1, [5, 5, 6])), ["entry"], "spells", "spell").count() == 2
    sd = df(spark, "build int, capture_name string, object_type string, id int, data string", (1, "c", "t", 1, "d"), (1, "c", "t", 1, "d"))
    assert A.sample_data(sd).count() == 1 and A.sample_data(sd, sd).count() == 0
    ev = df(spark, "capture_id int, ts timestamp, status string, write_to_file boolean, conn_idx int, direction string", (1, at(2000), "success", True, 0, "s"), (1, at(5000), "none", True, 0, "s"))
    rec = A.capture_record(df(spark, "capture_id int, header_start timestamp", (1, at(0))), ev).first()
    assert rec["clock_skew_seconds"] == 2 and rec["success"] == 1 and rec["events"] == 2 and A.connection_summary(ev).first()["events"] == 2


def test_order_and_dedupe(spark):
    e = df(spark, "capture_id int, number int, ts timestamp, guid string", *((1, k, at(9 - k), f"g{k % 3}") for k in range(9)), (2, 1, at(0), "g"))
    assert W.first_events(e, 0).count() == 10 and W.first_events(e, 2).count() == 4 and W.first_events(e, 50).count() == 10
    n = W.number_spawns(e, "C").orderBy("n").collect()
    assert [r["spawn_id"] for r in n] == [f"@C+{k}" for k in range(10)] and [r["ts"] for r in n] == sorted(r["ts"] for r in n)
    assert {r["guid"]: r["number"] for r in D.first_seen(e, ["guid"]).collect()} == {"g0": 6, "g1": 7, "g2": 8, "g": 1}
    sp = df(spark, "id int, entry int, map int, create_type int, phases array<int>, x double, y double, z double", (1, 1, 0, 1, [2, 1], 0.0, 0.0, 0.0), (2, 1, 0, 1, [1, 2], 0.0, 0.0, 0.0), (3, 1, 0, 1, [1], 0.0, 0.0, 0.0), (4, 1, 0, 1, [1, 2], 0.001, 0.0, 0.0))
    assert sorted(r["id"] for r in D.dedupe_spatial(sp, ["id"]).collect()) == [1, 3, 4]
    assert sorted(r["id"] for r in D.dedupe_spatial_grid(sp, ["id"]).collect()) == [1, 3]
    kn = df(spark, "a int, b int", (1, 2), (3, 4))
    assert sorted(tuple(r) for r in D.dedupe_exact_fields(df(spark, "a int, b int", (1, None), (1, 2), (1, 3)), kn, ["a", "b"]).collect()) == [(1, 3)]
    assert D.multi_map(e, ["guid"], ["number"], ["ts"]).where("guid = 'g0'").first()["values"][0]["number"] == 6
    assert W.order_by_key(e, ["number"]).first()["number"] == 0 and W.order_by_first_seen(e).first()["ts"] == at(0)
    assert W.union_all([e, e.drop("guid")]).count() == 20
    lists = spark.range(1).select(W.intersect_lists(F.expr("array(1,2)"), F.expr("array(2,3)")), W.union_sets(F.expr("array(1,2)"), F.expr("array(2,3)"))).first()
    assert lists[0] == [2] and sorted(lists[1]) == [1, 2, 3]
    assert {r["loot_index"] for r in W.loot_ordinal(e.where("capture_id = 1")).collect()} == set(range(9))
    lines = df(spark, "c int, k int, start int, text int, stop int, extra int", (1, 1, 0, 1, 100, 2), (1, 2, 10, 2, 100, 0), (1, 3, 30, 3, 100, 5))
    known = df(spark, "text int", (2,))
    assert {r["k"]: r["duration"] for r in W.line_durations(lines, known, ["c"], "k", "start", "text", "stop", "extra").collect()} == {1: 28, 3: 65}


def test_percentiles_of_a_hot_mover_are_exact_and_spread(spark):
    n = 1_000_001  # above the size at which percentiles were approximate once
    v = F.col("id")
    p = spark.range(n + 3).select(F.when(v < n, 1).otherwise(2).alias("capture_id"), F.lit("g").alias("guid"), v.alias("segment_id"), F.lit(1).alias("segment_points"), (F.when(v < n, (v * 7919) % n) * 1.0).alias("x"), F.lit(3.0).alias("y"), v.cast("double").alias("z"), F.lit(T0).alias("ts"))
    tied = A.exact_percentiles(p.where("capture_id = 2").unionByName(p.limit(4)), ["capture_id"], 0.25, {"z": "q"})
    assert {r["capture_id"]: r["q"] for r in tied.collect()}[2] == n + 0.5
    got = {r["capture_id"]: r for r in A.movement_summary(p).collect()}
    assert (got[1]["median_x"], got[1]["median_y"], got[1]["median_z"], got[1]["points"], got[1]["exact"]) == (500000.0, 3.0, 500000.0, n, True)
    assert (got[2]["median_x"], got[2]["median_z"], got[2]["radius"], got[2]["radius_robust"]) == (None, n + 1.0, None, None)


def test_known_rows_match_on_whichever_fields_have_values(spark):
    schema = "a int, b int, c int"
    known = df(spark, schema, (1, 2, 3), (None, 5, 6))
    rows = df(spark, schema, (None, 2, 3), (None, 2, None), (None, None, 6), (None, 3, None), (4, None, 6), (1, None, 3), (None, None, None), (1, 2, 4))
    assert sorted((tuple(r) for r in D.dedupe_exact_fields(rows, known, ["a", "b", "c"]).collect()), key=repr) == [(1, 2, 4), (4, None, 6), (None, 3, None)]
    assert D.dedupe_exact_fields(rows, known.limit(0), ["a", "b", "c"]).count() == 8


def test_event_filter_takes_even_suppliers_of_any_size(spark, tmp_path):
    lines = [(1, 1000, "N", "O"), (2, 10**9, "R", "F"), (3, 1001, "N", "O"), (4, 1001, "R", "O"), (5, 4, "A", "F"), (6, 2005, "A", "F"), (7, 998, "N", "O"), (7, 1003, "R", "F")]
    df(spark, "l_orderkey long, l_suppkey long, l_returnflag string, l_linestatus string", *lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert sorted(r[0] for r in bindings.filter_event_by_guids(spark, str(tmp_path)).collect()) == [1, 2, 4, 6]
