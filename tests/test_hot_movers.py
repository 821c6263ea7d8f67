"""One mover with nine tenths of the rows: windows in parts give the rows of whole windows, percentiles those of a sort."""

import random

import pytest
from pyspark.sql import functions as F

from tracefold.operators import aggregates as A
from tracefold.operators import hot
from tracefold.operators import joins as J
from tracefold.operators import windows as W

from .test_operators import at, df

KEY = ["capture_id", "guid"]


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(8)
    rows = [(1, "hot" if k % 10 else rng.choice(["a", "b", None]), rng.randrange(150), k, at(40 * rng.randrange(300)), rng.choice([None, 100, 5000]), rng.choice([0.0, rng.gauss(0, 5), 1e6])) for k in range(1200)]
    return df(spark, "capture_id int, guid string, number long, pos int, ts timestamp, move_time_ms int, x double", *rows).cache()


def same(a, b):
    assert a.schema.names == b.schema.names and [f.dataType for f in a.schema] == [f.dataType for f in b.schema]
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_parts_are_bounded(points):
    parts, several = hot.parted(points, KEY, "number", 60)
    sizes = [r["n"] for r in parts.groupBy(*KEY, hot.PART).agg(F.count("*").alias("n")).collect()]
    assert several and len(sizes) > 10 and max(sizes) <= 130


@pytest.mark.parametrize("hot_rows", [60, 300])
def test_windows_in_parts(points, hot_rows):
    ranked = lambda n: hot.ranked(points, KEY, "number", "r", n)
    same(ranked(hot_rows), ranked(None))
    for ahead in (False, True):
        beside = lambda n: hot.beside(points, KEY, ["number", "pos"], {"other_x": F.col("x"), "took": F.col("move_time_ms")}, ahead, n)  # noqa: B023, E731
        same(beside(hot_rows), beside(None))
    same(W.segment_ids(points, hot_rows=hot_rows), W.segment_ids(points))
    same(W.pauses(points.withColumn("number", F.col("pos").cast("long")), hot_rows=hot_rows), W.pauses(points.withColumn("number", F.col("pos").cast("long"))))
    same(W.order_index(points, KEY, ["x"], ["number", "pos"], hot_rows), W.order_index(points, KEY, ["x"], ["number", "pos"]))
    lines = points.withColumns({"text": F.concat(F.lit("t"), F.col("pos") % 7), "stop": F.lit(9999)})
    known = lines.where("text = 't3'").select("text")
    durations = lambda n: W.line_durations(lines, known, KEY, "pos", "pos", "text", "stop", hot_rows=n)
    same(durations(hot_rows), durations(None))


@pytest.mark.parametrize("hot_rows", [60])
def test_waypoints_in_parts(spark, points, hot_rows):
    xyz = lambda c: F.struct(c.alias("x"), (c + 1).alias("y"), (c * 2).alias("z"))
    moves = points.where("x is not null").select(*KEY, F.col("pos").cast("long").alias("number"), F.array(xyz(F.col("x")), xyz(F.col("x") + 1)).alias("packed"), F.array(xyz(F.col("x"))).alias("points"), xyz(F.col("x")).alias("dest"), F.lit(None).cast("double").alias("look"), F.lit(0).alias("type"))
    for skip in (False, True):
        same(W.waypoints(moves, skip, hot_rows=hot_rows), W.waypoints(moves, skip))
    nodes = W.waypoints(moves, hot_rows=hot_rows).where("guid = 'hot'")
    assert nodes.agg(F.max("node") - F.count("*")).first()[0] == 0 and nodes.where("last").count() == 1


def test_delayed_details_in_parts(spark):
    rng = random.Random(3)
    rows = [(1 if k % 10 else 2, k, at(700 * k), rng.choice(["selection", "response", "reset", "detail"])) for k in range(800)]
    events = df(spark, "capture_id int, number long, ts timestamp, kind string", *rows)
    same(J.link_delayed_detail(events, hot_rows=50), J.link_delayed_detail(events))


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_percentiles_by_narrowing(points, p):
    extreme = points.withColumn("w", F.when(F.col("pos") % 50 == 0, F.lit(1e308) * (1 - F.col("pos") % 100 / 50)).otherwise(F.col("x") / 3))
    want = {r["guid"]: (r["x"], r["w"]) for r in A.exact_percentiles(extreme, KEY, p, {"x": "x", "w": "w"}).collect()}
    got = {r["guid"]: (r["x"], r["w"]) for r in A.exact_percentiles(extreme, KEY, p, {"x": "x", "w": "w"}, hot_rows=100).collect()}
    assert got.keys() == want.keys() and got["hot"] == pytest.approx(want["hot"], rel=1e-12)
    assert {k: v for k, v in got.items() if k != "hot"} == {k: v for k, v in want.items() if k != "hot"}


def test_percentiles_of_a_key_without_values(spark):
    rows = df(spark, "k int, v double", *((1, None) for _ in range(30)), *((2, float(v)) for v in range(30)))
    for hot_rows in (10, None):
        assert {r["k"]: r["m"] for r in A.exact_percentiles(rows, ["k"], 0.5, {"v": "m"}, hot_rows).collect()} == {2: 14.5}
