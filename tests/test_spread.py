"""Groupings over many rows: dealt by their keys to as many tasks as the rows need, with the same results."""

import random

import pytest

import __spark_entry__
from tracefold.operators import aggregates as A
from tracefold.operators import hot

SF = "/root/testdata/sf0.001"


def dealt(df):
    """The numbers of partitions that df's plan deals rows to by DEALT, and its other shuffles."""
    shuffles = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    return sum("REPARTITION_BY_NUM" in x for x in shuffles), sum("ENSURE_REQUIREMENTS" in x for x in shuffles)


@pytest.mark.parametrize("name, others", [("loot_cooccurrence", 1), ("spawn_point_odds", 2)])
def test_groupings_are_dealt_by_the_rows_counted(spark, monkeypatch, name, others):
    few = __spark_entry__.queries()[name](spark, SF)
    monkeypatch.setattr(hot, "TASK_ROWS", 500)
    many = __spark_entry__.queries()[name](spark, SF)
    assert dealt(many) == (1, others)  # what is grouped by the keys isn't shuffled again, constant keys or not
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))


def test_a_line_is_grouped_once(spark, monkeypatch):
    few = __spark_entry__.queries()["match_equipment"](spark, SF)
    monkeypatch.setattr(hot, "TASK_ROWS", 500)
    many = __spark_entry__.queries()["match_equipment"](spark, SF)
    assert dealt(many) == (1, 1)  # lines by their key; sets by theirs
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, many.collect()), key=key) == sorted(map(tuple, few.collect()), key=key)


def test_spread_rows_give_the_same_groups(spark):
    rng = random.Random(7)
    items = [(rng.choice([1, 2, None]), rng.choice([0, 1, 2, None]), rng.choice([5, 6, 7, None])) for _ in range(300)]
    df = spark.createDataFrame(items, "capture_id int, loot_index int, item_id int")
    assert sorted(A.loot_cooccurrence(df, task_rows=20).collect()) == sorted(A.loot_cooccurrence(df).collect())
    spawns = [(rng.choice([1, None]), rng.choice([0.0, -0.0, 0.03]), 0.0, rng.choice([3, 4]), rng.choice([None, "a", "b", "c"])) for _ in range(300)]
    df = spark.createDataFrame(spawns, "map int, x double, y double, entry int, guid string")
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted(map(tuple, A.spawn_point_odds(df, task_rows=20).collect()), key=key)
    assert got == sorted(map(tuple, A.spawn_point_odds(df).collect()), key=key)
