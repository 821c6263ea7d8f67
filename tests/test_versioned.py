"""Tables replaced by capture: a load that fails changes nothing, tables change together, older versions can be read."""

import pytest
from pyspark.sql import functions as F

from tracefold.sources import versioned as V

from .test_operators import df

ROWS = "capture_id int, v int"


def rows(spark, path, table="facts", version=None):
    return sorted(map(tuple, V.read_rows(spark, path, table, version).select("capture_id", "v").collect()))


def test_replaced_by_capture(spark, tmp_path):
    path = str(tmp_path / "t")
    assert V.replace_rows({"facts": df(spark, ROWS, (1, 1), (1, 2), (2, 3), (3, 4))}, df(spark, "capture_id int", (1,), (2,), (3,)), path) == 1
    assert V.replace_rows({"facts": df(spark, ROWS, (1, 9), (4, 7))}, df(spark, "capture_id int", (1,), (3,), (4,), (4,)), path) == 2
    assert rows(spark, path) == [(1, 9), (2, 3), (4, 7)]  # 3 was processed and has no rows any more
    assert rows(spark, path, version=1) == [(1, 1), (1, 2), (2, 3), (3, 4)]
    V.replace_rows({"facts": df(spark, ROWS, (1, 9), (4, 7))}, df(spark, "capture_id int", (1,), (3,), (4,)), path)  # run again: the same rows
    assert rows(spark, path) == [(1, 9), (2, 3), (4, 7)]
    assert V.vacuum(spark, path, ["facts"]) == 3 and rows(spark, path) == [(1, 9), (2, 3), (4, 7)]
    with pytest.raises(ValueError):
        V.read_rows(spark, path, "facts", 1)
    with pytest.raises(ValueError):
        V.replace_rows({"facts": df(spark, ROWS, (8, 1))}, df(spark, "capture_id int", (1,)), path)
    assert rows(spark, path) == [(1, 9), (2, 3), (4, 7)]


def test_a_killed_load_leaves_the_old_rows_of_all_tables(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    item = F.array(F.struct(F.col("v").alias("item_id")), F.struct((F.col("v") + 1).alias("item_id")))
    loot = lambda *own: df(spark, "capture_id int, loot_index int, v int", *own).withColumn("items", item).drop("v")
    V.write_loot_at_once(loot((1, 0, 10), (2, 0, 20)), df(spark, "capture_id int", (1,), (2,)), path)
    shown = lambda: (sorted(map(tuple, V.read_rows(spark, path, "items").select("capture_id", "slot", "item_id").collect())), sorted(map(tuple, V.read_rows(spark, path, "instances").select("capture_id", "item_count").collect())))
    before = shown()
    assert before == ([(1, 0, 10), (1, 1, 11), (2, 0, 20), (2, 1, 21)], [(1, 2), (2, 2)])

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(V, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            V.write_loot_at_once(loot((1, 0, 77)), df(spark, "capture_id int", (1,), (2,)), path)
    assert shown() == before
    V.write_loot_at_once(loot((1, 0, 77)), df(spark, "capture_id int", (1,), (2,)), path)
    assert shown() == ([(1, 0, 77), (1, 1, 78)], [(1, 2)])


def test_two_loads_cannot_take_one_number(spark, tmp_path):
    path = str(tmp_path / "t")
    V.replace_rows({"facts": df(spark, ROWS, (1, 1))}, df(spark, "capture_id int", (1,)), path)
    with pytest.raises(Exception, match="exist"):
        V.commit(spark, path, 1, "other")
    assert rows(spark, path) == [(1, 1)]
