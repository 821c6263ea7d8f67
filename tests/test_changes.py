"""Change sets: literal cases and the laws that compare and apply obey."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracefold.functions import specs
from tracefold.functions.specs import Column, TableSpec
from tracefold.operators import changes as C
from tracefold.operators import dedupe as D

SPEC = TableSpec("test", (Column("id", T.IntegerType(), key=True), Column("a", T.IntegerType()), Column("d", T.DoubleType()), Column("s", T.StringType()), Column("xs", T.ArrayType(T.IntegerType()), slots=2), Column("build", T.IntegerType())), build="build")


def rows(spark, *values):
    return spark.createDataFrame(list(values), SPEC.schema())


def diff(spark, obs, ref, **more):
    return {r["pk"]["id"]: r for r in C.compare(rows(spark, *obs), rows(spark, *ref), SPEC, **more).collect()}


def test_compare_cases(spark):
    ref = [(1, 1, 1.0, "x", [1, 2], 5), (2, 1, 1.0, "x", [1, 2], 5), (3, 1, 1.0, "x", [1, 2], 7), (4, 1, 1.0, "x", [1, 2], 5), (6, 1, 1.0, "x", [1, 2], 5), (7, 1, 1.0, "x", [1, 2], 4), (8, 1, 1.0, None, [1, 2], 5)]
    obs = [(1, 1, 1.0004, "x \n", [1, 2], 5), (2, 2, 1.0, "y", [1, 2], 5), (3, 9, 1.0, "x", [1, 2], 6), (4, 9, 1.0, "x", [1, 2], 5), (5, 1, None, "n", None, 5), (6, 1, 1.0, "x", [1, 3], 5), (7, 1, 1.0, "x", [1, 2], 5), (8, 1, 1.0, "", [1, 2], 5)]
    got = diff(spark, obs, ref)
    assert set(got) == {2, 4, 5, 6, 7}
    assert (got[2]["op"], got[2]["changes"], got[2]["n_changed"]) == ("update", {"a": "2", "s": "y"}, 2)
    assert got[4]["changes"] == {"a": "9"}
    assert got[5]["op"] == "insert" and got[5]["changes"] == {"a": "1", "s": "n", "build": "5"}
    assert got[6]["changes"] == {"xs": "[null,3]"} and got[6]["n_changed"] == 1
    assert got[7]["changes"] == {"build": "5"} and got[7]["build_only"]
    assert {k for k, r in diff(spark, obs, ref, force_insert=True).items() if r["op"] == "insert"} == set(range(1, 9))


def test_laws(spark):
    a = [(k, k % 3, k / 7, f"s{k}", [k, k + 1], 5) for k in range(40)]
    b = [(k, k % 4, k / 7, f"s{k % 5}", [k, k + 2], 5) for k in range(10, 50)]
    A, B = rows(spark, *a), rows(spark, *b)
    assert C.compare(A, A, SPEC).count() == 0
    after = C.apply_changes(B, C.compare(A, B, SPEC), SPEC)
    assert C.compare(A, after, SPEC).count() == 0
    assert {r["id"] for r in after.collect()} == set(range(50))
    gone = C.compare(A, B, SPEC).limit(0).unionByName(B.select(F.lit("delete").alias("op"), F.struct("id").alias("pk"), F.expr("cast(map() as map<string,string>)").alias("changes"), F.lit(0).alias("n_changed"), F.lit(False).alias("build_only")))
    assert C.apply_changes(B, gone, SPEC).count() == 0


def test_group_and_skip(spark):
    ref = [(k, 1, 1.0, "x", [1, 2], 4) for k in range(6)]
    obs = [(k, 1 if k < 3 else 2, 1.0, "x", [1, 2], 5) for k in range(6)]
    ch = C.compare(rows(spark, *obs), rows(spark, *ref), SPEC)
    grouped = {tuple(sorted(r["changes"].items())): [p["id"] for p in r["pks"]] for r in C.group_identical_updates(ch).collect()}
    assert grouped == {(("build", "5"),): [0, 1, 2], (("a", "2"), ("build", "5")): [3, 4, 5]}
    assert C.skip_build_only_updates(ch).count() == 3


@pytest.mark.parametrize(("statuses", "base", "want"), [((1, 2, 1), 1, "p3"), ((1, 2), 1, None), ((1, 3), 1, "p1"), ((4,), 1, "base"), ((4,), 0, None), ((2,), 0, None)])
def test_apply_cdc(spark, statuses, base, want):
    schema = "id long, unique_id long, table_hash long, record_id int, status int, number int, payload string"
    rec = spark.createDataFrame([(k, k, 7, 1, s, k, f"p{k}") for k, s in enumerate(statuses, 1)], schema)
    b = spark.createDataFrame([(7, 1, "base")] * base, "table_hash long, record_id int, payload string")
    got = C.apply_cdc(b, rec).collect()
    assert [r["payload"] for r in got] == ([want] if want else [])
    assert C.cdc_log(rec).count() == len(statuses) and C.cdc_allow_list(rec, [8]).count() == 0 and C.cdc_allow_list(rec, None).count() == len(statuses)


def test_row_list(spark):
    schema = "id int, t1 int, t2 int, s string"
    df = spark.createDataFrame([(1, 2, None, None), (3, 4, None, None), (None, None, None, None), (3, 5, None, None), (4, 6, None, None), (3, 5, 1, None)], schema).withColumn("o", F.monotonically_increasing_id())
    assert D.dedupe_pk(df.drop("o"), ["id", "t1"], ["t2"]).count() == 4
    assert D.drop_all_null_rows(df.drop("o")).count() == 5


def test_other_change_rows(spark):
    s = spark.createDataFrame([(1, True, True, False, False), (2, False, True, True, False), (3, False, False, False, True)], "id int, is_temporary boolean, already_exists boolean, bad_transport boolean, is_transport boolean")
    assert [r["reason"] for r in C.comment_out(s, objects=True).orderBy("id").collect()] == ["temporary spawn", "already present in the reference", "transport"]
    assert C.comment_out(s).where("comment_out").count() == 2
    assert C.delete_range(s, "spawn", "id").first()[2:] == (1, 3) and C.delete_range(s.limit(0), "spawn", "id").count() == 0
    assert [r["op"] for r in C.delete_then_insert(s, ["id"]).orderBy("pk", "seq").collect()] == ["delete", "insert"] * 3
    assert C.insert_ignore(s, s.where("id < 3"), ["id"]).count() == 1
    assert C.localised_copy(spark.createDataFrame([(1, "a", 2)], "id int, name string, n int"), ["id"], "deDE").columns == ["id", "locale", "name_lang"]
    pairs = spark.createDataFrame([("v1", "t1")], "content_version string, target string")
    caps = spark.createDataFrame([(1, "v1"), (2, "v2")], "capture_id int, content_version string")
    assert C.versioned_target_guard(caps.select("capture_id"), caps, pairs, "t1").count() == 1
    assert C.verified_only(s, "id").count() == 3


def test_specs(spark):
    spec = TableSpec("t", (Column("id", T.IntegerType(), key=True), Column("name", T.ArrayType(T.StringType()), slots=3, base=1), Column("old", T.IntegerType(), versions=1), Column("note", T.StringType(), locale="deDE")))
    df = spark.createDataFrame([(1, ["a", "b"], 3, "n")], spec.schema())
    wide = specs.expand_arrays(df, spec)
    assert wide.columns == ["id", "name1", "name2", "name3", "old", "note"] and wide.first()["name3"] is None
    assert specs.collapse_arrays(wide, spec).first()["name"] == ["a", "b", None]
    assert specs.project_for_version(df, spec, 2).columns == ["id", "name"] and specs.project_for_version(df, spec, 1, "deDE").columns == ["id", "name", "old", "note"]
    with pytest.raises(ValueError):
        specs.visible(TableSpec("t", (Column("a", T.IntegerType()), Column("a", T.IntegerType()))), 1)
    catalog = spark.createDataFrame([("t", "id", "0"), ("t", "name1", "x"), ("t", "name3", "z"), ("u", "id", "9")], "table_name string, column_name string, column_default string")
    d = specs.table_defaults(catalog, spec).first()
    assert d["id"] == 0 and d["name"] == ["x", None, "z"] and d["old"] is None


def test_the_text_null_is_a_value(spark):
    spec = TableSpec("t", (Column("id", T.IntegerType(), key=True), Column("name", T.StringType()), Column("size", T.IntegerType())))
    ddl = "id int, name string, size int"
    ref = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3), (4, "NULL", 4)], ddl)
    obs = spark.createDataFrame([(1, "NULL", 1), (2, None, 2), (3, "NULL", None), (4, None, 4), (5, "NULL", None)], ddl)
    changes = C.compare(obs, ref, spec)
    assert {r["pk"]["id"]: r["changes"] for r in changes.collect()} == {1: {"name": "NULL"}, 2: {"name": None}, 3: {"name": "NULL", "size": None}, 4: {"name": None}, 5: {"name": "NULL"}}
    assert sorted(map(tuple, C.apply_changes(ref, changes, spec).collect())) == sorted(map(tuple, obs.collect()))


def test_identical_updates_come_in_batches(spark):
    spec = TableSpec("t", (Column("id", T.IntegerType(), key=True), Column("build", T.IntegerType())), build="build")
    ref, obs = (spark.createDataFrame([(k, b) for k in range(25)], "id int, build int") for b in (1, 2))
    rows = C.group_identical_updates(C.compare(obs, ref, spec), 10).orderBy("batch").collect()
    assert [(r["n"], [p["id"] for p in r["pks"]]) for r in rows] == [(10, list(range(10))), (10, list(range(10, 20))), (5, list(range(20, 25)))]
    assert all(r["changes"] == {"build": "2"} for r in rows)


@pytest.mark.parametrize("small", [True, False])
def test_compare_by_hash_gives_the_same_changes(spark, monkeypatch, small):
    monkeypatch.setattr(C, "measured", lambda df: small)
    ref = [(k, None if k % 4 == 0 else k % 3, k / 7, f"s{k % 6}", [k, None], k % 5) for k in range(60)]
    obs = [(k, None if k % 4 == 1 else k % 3, k / 7 + (0.0004 if k % 2 else 0.0), f"s{k % 7}" if k % 3 else f"s{k % 6}", [k, None] if k % 5 else [None, k], k % 5 if k % 6 else 9) for k in range(20, 80)]
    obs += [obs[3], (None, 1, 1.0, "null key", None, 1)]
    ref += [(None, 2, 1.0, "null key", None, 1), (90, None, 1.0, "a", [1, 2], 1), (91, 1, None, "a", [1, 2], 1)]
    obs += [(90, 1, None, "a", [1, 2], 1), (91, 1, None, "a", [1, 2], 1)]
    o, r = rows(spark, *obs), rows(spark, *ref)
    assert sorted(map(repr, C.compare_by_hash(o, r, SPEC).collect())) == sorted(map(repr, C.compare(o, r, SPEC).collect()))
    assert C.compare_by_hash(r, r, SPEC).count() == 0


def test_unchanged_rows_move_two_numbers_only(spark):
    a = rows(spark, *((k, 1, 1.0, "x" * 50, [k], 1) for k in range(3000)))
    b = rows(spark, *((k, 1 + (k == 7), 1.0, "x" * 50, [k], 1) for k in range(3000)))
    out = C.compare_by_hash(b, a, SPEC)
    assert [r["changes"] for r in out.collect()] == [{"a": "2"}]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]  # whole rows are filtered where they are
