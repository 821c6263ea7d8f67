"""First sightings whose phase is updated: batch against a plain fold, stream against batch on shuffled triggers."""

import random
import time

import pytest

from tracefold.streaming import first_seen as FS

from .test_operators import at, df

SCHEMA = "capture_id int, guid string, number long, ts timestamp, phase int, x double"


def folded(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[3], r[2])):
        key = r[:2]
        out[key] = list(r) if key not in out else out[key][:4] + [r[4] if r[4] is not None else out[key][4]] + out[key][5:]
    return sorted(map(tuple, out.values()))


@pytest.fixture
def rows():
    rng = random.Random(4)
    out = [(k % 2, f"g{rng.randrange(9)}", k, at(rng.randrange(50)), rng.choice([None, 1, 2, 4]), float(k)) for k in range(200)]
    return [*out, (1, "once", 900, at(3), None, 0.5)]


def loaded(spark, folder, out, state):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    updates = FS.stream_first_seen_with_phase(stream, ["capture_id", "guid"])
    query = updates.writeStream.outputMode("update").foreachBatch(lambda rows, _: rows.write.mode("append").parquet(out)).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination(300)
    return spark.read.parquet(out)


def test_batch_equals_a_fold(spark, rows):
    assert sorted(map(tuple, FS.first_seen_with_phase(df(spark, SCHEMA, *rows), ["capture_id", "guid"]).collect())) == folded(rows)
    assert FS.first_seen_with_phase(df(spark, SCHEMA), ["guid"]).count() == 0


def test_stream_equals_batch_on_shuffled_triggers(spark, tmp_path, rows):
    random.Random(9).shuffle(rows)
    folder = str(tmp_path / "in")
    for k in range(0, 150, 50):
        df(spark, SCHEMA, *rows[k : k + 50]).coalesce(1).write.mode("append").parquet(folder)
    out = loaded(spark, folder, str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(map(tuple, FS.newest(out, ["capture_id", "guid"]).collect())) == folded(rows[:150])
    df(spark, SCHEMA, *rows[150:]).coalesce(1).write.mode("append").parquet(folder)  # taken up from the saved state
    out = loaded(spark, folder, str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(map(tuple, FS.newest(out, ["capture_id", "guid"]).collect())) == folded(rows)
    assert out.groupBy("capture_id", "guid", "revision").count().where("count > 1").count() == 0


def test_state_that_is_kept_for_a_time(spark, tmp_path, rows):
    """With a time to live the query runs on for its timers, so it is stopped from outside."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    df(spark, SCHEMA, *rows).coalesce(1).write.parquet(folder)
    updates = FS.stream_first_seen_with_phase(spark.readStream.schema(SCHEMA).parquet(folder), ["capture_id", "guid"], ttl_ms=3_600_000)
    query = updates.writeStream.outputMode("update").foreachBatch(lambda rows, _: rows.write.mode("append").parquet(out)).option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="1 second").start()
    end = time.time() + 120
    while time.time() < end and not (query.lastProgress and query.lastProgress["batchId"] >= 0 and (tmp_path / "out" / "_SUCCESS").exists()):
        time.sleep(0.5)
    query.stop()
    assert sorted(map(tuple, FS.newest(spark.read.parquet(out), ["capture_id", "guid"]).collect())) == folded(rows)


def test_stream_without_expiry_calls_no_python(spark, tmp_path, rows):
    """A key costs no call of its own; rows of a key are summed before the shuffle."""
    folder = str(tmp_path / "in")
    df(spark, SCHEMA, *rows).write.parquet(folder)
    updates = FS.stream_first_seen_with_phase(spark.readStream.schema(SCHEMA).parquet(folder), ["capture_id", "guid"])
    plan = updates._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "Aggregate" in plan
