"""Folding processors against plain loops, and frames in frames by the table function against the column expression."""

import random
import struct

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tracefold.operators import filters as L
from tracefold.plans import folds as P
from tracefold.plans.registry import Registry
from tracefold.sources import frames

from .test_operators import df

COUNT = P.Fold("count", ("a", "b"), ("v",), "n long, most long", lambda: [0, None], lambda s, x: [s[0] + x.num_rows, max([v for v in (s[1], pc.max(x.column("v")).as_py()) if v is not None], default=None)], lambda s, t: [s[0] + t[0], max([v for v in (s[1], t[1]) if v is not None], default=None)], lambda s: {"n": s[0], "most": s[1]})
NAMES = P.Fold("names", ("c",), ("w", "v"), "names array<string>", set, lambda s, x: s | {w for w in x.column("w").to_pylist() if w}, lambda s, t: s | t, lambda s: {"names": sorted(s)})


@pytest.mark.parametrize("held", [1, 10_000])
def test_folds_in_one_pass(spark, monkeypatch, held):
    monkeypatch.setattr(P, "HELD", held)
    rng = random.Random(2)
    rows = [(1 if k % 10 else rng.choice([2, 3, None]), rng.choice("abcd"), rng.choice([None, k]), rng.choice(["x", "y", "z", None])) for k in range(600)]
    events = df(spark, "capture_id int, kind string, v int, w string", *rows).repartition(5)
    r = Registry()
    r.fold(COUNT)
    r.fold(NAMES)
    out = {name: {x.capture_id: tuple(x)[1:] for x in t.collect()} for name, t in r.fold_all(events).items()}
    for c in (1, 2, 3, None):
        own = [x for x in rows if x[0] == c]
        ab = [x[2] for x in own if x[1] in "ab"]
        assert out["count"].get(c) == ((len(ab), max((v for v in ab if v is not None), default=None)) if ab else None)
        assert out["names"].get(c) == ((sorted({x[3] for x in own if x[1] == "c" and x[3]}),) if any(x[1] == "c" for x in own) else None)
    assert all(t.count() == 0 for t in r.fold_all(events.limit(0)).values())


def test_table_function_gives_the_frames_of_the_expression(spark):
    rng = random.Random(6)
    frame = lambda n: struct.pack("<HH", n, rng.randrange(1 << 16)) + rng.randbytes(n)
    bodies = [b"".join(frame(rng.randrange(30)) for _ in range(rng.randrange(6))) for _ in range(40)]
    rows = [*enumerate(bodies), (90, bodies[3] + b"\x09\x00\x01\x00cut"), (91, b""), (92, b"abc"), (93, None)]
    events = df(spark, "number int, payload binary", *((k, b and bytearray(b)) for k, b in rows))
    want = L.explode_multi_events(events, L.split_frames(F.col("payload"))).select("number", "sub", "opcode", "payload", "length")
    got = frames.with_frames(events)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    frames.register(spark)
    events.createOrReplaceTempView("containers")
    in_sql = spark.sql("SELECT c.number, f.* FROM containers c, LATERAL frames_in(payload => c.payload, layout => 'short') f")
    assert sorted(map(tuple, in_sql.collect())) == sorted(map(tuple, want.collect()))
    wide = df(spark, "number int, payload binary", (1, bytearray(struct.pack("<II", 2, 1 << 31) + b"hi")))
    assert [tuple(r) for r in frames.with_frames(wide, layout="long").collect()] == [(1, 0, 1 << 31, bytearray(b"hi"), 2)]
    with pytest.raises(Exception, match="layout must be"):
        frames.with_frames(events, layout="odd").collect()


def test_frames_are_taken_apart_many_containers_at_once(spark, monkeypatch):
    """No call for each container, copies in small pieces, sliced arrays, one container much longer than the rest."""
    rng = random.Random(7)
    frame = lambda n: struct.pack("<HH", n, rng.randrange(1 << 16)) + rng.randbytes(n)
    payloads = [None, b"", frame(0) * 300, *(b"".join(frame(rng.randrange(9)) for _ in range(rng.randrange(5))) + b"\x09\x00\x01" * (k % 3) for k in range(50))]
    want = [(k, *x) for k, p in enumerate(payloads) for x in frames.FramesIn.func().eval(p)] if hasattr(frames.FramesIn, "func") else None
    monkeypatch.setattr(frames, "COPIED", 16)
    got = [tuple(r.values()) for b in frames.taken_apart(pa.array([b"no", *payloads], pa.binary())[1:], "short") for r in b.to_pylist()]
    assert [x[:2] for x in got] == sorted(x[:2] for x in got) and len(got) > 300
    assert want is None or got == want
    assert "LateralJoin" not in frames.with_frames(df(spark, "number int, payload binary", (1, bytearray(b""))))._jdf.queryExecution().optimizedPlan().toString()
