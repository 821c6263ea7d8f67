"""First sightings with their update rule, as a batch and as a stream.

The first sighting of a key, by time and number, is kept as it is; later ones only
change its phase, to that of the last of them that has one. The stream keeps one
row of state for each key, with the places in the order that its two parts come
from, so rows may come in any order and in any trigger.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.dedupe import first_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_seen_with_phase(events: DataFrame, key: list[str], phase: str = "phase", ts: str = "ts", number: str = "number") -> DataFrame:
    """One row per key: the first by (ts, number), its phase that of the last row of the key that has one. A hot key is summed before the shuffle."""
    at: Column = F.struct(ts, number)
    last = events.groupBy(*key).agg(F.max_by(phase, F.when(F.col(phase).isNotNull(), at)).alias("__phase"))
    on = [F.col(f"f.{k}").eqNullSafe(F.col(f"l.{k}")) for k in key]
    both = first_of(events, key, [ts, number]).alias("f").join(last.alias("l"), on)
    return both.select(*(F.col("l.__phase").alias(phase) if c == phase else F.col(f"f.{c}") for c in events.columns))


class FirstSeen(StatefulProcessor):
    """For each key the first row's values, where the phase comes from, and how often the two have changed."""

    def __init__(self, columns: list[str], state: T.StructType, phase: str, ts: str, number: str, ttl_ms: int | None):
        self.columns, self.schema, self.ttl_ms = columns, state, ttl_ms
        self.phase, self.ts, self.number = (columns.index(c) for c in (phase, ts, number))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("first", self.schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        place = lambda row: (row[self.ts], row[self.number])
        found = [tuple(r) for r in rows]
        first = min(found, key=place)
        phased = max((r for r in found if r[self.phase] is not None), key=place, default=None)
        before = tuple(self.state.get()) if self.state.exists() else None
        if before is None:
            own, last, revision = first, phased and (phased[self.phase], *place(phased)), 0
        else:
            own, last, revision = before[: len(self.columns)], before[len(self.columns) : -1], before[-1]
            own = min(own, first, key=place)
            last = last if last[1] is not None else None
            if phased is not None and (last is None or place(phased) > last[1:]):
                last = (phased[self.phase], *place(phased))
        now = (*own, *(last or (None, None, None)))
        if before is None or now != before[:-1]:
            self.state.update((*now, revision + 1))
            shown = dict(zip(self.columns, own, strict=True)) | {self.columns[self.phase]: last and last[0], "revision": revision + 1}
            yield Row(**shown)

    def close(self) -> None:
        pass


def stream_first_seen_with_phase(events: DataFrame, key: list[str], phase: str = "phase", ts: str = "ts", number: str = "number", ttl_ms: int | None = None) -> DataFrame:
    """first_seen_with_phase() as a stream in update mode: a key's row, with `revision`, whose largest is the row so far.

    Without ttl_ms it is an aggregation: a key's rows are summed before the
    shuffle, a trigger gives the rows of all keys that it has, and the revision is
    the number of events so far. With ttl_ms a key's row is given each time it
    changes (revision 1, 2, ...); the key is forgotten that long of processing time after its last
    change, and the query runs on for that until it is stopped. State is kept by RocksDB, which holds more keys than fit in memory; the session is set to it.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if ttl_ms is None:
        at = F.struct(ts, number)
        last = F.max_by(phase, F.when(F.col(phase).isNotNull(), at)).alias("__phase")
        seen = events.groupBy(*(F.col(k).alias(f"__{k}") for k in key)).agg(F.min_by(F.struct(*events.columns), at).alias("__first"), last, F.count("*").alias("revision"))
        return seen.select(*(F.col("__phase").alias(phase) if c == phase else F.col(f"__first.{c}").alias(c) for c in events.columns), "revision")
    times = [f.name for f in events.schema if isinstance(f.dataType, T.TimestampType)]
    rows = events.withColumns({c: F.unix_micros(c) for c in times})  # whole numbers have no time zone to lose in the state
    own = [T.StructField(f.name, f.dataType, True) for f in rows.schema]
    kind = {f.name: f.dataType for f in own}
    state = T.StructType([*own, T.StructField("__phase", kind[phase]), T.StructField("__phase_ts", kind[ts]), T.StructField("__phase_number", kind[number]), T.StructField("__revision", T.LongType())])
    out = T.StructType([*own, T.StructField("revision", T.LongType())])
    processor = FirstSeen(rows.columns, state, phase, ts, number, ttl_ms)
    changes = rows.groupBy(*key).transformWithState(processor, out, "update", "ProcessingTime" if ttl_ms else "None")
    return changes.withColumns({c: F.timestamp_micros(c) for c in times})


def newest(updates: DataFrame, key: list[str]) -> DataFrame:
    """Of the rows that the stream has given, the last of each key."""
    return updates.groupBy(*(F.col(k).alias(f"__{k}") for k in key)).agg(F.max_by(F.struct(*(c for c in updates.columns if c != "revision")), "revision").alias("row")).select("row.*")
