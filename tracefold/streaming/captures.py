"""Streaming forms of the ordered passes. State is kept per session; results equal the batch operators'.

Order within a session is (number), never arrival: a trigger's rows of a session
are sorted before its state sees them, so files of one session must arrive in
their order, as the reference reads them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.joins import DETAIL, LINK_WINDOW_MS, RESET, RESPONSE, SELECTION
from ..sources.captures import SCHEMA, decoded


def stream_captures(spark: SparkSession, folder: str, files_a_trigger: int = 100) -> DataFrame:
    """The frames of capture files as they land in folder."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.{pkt,bin}").option("maxFilesPerTrigger", files_a_trigger).load(folder)

    return files.select("path", "content").mapInArrow(decoded, SCHEMA)


def load_each(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True):
    """Each trigger's rows given to load (an idempotent one: upsert and replace); the running query."""
    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_parse_stats(events: DataFrame, key: list[str] = ("capture_id",)) -> DataFrame:
    """Events by outcome per capture, over all that has come: for update or complete mode."""
    outcome = F.when(~F.coalesce("write_to_file", F.lit(True)), "not_parsed").otherwise(F.col("status"))
    return events.where(outcome != "none").groupBy(*key, outcome.alias("outcome")).agg(F.count("*").alias("n"))


def stream_first_seen(events: DataFrame, key: list[str], ts: str = "ts", delay: str | None = None) -> DataFrame:
    """The first row of each key; with a delay, keys are forgotten that long after they were seen."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key)) if delay else events.dropDuplicates(list(key))


def expiry(events: DataFrame, idle: str | None) -> tuple[DataFrame, Callable[[GroupState, pd.DataFrame], None]]:
    """events with a watermark of idle behind their ts, and what sets a group's timer to idle after its last row; nothing without idle."""
    if idle is None:
        return events, lambda state, rows: None
    span = int(pd.Timedelta(idle).total_seconds() * 1000)

    def set_timer(state: GroupState, rows: pd.DataFrame) -> None:
        last = int(rows["ts"].max().timestamp() * 1000)
        state.setTimeoutTimestamp(max(last + span, state.getCurrentWatermarkMs() + 1))

    return events.withWatermark("ts", idle), set_timer


LINKED = "number long, kind string, selection_number long"
PENDING = "pending long, pending_ts double, saved long, saved_ts double"


def stream_link(events: DataFrame, session: str = "capture_id", window_ms: int = LINK_WINDOW_MS, idle: str | None = None) -> DataFrame:
    """Responses and details among events (session, number, ts, kind), each with the selection that it belongs to, or null.

    State per session: the pending selection, and the one saved for a detail
    that comes after its response. With idle (such as '1 hour') a session without
    events for so long of event time is forgotten: by then nothing that it held
    is near enough to be linked.
    """
    timed, expires = expiry(events, idle)
    kind = events.schema[session].dataType.simpleString()

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pending, pending_ts, saved, saved_ts = state.get if state.exists else (None, None, None, None)
        out = []
        rows = pd.concat(list(batches)).sort_values("number")
        for number, ts, what in zip(rows["number"].tolist(), rows["ms"].tolist(), rows["kind"], strict=True):
            if what == SELECTION:
                pending, pending_ts = number, ts
            elif what == RESET:
                pending = saved = None
            elif what == RESPONSE:
                hit = pending is not None and abs(ts - pending_ts) <= window_ms
                out.append((key[0], number, what, pending if hit else None))
                if hit:
                    saved, saved_ts = pending, pending_ts
                elif pending is not None:
                    saved = None
                pending = None
            elif what == DETAIL:
                hit = saved is not None and abs(ts - saved_ts) <= window_ms
                out.append((key[0], number, what, saved if hit else None))
                saved = None
        state.update((pending, pending_ts, saved, saved_ts))
        expires(state, rows)
        if out:
            frame = pd.DataFrame([x[:3] for x in out], columns=[session, "number", "kind"])
            yield frame.assign(selection_number=pd.array([x[3] for x in out], dtype="Int64"))

    rows = timed.select(session, "number", "ts", (F.unix_micros("ts") / 1000.0).alias("ms"), "kind")
    return rows.groupBy(session).applyInPandasWithState(step, f"{session} {kind}, {LINKED}", PENDING, "append", GroupStateTimeout.EventTimeTimeout if idle else GroupStateTimeout.NoTimeout)


def stream_session_state(events: DataFrame, session: str, value: str, idle: str | None = None) -> DataFrame:
    """Events (session, number, value) with the last value of the session that wasn't null, their own included.

    With idle, events have ts too, and a session without events for so long of event time starts anew.
    """
    timed, expires = expiry(events, idle)
    kinds = {c: events.schema[c].dataType.simpleString() for c in (session, value)}

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values("number")
        current, out = (state.get[0] if state.exists else None), []
        for v in rows[value]:
            if not pd.isna(v):
                current = int(v) if whole else v  # a column with nulls comes as floats
            out.append(current)
        state.update((current,))
        expires(state, rows)
        yield rows.assign(**{f"current_{value}": pd.Series(out, index=rows.index, dtype="Int64" if whole else object)})[[session, "number", value, f"current_{value}"]]

    whole = kinds[value] in ("tinyint", "smallint", "int", "bigint")
    return timed.select(session, "number", value, *(["ts"] if idle else [])).groupBy(session).applyInPandasWithState(step, f"{session} {kinds[session]}, number long, {value} {kinds[value]}, current_{value} {kinds[value]}", f"last {kinds[value]}", "append", GroupStateTimeout.EventTimeTimeout if idle else GroupStateTimeout.NoTimeout)


def entity_lifecycle(events: DataFrame, fields: list[str], key: list[str] = ("capture_id", "guid")) -> DataFrame:
    """The state of each entity after its events (key, number, kind, fields; null fields were not sent): kind create starts anew, update sets what it has, destroy and out_of_range end it.

    For each field the last value since the last create; alive unless the last
    event ends it. Two groupings, no window over a hot entity.
    """
    key = list(key)
    starts = events.groupBy(*key).agg(F.max(F.when(F.col("kind") == "create", F.col("number"))).alias("__start"), F.max_by("kind", "number").alias("__last"), F.max("number").alias("last_number"))
    rows = events.join(starts, key).where(F.col("__start").isNull() | (F.col("number") >= F.col("__start")))
    out = rows.groupBy(*key, "last_number", (~F.col("__last").isin("destroy", "out_of_range")).alias("alive"))
    return out.agg(*(F.max_by(f, F.when(F.col(f).isNotNull(), F.col("number"))).alias(f) for f in fields))


def stream_lifecycle(events: DataFrame, entity: str, fields: list[str], idle: str | None = None) -> DataFrame:
    """The same as a stream, in update mode: the state of each entity (one key column) that a trigger touched; a destroyed one is reported once, not alive, and forgotten.

    With idle (such as '1 hour') events have ts too, and an entity without events
    for so long of event time is forgotten without a row: what is never destroyed
    doesn't stay for ever.
    """
    timed, expires = expiry(events, idle)
    kinds = {c: events.schema[c].dataType.simpleString() for c in (entity, *fields)}

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        own = list(state.get) if state.exists else [None] * len(fields)
        parts = list(batches)
        rows = parts[0] if len(parts) == 1 else pd.concat(parts)
        order = np.argsort(rows["number"].to_numpy(), kind="stable")
        kind = rows["kind"].to_numpy()[order]
        starts = np.flatnonzero(kind == "create")
        since = order
        if len(starts):  # what came before the last create doesn't count
            own, since = [None] * len(fields), order[starts[-1] :]
        for k, f in enumerate(fields):
            v = rows[f].to_numpy()[since]
            sent = np.flatnonzero(~pd.isna(v))
            if len(sent):
                v = v[sent[-1]]
                own[k] = v.item() if isinstance(v, np.number | np.bool_) else v if not isinstance(v, np.datetime64) else rows[f].iloc[since[sent[-1]]]
        alive, number = kind[-1] not in ("destroy", "out_of_range"), int(rows["number"].to_numpy()[order[-1]])
        state.update(tuple(own))
        if alive:
            expires(state, rows)
        else:
            state.remove()
        yield pd.DataFrame({entity: [key[0]], "last_number": [number], "alive": [alive]} | {f: [v] for f, v in zip(fields, own, strict=True)})

    schema = f"{entity} {kinds[entity]}, last_number long, alive boolean, " + ", ".join(f"{f} {kinds[f]}" for f in fields)
    rows = timed.select(entity, "number", "kind", *fields, *(["ts"] if idle else []))
    return rows.groupBy(entity).applyInPandasWithState(step, schema, ", ".join(f"{f} {kinds[f]}" for f in fields), "update", GroupStateTimeout.EventTimeTimeout if idle else GroupStateTimeout.NoTimeout)
