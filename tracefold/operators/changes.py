"""Change sets: observations against a reference table, what to insert and update, and how a table looks after it."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import values_equal
from ..functions.specs import TableSpec
from .aggregates import BATCH, batch_rows
from .joins import measured, written

EMPTY_CHANGES = "cast(map() as map<string,string>)"


def on_key(left: str, right: str, key: Iterable[str]) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in key])


def diff_join(obs: DataFrame, ref: DataFrame, key: list[str]) -> DataFrame:
    """Each row of obs (as struct o) with the reference row of its key (as struct r, null where there is none).

    A shuffle join on the key unless one side is small; the strategy is left to
    the optimizer. ref has one row for each key.
    """
    o = obs.select(F.struct("*").alias("o"))
    r = ref.select(F.struct("*").alias("r"))
    cond = functools.reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key])
    return o.join(r, cond, "left")


def compare_array(a: Column, b: Column, slots: int, element: T.DataType) -> Column:
    """a with null in every slot that equals b's, up to the shorter length and slots; later slots are left out."""
    n = F.greatest(F.least(F.size(a), F.size(b), F.lit(slots)), F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: F.when(~values_equal(x, y, element), x))


def text_of(c: Column, kind: T.DataType) -> Column:
    return F.to_json(c) if isinstance(kind, T.ArrayType) else c.cast("string")


def compare(obs: DataFrame, ref: DataFrame, spec: TableSpec, force_insert: bool = False) -> DataFrame:
    """What makes ref agree with obs: one row for each observation that is new or differs.

    Columns: op ('insert' or 'update'), pk (struct), changes (column to new
    value as text, null to set null; for arrays a JSON list with null in equal slots), n_changed,
    build_only. A key that ref lacks is an insert with all its values that
    aren't null. Else the columns that differ under tolerant equality are
    updates, each array slot counting as one; nothing where none differs, or
    where ref's build is strictly greater than obs'. The build column itself
    counts as a change. force_insert makes every row an insert.
    """
    joined = diff_join(obs, ref, spec.key)
    new = F.lit(True) if force_insert else F.col("r").isNull()
    inserts, updates, counts = [], [], []
    for c in spec.columns:
        if c.key:
            continue
        mine, theirs, name = F.col(f"o.{c.name}"), F.col(f"r.{c.name}"), F.lit(c.name)
        inserts.append(F.struct(name.alias("key"), text_of(mine, c.type).alias("value"), mine.isNotNull().alias("set")))
        if isinstance(c.type, T.ArrayType):
            slots = compare_array(mine, theirs, c.slots, c.type.elementType)
            n = F.coalesce(F.size(F.filter(slots, lambda x: x.isNotNull())), F.lit(0))
            n = F.when(mine.isNull() | theirs.isNull(), F.lit(0)).otherwise(n)
            updates.append(F.struct(name.alias("key"), F.to_json(slots, {"ignoreNullFields": "false"}).alias("value"), (n > 0).alias("set")))
        else:
            differs = ~values_equal(mine, theirs, c.type)
            n = differs.cast("int")
            updates.append(F.struct(name.alias("key"), text_of(mine, c.type).alias("value"), differs.alias("set")))
        counts.append(n)
    present = lambda entries: F.map_from_entries(F.transform(F.filter(F.array(*entries), lambda e: F.coalesce(e["set"], F.lit(False))), lambda e: F.struct(e["key"], e["value"])))
    changed = functools.reduce(lambda a, b: a + b, counts, F.lit(0))
    rows = joined.select(
        F.when(new, "insert").otherwise("update").alias("op"),
        F.struct(*(F.col(f"o.{k}").alias(k) for k in spec.key)).alias("pk"),
        F.when(new, present(inserts)).otherwise(present(updates)).alias("changes"),
        F.when(new, F.lit(len(inserts))).otherwise(changed).alias("n_changed"),
        *([(F.col(f"r.{spec.build}") > F.col(f"o.{spec.build}")).alias("older")] if spec.build else [F.lit(False).alias("older")]),
    )
    rows = rows.where((F.col("op") == "insert") | ((F.col("n_changed") > 0) & ~F.coalesce("older", F.lit(False))))
    build_only = (F.col("op") == "update") & (F.col("n_changed") == 1) & (F.map_contains_key("changes", spec.build) if spec.build else F.lit(False))
    return rows.select("op", "pk", "changes", "n_changed", build_only.alias("build_only"))


def row_hash(spec: TableSpec) -> Column:
    """64 bits of a row's values besides its key. Nulls count by their place: the hash of values alone passes over them."""
    own = [c for c in spec.columns if not c.key]
    plain = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.BinaryType)
    values = [F.col(c.name) if isinstance(c.type, plain) else F.to_json(F.struct(c.name)) for c in own]
    return F.xxhash64(*values, *(F.col(c.name).isNull() for c in own)) if own else F.lit(0).cast("long")


def compare_by_hash(obs: DataFrame, ref: DataFrame, spec: TableSpec) -> DataFrame:
    """compare() for tables that hardly differ: keys and hashes are joined first, and whole rows are only moved for keys that are new or whose hashes differ.

    Equal hashes are equal rows; different ones may still be equal within the
    tolerance, which compare() tells. Where too many keys differ for a broadcast,
    whole rows are compared as they are.
    """
    hashed = lambda df: df.select(*spec.key, row_hash(spec).alias("hash"))
    both = hashed(obs).alias("o").join(hashed(ref).alias("r"), on_key("o", "r", spec.key), "left")
    differ = written(both.where(F.col("r.hash").isNull() | (F.col("r.hash") != F.col("o.hash"))).select(*(F.col(f"o.{k}").alias(k) for k in spec.key)).distinct(), "changed-keys")
    if not measured(differ):
        return compare(obs, ref, spec)
    some = lambda df: df.alias("x").join(F.broadcast(differ).alias("k"), on_key("x", "k", spec.key), "left_semi")
    return compare(some(obs), some(ref), spec)


def skip_build_only_updates(changes: DataFrame) -> DataFrame:
    """changes without the updates that only set the build."""
    return changes.where(~F.col("build_only"))


def group_identical_updates(changes: DataFrame, most: int = BATCH) -> DataFrame:
    """Updates that set the same values, as rows over their keys: changes, batch, pks (at most `most`, sorted), n (rows of the batch)."""
    keys = [f"__pk{k}" for k in range(len(changes.schema["pk"].dataType.fields))]
    updates = changes.where("op = 'update'").select("pk", F.sort_array(F.map_entries("changes")).alias("set"), *(F.col(f"pk.{f.name}").alias(k) for f, k in zip(changes.schema["pk"].dataType, keys, strict=True)))
    rows = batch_rows(updates, most, ["set"], keys).groupBy("set", "batch")
    return rows.agg(F.sort_array(F.collect_list("pk")).alias("pks"), F.count("*").alias("n")).select(F.map_from_entries("set").alias("changes"), "batch", "pks", "n")


def split_insert_update(obs: DataFrame, ref: DataFrame, key: list[str]) -> DataFrame:
    """obs with in_reference: whether its key is there; one join and a flag."""
    joined = diff_join(obs, ref, key)
    return joined.select("o.*", F.col("r").isNotNull().alias("in_reference"))


def comment_out(spawns: DataFrame, objects: bool = False) -> DataFrame:
    """spawns (is_temporary, already_exists, bad_transport, is_transport) with comment_out and reason; the first reason that holds counts, no row goes."""
    reason = F.when(F.col("is_temporary"), "temporary spawn").when(F.col("already_exists"), "already present in the reference").when(F.col("bad_transport"), "transport template not found")
    if objects:
        reason = reason.when(F.col("is_transport"), "transport")
    return spawns.withColumn("reason", reason).withColumn("comment_out", F.col("reason").isNotNull())


def delete_range(numbered: DataFrame, table: str, n: str) -> DataFrame:
    """One row: the range of numbers of table to delete before its rows are inserted; none for an empty table."""
    return numbered.agg(F.min(n).alias("first"), F.max(n).alias("last")).where("first is not null").select(F.lit("delete_range").alias("op"), F.lit(table).alias("table"), "first", "last")


def delete_then_insert(rows: DataFrame, key: list[str]) -> DataFrame:
    """Two ordered change rows for each row: its delete, then its insert (op, seq, pk, row)."""
    ops = F.explode(F.array(F.struct(F.lit("delete").alias("op"), F.lit(0).alias("seq")), F.struct(F.lit("insert").alias("op"), F.lit(1).alias("seq")))).alias("x")
    return rows.select(ops, F.struct(*key).alias("pk"), F.struct(*rows.columns).alias("row")).select("x.op", "x.seq", "pk", "row")


def insert_ignore(rows: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key table lacks, one for each key."""
    return rows.dropDuplicates(key).join(table.select(*key), key, "left_anti")


def apply_changes(ref: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """ref as it is after changes (rows of compare(), and op 'delete' with pk): deletes, then updates, then inserts.

    A change to null sets null. Array slots that are null in a change keep their value.
    """
    flat = changes.select("op", "changes", *(F.col(f"pk.{k}").alias(k) for k in spec.key))
    null_safe = lambda left, right: functools.reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in spec.key])
    gone = flat.where("op = 'delete'")
    kept = ref.join(gone, null_safe(ref, gone), "left_anti")
    sets = flat.where("op = 'update'").select(*(F.col(k).alias(f"__{k}") for k in spec.key), F.col("changes").alias("__changes"))
    both = kept.join(sets, functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in spec.key]), "left")
    out = []
    for c in spec.columns:
        got = F.element_at("__changes", c.name)
        if c.key:
            value = F.col(c.name)
        elif isinstance(c.type, T.ArrayType):
            parsed = F.from_json(got, c.type)
            value = F.when(got.isNull(), F.col(c.name)).otherwise(F.concat(F.zip_with(F.slice(F.col(c.name), 1, F.size(parsed)), parsed, lambda old, new: F.coalesce(new, old)), F.slice(F.col(c.name), F.size(parsed) + 1, F.greatest(F.size(c.name) - F.size(parsed), F.lit(0)))))
        else:
            value = F.when(F.coalesce(F.map_contains_key("__changes", F.lit(c.name)), F.lit(False)), got.cast(c.type)).otherwise(F.col(c.name))
        out.append(value.alias(c.name))
    updated = both.select(*out)
    inserts = flat.where("op = 'insert'")
    fresh = inserts.select(*(F.col(c.name) if c.key else (F.from_json(F.element_at("changes", c.name), c.type) if isinstance(c.type, T.ArrayType) else F.element_at("changes", c.name).cast(c.type)).alias(c.name) for c in spec.columns))
    return updated.unionByName(fresh)


def versioned_target_guard(rows: DataFrame, captures: DataFrame, pairs: DataFrame, target: str) -> DataFrame:
    """rows of captures whose content version belongs to target, by pairs (content_version, target)."""
    fit = captures.join(F.broadcast(pairs.where(F.col("target") == target)), "content_version", "left_semi").select("capture_id")
    return rows.join(fit, "capture_id", "left_semi")


# --- change records (CDC) ---

#: Statuses of a record (fixed values).
VALID, REMOVED, INVALID, NOT_PUBLIC = 1, 2, 3, 4


def latest_records(records: DataFrame) -> DataFrame:
    """The last valid or removed record of each (table_hash, record_id) by number; the other statuses do nothing."""
    rows = records.where(F.col("status").isin(VALID, REMOVED))
    return rows.groupBy("table_hash", "record_id").agg(F.max_by(F.struct("status", "payload"), F.struct("number", "unique_id")).alias("last")).select("table_hash", "record_id", "last.*")


def apply_cdc(base: DataFrame, records: DataFrame) -> DataFrame:
    """base (table_hash, record_id, payload) after records: valid ones replace or add, removed ones delete."""
    last = latest_records(records).select("table_hash", "record_id", "status", F.col("payload").alias("new"))
    both = base.join(last, ["table_hash", "record_id"], "full")
    kept = both.where(F.col("status").isNull() | (F.col("status") == VALID))
    return kept.select("table_hash", "record_id", F.when(F.col("status").isNull(), F.col("payload")).otherwise(F.col("new")).alias("payload"))


def cdc_log(records: DataFrame) -> DataFrame:
    """Every record as it came."""
    return records.select("id", "unique_id", "table_hash", "record_id", "status")


def cdc_allow_list(records: DataFrame, tables: list[int] | None) -> DataFrame:
    """Records of the listed tables; all where there is no list."""
    return records if tables is None else records.where(F.col("table_hash").isin(*tables))


def verified_only(rows: DataFrame, build: str) -> DataFrame:
    return rows.where(F.col(build) > 0)


def localised_copy(rows: DataFrame, key: list[str], locale: str) -> DataFrame:
    """key, locale and the string columns of rows, each under the name it has with _lang."""
    strings = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType) and f.name not in key]
    return rows.select(*key, F.lit(locale).alias("locale"), *(F.col(c).alias(f"{c}_lang") for c in strings))


def anti_known_tables(records: DataFrame, known: DataFrame) -> DataFrame:
    """Records of tables whose structure isn't known, kept as blobs."""
    return records.join(known.select("table_hash"), "table_hash", "left_anti")


def optional_data_link(optional: DataFrame, records: DataFrame) -> DataFrame:
    return optional.join(latest_records(records).where(F.col("status") == VALID).select("table_hash", "record_id"), ["table_hash", "record_id"])
