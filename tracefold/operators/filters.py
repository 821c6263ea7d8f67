"""Projections and filters over events, entities and observations."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import values_equal
from ..functions.specs import TableSpec


def matches_any(value: Column, patterns: list[str]) -> Column:
    """Any of the patterns is part of value, in either case."""
    return functools.reduce(lambda a, b: a | b, [F.contains(F.lower(value), F.lit(p.lower())) for p in patterns], F.lit(False))


def filter_opcodes(df: DataFrame, include: list[str] = (), exclude: list[str] = (), name: str = "opcode_name") -> DataFrame:
    """Events whose opcode name has an included part (any, where nothing is included) and no excluded one."""
    out = df.where(matches_any(F.col(name), include)) if include else df
    return out.where(~matches_any(F.col(name), exclude)) if exclude else out


def warn_unmatched_patterns(spark, patterns: list[str], names: DataFrame) -> DataFrame:
    """The patterns that are part of no name; those that start with - are not tested."""
    tested = [p for p in patterns if not p.startswith("-")]
    if not tested:
        return spark.createDataFrame([], "pattern string")
    hit = names.agg(*(F.bool_or(F.contains(F.lower("name"), F.lit(p.lower()))).alias(f"p{k}") for k, p in enumerate(tested)))
    rows = F.inline(F.array(*(F.struct(F.lit(p).alias("pattern"), F.coalesce(f"p{k}", F.lit(False)).alias("hit")) for k, p in enumerate(tested))))
    return hit.select(rows).where("not hit").select("pattern")


def parse_entry_lists(text: str) -> dict[str, list[int]]:
    """'Type:id:id,Type:id' by type."""
    out: dict[str, list[int]] = {}
    for part in filter(None, (x.strip() for x in text.split(","))):
        kind, *ids = part.split(":")
        out.setdefault(kind, []).extend(int(i) for i in ids)
    return out


def entry_passes(kind: Column, entry: Column, include: dict[str, list[int]], ignore: dict[str, list[int]]) -> Column:
    """Whether an entry passes: in its type's include list, if any type has one; but a type's ignore list, where there is one, decides alone."""
    listed = functools.reduce(lambda a, b: a | b, [(kind == k) & entry.isin(*v) for k, v in include.items()], F.lit(False)) if include else F.lit(True)
    return functools.reduce(lambda c, kv: c.when(kind == kv[0], ~entry.isin(*kv[1])), ignore.items(), F.when(F.lit(False), True)).otherwise(listed)


def filter_entries(df: DataFrame, include: dict[str, list[int]], ignore: dict[str, list[int]], kind: str = "entity_type", entry: str = "entry") -> DataFrame:
    return df.where(entry_passes(F.col(kind), F.col(entry), include, ignore))


def filter_event_by_guids(df: DataFrame, include: dict[str, list[int]], ignore: dict[str, list[int]], guids: str = "guids") -> DataFrame:
    """Events all of whose guids (structs of entity_type, entry, has_entry) pass; those without an entry pass unless they are players."""
    ok = lambda g: (~g["has_entry"] & (g["entity_type"] != "Player")) | entry_passes(g["entity_type"], g["entry"], include, ignore)
    return df.where(F.forall(F.coalesce(F.col(guids), F.array().cast(df.schema[guids].dataType)), ok))


def filter_area_map(df: DataFrame, areas: list[str] = (), maps: list[str] = (), area: str = "area_id", map_: str = "map") -> DataFrame:
    """Rows whose area and map ids have one of the given texts as a part: '1' passes map 571 too."""
    for texts, name in ((areas, area), (maps, map_)):
        if texts:
            df = df.where(functools.reduce(lambda a, b: a | b, [F.contains(F.col(name).cast("string"), F.lit(t)) for t in texts]))
    return df


#: Bits of an event's outcome (fixed values).
STATUS_BITS = {"none": 0, "success": 1, "with_errors": 2, "not_parsed": 4, "no_structure": 8}


def filter_status(df: DataFrame, mask: int, status: str = "status_bits") -> DataFrame:
    return df.where(F.col(status).bitwiseAND(mask) != 0)


def is_temporary() -> Column:
    """An owner, a creator, a spell that created it, or a mark."""
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return F.coalesce("forced_temporary", F.lit(False)) | has("owner_guid") | has("created_by") | (F.coalesce("created_by_spell", F.lit(0)) != 0)


def drop_temporary(df: DataFrame) -> DataFrame:
    return df.where(~is_temporary())


#: How an entity came into view (fixed value): 2 is by spawning.
SPAWN = 2


def spawned_in_view_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("create_type") == SPAWN)


def drop_zero_entry(df: DataFrame) -> DataFrame:
    return df.where(F.col("entry") != 0)


def drop_dead(df: DataFrame) -> DataFrame:
    return df.where(F.col("health") > 0)


#: Opcodes from which events of old builds are undecrypted, and the last such build (fixed values).
UNDECRYPTED_OPCODE, OLD_BUILD = 1312, 12340


def drop_undecrypted(df: DataFrame, build: str = "client_build") -> DataFrame:
    return df.where(~((F.col("opcode") >= UNDECRYPTED_OPCODE) & (F.col(build) <= OLD_BUILD) & (F.col(build) != 0)))


def sample_data_filter(df: DataFrame, opcodes: bool = False) -> DataFrame:
    """Samples with a type and an id; id 0 for maps only, opcode rows only when asked for."""
    out = df.where((F.col("object_type") != "None") & ((F.col("id") != 0) | (F.col("object_type") == "Map")))
    return out if opcodes else out.where(F.col("object_type") != "Opcode")


def max_content_expansion(captures: DataFrame, versions: DataFrame, limit: str) -> DataFrame:
    """captures up to a content version; versions: (content_version, rank). An unknown limit is an error."""
    row = versions.where(F.col("content_version") == limit).select("rank").first()
    if row is None:
        raise ValueError(f"unknown content version {limit}")
    return captures.join(F.broadcast(versions.where(F.col("rank") <= row["rank"]).select("content_version")), "content_version", "left_semi")


def skip_default_rows(df: DataFrame, spec: TableSpec, defaults: DataFrame) -> DataFrame:
    """df without rows whose values (not the key) all equal the one row of defaults, under tolerant equality."""
    d = defaults.select(F.struct(*spec.values).alias("__d"))
    same = functools.reduce(lambda a, b: a & b, [values_equal(F.col(c), F.col(f"__d.{c}"), spec.column(c).type) for c in spec.values])
    return df.crossJoin(F.broadcast(d)).where(~same).drop("__d")  # defaults are one row


def explode_multi_events(df: DataFrame, frames: Column) -> DataFrame:
    """One row for each (opcode, body) of frames that a container event holds; time, number and direction are the container's, sub is the place in it."""
    other = [c for c in df.columns if c not in ("opcode", "payload", "length")]
    return df.select(*other, F.posexplode(frames).alias("sub", "frame")).select(*other, "sub", "frame.opcode", F.col("frame.body").alias("payload"), F.octet_length("frame.body").alias("length"))


def split_frames(payload: Column) -> Column:
    """The frames in a payload of little-endian (length 16 bits, opcode 16 bits, body): array of (opcode, body)."""
    digits = F.hex(payload)
    number = lambda at: F.conv(F.concat(F.substring(digits, at + 3, F.lit(2)), F.substring(digits, at + 1, F.lit(2))), 16, 10).cast("int")
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<opcode:int,body:binary>>").alias("out"))

    def step(s: Column, _: Column) -> Column:
        at = s["at"]
        n = number(at)
        left = at + 8 <= F.length(digits)
        frame = F.struct(number(at + 4).alias("opcode"), F.unhex(F.substring(digits, at + 9, n * 2)).alias("body"))
        return F.when(left, F.struct((at + 8 + n * 2).alias("at"), F.concat(s["out"], F.array(frame)).alias("out"))).otherwise(s)

    most = F.greatest(F.floor(F.octet_length(payload) / 4).cast("int"), F.lit(1))
    return F.aggregate(F.sequence(F.lit(1), most), state, step, lambda s: s["out"])


def savable_scenes(df: DataFrame, excluded_type: int) -> DataFrame:
    """Scenes with an entity and a script id and another type than the excluded one, as template rows."""
    return df.where((F.col("entry") != 0) & (F.col("script_package_id") != 0) & (F.col("scene_type") != excluded_type)).select(F.col("entry").alias("scene_id"), "flags", "script_package_id")


def locale_rows(df: DataFrame, base: str = "enUS", locale: str = "locale") -> DataFrame:
    return df.where(F.col(locale) != base)


def plausible_map_ids(df: DataFrame, below: int = 1000) -> DataFrame:
    return df.where((F.col("object_type") != "Map") | (F.col("id") < below))
