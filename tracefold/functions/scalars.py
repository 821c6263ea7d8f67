"""Column expressions: tolerant equality, times, bit fields, literals and small rules. All stay in the JVM."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def either(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- equality (X01, X02, X25, X26) ---


def trimmed(s: Column) -> Column:
    """A string without trailing CR, LF and spaces."""
    return F.regexp_replace(s, "[\r\n ]+$", "")


def values_equal(a: Column, b: Column, kind: T.DataType, other: T.DataType | None = None) -> Column:
    """Tolerant equality of a (of type kind) and b (of type other, kind unless given); never null.

    float to float: nearer than 0.01; double to double: nearer than 0.001. A float
    on the left or a double on the right against another type is unequal; a
    double on the left against an integer is rounded half to even first. Strings
    lose trailing CR, LF and spaces, and null equals the empty string. Else null
    counts as 0. Arrays are equal when all their slots are, up to the shorter
    length. The relation isn't transitive, so it is never a grouping key.
    """
    other = other or kind
    nulls = a.isNull() & b.isNull()
    if isinstance(kind, T.ArrayType) and isinstance(other, T.ArrayType):
        n = F.least(F.size(a), F.size(b))
        pairs = F.zip_with(F.slice(a, 1, F.greatest(n, F.lit(0))), F.slice(b, 1, F.greatest(n, F.lit(0))), lambda x, y: values_equal(x, y, kind.elementType, other.elementType))
        return nulls | F.coalesce(F.forall(pairs, lambda x: x), F.lit(False))
    for t, eps in ((T.FloatType, 0.01), (T.DoubleType, 0.001)):
        if isinstance(kind, t) and isinstance(other, t):
            return nulls | F.coalesce(F.abs(a.cast("double") - b.cast("double")) < eps, F.lit(False))
    if isinstance(kind, T.FloatType) or isinstance(other, T.DoubleType):
        return F.lit(False)
    if isinstance(kind, T.StringType) or isinstance(other, T.StringType):
        text = [F.coalesce(trimmed(x) if isinstance(t, T.StringType) else x.cast("string"), F.lit("")) for x, t in ((a, kind), (b, other))]
        return text[0] == text[1]
    if isinstance(kind, INTEGRAL + (T.DoubleType,)) and isinstance(other, INTEGRAL):
        whole = [F.coalesce((F.bround(x) if isinstance(t, T.DoubleType) else x).cast("long"), F.lit(0)) for x, t in ((a, kind), (b, other))]
        return whole[0] == whole[1]
    return a.eqNullSafe(b)


def within(x: Column, y: Column, eps: float) -> Column:
    return F.abs(x - y) < eps


def map_equal(a: Column, b: Column) -> Column:
    """Same keys with same values, in any order."""
    return F.sort_array(F.map_entries(a)) == F.sort_array(F.map_entries(b))


def normalize_newlines(s: Column) -> Column:
    return F.regexp_replace(s, "\r\n", "\n")


# --- geometry (X03, X04, X22) ---


def normalize_orientation(o: Column) -> Column:
    """An angle of [0, 2 pi) brought to (-pi, pi]."""
    return F.when(o > math.pi, o - 2 * math.pi).otherwise(o)


def to_local_offset(x: Column, y: Column, z: Column, px: Column, py: Column, pz: Column, po: Column) -> Column:
    """(x, y, z) as seen from a parent at (px, py, pz) that faces po."""
    dx, dy = x - px, y - py
    return F.struct((dx * F.cos(po) + dy * F.sin(po)).alias("x"), (dy * F.cos(po) - dx * F.sin(po)).alias("y"), (z - pz).alias("z"))


def unpack_quaternion(packed: Column) -> Column:
    """(x, y, z, w) of a rotation packed in 64 bits: x in the upper 22, y and z in 21 each; w is what makes the norm 1."""
    x = F.shiftright(packed, 42) / 2097152.0
    y = F.shiftright(F.shiftright(F.shiftleft(packed, 22), 32), 11) / 1048576.0
    z = F.shiftright(F.shiftleft(packed, 43), 43) / 1048576.0
    n = x * x + y * y + z * z
    w = F.when(F.abs(n - 1.0) >= 1 / 1048576.0, F.sqrt(1.0 - n)).otherwise(0.0)
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"), w.alias("w"))


def static_rotation(packed: Column, rotation: Column, build: Column, added: int = 13164) -> Column:
    """The packed rotation for builds from `added` on, else the rotation that was sent."""
    return F.when(build >= added, unpack_quaternion(packed)).otherwise(rotation)


# --- literals and text (X05-X08, X14, X16-X18, X23, X24, X30, X31) ---


def escape_string(s: Column) -> Column:
    """Backslashes, double and single quotes escaped with a backslash."""
    return F.regexp_replace(s, r"""([\\"'])""", r"\\$1")


def stringify(s: Column) -> Column:
    """A quoted literal; null is the empty one."""
    return F.concat(F.lit("'"), F.coalesce(escape_string(s), F.lit("")), F.lit("'"))


def hexify(c: Column) -> Column:
    return F.concat(F.lit("0x"), F.hex(c))


def sql_literal(c: Column, kind: T.DataType, flags: bool = False, nullable: bool = True) -> Column:
    """The literal of a value: text quoted, booleans 1 and 0, flags and blobs in hex, decimals of 20 characters at most without trailing zeros.

    A null is NULL, or UNKNOWN in a column that can't hold one.
    """
    if isinstance(kind, T.StringType):
        text = stringify(c)
    elif isinstance(kind, T.BooleanType):
        text = c.cast("int").cast("string")
    elif isinstance(kind, T.BinaryType) or flags:
        text = hexify(c)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        text = F.regexp_replace(F.substring(F.format_string("%.20f", c.cast("double")), 1, 20), r"\.?0+$", "")
    else:
        text = c.cast("string")
    return F.when(c.isNull(), "NULL" if nullable else "UNKNOWN").otherwise(text)


def snake_case(s: Column) -> Column:
    return F.lower(F.regexp_replace(s, "(?<!^)([A-Z])", "_$1"))


def add_back_quotes(s: Column) -> Column:
    return F.concat(F.lit("`"), s, F.lit("`"))


def remove_back_quotes(s: Column) -> Column:
    return F.replace(s, F.lit("`"), F.lit(""))


def format_span(ms: Column) -> Column:
    """hh:mm:ss.fff of a span in milliseconds; whole days are left out."""
    ms = F.abs(ms.cast("long"))
    part = lambda unit, n: F.expr("0") + F.floor(ms / unit).cast("long") % n
    return F.format_string("%02d:%02d:%02d.%03d", part(3_600_000, 24), part(60_000, 60), part(1000, 60), ms % 1000)


def human_bytes(n: Column) -> Column:
    """A number of bytes with a unit, in powers of 1024."""
    units = F.array(*map(F.lit, ("B", "KB", "MB", "GB", "TB", "PB", "EB")))
    at = F.when(n == 0, 0).otherwise(F.floor(F.log2(F.abs(n).cast("double")) / 10 + 1e-12).cast("int"))
    return F.concat(F.round(n / F.pow(F.lit(1024.0), at), 1).cast("string"), F.get(units, at))


def hex_table(payload: Column) -> Column:
    """The bytes in lines of 16: hex on the left, printable characters on the right."""
    digits = F.hex(payload)
    lines = F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length(payload) / 16).cast("int") - 1, F.lit(0)))

    def line(k: Column) -> Column:
        own = F.substring(digits, k * 32 + 1, F.lit(32))
        text = F.decode(F.unhex(own), "ISO-8859-1")
        left = F.rpad(F.regexp_replace(own, "(..)", "$1 "), 48, " ")
        return F.concat(F.lit("| "), left, F.lit("| "), F.regexp_replace(F.regexp_replace(text, "[^\\x20-\\x7E]", "."), "(.)", "$1 "), F.lit("|"))

    return F.when(F.octet_length(payload) == 0, "").otherwise(F.array_join(F.transform(lines, line), "\n"))


def object_path(name: Column, indexes: Column) -> Column:
    """(name) [i] [j] ..."""
    return F.concat_ws(" ", F.array(F.concat(F.lit("("), name, F.lit(")"))), F.transform(indexes, lambda i: F.concat(F.lit("["), i.cast("string"), F.lit("]"))))


def flatten_lists(lists: Column) -> Column:
    return F.flatten(lists)


def join_phases(phases: Column, force_zero: bool = False) -> Column:
    joined = F.array_join(F.transform(phases, lambda p: p.cast("string")), " - ")
    return F.lit("0") if force_zero else F.when(F.coalesce(joined, F.lit("")) == "", "0").otherwise(joined)


def template_auras(auras: Column, no_caster: int) -> Column:
    """Spell ids of auras (spell_id, flags, duration) with the no-caster flag and no duration, space separated."""
    kept = F.filter(auras, lambda a: (a["flags"].bitwiseAND(no_caster) != 0) & (F.coalesce(a["duration"], F.lit(0)) <= 0))
    return F.array_join(F.transform(kept, lambda a: a["spell_id"].cast("string")), " ")


# --- times (X09, X10) ---

#: The range of timestamps that from_unix() keeps to: years 1 to 9999 (fixed values).
LEAST_SECOND, LAST_SECOND = -62135596800, 253402300799


def from_unix(sec: Column) -> Column:
    return F.timestamp_seconds(F.least(F.greatest(sec.cast("long"), F.lit(LEAST_SECOND)), F.lit(LAST_SECOND)))


def to_unix(ts: Column) -> Column:
    return F.unix_seconds(ts)


def bits(v: Column, at: int, n: int) -> Column:
    return F.shiftright(v, at).bitwiseAND((1 << n) - 1)


def from_packed_time(v: Column) -> Column:
    """A time packed in an integer: minute 6 bits, hour 5, weekday 3, day 6, month 4, year 5, all counted from 2000-01-01."""
    v = v.cast("long")
    day = F.date_add(F.add_months(F.lit("2000-01-01").cast("date"), (bits(v, 24, 5) * 12 + bits(v, 20, 4)).cast("int")), bits(v, 14, 6).cast("int"))
    return F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + bits(v, 6, 5) * 3600 + bits(v, 0, 6) * 60)


# --- bit fields (X11-X13, X15, X27, X33) ---

#: High types of legacy 64-bit ids (fixed values): code and name.
LEGACY_TYPES = {0x101: "BattleGround1", 0x104: "InstanceSave", 0x105: "RaidGroup", 0x109: "BattleGround2", 0x10C: "MOTransport", 0x10F: "Guild", 0xF00: "DynamicObject", 0xF01: "GameObject", 0xF02: "Transport", 0xF03: "Creature", 0xF04: "Pet", 0xF05: "Vehicle"}
HAS_ENTRY = ("Creature", "GameObject", "Pet", "Vehicle", "AreaTrigger", "Cast")
OBJECT_TYPE = {"Player": "Player", "DynamicObject": "DynamicObject", "Item": "Item", "GameObject": "GameObject", "Transport": "GameObject", "Vehicle": "Unit", "Creature": "Unit", "Pet": "Unit", "AreaTrigger": "AreaTrigger"}
NAME_TYPE = {"Player": "Player", "Item": "Item", "Transport": "GameObject", "Creature": "Unit", "Vehicle": "Unit", "Pet": "Unit", "GameObject": "GameObject", "Cast": "Spell"}
#: The build from which legacy ids have 32 bits of counter (fixed value).
WIDE_COUNTER_BUILD = 13164


def chosen(key: Column, table: dict, default: object = None) -> Column:
    """table[key], default where it has none."""
    out = functools.reduce(lambda c, kv: c.when(key == kv[0], kv[1]), table.items(), F.when(F.lit(False), F.lit(next(iter(table.values())))))
    return out.otherwise(F.lit(default))


def guid_parts(hi: Column, lo: Column) -> Column:
    """Fields of a 128-bit id given as two longs of the same bits."""
    take = lambda v, at, n: F.shiftrightunsigned(v, at).bitwiseAND((1 << n) - 1)
    return F.struct(take(hi, 58, 6).alias("high_type"), take(hi, 0, 6).alias("sub_type"), take(hi, 42, 13).alias("realm"), take(lo, 40, 24).alias("server"), take(hi, 29, 13).alias("map"), take(hi, 6, 23).alias("entry"), take(lo, 0, 40).alias("low"))


def legacy_guid_parts(lo: Column, build: Column, types: dict[int, str] = LEGACY_TYPES) -> Column:
    """Fields of a 64-bit id: high_type, entry, low; counters widen with the build."""
    code = F.shiftrightunsigned(lo.bitwiseAND(signed64(0xF0F0000000000000)), 52)
    group = code.bitwiseAND(0xF00)
    kind = F.when(lo == 0, "Null").when(group == 0, "Player").when(group == 0x400, "Item").otherwise(chosen(code, types, "Unknown"))
    wide = build >= WIDE_COUNTER_BUILD
    entry = F.when(kind.isin(*HAS_ENTRY), F.when(wide, F.shiftrightunsigned(lo, 32).bitwiseAND(0xFFFFF)).otherwise(F.shiftrightunsigned(lo, 24).bitwiseAND(0xFFFFFFF))).otherwise(0)
    narrow = F.when(wide, lo.bitwiseAND(0xFFFFFFFF)).otherwise(lo.bitwiseAND(0xFFFFFF))
    low = F.when(kind.isin("Player", "DynamicObject", "RaidGroup", "Item"), lo.bitwiseAND(0x000FFFFFFFFFFFFF)).when(kind.isin("GameObject", "Transport", "Vehicle", "Creature", "Pet"), narrow).otherwise(lo.bitwiseAND(0xFFFFFFFF))
    return F.struct(kind.alias("high_type"), entry.alias("entry"), low.alias("low"))


def signed64(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def guid_has_entry(high_type: Column) -> Column:
    return high_type.isin(*HAS_ENTRY)


def guid_object_type(high_type: Column) -> Column:
    return chosen(high_type, OBJECT_TYPE, "Object")


def guid_name_type(high_type: Column) -> Column:
    return chosen(high_type, NAME_TYPE, "None")


def guid_text(hi: Column, lo: Column, high_type: Column, map_name: Column, name: Column) -> Column:
    """Full: 0x... type/sub R/S Map [Entry] Low, as shown to people."""
    p = guid_parts(hi, lo)
    head = F.format_string("Full: 0x%016X%016X %s/%d R%d/S%d Map: %s", hi, lo, high_type, p["sub_type"], p["realm"], p["server"], map_name)
    tail = F.when(guid_has_entry(high_type), F.format_string(" Entry: %s Low: %d", name, p["low"])).otherwise(F.concat(F.format_string(" Low: %d", p["low"]), F.when(F.coalesce(name, F.lit("")) != "", F.concat(F.lit(" Name: "), name)).otherwise("")))
    return F.when((hi == 0) & (lo == 0), "Full: 0x0").otherwise(F.concat(head, tail))


SPAWN_TIME_BITS = 0x7FFFFF


def guid_spawn_time(lo: Column) -> Column:
    return lo.bitwiseAND(SPAWN_TIME_BITS)


def spawned_at(lo: Column, ts: Column, tolerance: int = 3) -> Column:
    """The id's spawn time lies within tolerance seconds of ts, so coming into view was a spawn."""
    return F.abs(guid_spawn_time(lo) - F.unix_seconds(ts).bitwiseAND(SPAWN_TIME_BITS)) <= tolerance


def has_any_flag(v: Column, mask: Column | int) -> Column:
    return v.bitwiseAND(mask) != 0


def has_flag_bit(v: Column, bit: Column) -> Column:
    return F.call_function("shiftright", v, bit.cast("int")).bitwiseAND(1) == 1


def lfg_parts(v: Column) -> Column:
    return F.struct(F.shiftrightunsigned(v, 24).bitwiseAND(0xFF).alias("type"), v.bitwiseAND(0xFFFFFF).alias("instance"))


def unpack_action(v: Column) -> Column:
    return F.struct(v.bitwiseAND(0xFFFFFF).alias("id"), F.shiftrightunsigned(v, 24).bitwiseAND(0xFF).alias("type"))


# --- rules (X19-X21, X28-X30, X32) ---

#: Maps that count as continents (fixed values).
CONTINENTS = (0, 1, 530, 571, 609, 638, 646, 648, 654, 655, 656, 659, 661, 732, 860, 861, 870, 974, 1064)


def is_continent(map_: Column) -> Column:
    return map_.isin(*CONTINENTS)


def default_respawn(map_: Column, instance_type: Column, difficulty: Column) -> Column:
    """Seconds by the kind of map (null where unknown: then continents are short)."""
    known = F.when(instance_type == 0, 120).when(instance_type == 1, F.when(difficulty == 2, 86400).otherwise(7200)).when(instance_type == 2, 604800).when(instance_type.isin(3, 4, 5), 7200)
    return F.coalesce(known, F.when(is_continent(map_), 120).otherwise(7200))


#: Visibility bits of a unit, largest reach first, with their class (fixed values).
VISIBILITY = {0x40000000: 5, 0x00400000: 4, 0x00200000: 3}


def visibility_class(flags: Column, table: dict[int, int] = VISIBILITY) -> Column:
    out = functools.reduce(lambda c, kv: c.when(has_any_flag(flags, kv[0]), kv[1]), table.items(), F.when(flags.isNull(), F.lit(None).cast("int")))
    return out.otherwise(0)


def sniffer_name(id_: Column, table: dict[int, str]) -> Column:
    """The recorder's name from its id; ids without one as text."""
    return F.coalesce(chosen(id_, table), id_.cast("string"))


def option_type(icon: Column, npc_flags: Column, rules: list[tuple[int, int, list[tuple[int, int]], int | None]]) -> Column:
    """(option_type, npc_flag) of a menu option.

    rules: for each icon its option type, the flags of the owner that are tried
    in order as (mask, flag), and the flag when none is set. An icon without a
    rule, or whose flags fail without a fallback, gives nulls in what is unknown.
    """
    kind, flag = F.when(F.lit(False), F.lit(0)), F.when(F.lit(False), F.lit(0))
    for own, type_, tries, fallback in rules:
        got = functools.reduce(lambda c, t: c.when(has_any_flag(npc_flags, t[0]), t[1]), tries, F.when(F.lit(False), F.lit(0)))
        kind, flag = kind.when(icon == own, type_), flag.when(icon == own, got.otherwise(F.lit(fallback).cast("int")))
    return F.struct(kind.alias("option_type"), flag.alias("npc_flag"))


def spell_list_key(entry: Column, slot: Column) -> Column:
    return entry * 100 + slot


def difficulty_slot(difficulty: Column, table: dict[int, int]) -> Column:
    return chosen(difficulty, table, 0)


def hover_adjust(z: Column, hover: Column, hovering: Column) -> Column:
    return F.when((hover > 0) & hovering, z - hover).otherwise(z)


def health_pct(health: Column, most: Column, in_combat: Column) -> Column:
    """Whole-number division first, so anything short of full health is 0; 100 in combat or near death."""
    ratio = F.when(most != 0, F.floor(health / most) * 100)
    return F.when((health > 1) & ~in_combat, ratio).otherwise(100).cast("long")


def health_pct_exact(health: Column, most: Column) -> Column:
    """The percentage itself, null without a maximum."""
    return F.when(most != 0, F.round(health * 100 / most, 2))


#: Names of the eight slots by kind of shape (fixed order); empty slots are 0.
SHAPES = {
    "sphere": ("radius", "radius_target"),
    "box": ("x", "y", "z", "x_target", "y_target", "z_target"),
    "polygon": ("height", "height_target"),
    "cylinder": ("radius", "radius_target", "height", "height_target", "offset", "offset_target"),
    "disk": ("inner", "inner_target", "outer", "outer_target", "height", "height_target", "offset", "offset_target"),
    "plane": ("x", "y", "x_target", "y_target"),
}


def shape_data(kind: Column, values: Column) -> Column:
    """Eight slots from a map of named values, in the order of the kind; null for an unknown kind."""
    slots = {k: F.array(*(F.element_at(values, n).cast("double") for n in names), *([F.lit(0.0)] * (8 - len(names)))) for k, names in SHAPES.items()}
    return functools.reduce(lambda c, kv: c.when(kind == kv[0], kv[1]), slots.items(), F.when(F.lit(False), F.array(F.lit(0.0))))
