"""Secret scans with multipart credential linking, in DataFrame operations only.

Base findings stand alone: an assigned password or token, an access identifier, a
long hexadecimal run. Weak candidates (a mixed run of letters and digits that
alone means nothing) are reported only where complementary parts lie in the same
scope: an access identifier or user name, and an endpoint, each within SCOPE
characters. Candidates are joined to the parts by the bins of SCOPE characters
that their neighbourhoods touch, as semi joins, so no pairs are made.

Positions are code points. Spark's pattern functions give the matches and the
pieces between them; the running sum of both lengths is where each match is.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, cut

#: Patterns (fixed values). Of a match, group 2 (assign) or the whole must have the least number of characters.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: A run of 24 or more is what is left of [0-9a-f]+ when shorter ones are dropped, as runs never overlap.
HEX_LONG = r"[0-9a-f]{24,}"
#: What assignments can start with; texts without any are not searched.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Kinds in the order in which findings at one place are listed.
KINDS = ("assign", "access", "hex", "weak")
#: Complementary parts: names of users or clients, and endpoints.
IDENTIFIER = r"""(?i:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.=-]{3,}"""
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{1,20}://[A-Za-z0-9.-]+(?::[0-9]+)?|(?i:host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}"""
#: A weak candidate: 16 or more characters with a lower-case letter, an upper-case letter and a digit.
WEAK = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}"
#: Characters between a candidate and its complementary parts at most.
SCOPE = 400


SPAN = "array<struct<start:int,end:int>>"
#: Matches whose places are summed together; a text's blocks are then summed.
BLOCK = 256


def places(pieces: Column) -> Column:
    """(start, end) of each of pieces, an array of (gap, own, ok): the lengths before and of each match; only those that are ok."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int")), lambda b: F.slice(pieces, b * BLOCK + 1, F.lit(BLOCK)))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["gap"]
        end = start + x["own"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["ok"], F.concat(s["out"], span)).otherwise(s["out"]).alias("out"))

    inner = F.transform(blocks, lambda b: F.aggregate(b, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")), step))

    def shift(s: Column, x: Column) -> Column:
        moved = F.transform(x["out"], lambda y: F.struct((y["start"] + s["at"]).alias("start"), (y["end"] + s["at"]).alias("end")))
        return F.struct((s["at"] + x["at"]).alias("at"), F.concat(s["out"], moved).alias("out"))

    return F.aggregate(inner, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")), shift, lambda s: s["out"])


def located(text: Column, pattern: str, least: int = 1, group: int = 0) -> Column:
    """Every match of pattern in text, leftmost first and apart from each other, as (start, end) in code points.

    Matches whose group has fewer than least characters are dropped, though what
    they cover stays covered. Array arguments are passed whole to zip_with, so
    each pattern runs once over a text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(found, F.split(text, pattern, -1), lambda m, gap: F.when(m.isNotNull(), F.struct(F.length(gap).alias("gap"), F.length(m).alias("own"))))
    if group:
        pieces = F.zip_with(pieces, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x, g: F.when(x.isNotNull(), F.struct(x["gap"].alias("gap"), x["own"].alias("own"), (F.length(g) >= least).alias("ok"))))
    else:
        pieces = F.transform(pieces, lambda x: F.when(x.isNotNull(), F.struct(x["gap"].alias("gap"), x["own"].alias("own"), (x["own"] >= least).alias("ok"))))
    return places(F.filter(pieces, lambda x: x.isNotNull()))



def findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """The written table of what each text holds: doc_id, texthash, row, and arrays of (start, end): assign, access, hex, weak, identifier, endpoint.

    A kind's pattern runs only on texts that a cheaper test lets through. Weak
    candidates and their parts are sought only in texts that have all of them.
    """
    none = F.array().cast(SPAN)
    body, lower = F.col("body"), F.lower("body")
    any_of = lambda xs: functools.reduce(lambda a, b: a | b, [F.contains(lower, F.lit(x)) for x in xs])
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("body"))
    has_parts = any_of(("://", "host", "server", "endpoint")) & body.rlike(ENDPOINT) & (F.contains(body, F.lit("AKIA")) | any_of(("user", "login", "account", "client", "access")) & body.rlike(IDENTIFIER)) & body.rlike(WEAK)
    out = rows.select(
        "doc_id",
        F.xxhash64("body").alias("texthash"),
        F.when(any_of(KEYWORDS), located(body, ASSIGN, LEAST["assign"], 2)).otherwise(none).alias("assign"),
        F.when(F.contains(body, F.lit("AKIA")), located(body, ACCESS, LEAST["access"])).otherwise(none).alias("access"),
        F.when(body.rlike(f"[0-9a-f]{{{LEAST['hex']}}}"), located(body, HEX_LONG, LEAST["hex"])).otherwise(none).alias("hex"),
        F.when(has_parts, located(body, WEAK)).otherwise(none).alias("weak"),
        F.when(has_parts, located(body, IDENTIFIER)).otherwise(none).alias("identifier"),
        F.when(has_parts, located(body, ENDPOINT)).otherwise(none).alias("endpoint"),
    )
    return cut(out.withColumn("row", F.monotonically_increasing_id()), "secret-findings")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row, weak): the weak candidates with an identifier and an endpoint within scope characters, apart from base findings."""
    names = F.concat("identifier", "access")
    rich = found.where((F.size("weak") > 0) & (F.size(names) > 0) & (F.size("endpoint") > 0))
    every = F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))).alias("bin")
    weak = rich.select("row", F.inline("weak"))
    base = rich.select(F.col("row").alias("of"), F.inline(F.concat("assign", "access", "hex"))).select("of", F.col("start").alias("from"), F.col("end").alias("to"), every.alias("in"))
    cut_up = weak.select("row", "start", "end", every)
    taken = cut_up.join(base, (cut_up["row"] == base["of"]) & (cut_up["bin"] == base["in"]) & (base["from"] < cut_up["end"]) & (cut_up["start"] < base["to"]), "left_semi")
    left = weak.join(taken.select("row", "start", "end").distinct(), ["row", "start", "end"], "left_anti")
    for parts in (names, F.col("endpoint")):
        near = rich.select(F.col("row").alias("of"), F.inline(parts)).select("of", F.col("start").alias("at"), F.floor(F.col("start") / scope).alias("in"))
        bins = F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))).alias("bin")
        left = left.select("row", "start", "end", bins)
        left = left.join(near, (left["row"] == near["of"]) & (left["bin"] == near["in"]) & near["at"].between(left["start"] - scope, left["end"] + scope), "left_semi").select("row", "start", "end").distinct()
    return left.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("linked"))


def spans_of(found: DataFrame, kinds: dict[str, str]) -> Column:
    """Sorted (start, rank, end, kind) of the array columns in kinds (kind: column)."""
    def ranked(kind: str, column: str) -> Column:
        return F.transform(column, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    every = [ranked(kind, column) for kind, column in kinds.items()]
    return F.sort_array(F.concat(*every))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secrets(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans (text), texthash, found (array of spans).

    Positions are code points, ends exclusive. A null or empty text has no
    findings (an empty spans). Repeated rows are searched each by itself. Texts
    of any length are searched whole. An empty table gives no rows. Other columns
    of docs are ignored.
    """
    found = findings(docs, text)
    joined = found.join(bounded(cut(linked(found, scope), "secret-links")), "row", "left").withColumn("linked", F.coalesce("linked", F.array().cast(SPAN)))
    base = {k: k for k in KINDS[:3]}
    return joined.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(as_text(spans_of(joined, base)), 256).alias("base_sha256"),
        as_text(spans_of(joined, base | {"weak": "linked"})).alias("spans"),
        "texthash",
        spans_of(joined, base | {"weak": "linked"}).alias("found"),
    )


def redacted(docs: DataFrame, text: str = "text", mark: str = "[REDACTED]", scope: int = SCOPE) -> DataFrame:
    """docs with every finding in text replaced by mark (overlapping ones by one), n_chars counted anew where there is such a column.

    No row goes: null and empty texts and texts without findings stay as they
    are, with their n_chars. Texts of any length are read whole; repeated rows
    are redacted alike. An empty table gives no rows. All columns of docs pass
    through, whatever their names.
    """
    hits = secrets(docs, text, scope).where(F.size("found") > 0).select(F.col("doc_id").alias("__id"), F.col("texthash").alias("__hash"), F.col("found").alias("__found")).dropDuplicates(["__id", "__hash"])
    hits = cut(hits, "secret-hits")
    joined = docs.join(bounded(hits), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("__hash")), "left")

    def step(s: Column, x: Column) -> Column:
        fresh = x["start"] >= s["at"]
        before = F.substring(F.col(text), s["at"] + 1, x["start"] - s["at"])
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(fresh, F.concat(s["out"], F.array(before, F.lit(mark)))).otherwise(s["out"]).alias("out"))

    rest = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col(text), s["at"] + 1, F.length(F.col(text))))
    clean = F.aggregate("__found", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, rest)
    # Under a name of its own first: in one select, `text` inside the lambdas could also mean the new column.
    joined = joined.withColumn("__clean", F.when(F.col("__found").isNull(), F.col(text)).otherwise(clean))
    new = {text: F.col("__clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__found").isNull(), F.col("n_chars")).otherwise(F.length("__clean").cast(docs.schema["n_chars"].dataType))
    return joined.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))
