"""Exact deduplication over an extendible-hash index in shared files, in DataFrame operations only.

The key of a text is the 64-bit hash of its normalised form. The index has one
entry per key and length, with how many rows it stands for, so copies are summed
before anything is shuffled. Buckets are the leading bits of the key: where more
than `capacity` entries share a bucket, the directory doubles (one more bit)
until none is overfull. The entries are written bucket by bucket, each range of
buckets by one task, its owner.

Equal keys form a chain. Only chains of more than one row can hold copies. Their
texts are read again and placed by the index; equal ones are summed on the way, by
bucket, key, length and the text itself, so that two texts with one key stay
apart. What is left, one row for each distinct text, goes to the owners of the
bucket ranges, who name each text of a chain by its SHA-256 and check that no two
different ones go by the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, cut

#: The characters that are deleted before texts are compared (fixed values: [\\x20\\x09-\\x0D]).
DELETED = " \t\n\x0b\x0c\r"
#: Entries of a bucket before it splits.
CAPACITY = 4096
#: Bits of the directory at most; a bucket that is still overfull then is chained further.
MAX_DEPTH = 24


def normalised(text: Column) -> Column:
    """text without DELETED; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in DELETED:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def directory(entries: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(prefix, bucket, depth) for each leading pattern of `depth of the directory` bits of key, and that depth.

    Starts at the depth that fills buckets evenly and doubles while a bucket is
    overfull. Buckets that needn't split keep their smaller depth: several
    prefixes then point to one bucket, numbered by its first prefix. A count per
    prefix is all that is computed; the number of prefixes is about the number
    of entries over capacity.
    """
    n = entries.count()
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, n / capacity)))))
    while True:
        counts = entries.groupBy(prefix(F.col("key"), depth).alias("prefix")).agg(F.count("*").alias("n"))
        if depth >= MAX_DEPTH or not counts.where(F.col("n") > capacity).limit(1).count():
            break
        depth += 1
    own = F.col("prefix")
    above = [F.struct(F.lit(d).alias("depth"), F.call_function("shiftright", own, F.lit(depth - d)).alias("above"), "n") for d in range(depth)]
    if above:  # the shallowest bucket that isn't overfull
        fits = counts.select(F.inline(F.array(*above))).groupBy("depth", "above").agg(F.sum("n").alias("n")).where(F.col("n") <= capacity).select("depth", "above")
        of = F.explode(F.array(*(F.struct(F.lit(d).alias("depth"), F.call_function("shiftright", own, F.lit(depth - d)).alias("above")) for d in range(depth)))).alias("x")
        least = counts.select("prefix", of).select("prefix", "x.*").join(fits, ["depth", "above"]).groupBy("prefix").agg(F.min("depth").alias("depth"))
        counts = counts.join(least, "prefix", "left")
    else:
        counts = counts.withColumn("depth", F.lit(0))
    out = counts.select("prefix", F.coalesce("depth", F.lit(depth)).alias("depth"))
    shift = F.lit(depth) - F.col("depth")
    return out.select("prefix", F.call_function("shiftleft", F.call_function("shiftright", "prefix", shift), shift).alias("bucket"), "depth"), depth


def prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def index(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The written index over rows (key, length, ...): bucket, key, length, members; in bucket order, owners writing ranges."""
    entries = cut(rows.groupBy("key", "length").agg(F.count("*").alias("members")), "dedup-entries")
    where, depth = directory(entries, capacity)
    placed = entries.withColumn("prefix", prefix(F.col("key"), depth)).join(where, "prefix").drop("prefix", "depth")
    return cut(placed.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key"), "dedup-index")


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, hashed: object = F.xxhash64, row: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are. Of equal texts one row
    stays: the one with the most code points, then the smallest doc_id (null
    last), then the first in the files. Null counts as empty; empty and all-white
    texts are one group. Rows repeated with the same doc_id count each, and one
    of them at most stays. An empty table gives no rows. Other columns of docs
    are ignored.

    hashed: the 64-bit hash of the key; tests pass a weak one to force chains.
    row: a column of docs with an id for each row, in the order of the files; the
    verdicts have it as well.
    """
    plain = normalised(F.col(text))
    given = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = docs.select(given.alias("row"), F.col(key).alias("doc_id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("n"), plain.alias("plain"))
    rows = rows.select("row", "doc_id", "n", hashed("plain").alias("key"), F.octet_length("plain").alias("length"), F.sha2("plain", 256).alias("text_sha256"))
    rows = cut(rows, "dedup-rows")
    chains = index(rows, capacity).where("members > 1").select("bucket", "key", "length")

    members = docs.select(plain.alias("plain")).select("plain", hashed("plain").alias("key"), F.octet_length("plain").alias("length"))
    texts = members.join(bounded(chains), ["key", "length"]).groupBy("bucket", "key", "length", "plain").agg(F.count("*").alias("group_size"))
    owned = texts.repartitionByRange("bucket", "key").withColumn("text_sha256", F.sha2("plain", 256)).groupBy("bucket", "key", "length", "text_sha256")
    compared = owned.agg(F.count("*").alias("texts"), F.sum("group_size").alias("group_size"))
    one = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two different texts have one SHA-256")).cast("long"))
    sizes = compared.select("key", "length", "text_sha256", one.alias("group_size")).where("group_size > 1")

    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    same = ["key", "length", "text_sha256"]
    groups = rows.join(bounded(chains.select("key", "length")), ["key", "length"], "left_semi").groupBy(*same).agg(best.alias("best"))
    groups = cut(groups.join(sizes, same).select(*same, "group_size", F.col("best.doc_id").alias("best_id"), F.col("best.row").alias("best_row")), "dedup-groups")
    alone = F.col("group_size").isNull()
    return rows.join(bounded(groups), same, "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("row") == F.col("best_row"))).alias("kept"),
        "text_sha256",
        *([] if row is None else [F.col("row").alias(row)]),
    )
