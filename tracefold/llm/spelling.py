"""Spelling variant grouping: words within one edit, found through pivotal grams.

All bigrams of all words have one order, rare ones first. The prefix of a word
holds its three rarest bigrams (and others as common as the third): one edit
touches at most two, so near words share one. Two bigrams of the prefix that
don't overlap are the word's pivots, chosen by dynamic programming over the
prefix in the order of places, so that they are as rare as can be in sum; one
edit spoils at most one of them. So of two near words, the one whose prefix ends
earlier in the order has a pivot that stands in the other's prefix.

The edit lies before or after that bigram, and the text on the other side is
the same, which fixes the bigram's place: the index has an entry for either side
of each bigram of a prefix, by bigram, that side's text and the word's length.
Pivots are looked up with lengths that differ by one at most; what is found is
verified. All is joins and sums of columns, spread by bigram, side and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, cut

#: Maximal runs of letters (fixed value).
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every so manieth run, by checksum, loses a code point.
DAMAGED = 97
#: Code points and occurrences of a word at least. Three prefix bigrams need four code points.
MIN_LENGTH, MIN_COUNT = 5, 3
#: Bigrams that one edit can touch, and one more.
PREFIX = 3
#: A form occurs at least so many times as often as what it is the form of.
DOMINANT = 2


def runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and run: each maximal run of letters of text, A-Z lower-cased. Null texts have none; repeated rows count again."""
    found = F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run")).withColumn("run", F.translate("run", UPPER, LOWER))


def damaged(found: DataFrame) -> DataFrame:
    """word for each run of found (doc_id, run): the run, less a code point where DAMAGED divides the checksum of `<doc_id>:<run>`. A null doc_id is the empty text there."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    with_sum = found.withColumn("h", F.crc32(F.encode(key, "UTF-8")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return with_sum.select(F.when(F.col("h") % DAMAGED == 0, less).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the distinct words of min_length code points and min_count occurrences at least, summed before the shuffle."""
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def order_of(x: Column) -> Column:
    """The place of a bigram in the common order: rare ones first."""
    return F.struct(x["freq"].alias("freq"), x["gram"].alias("gram"))


def pivots(prefix: Column) -> Column:
    """The two bigrams of a prefix (an array of freq, gram, at) that don't overlap and whose frequencies have the smallest sum; ties go to the earlier places.

    Dynamic programming from left to right: before holds the best single bigram
    that ends before the last one begins its second character, upto the best of
    all so far, both the best pair.
    """
    one = "struct<freq:long,gram:string,at:int>"
    start = F.struct(F.lit(None).cast(one).alias("before"), F.lit(None).cast(one).alias("upto"), F.lit(-2).alias("last"), F.lit(None).cast(f"struct<cost:long,first:{one},second:{one}>").alias("both"))

    def step(s: Column, x: Column) -> Column:
        x = F.struct(x["freq"].alias("freq"), x["gram"].alias("gram"), x["at"].alias("at"))
        free = F.when(x["at"] >= s["last"] + 2, s["upto"]).otherwise(s["before"])
        pair = F.when(free.isNotNull(), F.struct((free["freq"] + x["freq"]).alias("cost"), free.alias("first"), x.alias("second")))
        return F.struct(s["upto"].alias("before"), F.least(s["upto"], x).alias("upto"), x["at"].alias("last"), F.least(s["both"], pair).alias("both"))

    by_place = F.array_sort(prefix, lambda x, y: x["at"] - y["at"])
    return F.aggregate(by_place, start, step, lambda s: F.array(s["both"]["first"], s["both"]["second"]))


def letters(word: Column) -> Column:
    """A bit for each code point of word, modulo 64; one edit changes two at most."""
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(x) % 64)))


def signatures(words: DataFrame) -> DataFrame:
    """(word, size, letters, prefix, last, pivots) of words (word) with four code points or more; last is the place in the order where the prefix ends."""
    grams = words.select("word", F.length("word").alias("size"), F.posexplode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))).alias("at", "gram"))
    freq = cut(grams.groupBy("gram").agg(F.count("*").alias("freq")), "gram-freq")
    placed = grams.join(bounded(freq), "gram").groupBy("word", "size").agg(F.sort_array(F.collect_list(F.struct("freq", "gram", "at"))).alias("grams"))
    last = order_of(F.col("grams")[PREFIX - 1])
    ended = placed.withColumn("last", last).withColumn("prefix", F.filter("grams", lambda x: order_of(x) <= F.col("last")))
    return ended.select("word", "size", letters(F.col("word")).alias("letters"), "last", "prefix", pivots(F.col("prefix")).alias("pivots"))


def sides(x: Column) -> Column:
    """For a bigram x of word: its two entries (gram, side, rest), by the text before it and after it."""
    before, after = F.substring("word", F.lit(1), x["at"]), F.substring("word", x["at"] + 3, F.length("word"))
    return F.array(*(F.struct(x["gram"].alias("gram"), F.lit(k).alias("side"), rest.alias("rest")) for k, rest in enumerate((before, after))))


def candidates(signed: DataFrame) -> DataFrame:
    """(word, other): pairs of words of which one has a pivot in the other's prefix at a place that one edit allows; a pair comes up to a few times."""
    index = signed.select(F.col("word").alias("other"), F.col("last").alias("other_last"), F.col("size").alias("other_size"), F.col("letters").alias("other_letters"), F.inline(F.flatten(F.transform("prefix", sides))))
    asked = signed.select("word", "last", "size", "letters", F.inline(F.flatten(F.transform("pivots", sides))))
    asked = asked.withColumn("other_size", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)))
    alike = F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 2  # before the words themselves are looked at
    met = asked.join(index, ["gram", "side", "rest", "other_size"]).where(alike & (F.col("last") <= F.col("other_last")) & (F.col("word") != F.col("other")))
    return met.select("word", "other")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other), each pair once with word < other: all pairs of distinct words (word) that differ by exactly one inserted, deleted or replaced code point.

    Words have four code points or more. No candidate is left out.
    """
    signed = cut(signatures(words), "gram-signatures")
    pairs = candidates(signed).where(F.levenshtein("word", "other", 1) == 1)
    return pairs.select(F.least("word", "other").alias("word"), F.greatest("word", "other").alias("other")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each word of forms (word, form): the last that its forms lead to. Chains double in length each round."""
    up = cut(forms.select("word", F.col("form").alias("root")), "form-roots")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = cut(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "form-roots")
        up = jumped.select("word", "root")
        if not jumped.where("moved").limit(1).count():
            return up


def variants(counts: DataFrame) -> DataFrame:
    """counts (word, n; each word once, of four code points or more) with n_near, form, form_n and root.

    Words are near that differ by exactly one inserted, deleted or replaced code
    point. A word's form is its near word of largest n (ties: the smallest in
    code-point order), if that n is DOMINANT times the word's n at least, else
    null. root follows forms to the last; the word itself if there is none. An
    empty table gives no rows; other columns of counts are ignored.
    """
    counts = cut(counts.select("word", "n"), "word-counts")
    pairs = cut(near_pairs(counts.select("word")), "near-words")
    other = counts.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    ways = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    best = ways.join(other, "other").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    named = counts.join(best, "word", "left")
    dominant = -F.col("best.less") >= DOMINANT * F.col("n")
    formed = cut(
        named.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(dominant, F.col("best.form")).alias("form"), F.when(dominant, -F.col("best.less")).alias("form_n")),
        "word-forms",
    )
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
