"""The registered queries of this subpackage, each over a whole table, and their SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, exact_dedup, language_id, license_scan, merge_replay, packing, quality, secret_scan, sharding, simhash, spelling, token_store
from .common import documents, scratch_path

#: Vocabulary files of the queries.
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
END_ID = 2
BYTE_RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def tokenizer(spark: SparkSession, name: str) -> bpe.Tokenizer:
    return bpe.Tokenizer(spark, str(public_tokenizers.path(name)))


def ranks(spark: SparkSession) -> merge_replay.Ranks:
    return merge_replay.Ranks(spark, str(public_tokenizers.path(BYTE_RANKS)), public_tokenizers.PATTERN)


def pair(spark: SparkSession) -> alignment.Pair:
    return alignment.Pair(spark, str(public_tokenizers.path(BYTE_BPE)), str(public_tokenizers.path(PIECES)))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = tokenizer(spark, BYTE_BPE)
    ids = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), own).select("doc_id", "ids")
    both = bpe.decode(ids, own)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer(spark, WORD_BPE), END_ID)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir))


def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-orc")
    token_store.write_tokens(documents(spark, sf_dir), tokenizer(spark, WORD_BPE), END_ID, path)
    return token_store.token_digests(token_store.read_tokens(spark, path))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a tree of files: source/id, and for ids not divisible by 5 source/(id div 500)/id.

    Of either, the ids that leave 0 or 1 divided by 5 are called LICENSE.id, so they speak for their folder if they have a licence.
    """
    docs = documents(spark, sf_dir)
    folder = F.when(F.col("doc_id") % 5 == 0, F.col("source")).otherwise(F.concat_ws("/", "source", F.floor(F.col("doc_id") / 500)))
    name = F.concat(F.when(F.col("doc_id") % 5 < 2, "LICENSE.").otherwise(""), F.col("doc_id").cast("string"))
    files = docs.select("doc_id", F.concat_ws("/", folder, name).alias("path"), "text")
    return license_scan.scanned(files, key="doc_id").withColumnRenamed("licence_key", "licence_doc_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    third = language_id.crc_third(F.col("doc_id"))
    models = language_id.learn(docs.where((third != 1) & F.col("lang").isNotNull()).select("doc_id", "text", "lang"))
    out = language_id.identify(docs, models)
    return out.select("doc_id", (third == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(documents(spark, sf_dir))


def op10_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(documents(spark, sf_dir)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted(spelling.damaged(spelling.runs(documents(spark, sf_dir)))))


def op12_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = ranks(spark)
    both = merge_replay.decode(merge_replay.encode(documents(spark, sf_dir).select("doc_id", "text"), own).select("doc_id", "ids"), own)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(documents(spark, sf_dir), pair(spark))


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


#: Every window of every text is compared here, without the words that let the operator leave most of them out.
LICENCE_SQL = rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source, CASE WHEN doc_id % 5 = 0 THEN source ELSE source || '/' || doc_id // 500 END AS folder,
            CASE WHEN doc_id % 5 < 2 THEN 'LICENSE.' ELSE '' END || doc_id AS name, doc_id % 5 < 2 AS speaks FROM documents),
    line AS (SELECT doc_id, i, list_filter(list_transform(regexp_split_to_array(lower(x), '[^a-z0-9.-]+'), lambda y: trim(y, '.-')), lambda y: y <> '') AS ws
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM d)),
    unit AS (SELECT doc_id, size, b, flatten(list(ws ORDER BY i)) AS ws FROM (
            SELECT doc_id, size, i, ws, unnest(range((greatest(i - size + 1, 0) + step - 1) // step, i // step + 1)) * step AS b
            FROM line, (SELECT w AS size, greatest(1, w // 4) AS step FROM (VALUES {", ".join(f"({w})" for w in license_scan.WINDOWS)}) AS v(w)))
        GROUP BY ALL HAVING true
        UNION ALL SELECT doc_id, 0, 0, flatten(list(ws ORDER BY i)) FROM line GROUP BY 1),
    kind AS (SELECT ws, row_number() OVER () AS k FROM (SELECT DISTINCT ws FROM unit)),
    tf AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(ws) AS term FROM kind) GROUP BY 1, 2),
    df AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(ws) AS term FROM line) GROUP BY 1),
    tot AS (SELECT count(*) AS n FROM d),
    idf AS (SELECT term, ln((n + 1) / (df + 1)) + 1 AS idf FROM df, tot),
    m AS (SELECT t, licence, term, count(*) AS n FROM (SELECT t, licence, unnest(list_filter(list_transform(regexp_split_to_array(lower(notice), '[^a-z0-9.-]+'), lambda y: trim(y, '.-')), lambda y: y <> '')) AS term
        FROM (VALUES {", ".join(f"({k}, {quoted(a)}, {quoted(b)})" for k, (a, b) in enumerate(license_scan.TEMPLATES))}) AS v(t, licence, notice)) GROUP BY 1, 2, 3),
    mw AS (SELECT t, licence, m.term, m.n * coalesce(idf, ln(tot.n + 1.0) + 1) AS m FROM m CROSS JOIN tot LEFT JOIN idf ON m.term = idf.term),
    mm AS (SELECT mw.t, licence, term, m / l AS m FROM mw JOIN (SELECT t, sqrt(sum(m * m)) AS l FROM mw GROUP BY 1) x ON x.t = mw.t),
    w AS (SELECT k, tf.term, tf * idf AS w FROM tf JOIN idf ON tf.term = idf.term),
    c AS (SELECT w.k, licence, round(sum(w * m) / any_value(norm), 6) AS cosine FROM w JOIN mm ON w.term = mm.term JOIN (SELECT k, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1) x ON x.k = w.k GROUP BY w.k, mm.t, licence),
    o AS (SELECT doc_id, arg_min(licence, struct_pack(a := -cosine, b := licence)) AS licence, max(cosine) AS cosine FROM unit JOIN kind ON unit.ws = kind.ws JOIN c ON c.k = kind.k WHERE cosine >= {license_scan.SIMILAR} GROUP BY 1),
    p AS (SELECT d.doc_id, folder || '/' || name AS path, folder, source, speaks, o.licence, o.cosine FROM d LEFT JOIN o ON d.doc_id = o.doc_id),
    s AS (SELECT folder, arg_min(struct_pack(l := licence, c := cosine, d := doc_id, p := path), struct_pack(a := -cosine, b := path)) AS s FROM p WHERE speaks AND licence IS NOT NULL GROUP BY 1),
    u AS (SELECT p.*, CASE WHEN p.licence IS NULL THEN coalesce(near.s, far.s) END AS up FROM p LEFT JOIN s near ON near.folder = p.folder LEFT JOIN s far ON far.folder = p.source)
    SELECT doc_id, path, coalesce(licence, up.l) AS licence, coalesce(cosine, up.c) AS cosine, CASE WHEN licence IS NOT NULL THEN 'own' WHEN up IS NOT NULL THEN 'inherited' END AS origin,
        CASE WHEN licence IS NOT NULL THEN path ELSE up.p END AS licence_path, CASE WHEN licence IS NOT NULL THEN doc_id ELSE up.d END AS licence_doc_id FROM u
"""


def either_case(pattern: str) -> str:
    """pattern with each letter of its (?i:...) groups as a class of two: ASCII alone, as some engines fold more."""
    out, depth, at = "", 0, 0
    while at < len(pattern):
        if not depth and pattern.startswith("(?i:", at):
            out, depth, at = out + "(?:", 1, at + 4
            continue
        c = pattern[at]
        depth += depth and (c == "(") - (c == ")")
        out += f"[{c}{c.upper()}]" if depth and c.isalpha() else c
        at += 1
    return out


def found_sql(kind: str, pattern: str, group: int, keep: str) -> str:
    """(r, kind, s, e) of each match of pattern in d (r, t): places from the lengths of the matches and of what lies between them."""
    p = quoted(either_case(pattern))
    return f"""
        SELECT r, '{kind}' AS kind, e - length(m) AS s, e FROM (
            SELECT r, x[2] AS m, x[3] AS g, CAST(sum(length(x[2]) + length(x[4])) OVER (PARTITION BY r ORDER BY CAST(x[1] AS INTEGER)) AS BIGINT) AS e
            FROM (SELECT r, unnest(list_transform(range(1, len(ms) + 1), lambda i: [CAST(i AS VARCHAR), ms[i], gs[i], gaps[i]])) AS x
                FROM (SELECT r, regexp_extract_all(t, {p}) AS ms, regexp_extract_all(t, {p}, {group}) AS gs, regexp_split_to_array(t, {p}) AS gaps FROM d))) WHERE {keep}"""


#: Weak candidates are maximal runs here, so no pattern has to look around.
SECRET_SQL = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    base AS ({found_sql("assign", secret_scan.ASSIGN, 2, "length(g) >= 6")} UNION ALL {found_sql("access", secret_scan.ACCESS, 0, "length(m) >= 20")} UNION ALL {found_sql("hex", "[0-9a-f]+", 0, "length(m) >= 24")}),
    weak AS ({found_sql("weak", "[A-Za-z0-9+/_-]{16,}", 0, "regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')")}),
    names AS ({found_sql("name", secret_scan.IDENTIFIER, 0, "true")} UNION ALL SELECT * FROM base WHERE kind = 'access'),
    ends AS ({found_sql("end", secret_scan.ENDPOINT, 0, "true")}),
    linked AS (SELECT * FROM weak w WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = w.r AND b.s < w.e AND w.s < b.e)
        AND EXISTS (SELECT 1 FROM names n WHERE n.r = w.r AND n.s BETWEEN w.s - {secret_scan.SCOPE} AND w.e + {secret_scan.SCOPE}) AND EXISTS (SELECT 1 FROM ends n WHERE n.r = w.r AND n.s BETWEEN w.s - {secret_scan.SCOPE} AND w.e + {secret_scan.SCOPE})),
    every AS (SELECT r, kind, s, list_position(['assign', 'access', 'hex', 'weak'], kind) AS k, kind || ':' || s || ':' || e AS x FROM (SELECT * FROM base UNION ALL SELECT * FROM linked)),
    g AS (SELECT r, string_agg(x, ',' ORDER BY s, k) AS spans, string_agg(x, ',' ORDER BY s, k) FILTER (k < 4) AS base, count(*) FILTER (k = 1) AS a, count(*) FILTER (k = 2) AS b, count(*) FILTER (k = 3) AS c FROM every GROUP BY 1)
    SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g ON g.r = d.r
"""

#: CRC-32 byte by byte; near words by the code points that they lose or change, without any bigram. The chain of forms is at most as long as counts can double.
SPELLING_SQL = r"""
    WITH RECURSIVE tab AS (SELECT i, i AS c, 0 AS k FROM range(256) AS r(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM tab WHERE k < 8),
    byte AS (SELECT list(c ORDER BY i) AS t FROM tab WHERE k = 8),
    run AS (SELECT doc_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS x FROM documents)),
    kind AS (SELECT x, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || x) AS b, count(*) AS n FROM run GROUP BY doc_id, x),
    summed AS (SELECT x, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(b), 2), lambda i: CAST(16 * strpos('0123456789ABCDEF', b[i]) + strpos('0123456789ABCDEF', b[i + 1]) - 17 AS BIGINT))),
        lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) AS h FROM kind, byte),
    word AS (SELECT CASE WHEN h % 97 = 0 THEN substr(x, 1, h % length(x)) || substr(x, h % length(x) + 2) ELSE x END AS word, n FROM summed),
    w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM word WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
    less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
    pair AS (SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT a.word, w.word, w.n FROM less a JOIN w ON a.rest = w.word UNION SELECT w.word, a.word, a.n FROM less a JOIN w ON a.rest = w.word),
    best AS (SELECT word, count(*) AS n_near, arg_min(struct_pack(form := other, form_n := other_n), struct_pack(a := -other_n, b := other)) AS f FROM pair GROUP BY 1),
    formed AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN f.form_n >= 2 * n THEN f.form END AS form, CASE WHEN f.form_n >= 2 * n THEN f.form_n END AS form_n FROM w LEFT JOIN best ON w.word = best.word),
    chain AS (SELECT word, word AS reached, 0 AS k FROM formed UNION ALL SELECT chain.word, form, k + 1 FROM chain JOIN formed ON formed.word = chain.reached WHERE form IS NOT NULL)
    SELECT f.word, n, n_near, form, form_n, root FROM formed f JOIN (SELECT word, arg_max(reached, k) AS root FROM chain GROUP BY 1) c ON c.word = f.word
"""

QUERIES = {f.__name__: f for f in (op1_bpe, op2_packing, op3_exact_dedup, op4_simhash, op5_token_orc, op6_license_scan, op7_quality, op8_language_id, op9_hilbert_shards, op10_secret_links, op11_spelling, op12_merge_replay, op13_alignment)}

ORACLE_SQL = {
    "op3_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS p FROM documents),
        g AS (SELECT p, count(*) AS group_size, arg_min(doc_id, struct_pack(a := -n, b := doc_id)) AS keep_id FROM d GROUP BY p)
        SELECT d.doc_id, keep_id, group_size, d.doc_id = keep_id AS kept, sha256(d.p) AS text_sha256 FROM d JOIN g USING (p)
    """,
    "op7_quality": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, t FROM d),
        word AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
        win AS (SELECT doc_id, i, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS g FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        twice AS (SELECT doc_id, i FROM win WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2),
        rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id),
        line AS (SELECT doc_id, x FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
        dup AS (SELECT doc_id, count(*) AS lines, count(*) - count(DISTINCT x) AS n FROM line GROUP BY doc_id),
        f AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
            length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_chars, coalesce(dup.lines, 0) AS lines
            FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id)),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND 10 * n_symbols <= n_words AND 2 * n_dup_lines <= lines AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 2 * upper_chars <= word_chars AS kept
        FROM b
    """,
    "op6_license_scan": LICENCE_SQL,
    "op10_secret_links": SECRET_SQL,
    "op11_spelling": SPELLING_SQL,
}
