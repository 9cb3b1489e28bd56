"""The registered queries of this subpackage, and the SQL that gives the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmeld.functions.binding import bind
from jobmeld.llm import bpe, decontam, hosts, langid, lexical, licenses, lmscore, periodic, quality, sharding, simhash, tokenfile, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The URL rules of the query
URL_RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_pseudo_likelihood")
def _(spark, sf):
    return lmscore.score(table(spark, sf, "documents"))


@query("op2_language_id")
def _(spark, sf):
    return langid.identify(table(spark, sf, "documents")).drop("r1", "r2")


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(sha, {1 + 10 * part}, 10))::BIGINT >> {35 - 5 * k}) & 31)::INT, 1)"
    for part in range(4)
    for k in range(8)
)


@query(
    "op3_warc_round_trip",
    f"""
    WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS sha, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
    q AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS chosen FROM p)
    SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
      CASE WHEN page_id < chosen THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN page_id < chosen THEN chosen END AS refers_to FROM q
    """,
)
def _(spark, sf):
    return warc.round_trip(table(spark, sf, "pages")).drop("intact")


@query("op4_token_files")
def _(spark, sf):
    return tokenfile.round_trip(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)


@query("op5_license_scan")
def _(spark, sf):
    return licenses.scan(table(spark, sf, "documents")).drop("spans")


@query("op6_simhash")
def _(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


_WORD = r"[^\x20\x09-\x0D]+"


@query(
    "op7_quality_hosts",
    rf"""
    WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
    s AS (SELECT doc_id, regexp_extract_all(text, '{_WORD}') AS ws FROM t),
    w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM s),
    g AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p AS k
          FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
    r AS (SELECT doc_id, k FROM g WHERE k IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
    h AS (SELECT doc_id, count(DISTINCT j) AS n FROM
          (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g JOIN r USING (doc_id, k)) GROUP BY doc_id),
    l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM
          (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
          WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
    c AS (SELECT t.doc_id, source, len(ws)::BIGINT AS n_words,
            length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
            coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(h.n, 0)::BIGINT AS n_repeat_words
          FROM t JOIN s USING (doc_id) LEFT JOIN h USING (doc_id) LEFT JOIN l USING (doc_id)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 10 * n_symbols > n_words OR word_chars > 15 * n_words
        OR word_chars < 2 * n_words OR 20 * n_dup_lines > n_words OR 5 * n_repeat_words > n_words AS strict_failed FROM c),
    hosts AS (SELECT source, count(*)::DOUBLE AS n, sum((base_failed OR strict_failed)::INT)::DOUBLE AS f FROM b GROUP BY source),
    sums AS (SELECT sum(n) AS nn, sum(f) AS ff, sum(n * n) AS qq, count(*) AS hh, sum(f * f / n) AS ss FROM hosts),
    prior AS (SELECT nn, ff, (ff + 0.5) / (nn + 1) AS m, nn - qq / nn AS room, hh, ss FROM sums),
    beyond AS (SELECT *, CASE WHEN room > 0 THEN (ss - ff * ff / nn - (hh - 1) * m * (1 - m)) / room ELSE 0 END AS v FROM prior),
    beta AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), nn) ELSE nn END AS k FROM beyond),
    rates AS (SELECT source, m, (f + m * k) / (n + k) AS rate, n + k AS size FROM hosts, beta),
    marks AS (SELECT source, rate - 2 * sqrt(rate * (1 - rate) / (size + 1)) > m AS host_failed,
                rate + 2 * sqrt(rate * (1 - rate) / (size + 1)) < m AS host_trusted FROM rates)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, strict_failed, host_failed, host_trusted,
      NOT base_failed AND (host_trusted OR NOT strict_failed) AS kept
    FROM b JOIN marks ON b.source IS NOT DISTINCT FROM marks.source
    """,
)
def _(spark, sf):
    return quality.judge(table(spark, sf, "documents")).drop("r1", "r2")


_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op8_decontaminate",
    rf"""
    WITH b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ws FROM benchmark),
    bl AS (SELECT item_id, ws, least(len(ws), 13) AS size FROM b WHERE len(ws) > 0),
    win AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(ws, k, k + size - 1), ' ') AS key
            FROM (SELECT item_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS k FROM bl)),
    d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ws FROM documents),
    dw AS (SELECT doc_id, size, k, array_to_string(list_slice(ws, k, k + size - 1), ' ') AS key
           FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS k
                 FROM d, (SELECT DISTINCT size FROM win) WHERE len(ws) >= size)),
    hit AS (SELECT doc_id, k, item_id, dw.size FROM dw JOIN win USING (size, key)),
    pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM hit) GROUP BY doc_id),
    its AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id),
    dp AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM d),
    often AS (SELECT word, count(*) AS n FROM dp GROUP BY word),
    ip AS (SELECT item_id, size, len(ws) AS all_words, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM bl),
    iw AS (SELECT item_id, size, i, word, coalesce(n, 0) AS n, unnest(range(greatest(i - size + 1, 0), least(i, all_words - size) + 1)) AS w
           FROM ip LEFT JOIN often USING (word)),
    few AS (SELECT *, row_number() OVER (PARTITION BY item_id, w ORDER BY n, i) AS nth, min(n) OVER (PARTITION BY item_id, w) AS least_n FROM iw),
    shifts AS (SELECT doc_id, item_id, w, i, least(size, {decontam.RAREST}) AS k, pos - i AS s FROM few JOIN dp USING (word)
               WHERE least_n > 0 AND nth <= {decontam.RAREST}),
    bins AS (SELECT *, unnest([floor(s / {2.0 * decontam.SLOP}) * 2, floor((s + {decontam.SLOP}) / {2.0 * decontam.SLOP}) * 2 + 1]) AS bin FROM shifts),
    close AS (SELECT doc_id, item_id FROM bins GROUP BY doc_id, item_id, w, bin HAVING count(DISTINCT i) = any_value(k)),
    near AS (SELECT doc_id, count(DISTINCT item_id) AS n FROM close GROUP BY doc_id)
    SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(pos.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AND 20 * coalesce(pos.n, 0) >= len(ws) AS contaminated,
      coalesce(near.n, 0)::BIGINT AS n_near_items
    FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN near USING (doc_id)
    """,
)
def _(spark, sf):
    found = decontam.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        decontam.contaminated().alias("contaminated"), "n_near_items",
    )


_RULE_CASE = " ".join(
    f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
    for r, _ in sorted(URL_RULES, key=lambda r: (len(r[0]), r[0]), reverse=True)
)
_SUFFIX_CASE = " ".join(f"WHEN ends_with(host, '.{s}') THEN '{s}'" for s in sorted(hosts.SUFFIXES, key=len, reverse=True))
_BLOCKING = ", ".join(f"'{r}'" for r, v in URL_RULES if v == "block")


def _sql_level(name: str, children: str) -> str:
    """Prior strength of a level, from rows (n, bad, mean) of `children`."""
    return f"""{name} AS (SELECT CASE WHEN nodes = 0 THEN 1.0 WHEN off > chance
        THEN least(greatest((chance / nodes) / ((off - chance) / total) - 1, 1.0), total) ELSE total END AS k FROM (
      SELECT sum(n)::DOUBLE AS total, count(*) AS nodes, sum(n * (bad / n - mean) ** 2) AS off, sum(mean * (1 - mean)) AS chance
      FROM {children} WHERE n > 0))"""


@query(
    "op9_url_filter",
    rf"""
    WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
          coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
          CASE WHEN url IS NOT NULL THEN regexp_matches(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '(^|[^a-z])({"|".join(hosts.BAD_WORDS)})([^a-z]|$)') OR len(regexp_extract_all(
              regexp_replace(coalesce(html, ''), '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g'), '{_WORD}')) < 50 END AS bad FROM pages),
    seen AS (SELECT *, CASE {_RULE_CASE} END AS rule FROM u),
    x AS (SELECT host, CASE {_SUFFIX_CASE} ELSE string_split(host, '.')[-1] END AS suffix, count(bad)::DOUBLE AS n,
            coalesce(sum(bad::INT), 0)::DOUBLE AS bad FROM seen GROUP BY host),
    h AS (SELECT *, array_to_string(list_slice(string_split(host, '.'), -1 - len(string_split(suffix, '.')), -1), '.') AS domain FROM x),
    top AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1) AS m FROM h),
    s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(m) AS mean FROM h, top GROUP BY suffix),
    {_sql_level("ks", "s0")},
    s AS (SELECT suffix, (bad + k * mean) / (n + k) AS mean FROM s0, ks),
    d0 AS (SELECT domain, h.suffix, sum(n) AS n, sum(bad) AS bad, any_value(s.mean) AS mean
           FROM h JOIN s ON h.suffix = s.suffix GROUP BY domain, h.suffix),
    {_sql_level("kd", "d0")},
    d AS (SELECT domain, (bad + k * mean) / (n + k) AS mean FROM d0, kd),
    h0 AS (SELECT host, n, bad, d.mean AS mean FROM h JOIN d ON h.domain = d.domain),
    {_sql_level("kh", "h0")},
    hr AS (SELECT host, n + k AS size, (bad + k * mean) / (n + k) AS rate FROM h0, kh),
    blocked AS (SELECT host FROM hr WHERE rate - 2 * sqrt(rate * (1 - rate) / (size + 1)) > 0.5)
    SELECT page_id, seen.host, path, rule, CASE WHEN rule IN ({_BLOCKING}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
      WHEN blocked.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
    FROM seen LEFT JOIN blocked ON seen.host = blocked.host
    """,
)
def _(spark, sf):
    return hosts.judge(table(spark, sf, "pages"), URL_RULES)


@query("op10_bpe")
def _(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.encode_decode(table(spark, sf, "documents"), path))


_RANKED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@query(
    "op11_lexical_search",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_RANKED}') AS ws FROM documents),
    c AS (SELECT count(*)::BIGINT AS nn, sum(len(ws))::BIGINT AS ll FROM d WHERE len(ws) > 0),
    t AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, w, count(*)::BIGINT AS tf
          FROM (SELECT r, doc_id, len(ws)::BIGINT AS n, unnest(ws) AS w FROM d) GROUP BY r, w),
    i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_LOWER}, '{_RANKED}') AS ws FROM benchmark),
    it AS (SELECT q, any_value(item_id) AS item_id, w, count(*)::BIGINT AS k
           FROM (SELECT q, item_id, unnest(ws) AS w FROM i) GROUP BY q, w),
    f AS (SELECT w, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
          FROM (SELECT w, count(*)::BIGINT AS df FROM t WHERE w IN (SELECT w FROM it) GROUP BY w), c),
    s AS (SELECT q, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id,
            sum(k * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score
          FROM it JOIN f USING (w) JOIN t USING (w), c GROUP BY q, r)
    SELECT item_id, rank::INT AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    WHERE rank <= 20
    """,
)
def _(spark, sf):
    return lexical.rank(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def _crc(codes: str) -> str:
    """SQL: unsigned CRC-32 of a list of byte values."""
    bit = "xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda c, k: {bit})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def _digits(column: str) -> str:
    return f"list_transform(string_split({column}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"


def with_repeats(text: Column, doc_id: Column) -> Column:
    """The text op12 looks at: for ids whose CRC-32 ends in 0, the words from some place on repeat there."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(crc / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        place = F.sequence(F.lit(0).cast("bigint"), (n - 1).cast("bigint"))
        again = F.transform(place, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(again, " ")).otherwise(text)

    words = F.regexp_extract_all(text, F.lit(f"({_WORD})"), F.lit(1))
    return F.when((crc % 10 == 0) & text.isNotNull(), bind(words, repeated)).otherwise(text)


@query(
    "op12_periodic_runs",
    rf"""
    WITH h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS o, {_crc(_digits("doc_id"))} AS h FROM documents),
    g AS (SELECT *, h // 10 AS g, len(o)::BIGINT AS n FROM h),
    a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM g),
    d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
            o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE o END AS ws FROM a),
    w AS (SELECT doc_id, n, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM d),
    e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
    r AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY doc_id, q, island
          HAVING count(*) + q >= greatest(6, 4 * q)),
    m AS (SELECT doc_id, start, length, min(q) AS period FROM r GROUP BY doc_id, start, length),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS k FROM m) WHERE k = 1),
    lines AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
              FROM m GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM m),
    kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
      (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
      sha256(coalesce(text, '')) AS collapsed_sha256
    FROM d LEFT JOIN best USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", with_repeats(F.col("text"), F.col("doc_id")).alias("text"))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return periodic.find_runs(docs).select(
        "doc_id", "n_runs", "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"),
    )


@query(
    "op13_histogram_shards",
    rf"""
    WITH s AS (SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size,
            {_crc("list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)")} AS text_crc32
          FROM documents),
    c AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total,
            row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM s),
    ends AS (SELECT before, total, pos FROM c UNION ALL SELECT max(total), max(total), count(*) FROM c),
    b AS (SELECT k, arg_min(pos, (abs(8 * before - k * total), before)) AS first
          FROM ends, (SELECT unnest(range(1, 8)) AS k) GROUP BY k),
    f AS (SELECT 0 AS k, 0 AS first UNION ALL SELECT k, first FROM b),
    p AS (SELECT doc_id, size, text_crc32, pos, max(k) AS shard, max(first) AS first FROM c JOIN f ON first <= pos GROUP BY ALL)
    SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard, (pos - first)::BIGINT AS slot,
      NULL::INT AS grown_shard FROM p
    """,
)
def _(spark, sf):
    return sharding.shard(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
