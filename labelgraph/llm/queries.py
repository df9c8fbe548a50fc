"""Registered queries of the training-data operators: ``opN_<name>`` -> (spark, sf_dir) plan.

Each reads its whole table with production parameters. ``ORACLE`` has the DuckDB twin where SQL
can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgraph.llm import (
    chat_repair,
    decontaminate,
    hyper_minhash,
    jaccard_join,
    mixing,
    paragraph_dedup,
    periodic_runs,
    quality_rules,
    sharding,
    source_audit,
    token_blocks,
    url_filter,
    warc,
)
from labelgraph.llm.common import only, read_table, words_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: DuckDB: words between ASCII white space.
WORDS_SQL = r"regexp_extract_all(coalesce({t}, ''), '[^\x20\x09-\x0D]+')"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---- 1: substring dedup ------------------------------------------------------------------
@query("op1_paragraph_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = paragraph_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", "n_words", F.col("kept").alias("kept_doc_id"))


# ---- 2: benchmark decontamination --------------------------------------------------------
_TEXT_WORDS = r"regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op2_decontaminate",
    rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_TEXT_WORDS.format(t='text')} AS w FROM documents),
items AS (SELECT item_id, {_TEXT_WORDS.format(t='text')} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
spots AS (
  SELECT rid, i, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs JOIN lens ON len(w) >= n)),
hits AS (SELECT rid, i, n, item_id FROM spots JOIN wins USING (n, win)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
ids AS (SELECT rid, list(DISTINCT CAST(item_id AS VARCHAR)) AS l FROM hits WHERE item_id IS NOT NULL GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(l), 0) AS n_items,
  sha256(coalesce(array_to_string(list_sort(l), ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (rid) LEFT JOIN ids USING (rid)
""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# ---- 3: chat formatting ------------------------------------------------------------------
@query("op3_chat_repair")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair_conversations(read_table(spark, sf_dir, "conversations"))


# ---- 4: sharding -------------------------------------------------------------------------
SHARDS = 40


@query("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(only(read_table(spark, sf_dir, "documents"), "doc_id", "text"), SHARDS)


# ---- 5: WARC archives --------------------------------------------------------------------
@query(
    "op5_warc",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT h, min(page_id) AS m FROM p WHERE strlen(h) >= 100 GROUP BY h HAVING count(*) > 1)
SELECT page_id, strlen(p.h) AS payload_bytes, sha256(p.h) AS payload_digest,
  CASE WHEN m IS NOT NULL AND page_id IS DISTINCT FROM m THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN m IS NOT NULL AND page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM p LEFT JOIN d ON p.h = d.h
""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(only(read_table(spark, sf_dir, "pages"), "page_id", "url", "html"))
    return read.select(
        F.col("page").cast("long").alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers").cast("long").alias("refers_to"),
    )


# ---- 6: n-gram Jaccard join --------------------------------------------------------------
_SHINGLE_SQL = rf"""
docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT rid, list_slice(w, i, i + least(5, len(w)) - 1) AS s
  FROM (SELECT rid, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM docs WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
shared AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.rid < b.rid GROUP BY 1, 2),
link AS (
  SELECT x, y FROM shared JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
sides AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link)
"""


@query(
    "op6_jaccard_join",
    f"""
WITH RECURSIVE {_SHINGLE_SQL},
reach(x, y) AS (SELECT x, y FROM sides UNION SELECT r.x, s.y FROM reach r JOIN sides s ON r.y = s.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(d.doc_id, min(o.doc_id)), d.doc_id, min(o.doc_id)) AS component_id
FROM docs d LEFT JOIN n ON n.rid = d.rid LEFT JOIN reach r ON r.x = d.rid LEFT JOIN docs o ON o.rid = r.y
GROUP BY d.rid, d.doc_id, n.n
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(read_table(spark, sf_dir, "documents"))


# ---- 7: URL filters ----------------------------------------------------------------------
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)


@query(
    "op7_url_filter",
    rf"""
WITH rules(rh, rp, action) AS (VALUES {_RULE_ROWS}),
parts AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
hit AS (
  SELECT rid, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(action, length(rh || rp)) AS action
  FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN hit USING (rid)
""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), rules)


# ---- 8: quality rules --------------------------------------------------------------------
_REPEAT_SQL = rf"""
words AS (SELECT rid, {WORDS_SQL.format(t='text')} AS w FROM docs),
wins AS (
  SELECT rid, i, list_slice(w, i, i + 7) AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
twice AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM wins) WHERE c > 1),
reps AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n FROM twice GROUP BY rid)
"""
_QUALITY_SQL = rf"""
docs AS (SELECT row_number() OVER () AS rid, * FROM documents),
{_REPEAT_SQL},
lines AS (SELECT rid, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs),
measured AS (
  SELECT d.*, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs d JOIN words USING (rid) JOIN lines USING (rid) LEFT JOIN reps r USING (rid)),
bits AS (
  SELECT *, {' + '.join(f'CASE WHEN {c} THEN {1 << k} ELSE 0 END' for k, c in enumerate(quality_rules.RULES.values()))} AS failed_bits
  FROM measured)
"""
LEDGER_COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@query(
    "op8_quality_rules",
    f"WITH {_QUALITY_SQL} SELECT doc_id, {', '.join(LEDGER_COLS)}, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, "
    "CAST(failed_bits AS BIGINT) AS failed_bits FROM bits",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    led = quality_rules.ledger(quality_rules.measure(docs))
    return quality_rules.apply_policy(led).select("doc_id", *LEDGER_COLS, "base_failed", "kept", "failed_bits")


# ---- 9: mixing sources -------------------------------------------------------------------
#: Water level: words per weight once the sources that reach their limit first are filled up.
_MIX_SQL = f"""
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, len({WORDS_SQL.format(t='text')}) AS size,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
src AS (
  SELECT source, sum(size) AS s, (ARRAY[3, 1, 2])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS w
  FROM docs GROUP BY source),
ranked AS (
  SELECT *, sum(2 * s) OVER o - 2 * s AS capped_before, sum(w) OVER () - (sum(w) OVER o - w) AS w_left
  FROM src WINDOW o AS (ORDER BY 2.0 * s / w, source ROWS UNBOUNDED PRECEDING)),
lev AS (SELECT *, ((SELECT 1.5 * sum(s) FROM src) - capped_before) / w_left AS level FROM ranked),
water AS (SELECT arg_min(level, 2.0 * s / w) FILTER (level * w <= 2 * s) AS level FROM lev),
target AS (SELECT source, CAST(s AS BIGINT) AS source_size, CAST(least(2 * s, w * coalesce(level, 1e300)) AS DOUBLE) AS target FROM src, water)
"""


@query(
    "op9_mixing",
    f"""
WITH {_MIX_SQL},
run AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN source_size > 0 THEN least(2, floor(target / source_size)) ELSE 0 END AS whole,
    sum(size) OVER (PARTITION BY d.source ORDER BY h, size, rid ROWS UNBOUNDED PRECEDING) - size AS before
  FROM docs d JOIN target t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN whole < 2 AND 2 * before + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(only(read_table(spark, sf_dir, "documents"), "doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"),
    )


# ---- 10: token ids -----------------------------------------------------------------------
TOKENIZER, END_ID = "word_bpe_49k.json", 2


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query("op10_token_blocks")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.encode_documents(read_table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


# ---- 11: periodic runs -------------------------------------------------------------------
def planted_repeats(docs: DataFrame) -> DataFrame:
    """The query's texts: with h = crc32(doc_id) and g = h / 10, every tenth document's words from
    a = g % n on repeat the first p = 1 + (n - a) / (3 + g % 8) of them; other texts, and those of
    null ids, stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words_of(F.col("text"))).alias("w"))
    n, g = F.size("w"), F.expr("h div 10")
    rows = rows.select("doc_id", "text", "w", n.alias("n"), g.alias("g"), F.when(n > 0, g % n).cast("int").alias("a"))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    rows = rows.select("doc_id", "text", "w", "n", "a", p.alias("p"))
    again = F.expr("slice(concat(slice(w, 1, a), flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int)))), 1, n)")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.coalesce("text", F.lit(""))).alias("text"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.summary(periodic_runs.periodic_runs(planted_repeats(read_table(spark, sf_dir, "documents"))))


# ---- 12: source divergence audit ---------------------------------------------------------
_TERMS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"


def _share_sql(n: str, total: str) -> str:
    return f"1 + (1000000000::HUGEINT * ({n} + 2)) // ({total} + 2 * v)"


@query(
    "op12_source_audit",
    f"""
WITH docs AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS_SQL} AS w FROM documents),
occ AS (SELECT rid, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS ln FROM occ GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
cnt AS (SELECT lang, source, term, count(*) AS n FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM docs),
vs AS (SELECT lang, count(*) AS v, sum(ln) AS l_total FROM kept GROUP BY lang),
ns AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM grp g LEFT JOIN cnt USING (lang, source) GROUP BY g.lang, g.source),
own AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, CAST({_share_sql('coalesce(n, 0)', 'total')} AS BIGINT) AS p, CAST({_share_sql('ln', 'l_total')} AS BIGINT) AS q
  FROM kept JOIN vs USING (lang) JOIN ns USING (lang) LEFT JOIN cnt USING (lang, source, term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM own WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(read_table(spark, sf_dir, "documents"))


# ---- 13: near duplicates by HyperMinHash -------------------------------------------------
@query(
    "op13_hyper_minhash",
    rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT rid, list_slice(w, i, i + least(2, len(w)) - 1) AS s
  FROM (SELECT rid, w, unnest(range(1, len(w) - least(2, len(w)) + 2)) AS i FROM docs WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
shared AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.rid < b.rid GROUP BY 1, 2),
link AS (SELECT x, y FROM shared JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
sides AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(x, y) AS (SELECT x, y FROM sides UNION SELECT r.x, s.y FROM reach r JOIN sides s ON r.y = s.x),
named AS (
  SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(d.doc_id, min(o.doc_id)), d.doc_id, min(o.doc_id)) AS component_id
  FROM docs d LEFT JOIN n ON n.rid = d.rid LEFT JOIN reach r ON r.x = d.rid LEFT JOIN docs o ON o.rid = r.y
  GROUP BY d.rid, d.doc_id, n.n)
SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM named
""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyper_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))
