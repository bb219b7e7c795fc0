"""Queries over the driver's tables, each with the SQL that gives the same rows.

The tables hold no legal texts, so each query binds an operator to columns of the same shape: events are
edits (a user is a provision, a sign-up its enactment, an error whose id is divisible by 20 a repeal, other errors
and purchases replacements),
orders and lines are instruments and their parts, documents are pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.functions import keys, quality, tables, text
from statuta.operators import chunks, classify, edges, search, store, timeline
from statuta.operators import quality as reports

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- keys, hashes, scalar text -------------------------------------------------------------------


@query("SELECT sha256(text) AS content_hash, min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY 1")
def content_hash_dedup(spark, d):
    return store.first_by_hash(t(spark, d, "documents"), "doc_id", F.col("text"))


@query("SELECT doc_id, replace(strip_accents(lower(text)), 'ς', 'σ') AS folded FROM documents")
def fold_text(spark, d):
    return t(spark, d, "documents").select("doc_id", text.fold(F.col("text")).alias("folded"))


@query(r"""
SELECT doc_id, greek AS n_greek, latin AS n_latin,
  CASE WHEN greek + latin = 0 OR latin / (greek + latin) < 0.15 THEN 'el' WHEN latin / (greek + latin) > 0.85 THEN 'en' ELSE 'mixed' END AS language
FROM (SELECT doc_id, CAST(length(regexp_replace(text, '[^\x{0370}-\x{03FF}\x{1F00}-\x{1FFF}]', '', 'g')) AS INTEGER) AS greek,
             CAST(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS INTEGER) AS latin FROM documents)""")
def language_ratio(spark, d):
    x = F.col("text")
    return t(spark, d, "documents").select("doc_id", text.count_of(x, text.GREEK).alias("n_greek"), text.count_of(x, text.LATIN).alias("n_latin"), text.language(x).alias("language"))


@query(r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '([\p{L}\p{N}_])-\n([\p{L}\p{N}_])', '\1\2', 'g'), '(\d)/\n(\d)', '\1/\2', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS clean
FROM documents""")
def dehyphenate_ws(spark, d):
    x = F.regexp_replace(F.regexp_replace(text.dehyphenate(F.col("text")), r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return t(spark, d, "documents").select("doc_id", text.strip(x).alias("clean"))


_QUALITY = r"""
q0 AS (SELECT *, length(text) AS n, regexp_replace(text, '^\s+|\s+$', '', 'g') AS s FROM documents),
q1 AS (SELECT doc_id, source, s, CAST(n AS DOUBLE) AS n,
  length(regexp_replace(text, '[^\x{0370}-\x{03FF}\x{1F00}-\x{1FFF}]', '', 'g')) AS greek,
  length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS latin,
  length(regexp_replace(text, '[^\x{00C0}-\x{00FF}\x{0100}-\x{017F}\x{0180}-\x{024F}\x{0250}-\x{02AF}\x{02B0}-\x{02FF}\x{1E00}-\x{1EFF}]', '', 'g')) AS garbled,
  length(regexp_replace(text, '[^\x{2500}-\x{257F}\x{2580}-\x{259F}\x{25A0}-\x{25FF}]', '', 'g')) AS box,
  length(regexp_replace(text, '[^\x{2100}-\x{214F}\x{2200}-\x{22FF}\x{2300}-\x{23FF}\x{2700}-\x{27BF}\x{FFF0}-\x{FFFF}]', '', 'g')) AS symbol,
  length(regexp_replace(text, '[^\x{0000}-\x{0008}\x{000b}\x{000c}\x{000e}-\x{001f}\x{007f}-\x{009f}]', '', 'g')) AS control,
  len(regexp_extract_all(text, '\(cid:\d+\)')) AS cids,
  len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS words,
  length(regexp_replace(text, '\s+', '', 'g')) AS solid,
  length(regexp_replace(text, '[^?]', '', 'g')) AS asks FROM q0),
q2 AS (SELECT *, greek / n AS rg, latin / n AS rl, garbled / n AS rb, box / n AS rx, cids / greatest(1, words) AS rc, (garbled + box + symbol + control) / n AS rt,
  CASE WHEN words > 0 THEN solid / words ELSE 0 END AS mean, asks / n AS rq FROM q1),
q3 AS (SELECT *, greatest(0, least(100, 100 - rb * 80 - rx * 60 - symbol / n * 50 - control / n * 40 - rt * 30 - least(rc, 1) * 80
  - CASE WHEN rg < 0.05 AND rl < 0.05 THEN 25 ELSE 0 END - CASE WHEN mean > 25 THEN 25 WHEN mean > 15 THEN 10 ELSE 0 END
  - CASE WHEN rq > 0.08 THEN 40 ELSE 0 END + CASE WHEN rg > 0.3 THEN 10 ELSE 0 END)) AS points FROM q2),
q AS (SELECT doc_id, source, length(s) AS stripped, CASE WHEN length(s) < 50 THEN 0 ELSE CAST(round_even(points, 0) AS INTEGER) END AS score,
  CASE WHEN length(s) < 50 THEN 0.0 ELSE round_even(rg, 3) END AS greek_ratio, CASE WHEN length(s) < 50 THEN 1.0 ELSE round_even(rt, 3) END AS garbage_ratio,
  CASE WHEN length(s) < 50 THEN 'text too short (<50 chars)' WHEN points >= 40 THEN ''
    WHEN rc > 0.15 THEN 'CID-keyed font, no ToUnicode map (' || CAST(round_even(rc * 100, 0) AS INTEGER) || '% cid tokens)'
    WHEN rq > 0.08 THEN 'ASCII-substitution garble (' || CAST(round_even(rq * 100, 0) AS INTEGER) || '% ''?'')'
    WHEN rb > 0.15 THEN 'font-encoding garble (' || CAST(round_even(rb * 100, 0) AS INTEGER) || '% extended-Latin)'
    WHEN rx > 0.08 THEN 'image-based content (' || CAST(round_even(rx * 100, 0) AS INTEGER) || '% box/block glyphs)'
    WHEN rg < 0.05 AND rl < 0.05 THEN 'insufficient readable text'
    ELSE 'low quality score ' || CAST(round_even(points, 0) AS INTEGER) END AS reason FROM q3)"""


@query(f"WITH {_QUALITY} SELECT doc_id, score, CAST(greek_ratio AS DOUBLE) AS greek_ratio, CAST(garbage_ratio AS DOUBLE) AS garbage_ratio, reason, score >= 40 AS is_valid FROM q")
def quality_score(spark, d):
    q = t(spark, d, "documents").select("doc_id", quality.score(F.col("text")).alias("q"))
    return q.select("doc_id", *[f"q.{c}" for c in ("score", "greek_ratio", "garbage_ratio", "reason", "is_valid")])


@query(f"""WITH {_QUALITY}, p AS (SELECT source, count(*) AS n_pages, count(*) FILTER (stripped < 80 OR score < 40) AS n_ocr FROM q GROUP BY source)
SELECT *, CASE WHEN n_ocr = 0 THEN 'text' WHEN n_ocr = n_pages THEN 'scanned' ELSE 'mixed' END AS class FROM p""")
def page_class(spark, d):
    return reports.page_classes(t(spark, d, "documents"), "source", "text")


_LINES = r"""l AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, regexp_replace(x[i], '^\s+|\s+$', '', 'g') AS s, x[i] AS raw
  FROM (SELECT doc_id, string_split(SOURCE, chr(10)) AS x FROM documents), unnest(generate_series(1, len(x))) AS g(i))"""


#: Lines with pipes get a pipe at both ends, as rows of tables have.
_ROWS = _LINES.replace("SOURCE", r"regexp_replace(text, '(?m)^(.*\|.*)$', '| \1 |', 'g')")
_LINES = _LINES.replace("SOURCE", "text")


def _piped():
    return F.regexp_replace("text", r"(?m)^(.*\|.*)$", r"| $1 |")


@query(rf"""WITH {_ROWS}, c AS (SELECT doc_id, line_no, list_transform(string_split(s[2:-2], '|'), lambda v: regexp_replace(v, '^\s+|\s+$', '', 'g')) AS cells
  FROM l WHERE length(s) >= 3 AND s[1] = '|' AND s[-1] = '|')
SELECT doc_id, line_no, CAST(len(cells) AS INTEGER) AS n_cells,
  len(list_filter(cells, lambda v: v <> '')) > 0 AND len(list_filter(cells, lambda v: v <> '' AND NOT regexp_full_match(v, '[-:]+'))) = 0 AS is_rule FROM c""")
def table_rows(spark, d):
    return tables.table_lines(t(spark, d, "documents").withColumn("text", _piped()), "doc_id", "text")


@query(rf"""WITH {_ROWS}, c AS (SELECT doc_id, line_no, length(s) >= 3 AND s[1] = '|' AND s[-1] = '|' AS pipe,
    list_transform(string_split(s[2:-2], '|'), lambda v: regexp_replace(v, '^\s+|\s+$', '', 'g')) AS cells FROM l),
k AS (SELECT *, sum(CASE WHEN pipe THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS run,
    len(list_filter(cells, lambda v: v <> '')) > 0 AND len(list_filter(cells, lambda v: v <> '' AND NOT regexp_full_match(v, '[-:]+'))) = 0 AS rule FROM c),
r AS (SELECT doc_id, run, count(*) AS n_rows, max(len(cells)) AS n_cols FROM k WHERE pipe AND NOT rule GROUP BY doc_id, run)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_tables, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM r WHERE n_rows >= 2 AND n_cols >= 2 GROUP BY doc_id""")
def table_blocks(spark, d):
    x = t(spark, d, "documents").select("doc_id", tables.tables(_piped()).alias("x")).where(F.size("x") > 0)
    n = F.aggregate("x", F.lit(0).cast("long"), lambda a, r: a + F.size(r))
    return x.select("doc_id", F.size("x").alias("n_tables"), n.alias("n_rows"))


@query()
def table_json(spark, d):
    return t(spark, d, "documents").select("doc_id", tables.tables_json(_piped()).alias("table_json")).where("table_json is not null")


@query(rf"""WITH {_LINES}, a AS (SELECT doc_id, line_no, raw, s = '' AS blank, length(s) >= 3 AND s[1] = '|' AND s[-1] = '|' AS tab,
    regexp_matches(raw, '^\s*([0-9]{{1,3}}|[Α-Ωα-ωA-Za-z])[.)]\s') AS clause FROM l),
b AS (SELECT *, lag(blank, 1, true) OVER w AS after_blank, lag(tab, 1, false) OVER w AS was_tab FROM a WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
g AS (SELECT *, sum(CASE WHEN blank OR after_blank OR tab <> was_tab OR (NOT tab AND clause) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS block FROM b),
j AS (SELECT doc_id, block, regexp_replace(string_agg(raw, chr(10) ORDER BY line_no), '^\s+|\s+$', '', 'g') AS body FROM g WHERE NOT blank GROUP BY doc_id, block)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY block) - 1 AS INTEGER) AS block_no, body FROM j WHERE body <> ''""")
def paragraph_blocks(spark, d):
    return t(spark, d, "documents").select("doc_id", F.posexplode(chunks.paragraphs(F.col("text"))).alias("block_no", "body"))


@query("""WITH RECURSIVE o AS (SELECT source, doc_id, greatest(1, CAST(floor(n_chars / 1.5) AS BIGINT)) AS tok, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
w AS (SELECT source, doc_id, rn, tok AS total, 0 AS win FROM o WHERE rn = 1
  UNION ALL SELECT o.source, o.doc_id, o.rn, CASE WHEN w.total + o.tok > 24000 THEN o.tok ELSE w.total + o.tok END, CASE WHEN w.total + o.tok > 24000 THEN w.win + 1 ELSE w.win END
  FROM w JOIN o ON o.source = w.source AND o.rn = w.rn + 1)
SELECT source, doc_id, CAST(win AS INTEGER) AS "window" FROM w""")
def greedy_pack(spark, d):
    return chunks.plan_windows(t(spark, d, "documents"), "source", "doc_id", "n_chars")


@query()
def document_sections(spark, d):
    return t(spark, d, "documents").select("doc_id", F.posexplode(chunks.sections(F.col("text"))).alias("chunk_index", "body"))


@query("""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, 'N' || page_id || '/' || (2000 + page_id % 25) AS instrument_key,
  'ν.' || page_id || '/' || (2000 + page_id % 25) || '#αρ.' || (page_id % 40) || CASE WHEN page_id % 3 = 0 THEN '.παρ.2' ELSE '' END AS provision,
  'ν.' || page_id || '/' || (2000 + page_id % 25) || '#αρ.' || (page_id % 40) AS article_id, page_id || '/' || (2000 + page_id % 25) AS law_number, CAST(page_id % 40 AS VARCHAR) AS article_number FROM pages""")
def parse_keys(spark, d):
    p, year = F.col("page_id"), 2000 + F.col("page_id") % 25
    kind = F.lit("NOMOS")
    prov = keys.provision_id(keys.instrument_id(kind, p, year), (p % 40).cast("string"), F.when(p % 3 == 0, "2"))
    rows = t(spark, d, "pages").select("page_id", F.coalesce(F.expr("try_parse_url(url, 'HOST')"), F.lit("")).alias("host"), keys.instrument_key(kind, p, year).alias("instrument_key"), prov.alias("provision"))
    return rows.withColumn("article_id", keys.article_level(F.col("provision"))).withColumn("law_number", keys.law_number(keys.law_of(F.col("provision")))).withColumn("article_number", keys.article_number(F.col("provision")))


@query("""SELECT page_id, kind, CAST(number AS INTEGER) AS number, CAST(year AS INTEGER) AS year, article, key AS instrument_key FROM (
  SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'PD' ELSE 'NOMOS' END AS kind, page_id AS number, 1990 + page_id % 30 AS year, CAST(page_id % 50 AS VARCHAR) AS article,
  CASE WHEN page_id % 2 = 0 THEN 'PD' ELSE 'N' END || page_id || '/' || (1990 + page_id % 30) AS key FROM pages WHERE page_id < 100000)""")
def citations(spark, d):
    p = F.col("page_id")
    number = p % 100000  # citations read at most five digits
    said = F.concat(F.lit("άρθρο "), (p % 50).cast("string"), F.when(p % 2 == 0, F.lit(" του π.δ. ")).otherwise(F.lit(" του ν. ")), number.cast("string"), F.lit("/"), (1990 + p % 30).cast("string"))
    c = t(spark, d, "pages").select("page_id", keys.citation(said).alias("c"))
    return c.select("page_id", F.col("c.instrument_type").alias("kind"), "c.number", "c.year", "c.article", "c.instrument_key")


@query("""SELECT o_orderkey, k AS version_key, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST((CAST(('0x' || substr(h, 17, 1)) AS INTEGER) % 4) + 1 AS BIGINT), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid
FROM (SELECT o_orderkey, k, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(k)) AS h FROM (SELECT o_orderkey, 'N' || o_orderkey || '/2024@' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS k FROM orders))""")
def uuid5_keys(spark, d):
    k = keys.version_key(keys.instrument_key(F.lit("NOMOS"), F.col("o_orderkey"), F.lit(2024)), F.to_date("o_orderdate"))
    return t(spark, d, "orders").select("o_orderkey", k.alias("version_key")).withColumn("uuid", keys.uuid5(F.col("version_key")))


# --- windows, store ------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, l_partkey, last_value(CASE WHEN l_returnflag = 'R' THEN l_linenumber END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS part FROM lineitem""")
def hierarchy_carry(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    marker = F.when(F.col("l_returnflag") == "R", F.col("l_linenumber"))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.last_value(marker, ignoreNulls=True).over(w).alias("part"))


@query("SELECT event_id, user_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_event, date_diff('second', ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS seconds FROM (SELECT event_id, user_id, date_trunc('second', ts) AS ts FROM events)")
def next_anchor_slice(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"))
    w = Window.partitionBy("user_id").orderBy("s", "event_id")
    return e.select("event_id", "user_id", F.lead("event_id").over(w).alias("next_event"), (F.lead("s").over(w) - F.col("s")).alias("seconds"))


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def upsert_last_wins(spark, d):
    e = t(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return store.last_wins(e, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("""SELECT c.c_custkey, CASE WHEN o.n IS NULL THEN c.c_mktsegment ELSE o.s END AS c_mktsegment, coalesce(o.n, c.n) AS n
FROM (SELECT c_custkey, c_mktsegment, CAST(0 AS BIGINT) AS n FROM customer) c LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS s, count(*) AS n FROM orders GROUP BY 1) o ON c_custkey = o_custkey""")
def upsert_rows(spark, d):
    stored = t(spark, d, "customer").select("c_custkey", "c_mktsegment", F.lit(0).cast("long").alias("n"))
    batch = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("c_mktsegment"), F.count("*").alias("n"))
    return store.upsert(stored, batch.join(stored.select("c_custkey"), "c_custkey", "left_semi"), ["c_custkey"])


@query("""SELECT c_custkey, CASE WHEN p IS NULL OR p = '' THEN c_mktsegment ELSE p END AS c_mktsegment, coalesce(v, c_acctbal) AS c_acctbal
FROM customer LEFT JOIN (SELECT o_custkey, min(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE '' END) AS p, max(o_totalprice) AS v FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def patch_enrichment(spark, d):
    o = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise("")).alias("c_mktsegment"), F.max("o_totalprice").alias("c_acctbal"))
    return store.patch_existing(t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), o, "c_custkey")


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark, d):
    return store.counts(t(spark, d, "orders"), "o_orderstatus")


@query("SELECT o_custkey, count(*) AS n_chunks, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1")
def list_laws(spark, d):
    o = t(spark, d, "orders").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    return store.laws(o, "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus").withColumn("o_custkey", F.col("o_custkey").cast("long"))


@query("""WITH f AS (SELECT sha256(text) AS h, doc_id, source FROM documents), done AS (SELECT DISTINCT h FROM f WHERE source = 'src1'),
o AS (SELECT * FROM f WHERE source <> 'src1' AND h NOT IN (SELECT h FROM done)) SELECT min(doc_id) AS doc_id, h AS content_hash FROM o GROUP BY h""")
def state_claim(spark, d):
    f = t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"), "source")
    state = f.where("source = 'src1'").withColumn("status", F.lit("done"))
    return store.claim(f.where("source <> 'src1'"), state).select("doc_id", "content_hash")


@query("SELECT o_orderkey, coalesce(list_aggregate(list_sort(list(DISTINCT l_partkey) FILTER (l_partkey IS NOT NULL)), 'string_agg', ','), '') AS parts FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def denorm_edges(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    x = store.denormalise(o, t(spark, d, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey", "l_partkey", "parts")
    return x.select(F.col("l_orderkey").alias("o_orderkey"), F.array_join(F.col("parts").cast("array<string>"), ",").alias("parts"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_partkey = 17 OR l_suppkey = 5 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 2000")
def inspect_or_filter(spark, d):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return store.find(t(spark, d, "lineitem").select(*cols), (F.col("l_partkey") == 17) | (F.col("l_suppkey") == 5), cols)


@query("SELECT regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, count(*) AS n, list_aggregate(list_sort(list(page_id)), 'string_agg', ',') AS pages FROM pages GROUP BY 1")
def group_by_host(spark, d):
    host = F.coalesce(F.expr("try_parse_url(url, 'HOST')"), F.lit(""))
    return t(spark, d, "pages").groupBy(host.alias("host")).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("page_id")).cast("array<string>"), ",").alias("pages"))


# --- classification, reports ---------------------------------------------------------------------

_TOPICS = [("action", "energie"), ("action", "aktion"), ("license", "license"), ("license", "copyright"), ("secret", "password"), ("secret", "token"), ("table", "|"), ("mail", "@")]


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(x, 'aktion') OR contains(x, 'energie') THEN 'action' END, CASE WHEN contains(x, 'license') OR contains(x, 'copyright') THEN 'license' END,
  CASE WHEN contains(x, '@') THEN 'mail' END, CASE WHEN contains(x, 'password') OR contains(x, 'token') THEN 'secret' END, CASE WHEN contains(x, '|') THEN 'table' END], lambda v: v IS NOT NULL), ',') AS labels FROM (SELECT doc_id, lower(text) AS x FROM documents)""")
def multilabel_domains(spark, d):
    words = spark.createDataFrame(_TOPICS, "label string, keyword string")
    return classify.join_dictionary(t(spark, d, "documents"), words, "doc_id", "text").withColumn("labels", F.array_join("labels", ","))


@query("""SELECT o_orderkey, CASE WHEN n = 0 THEN 'empty' WHEN r >= 3 THEN 'codification' WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'framework' WHEN r > 0 THEN 'amending' WHEN o_orderstatus = 'P' THEN 'provisional' ELSE 'ordinary' END AS category
FROM (SELECT o_orderkey, o_orderstatus, o_totalprice, count(l_orderkey) AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)""")
def category_tree(spark, d):
    n = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    o = t(spark, d, "orders").join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").fillna(0, ["n", "r"])
    return o.select("o_orderkey", classify.category(F.col("o_orderstatus"), F.col("n"), F.col("r"), F.col("o_totalprice")).alias("category"))


@query("""WITH g AS (SELECT doc_id FROM labels WHERE quality = 1), p AS (SELECT doc_id FROM documents WHERE n_chars > 800), c AS (SELECT count(*) FILTER (g.doc_id IS NOT NULL AND p.doc_id IS NOT NULL) AS tp, count(*) FILTER (g.doc_id IS NULL) AS fp, count(*) FILTER (p.doc_id IS NULL) AS fn FROM g FULL JOIN p ON g.doc_id = p.doc_id)
SELECT tp, fp, fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1 FROM c""")
def prf_benchmark(spark, d):
    return reports.prf(t(spark, d, "labels").where("quality = 1"), t(spark, d, "documents").where("n_chars > 800"), ["doc_id"])


@query("""SELECT count(DISTINCT source) AS documents, count(*) AS instruments, count(*) FILTER (quality = 1) AS identified, count(*) FILTER (coalesce(quality, 0) <> 1 AND NOT coalesce(toxic = 1, false)) AS review,
  count(*) FILTER (toxic = 1) AS errors, count(*) FILTER (n_chars < 500) AS flagged, CAST(sum(n_chars // 1000) AS BIGINT) AS provisions FROM documents LEFT JOIN labels USING (doc_id)""")
def validation_summary(spark, d):
    r = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left")
    return reports.summary(r.select(F.col("source").alias("file"), (F.col("quality") == 1).alias("identified"), F.when(F.col("toxic") == 1, "toxic").alias("error"), (F.col("n_chars") < 500).cast("int").alias("n_flags"), F.floor(F.col("n_chars") / 1000).alias("n_provisions")))


# --- edges ---------------------------------------------------------------------------------------


def _edges(spark, d):
    e = t(spark, d, "events")
    action = F.when(F.col("event_type") == "error", "repeals").when(F.col("event_type") == "purchase", "replaces").when(F.col("event_type") == "view", "adds").otherwise("amends")
    body = F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit("text no "), (F.col("event_id") % 40).cast("string")))
    return e.select(F.col("event_id").alias("ordinal"), (F.col("user_id") % 50).cast("string").alias("source_id"), (F.col("event_id") % 200).cast("string").alias("target_id"), action.alias("action"), body.alias("text"))


_EDGES = """e AS (SELECT event_id AS ordinal, CAST(user_id % 50 AS VARCHAR) AS source_id, CAST(event_id % 200 AS VARCHAR) AS target_id,
  CASE event_type WHEN 'error' THEN 'repeals' WHEN 'purchase' THEN 'replaces' WHEN 'view' THEN 'adds' ELSE 'amends' END AS action,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE 'text no ' || (event_id % 40) END AS text FROM events)"""


@query(f"""WITH {_EDGES}, a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY action, target_id, left(text, 120) ORDER BY ordinal) AS rn FROM e) WHERE rn = 1),
b AS (SELECT * FROM (SELECT *, max(CASE WHEN action <> 'repeals' AND text <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY target_id) AS has FROM a) WHERE NOT (action <> 'repeals' AND text = '' AND has = 1)),
c AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM b x WHERE x.target_id = b.target_id AND length(b.text) >= 6 AND length(b.text) < length(x.text) AND contains(x.text, b.text)))
SELECT ordinal, source_id, target_id, action, text FROM c WHERE NOT (action = 'repeals' AND text = '' AND EXISTS (SELECT 1 FROM c x WHERE x.source_id = c.source_id AND x.target_id = c.target_id AND x.action <> 'repeals' AND x.text <> ''))""")
def edge_dedup_clean(spark, d):
    e = edges.dedupe(_edges(spark, d), ["action", "target_id"], ["ordinal"])
    return edges.drop_contradicted_repeals(edges.collapse_restatements(e, "target_id", "ordinal"))


@query(f"""WITH {_EDGES}, r AS (SELECT target_id, arg_max(text, ordinal) AS last, count(*) AS n FROM e WHERE action = 'replaces' AND text <> '' GROUP BY 1), p AS (SELECT DISTINCT target_id AS canonical_id FROM e)
SELECT canonical_id, coalesce(last, 'enacted ' || canonical_id) AS text_in_force, CASE WHEN last IS NOT NULL THEN 'enacted ' || canonical_id END AS text_as_enacted, CAST(coalesce(n, 0) + 1 AS INTEGER) AS version FROM p LEFT JOIN r ON target_id = canonical_id""")
def inlaw_consolidate(spark, d):
    e = _edges(spark, d).withColumn("resolved", F.lit(True))
    p = e.select(F.col("target_id").alias("canonical_id")).distinct().withColumn("text", F.concat(F.lit("enacted "), F.col("canonical_id")))
    return edges.consolidate(p, e).drop("amended_by")


@query("""WITH k AS (SELECT DISTINCT user_id AS law FROM events WHERE event_type = 'signup'), e AS (SELECT user_id, event_id, event_type FROM events WHERE event_type <> 'signup'),
x AS (SELECT e.*, k.law FROM e LEFT JOIN k ON e.user_id = k.law)
SELECT count(*) AS total, count(law) AS present, count(*) - count(law) AS missing, count(*) FILTER (event_type = 'view') AS undated, count(*) FILTER (event_id % 7 = 0) AS unresolved,
  coalesce((SELECT string_agg(m, ',' ORDER BY m) FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS m FROM x WHERE law IS NULL ORDER BY 1 LIMIT 50)), '') AS missing_laws FROM x""")
def graph_status(spark, d):
    e = t(spark, d, "events")
    known = e.where("event_type = 'signup'").select(F.col("user_id").cast("string").alias("law"))
    links = e.where("event_type <> 'signup'").select(F.col("user_id").cast("string").alias("target_law"), F.when(F.col("event_type") != "view", F.col("ts")).alias("effective_date"), (F.col("event_id") % 7 != 0).alias("resolved"))
    return edges.graph_status(links, known)


@query("SELECT event_id, user_id FROM events e WHERE event_type = 'click' AND NOT EXISTS (SELECT 1 FROM events s WHERE s.event_type = 'error' AND s.user_id = e.user_id AND e.event_id > s.event_id AND e.event_id < s.event_id + 2000)")
def masked_spans(spark, d):
    e = t(spark, d, "events")
    spans = e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("a"), (F.col("event_id") + 2000).alias("b"))
    return edges.outside(e.where("event_type = 'click'").select("event_id", "user_id"), spans, "user_id", "event_id")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS s, l_partkey % 100 + 1 AS t FROM lineitem), r AS (SELECT CAST(1 AS BIGINT) AS node, 0 AS hop UNION SELECT e.t, r.hop + 1 FROM r JOIN e ON e.s = r.node WHERE r.hop < 2)
SELECT node, CAST(min(hop) AS INTEGER) AS hop FROM r GROUP BY node""")
def graph_traverse(spark, d):
    e = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") % 100 + 1).alias("dst"))
    return timeline.traverse(e, spark.range(1, 2).select(F.col("id").alias("node")), 2)


# --- timeline ------------------------------------------------------------------------------------


def _versions(spark, d):
    e = t(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "event_type")
    base = e.where("event_type = 'signup'").groupBy(F.col("user_id").alias("aid")).agg(F.min("day").alias("valid_from")).withColumn("text", F.lit("enacted"))
    action = F.when((F.col("event_type") == "error") & (F.col("event_id") % 20 == 0), "repeals").otherwise("replaces")
    edits = e.where("event_type in ('purchase', 'error')").select(F.col("user_id").alias("aid"), F.col("day").alias("effective_date"), F.col("event_id").alias("ordinal"), F.lit("").alias("source"), action.alias("action"), F.when(action == "replaces", F.concat(F.lit("e"), F.col("event_id").cast("string"))).alias("text"))
    later = edits.join(base.select("aid", "valid_from"), "aid").where("effective_date > valid_from").drop("valid_from")
    return timeline.fold(base, later)


_VERSIONS = """b AS (SELECT user_id AS aid, min(CAST(ts AS DATE)) AS vf FROM events WHERE event_type = 'signup' GROUP BY 1),
x AS (SELECT user_id AS aid, CAST(ts AS DATE) AS day, event_id, CASE WHEN event_type = 'error' AND event_id % 20 = 0 THEN 'error' ELSE 'purchase' END AS event_type, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), event_id) AS rn FROM events JOIN b ON user_id = aid WHERE events.event_type IN ('purchase', 'error') AND CAST(ts AS DATE) > vf),
s AS (SELECT aid, min(rn) AS stop FROM x WHERE event_type = 'error' GROUP BY 1),
k AS (SELECT x.* FROM x LEFT JOIN s USING (aid) WHERE stop IS NULL OR rn <= stop),
y AS (SELECT *, last_value(CASE WHEN event_type = 'purchase' THEN 'e' || event_id END IGNORE NULLS) OVER (PARTITION BY aid ORDER BY rn) AS txt, row_number() OVER (PARTITION BY aid, day ORDER BY rn DESC) AS r FROM k),
u AS (SELECT aid, vf AS valid_from, 'enacted' AS text, 'in_force' AS status FROM b UNION ALL SELECT aid, day, coalesce(txt, 'enacted'), CASE WHEN event_type = 'error' THEN 'repealed' ELSE 'amended' END FROM y WHERE r = 1),
v AS (SELECT aid, CAST(row_number() OVER w AS INTEGER) AS version, valid_from, lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current, status, text FROM u WINDOW w AS (PARTITION BY aid ORDER BY valid_from))"""


@query(f"WITH {_VERSIONS} SELECT * FROM v")
def timeline_versions(spark, d):
    return _versions(spark, d)


@query(f"WITH {_VERSIONS} SELECT * FROM v WHERE valid_from <= DATE '2024-06-30' AND (valid_to IS NULL OR valid_to > DATE '2024-06-30')")
def timeline_point_in_time(spark, d):
    return timeline.as_of(_versions(spark, d), "2024-06-30")


@query(f"WITH {_VERSIONS} SELECT * FROM v WHERE is_current AND status <> 'repealed'")
def timeline_current(spark, d):
    return timeline.current(_versions(spark, d))


@query(f"WITH {_VERSIONS} SELECT event_id, user_id, version, status FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view') LEFT JOIN v ON user_id = aid AND valid_from <= day AND (valid_to IS NULL OR valid_to > day)")
def timeline_as_of_join(spark, d):
    views = t(spark, d, "events").where("event_type = 'view'").select("event_id", "user_id", F.to_date("ts").alias("day"))
    return timeline.as_of_join(views, _versions(spark, d), "user_id", "day").select("event_id", "user_id", "version", "status")


@query(f"""WITH {_VERSIONS}, one AS (SELECT min(aid) AS a FROM b)
SELECT 'edit' AS kind, CAST(ts AS DATE) AS at, CAST(event_id AS VARCHAR) AS ref, event_type AS action, 'e' || event_id AS preview FROM events, one WHERE user_id = a AND event_type IN ('purchase', 'error')
UNION ALL SELECT 'version', valid_from, CAST(version AS VARCHAR), status, text FROM v, one WHERE aid = a""")
def provision_history(spark, d):
    e = t(spark, d, "events")
    one = e.where("event_type = 'signup'").agg(F.min("user_id").alias("aid"))
    edits = e.where("event_type in ('purchase', 'error')").join(one, F.col("user_id") == F.col("aid"), "left_semi")
    edits = edits.select(F.to_date("ts").alias("effective_date"), F.col("event_id").alias("source"), F.col("event_type").alias("action"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("text"))
    return timeline.history(edits, _versions(spark, d).join(one, "aid", "left_semi"), limit=None)


# --- search --------------------------------------------------------------------------------------

_TERMS = ["that", "password", "tion", "license"]
_BM25 = """tok AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}_]+'), lambda w: w <> '') AS w FROM documents),
d AS (SELECT doc_id, len(w) AS len, [len(list_filter(w, lambda x: x = q)) FOR q IN ['that', 'password', 'tion', 'license']] AS tf FROM tok),
s AS (SELECT count(*) AS n, avg(len) AS a, [sum(CASE WHEN tf[i] > 0 THEN 1 ELSE 0 END) FOR i IN [1]] AS z FROM d),
g AS (SELECT i, sum(CASE WHEN tf[i] > 0 THEN 1 ELSE 0 END) AS df FROM d, (SELECT unnest([1, 2, 3, 4]) AS i) GROUP BY i),
bm AS (SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf[i] * 2.5 / (tf[i] + 1.5 * (1 - 0.3 + 0.3 * len / a))), 6) AS score FROM d, (SELECT count(*) AS n, avg(len) AS a FROM d), g WHERE tf[i] > 0 GROUP BY doc_id),
top AS (SELECT doc_id, score FROM bm ORDER BY score DESC, doc_id LIMIT 20)"""
_BM25 = _BM25.replace("s AS (SELECT count(*) AS n, avg(len) AS a, [sum(CASE WHEN tf[i] > 0 THEN 1 ELSE 0 END) FOR i IN [1]] AS z FROM d),\n", "")
_VEC = """near AS (SELECT vec_id AS doc_id, round(list_inner_product(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 6) AS score FROM embeddings),
vec AS (SELECT * FROM near ORDER BY score DESC, doc_id LIMIT 20)"""


@query(f"WITH {_BM25} SELECT * FROM top")
def bm25_topk(spark, d):
    return search.bm25(t(spark, d, "documents"), _TERMS, "doc_id", "text", 20)


def _nearest(spark, d):
    v = t(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    q = v.where("doc_id = 0").first()
    return search.nearest(v, list(q["embedding"]) if q else [], "doc_id", "embedding", 20)


@query(f"WITH {_VEC} SELECT * FROM vec")
def vector_topk(spark, d):
    return _nearest(spark, d)


@query("""WITH x AS (SELECT label, CAST(i - 1 AS INTEGER) AS dim, sum(CAST(embedding[i] AS DOUBLE)) AS s FROM embeddings, unnest(generate_series(1, len(embedding))) AS g(i) GROUP BY 1, 2), n AS (SELECT label, sqrt(sum(s * s)) AS z FROM x GROUP BY 1)
SELECT label, dim, round(s / CASE WHEN z = 0 THEN 1 ELSE z END, 6) AS value FROM x JOIN n USING (label)""")
def vector_pool(spark, d):
    return search.pool(t(spark, d, "embeddings"), "label", "embedding")


@query(f"""WITH {_BM25}, {_VEC}, r AS (SELECT doc_id, 1.0 / (60 + row_number() OVER (ORDER BY score DESC, doc_id)) AS p FROM top UNION ALL SELECT doc_id, 1.0 / (60 + row_number() OVER (ORDER BY score DESC, doc_id)) FROM vec)
SELECT doc_id, round(sum(CAST(p AS DOUBLE)), 9) AS score FROM r GROUP BY 1 ORDER BY score DESC, doc_id LIMIT 10""")
def hybrid_rrf(spark, d):
    return search.fuse([search.bm25(t(spark, d, "documents"), _TERMS, "doc_id", "text", 20), _nearest(spark, d)], "doc_id", 10)


@query(r"""SELECT doc_id, twin_key, n FROM (SELECT doc_id, twin_key, count(*) OVER (PARTITION BY twin_key) AS n, row_number() OVER (PARTITION BY twin_key ORDER BY CASE WHEN lang = 'en' THEN 0 ELSE 1 END, doc_id) AS rn
FROM (SELECT doc_id, lang, sha256(regexp_replace(lower(text), '[^a-z]+', '', 'g')) AS twin_key FROM documents)) WHERE rn = 1""")
def twin_dedupe(spark, d):
    key = F.sha2(F.regexp_replace(F.lower("text"), "[^a-z]+", ""), 256)
    return search.without_twins(t(spark, d, "documents"), key, F.col("lang") == "en", "doc_id")


# --- aggregates, sets, windows that the engine gives for free ---------------------------------------


@query("SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (o_orderpriority = '2-HIGH') AS high, count(*) AS n FROM orders GROUP BY 1")
def chunk_histogram(spark, d):
    o = t(spark, d, "orders")
    return o.groupBy("o_orderstatus").agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"), F.count_if(F.col("o_orderpriority") == "2-HIGH").alias("high"), F.count("*").alias("n"))


@query("SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ',') AS segments FROM customer GROUP BY 1")
def distinct_domains(spark, d):
    c = t(spark, d, "customer").groupBy("c_nationkey").agg(F.sort_array(F.collect_set("c_mktsegment")).alias("s"))
    return c.select("c_nationkey", F.array_join("s", ",").alias("segments"))


@query("SELECT l_returnflag, l_linestatus, GROUPING(l_returnflag) + GROUPING(l_linestatus) AS level, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def grouping_sets(spark, d):
    c = t(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg((F.grouping("l_returnflag") + F.grouping("l_linestatus")).cast("long").alias("level"), F.count("*").alias("n"), F.sum("l_linenumber").cast("long").alias("lines"))
    return c.select("l_returnflag", "l_linestatus", "level", "n", "lines")


@query("""SELECT 'both' AS kind, k FROM (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal < 0 INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'customers', k FROM (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal < 0 EXCEPT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'suppliers', k FROM (SELECT DISTINCT s_nationkey AS k FROM supplier EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal < 0)""")
def set_operations(spark, d):
    c = t(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("k"))
    s = t(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    return c.intersect(s).select(F.lit("both").alias("kind"), "k").unionByName(c.subtract(s).select(F.lit("customers").alias("kind"), "k")).unionByName(s.subtract(c).select(F.lit("suppliers").alias("kind"), "k"))


@query("""SELECT o_custkey, o_orderkey, ntile(4) OVER w AS quarter, round(percent_rank() OVER w, 9) AS share, lag(o_orderkey) OVER w AS before, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS near
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")
def window_frames(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return t(spark, d, "orders").select("o_custkey", "o_orderkey", F.ntile(4).over(w).cast("long").alias("quarter"), F.round(F.percent_rank().over(w), 9).alias("share"), F.lag("o_orderkey").over(w).alias("before"), F.count("*").over(w.rowsBetween(-2, 0)).alias("near"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AND EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND n_regionkey = 1)")
def dangling_targets(spark, d):
    c = t(spark, d, "customer").join(t(spark, d, "orders").where("o_orderstatus = 'F'"), F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    return c.join(t(spark, d, "nation").where("n_regionkey = 1"), F.col("n_nationkey") == F.col("c_nationkey"), "left_semi").select("c_custkey")


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2")
def daily_activity(spark, d):
    e = t(spark, d, "events").groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))
    return e.select(F.to_date("w.start").alias("day"), "event_type", "n", "users")


@query("""SELECT row_number() OVER (ORDER BY CASE WHEN l_linenumber IS NULL THEN 1 ELSE 0 END, l_linenumber, l_orderkey, l_partkey, l_suppkey, l_extendedprice) AS place, l_orderkey, l_linenumber
FROM lineitem ORDER BY place LIMIT 2000""")
def inspect_order(spark, d):
    rows = t(spark, d, "lineitem").orderBy(F.col("l_linenumber").isNull(), "l_linenumber", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice").limit(2000)  # what a report shows
    w = Window.orderBy("l_linenumber", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")  # the report's rows
    return rows.select(F.row_number().over(w).cast("long").alias("place"), "l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' AS at, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def rfc3339_dates(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t(spark, d, "orders").select("o_orderkey", keys.rfc3339(day).alias("at"), F.left(day, F.lit(4)).cast("int").alias("year"))


@query("SELECT page_id, CASE WHEN length(url) <= 8 THEN 'set(len=' || length(url) || ')' ELSE left(url, 4) || '…' || right(url, 4) || ' (len=' || length(url) || ')' END AS masked FROM pages")
def mask_secrets(spark, d):
    return t(spark, d, "pages").select("page_id", text.mask(F.col("url")).alias("masked"))


@query("SELECT event_id, CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN true ELSE false END AS fatal FROM events")
def fatal_errors(spark, d):
    from statuta.sources.providers import is_fatal

    said = F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, "401 unauthorized").otherwise("429 too many requests")).otherwise("fine")
    return t(spark, d, "events").select("event_id", is_fatal(said).alias("fatal"))


@query("SELECT doc_id, CAST(greatest(1, floor(n_chars / 1.5)) AS INTEGER) AS tokens, CAST(ceil(n_chars / 2000.0) AS INTEGER) AS pieces FROM documents WHERE n_chars > 0")
def wrap_sizes(spark, d):
    docs = t(spark, d, "documents").where("n_chars > 0")
    return docs.select("doc_id", chunks.estimated_tokens(F.col("n_chars")).alias("tokens"), F.size(chunks.hard_wrap(F.col("text"), 2000)).alias("pieces"))
