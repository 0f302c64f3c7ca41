"""All queries on the driver's tables and, where SQL can express them, their SQL twins.

The tables stand for filings: ``documents`` and ``pages`` for report texts, ``orders`` for the filings table, ``labels``
for sidecar tags, ``part`` for the company master, ``lineitem`` for account rows, ``events`` for append logs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions import dates, tags
from ..functions import text as T
from ..operators import aggregates, collect, dedup, lookup, search, topics
from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: A word dictionary for the invented prose of the test tables, and a longer word that does not count as the shorter.
WORDS = (("article", "the"), ("relation", " of "), ("joiner", "and"), ("german", "der"), ("spanish", "los"), ("french", "les"))
LONGER = {"the": ("there", "then")}
RULES = (("listed", (("the",), ("and",))), ("german", (("der", "und"),)), ("spanish", (("los",), ("que",))), ("french", (("les",),)))
MARKS = ("the", "and", "of", "der", "und", "los", "que", "les", "de")
LICENSE = ("License", "license")


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql.strip()
        return f

    return register


def _text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))


@query(
    """
    WITH found AS (SELECT doc_id, coalesce(text, '') AS text, source FROM documents WHERE contains(text, 'e')),
    last AS (SELECT source, sha256(text) AS key, arg_max(text, doc_id) AS text FROM found GROUP BY ALL)
    SELECT CASE WHEN contains(text, 'the') THEN 'the' WHEN contains(text, 'der') THEN 'der' WHEN contains(text, 'los') THEN 'los' ELSE 'other' END AS category, count(*) AS n
    FROM last GROUP BY ALL
    """
)
def collect_manifest_counts(spark, sf_dir):
    """Filter by keyword, keep the last of each key, classify, count: the flagship."""
    found = _text(spark, sf_dir).filter(F.col("text").contains("e")).select("doc_id", "source", "text", F.sha2("text", 256).alias("key"))
    last = dedup.keep_last(found, ["source", "key"], "doc_id")
    return aggregates.counts(last.withColumn("category", T.first_contained(F.col("text"), ("the", "der", "los"), "other")), "category")


@query("SELECT CASE WHEN contains(text, 'the') THEN 'the' WHEN contains(text, 'und') THEN 'und' ELSE 'other' END AS category, count(*) AS n FROM documents WHERE contains(text, 'on') GROUP BY ALL")
def keyword_filter_classify(spark, sf_dir):
    found = _text(spark, sf_dir).filter(F.col("text").contains("on"))
    return aggregates.counts(found.withColumn("category", T.first_contained(F.col("text"), ("the", "und"), "other")), "category")


@query("SELECT doc_id, source FROM documents WHERE NOT contains(coalesce(text, ''), 'License') AND NOT contains(coalesce(text, ''), 'license')")
def exclude_markers(spark, sf_dir):
    return search.without_markers(_text(spark, sf_dir), "text", LICENSE).select("doc_id", "source")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE coalesce(o_orderstatus, '') IN ('F', 'P') ORDER BY o_orderkey LIMIT 500")
def class_in_set(spark, sf_dir):
    found = search.in_classes(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "P"])
    return search.limited(found, "o_orderkey", 500).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 1000 ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 100")
def search_page(spark, sf_dir):
    found = search.matching(table(spark, sf_dir, "orders"), {"o_orderstatus": "F", "o_orderpriority": ""}, {"o_totalprice": (1000, None)})
    return search.ordered_page(found, [F.desc("o_orderdate"), F.col("o_orderkey")], page=3, size=50).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    """
    SELECT p_partkey, p_name, CAST(CASE WHEN lower(p_name) = 'ring' THEN 0 WHEN starts_with(lower(p_name), 'ring') THEN 1 ELSE 2 END AS INTEGER) AS rank
    FROM part WHERE contains(lower(p_name), 'ring')
    """
)
def name_rank(spark, sf_dir):
    return lookup.rank_matches(table(spark, sf_dir, "part"), " Ring ", "p_name", "p_partkey").select("p_partkey", "p_name", "rank")


@query(
    """
    SELECT c.c_name AS query, count(p.c_custkey) AS n_exact, CASE WHEN count(p.c_custkey) = 1 THEN min(p.c_custkey) END AS code
    FROM (SELECT DISTINCT c_name FROM customer) c LEFT JOIN customer p ON lower(p.c_name) = lower(c.c_name) GROUP BY ALL
    """
)
def name_resolve_unique(spark, sf_dir):
    master = table(spark, sf_dir, "customer")
    return lookup.resolve_many(master, master.select(F.col("c_name").alias("query")).distinct(), "c_name", "c_custkey", "c_custkey")


@query(
    """
    WITH r AS (SELECT p_partkey, CASE WHEN lower(p_name) = 'red widget' THEN 0 WHEN starts_with(lower(p_name), 'red widget') THEN 1 WHEN contains(lower(p_name), 'red widget') THEN 2 END AS rank FROM part),
    s AS (SELECT count_if(rank = 0) AS e, count_if(rank > 0) AS o, arg_min(p_partkey, rank * 1000000000 + p_partkey) AS best FROM r WHERE rank IS NOT NULL)
    SELECT CASE WHEN e = 1 OR (e = 0 AND o = 1) THEN 'unique' WHEN e + o = 0 THEN 'not_found' ELSE 'ambiguous' END AS status,
           CASE WHEN e = 1 OR (e = 0 AND o = 1) THEN best END AS code, CAST(CASE WHEN e > 0 THEN e ELSE o END AS BIGINT) AS n_candidates FROM s
    """
)
def name_resolution_status(spark, sf_dir):
    return lookup.resolve(table(spark, sf_dir, "part"), "Red widget", "p_name", "p_partkey", "p_partkey").select("status", "code", "n_candidates")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def dedup_last_by_key(spark, sf_dir):
    return dedup.keep_last(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], "event_id")


@query("SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def dedup_first_by_key(spark, sf_dir):
    return dedup.keep_first(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, min(event_id) AS first_pos FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def log_repair(spark, sf_dir):
    return dedup.repair(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("SELECT sha256(text) AS text_hash, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text")
def dedup_full_row(spark, sf_dir):
    found = dedup.distinct_rows(table(spark, sf_dir, "documents").filter("text is not null"), ["text"], "doc_id")
    return found.select(F.sha2("text", 256).alias("text_hash"), "doc_id")


@query(
    """
    WITH p AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS ym, arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_orderkey FROM orders GROUP BY ALL)
    SELECT o_custkey, arg_min(o_orderkey, ym) AS first_order, arg_max(o_orderkey, ym) AS last_order FROM p GROUP BY o_custkey
    """
)
def latest_per_period(spark, sf_dir):
    found = aggregates.latest_of_periods(table(spark, sf_dir, "orders"), "o_custkey", F.date_format("o_orderdate", "yyyy-MM"), F.struct("o_orderdate", "o_orderkey"), "o_orderkey")
    return found.select("o_custkey", F.col("first").alias("first_order"), F.col("last").alias("last_order"))


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, l.doc_id IS NOT NULL AS matched FROM documents d LEFT JOIN (SELECT doc_id, arg_max(quality, toxic) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)")
def merge_left_outer(spark, sf_dir):
    merged = lookup.merge_left(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id", "quality", "toxic")
    return merged.withColumn("quality", F.coalesce("quality", F.lit(-1)))


@query("SELECT count(l.doc_id) AS matched, count(*) - count(l.doc_id) AS unmatched, CAST(0 AS BIGINT) AS corrupt FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def merge_counters(spark, sf_dir):
    return aggregates.merge_counts(merge_left_outer(spark, sf_dir))


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_anti_join(spark, sf_dir):
    return lookup.not_done(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def resume_by_status(spark, sf_dir):
    return lookup.not_done(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", [1], "quality").select("doc_id", "source")


@query("SELECT doc_id, 'state' AS origin FROM labels UNION ALL SELECT doc_id, 'recovered' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def state_union_recovered(spark, sf_dir):
    state = table(spark, sf_dir, "labels").select("doc_id", F.lit("state").alias("origin"))
    return lookup.add_recovered(state, table(spark, sf_dir, "documents").select("doc_id", F.lit("recovered").alias("origin")), "doc_id")


@query(
    """
    WITH k AS (SELECT doc_id, sha256('m' || chr(10) || coalesce(text, '')) AS kam_hash FROM documents),
    c AS (SELECT kam_hash, min(doc_id) AS cached FROM k WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY kam_hash)
    SELECT k.doc_id, k.kam_hash, c.cached FROM k JOIN c USING (kam_hash)
    UNION ALL SELECT NULL, kam_hash, NULL FROM (SELECT DISTINCT kam_hash FROM k WHERE kam_hash NOT IN (SELECT kam_hash FROM c))
    """
)
def cache_probe(spark, sf_dir):
    keyed = _text(spark, sf_dir).select("doc_id", T.content_hash(F.lit("m"), F.col("text")).alias("kam_hash"))
    cache = keyed.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").groupBy("kam_hash").agg(F.min("doc_id").alias("cached"))
    hits, missing = lookup.probe_cache(keyed, cache, "kam_hash")
    return hits.unionByName(missing, allowMissingColumns=True)


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status FROM orders")
def code_labels(spark, sf_dir):
    names = spark.createDataFrame([("F", "finished"), ("O", "open")], "code string, label string")
    return lookup.label_codes(table(spark, sf_dir, "orders"), "o_orderstatus", F.broadcast(names), "status").select("o_orderkey", "status")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' ELSE o_orderpriority END AS priority FROM orders")
def code_map(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", tags.labels(F.col("o_orderpriority"), {"1-URGENT": "urgent"}).alias("priority"))


_TAGS_SQL = """
    list_filter([CASE WHEN contains(replace(replace(text, 'there', chr(1)), 'then', chr(1)), 'the') THEN 'article' END, CASE WHEN contains(text, ' of ') THEN 'relation' END,
    CASE WHEN contains(text, 'and') THEN 'joiner' END, CASE WHEN contains(text, 'der') THEN 'german' END, CASE WHEN contains(text, 'los') THEN 'spanish' END, CASE WHEN contains(text, 'les') THEN 'french' END], lambda x : x IS NOT NULL)
"""


@query(f"SELECT doc_id, array_to_string({_TAGS_SQL}, ',') AS tags FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")
def theta_keywords(spark, sf_dir):
    return _text(spark, sf_dir).select("doc_id", F.array_join(T.terms_found(F.col("text"), WORDS, LONGER), ",").alias("tags"))


@query(f"SELECT tag, count(*) AS n FROM (SELECT unnest({_TAGS_SQL}) AS tag FROM (SELECT coalesce(text, '') AS text FROM documents)) GROUP BY tag")
def tag_explode_count(spark, sf_dir):
    return aggregates.tag_distribution(_text(spark, sf_dir).select(T.terms_found(F.col("text"), WORDS, LONGER).alias("tags")), "tags")


_WINDOWS_SQL = """
    WITH RECURSIVE w(pos, a, b) AS (
      SELECT 0, DATE '{0}', least(CAST(DATE '{0}' + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), DATE '{1}')
      UNION ALL SELECT pos + 1, b + 1, least(CAST((b + 1) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), DATE '{1}') FROM w WHERE b < DATE '{1}')
"""


@query(
    """
    WITH RECURSIVE ends AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders), w(pos, a, b) AS (
      SELECT 0, a, least(CAST(a + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), b) FROM ends
      UNION ALL SELECT pos + 1, w.b + 1, least(CAST((w.b + 1) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), ends.b) FROM w, ends WHERE w.b < ends.b)
    SELECT CAST(pos AS INTEGER) AS pos, strftime(a, '%Y%m%d') AS bgn_de, strftime(b, '%Y%m%d') AS end_de FROM w
    """
)
def window_split(spark, sf_dir):
    """The windows of the time in which orders were made."""
    return dates.split_windows(spark, *dates.day_range(table(spark, sf_dir, "orders"), "o_orderdate"))


@query(
    _WINDOWS_SQL.format("1992-01-01", "1999-12-31")
    + " SELECT strftime(a, '%Y%m%d') AS bgn_de, strftime(b, '%Y%m%d') AS end_de, count(*) AS n FROM w JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN a AND b GROUP BY ALL"
)
def window_bucket_counts(spark, sf_dir):
    """Orders are counted by day first, so that the range join sees days and not orders."""
    days = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("day")).agg(F.count("*").alias("n"))
    windows = dates.split_windows(spark, "19920101", "19991231")
    return days.join(F.broadcast(windows), (F.col("day") >= F.col("bgn_de")) & (F.col("day") <= F.col("end_de"))).groupBy("bgn_de", "end_de").agg(F.sum("n").alias("n"))


@query(
    """
    WITH RECURSIVE t AS (SELECT * FROM (VALUES ('F', '감사보고서'), ('A', '사업보고서')) v(ty, kw)), ends AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders), w(pos, a, b) AS (
      SELECT 0, a, least(CAST(a + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), b) FROM ends
      UNION ALL SELECT pos + 1, w.b + 1, least(CAST((w.b + 1) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), ends.b) FROM w, ends WHERE w.b < ends.b),
    n AS (SELECT w.a, w.b, count(o_orderkey) AS n FROM w LEFT JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN w.a AND w.b GROUP BY ALL)
    SELECT ty || '|' || kw || '|' || strftime(a, '%Y%m%d') || '|' || strftime(b, '%Y%m%d') AS task_key, n FROM t, n
    """
)
def collection_tasks(spark, sf_dir):
    """The tasks that collect the orders' time, with the number of orders that each would meet."""
    orders = table(spark, sf_dir, "orders")
    days = orders.groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("day")).agg(F.count("*").alias("m"))
    tasks = collect.tasks(spark, *dates.day_range(orders, "o_orderdate"))
    met = tasks.join(days, (F.col("day") >= F.col("bgn_de")) & (F.col("day") <= F.col("end_de")), "left")
    return met.groupBy("task_key").agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n"))


@query("SELECT k.key AS event_type, count(e.event_type) AS n FROM (VALUES ('view'), ('click'), ('purchase'), ('refund')) k(key) LEFT JOIN (SELECT CASE WHEN event_type IN ('view', 'click', 'purchase') THEN event_type ELSE 'refund' END AS event_type FROM events) e ON e.event_type = k.key GROUP BY k.key")
def summary_zero_fill(spark, sf_dir):
    return aggregates.zero_filled_counts(table(spark, sf_dir, "events"), "event_type", ["view", "click", "purchase", "refund"], fold_into="refund")


@query("SELECT event_type, array_to_string(list(event_id ORDER BY event_id), ',') AS sample FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) WHERE n <= 10 GROUP BY event_type")
def error_samples_topn(spark, sf_dir):
    return aggregates.first_per_group(table(spark, sf_dir, "events"), "event_type", "event_id", "event_id", 10).select("event_type", F.array_join("sample", ",").alias("sample"))


@query("SELECT l_returnflag, l_linestatus, min(p) AS first_pos, arg_min(l_partkey, p) AS header, count(*) AS n FROM (SELECT *, l_orderkey * 10 + l_linenumber AS p FROM lineitem) GROUP BY ALL")
def group_first_seen(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("p", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return aggregates.groups_in_order(rows, ["l_returnflag", "l_linestatus"], "p", "l_partkey")


@query("SELECT r_name, n_name, count(*) AS n, min(c_custkey) AS first_pos FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def nested_group(spark, sf_dir):
    """Customers are counted by nation before the names come in."""
    sums = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first_pos"))
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return sums.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("r_name", "n_name", "n", "first_pos")


@query("SELECT event_id, event_type AS class FROM events WHERE event_type IN ('view', 'signup', 'purchase', 'error')")
def union_classes(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return search.union_branches([events.filter(F.col("event_type") == c).select("event_id", F.lit(c).alias("class")) for c in ("view", "signup", "purchase", "error")])


_PAGE_TEXT = r"trim(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '&[#A-Za-z0-9]+;', ' ', 'g'), '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g'))"


@query(f"SELECT page_id, {_PAGE_TEXT} AS text FROM pages")
def strip_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.bytes_to_text(F.coalesce("html", F.lit("")).cast("binary")).alias("text"))


@query(
    rf"""
    WITH t AS (SELECT page_id, {_PAGE_TEXT} AS text FROM pages), h AS (SELECT *, strpos(text || ' ', 'the ') AS place FROM t),
    r AS (SELECT *, substr(text, place + 3) AS rest FROM h WHERE place > 0),
    e AS (SELECT *, least(coalesce(nullif(strpos(rest || ' ', 'and '), 0), 1000000000), coalesce(nullif(strpos(rest || ' ', 'of '), 0), 1000000000), length(rest) + 1) AS stop FROM r)
    SELECT h.page_id, trim(coalesce(substr(e.rest, 1, CAST(least(e.stop - 1, 6000) AS BIGINT)), '')) AS section FROM h LEFT JOIN e USING (page_id)
    """
)
def landmark_section(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", T.bytes_to_text(F.coalesce("html", F.lit("")).cast("binary")).alias("text"))
    return pages.select("page_id", T.section(F.col("text"), "the", ("the", "and", "of")).alias("section"))


@query(
    """
    SELECT doc_id, CASE WHEN contains(text, 'the') AND contains(text, 'and') THEN 'listed' WHEN contains(text, 'der') OR contains(text, 'und') THEN 'german'
    WHEN contains(text, 'los') AND contains(text, 'que') THEN 'spanish' WHEN contains(text, 'les') THEN 'french' ELSE 'unknown' END AS opinion FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    """
)
def ordered_classify(spark, sf_dir):
    return _text(spark, sf_dir).select("doc_id", T.classify(F.col("text"), RULES, D.UNKNOWN).alias("opinion"))


@query(
    """
    WITH p AS (SELECT doc_id, nullif(strpos(text || ' ', 'and '), 0) AS a, nullif(strpos(text || ' ', 'of '), 0) AS b, nullif(strpos(text || ' ', 'und '), 0) AS c FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, CAST(least(a, b, c) AS INTEGER) AS at, CASE least(a, b, c) WHEN a THEN 'and' WHEN b THEN 'of' WHEN c THEN 'und' END AS mark FROM p
    """
)
def earliest_landmark(spark, sf_dir):
    found = table(spark, sf_dir, "documents").filter("text is not null").withColumn("x", T.first_landmark(F.col("text"), ("and", "of", "und")))
    return found.select("doc_id", "x.at", "x.mark")


@query(r"SELECT doc_id, coalesce(list_extract(regexp_extract_all(text, '[A-Z][a-z]+ [a-z]{2,6}'), -1), '') AS found FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")
def last_regex_match(spark, sf_dir):
    return _text(spark, sf_dir).select("doc_id", T.last_match(F.col("text"), "[A-Z][a-z]+ [a-z]{2,6}").alias("found"))


@query(
    """
    SELECT doc_id, trim(CASE WHEN strpos(text, 'tion') > 0 THEN substr(text, greatest(1, strpos(text, 'tion') - 80), strpos(text, 'tion') + 84 - greatest(1, strpos(text, 'tion') - 80)) ELSE substr(text, 1, 240) END, ' ' || chr(9) || chr(10) || chr(13)) AS snippet
    FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    """
)
def bounded_snippet(spark, sf_dir):
    return _text(spark, sf_dir).select("doc_id", T.snippet(F.col("text"), F.lit("tion")).alias("snippet"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _text(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    quality = F.coalesce(F.col("quality").cast("string"), F.lit(""))
    return joined.select(
        F.concat(F.lit(" "), "lang").alias("corp_code"), F.col("source").alias("corp_name"), F.when(quality == "0", "x").otherwise(" 2024").alias("bsns_year"), F.concat(F.col("doc_id").cast("string"), F.lit(" ")).alias("rcept_no"),
        F.col("source").alias("auditor"), F.when(quality == "1", "적정").otherwise("unknown").alias("audit_opinion"), F.lit("-").alias("special_matter"), F.col("text").alias("emphasis_matter"), F.when(quality == "1", "core").otherwise(" - ").alias("core_audit_matter"), F.lit("").alias("source_url"),
    )


_TERMS_SQL = _TAGS_SQL.replace("'article'", "'the'").replace("'relation'", "' of '").replace("'joiner'", "'and'").replace("'german'", "'der'").replace("'spanish'", "'los'").replace("'french'", "'les'")
_CASES_SQL = f"""
    WITH j AS (SELECT d.doc_id, d.lang, coalesce(d.source, '') AS source, coalesce(CAST(l.quality AS VARCHAR), '') AS q, coalesce(d.text, '') AS em FROM documents d LEFT JOIN labels l USING (doc_id)),
    r AS (SELECT *, CASE WHEN q = '1' THEN '적정' ELSE 'unknown' END AS op, CASE WHEN q = '1' THEN 'core' ELSE ' - ' END AS core FROM j WHERE q <> '0' AND lang IS NOT NULL),
    t AS (SELECT *, op || ' -' || CASE WHEN em <> '' THEN ' ' || em ELSE '' END || ' ' || core AS text, trim(regexp_replace(em, '\\s+', ' ', 'g')) AS ems FROM r),
    g AS (SELECT *, {_TAGS_SQL} AS slugs, {_TERMS_SQL} AS terms FROM t),
    p AS (SELECT *, CASE WHEN len(terms) > 0 THEN strpos(text, terms[1]) ELSE 0 END AS place FROM g)
    SELECT 'case-' || lang || '-2024-' || doc_id || '-' || coalesce(slugs[1], 'general') || '-' || substr(sha256(source || '|' || op || '|-|' || em || '|' || core), 1, 8) AS case_id,
           array_to_string(terms, ',') AS topic_tags, 'https://filings.example/' || doc_id AS source_url,
           trim(CASE WHEN place > 0 THEN substr(text, greatest(1, place - 80), place + length(terms[1]) + 80 - greatest(1, place - 80)) ELSE substr(text, 1, 240) END, ' ' || chr(9) || chr(10) || chr(13)) AS disclosure_snippet,
           (CAST(source NOT IN ('', '-') AS INTEGER) + CAST(op <> 'unknown' AS INTEGER) + CAST(q = '1' AS INTEGER) + CAST(ems NOT IN ('', '-') AS INTEGER)) / 4.0::DOUBLE AS extraction_confidence
    FROM p
"""


@query(_CASES_SQL)
def topic_case(spark, sf_dir):
    cases, _ = topics.topic_cases(_records(spark, sf_dir), "2025-01-01T00:00:00Z", WORDS, LONGER, url="https://filings.example/%s")
    return cases.select("case_id", F.array_join("topic_tags", ",").alias("topic_tags"), "source_url", "disclosure_snippet", "extraction_confidence")


@query("SELECT 'invalid_fiscal_year' AS reason, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE quality = 0 HAVING count(*) > 0")
def skip_reasons(spark, sf_dir):
    _, rejected = topics.topic_cases(_records(spark, sf_dir), "2025-01-01T00:00:00Z", WORDS, LONGER)
    return aggregates.counts(rejected, "reason")


@query("SELECT o_orderkey, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS whole, format('{:,.2f}', round(o_totalprice, 2)) AS precise FROM orders")
def amount_format(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select("o_orderkey", T.amount(F.floor(price).cast("string")).alias("whole"), T.amount(F.round(price, 2).cast("decimal(18,2)").cast("string")).alias("precise"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def date_format(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.dashed(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"))


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k FROM events")
def json_fields(spark, sf_dir):
    record = tags.without_keys(tags.coerce_record(F.col("props")))
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(F.try_element_at(record, F.lit("k")), F.lit("")).alias("k"))


@query(
    """
    WITH s AS (SELECT doc_id, list_filter([source, lang, 'en', 'zz', source], lambda x : x IS NOT NULL AND x <> '') AS x FROM documents)
    SELECT doc_id, array_to_string(list_filter(['en', 'de', 'src0', 'src1'], lambda v : list_contains(x, v)), ',') AS tags,
           array_to_string(list_transform(list_sort(list_transform(list_distinct(list_filter(x, lambda v : v NOT IN ('en', 'de', 'src0', 'src1'))), lambda v : struct_pack(p := list_position(x, v), v := v))), lambda s : s.v), ',') AS dropped
    FROM s
    """
)
def tag_parse(spark, sf_dir):
    reply = F.concat(F.lit("Tags: ```json\n"), F.to_json(F.array("source", "lang", F.lit("en"), F.lit("zz"), "source")), F.lit("\n```"))
    parsed = table(spark, sf_dir, "documents").select("doc_id", tags.parse_reply(reply, ("en", "de", "src0", "src1")).alias("x"))
    return parsed.select("doc_id", F.array_join("x.tags", ",").alias("tags"), F.array_join("x.dropped", ",").alias("dropped"))


@query("SELECT conv_id, count(*) AS n, array_to_string(list(role || ':' || coalesce(text, '') ORDER BY turn, role, text), chr(10)) AS chat FROM conversations GROUP BY conv_id")
def chat_prompt(spark, sf_dir):
    said = F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    chats = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(said)).alias("x"))
    return chats.select("conv_id", "n", F.array_join(F.transform("x", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n").alias("chat"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END, event_id) AS n FROM events) WHERE n = 1")
def priority_pick(spark, sf_dir):
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "signup", 1).otherwise(2)
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type").withColumn("rank", rank)
    return dedup.keep_first(events, ["user_id"], "rank", "event_id").drop("rank")


@query(
    """
    SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 2 THEN strftime(o_orderdate, '%Y') WHEN o_orderkey % 3 = 1 THEN '2001' ELSE strftime(o_orderdate, '%Y') END AS INTEGER) AS fiscal_year,
           CAST(CASE WHEN o_orderkey % 3 = 1 THEN 9 ELSE CAST(strftime(o_orderdate, '%m') AS INTEGER) END AS INTEGER) AS settlement_month FROM orders
    """
)
def receipt_period(spark, sf_dir):
    key = F.col("o_orderkey") % 3
    name = F.when(key == 0, F.concat(F.lit("감사보고서 ("), F.date_format("o_orderdate", "yyyy.MM"), F.lit(")"))).otherwise("감사보고서")
    period = dates.fiscal_period(name, F.when(key == 1, "보고기간 2001년 9월 30일 현재").otherwise(""), F.date_format("o_orderdate", "yyyyMMdd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", period.alias("p")).select("o_orderkey", F.col("p.year").alias("fiscal_year"), F.col("p.month").alias("settlement_month"))


from . import answering, filings, holdings, lookups, states  # noqa: E402, F401  (register their queries)
