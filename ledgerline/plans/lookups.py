"""Queries of the large look-ups: a dictionary of thousands of terms, and tables of names against tables of queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dictionary, lookup
from ..session import table
from .registry import _text, query

_TERMS_SQL = """
    terms AS (SELECT term FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[a-z]{6,}')) AS term FROM documents) GROUP BY term HAVING count(*) >= 4)
"""


def _terms(docs):
    """The words of six letters and more that four documents hold, in order of the alphabet."""
    words = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[a-z]{6,}"), F.lit(0)))).alias("term"))
    found = words.groupBy("term").agg(F.count_distinct("doc_id").alias("n")).filter("n >= 4")
    return found.select(F.lit(0).cast("long").alias("pos"), F.concat(F.lit("t:"), "term").alias("name"), "term")


@query(
    f"""
    WITH {_TERMS_SQL}, hits AS (SELECT doc_id, term, strpos(text, term) AS first FROM documents JOIN terms ON contains(text, term))
    SELECT d.doc_id, count(term) AS n_terms, CAST(coalesce(sum(first), 0) AS BIGINT) AS places, coalesce(md5(string_agg('t:' || term, ',' ORDER BY 't:' || term)), md5('')) AS terms
    FROM documents d LEFT JOIN hits USING (doc_id) GROUP BY d.doc_id
    """
)
def dictionary_terms(spark, sf_dir):
    """All texts against a dictionary that the texts themselves give: some thousand terms, one pass over each text."""
    docs = _text(spark, sf_dir)
    found = dictionary.terms_in(docs, _terms(docs), "doc_id")
    names = F.array_sort(F.transform("terms", lambda x: x["name"]))
    places = F.aggregate("terms", F.lit(0).cast("long"), lambda a, x: a + x["first"])
    return found.select("doc_id", F.size("terms").cast("long").alias("n_terms"), places.alias("places"), F.md5(F.array_join(names, ",").cast("binary")).alias("terms"))


_RESOLVE_SQL = """
    asked AS (SELECT DISTINCT query FROM {queries}), master AS ({master}),
    hits AS (SELECT query, code, pos, CASE WHEN name = q THEN 0 WHEN starts_with(name, q) THEN 1 ELSE 2 END AS rank
             FROM (SELECT query, lower(trim(query)) AS q FROM asked) JOIN (SELECT lower(name) AS name, code, pos FROM master) ON q <> '' AND contains(name, q)),
    best AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY rank, pos) AS place, count_if(rank = 0) OVER (PARTITION BY query) AS exact FROM hits),
    told AS (SELECT *, count(*) OVER (PARTITION BY query) AS n FROM best WHERE exact = 0 OR rank = 0)
    SELECT query, CASE WHEN count(code) = 0 THEN 'not_found' WHEN count(code) = 1 THEN 'unique' ELSE 'ambiguous' END AS status, CASE WHEN count(code) = 1 THEN min(code) END AS code, count(code) AS n_candidates,
           coalesce(string_agg(CAST(code AS VARCHAR), ',' ORDER BY place) FILTER (place <= 20), '') AS candidates, greatest(count(code) - 20, 0) AS more
    FROM asked LEFT JOIN told USING (query) GROUP BY query
"""


def _resolved(master, queries, name, code):
    found = lookup.resolve_table(master, queries, name, code, code)
    return found.withColumn("candidates", F.array_join(F.transform("candidates", lambda x: x.cast("string")), ","))


@query(
    "WITH queries AS (SELECT unnest([c_name, upper(c_name), substr(c_name, 14), ' ' || substr(c_name, 1, 16) || ' ', substr(c_name, 17), c_mktsegment]) AS query FROM customer),"
    + _RESOLVE_SQL.format(queries="queries", master="SELECT c_name AS name, c_custkey AS code, c_custkey AS pos FROM customer")
)
def names_resolved(spark, sf_dir):
    """Customers' names, their beginnings, ends and what is no name, all against all names."""
    master = table(spark, sf_dir, "customer")
    name = F.col("c_name")
    kinds = F.array(name, F.upper(name), F.substring(name, 14, 99), F.concat(F.lit(" "), F.substring(name, 1, 16), F.lit(" ")), F.substring(name, 17, 99), F.col("c_mktsegment"))
    return _resolved(master, master.select(F.explode(kinds).alias("query")), "c_name", "c_custkey")


@query(
    "WITH queries AS (SELECT unnest([p_name, p_brand, substr(p_name, 1, 2), substr(p_name, length(p_name)), substr(p_name, 3, 5), '']) AS query FROM part),"
    + _RESOLVE_SQL.format(queries="queries", master="SELECT p_name AS name, p_partkey AS code, p_partkey AS pos FROM part")
)
def shared_names_resolved(spark, sf_dir):
    """Names that very many rows share, asked for by short parts of them: one and two letters, too."""
    master = table(spark, sf_dir, "part")
    name = F.col("p_name")
    kinds = F.array(name, F.col("p_brand"), F.substring(name, 1, 2), F.right(name, F.lit(1)), F.substring(name, 3, 5), F.lit(""))
    return _resolved(master, master.select(F.explode(kinds).alias("query")), "p_name", "p_partkey")
