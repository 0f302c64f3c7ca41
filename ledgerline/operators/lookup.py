"""Name resolution, labels, resume and merge joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

EXACT, PREFIX, CONTAINS = 0, 1, 2
#: Characters of the longest runs in the index of names.
LONGEST = 32


def match_rank(name: Column, query: Column | str) -> Column:
    """0 exact, 1 prefix, 2 contained, null otherwise; case and outer white space of the query do not matter."""
    wanted = F.lower(strip(F.lit(query) if isinstance(query, str) else query))
    own = F.lower(name)
    return F.when(wanted == "", F.lit(None)).when(own == wanted, EXACT).when(own.startswith(wanted), PREFIX).when(own.contains(wanted), CONTAINS)


def rank_matches(master: DataFrame, query: str, name: str, pos: str) -> DataFrame:
    """Rows whose name matches, best bucket first and in source order inside a bucket."""
    return master.withColumn("rank", match_rank(F.col(name), query)).filter("rank is not null").orderBy("rank", pos)


def resolve(master: DataFrame, query: str, name: str, code: str, pos: str, most: int = 20) -> DataFrame:
    """One row: status (unique, ambiguous, not_found), the code if unique, the number of candidates and the first ones.

    One exact match wins; without one, a sole prefix or contained match does.
    """
    found = master.withColumn("rank", match_rank(F.col(name), query)).filter("rank is not null")
    n_exact, n_other = F.count_if(F.col("rank") == EXACT), F.count_if(F.col("rank") != EXACT)
    first = found.orderBy("rank", pos).limit(most).agg(F.array_sort(F.collect_list(F.struct("rank", F.col(pos).alias("pos"), F.col(code).alias("code")))).alias("x")).select(F.transform("x", lambda r: r["code"]).alias("candidates"))
    sums = found.agg(n_exact.alias("n_exact"), n_other.alias("n_other"), F.min_by(code, F.struct("rank", pos)).alias("best"))
    one = (F.col("n_exact") == 1) | ((F.col("n_exact") == 0) & (F.col("n_other") == 1))
    status = F.when(one, "unique").when(F.col("n_exact") + F.col("n_other") == 0, "not_found").otherwise("ambiguous")
    n = F.when(F.col("n_exact") > 0, F.col("n_exact")).otherwise(F.col("n_other"))
    return sums.select(status.alias("status"), F.when(one, F.col("best")).alias("code"), n.alias("n_candidates"), F.lit(1).alias("__k")).join(first.withColumn("__k", F.lit(1)), "__k").drop("__k")


def resolve_many(master: DataFrame, queries: DataFrame, name: str, code: str, pos: str) -> DataFrame:
    """Exact resolution of a table of queries (column ``query``) by an equality join on the folded name."""
    own = master.select(F.lower(F.col(name)).alias("__name"), F.struct(F.col(pos).alias("pos"), F.col(code).alias("code")).alias("__row"))
    asked = queries.select("query", F.lower(strip(F.col("query"))).alias("__name"))
    hits = asked.join(own, "__name", "left").groupBy("query").agg(F.count("__row").alias("n_exact"), F.min("__row").alias("__row"))
    return hits.select("query", "n_exact", F.when(F.col("n_exact") == 1, F.col("__row.code")).alias("code"))


def grams(c: Column, n: int) -> Column:
    """The distinct runs of n characters of a text."""
    return F.array_distinct(F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, F.lit(n)))).otherwise(F.array().cast("array<string>")))


def matching_names(names: DataFrame, queries: DataFrame) -> DataFrame:
    """(wanted, name, rank) of folded names (column ``name``, distinct) that each folded query (``wanted``) is equal to, starts or is in.

    Names are indexed by their runs of just the lengths that are asked for, so that a query meets the names that hold it, by
    an equality join, and no others. A query of more than ``LONGEST`` characters meets the names that hold its rarest run
    of so many, and is compared in full. No side is broadcast: names and queries both grow.
    """
    asked = queries.select("wanted").filter("wanted <> ''").distinct().withColumn("size", F.least(F.length("wanted"), F.lit(LONGEST)))
    sizes = sorted(r[0] for r in asked.select("size").distinct().collect())  # LONGEST of them at most
    runs = lambda n: F.flatten(F.array(F.array().cast("array<string>"), *(grams(F.col("name"), i) for i in n)))
    index = names.select("name", F.explode(runs(sizes)).alias("gram"))
    keyed = asked.filter(F.col("size") < LONGEST).select("wanted", F.col("wanted").alias("gram"))
    if LONGEST in sizes:
        own = asked.filter(F.col("size") == LONGEST).select("wanted", F.explode(grams(F.col("wanted"), LONGEST)).alias("gram"))
        often = names.select(F.explode(runs([LONGEST])).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
        rarest = own.join(often.hint("merge"), "gram", "left").groupBy("wanted").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("x")).filter("x.n > 0")
        keyed = keyed.unionByName(rarest.select("wanted", "x.gram"))
    return keyed.join(index.hint("merge"), "gram").select("wanted", "name", match_rank(F.col("name"), F.col("wanted")).alias("rank")).filter("rank is not null")


def resolve_table(master: DataFrame, queries: DataFrame, name: str, code: str, pos: str, most: int = 20) -> DataFrame:
    """``resolve`` for each distinct query of a table: status, code if unique, n_candidates, the first ones, and how many more.

    Names that many rows of the master share are compared once, and so are queries that are folded alike; of each name and
    of each query no more than ``most`` rows are kept while the first ones are looked for.
    """
    own = master.select(F.lower(F.col(name)).alias("name"), F.col(pos).alias("pos"), F.col(code).alias("code")).filter("name is not null")
    first = lambda df, by: df.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(*([] if by == "name" else ["rank"]), "pos"))).filter(F.col("__n") <= most).drop("__n")
    asked = queries.select("query").distinct().withColumn("wanted", F.lower(strip(F.col("query"))))
    met = matching_names(own.select("name").distinct(), asked)
    n_of = own.groupBy("name").agg(F.count("*").alias("n"))
    exact, n = F.col("rank") == EXACT, F.col("n")
    sums = met.join(n_of.hint("merge"), "name").groupBy("wanted").agg(F.sum(F.when(exact, n).otherwise(0)).alias("n_exact"), F.sum(F.when(exact, 0).otherwise(n)).alias("n_other"))
    listed = first(met.join(first(own, "name").hint("merge"), "name"), "wanted").groupBy("wanted").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "pos", "code"))), lambda x: x["code"]).alias("candidates"))
    found = asked.join(sums.hint("merge"), "wanted", "left").join(listed.hint("merge"), "wanted", "left").na.fill(0, ["n_exact", "n_other"])
    one = (F.col("n_exact") == 1) | ((F.col("n_exact") == 0) & (F.col("n_other") == 1))
    total = F.when(F.col("n_exact") > 0, F.col("n_exact")).otherwise(F.col("n_other"))
    status = F.when(one, "unique").when(F.col("n_exact") + F.col("n_other") == 0, "not_found").otherwise("ambiguous")
    listed = F.coalesce("candidates", F.array().cast(dict(found.dtypes)["candidates"]))
    told = F.when(F.col("n_exact") > 0, F.slice(listed, F.lit(1), F.least(F.col("n_exact"), F.lit(most)).cast("int"))).otherwise(listed)
    return found.select("query", status.alias("status"), F.when(one, F.get("candidates", F.lit(0))).alias("code"), total.alias("n_candidates"), told.alias("candidates"), F.greatest(total - most, F.lit(0)).alias("more"))


def label_codes(df: DataFrame, code: str, names: DataFrame, out: str) -> DataFrame:
    """A left join with a label table (code, label); unknown codes stay as they are."""
    named = names.select(F.col("code").alias("__code"), F.col("label").alias("__label"))
    return df.join(named, F.col(code) == F.col("__code"), "left").withColumn(out, F.coalesce("__label", F.col(code))).drop("__code", "__label")


def merge_left(facts: DataFrame, sidecar: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """Facts with the sidecar's last value for their key; unmatched facts keep theirs, or an empty list. Adds ``matched``."""
    last = sidecar.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, pos).alias("__value"), F.lit(True).alias("__hit"))
    own = F.col(value) if value in facts.columns else F.lit(None)
    joined = facts.join(last, key, "left")
    kind = dict(sidecar.dtypes)[value]
    empty = F.array().cast(kind) if kind.startswith("array") else F.lit(None).cast(kind)
    merged = joined.withColumn(value, F.when(F.col("__hit"), F.col("__value")).otherwise(F.coalesce(own.cast(kind), empty)))
    return merged.withColumn("matched", F.coalesce("__hit", F.lit(False))).drop("__value", "__hit")


def not_done(df: DataFrame, state: DataFrame, key: str, statuses: Sequence[str] | None = None, status: str = "status") -> DataFrame:
    """What is still to do: keys in the state are skipped, all of them or those with one of the statuses."""
    done = state if statuses is None else state.filter(F.col(status).isin(*statuses))
    return df.join(done.select(key).distinct(), key, "left_anti")


def add_recovered(state: DataFrame, recovered: DataFrame, key: str) -> DataFrame:
    """The state with the recovered rows whose keys it lacks."""
    return state.unionByName(recovered.join(state.select(key).distinct(), key, "left_anti"))


def probe_cache(df: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(hits with the cache's columns, distinct missing keys): a missing key is worked out once."""
    hits = df.join(cache, key)
    return hits, df.select(key).distinct().join(cache.select(key), key, "left_anti")
