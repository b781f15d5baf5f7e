"""The registered queries on the fixture tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..catalog import table
from ..functions import text as T
from ..operators import decide, relate, search, select, similarity, summarise

AS_OF = "2024-01-31"
#: A closed list of codes for the fixtures' invented prose.
LISTED = {"mail": r"[a-z0-9.]+@[a-z0-9.]+", "licence": r"(?i)licen[sc]e", "web": r"https?://", "shout": r"!!!", "rule": r"\|"}
STATUS = [("licensed", "(?i)licen[sc]e"), ("contact", "@"), ("noisy", "!!!"), ("listed", r"\|")]
TERMS = ["the", "tion", "und", "les"]

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(sql: str):
    def add(f):
        _queries[f.__name__] = f
        _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import answers, decisions, expectations, intake, register, reports, rulings, texts, watch  # noqa: F401  they register their queries

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    from . import answers, decisions, expectations, intake, register, reports, rulings, texts, watch  # noqa: F401

    return dict(_sql)


def _days(spark, d):
    return table(spark, d, "events").withColumn("day", F.to_date("ts"))


_TITLE = f"substring(trim(regexp_replace(lower(translate(text, '{T.MARKED}', '{T.BARE}')), '[^a-z0-9]+', ' ', 'g')), 1, 120)"


@query(f"SELECT doc_id, {_TITLE} AS title_key FROM documents")
def title_keys(spark, d):
    return table(spark, d, "documents").select("doc_id", T.title_key(F.col("text")).alias("title_key"))


@query("SELECT regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)), '^www\\.', '') AS domain, count(*) AS n FROM pages GROUP BY 1")
def page_domains(spark, d):
    return table(spark, d, "pages").groupBy(T.domain(F.col("url")).alias("domain")).agg(F.count("*").alias("n"))


@query(f"""
WITH k AS (SELECT doc_id, source, {_TITLE} AS k FROM documents)
SELECT doc_id, source, k AS title_key FROM k QUALIFY row_number() OVER (PARTITION BY source, k ORDER BY doc_id) = 1""")
def first_per_title(spark, d):
    keyed = table(spark, d, "documents").select("doc_id", "source", T.title_key(F.col("text")).alias("title_key"))
    return relate.first_per(keyed, ["source", "title_key"], [F.col("doc_id")]).drop("rank_in_group")


@query("SELECT doc_id, " + "array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{c}' END" for c, p in LISTED.items()) + "], lambda x: x IS NOT NULL), ',') AS codes FROM documents")
def closed_list(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(select.codes(F.col("text"), LISTED), ",").alias("codes"))


@query("SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in STATUS) + " ELSE 'plain' END AS status FROM documents")
def first_status(spark, d):
    return table(spark, d, "documents").select("doc_id", select.first_match(F.col("text"), STATUS, "plain").alias("status"))


@query("SELECT doc_id, lang, source FROM documents WHERE lang IN ('fr', 'de') AND source IN ('src0', 'src1', 'src2') AND contains(lower(text), 'au')")
def facet_search(spark, d):
    docs = select.facets(table(spark, d, "documents"), {"lang": ["fr", "de"], "source": ["src0", "src1", "src2"]})
    return docs.where(select.holds_all(F.col("text"), ["au"])).select("doc_id", "lang", "source")


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(text, '(^|[^\p{L}\p{N}])The([^\p{L}\p{N}]|$)')")
def exact_search(spark, d):
    return table(spark, d, "documents").where(select.says(F.col("text"), "The")).select("doc_id")


@query("SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source")
def facet_counts(spark, d):
    return summarise.facet_counts(table(spark, d, "documents").select("lang", "source"), ["lang", "source"])


@query(f"""
WITH e AS (SELECT *, date_diff('day', CAST(ts AS DATE), DATE '{AS_OF}') AS age FROM events),
w AS (SELECT CASE WHEN count(*) FILTER (age BETWEEN 0 AND 7) >= 25 THEN 7 ELSE 14 END AS days FROM e)
SELECT event_id FROM e, w WHERE age BETWEEN 0 AND days""")
def recent_window(spark, d):
    return select.recent(_days(spark, d), "day", AS_OF, 7, 14, 25).select("event_id")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '5-LOW')")
def novel_rows(spark, d):
    seen = table(spark, d, "orders").where("o_orderpriority = '5-LOW'").withColumnRenamed("o_custkey", "c_custkey")
    return select.new_rows(table(spark, d, "customer"), seen, "c_custkey").select("c_custkey")


@query("""
SELECT event_type, user_id, min(ts) AS first_at, max(ts) AS last_at, count(*) AS n, arg_max(event_id, (ts, event_id)) AS lead,
  max(value) AS top_value FROM events GROUP BY 1, 2""")
def alert_register(spark, d):
    return summarise.register(table(spark, d, "events"), ["event_type", "user_id"], "ts", "event_id", {"top_value": F.max("value")})


@query("""
WITH a AS (SELECT user_id, min(ts) AS f, max(ts) AS l, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type = 'error' GROUP BY 1),
b AS (SELECT user_id, min(ts) AS f, max(ts) AS l, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type = 'error' GROUP BY 1)
SELECT coalesce(a.user_id, b.user_id) AS user_id, least(a.f, b.f) AS first_at, greatest(a.l, b.l) AS last_at, coalesce(a.n, 0) + coalesce(b.n, 0) AS n,
  CASE WHEN a.user_id IS NULL THEN 'new' WHEN b.user_id IS NULL THEN 'kept' ELSE 'updated' END AS origin
FROM a FULL JOIN b ON a.user_id = b.user_id""")
def register_merge(spark, d):
    e = table(spark, d, "events").where("event_type = 'error'")
    cut = F.lit("2024-01-15").cast("timestamp")
    old, new = (summarise.register(e.where(c), ["user_id"], "ts", "event_id") for c in (F.col("ts") < cut, F.col("ts") >= cut))
    return relate.merge_register(old, new, "user_id", "first_at", "last_at", "n")


@query("""
WITH a AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'), b AS (SELECT event_id AS bought, user_id, ts AS bought_at FROM events WHERE event_type = 'purchase')
SELECT event_id, user_id, ts, bought, bought_at FROM a LEFT JOIN b USING (user_id)
WHERE bought_at >= ts OR bought_at IS NULL OR NOT EXISTS (SELECT 1 FROM b x WHERE x.user_id = a.user_id AND x.bought_at >= a.ts)
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY CASE WHEN bought_at >= ts THEN bought_at END, bought) = 1""".replace(
    "SELECT event_id, user_id, ts, bought, bought_at FROM a", "SELECT event_id, user_id, ts, CASE WHEN bought_at >= ts THEN bought END AS bought, CASE WHEN bought_at >= ts THEN bought_at END AS bought_at FROM a"
))
def first_purchase_after(spark, d):
    e = table(spark, d, "events")
    views = e.where("event_type = 'view'").select("event_id", "user_id", "ts")
    bought = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("bought"), F.col("ts").alias("bought_at"))
    return relate.first_after(views, bought, ["user_id"], "ts", "bought_at", ["bought"])


@query("""
SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'high' WHEN l.quality = 0 THEN 'discarded' WHEN n_chars >= 2000 THEN 'high' WHEN n_chars >= 300 THEN 'medium' ELSE 'low' END AS relevance
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def feedback_override(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    rules = decide.ladder([(F.col("n_chars") >= 2000, "high"), (F.col("n_chars") >= 300, "medium")], "low")
    return docs.select("doc_id", decide.overridden(rules, F.col("quality"), "high", "discarded").alias("relevance"))


@query(f"""
SELECT n_name, coalesce(o_orderpriority, '*') AS o_orderpriority, max(CAST(o_orderdate AS DATE)) AS latest, date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '1998-12-31') > 60 AS stale
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY GROUPING SETS ((n_name, o_orderpriority), (n_name))""")
def coverage_matrix(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("day", F.to_date("o_orderdate"))
    return summarise.coverage(o.select("n_name", "o_orderpriority", "day"), "n_name", "o_orderpriority", "day", "1998-12-31")


@query(f"""
WITH e AS (SELECT user_id, date_diff('day', CAST(ts AS DATE), DATE '{AS_OF}') AS age FROM events)
SELECT user_id, count(*) FILTER (age BETWEEN 0 AND 7) AS now, count(*) FILTER (age BETWEEN 8 AND 15) AS before,
  count(*) FILTER (age BETWEEN 0 AND 7) - count(*) FILTER (age BETWEEN 8 AND 15) AS diff FROM e GROUP BY 1 HAVING count(*) FILTER (age BETWEEN 0 AND 7) >= 2""")
def topic_trend(spark, d):
    return summarise.trend(_days(spark, d), "user_id", "day", AS_OF, 7)


@query("""
WITH e AS (SELECT user_id || '/' || event_type AS term, event_id, hour(ts) AS h, CAST(ts AS DATE) AS day FROM events)
SELECT term, count(DISTINCT event_id) AS documents, count(DISTINCT h) AS sources, min(day) AS first_seen FROM e GROUP BY 1
HAVING min(day) >= DATE '2024-01-04' AND count(DISTINCT event_id) >= 3 AND count(DISTINCT h) >= 2""")
def emerging_terms(spark, d):
    e = _days(spark, d).withColumn("term", F.concat_ws("/", "user_id", "event_type")).withColumn("h", F.hour("ts"))
    return summarise.emerging(e, "term", "event_id", "h", "day", "2024-01-04")


@query("SELECT quality, n_chars >= 300 AS told, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2")
def confusion_matrix(spark, d):
    both = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").withColumn("told", F.col("n_chars") >= 300)
    return summarise.confusion(both, "quality", "told")


@query("SELECT n_name, count(c_custkey) AS n, CASE WHEN count(c_custkey) >= 21 THEN 5 WHEN count(c_custkey) >= 11 THEN 4 WHEN count(c_custkey) >= 6 THEN 3 WHEN count(c_custkey) >= 3 THEN 2 WHEN count(c_custkey) >= 1 THEN 1 ELSE 0 END AS bucket FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def zone_buckets(spark, d):
    counted = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    both = table(spark, d, "nation").join(counted, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("n_name", F.coalesce("n", F.lit(0)).alias("n"))
    n = F.col("n")
    return both.withColumn("bucket", F.when(n >= 21, 5).when(n >= 11, 4).when(n >= 6, 3).when(n >= 3, 2).when(n >= 1, 1).otherwise(0))


@query("SELECT o_orderkey, o_custkey, o_totalprice, rank_in_group FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank_in_group FROM orders) WHERE rank_in_group <= 5")
def top_five(spark, d):
    found = relate.first_per(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 5)
    return found.select("o_orderkey", "o_custkey", "o_totalprice", "rank_in_group")


@query("SELECT o_orderkey, o_custkey, coalesce(lag(date_trunc('month', o_orderdate)) OVER w <> date_trunc('month', o_orderdate), true) AS opens FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey)")
def month_breaks(spark, d):
    found = relate.group_breaks(table(spark, d, "orders"), F.trunc("o_orderdate", "month"), [F.desc("o_orderdate"), F.col("o_orderkey")], "o_custkey")
    return found.select("o_orderkey", "o_custkey", "opens")


@query("SELECT event_id, event_type, dense_rank() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) AS run FROM events")
def run_rank(spark, d):
    """Runs are ranked, not rows: a row for each type and day goes through the window."""
    e = _days(spark, d).select("event_id", "event_type", "day")
    runs = e.select("event_type", "day").distinct().withColumn("run", F.dense_rank().over(Window.partitionBy("event_type").orderBy("day")))
    return e.join(runs, ["event_type", "day"]).select("event_id", "event_type", "run")


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY substring(text, 1, 40)) AS first_doc_id FROM documents WHERE length(text) >= 40 QUALIFY doc_id > first_doc_id")
def prefix_join(spark, d):
    """Each text's first match on its head: one row each, never the pairs of a head."""
    docs = table(spark, d, "documents").where("length(text) >= 40").select("doc_id", F.substring("text", 1, 40).alias("head"))
    firsts = docs.groupBy("head").agg(F.min("doc_id").alias("first_doc_id"))
    return docs.join(firsts, "head").where("doc_id > first_doc_id").select("doc_id", "first_doc_id")


@query("""
WITH t AS (SELECT label, list(embedding ORDER BY vec_id)[1] AS theme FROM embeddings GROUP BY 1),
s AS (SELECT e.vec_id, t.label, round(list_inner_product(e.embedding::DOUBLE[], t.theme::DOUBLE[]), 6) AS score FROM embeddings e CROSS JOIN t)
SELECT vec_id, label AS theme, score FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) = 1""")
def best_theme(spark, d):
    """One theme vector a label, compared in blocks, so that any number of labels will do."""
    e = table(spark, d, "embeddings")
    themes = e.groupBy(F.col("label").alias("theme")).agg(F.min_by("embedding", "vec_id").alias("vector")).withColumn("weight", F.lit(1.0))
    best = similarity.best_themes(e, ["vec_id"], "embedding", themes, 1)
    return best.where(F.size("best") > 0).select("vec_id", F.get("best", F.lit(0))["theme"].alias("theme"), F.get("best", F.lit(0))["score"].alias("score"))


_WORDS = f"list_filter(regexp_split_to_array(lower(translate(text, '{T.MARKED}', '{T.BARE}')), '[^a-z0-9]+'), lambda w: length(w) > 1)"


def _words(spark, d):
    words = F.filter(F.split(T.folded(F.col("text")), "[^a-z0-9]+"), lambda w: F.length(w) > 1)
    return table(spark, d, "documents").select("doc_id", words.alias("words"))


@query(f"WITH w AS (SELECT doc_id, unnest(list_distinct({_WORDS})) AS word FROM documents) SELECT word, count(*) AS df FROM w GROUP BY 1")
def document_frequency(spark, d):
    return _words(spark, d).select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))


@query(f"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents), t AS (SELECT count(*) AS n, avg(len(words)) AS mean FROM d),
f AS (SELECT doc_id, len(words) AS l, unnest(words) AS word FROM d), tf AS (SELECT doc_id, l, word, count(*) AS tf FROM f WHERE word IN ('the', 'tion', 'und', 'les') GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY 1)
SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score FROM tf JOIN df USING (word), t GROUP BY 1""")
def bm25_search(spark, d):
    return search.bm25(_words(spark, d), "doc_id", "words", TERMS)


@query("SELECT l_orderkey AS orderkey, 'late' AS kind FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01' UNION SELECT o_orderkey, 'open' FROM orders WHERE o_orderstatus = 'O'")
def agenda_union(spark, d):
    late = table(spark, d, "lineitem").where("l_shipdate >= timestamp '1998-06-01'").select(F.col("l_orderkey").alias("orderkey"), F.lit("late").alias("kind"))
    open_ = table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("orderkey"), F.lit("open").alias("kind"))
    return late.unionByName(open_).dropDuplicates()


@query("SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty, max(l_extendedprice) AS top_price, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-01' GROUP BY 1, 2")
def period_summary(spark, d):
    li = table(spark, d, "lineitem").where("l_shipdate <= timestamp '1998-09-01'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double").alias("sum_qty"), F.max("l_extendedprice").alias("top_price"), F.count("*").alias("n"), F.countDistinct("l_suppkey").alias("suppliers"))
