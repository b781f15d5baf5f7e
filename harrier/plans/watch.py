"""Registered queries of the watch: dates, streaks, lifecycles, duplicates, names and reports, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import table
from ..functions import dates
from ..functions import text as T
from ..operators import lifecycle, relate, summarise
from .catalogue import _TITLE, AS_OF, _days, query


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || '|' || strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || '~|' || strftime(o_orderdate, '%Y-%m-%d') AS dates,
  CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS deadlines FROM orders""")
def written_dates(spark, d):
    """All dates of a sentence made from an order, as the fixtures' prose holds none, and its deadlines; low orders speak of an event in the obligation's place."""
    o = table(spark, d, "orders")
    duty = F.when(F.col("o_orderpriority") == "5-LOW", "A seminar is due on ").otherwise("Firms must comply by ")
    said = F.concat(duty, F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(". A workshop follows in "), F.date_format("o_orderdate", "MMMM yyyy"), F.lit(". It was signed on "), F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit("."))
    o = o.select("o_orderkey", said.alias("said"))
    shown = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["day"].cast("string"), F.when(x["approx"], "~").otherwise(""))), "|")
    return o.select("o_orderkey", shown(dates.all_dates(F.col("said"))).alias("dates"), shown(dates.deadlines(F.col("said"))).alias("deadlines"))


@query("""
WITH g AS (SELECT user_id, max((ts, event_id)) FILTER (event_type <> 'error') AS good FROM events GROUP BY 1)
SELECT g.user_id, count(event_id) AS streak, count(event_id) >= 2 AS to_remove
FROM g LEFT JOIN events e ON e.user_id = g.user_id AND event_type = 'error' AND (good IS NULL OR (ts, event_id) > good) GROUP BY 1""")
def failure_streaks(spark, d):
    found = lifecycle.streak(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")
    return found.withColumn("to_remove", F.col("streak") >= 2)


@query(f"""
WITH t AS (SELECT user_id, min(CAST(ts AS DATE)) AS first_at, max(CAST(ts AS DATE)) AS last_at, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1),
b AS (SELECT t.user_id, min(CAST(ts AS DATE)) AS became FROM t JOIN events e ON e.user_id = t.user_id AND event_type = 'purchase' AND CAST(ts AS DATE) >= first_at GROUP BY 1)
SELECT user_id, first_at, last_at, n, became, CASE WHEN became IS NOT NULL AND DATE '{AS_OF}' - became <= 21 THEN 'became' WHEN became IS NOT NULL THEN 'closed'
  WHEN DATE '{AS_OF}' - last_at > 10 THEN 'expired' ELSE 'expected' END AS status FROM t LEFT JOIN b USING (user_id)""")
def topic_lifecycle(spark, d):
    e = _days(spark, d)
    topics = summarise.register(e.where("event_type = 'signup'"), ["user_id"], "day", "event_id").drop("lead")
    alerts = e.where("event_type = 'purchase'").select("user_id", F.col("day").alias("became")).distinct()
    found = relate.first_after(topics, alerts, ["user_id"], "first_at", "became", [])
    return lifecycle.lifecycle(found, "first_at", "last_at", "became", AS_OF, 21, 10)


@query(f"""
WITH k AS (SELECT doc_id, source, {_TITLE} AS k FROM documents),
f AS (SELECT *, first_value(doc_id) OVER w AS lead, first_value(source) OVER w AS lead_source FROM k WHERE len(string_split(k, ' ')) >= 5 WINDOW w AS (PARTITION BY k ORDER BY doc_id))
SELECT k.doc_id, CASE WHEN lead_source <> k.source THEN lead END AS leader FROM k LEFT JOIN f USING (doc_id)""")
def duplicate_groups(spark, d):
    key = T.title_key(F.col("text"))
    docs = table(spark, d, "documents").select("doc_id", "source", F.when(F.size(F.split(key, " ")) >= 5, key).alias("k"))
    return lifecycle.duplicate_leaders(docs, "k", "source", ["doc_id"]).select("doc_id", "leader")


@query("""
WITH w AS (SELECT doc_id, lang, unnest(list_distinct(list_filter(regexp_split_to_array(text, '[^\\p{L}\\p{N}]+'), lambda x: regexp_matches(x, '^[A-Z]{2,6}$')))) AS code FROM documents)
SELECT code, count(*) AS n, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs, min(doc_id) AS first_doc_id FROM w GROUP BY 1 HAVING count(*) >= 3""")
def acronym_registry(spark, d):
    codes = F.array_distinct(F.filter(F.split("text", r"[^\p{L}\p{N}]+"), lambda x: F.rlike(x, F.lit("^[A-Z]{2,6}$"))))
    w = table(spark, d, "documents").select("doc_id", "lang", F.explode(codes).alias("code"))
    found = w.groupBy("code").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("langs"), F.min("doc_id").alias("first_doc_id"))
    return found.where("n >= 3")


@query("""
WITH o AS (SELECT n_name, o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
g AS (SELECT n_name, p, min(day) AS f, max(day) AS l, count(*) AS n FROM o GROUP BY 1, 2)
SELECT n_name, string_agg(p, ',' ORDER BY f, p) AS listed, CAST(sum(n) AS BIGINT) AS n, max(l) AS latest FROM g GROUP BY 1""")
def regulation_summary(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("day", F.to_date("o_orderdate"))
    return lifecycle.first_seen_lists(o, "n_name", "o_orderpriority", "day")


@query("SELECT s_suppkey, s_nationkey, CAST(floor((row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) / 6) AS BIGINT) AS block FROM supplier")
def slide_blocks(spark, d):
    return lifecycle.blocks(table(spark, d, "supplier"), "s_nationkey", [F.col("s_suppkey")]).select("s_suppkey", "s_nationkey", "block")


@query("""
WITH a AS (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20 UNION SELECT s_suppkey FROM supplier WHERE s_nationkey >= 15)
SELECT s_suppkey, s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 50) AS inactive FROM a""")
def source_overlay(spark, d):
    s = table(spark, d, "supplier")
    gone = table(spark, d, "lineitem").where("l_quantity >= 50").select(F.col("l_suppkey").alias("s_suppkey"))
    return lifecycle.overlay(s.where("s_nationkey < 20"), s.where("s_nationkey >= 15"), gone, "s_suppkey").select("s_suppkey", "inactive")


@query("SELECT 'p_brand' AS grp, p_brand AS label, count(*) AS n FROM part GROUP BY 2 UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY 2")
def keyword_unpivot(spark, d):
    long = table(spark, d, "part").unpivot(["p_partkey"], ["p_brand", "p_type"], "grp", "label")
    return long.groupBy("grp", "label").agg(F.count("*").alias("n"))


@query("WITH f AS (SELECT user_id, event_type, min(CAST(ts AS DATE)) AS day FROM events GROUP BY 1, 2) SELECT CAST(date_trunc('week', day) AS DATE) AS week, count(*) AS n FROM f GROUP BY 1")
def new_facts_by_week(spark, d):
    first = _days(spark, d).groupBy("user_id", "event_type").agg(F.min("day").alias("day"))
    return first.groupBy(F.trunc("day", "week").alias("week")).agg(F.count("*").alias("n"))


@query("""
SELECT count(*) FILTER (o_orderdate >= TIMESTAMP '1998-06-01') AS recent, count(*) FILTER (o_orderstatus = 'O') AS open, count(DISTINCT c_nationkey) AS countries,
  max(CAST(o_orderdate AS DATE)) AS latest FROM orders JOIN customer ON o_custkey = c_custkey""")
def key_figures(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.agg(
        F.count(F.when(F.col("o_orderdate") >= F.lit("1998-06-01").cast("timestamp"), 1)).alias("recent"),
        F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("open"),
        F.countDistinct("c_nationkey").alias("countries"),
        F.max(F.to_date("o_orderdate")).alias("latest"),
    )


@query("""
WITH r AS (SELECT event_type, user_id, min(CAST(ts AS DATE)) AS f, max(CAST(ts AS DATE)) AS l FROM events WHERE event_type IN ('signup', 'error') GROUP BY 1, 2)
SELECT event_type, user_id FROM r WHERE f <= DATE '2024-01-05' AND l >= DATE '2024-01-03'""")
def period_overlap(spark, d):
    """Drafts and expected topics whose interval of signals meets the period."""
    e = _days(spark, d)
    parts = [summarise.register(e.where(F.col("event_type") == kind), ["event_type", "user_id"], "day", "event_id") for kind in ("signup", "error")]
    return parts[0].unionByName(parts[1]).where("first_at <= date '2024-01-05' and last_at >= date '2024-01-03'").select("event_type", "user_id")
