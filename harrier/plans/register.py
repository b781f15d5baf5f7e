"""Registered queries on the register of key points and on reports, each beside its SQL. Orders stand in for articles."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import table
from ..operators import alerts, listing, relate, report, select, versions
from ..session import shared_folder
from .catalogue import _days, query

DAY = "1998-07-15"
_ARTICLES = """(SELECT o_orderkey AS id, 'Z' || (o_custkey % 25) AS zone, CASE WHEN o_orderkey % 6 > 0 THEN o_orderpriority END AS text, o_orderstatus AS stage, 'S' || (o_custkey % 40) AS source,
  CAST(o_orderdate AS DATE) AS detected, CAST(o_orderdate AS DATE) - CAST(o_orderkey % 40 AS INTEGER) AS published, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 300 AS INTEGER) AS due, o_orderkey % 3 = 0 AS official, o_orderkey % 4 <> 0 AS to_verify,
  ['elevee', 'elevee', 'elevee', 'moyenne', 'moyenne', 'faible', 'faible', 'ecarte'][CAST(o_orderkey * 7919 % 8 AS INTEGER) + 1] AS level, o_orderkey * 7919 % 13 < 4 AS essential, (o_orderkey * 7919 % 1000) / 1000.0::DOUBLE AS score FROM orders)"""


def articles(spark, d):
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    levels = F.array(*map(F.lit, ["elevee", "elevee", "elevee", "moyenne", "moyenne", "faible", "faible", "ecarte"]))
    return table(spark, d, "orders").select(
        k.alias("id"), F.concat(F.lit("Z"), F.col("o_custkey") % 25).alias("zone"), F.when(k % 6 > 0, F.col("o_orderpriority")).alias("text"), F.col("o_orderstatus").alias("stage"),
        F.concat(F.lit("S"), F.col("o_custkey") % 40).alias("source"), day.alias("detected"), F.date_sub(day, (k % 40).cast("int")).alias("published"),
        F.date_add(day, (k % 300).cast("int")).alias("due"), (k % 3 == 0).alias("official"), (k % 4 != 0).alias("to_verify"),
        F.get(levels, (k * 7919 % 8).cast("int")).alias("level"), (k * 7919 % 13 < 4).alias("essential"), (k * 7919 % 1000 / 1000.0).alias("score"),
    )


_KEPT = "text IS NOT NULL AND level IN ('elevee', 'moyenne')"


@query(f"""
WITH g AS (SELECT text, zone, stage, min(detected) AS first_at, max(detected) AS last_at, min(published) AS p, max(published) AS latest, count(*) AS n, bool_and(to_verify) AS to_verify,
  arg_max(id, (published, detected, id)) AS lead FROM {_ARTICLES} WHERE {_KEPT} GROUP BY 1, 2, 3)
SELECT text, zone, stage, first_at, last_at, latest, n, to_verify, lead, least(first_at, p + 14) + 28 AS ends, least(first_at, p + 14) + 28 >= DATE '{DAY}' AS active FROM g""")
def alert_windows(spark, d):
    return alerts.windows(articles(spark, d).where(_KEPT), ["text", "zone", "stage"], "detected", "published", "to_verify", "id", DAY)


#: The runs of a month, a week apart, and the rows that ever are key points in them.
RUNS = ["1998-06-08", "1998-06-15", "1998-06-22", "1998-06-29"]
_SEEN = "detected BETWEEN DATE '1998-05-01' AND DATE '1998-06-29' AND level IN ('elevee', 'moyenne')"


@query(f"""
WITH a AS (SELECT *, ['adopte', 'a_qualifier', 'signale'][CAST(id % 3 AS INTEGER) + 1] AS kind FROM {_ARTICLES} WHERE {_SEEN}), r AS (SELECT unnest({RUNS}) AS run),
v AS (SELECT run, a.*, CASE WHEN text IS NULL OR kind = 'a_qualifier' THEN 'art|' || id ELSE 'txt|' || text || '|' || zone || '|' || stage END AS k FROM r JOIN a ON detected <= CAST(run AS DATE)),
g AS (SELECT run, k, arg_min(kind, (detected, id)) AS kind, any_value(text) AS text, min(zone) AS zone, min(detected) AS first_at, max(detected) AS last_at, count(*) AS n, least(min(detected), min(published) + 14) + 28 AS ends,
  array_to_string(list(id ORDER BY published DESC, detected DESC, id DESC)[1:6], ',') AS articles FROM v GROUP BY 1, 2)
SELECT run, kind, text, zone, first_at, last_at, n, CAST(ends AS DATE) AS ends, ends >= CAST(run AS DATE) AS active, articles FROM g""")
def weekly_register(spark, d):
    """Key points as each weekly run left them, read from the intervals of a register that four runs, the last one twice, wrote."""
    kinds = F.array(*map(F.lit, ["adopte", "a_qualifier", "signale"]))
    a = articles(spark, d).where(_SEEN).withColumn("kind", F.get(kinds, (F.col("id") % 3).cast("int"))).withColumn("version", F.col("detected").cast("string"))
    store = versions.Store(spark, f"{shared_folder(spark)}/register-{uuid.uuid4().hex}")
    for run in [*RUNS, RUNS[-1]]:
        seen = a.where(F.col("detected") <= F.lit(run).cast("date"))
        store.run(seen, seen.select("id"), run, run)
    found = None
    for run in RUNS:
        one = versions.as_of(store.read(), run).select(F.lit(run).alias("run"), "kind", "text", "zone", "first_at", "last_at", "n", "ends", (F.col("ends") >= F.lit(run).cast("date")).alias("active"), F.array_join("articles", ",").alias("articles"))
        found = one if found is None else found.unionByName(one)
    return found


_OWN = f"SELECT text || '/' || zone AS alert, id FROM {_ARTICLES} WHERE {_KEPT} QUALIFY row_number() OVER (PARTITION BY text, zone ORDER BY published DESC, id) <= 6"


def _own(a):
    listed = alerts.latest_articles(a.where(_KEPT), ["text", "zone"], [F.desc("published"), F.col("id")], "id")
    return listed.select(F.concat_ws("/", "text", "zone").alias("alert"), F.explode("articles").alias("id"))


@query(f"WITH o AS ({_OWN}) SELECT alert, o.id, o_totalprice AS price FROM o JOIN orders ON o_orderkey = o.id")
def alert_articles(spark, d):
    """The articles a key point lists, six at most, with a column of theirs."""
    full = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    return _own(articles(spark, d)).join(full, "id").select("alert", "id", "price")


@query(f"""
SELECT zone, CAST(l_shipdate AS DATE) AS day, arg_min(id, (published, id)) AS id, arg_min(coalesce(text, ''), (published, id)) AS text FROM {_ARTICLES} JOIN lineitem ON l_orderkey = id
WHERE essential AND level IN ('elevee', 'moyenne') AND l_linenumber <> 2 AND CAST(l_shipdate AS DATE) >= published GROUP BY 1, 2""")
def deadline_alerts(spark, d):
    li = table(spark, d, "lineitem").where("l_linenumber <> 2").select(F.col("l_orderkey").alias("id"), F.to_date("l_shipdate").alias("day"))
    dated = articles(spark, d).where("essential and level in ('elevee', 'moyenne')").join(li, "id").where("day >= published").withColumn("text", F.coalesce("text", F.lit("")))
    return alerts.deadline_alerts(dated, "zone", "day", ["published", "id"], ["id", "text"])


_YEAR = f"published >= DATE '{DAY}' - 365"


@query(f"""
WITH own AS ({_OWN}), x AS (SELECT DISTINCT text || '/' || zone AS alert, text FROM {_ARTICLES} WHERE {_KEPT})
SELECT alert, a.id, row_number() OVER (PARTITION BY alert ORDER BY published DESC, a.id) AS place FROM x JOIN (SELECT * FROM {_ARTICLES} WHERE {_YEAR}) a USING (text)
WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.alert = x.alert AND own.id = a.id) QUALIFY place <= 80""")
def linked_by_text(spark, d):
    """The latest 80 articles on a key point's text, besides its own."""
    a = articles(spark, d)
    mine = a.where(_KEPT).select(F.concat_ws("/", "text", "zone").alias("alert"), "text")
    return alerts.linked(mine, _own(a), a.where(f"published >= date_sub(date'{DAY}', 365) and text is not null").select("id", "text", "published"), "alert", "text", "id", "published")


@query(f"""
WITH own AS ({_OWN}), x AS (SELECT DISTINCT alert, t FROM own JOIN {_ARTICLES} a USING (id), unnest([source, stage || zone]) AS u(t)),
a AS (SELECT id, published, unnest([source, stage || zone]) AS t FROM {_ARTICLES} WHERE {_YEAR}), p AS (SELECT DISTINCT alert, a.id, published FROM x JOIN a USING (t))
SELECT alert, id, row_number() OVER (PARTITION BY alert ORDER BY published DESC, id) AS place FROM p WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.alert = p.alert AND own.id = p.id) QUALIFY place <= 80""")
def linked_by_terms(spark, d):
    """The latest 80 articles that share a term with a key point's own ones."""
    a = articles(spark, d)
    termed = a.select("id", "published", F.explode(F.array("source", F.concat("stage", "zone"))).alias("term"))
    mine = _own(a).join(termed, "id").select("alert", "term")
    return alerts.linked(mine, _own(a), termed.where(f"published >= date_sub(date'{DAY}', 365)"), "alert", "term", "id", "published")


#: Invented names and sigla, each cited by the orders whose key leaves its remainder.
NAMED = [("Cyber Harvest Act", 701, 0), ("Harvest Act", 701, 1), ("Harvest Act", 701, 0), ("CHA", 701, 0), ("CHA", 701, 2), ("River Safety Code", 353, 3), ("Safety Code", 353, 3), ("Safety Code", 353, 4), ("Safety Code", 353, 5), ("Old Law", 97, 6), ("Lone Rule", 1499, 7), ("Moon Light Data Law", 401, 8), ("Light Data Law", 401, 8), ("Data Law", 401, 8), ("Data Law", 401, 9)]
_TERMS = " UNION ALL ".join(f"SELECT '{n}' AS term, id, source, published, official, stage, text FROM {_ARTICLES} WHERE id % {m} = {r}{'' if n == 'Old Law' else f' AND published >= DATE {chr(39)}1996-01-01{chr(39)}'}" for n, m, r in NAMED)


@query(f"""
WITH t AS (SELECT *, published >= DATE '1996-01-01' AS win, term = upper(term) AS sig FROM ({_TERMS})),
s AS (SELECT * FROM t WHERE win AND lower(term) NOT IN (SELECT lower(term) FROM t WHERE NOT win)),
p AS (SELECT x.term AS siglum, y.term AS name, count(DISTINCT x.id) AS shared FROM s x JOIN s y ON x.id = y.id WHERE x.sig AND NOT y.sig AND starts_with(regexp_replace(y.term, '([A-Z])[^A-Z]*', '\\1', 'g'), x.term) GROUP BY 1, 2),
al AS (SELECT siglum, arg_max(name, (shared, name)) AS name FROM p GROUP BY 1),
m AS (SELECT coalesce(al.name, term) AS name, id, source, official, stage, text FROM s LEFT JOIN al ON siglum = term),
g AS (SELECT name, count(DISTINCT id) AS articles FROM m GROUP BY 1 HAVING (count(DISTINCT id) >= 3 OR (count(DISTINCT id) >= 2 AND bool_or(official))) AND count(DISTINCT source) >= 2 AND bool_or(stage = 'O')
  AND 2 * count(DISTINCT CASE WHEN text = '1-URGENT' THEN id END) <= count(DISTINCT id)),
i AS (SELECT a.name, b.name AS longer FROM g a JOIN g b ON a.name <> b.name AND contains(' ' || b.name || ' ', ' ' || a.name || ' ')
  WHERE 2 * (SELECT count(DISTINCT x.id) FROM m x JOIN m y ON x.id = y.id WHERE x.name = a.name AND y.name = b.name) >= a.articles),
k4 AS (SELECT name FROM g WHERE len(string_split(name, ' ')) >= 4), k3 AS (SELECT name FROM g WHERE len(string_split(name, ' ')) = 3 AND name NOT IN (SELECT i.name FROM i WHERE longer IN (FROM k4))),
k2 AS (SELECT name FROM g WHERE len(string_split(name, ' ')) <= 2 AND name NOT IN (SELECT i.name FROM i WHERE longer IN (FROM k4 UNION ALL FROM k3)))
SELECT g.name, (SELECT min(siglum) FROM al WHERE al.name = g.name) AS siglum, articles FROM g WHERE name IN (FROM k4 UNION ALL FROM k3 UNION ALL FROM k2)""")
def emerging_names(spark, d):
    a = articles(spark, d)
    cited = F.array_compact(F.array(*[F.when((F.col("id") % m == r) & ((F.col("published") >= F.lit("1996-01-01").cast("date")) | F.lit(n == "Old Law")), F.lit(n)) for n, m, r in NAMED]))
    t = a.withColumn("term", F.explode(cited)).withColumn("in_window", F.col("published") >= F.lit("1996-01-01").cast("date"))
    t = t.withColumns({"is_siglum": F.col("term") == F.upper("term"), "keyed": F.coalesce(F.col("text") == "1-URGENT", F.lit(False)), "signal": F.col("stage") == "O"})
    return alerts.emerging_names(t, "id")


_PERIOD = "published BETWEEN DATE '1998-05-01' AND DATE '1998-07-15'"


@query(f"""
SELECT text, zone, stage, count(*) AS n, arg_min(id, (CASE level WHEN 'elevee' THEN 0 WHEN 'moyenne' THEN 1 WHEN 'faible' THEN 2 ELSE 3 END, NOT official, -epoch(published)::BIGINT, id)) AS lead, bool_or(to_verify OR level = 'faible') AS verify
FROM {_ARTICLES} WHERE {_PERIOD} AND level <> 'ecarte' GROUP BY text, zone, stage, CASE WHEN text IS NULL THEN id END""")
def slide_groups(spark, d):
    a = articles(spark, d).where(f"{_PERIOD} and level <> 'ecarte'")
    lead = [report.rank_of(F.col("level"), report.LEVELS), ~F.col("official"), -F.unix_date("published"), F.col("id")]
    return report.groups(a, "text", ["zone", "stage"], "id", lead, F.col("to_verify") | (F.col("level") == "faible"))


@query("SELECT p_size % 10 + 1 AS category, p_type AS zone, count(*) AS n FROM part WHERE p_size % 10 + 1 IN (1, 2, 3) AND contains(lower(p_name), 'ring') GROUP BY 1, 2")
def applicable_texts(spark, d):
    texts = table(spark, d, "part").select((F.col("p_size") % 10 + 1).alias("category"), F.col("p_type").alias("zone"), "p_name")
    return select.facets(texts, {"category": [1, 2, 3]}).where(select.holds_all(F.col("p_name"), ["ring"])).groupBy("category", "zone").agg(F.count("*").alias("n"))


@query(f"""
WITH a AS (SELECT * FROM {_ARTICLES} WHERE level <> 'ecarte'), t AS (SELECT zone, text, count(*) AS n FROM a WHERE text IS NOT NULL GROUP BY 1, 2)
SELECT zone, 'texts' AS section, row_number() OVER (PARTITION BY zone ORDER BY n DESC, text) AS place, text AS shown FROM t QUALIFY place <= 5
UNION ALL SELECT zone, 'due', row_number() OVER (PARTITION BY zone ORDER BY due, id) AS place, CAST(id AS VARCHAR) FROM a WHERE due >= DATE '{DAY}' QUALIFY place <= 6
UNION ALL SELECT zone, 'articles', row_number() OVER (PARTITION BY zone ORDER BY published DESC, id) AS place, CAST(id AS VARCHAR) FROM a QUALIFY place <= 15""")
def country_sheets(spark, d):
    """Five texts, the next six deadlines and fifteen articles of each zone: the lengths of the sheet."""
    a = articles(spark, d).where("level <> 'ecarte'")
    counted = a.where("text is not null").groupBy("zone", "text").agg(F.count("*").alias("n"))
    sections = {
        "texts": (counted, [F.desc("n"), F.col("text")], F.col("text"), 5),
        "due": (a.where(f"due >= date'{DAY}'"), [F.col("due"), F.col("id")], F.col("id"), 6),
        "articles": (a, [F.desc("published"), F.col("id")], F.col("id"), 15),
    }
    return report.top_of_each(a, "zone", sections)


@query(f"SELECT id FROM {_ARTICLES} WHERE essential AND level = 'elevee' ORDER BY official DESC, published DESC, id LIMIT 60")
def summary_candidates(spark, d):
    """The 60 essential articles a run has the budget to summarise."""
    return articles(spark, d).where("essential and level = 'elevee'").orderBy(F.desc("official"), F.desc("published"), "id").limit(60).select("id")


@query(f"WITH g AS (SELECT coalesce(text, '') AS text, count(*) AS n FROM {_ARTICLES} WHERE essential GROUP BY 1) SELECT text, n, row_number() OVER (ORDER BY text = '', n DESC, text) AS place FROM g")
def essential_by_text(spark, d):
    g = articles(spark, d).where("essential").groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(F.count("*").alias("n"))
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.col("text") == "", F.desc("n"), "text")))  # a row for each text


@query(f"SELECT split_part(level || ' : ' || coalesce(text, 'none'), ' : ', 1) AS reason, count(*) AS n FROM {_ARTICLES} WHERE NOT essential GROUP BY 1")
def reason_counts(spark, d):
    reason = F.concat_ws(" : ", "level", F.coalesce("text", F.lit("none")))
    return articles(spark, d).where("not essential").groupBy(F.split_part(reason, F.lit(" : "), F.lit(1)).alias("reason")).agg(F.count("*").alias("n"))


@query("WITH s AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS state FROM events GROUP BY 1) SELECT state, count(*) AS n FROM s GROUP BY 1")
def access_states(spark, d):
    last = table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"))
    return last.groupBy("state").agg(F.count("*").alias("n"))


@query(f"""
SELECT max(detected) AS run, count(*) AS total, count(*) FILTER (detected = (SELECT max(detected) FROM {_ARTICLES})) AS new, count(*) FILTER (essential) AS essential,
  count(*) FILTER (level = 'ecarte') AS discarded, count(DISTINCT source) AS sources FROM {_ARTICLES}""")
def run_summary(spark, d):
    a = articles(spark, d)
    last = a.agg(F.max("detected").alias("run"))
    count = lambda c: F.count(F.when(c, 1))
    both = a.crossJoin(F.broadcast(last))
    return both.groupBy("run").agg(
        F.count("*").alias("total"), count(F.col("detected") == F.col("run")).alias("new"), count(F.col("essential")).alias("essential"), count(F.col("level") == "ecarte").alias("discarded"), F.countDistinct("source").alias("sources")
    )


@query(f"SELECT count(DISTINCT zone) AS zones, count(*) FILTER (level = 'elevee') AS high, count(*) FILTER (level = 'moyenne') AS medium, count(DISTINCT due) FILTER (NOT to_verify AND due >= DATE '{DAY}') AS dates FROM {_ARTICLES} WHERE {_PERIOD}")
def report_overview(spark, d):
    a = articles(spark, d).where(_PERIOD)
    count = lambda level: F.count(F.when(F.col("level") == level, 1))
    dates = F.countDistinct(F.when(~F.col("to_verify") & (F.col("due") >= F.lit(DAY).cast("date")), F.col("due")))
    return a.agg(F.countDistinct("zone").alias("zones"), count("elevee").alias("high"), count("moyenne").alias("medium"), dates.alias("dates"))


@query(f"WITH g AS (SELECT stage, count(*) AS n FROM {_ARTICLES} WHERE {_PERIOD} GROUP BY 1) SELECT stage, n, row_number() OVER (ORDER BY n DESC, stage) AS place FROM g")
def stage_breakdown(spark, d):
    g = articles(spark, d).where(_PERIOD).groupBy("stage").agg(F.count("*").alias("n"))
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "stage")))  # a row for each stage


@query(f"""
WITH a AS (SELECT * FROM {_ARTICLES} WHERE {_PERIOD}), z AS (SELECT text, zone, min(published) AS f FROM a GROUP BY 1, 2), s AS (SELECT text, stage, min(published) AS f FROM a GROUP BY 1, 2)
SELECT text, count(*) AS n, min(due) FILTER (due >= DATE '{DAY}') AS next_due, (SELECT string_agg(zone, ',' ORDER BY f, zone) FROM z WHERE z.text IS NOT DISTINCT FROM a.text) AS zones,
  (SELECT string_agg(stage, ',' ORDER BY f, stage) FROM s WHERE s.text IS NOT DISTINCT FROM a.text) AS stages, row_number() OVER (ORDER BY text IS NULL, count(*) DESC, text)::INTEGER AS place FROM a GROUP BY text""")
def regulation_report(spark, d):
    return report.text_summary(articles(spark, d).where(_PERIOD), "text", "zone", "stage", "published", "due", DAY)


@query(f"SELECT due, coalesce(text, CAST(id AS VARCHAR)) AS what, min(id) AS id FROM {_ARTICLES} WHERE NOT to_verify AND {_PERIOD} GROUP BY 1, 2")
def regulatory_calendar(spark, d):
    a = articles(spark, d).where(f"not to_verify and {_PERIOD}")
    return a.groupBy("due", F.coalesce("text", F.col("id").cast("string")).alias("what")).agg(F.min("id").alias("id"))


@query(f"WITH a AS (SELECT * FROM {_ARTICLES} WHERE essential) SELECT id, row_number() OVER (ORDER BY published DESC, id) AS place, greatest((SELECT count(*) FROM a) - 350, 0) AS hidden FROM a QUALIFY place <= 350")
def footnotes(spark, d):
    """The numbered sources of a report, 350 at most, and how many it leaves out."""
    return report.cut(articles(spark, d).where("essential"), [F.desc("published"), F.col("id")]).select("id", "place", "hidden")


@query(f"SELECT id FROM {_ARTICLES} WHERE level <> 'ecarte' ORDER BY published DESC, detected DESC, id LIMIT 5000")
def article_list(spark, d):
    """The 5000 latest kept articles, the reference size of the list."""
    return articles(spark, d).where("level <> 'ecarte'").orderBy(F.desc("published"), F.desc("detected"), "id").limit(5000).select("id")


@query(f"SELECT id FROM {_ARTICLES} WHERE level = 'ecarte' AND detected >= DATE '{DAY}' - 1200 ORDER BY detected DESC, published DESC, id LIMIT 4000")
def discarded_list(spark, d):
    """The 4000 latest discarded articles of a span, the reference size of the list."""
    a = articles(spark, d).where(f"level = 'ecarte' and detected >= date_sub(date'{DAY}', 1200)")
    return a.orderBy(F.desc("detected"), F.desc("published"), "id").limit(4000).select("id")


@query(f"SELECT id FROM {_ARTICLES} WHERE level = 'ecarte' ORDER BY detected DESC, published DESC, id LIMIT 8000")
def discarded_kept(spark, d):
    """The 8000 latest of all discarded articles, the reference size of what is kept of them."""
    return articles(spark, d).where("level = 'ecarte'").orderBy(F.desc("detected"), F.desc("published"), "id").limit(8000).select("id")


@query(f"""
WITH g AS (SELECT text, zone FROM {_ARTICLES} WHERE {_KEPT} GROUP BY 1, 2 HAVING least(min(detected), min(published) + 14) + 28 >= DATE '{DAY}'), o AS ({_OWN})
SELECT id, published >= DATE '{DAY}' - 183 OR official OR id IN (SELECT o.id FROM o JOIN g ON o.alert = g.text || '/' || g.zone) AS hot FROM {_ARTICLES}""")
def hot_articles(spark, d):
    """Articles that a first page loads: of the last 183 days, of the base (official here), and those of active key points."""
    a = articles(spark, d)
    w = alerts.windows(a.where(_KEPT), ["text", "zone"], "detected", "published", "to_verify", "id", DAY).where("active").select(F.concat_ws("/", "text", "zone").alias("alert"))
    active = _own(a).join(w, "alert", "left_semi").select("id")
    return listing.hot(a, "id", "published", F.col("official"), active, DAY).select("id", "hot")


_RANK = "CASE level WHEN 'elevee' THEN 0 WHEN 'moyenne' THEN 1 WHEN 'faible' THEN 2 ELSE 3 END"


@query(f"SELECT id FROM {_ARTICLES} ORDER BY essential DESC, {_RANK}, published DESC, id LIMIT 5000")
def translation_queue(spark, d):
    """The 5000 texts a run translates: base first, then by level, then the most recent."""
    return articles(spark, d).orderBy(F.desc("essential"), report.rank_of(F.col("level"), report.LEVELS), F.desc("published"), "id").limit(5000).select("id")


@query(f"""
SELECT id, row_number() OVER (PARTITION BY zone ORDER BY published DESC, {_RANK}, id) AS by_date, row_number() OVER (PARTITION BY zone ORDER BY {_RANK}, score DESC, published DESC, id) AS by_level,
  row_number() OVER (PARTITION BY zone ORDER BY due DESC, published DESC, id) AS by_amount FROM {_ARTICLES} WHERE {_PERIOD}""")
def watch_sorts(spark, d):
    level, late = report.rank_of(F.col("level"), report.LEVELS), F.desc("published")
    orders = {"by_date": [late, level, F.col("id")], "by_level": [level, F.desc("score"), late, F.col("id")], "by_amount": [F.desc("due"), late, F.col("id")]}
    return report.placed(articles(spark, d).where(_PERIOD), ["zone"], orders).select("id", *orders)


@query(f"""
WITH a AS (SELECT *, ['echeance', 'adopte', 'signale', 'proposition', 'a_qualifier'][CAST(id % 5 AS INTEGER) + 1] AS kind FROM {_ARTICLES} WHERE {_PERIOD})
SELECT id, row_number() OVER (PARTITION BY zone ORDER BY detected DESC, CASE kind WHEN 'echeance' THEN 1 WHEN 'proposition' THEN 3 WHEN 'a_qualifier' THEN 4 ELSE 2 END, published DESC, id) AS place,
  row_number() OVER (PARTITION BY zone ORDER BY kind = 'adopte', kind = 'signale', published DESC, id) AS topic_place FROM a""")
def alert_sort(spark, d):
    kinds = F.array(*map(F.lit, ["echeance", "adopte", "signale", "proposition", "a_qualifier"]))
    a = articles(spark, d).where(_PERIOD).withColumn("kind", F.get(kinds, (F.col("id") % 5).cast("int")))
    kind, late = F.col("kind"), F.desc("published")
    orders = {"place": [F.desc("detected"), report.rank_of(kind, report.TYPES), late, F.col("id")], "topic_place": [kind == "adopte", kind == "signale", late, F.col("id")]}
    return report.placed(a, ["zone"], orders).select("id", *orders)


@query("SELECT c_custkey AS key, c_mktsegment AS segment, NULL AS brand FROM customer WHERE c_acctbal > 0 UNION ALL SELECT p_partkey, NULL, p_brand FROM part WHERE p_size > 10")
def kept_and_base(spark, d):
    """Kept rows and the knowledge base, which lack columns of each other."""
    kept = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    base = table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand"))
    return kept.unionByName(base, allowMissingColumns=True)


@query(f"SELECT level, state, count(*) AS n FROM (SELECT level, CASE WHEN level = 'ecarte' THEN 'discarded' WHEN stage = 'P' THEN 'debate' ELSE 'kept' END AS state FROM {_ARTICLES}) GROUP BY 1, 2")
def reevaluated(spark, d):
    """Kept and discarded rows together for another judgement, then parted in three."""
    a = articles(spark, d)
    again = a.where("level <> 'ecarte'").unionByName(a.where("level = 'ecarte'"))
    gone, debate = F.col("level") == "ecarte", F.col("stage") == "P"
    parts = {"discarded": gone, "debate": ~gone & debate, "kept": ~gone & ~debate}
    state = F.coalesce(*[F.when(c, F.lit(n)) for n, c in parts.items()])
    return again.groupBy("level", state.alias("state")).agg(F.count("*").alias("n"))


@query("""
WITH g AS (SELECT o_custkey, list_distinct(list(o_orderpriority) FILTER (o_orderstatus = 'F')) AS a, list_distinct(list(o_orderpriority) FILTER (o_orderstatus = 'O')) AS b FROM orders GROUP BY 1)
SELECT o_custkey FROM g WHERE len(a) > 0 AND 2 * len(list_intersect(a, coalesce(b, []))) >= len(a)""")
def half_shared(spark, d):
    """Keys whose two sets of codes have half of the first in common."""
    only = lambda s: F.collect_set(F.when(F.col("o_orderstatus") == s, F.col("o_orderpriority")))  # noqa: E731 a closed list of codes
    g = table(spark, d, "orders").groupBy("o_custkey").agg(only("F").alias("a"), only("O").alias("b"))
    return g.where((F.size("a") > 0) & (2 * F.size(F.array_intersect("a", "b")) >= F.size("a"))).select("o_custkey")


@query("SELECT conv_id, turn, array_to_string(list_distinct(list_sort(regexp_split_to_array(lower(text), '[^a-z]+'))), ' ') AS words FROM conversations WHERE text IS NOT NULL".replace("list_distinct(list_sort(", "list_sort(list_distinct("))
def distinct_words(spark, d):
    c = table(spark, d, "conversations").where("text is not null")
    return c.select("conv_id", "turn", F.array_join(F.array_sort(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))), " ").alias("words"))


@query("SELECT conv_id, turn, array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i), ' ') AS words FROM (SELECT conv_id, turn, regexp_split_to_array(lower(text), '[^a-z]+') AS w FROM conversations WHERE text IS NOT NULL)")
def words_in_order(spark, d):
    """Each word once, where it first stands."""
    c = table(spark, d, "conversations").where("text is not null")
    return c.select("conv_id", "turn", F.array_join(F.array_distinct(F.split(F.lower("text"), "[^a-z]+")), " ").alias("words"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def registry_left(spark, d):
    """The registry without keys that are gone from the site."""
    there = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(there, "c_custkey", "left_semi").select("c_custkey")


@query("SELECT event_id FROM events WHERE strftime(ts, '%Y-%m-%d-%H%M') > '2024-01-20-1200' AND event_type <> 'signup'")
def since_visit(spark, d):
    """Rows of runs after the last visit; runs are named by their time, and 'base' (here: signup) is none."""
    run = F.date_format("ts", "yyyy-MM-dd-HHmm")
    return table(spark, d, "events").where((run > "2024-01-20-1200") & (F.col("event_type") != "signup")).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31' AND o_orderpriority <> '5-LOW' AND o_orderkey % 7 <> 0")
def site_rows(spark, d):
    """What the site shows of a period, both days included: no opinions, no duplicates."""
    o = table(spark, d, "orders").where("o_orderdate >= timestamp'1997-03-01' and o_orderdate < timestamp'1997-04-01'")
    return o.where("o_orderpriority <> '5-LOW' and o_orderkey % 7 <> 0").select("o_orderkey")


@query("""
WITH o AS (SELECT o_custkey, [o_orderpriority, o_orderstatus] AS actors, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS nth FROM orders),
u AS (SELECT o_custkey, actors[1] AS actor, nth * 10 AS i FROM o WHERE nth <= 6 UNION ALL SELECT o_custkey, actors[2], nth * 10 + 1 FROM o WHERE nth <= 6),
f AS (SELECT o_custkey, actor, min(i) AS pos FROM u GROUP BY 1, 2)
SELECT o_custkey, string_agg(actor, ',' ORDER BY pos) AS actors FROM f GROUP BY 1""")
def actors_in_order(spark, d):
    """The actors of a key point's six latest articles, in the order named."""
    o = relate.first_per(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")], alerts.OWN)
    listed = F.sort_array(F.collect_list(F.struct("rank_in_group", F.array("o_orderpriority", "o_orderstatus").alias("actors"))))  # six at most
    return o.groupBy("o_custkey").agg(F.array_join(F.array_distinct(F.flatten(F.transform(listed, lambda x: x["actors"]))), ",").alias("actors"))


@query("""
WITH f AS (SELECT CAST(ts AS DATE) AS day, user_id FROM events WHERE event_type = 'purchase'), m AS (SELECT unnest(generate_series(DATE '2024-01-07', DATE '2024-01-28', INTERVAL 7 DAY))::DATE AS week),
s AS (SELECT week, user_id, count(*) AS n FROM m JOIN f ON day <= week GROUP BY 1, 2)
SELECT week, count(*) AS keys, count(*) FILTER (first_week = week) AS new FROM (SELECT *, min(week) OVER (PARTITION BY user_id) AS first_week FROM s WHERE n >= 2) GROUP BY 1""")
def weekly_replay(spark, d):
    """The register as it stood at the end of each week, and what was new in it. A user's counts are by week, so a week's
    state is a running sum and no row is repeated for later weeks."""
    e = _days(spark, d).where("event_type = 'purchase'")
    week = F.date_add(F.lit("2024-01-07").cast("date"), (F.ceil(F.greatest(F.datediff("day", F.lit("2024-01-07")), F.lit(0)) / 7) * 7).cast("int"))
    by_week = e.groupBy("user_id", week.alias("week")).agg(F.count("*").alias("c")).where("week <= date'2024-01-28'")
    weeks = F.expr("sequence(date'2024-01-07', date'2024-01-28', interval 7 day)")
    known = by_week.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("week", "c"))).alias("m"))  # a week each
    upto = lambda w: F.aggregate(F.filter(F.map_entries("m"), lambda x: x["key"] <= w), F.lit(0).cast("long"), lambda s, x: s + x["value"])
    states = known.withColumn("states", F.filter(weeks, lambda w: upto(w) >= 2)).select(F.explode("states").alias("week"), F.get("states", F.lit(0)).alias("first_week"))
    return states.groupBy("week").agg(F.count("*").alias("keys"), F.count(F.when(F.col("first_week") == F.col("week"), 1)).alias("new"))
