"""Registered queries on what a run takes in, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import table
from ..functions import questions, text as T
from ..operators import intake, select, summarise
from .catalogue import _TITLE, _days, query
from .register import _ARTICLES, _PERIOD, DAY, articles


@query(f"""
WITH i AS (SELECT id, source, CASE WHEN id % 9 > 0 THEN published END AS day FROM {_ARTICLES}), v AS (SELECT DISTINCT source FROM i WHERE source < 'S20')
SELECT id FROM i LEFT JOIN v USING (source) WHERE id % 5 > 0 AND CASE WHEN v.source IS NOT NULL THEN day IS NULL OR (day >= DATE '1997-09-01' AND DATE '{DAY}' - day <= 365)
  ELSE coalesce(day >= DATE '1997-09-01' AND DATE '{DAY}' - day <= 60, false) END""".replace("LEFT JOIN v USING (source)", "LEFT JOIN v ON v.source = i.source"))
def admitted_items(spark, d):
    a = articles(spark, d).select("id", "source", F.when(F.col("id") % 9 > 0, F.col("published")).alias("day"))
    return intake.admitted(a, a.where("id % 5 = 0"), a.where("source < 'S20'"), "id", "source", "day", "1997-09-01", DAY).select("id")


@query(f"""
WITH k AS (SELECT doc_id, source, {_TITLE} AS k FROM documents WHERE source IS NOT NULL AND text IS NOT NULL)
SELECT source, k, min(doc_id) AS doc_id FROM k WHERE doc_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM k s WHERE s.doc_id % 2 = 0 AND s.source = k.source AND s.k = k.k) GROUP BY 1, 2""")
def unseen_titles(spark, d):
    k = table(spark, d, "documents").where("source is not null and text is not null").select("doc_id", "source", T.title_key(F.col("text")).alias("k"))
    return intake.unseen(k.where("doc_id % 2 = 1"), k.where("doc_id % 2 = 0"), ["source", "k"], ["doc_id"], "doc_id")


@query("""
WITH n AS (SELECT user_id, count(*) AS found, bool_and(event_type = 'error') AS failed FROM events WHERE ts >= TIMESTAMP '2024-01-25' AND user_id % 7 > 0 GROUP BY 1), b AS (SELECT user_id, count(*) AS failures FROM events WHERE ts < TIMESTAMP '2024-01-03' AND event_type = 'error' GROUP BY 1)
SELECT coalesce(n.user_id, b.user_id) AS user_id, coalesce(found, 0) AS found, CASE WHEN failed IS NULL THEN failures WHEN failed THEN coalesce(failures, 0) + 1 ELSE 0 END AS failures,
  CASE WHEN failed IS NULL THEN failures WHEN failed THEN coalesce(failures, 0) + 1 ELSE 0 END >= 2 AS to_remove FROM n FULL JOIN b ON n.user_id = b.user_id""")
def source_states(spark, d):
    e = table(spark, d, "events")
    now = e.where("ts >= timestamp'2024-01-25' and user_id % 7 > 0").groupBy("user_id").agg(F.count("*").alias("found"), F.bool_and(F.col("event_type") == "error").alias("failed"))
    before = e.where("ts < timestamp'2024-01-03' and event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("failures"))
    return intake.source_states(now, before, "user_id")


@query(f"SELECT id FROM {_ARTICLES} WHERE stage <> 'F' ORDER BY level = 'ecarte', published DESC, id LIMIT 600")
def unfinished_work(spark, d):
    """The 600 rows of another stamp a run has the budget for."""
    return intake.unfinished(articles(spark, d), "stage", "F", [F.col("level") == "ecarte", F.desc("published"), F.col("id")], 600).select("id")


@query("""
WITH u AS (SELECT 'p_brand' AS grp, CASE WHEN p_size > 25 THEN p_brand END AS label, p_size FROM part UNION ALL SELECT 'p_type', p_type, p_size FROM part)
SELECT grp, label, array_to_string(list_sort(list_distinct(list(p_size))), ',') AS variants FROM u WHERE label IS NOT NULL GROUP BY 1, 2""")
def keyword_lists(spark, d):
    wide = table(spark, d, "part").select("p_size", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("p_brand"), "p_type")
    found = intake.keyword_lists(wide, "p_size", ["p_brand", "p_type"])
    return found.select("grp", "label", F.array_join(F.col("variants").cast("array<string>"), ",").alias("variants"))


@query("SELECT page_id, 'https://h' || page_id % 3 || '.org/news/item-' || page_id AS link, 'A title that is long enough ' || page_id AS title FROM pages WHERE page_id % 2 = 0")
def article_links(spark, d):
    """The one article of pages made from ids, among links to itself, to files, to other hosts, in menus and without a title."""
    p, base = F.col("page_id"), F.concat(F.lit("https://h"), F.col("page_id") % 3, F.lit(".org/news/"))
    title = F.concat(F.lit("A title that is <b>long</b>  enough "), p)
    good = F.when(p % 2 == 0, F.concat(F.lit("<a class='x' href='item-"), p, F.lit("?utm_source=x#top'>"), title, F.lit("</a>"))).otherwise("")
    rest = F.concat(F.lit("<nav><a href='/menu'>A menu entry of this page, a long one</a></nav><a href='/doc.xlsx'>A table of this page, to be downloaded</a>"), F.lit("<a href='https://other.net/a'>A page of another host, a long title</a><a href='/short'>short</a><a href='/'>The first page of this host, a long title</a>"))
    html = F.concat(F.lit("<html>"), good, rest, good, F.lit("</html>"))
    return intake.article_links(table(spark, d, "pages").select("page_id", base.alias("url"), html.alias("html"))).select("page_id", "link", "title")


@query("""
SELECT page_id, 'https://h.org/n/' || page_id AS link, CASE WHEN page_id % 3 < 2 THEN DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER) END AS day,
  CASE WHEN page_id % 3 < 2 THEN strftime(DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER), '%-d %B %Y') || ' and what this news is about, in some words' END AS summary FROM pages""")
def dated_links(spark, d):
    """The day beside a link: as text in the second element around it, with elements left open; in a time element of the same
    form; and none where the element around holds another link as well."""
    p = F.col("page_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (p % 300).cast("int"))
    link = F.concat(F.lit('<a href="/n/'), p, F.lit('">A title that is long enough for news</a>'))
    said = F.concat(F.lit("<span>"), F.date_format(day, "d MMMM yyyy"), F.lit("</span> and what this news is about, in some words"))
    form = F.when(p % 3 == 0, F.concat(F.lit("<ul><li><h3>"), link, F.lit("</h3><p>"), said, F.lit("<li>next</ul>")))
    form = form.when(p % 3 == 1, F.concat(F.lit("<div><h2>"), link, F.lit("</h2><time datetime='"), day.cast("string"), F.lit("'></time>"), said, F.lit("</div>")))
    form = form.otherwise(F.concat(F.lit("<div>"), link, F.lit("<a href='/short'>x</a>"), said, F.lit("</div>")))
    made = table(spark, d, "pages").select("page_id", F.lit("https://h.org/").alias("url"), F.concat(F.lit("<body><nav>1 May 2020</nav>"), form).alias("html"))
    return intake.article_links(made).select("page_id", "link", "day", "summary")


@query(r"""
SELECT doc_id FROM documents WHERE text IS NOT NULL AND (regexp_matches(text, '[a-z0-9.]+@[a-z0-9.]+') OR regexp_matches(text, '(^|[^\p{L}\p{N}])mail([^\p{L}\p{N}]|$)'))""")
def exact_or_code(spark, d):
    """An exact search finds a text's code as well as the word itself."""
    codes = select.codes(F.col("text"), {"mail": r"[a-z0-9.]+@[a-z0-9.]+", "web": "https?://"})
    return table(spark, d, "documents").where("text is not null").where(F.array_contains(codes, "mail") | select.says(F.col("text"), "mail")).select("doc_id")


@query(f"""
SELECT 'articles' AS part, count(*) AS n, max(published) AS latest FROM {_ARTICLES} WHERE {_PERIOD} AND level <> 'ecarte' UNION ALL SELECT 'essential', count(*), max(published) FROM {_ARTICLES} WHERE {_PERIOD} AND essential
UNION ALL SELECT 'due', count(*), max(due) FROM {_ARTICLES} WHERE due BETWEEN DATE '1998-05-01' AND DATE '1998-07-15' UNION ALL SELECT 'detected', count(*), max(detected) FROM {_ARTICLES} WHERE detected BETWEEN DATE '1998-05-01' AND DATE '1998-07-15'""")
def period_content(spark, d):
    """What a period holds, in one pass: its articles, essential ones, deadlines and detections."""
    a = articles(spark, d)
    inside = lambda c: F.col(c).between(F.lit("1998-05-01").cast("date"), F.lit("1998-07-15").cast("date"))
    parts = {"articles": (inside("published") & (F.col("level") != "ecarte"), "published"), "essential": (inside("published") & F.col("essential"), "published"), "due": (inside("due"), "due"), "detected": (inside("detected"), "detected")}
    held = F.filter(F.array(*[F.when(c, F.struct(F.lit(n).alias("part"), F.col(day).alias("day"))) for n, (c, day) in parts.items()]), lambda x: x.isNotNull())
    return a.select(F.explode(held).alias("h")).groupBy("h.part").agg(F.count("*").alias("n"), F.max("h.day").alias("latest"))


@query("""
WITH e AS (SELECT user_id, min(CAST(ts AS DATE)) AS first_at, max(CAST(ts AS DATE)) AS last_at, count(*) AS n, count(DISTINCT hour(ts)) AS sources, bool_or(event_type = 'error') AS official, bool_or(event_type = 'purchase') AS signal FROM events GROUP BY 1)
SELECT * FROM e WHERE n >= 3 AND sources >= 2""")
def topic_sources(spark, d):
    """Topics with first and last signal, articles, distinct sources, any official one and any signal."""
    e = _days(spark, d)
    extra = {"sources": F.countDistinct(F.hour("ts")), "official": F.bool_or(F.col("event_type") == "error"), "signal": F.bool_or(F.col("event_type") == "purchase")}
    return summarise.register(e, ["user_id"], "day", "event_id", extra).drop("lead").where("n >= 3 and sources >= 2")


@query(r"""
WITH w AS (SELECT doc_id, lang, unnest(list_distinct(regexp_extract_all(text, '[A-Z](?:[.-]?[A-Z]){1,5}'))) AS v FROM documents WHERE text IS NOT NULL)
SELECT regexp_replace(v, '[.-]', '', 'g') AS code, count(DISTINCT doc_id) AS n, array_to_string(list_sort(list_distinct(list(v))), ' ') AS variants, array_to_string(list_sort(list_distinct(list(lang) FILTER (lang IS NOT NULL))), ',') AS langs, max(doc_id) AS example
FROM w GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3""")
def acronym_variants(spark, d):
    """Acronyms in one form, with their written forms, languages and latest example. A form is counted once a text."""
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Z](?:[.-]?[A-Z]){1,5}"), F.lit(0)))
    w = table(spark, d, "documents").where("text is not null").select("doc_id", "lang", F.explode(found).alias("v")).withColumn("code", F.regexp_replace("v", "[.-]", ""))
    listed = lambda c, s: F.array_join(F.array_sort(F.collect_set(c)), s)
    g = w.groupBy("code").agg(F.countDistinct("doc_id").alias("n"), listed("v", " ").alias("variants"), listed("lang", ",").alias("langs"), F.max("doc_id").alias("example"))
    return g.where("n >= 3")


@query(r"""
WITH q AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user' AND text IS NOT NULL)
SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN contains(text, ' the ') THEN 'North' END, CASE WHEN contains(text, ' und ') THEN 'Centre' END, CASE WHEN contains(text, ' les ') THEN 'West' END], lambda x: x IS NOT NULL), ',') AS zones,
  array_to_string(list_filter([CASE WHEN regexp_matches(text, '(?i)licen') THEN 'licence' END, CASE WHEN contains(text, '@') THEN 'mail' END], lambda x: x IS NOT NULL), ',') AS topics FROM q""")
def question_zones(spark, d):
    q = table(spark, d, "conversations").where("role = 'user' and text is not null")
    named = lambda rules: F.array_join(questions.named(F.col("text"), rules), ",")
    return q.select("conv_id", "turn", named({"North": " the ", "Centre": " und ", "West": " les "}).alias("zones"), named({"licence": "(?i)licen", "mail": "@"}).alias("topics"))
