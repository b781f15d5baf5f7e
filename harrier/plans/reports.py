"""Registered queries on pages, questions and reports, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import table
from ..functions import questions, spans
from ..functions import text as T
from ..operators import listing, relate
from ..sources import files
from .catalogue import AS_OF, _days, query

_FOLDED = f"lower(translate(text, '{T.MARKED}', '{T.BARE}'))"


@query(r"""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href="([^"#][^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
  unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href="([^"#][^"]*)"[^>]*>(.*?)</a>', 2)) AS t FROM pages)
SELECT page_id, href, trim(regexp_replace(t, '<[^>]+>|\s+', ' ', 'g')) AS text FROM l""")
def page_links(spark, d):
    return files.read_links(table(spark, d, "pages"))


@query(r"""
WITH b AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<nav\b.*?</nav>', ' ', 'g') AS bare FROM pages),
i AS (SELECT page_id, coalesce(nullif(regexp_extract(bare, '(?is)<article\b[^>]*>(.*)</article>', 1), ''), nullif(regexp_extract(bare, '(?is)<main\b[^>]*>(.*)</main>', 1), ''), bare) AS bare FROM b),
p AS (SELECT page_id, list_transform(regexp_extract_all(bare, '(?is)<(?:p|li|h2|h3)\b[^>]*>(.*?)</(?:p|li|h2|h3)>', 1),
  lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS parts FROM i)
SELECT page_id, array_to_string(list_filter(parts, lambda x: length(x) >= 50), chr(10)) AS main_text FROM p""")
def page_main_text(spark, d):
    return table(spark, d, "pages").select("page_id", files.main_text("html").alias("main_text"))


@query(rf"""
WITH u AS (SELECT page_id, regexp_extract(url, '^([a-zA-Z]+)://([^/?#]*)([^?#]*)\??([^#]*)', ['scheme', 'host', 'path', 'query']) AS p FROM pages),
q AS (SELECT *, list_filter(string_split(p.query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '{T.TRACKING}')) AS kept FROM u)
SELECT page_id, substr(sha1(lower(p.scheme) || '://' || lower(p.host) || regexp_replace(p.path, '/+$', '') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END), 1, 12) AS url_id FROM q""")
def page_ids(spark, d):
    return table(spark, d, "pages").select("page_id", T.url_id(F.col("url")).alias("url_id"))


#: The entities that the fixtures' titles may hold; the ampersand comes last, so that a twice written one needs two passes.
_ENTITIES = "lt gt quot apos nbsp eacute egrave agrave ccedil rsquo laquo raquo ndash hellip amp".split()


def _decoded(c: str) -> str:
    for name in [*_ENTITIES, *_ENTITIES]:
        c = f"replace({c}, '&{name};', '{T.ENTITIES[name].replace(chr(39), chr(39) * 2)}')"
    return c


@query(f"""
WITH t AS (SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS t FROM pages)
SELECT page_id, trim(regexp_replace(regexp_replace({_decoded('t')}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS title FROM t""")
def page_titles(spark, d):
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    return table(spark, d, "pages").select("page_id", T.clean(title).alias("title"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN CAST(floor(o_totalprice) AS BIGINT) * 1000
  WHEN floor(o_totalprice) BETWEEN 2000 AND 2099 THEN NULL
  WHEN floor(o_totalprice) >= 1000 THEN CAST(floor(o_totalprice) AS BIGINT) END AS fine FROM orders""")
def written_fines(spark, d):
    """The largest fine of a sentence made from an order, as the fixtures' prose holds none; low orders speak of a fee. By order
    key the amount stands behind or before the penalty word, the currency behind or before the number, or a smaller amount first.
    A bare number that may be a year of this century is no amount."""
    n = F.floor("o_totalprice").cast("string")
    k = F.when(F.col("o_orderpriority") == "1-URGENT", " k").otherwise("")
    form = F.col("o_orderkey") % 4
    fined = F.when(form == 0, F.concat(F.lit("The authority imposed a fine of "), n, k, F.lit(" euros on the firm.")))
    fined = fined.when(form == 1, F.concat(F.lit("The firm must pay "), n, k, F.lit(" euros, a penalty set by the authority.")))
    fined = fined.when(form == 2, F.concat(F.lit("The firm was fined EUR "), n, k, F.lit(" by the authority.")))
    fined = fined.otherwise(F.concat(F.lit("After a fine of 900 euros came one of "), n, k, F.lit(" euros.")))
    said = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("The fee is "), n, F.lit(" euros on the firm."))).otherwise(fined)
    found = spans.spans(table(spark, d, "orders").select("o_orderkey", said.alias("said")), "o_orderkey", "said")
    return spans.largest_fine(found, "o_orderkey").select("o_orderkey", "fine")


#: Words that stand for a zone in the fixtures' invented prose.
ZONES = {"North": " the ", "Centre": " und ", "West": " les ", "South": " los "}
_COUNTS = {z: f"len(regexp_extract_all(text, '{p}'))" for z, p in ZONES.items()}


@query(
    f"SELECT doc_id, CASE WHEN greatest({', '.join(_COUNTS.values())}) = 0 THEN 'Worldwide' "
    + " ".join(f"WHEN {c} = greatest({', '.join(_COUNTS.values())}) THEN '{z}'" for z, c in _COUNTS.items())
    + " END AS zone FROM documents WHERE text IS NOT NULL"
)
def probable_zone(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", questions.probable(F.col("text"), ZONES).alias("zone"))


_CLUE = "(?i)licen|@|http"


@query(rf"""
WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?]+[ \n\t\r]+'), lambda x: trim(x)), lambda x: length(x) BETWEEN 40 AND 400 AND regexp_matches(x, '{_CLUE}')) AS s FROM documents)
SELECT doc_id, len(s) AS n, array_to_string(s, '|') AS sentences FROM s WHERE len(s) > 0""")
def scope_sentences(spark, d):
    found = table(spark, d, "documents").select("doc_id", questions.clue_sentences(F.col("text"), _CLUE).alias("s")).where(F.size("s") > 0)
    return found.select("doc_id", F.size("s").cast("long").alias("n"), F.array_join("s", "|").alias("sentences"))


#: Intents of a question and the words taken as known, for the fixtures' invented prose.
INTENTS = {"contact": "@", "link": "https?://", "ask": r"\?", "stress": "!"}
KNOWN = ["the", "and", "ing", "that"]


@query(f"""
WITH q AS (SELECT conv_id, turn, text, {_FOLDED} AS f FROM conversations WHERE role = 'user' AND text IS NOT NULL)
SELECT conv_id, turn, array_to_string(list_filter([{', '.join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{n}' END" for n, p in INTENTS.items())}], lambda x: x IS NOT NULL), ',') AS intents,
  TRY_CAST(nullif(regexp_extract(f, '([0-9]{{1,3}}) (day|week|month|year)s?', 1), '') AS INTEGER) * CASE regexp_extract(f, '([0-9]{{1,3}}) (day|week|month|year)s?', 2) WHEN 'day' THEN 1 WHEN 'week' THEN 7 WHEN 'month' THEN 30 WHEN 'year' THEN 365 END AS horizon,
  len(list_distinct(list_filter(regexp_split_to_array(f, '[^a-z0-9]+'), lambda w: length(w) > 2 AND w NOT IN ('the', 'and', 'ing', 'that')))) AS residual FROM q""")
def question_parts(spark, d):
    q = table(spark, d, "conversations").where("role = 'user' and text is not null")
    text = F.col("text")
    return q.select(
        "conv_id",
        "turn",
        F.array_join(questions.named(text, INTENTS), ",").alias("intents"),
        questions.horizon(text).alias("horizon"),
        F.size(questions.residual(text, KNOWN)).cast("long").alias("residual"),
    )


@query(r"SELECT doc_id, CASE WHEN length(regexp_replace(text, '[^\p{L}]', '', 'g')) > 0 THEN round(length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) / length(regexp_replace(text, '[^\p{L}]', '', 'g')), 6) ELSE 0 END AS share FROM documents WHERE text IS NOT NULL")
def upper_share(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", F.round(T.upper_share(F.col("text")), 6).alias("share"))


@query("""
SELECT event_id, event_type, place FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS place FROM events)
WHERE place <= CASE event_type WHEN 'error' THEN 8 WHEN 'purchase' THEN 10 ELSE 5 END""")
def section_lists(spark, d):
    found = listing.sections(table(spark, d, "events"), "event_type", [F.desc("value"), F.col("event_id")], {"error": 8, "purchase": 10})
    return found.select("event_id", "event_type", "place")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey LIMIT 400")
def reading_queue(spark, d):
    """The 400 open rows a run reads, the reference size of its budget."""
    o = table(spark, d, "orders")
    return listing.queue(o, F.col("o_orderstatus") == "O", [F.col("o_orderpriority"), F.desc("o_orderdate"), F.col("o_orderkey")], 400).select("o_orderkey")


@query("""
SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey AND (round(c_acctbal) = round(s_acctbal) OR c_custkey = s_suppkey)""")
def either_key(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("zone"), F.round("c_acctbal").alias("name"), F.col("c_custkey").alias("code"))
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("zone"), F.round("s_acctbal").alias("name"), F.col("s_suppkey").alias("code"))
    return listing.either_join(c, s, ["name", "code"], "zone", ["c_custkey", "s_suppkey"])


@query("""
SELECT CAST(m AS DATE) AS month, count(o_orderkey) AS n FROM generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1999-12-01', INTERVAL 1 MONTH) g(m)
LEFT JOIN orders ON date_trunc('month', o_orderdate) = m GROUP BY 1""")
def month_counts(spark, d):
    return listing.by_month(table(spark, d, "orders"), "o_orderdate", "1997-01-01", "1999-12-01")


@query("SELECT source, count(*) AS n, arg_max(doc_id, (n_chars, doc_id)) AS example FROM documents WHERE n_chars IS NOT NULL GROUP BY 1")
def topic_examples(spark, d):
    return listing.latest_example(table(spark, d, "documents").where("n_chars is not null"), "source", "doc_id", ["n_chars", "doc_id"])


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 200000")
def archive_append(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return listing.appended(o.where("o_orderstatus = 'F'"), o.where("o_totalprice > 200000"), "o_orderkey").select("o_orderkey")


@query("SELECT event_id, r AS rank FROM (SELECT event_id, dense_rank() OVER (ORDER BY CAST(ts AS DATE)) AS r FROM events) WHERE r <= 10")
def as_of_run(spark, d):
    """The state of the register at its tenth run."""
    return listing.ranked_runs(_days(spark, d), "day").where("rank <= 10").select("event_id", "rank")


@query("SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def holds_code(spark, d):
    o = table(spark, d, "orders")
    holders = o.groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("codes"))  # a closed list of codes
    wanted = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderpriority").distinct()
    return relate.contains_join(holders, "codes", wanted, "o_orderpriority").select("o_custkey", "o_orderpriority")


@query("SELECT source, count(*) FILTER (n_chars >= 300) AS shown, count(*) FILTER (n_chars < 300) AS hidden FROM documents GROUP BY 1")
def hidden_rows(spark, d):
    shown = F.col("n_chars") >= 300
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.when(shown, 1)).alias("shown"), F.count(F.when(~shown, 1)).alias("hidden"))


@query(f"SELECT date_trunc('month', CAST(ts AS DATE))::DATE AS month, date_diff('day', CAST(ts AS DATE), DATE '{AS_OF}') <= 14 AS hot, count(*) AS n FROM events GROUP BY 1, 2")
def hot_and_cold(spark, d):
    hot = F.datediff(F.lit(AS_OF).cast("date"), F.col("day")) <= 14
    return _days(spark, d).groupBy(F.trunc("day", "month").alias("month"), hot.alias("hot")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, coalesce(lang, CASE source WHEN 'src0' THEN 'fr' WHEN 'src1' THEN 'de' END, 'en') AS lang FROM documents")
def default_language(spark, d):
    by_source = F.create_map(*[F.lit(x) for pair in {"src0": "fr", "src1": "de"}.items() for x in pair])
    return table(spark, d, "documents").select("doc_id", F.coalesce("lang", F.try_element_at(by_source, F.col("source")), F.lit("en")).alias("lang"))
