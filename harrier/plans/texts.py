"""Registered queries on titles, links, quotes, feeds, signals and scores, each beside its SQL."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import table
from ..functions import dates, signals
from ..functions import text as T
from ..operators import lifecycle, relate, search, similarity
from ..sources import feeds
from .catalogue import _TITLE, query
from .register import NAMED
from .situations import SQL, situations


def _docs(spark, d):
    return table(spark, d, "documents").where("text is not null")


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _unescaped(given: str, to: str) -> str:
    """SQL of tables that decode the entities of column w once, by the rules of HTML 5."""
    named = f"map([{', '.join(map(_quoted, html5))}], [{', '.join(map(_quoted, html5.values()))}])"
    begun = f"regexp_extract(e.n, {_quoted(T.OPEN_NAMES)}, 1)"
    point = "CASE WHEN length(e.d) > 8 THEN 1114112 WHEN e.d = '' THEN 0 ELSE try_cast(CASE WHEN lower(e.n[2]) = 'x' THEN '0x' ELSE '' END || e.d AS BIGINT) END"
    none = "e.p BETWEEN 1 AND 8 OR e.p BETWEEN 14 AND 31 OR e.p IN (11, 127) OR e.p BETWEEN 64976 AND 65007 OR (e.p & 65534) = 65534"
    return f"""{to}_n AS (SELECT page_id, regexp_split_to_array(w, {_quoted(T.ENTITY)}) AS w, list_transform(regexp_extract_all(w, {_quoted(T.ENTITY)}, 1), lambda n: {{'n': n, 'd': regexp_extract(n, '^#[xX]?0*([0-9a-fA-F]*)', 1)}}) AS found FROM {given}),
{to}_p AS (SELECT page_id, w, list_transform(found, lambda e: {{'n': e.n, 'p': {point}, 'begun': {begun}, 'known': list_transform([e.n, {begun}], lambda k: {named}[k])}}) AS found FROM {to}_n),
{to}_x AS (SELECT page_id, w, CASE WHEN len(found) = 0 THEN [] ELSE list_transform(found, lambda e: CASE WHEN e.n[1] <> '#' THEN coalesce(e.known[1], e.known[2] || substr(e.n, length(e.begun) + 1), '&' || e.n)
    WHEN e.p = 0 OR e.p BETWEEN 55296 AND 57343 OR e.p > 1114111 THEN chr(65533) WHEN {none} THEN '' WHEN e.p BETWEEN 128 AND 159 THEN substr({_quoted(T.C1)}, e.p - 127, 1) ELSE chr(e.p::INT) END) END AS found FROM {to}_p),
{to} AS (SELECT page_id, array_to_string(list_transform(w, lambda t, i: t || coalesce(found[i], '')), '') AS w FROM {to}_x)"""


@query(rf"""
WITH t AS (SELECT page_id, coalesce(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '') AS t FROM pages),
worn AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Read more about: ' || t WHEN 1 THEN 'CELEX:32026D0499: ' || t WHEN 2 THEN t || ' (PDF, 1.2 MB)' ELSE 'Read more' END AS w FROM t),
{_unescaped('worn', 'once')},
{_unescaped('once', 'twice')},
spaced AS (SELECT page_id, trim(regexp_replace(w, {_quoted(T.SPACES)}, ' ', 'g')) AS s FROM twice),
named AS (SELECT page_id, regexp_replace(regexp_replace(s, {_quoted(T.CELEX)}, ''), {_quoted(T.SIZE)}, '') AS n FROM spaced),
rest AS (SELECT page_id, n, regexp_replace(n, {_quoted(T.LED)}, '') AS r FROM named),
shown AS (SELECT page_id, CASE WHEN length(r) < 12 THEN n ELSE r END AS s FROM rest)
SELECT page_id, CASE WHEN length(s) < 12 OR regexp_matches(s, {_quoted(T.FILE_NAME)}) OR regexp_matches(s, {_quoted(T.SAYS_NOTHING)}) THEN 'Some notes on page ' || page_id ELSE s END AS title FROM shown""")
def clean_titles(spark, d):
    """Titles behind a lead-in, a catalogue number or before a file size, and ones that say nothing, beside a URL."""
    t = F.coalesce(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1), F.lit(""))
    form = F.col("page_id") % 4
    worn = F.when(form == 0, F.concat(F.lit("Read more about: "), t)).when(form == 1, F.concat(F.lit("CELEX:32026D0499: "), t)).when(form == 2, F.concat(t, F.lit(" (PDF, 1.2 MB)"))).otherwise("Read more")
    url = F.concat(F.lit("https://x.org/a/some-notes-on-page-"), "page_id", F.lit(".html"))
    return table(spark, d, "pages").select("page_id", F.nullif(T.clean_title(worn, url), F.lit("")).alias("title"))


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'Some new rules of ' || page_id END AS title FROM pages")
def slug_titles(spark, d):
    url = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://x.org/news/some-new-rules_of-"), "page_id", F.lit("-20240131.pdf/"))).otherwise("https://x.org/news/a-1234567-b")
    return table(spark, d, "pages").select("page_id", T.slug_title(url).alias("title"))


@query("SELECT page_id, url AS link FROM pages")
def unwrapped_links(spark, d):
    coded = F.url_encode("url")
    form = F.col("page_id") % 4
    wrapped = F.when(form == 0, F.concat(F.lit("https://urldefense.com/v3/__"), "url", F.lit("__;!!abc")))
    wrapped = wrapped.when(form == 1, F.concat(F.lit("https://eu01.safelinks.protection.outlook.com/?data=x&url="), coded, F.lit("&y=1")))
    wrapped = wrapped.when(form == 2, F.concat(F.lit("https://urldefense.proofpoint.com/v2/url?u="), F.translate(F.replace(F.replace(coded, F.lit("-"), F.lit("%2D")), F.lit("_"), F.lit("%5F")), "%", "-"), F.lit("&d=z")))
    return table(spark, d, "pages").select("page_id", T.unwrap(wrapped.otherwise(F.col("url"))).alias("link"))


@query("""
WITH a AS (SELECT o_orderkey, floor(o_totalprice) * CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 100 WHEN 2 THEN 100000 ELSE 0.001 END AS v FROM orders),
r AS (SELECT o_orderkey, v::DOUBLE AS v, regexp_replace(CAST(CAST(round(v / 1e9, 1) AS DECIMAL(20, 1)) AS VARCHAR), '\\.0$', '') AS b, regexp_replace(CAST(CAST(round(v / 1e6, 1) AS DECIMAL(20, 1)) AS VARCHAR), '\\.0$', '') AS m FROM a)
SELECT o_orderkey, CASE WHEN v >= 1e9 THEN '€' || b || 'bn' WHEN v >= 1e6 THEN '€' || m || 'M' WHEN v >= 1e3 THEN '€' || CAST(round(v / 1000) AS BIGINT) || 'k' ELSE '€' || CAST(trunc(v) AS BIGINT) END AS en,
  CASE WHEN v >= 1e9 THEN replace(b, '.', ',') || ' Md€' WHEN v >= 1e6 THEN replace(m, '.', ',') || ' M€' WHEN v >= 1e3 THEN CAST(round(v / 1000) AS BIGINT) || ' k€' ELSE CAST(trunc(v) AS BIGINT) || ' €' END AS fr FROM r""")
def shown_amounts(spark, d):
    times = F.get(F.array(*map(F.lit, [1.0, 100.0, 100000.0, 0.001])), (F.col("o_orderkey") % 4).cast("int"))
    v = F.floor("o_totalprice") * times
    return table(spark, d, "orders").select("o_orderkey", T.shown_amount(v).alias("en"), T.shown_amount(v, "fr").alias("fr"))


@query(r"""
WITH p AS (SELECT doc_id, text, instr(lower(text), 'licen') AS s FROM documents), q AS (SELECT *, greatest(s - 90, 1) AS a, s + 5 + 90 AS b FROM p WHERE s > 0),
x AS (SELECT *, substring(text, a, b - a) AS t FROM q), y AS (SELECT *, CASE WHEN a > 1 THEN regexp_replace(t, '^\S*\s+', '') ELSE t END AS u FROM x)
SELECT doc_id, trim(regexp_replace(CASE WHEN b <= length(text) THEN regexp_replace(u, '\s+\S*$', '') ELSE u END, '\s+', ' ', 'g')) AS snippet FROM y""")
def snippets(spark, d):
    s = F.instr(F.lower("text"), "licen")
    return _docs(spark, d).where(s > 0).select("doc_id", T.snippet(F.col("text"), s, 5).alias("snippet"))


@query("SELECT doc_id, CASE WHEN lang IS NULL OR lang = 'en' OR doc_id % 3 = 0 THEN text ELSE 'translated ' || doc_id END AS shown FROM documents")
def displayed_texts(spark, d):
    made = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("translated "), "doc_id"))
    return table(spark, d, "documents").select("doc_id", T.displayed(F.col("text"), F.col("lang"), made, "en").alias("shown"))


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'key text: ' || o_orderkey WHEN '2-HIGH' THEN 'score too low (0.12), no key text' ELSE 'off-topic: events, telecoms' END AS reason FROM orders")
def reworded_reasons(spark, d):
    rules = [("^texte cle : ", "key text: "), (r"note trop faible \(([\d.]+)\), aucun texte cle", "score too low ($1), no key text"), ("^hors sujet : ", "off-topic: "), ("evenements", "events")]
    p = F.col("o_orderpriority")
    said = F.when(p == "1-URGENT", F.concat(F.lit("texte cle : "), "o_orderkey")).when(p == "2-HIGH", "note trop faible (0.12), aucun texte cle").otherwise("hors sujet : evenements, telecoms")
    return table(spark, d, "orders").select("o_orderkey", T.reworded(said, rules).alias("reason"))


@query(r"SELECT doc_id, doc_id % 3 <> 1 AND length(trim(regexp_replace(substring(text, 20, 60), '\s+', ' ', 'g'), ' .''"+'"'+r"')) >= 25 AS ok FROM documents WHERE text IS NOT NULL AND length(text) > 100")
def verified_quotes(spark, d):
    """Quotes with other case, spaces and marks are found; one with another word in it is not."""
    part = F.substring("text", 20, 60)
    quote = F.when(F.col("doc_id") % 3 == 0, F.regexp_replace(part, " ", "   ")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("qqq "), part)).otherwise(F.concat(F.lit("« "), part, F.lit(".»")))
    kept = F.when(F.col("doc_id") % 3 == 2, F.concat("text", F.lit(" "))).otherwise(F.col("text"))
    whole = F.when(F.col("doc_id") % 3 == 2, F.concat(kept, F.lit(" « "), part, F.lit(".»"))).otherwise(kept)
    return _docs(spark, d).where("length(text) > 100").select("doc_id", T.quoted_in(quote, whole).alias("ok"))


@query("SELECT c_custkey, 'Rules of ' || c_mktsegment AS title FROM customer")
def signed_titles(spark, d):
    said = F.concat(F.lit("Rules of "), "c_mktsegment")
    worn = F.when(F.col("c_custkey") % 2 == 0, F.concat(said, F.lit(" By Anna Body 22 Sep 2026 1 min Sector"))).otherwise(F.concat(said, F.lit(" 4 min read")))
    return table(spark, d, "customer").select("c_custkey", T.before_byline(worn).alias("title"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1994-01-01' THEN CAST(o_orderdate AS DATE) + INTERVAL 10 YEAR END::DATE AS day, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-12-31') AS age, left(o_orderpriority, 1) || 'X' AS initials
FROM orders""".replace("left(o_orderpriority, 1) || 'X'", "'RO'").replace(">= TIMESTAMP '1994-01-01'", "IS NOT NULL") + " WHERE NOT (month(o_orderdate) = 2 AND day(o_orderdate) = 29)")
def first_dates(spark, d):
    """The day of a sentence in one of three forms, the days since an order, and the initials of a name."""
    later = F.add_months(F.to_date("o_orderdate"), 120)
    form = F.col("o_orderkey") % 3
    said = F.when(form == 0, F.date_format(later, "yyyy-MM-dd")).when(form == 1, F.date_format(later, "d MMMM yyyy")).otherwise(F.date_format(later, "MMMM d, yyyy"))
    said = F.concat(F.lit("In force since "), said, F.lit("; see page 12."))
    return table(spark, d, "orders").where("not (month(o_orderdate) = 2 and day(o_orderdate) = 29)").select("o_orderkey", dates.first_date(said, "2026-01-01").alias("day"), T.days_since(F.to_date("o_orderdate"), "1998-12-31").alias("age"), T.initials(F.lit("Rules of Order")).alias("initials"))


_WORDS_ALL = f"list_filter(regexp_split_to_array(lower(translate(text, '{T.MARKED}', '{T.BARE}')), '[^a-z0-9α-ωа-я]+'), lambda w: length(w) > 1 AND w NOT IN ('the', 'les'))"


@query(f"""
WITH w AS (SELECT doc_id, unnest({_WORDS_ALL}) AS w FROM documents), s AS (SELECT CASE WHEN length(w) > 4 THEN regexp_replace(w, '(ations?|ments?|ings?|es|s)$', '') ELSE w END AS stem FROM w)
SELECT stem, count(*) AS n FROM s GROUP BY 1""")
def stem_counts(spark, d):
    return _docs(spark, d).select(F.explode(T.tokens(F.col("text"), ("the", "les"))).alias("stem")).groupBy("stem").agg(F.count("*").alias("n"))


NOISE = {"contact": "@", "shout": "!!!", "table": r"\|", "web": "https?://"}


@query("""
WITH f AS (SELECT doc_id, list_filter([CASE WHEN contains(text, '@') THEN 'contact' END, CASE WHEN contains(text, '!!!') THEN 'shout' END, CASE WHEN contains(text, '|') THEN 'table' END, CASE WHEN regexp_matches(text, 'https?://') THEN 'web' END], lambda x: x IS NOT NULL) AS f FROM documents WHERE text IS NOT NULL)
SELECT doc_id, array_to_string(f, ',') AS families, list_contains(f, 'shout') OR list_contains(f, 'table') AS strong FROM f""")
def noise_families(spark, d):
    f = signals.families(F.col("text"), NOISE, ["shout", "table"])
    return _docs(spark, d).select("doc_id", F.array_join(f["all"], ",").alias("families"), (F.size(f["strong"]) > 0).alias("strong"))


@query("""
SELECT doc_id, regexp_matches(text, '(?i)licen[sc]e|copy') AS signal, regexp_matches(text, '(?i)licen[sc]e') AS signal_net, regexp_matches(text, 'Licen[sc]ed under|licen[sc]ed under') AS signal_strong,
  contains(lower(text), 'the') AS topic, regexp_matches(text, '\\bThe\\b') AS topic_strong, (source NOT IN ('src0', 'src1', 'src2') OR contains(text, ' los ')) AND NOT contains(text, ' les ') AS abroad FROM documents WHERE text IS NOT NULL AND source IS NOT NULL""")
def signal_flags(spark, d):
    text = F.col("text")
    rules = {"signal": "(?i)licen[sc]e|copy", "signal_net": "(?i)licen[sc]e", "signal_strong": "Licen[sc]ed under|licen[sc]ed under", "topic": "(?i)the", "topic_strong": T.word("The")}
    away = signals.abroad(F.col("source"), text, ["src0", "src1", "src2"], " les ", " los ")
    return _docs(spark, d).where("source is not null").select("doc_id", *[c.alias(n) for n, c in signals.flags(text, rules).items()], away.alias("abroad"))


@query("SELECT o_orderkey, o_orderkey % 4 IN (0, 1) AS numbered, o_orderkey % 4 IN (0, 2) AS publication FROM orders")
def numbered_texts(spark, d):
    """Sentences that cite a law by number, an authority's decision, and what stands around the date of a publication."""
    k = F.col("o_orderkey")
    year = F.date_format("o_orderdate", "yyyy")
    number = F.concat((k % 900 + 1).cast("string"), F.lit("/"), year)
    said = F.when(k % 4 == 0, F.concat(F.lit("Yesterday Act No. "), number, F.lit(" was published in the Official Journal.")))
    said = said.when(k % 4 == 1, F.concat(F.lit("The Regulation (EU) "), number, F.lit(" comes into force.")))
    said = said.when(k % 4 == 2, F.concat(F.lit("Decision of the court on law "), number, F.lit(", published this week.")))
    said = said.otherwise(F.concat(F.lit("A webinar on the publication of the law, page "), number))
    return table(spark, d, "orders").select("o_orderkey", signals.numbered_text(said).alias("numbered"), signals.publication(said, dates.OCCASION).alias("publication"))


@query(r"""
WITH s AS (SELECT doc_id, n_chars, unnest(list_filter(regexp_split_to_array(text, '[.!?]+\s+'), lambda x: length(x) > 0)) AS s FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, s, (length(s) % 10) / 10.0 >= 0.9 OR n_chars % 10 >= 7 AS sure FROM s)
SELECT doc_id, bool_or(sure AND contains(s, '@')) AS mail, bool_or(sure AND contains(s, 'the')) AS reader FROM p GROUP BY 1 HAVING bool_or(sure AND contains(s, '@')) OR bool_or(sure AND contains(s, 'the'))""")
def concerned_actors(spark, d):
    sentences = F.transform(F.filter(F.split("text", r"[.!?]+\s+"), lambda x: F.length(x) > 0), lambda x: F.struct(x.alias("sentence"), (F.length(x) % 10 / 10.0).alias("probability")))
    held = signals.concerned(sentences, {"mail": "@", "reader": "the"}, F.col("n_chars") % 10 / 10.0)
    c = _docs(spark, d).select("doc_id", held.alias("held")).where(F.size("held") > 0)
    return c.select("doc_id", F.array_contains("held", "mail").alias("mail"), F.array_contains("held", "reader").alias("reader"))


_COUNT = lambda p: f"len(regexp_extract_all(text, '{p}'))"


@query(f"""
WITH s AS (SELECT doc_id, {_COUNT('licen')} * 5 + {_COUNT(' the ')} AS a, {_COUNT(' und ')} * 2 AS b, {_COUNT(' les ')} + {_COUNT('@')} * 3 AS c FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN greatest(a, b, c) = 0 THEN 'other' WHEN a = greatest(a, b, c) THEN 'law' WHEN b = greatest(a, b, c) THEN 'norm' ELSE 'press' END AS rubric FROM s""")
def best_rubric(spark, d):
    rules = [("law", "licen", 5), ("law", " the ", 1), ("norm", " und ", 2), ("press", " les ", 1), ("press", "@", 3)]
    return _docs(spark, d).select("doc_id", signals.best_rubric(F.col("text"), rules, "other").alias("rubric"))


@query("SELECT doc_id, list_max(list_transform(range(0, greatest(CAST(ceil(length(text) / 550.0) AS BIGINT), 1)), lambda i: len(regexp_extract_all(substring(text, i * 550 + 1, 600), '[aeiou]')))) AS score FROM documents WHERE text IS NOT NULL")
def best_chunks(spark, d):
    """The most vowels in any part of 600 characters: a text's parts overlap by 50."""
    return _docs(spark, d).select("doc_id", signals.best_chunk(F.col("text"), lambda p: F.regexp_count(p, F.lit("[aeiou]"))).cast("long").alias("score"))


@query("""
WITH t AS (SELECT label, list(embedding ORDER BY vec_id)[1] AS theme FROM embeddings GROUP BY 1),
s AS (SELECT e.vec_id, t.label AS theme, round(list_inner_product(e.embedding::DOUBLE[], t.theme::DOUBLE[]) * CASE WHEN t.label % 3 = 0 THEN 0.9 ELSE 1.0 END, 6) AS score FROM embeddings e CROSS JOIN t),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, theme) AS place, max(score) OVER (PARTITION BY vec_id) AS top FROM s)
SELECT vec_id, theme, place FROM r WHERE place <= 2 AND score >= top - 0.06""")
def top_themes(spark, d):
    """The best theme and a second one close to it."""
    e = table(spark, d, "embeddings")
    themes = e.groupBy(F.col("label").alias("theme")).agg(F.min_by("embedding", "vec_id").alias("vector"))
    themes = themes.withColumn("weight", F.when(F.col("theme") % 3 == 0, 0.9).otherwise(1.0))
    return similarity.close_themes(similarity.best_themes(e, ["vec_id"], "embedding", themes), "vec_id").select("vec_id", "theme", "place")


@query("""
WITH p AS (SELECT label, embedding, CASE WHEN vec_id % 2 = 0 THEN 0.8 ELSE 1.0 END AS w FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) <= 5),
s AS (SELECT e.vec_id // 4 AS doc, p.label AS theme, max(round(list_inner_product(e.embedding::DOUBLE[], list_transform(p.embedding, lambda x: x::DOUBLE * p.w)), 6)) AS score FROM embeddings e CROSS JOIN p GROUP BY ALL)
SELECT doc, theme, score, row_number() OVER (PARTITION BY doc ORDER BY score DESC, theme)::INTEGER AS place FROM s QUALIFY place <= 2""")
def document_themes(spark, d):
    """Five phrases a theme with weights, four chunks a document: a theme scores as its best phrase in any chunk."""
    e = table(spark, d, "embeddings")
    phrases = relate.first_per(e, ["label"], [F.col("vec_id")], 5).select(F.col("label").alias("theme"), F.when(F.col("vec_id") % 2 == 0, 0.8).otherwise(1.0).alias("weight"), F.col("embedding").alias("vector"))
    chunks = e.select(F.floor(F.col("vec_id") / 4).alias("doc"), "vec_id", "embedding")
    return similarity.of_documents(similarity.best_themes(chunks, ["doc", "vec_id"], "embedding", phrases), "doc")


@query(f"""
WITH s AS (SELECT l_orderkey, l_linenumber, ['article', 'alerte', 'texte', 'date'][CAST(h % 4 AS INTEGER) + 1] AS kind, ['FR', 'DE', 'Europe', 'US'][CAST(h % 331 % 4 AS INTEGER) + 1] AS zone, topic AS c1, h % 337 < 150 AS c2, CASE WHEN sig THEN round(score * 4, 6) ELSE 0 END AS ts,
  CASE WHEN score >= 0.6 THEN 'elevee' WHEN score >= 0.4 THEN 'moyenne' ELSE 'faible' END AS level, tier_a AS essential, noise AS fine, status, CASE WHEN h % 347 < 100 THEN 'echeance' WHEN h % 347 < 200 THEN 'proposition' WHEN h % 347 < 300 THEN 'adopte' END AS type,
  CASE WHEN h % 349 < 300 THEN CASE WHEN h % 353 < 150 THEN DATE '2024-02-01' + CAST(h % 90 AS INTEGER) ELSE day END END AS day FROM ({SQL})),
f AS (SELECT *, kind = 'date' OR (kind = 'alerte' AND coalesce(type = 'echeance', false)) AS dated, DATE '2024-01-31' - day AS age FROM s),
g AS (SELECT *, ts + CASE WHEN zone IN ('FR', 'DE') THEN 3 ELSE 0.3 END + CASE WHEN c2 THEN 4 ELSE -1 END
    + CASE WHEN kind = 'article' THEN CASE level WHEN 'elevee' THEN 1.5 WHEN 'moyenne' THEN 0.7 ELSE -0.5 END + CASE WHEN essential THEN 1 ELSE 0 END + CASE WHEN fine THEN 3 ELSE -1 END
        + CASE WHEN status IN ('projet', 'consultation') THEN 2.5 ELSE 0 END + CASE WHEN status IN ('adopte', 'en_vigueur') THEN 1.5 ELSE 0 END ELSE 0 END
    + CASE WHEN kind = 'alerte' THEN 1.5 + CASE type WHEN 'proposition' THEN 2 WHEN 'adopte' THEN 2 ELSE 0 END ELSE 0 END + CASE WHEN age BETWEEN 0 AND 30 THEN 2 WHEN age <= 90 THEN 0.4 ELSE 0 END AS total
  FROM f WHERE (ts > 0 OR c2) AND (zone IN ('FR', 'DE') OR (zone = 'Europe' AND kind <> 'article')) AND CASE WHEN dated THEN coalesce(-age BETWEEN 0 AND 45, false) ELSE age IS NULL OR age <= 45 END)
SELECT l_orderkey, l_linenumber, round(total, 6)::DOUBLE AS score FROM g WHERE round(total, 6) > 0""")
def search_ranked(spark, d):
    """Scores of a question on two zones, a topic, sanctions, projects and news within 45 days."""
    s, h = situations(spark, d), F.col("h")
    pick = lambda values, n: F.get(F.array(*map(F.lit, values)), n.cast("int"))
    s = s.withColumns(
        {
            "kind": pick(["article", "alerte", "texte", "date"], h % 4),
            "zone": pick(["FR", "DE", "Europe", "US"], h % 331 % 4),
            "codes": F.array_compact(F.array(F.when(F.col("topic"), "c1"), F.when(h % 337 < 150, "c2"))),
            "words": F.when(F.col("sig"), F.round(F.col("score") * 4, 6)).otherwise(0.0),
            "level": F.when(F.col("score") >= 0.6, "elevee").when(F.col("score") >= 0.4, "moyenne").otherwise("faible"),
            "essential": F.col("tier_a"),
            "fine": F.col("noise"),
            "type": F.when(h % 347 < 100, "echeance").when(h % 347 < 200, "proposition").when(h % 347 < 300, "adopte"),
            "day": F.when(h % 349 < 300, F.when(h % 353 < 150, F.date_add(F.lit("2024-02-01").cast("date"), (h % 90).cast("int"))).otherwise(F.col("day"))),
        }
    )
    found = search.boosted(s, "words", ["FR", "DE"], ["c2"], ["sanction", "projet", "nouveau"], 45, "2024-01-31")
    return found.select("l_orderkey", "l_linenumber", "score")


@query("SELECT page_id, i AS nth, 'Page ' || page_id || ' & more' AS title, url || '?i=' || i AS link, 'Sum ' || i AS summary FROM pages, unnest([1, 2]) AS u(i)")
def feed_items(spark, d):
    """The items of feeds made from the pages: RSS with bare ampersands, RDF with CDATA, Atom with links as attributes."""

    def item(i: int):
        u = F.concat("url", F.lit(f"?i={i}"))
        title = F.concat(F.lit("Page "), "page_id", F.lit(" & more"))
        made = [
            F.concat(F.lit("<item><title>"), title, F.lit("</title><link>"), u, F.lit(f"</link><description>Sum &lt;b&gt;{i}&lt;/b&gt;</description><pubDate>Mon, 01 Jan 2024</pubDate></item>")),
            F.concat(F.lit("<item rdf:about='x'><title><![CDATA["), title, F.lit("]]></title><link>"), u, F.lit(f"</link><content:encoded><![CDATA[<p>Sum  {i}</p>]]></content:encoded><dc:date>2024-01-01</dc:date></item>")),
            F.concat(F.lit("<entry><title>"), title, F.lit("</title><link rel='self' href='http://no'/><link rel='alternate' href='"), u, F.lit(f"'/><id>http://id</id><summary>Sum {i}</summary><updated>2024-01-01</updated></entry>")),
        ]
        return F.get(F.array(*made), (F.col("page_id") % 3).cast("int"))

    heads = F.array(*map(F.lit, ["<?xml version='1.0'?><rss>", "<?xml version='1.0'?><rdf:RDF>", " \n<feed>"]))
    xml = F.concat(F.get(heads, (F.col("page_id") % 3).cast("int")), item(1), F.lit("\n<!-- \x01 -->"), item(2), F.lit("<item><title>torn"))
    made = table(spark, d, "pages").select("page_id", "url", xml.alias("xml")).where(feeds.is_feed(F.col("xml")))
    found = feeds.read_feed(made, "xml", "page_id").withColumn("nth", F.regexp_extract("link", "i=([0-9]+)$", 1).cast("int"))
    return found.select("page_id", "nth", "title", "link", F.regexp_replace("summary", r"\s+", " ").alias("summary"))


@query("""
WITH h AS (SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root, regexp_replace(regexp_replace(url, '[?#].*$', ''), '([^/:]/)[^/]*$', '\\1') AS folder, url FROM pages)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN root || '/a/b' WHEN 1 THEN CASE WHEN ends_with(folder, '/') THEN folder ELSE root || '/' END || 'c.html' WHEN 2 THEN regexp_extract(url, '^([a-zA-Z]+:)', 1) || '//y.org/z' ELSE 'https://w.org/' END AS link FROM h""")
def resolved_links(spark, d):
    href = F.get(F.array(*map(F.lit, ["/a/b", "c.html", "//y.org/z", "https://w.org/"])), (F.col("page_id") % 4).cast("int"))
    return table(spark, d, "pages").select("page_id", feeds.resolve(href, F.col("url")).alias("link"))


@query("SELECT doc_id, nth, 'Title ' || nth AS title, 'src' || nth AS source, '2024-01-0' || (nth + 1) AS dated, 'Line one. Line two ' || doc_id AS summary FROM documents, unnest([1, 2]) AS u(nth)")
def mail_articles(spark, d):
    """The articles of mails made from the documents' ids, with a greeting in front of them."""
    block = lambda n: F.concat(F.lit(f"Title {n}\nsrc{n} | 2024-01-0{n + 1}\nLine one.\n  Line two "), "doc_id")
    text = F.concat_ws("\r\n\r\n", F.lit("Good day"), block(1), block(2), F.lit("Bye"))
    return feeds.mail_articles(table(spark, d, "documents").select("doc_id", text.alias("t")), "t", "doc_id").withColumn("nth", F.col("nth").cast("int"))


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '3-MEDIUM')")
def general_acts(spark, d):
    titles = {"1-URGENT": "Arrêté portant nomination", "2-HIGH": "Décret sur les données", "3-MEDIUM": "Décret attribuant la médaille", "4-NOT SPECIFIED": "Loi de sûreté", "5-LOW": "Avis"}
    named = F.create_map(*[F.lit(x) for pair in titles.items() for x in pair])
    return feeds.general_acts(table(spark, d, "orders").withColumn("title", named[F.col("o_orderpriority")]), "title").select("o_orderkey")


_CITED = " UNION ALL ".join(f"SELECT '{n}' AS term, o_orderkey AS id FROM orders WHERE o_orderkey % {m} = {r}" for n, m, r in NAMED)


def _cited(spark, d):
    cited = F.array_compact(F.array(*[F.when(F.col("o_orderkey") % m == r, F.lit(n)) for n, m, r in NAMED]))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.explode(cited).alias("term"))


@query(f"WITH t AS ({_CITED}) SELECT x.term AS siglum, y.term AS name, count(DISTINCT x.id) AS shared FROM t x JOIN t y USING (id) WHERE x.term = upper(x.term) AND y.term <> upper(y.term) AND starts_with(regexp_replace(y.term, '([A-Z])[^A-Z]*', '\\1', 'g'), x.term) GROUP BY 1, 2")
def sigla_of_names(spark, d):
    t = _cited(spark, d)
    sigla, names = t.where("term = upper(term)").withColumnRenamed("term", "siglum"), t.where("term <> upper(term)").withColumnRenamed("term", "name")
    return lifecycle.sigla_of_names(sigla, names, "id")


@query(f"""
WITH t AS (SELECT DISTINCT term, id FROM ({_CITED})), n AS (SELECT term, count(*) AS n FROM t GROUP BY 1)
SELECT x.term AS name, y.term AS longer, count(*) AS shared FROM t x JOIN t y USING (id) JOIN n ON n.term = x.term WHERE x.term <> y.term AND contains(' ' || y.term || ' ', ' ' || x.term || ' ') GROUP BY 1, 2, n.n HAVING 2 * count(*) >= n.n""")
def names_in_longer(spark, d):
    return lifecycle.names_in_longer(_cited(spark, d).withColumnRenamed("term", "name"), "id")


@query("""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN ['Cyber Resilience Act', 'Resilience Act'] WHEN 1 THEN [] ELSE ['Data Law'] END AS names, CASE o_orderkey % 3 WHEN 0 THEN ['CRA'] WHEN 1 THEN [] ELSE ['NIS'] END AS sigla FROM orders)
SELECT o_orderkey, array_to_string(names, ',') AS names, array_to_string(sigla, ',') AS sigla FROM t""")
def candidate_terms(spark, d):
    said = F.get(F.array(*map(F.lit, ["the Cyber Resilience Act (CRA) and its aims", "NO NAME AND ALL CAPITALS", "of a Data Law, and NIS, again NIS"])), (F.col("o_orderkey") % 3).cast("int"))
    sorted_names = F.array_join(F.array_sort(T.name_terms(said)), ",")
    return table(spark, d, "orders").select("o_orderkey", sorted_names.alias("names"), F.array_join(T.sigla(said), ",").alias("sigla"))


@query("""
WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth FROM orders),
g AS (SELECT o_custkey, list_sort(list_transform(list_distinct(list(day)), lambda x: {'past': x < DATE '1995-06-01', 'day': x}))[1:4] AS l FROM d WHERE nth <= 12 GROUP BY 1)
SELECT o_custkey, array_to_string(list_transform(l, lambda x: strftime(x.day, '%Y-%m-%d')), ',') AS days FROM g""")
def next_deadlines(spark, d):
    """The next four of twelve written days, future ones first."""
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    told = table(spark, d, "orders").withColumn("nth", nth).where("nth <= 12").groupBy("o_custkey").agg(F.collect_list(F.to_date("o_orderdate")).alias("days"))
    return told.select("o_custkey", F.array_join(F.transform(dates.upcoming(F.col("days"), "1995-06-01"), lambda x: x.cast("string")), ",").alias("days"))


@query(f"""
WITH k AS (SELECT doc_id, source, {_TITLE} AS k, n_chars FROM documents), e AS (SELECT doc_id, source, n_chars, k FROM k WHERE len(string_split(k, ' ')) >= 5)
SELECT count(*) AS keys, count(DISTINCT k) AS names FROM e""")
def title_key_totals(spark, d):
    key = T.title_key(F.col("text"))
    return table(spark, d, "documents").select(key.alias("k")).where(F.size(F.split("k", " ")) >= 5).agg(F.count("*").alias("keys"), F.countDistinct("k").alias("names"))


@query("""
WITH c AS (SELECT doc_id, substring(text, 1, 1500) AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, regexp_matches(t, '(?i)licen[sc]e') AS signal, contains(t, '@') AS topic, contains(t, 'http') AS strong FROM c""")
def page_clues(spark, d):
    """The signs of a page's first 1500 characters, the reference size of its head."""
    found = signals.flags(F.substring("text", 1, 1500), {"signal": "(?i)licen[sc]e", "topic": "@", "strong": "http"})
    return _docs(spark, d).select("doc_id", *[c.alias(n) for n, c in found.items()])


@query("""
WITH o AS (SELECT o_orderkey, o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d FROM orders), n AS (SELECT *, CASE WHEN d BETWEEN DATE '1996-06-01' - 45 AND DATE '1996-06-01' + 1095 THEN strftime(d, '%Y-%m-%d') ELSE '' END AS told FROM o)
SELECT o_orderkey, CASE WHEN p = '5-LOW' THEN '' WHEN p = '4-NOT SPECIFIED' THEN '' ELSE told END AS days FROM n""")
def near_deadlines(spark, d):
    """Dates of sentences made from orders: with an obligation in the sentence before, behind the date, too far away, at an
    event; the day of signing, far from every obligation, never counts."""
    p, day = F.col("o_orderpriority"), F.date_format("o_orderdate", "d MMMM yyyy")
    far = F.lit(" It is a long and plain text that says nothing of what anybody has to do, and goes on for a while, and then for some more of it.")
    said = F.when(p == "1-URGENT", F.concat(F.lit("Firms must comply. The text enters into force on "), day, F.lit(".")))
    said = said.when(p == "2-HIGH", F.concat(day, F.lit(" is the deadline."))).when(p == "4-NOT SPECIFIED", F.concat(F.lit("Firms must act."), far, far, F.lit(" It was read on "), day, F.lit(".")))
    said = said.when(p == "5-LOW", F.concat(F.lit("A webinar on what firms must do is held on "), day, F.lit("."))).otherwise(F.concat(F.lit("At the hearing: firms must comply no later than "), day, F.lit(".")))
    said = F.concat(said, far, far, F.lit(" Signed on 1997-01-01."))
    found = dates.near_deadlines(said, F.lit(None).cast("date"), "1996-06-01")
    return table(spark, d, "orders").select("o_orderkey", F.array_join(F.transform(found, lambda x: x.cast("string")), ",").alias("days"))
