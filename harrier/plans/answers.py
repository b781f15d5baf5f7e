"""Registered queries that search the documents: by an index, and by a question with its parts, each beside its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import postings, search
from ..session import shared_folder
from .catalogue import _WORDS, TERMS, _words, query, table

_BM25 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents), t AS (SELECT count(*) AS n, avg(len(words)) AS mean FROM d),
f AS (SELECT doc_id, len(words) AS l, unnest(words) AS word FROM d), tf AS (SELECT doc_id, l, word, count(*) AS tf FROM f WHERE word IN ('the', 'tion', 'und', 'les') GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY 1),
bm AS (SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score FROM tf JOIN df USING (word), t GROUP BY 1)
"""


@query(f"{_BM25} SELECT doc_id, score FROM bm ORDER BY score DESC, doc_id LIMIT 10")
def indexed_search(spark, d):
    """The ten best documents, from an index that is built and read in the shared folder."""
    path = f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    postings.build(_words(spark, d), "doc_id", "words", path)
    found, _ = postings.Index(spark, path).search(TERMS, 10)
    return found.select(F.col("key").alias("doc_id"), "score")


#: The parts of questions in the fixtures' invented prose.
ZONES = {"FR": r"\bfrench\b", "DE": r"\bgerman\b"}
TOPICS = {"licence": r"\blicen[sc]e\w*", "web": r"\bweb\b"}
INTENTS = {"nouveau": r"\bnew\b", "projet": r"\bdrafts?\b", "sanction": r"\bfines?\b", "echeance": r"\bdeadlines?\b", "obligation": r"\bdut(?:y|ies)\b"}
ASKED = "New drafts, French or German, on a licence: the tion und les"


def _facts(spark, d):
    """Documents with the columns that a question's parts are held against, all from what their texts say."""
    t = F.col("text")
    has = lambda p: F.coalesce(F.rlike(t, F.lit(p)), F.lit(False))
    kind = F.when(has("!!!"), "alerte").when(has(r"\|"), "texte").when(has("[0-9]{4}-[0-9]{2}-[0-9]{2}"), "date").otherwise("article")
    told = table(spark, d, "documents").select(
        "doc_id",
        kind.alias("kind"),
        F.coalesce(F.upper("lang"), F.lit("Europe")).alias("zone"),
        F.array_compact(F.array(F.when(has("(?i)licen[sc]e"), "licence"), F.when(has("https?://"), "web"))).alias("codes"),
        F.when(F.length(t) >= 2000, "elevee").when(F.length(t) >= 500, "moyenne").otherwise("faible").alias("level"),
        has("@").alias("essential"),
        has(r"\$").alias("fine"),
        F.when(has("(?i)draft|licen"), "projet").when(has("://"), "adopte").alias("status"),
        F.when(has("[0-9]{4}-[0-9]{2}-[0-9]{2}"), "echeance").otherwise("proposition").alias("type"),
        F.lit(None).cast("date").alias("day"),
    )
    return told.join(_words(spark, d), "doc_id")


@query(rf"""{_BM25}, s AS (SELECT doc_id, CASE WHEN contains(text, '!!!') THEN 'alerte' WHEN contains(text, '|') THEN 'texte' WHEN regexp_matches(text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'date' ELSE 'article' END AS kind,
    coalesce(upper(lang), 'Europe') AS zone, coalesce(regexp_matches(text, '(?i)licen[sc]e'), false) AS topic, CASE WHEN length(text) >= 2000 THEN 1.5 WHEN length(text) >= 500 THEN 0.7 ELSE -0.5 END AS level,
    coalesce(contains(text, '@'), false) AS essential, CASE WHEN regexp_matches(text, '(?i)draft|licen') THEN 'projet' WHEN contains(text, '://') THEN 'adopte' END AS status,
    CASE WHEN regexp_matches(text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'echeance' ELSE 'proposition' END AS type, coalesce(score, 0) AS ts FROM documents LEFT JOIN bm USING (doc_id)),
g AS (SELECT doc_id, kind, round(ts + CASE WHEN zone IN ('FR', 'DE') THEN 3 ELSE 0.3 END + CASE WHEN topic THEN 4 ELSE -1 END
    + CASE WHEN kind = 'article' THEN level + CASE WHEN essential THEN 1 ELSE 0 END + CASE status WHEN 'projet' THEN 2.5 WHEN 'adopte' THEN 1.5 ELSE 0 END ELSE 0 END
    + CASE WHEN kind = 'alerte' THEN 1.5 + CASE type WHEN 'proposition' THEN 2 ELSE 0 END ELSE 0 END, 6)::DOUBLE AS score
  FROM s WHERE (ts > 0 OR topic) AND (zone IN ('FR', 'DE') OR (zone = 'Europe' AND kind <> 'article'))),
p AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY score DESC, doc_id) AS place FROM g WHERE score > 0),
o AS (SELECT kind, row_number() OVER (ORDER BY CASE kind WHEN 'alerte' THEN 0 WHEN 'texte' THEN 1 WHEN 'date' THEN 2 ELSE 3 END) AS section FROM p GROUP BY kind)
SELECT section::INTEGER AS section, kind, place::INTEGER AS place, doc_id, score FROM p JOIN o USING (kind) WHERE place <= CASE kind WHEN 'alerte' THEN 5 WHEN 'date' THEN 8 WHEN 'texte' THEN 5 ELSE 10 END""")
def question_answer(spark, d):
    """From a question in words to the ranked sections of its answer."""
    asked = search.understood(spark, ASKED, ZONES, TOPICS, INTENTS, ["or", "on"])
    return search.answer(_facts(spark, d), "doc_id", "words", asked, "2024-01-31")
