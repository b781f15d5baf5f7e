"""Registered queries that read real texts by a table of 180 rules, up to the level of relevance, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import table
from ..functions import text as T
from ..operators import relevance, rules
from . import decisions  # noqa: F401  its SQL is used below
from .catalogue import _sql, query
from .situations import SQL

#: What the rules of a family tell of a text; the facts that ``relevance`` reads.
FAMILIES = [
    "key_text", "tier_a", "gdpr_change", "sig", "sig_net", "sig_fort", "topic", "topic_strong", "noise", "noise_strong", "official", "law_firm", "worldwide", "outside", "journal",
    "journal_noise", "health_only", "public_only", "company", "sme_only",
]
_STEMS = [c + v for c in "bcdfglmnprst" for v in "aeiou"]
_ENDS = ["", "n", "nd"]
#: Nine rules to a family, made for the fixtures' invented prose: words that begin and end in a way.
RULES = [
    rules.Rule(f"{family}-{stem}{end}", family, rf"\b{stem}[a-z]{{{2 + k},{3 + k}}}{end}\b", 1 + k)
    for i, family in enumerate(FAMILIES)
    for j, stem in enumerate(_STEMS[3 * i : 3 * i + 3])
    for k, end in enumerate(_ENDS)
]
_FOLDED = f"lower(translate(text, '{T.MARKED}', '{T.BARE}'))"
_VALUES = ", ".join(f"({i}, '{r.name}', '{r.family}', '{r.pattern}', {r.weight})" for i, r in enumerate(RULES))
_HITS = f"""r(i, name, family, pattern, weight) AS (VALUES {_VALUES}), d AS (SELECT doc_id, lang, n_chars, coalesce({_FOLDED}, '') AS f FROM documents),
h AS (SELECT doc_id, i, name, family, weight, len(regexp_extract_all(f, pattern)) AS n FROM d, r)"""


def _codes(spark, d):
    return rules.codes(table(spark, d, "documents"), "doc_id", "text", RULES)


@query(f"WITH {_HITS} SELECT doc_id, family, string_agg(name, ',' ORDER BY i) AS codes, CAST(sum(n * weight) AS BIGINT) AS score FROM h WHERE n > 0 GROUP BY 1, 2")
def rule_codes(spark, d):
    """The rules that hold in each document, by family, and their scores: 180 patterns, one pass over the texts."""
    found = _codes(spark, d).select("doc_id", F.explode("codes").alias("family", "codes"), "scores")
    return found.select("doc_id", "family", F.array_join("codes", ",").alias("codes"), F.element_at("scores", F.col("family")).alias("score"))


_RUBRICS = ["topic", "official", "company", "noise"]


@query(f"""WITH {_HITS}, s AS (SELECT doc_id, family, sum(n * weight) AS score FROM h WHERE family IN ('topic', 'official', 'company', 'noise') GROUP BY 1, 2)
SELECT doc_id, CASE WHEN max(score) > 0 THEN arg_max(family, (score, -list_position(['topic', 'official', 'company', 'noise'], family))) ELSE 'other' END AS rubric FROM s GROUP BY 1""")
def rule_rubric(spark, d):
    """The rubric whose rules score most."""
    return _codes(spark, d).select("doc_id", rules.best_family(F.col("scores"), _RUBRICS, "other").alias("rubric"))


_FACTS = f"""WITH {_HITS}, g AS (SELECT doc_id, {', '.join(f"bool_or(n > 0) FILTER (family = '{x}') AS {x}" for x in FAMILIES)},
  round(least(1.0, sum(n * weight) FILTER (family IN ('topic', 'topic_strong', 'sig')) / 60.0), 3)::DOUBLE AS score FROM h GROUP BY 1)
SELECT g.*, n_chars >= 300 AS telling, CASE lang WHEN 'en' THEN 'projet' WHEN 'fr' THEN 'adopte' WHEN 'de' THEN 'consultation' END AS status, NULL::DOUBLE AS noise_score, NULL AS ai_verdict, NULL AS ai_reason FROM g JOIN d USING (doc_id)"""


@query(_sql["relevance_decision"].replace(f"({SQL})", f"({_FACTS})").replace("l_orderkey, l_linenumber", "doc_id"))
def relevance_from_text(spark, d):
    """From the words of a document to its level of relevance: rules, facts, decision."""
    holds = {x: F.array_contains(F.map_keys("codes"), x) for x in FAMILIES}
    counted = sum((F.coalesce(F.try_element_at("scores", F.lit(x)), F.lit(0)) for x in ("topic_strong", "sig")), F.coalesce(F.try_element_at("scores", F.lit("topic")), F.lit(0)))
    read = _codes(spark, d).withColumns(holds).withColumn("score", F.round(F.least(F.lit(1.0), counted / 60.0), 3))
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    stage = F.create_map(*map(F.lit, ["en", "projet", "fr", "adopte", "de", "consultation"]))
    facts = read.join(docs, "doc_id").withColumns(
        {"telling": F.col("n_chars") >= 300, "status": F.try_element_at(stage, F.col("lang")), "noise_score": F.lit(None).cast("double"), "ai_verdict": F.lit(None).cast("string"), "ai_reason": F.lit(None).cast("string")}
    )
    return relevance.relevance(facts).select("doc_id", "level", "essential", "to_verify")
