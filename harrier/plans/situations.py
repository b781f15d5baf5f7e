"""Invented situations for the decision queries: facts and columns of an article drawn from the keys of lineitem.

The fixtures hold no legal text, so facts come from remainders of a number made from a row's keys; all branches of a
decision are met. The same table in SQL is ``SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import table

#: A fact holds where the number's remainder by the first value is below the second.
FACTS = {
    "key_text": (7, 2), "tier_a": (11, 4), "sig": (3, 2), "sig_net": (13, 6), "sig_fort": (17, 8), "topic": (19, 10), "topic_strong": (23, 9), "noise": (29, 6), "noise_strong": (31, 4),
    "official": (37, 13), "law_firm": (41, 12), "worldwide": (43, 9), "outside": (47, 12), "journal": (53, 9), "journal_noise": (59, 20), "telling": (61, 40), "health_only": (67, 12),
    "gdpr_change": (71, 9), "sector_named": (73, 30), "public_only": (79, 9), "sme_only": (83, 9), "company": (89, 30), "cyber_text": (97, 30), "preparation": (103, 20), "soft_law": (107, 50),
    "law_named": (109, 40), "high_volume": (127, 40), "base": (131, 9), "duplicate": (137, 9), "debate": (139, 9), "liked": (149, 9), "out_of_scope": (151, 30), "european": (157, 120),
    "numbered": (163, 90), "ai_topic_yes": (167, 120), "ai_applies": (173, 120), "excluded": (179, 30), "excluded_sector": (181, 30), "central_topic": (191, 120), "instrument": (193, 120),
    "expert": (197, 60), "out_of_field": (199, 20), "cyber_topic": (211, 90), "change": (223, 110), "intention": (227, 80), "unnamed_text": (229, 80), "ai_fits": (233, 170), "staged": (239, 90),
    "vulnerability": (241, 90), "is_new": (251, 40),
}
#: A column's value by the number's remainder; the rest is null.
CHOICES = {
    "ai_verdict": (101, ["pertinent", "a_surveiller", "pas_pertinent"], 25),
    "ai_reason": (257, ["public_seul", "guide_sans_texte", "preparation", "vulnerabilite_secteur", "pme"], 45),
    "status": (263, ["projet", "adopte", "en_vigueur", "consultation", "lignes_directrices"], 45),
    "title_status": (269, ["projet", "adopte", "lignes_directrices"], 60),
    "feedback": (271, ["important", "pas_pertinent"], 15),
    "nature": (277, ["rkc", "opinion", "officielle", "presse", "cabinet"], 56),
    "ai_type": (281, ["texte_officiel", "projet_consultation", "lignes_directrices", "commentaire", "alerte_vulnerabilite", "politique", "evenement"], 36),
    "ai_topic": (283, ["oui", "non", "partiel"], 95),
    "ai_applicable": (293, ["oui", "non", "incertain"], 98),
    "ai_exclusion": (307, ["aucune", "autre_secteur"], 154),
    "text_rubric": (311, ["lois", "normes"], 60),
    "keyword_rubric": (313, ["secteur", "menaces"], 70),
    "theme_rubric": (317, ["donnees"], 200),
}


def situations(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """The situations of all lines, with ``more`` of their columns."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *more, (F.col("l_orderkey") * 7919 + F.col("l_linenumber").cast("long") * 104729).alias("h"))
    h = F.col("h")
    facts = {n: h % m < r for n, (m, r) in FACTS.items()}
    chosen = {n: F.get(F.array(*map(F.lit, values)), F.floor(h % m / each).cast("int")) for n, (m, values, each) in CHOICES.items()}
    scores = {"score": (h % 1009 % 1000) / 1000.0, "noise_score": F.when(h % 5 == 0, (h % 997) / 1000.0), "day": F.date_sub(F.lit("2024-01-31").cast("date"), (h % 90).cast("int"))}
    return li.withColumns(facts | chosen | scores)


SQL = (
    "SELECT l_orderkey, l_linenumber, h, "
    + ", ".join(f"h % {m} < {r} AS {n}" for n, (m, r) in FACTS.items())
    + ", "
    + ", ".join(f"['{"', '".join(values)}'][CAST(floor(h % {m} / {each}) AS INTEGER) + 1] AS {n}" for n, (m, values, each) in CHOICES.items())
    + ", (h % 1009 % 1000) / 1000.0::DOUBLE AS score, CASE WHEN h % 5 = 0 THEN (h % 997) / 1000.0::DOUBLE END AS noise_score, DATE '2024-01-31' - CAST(h % 90 AS INTEGER) AS day"
    + " FROM (SELECT l_orderkey, l_linenumber, l_orderkey * 7919 + CAST(l_linenumber AS BIGINT) * 104729 AS h FROM lineitem)"
)
