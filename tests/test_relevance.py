"""Each branch of the relevance and triage decisions on a literal row, and rows of nulls."""

import pytest
from pyspark.sql import functions as F

from harrier.operators import alerts, relevance, report

FACTS = "key_text tier_a gdpr_change sig sig_net sig_fort topic topic_strong noise noise_strong official law_firm worldwide outside journal journal_noise telling health_only public_only company sme_only".split()
TEXTS = ["ai_verdict", "ai_reason", "status"]
CASES = [
    # facts, score, texts, level, essential, to_verify
    ("journal journal_noise sig_fort", 0.9, {}, "ecarte", False, False),
    ("journal telling sig_fort", 0.6, {}, "faible", False, False),
    ("journal telling", 0.6, {}, "ecarte", False, False),
    ("key_text sig tier_a", 0.4, {}, "elevee", True, True),
    ("key_text sig tier_a official", 0.4, {}, "elevee", True, False),
    ("key_text sig noise_strong", 0.4, {}, "moyenne", False, False),
    ("outside topic sig_net", 0.9, {}, "ecarte", False, False),
    ("noise topic sig_net", 0.9, {}, "ecarte", False, False),
    ("noise official", 0.9, {}, "ecarte", False, False),
    ("noise official sig_net topic_strong", 0.9, {}, "faible", False, False),
    ("topic sig_net", 0.6, {}, "elevee", False, False),
    ("official sig_fort", 0.8, {}, "elevee", True, True),
    ("topic sig", 0.5, {}, "moyenne", False, False),
    ("official topic", 0.1, {}, "faible", False, False),
    ("official", 0.1, {}, "ecarte", False, False),
    ("topic", 0.34, {}, "faible", False, False),
    ("", 0.46, {}, "faible", False, False),
    ("", 0.1, {}, "ecarte", False, False),
    ("worldwide", 0.1, {}, "moyenne", False, False),
    ("topic sig health_only", 0.5, {}, "faible", False, False),
    ("topic sig", 0.5, {"ai_verdict": "pas_pertinent", "ai_reason": "hors_sujet"}, "ecarte", False, False),
    ("key_text", 0.5, {"ai_verdict": "pas_pertinent", "ai_reason": "hors_sujet"}, "faible", False, False),
    ("key_text", 0.5, {"ai_verdict": "pas_pertinent", "ai_reason": "public_seul"}, "ecarte", False, False),
    ("topic sig", 0.5, {"ai_verdict": "a_surveiller", "ai_reason": "x"}, "faible", False, False),
    ("", 0.1, {"ai_verdict": "a_surveiller", "ai_reason": "preparation"}, "faible", False, False),
    ("", 0.1, {"ai_verdict": "a_surveiller", "ai_reason": "x"}, "ecarte", False, False),
    ("noise", 0.1, {"ai_verdict": "pertinent", "ai_reason": "vulnerabilite_secteur"}, "moyenne", False, False),
    ("key_text", 0.1, {"ai_verdict": "pertinent", "ai_reason": "x"}, "elevee", False, False),
    ("", 0.46, {"ai_verdict": "pertinent", "ai_reason": "x"}, "moyenne", False, False),
    ("", 0.1, {"ai_verdict": "pertinent", "ai_reason": "x"}, "faible", False, False),
    ("topic sig public_only", 0.5, {}, "ecarte", False, False),
    ("topic sig public_only company", 0.5, {}, "moyenne", False, False),
    ("topic sig sme_only", 0.5, {}, "ecarte", False, False),
    ("topic sig_net law_firm sig_fort topic_strong", 0.6, {"status": "projet"}, "elevee", True, True),
]


def test_relevance(spark):
    rows = [(i, s, *[f in facts.split() or None for f in FACTS], *[texts.get(t) for t in TEXTS]) for i, (facts, s, texts, *_) in enumerate(CASES)]
    rows.append((99, None, *[None] * (len(FACTS) + len(TEXTS))))
    schema = "i int, score double, " + ", ".join(f"{f} boolean" for f in FACTS) + ", " + ", ".join(f"{t} string" for t in TEXTS)
    df = spark.createDataFrame(rows, schema).withColumn("noise_score", F.lit(None).cast("double"))
    got = {r["i"]: (r["level"], r["essential"], r["to_verify"]) for r in relevance.relevance(df).collect()}
    assert got == {i: tuple(c[3:]) for i, c in enumerate(CASES)} | {99: ("ecarte", False, False)}
    assert relevance.relevance(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind, answers, facts, told", [
    (None, {}, "", (None, None)),
    ("alerte_vulnerabilite", {}, "sector_named", ("pertinent", "vulnerabilite_secteur")),
    ("commentaire", {"ai_exclusion": "autre_secteur", "ai_applicable": "non"}, "", ("pas_pertinent", "autre_secteur")),
    ("commentaire", {"ai_topic": "non"}, "", ("pas_pertinent", "hors_sujet")),
    ("commentaire", {"ai_topic": "non"}, "cyber_text key_text", ("pertinent", "commentaire")),
    ("texte_officiel", {"ai_applicable": "non"}, "", ("pas_pertinent", "non_applicable")),
    ("texte_officiel", {}, "sme_only", ("pas_pertinent", "pme")),
    ("texte_officiel", {}, "public_only", ("pas_pertinent", "public_seul")),
    ("texte_officiel", {"ai_applicable": "incertain"}, "", ("a_surveiller", "incertain")),
    ("projet_consultation", {}, "preparation", ("pertinent", "preparation")),
    ("projet_consultation", {}, "soft_law", ("a_surveiller", "consultation_droit_souple")),
    ("lignes_directrices", {}, "", ("a_surveiller", "guide_sans_texte")),
    ("sanction", {}, "", ("pertinent", "sanction")),
    ("politique", {}, "", ("a_surveiller", "politique")),
    ("evenement", {}, "", ("pas_pertinent", "evenement")),
])
def test_triage(spark, kind, answers, facts, told):
    names = "key_text cyber_text sme_only public_only company preparation soft_law law_named sector_named".split()
    told_by = {"ai_topic": "oui", "ai_applicable": "oui", "ai_exclusion": "aucune"} | answers
    schema = "ai_type string, " + ", ".join(f"{n} string" for n in told_by) + ", " + ", ".join(f"{n} boolean" for n in names)
    df = spark.createDataFrame([(kind, *told_by.values(), *[n in facts.split() or None for n in names])], schema)
    r = relevance.triage(df).first()
    assert (r["verdict"], r["reason"]) == told


def test_greedy_longest(spark):
    """A name is dropped for a kept longer one only: "B C" stays where "A B C" itself is dropped for "A B C D"."""
    names = spark.createDataFrame([("A B C D", 1), ("A B C", 1), ("B C", 1), ("X", 2)], "name string, articles long")
    inside = spark.createDataFrame([("A B C", "A B C D"), ("B C", "A B C")], "name string, longer string")
    assert sorted(r["name"] for r in alerts.greedy_longest(names, inside).collect()) == ["A B C D", "B C", "X"]


def test_greedy_longest_of_any_length(spark):
    """Names of seven and of nine words are settled in their own turns."""
    long, seven, six = "a b c d e f g h i", "a b c d e f g", "a b c d e f"
    names = spark.createDataFrame([(n, 1) for n in (long, seven, six, "b c", "q r s t u v w", "q r s t u v")], "name string, articles long")
    inside = spark.createDataFrame([(seven, long), (six, seven), ("b c", six), ("q r s t u v", "q r s t u v w")], "name string, longer string")
    assert sorted(r["name"] for r in alerts.greedy_longest(names, inside).collect()) == [six, long, "q r s t u v w"]


def test_linked_beyond_limits(spark):
    """The latest articles of a code that has more than the limits let through, and an alert's own ones left out."""
    articles = spark.createDataFrame([(f"a{i:03}", "c", i) for i in range(200)] + [("b", None, 5)], "id string, code string, day int")
    mine = spark.createDataFrame([("x", "c"), ("y", "none"), ("z", None)], "alert string, code string")
    own = spark.createDataFrame([("x", f"a{i:03}") for i in range(194, 200)], "alert string, id string")
    got = alerts.linked(mine, own, articles, "alert", "code", "id", "day").collect()
    assert sorted(r["id"] for r in got) == [f"a{i:03}" for i in range(114, 194)] and all(r["alert"] == "x" for r in got)


def test_report_groups_and_cut(spark):
    a = spark.createDataFrame([(1, None, "z", 3), (2, None, "z", 2), (3, "t", "z", 1), (4, "t", "z", 1)], "id int, text string, zone string, n int")
    got = {(r["text"], r["n"], r["lead"]) for r in report.groups(a, "text", ["zone"], "id", [F.col("n"), -F.col("id")], F.lit(False)).collect()}
    assert got == {(None, 1, 1), (None, 1, 2), ("t", 2, 4)}
    cut = report.cut(a, [F.col("id")], 3).collect()
    assert [(r["id"], r["place"], r["hidden"]) for r in sorted(cut)] == [(1, 1, 1), (2, 2, 1), (3, 3, 1)]
    assert report.cut(a.limit(0), [F.col("id")]).count() == 0


def test_several_sources(spark):
    names = "essential base key_text sig_fort topic_strong level nature copies".split()
    good = dict(essential=False, base=None, key_text=False, sig_fort=True, topic_strong=True, level="elevee", nature=None, copies=1)
    changes = [{}, {"essential": True}, {"base": True}, {"key_text": True}, {"sig_fort": None}, {"topic_strong": False}, {"level": "moyenne"}, {"level": None}, {"nature": "opinion"}, {"copies": 0}, {"copies": None}]
    schema = "i int, essential boolean, base boolean, key_text boolean, sig_fort boolean, topic_strong boolean, level string, nature string, copies int"
    df = spark.createDataFrame([(i, *[(good | c)[n] for n in names]) for i, c in enumerate(changes)], schema)
    assert [r["raised"] for r in relevance.several_sources(df).orderBy("i").collect()] == [True] + [False] * 10
