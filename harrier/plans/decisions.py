"""Registered decision queries on invented situations, each beside its SQL, written as plain CASE chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import table
from ..functions import text as T
from ..operators import relevance
from .catalogue import query
from .situations import SQL, situations

_KEYS = ("l_orderkey", "l_linenumber")


@query(f"""
WITH s AS ({SQL}),
n AS (SELECT *, noise OR noise_strong OR coalesce(noise_score > score + 0.02, false) AS any_noise, score >= 0.7 AS near FROM s),
r AS (SELECT *, journal AND (journal_noise OR (telling AND NOT key_text AND NOT topic_strong AND NOT near)) AS gazette,
  CASE WHEN key_text THEN CASE WHEN sig AND score >= 0.33 AND NOT noise_strong THEN 'elevee' ELSE 'moyenne' END
    WHEN outside AND NOT worldwide AND NOT official THEN 'ecarte' WHEN any_noise AND NOT official THEN 'ecarte'
    WHEN any_noise AND sig_net AND topic_strong THEN 'faible' WHEN any_noise THEN 'ecarte'
    WHEN topic AND sig_net AND score >= 0.55 THEN 'elevee' WHEN official AND near AND (sig_net OR sig_fort) THEN 'elevee'
    WHEN topic AND score >= 0.45 AND (sig OR official) THEN 'moyenne' WHEN official AND (topic OR score >= 0.45) THEN 'faible' WHEN official THEN 'ecarte'
    WHEN (topic AND score >= 0.33) OR score >= 0.45 THEN 'faible' ELSE 'ecarte' END AS l1 FROM n),
w AS (SELECT *, CASE WHEN worldwide AND l1 IN ('faible', 'ecarte') AND NOT any_noise THEN 'moyenne' ELSE l1 END AS l2 FROM r),
k AS (SELECT *, CASE WHEN health_only AND l2 IN ('elevee', 'moyenne') THEN 'faible' ELSE l2 END AS l3, coalesce(ai_reason, '') AS why FROM w),
a AS (SELECT *, CASE ai_verdict
    WHEN 'pas_pertinent' THEN CASE WHEN NOT key_text OR why = 'public_seul' THEN 'ecarte' WHEN l3 IN ('elevee', 'moyenne') THEN 'faible' ELSE l3 END
    WHEN 'a_surveiller' THEN CASE WHEN l3 IN ('elevee', 'moyenne') THEN 'faible' WHEN l3 = 'ecarte' AND NOT any_noise AND why IN ('guide_sans_texte', 'preparation', 'consultation_droit_souple') THEN 'faible' ELSE l3 END
    WHEN 'pertinent' THEN CASE WHEN why = 'vulnerabilite_secteur' THEN CASE WHEN key_text THEN 'elevee' ELSE 'moyenne' END
      WHEN key_text AND l3 IN ('moyenne', 'faible') THEN 'elevee' WHEN l3 = 'faible' THEN 'moyenne' WHEN l3 = 'ecarte' AND NOT any_noise THEN 'faible' ELSE l3 END
    ELSE l3 END AS l4, any_noise AND NOT coalesce(ai_verdict = 'pertinent' AND why = 'vulnerabilite_secteur', false) AS noise_left FROM k),
t AS (SELECT *, CASE WHEN (ai_verdict IS NULL OR why IN ('public_seul', 'pme')) AND ((public_only AND NOT company) OR (sme_only AND NOT key_text)) THEN 'ecarte' ELSE l4 END AS l5 FROM a),
e AS (SELECT *, key_text AND (tier_a OR gdpr_change) AS by_text, score >= 0.55 AND sig_fort AND (topic_strong OR near) AS told FROM t),
c AS (SELECT *, NOT gazette AND l5 = 'elevee' AND (by_text OR (official AND told) OR (law_firm AND told AND coalesce(status IN ('projet', 'adopte', 'en_vigueur'), false))) AS chosen FROM e)
SELECT l_orderkey, l_linenumber, CASE WHEN NOT gazette THEN l5 WHEN NOT journal_noise AND sig_fort AND score >= 0.55 THEN 'faible' ELSE 'ecarte' END AS level,
  chosen AND NOT noise_strong AND (NOT noise_left OR (key_text AND tier_a)) AS essential, chosen AND (NOT by_text OR NOT official) AS to_verify FROM c""")
def relevance_decision(spark, d):
    return relevance.relevance(situations(spark, d)).select(*_KEYS, "level", "essential", "to_verify")


_TRIAGE = """
CASE WHEN ai_type IS NULL THEN NULL WHEN ai_type = 'alerte_vulnerabilite' THEN CASE WHEN sector_named THEN 'pertinent:vulnerabilite_secteur' ELSE 'pas_pertinent:alerte_vulnerabilite' END
  WHEN ai_exclusion <> 'aucune' AND NOT coalesce(on_topic AND ai_applicable = 'oui', false) THEN 'pas_pertinent:' || ai_exclusion
  WHEN NOT on_topic THEN 'pas_pertinent:hors_sujet' WHEN ai_applicable = 'non' THEN 'pas_pertinent:non_applicable'
  WHEN sme_only AND NOT key_text THEN 'pas_pertinent:pme' WHEN public_only AND NOT company THEN 'pas_pertinent:public_seul'
  WHEN ai_type IN ('texte_officiel', 'projet_consultation', 'lignes_directrices', 'commentaire') THEN CASE
    WHEN ai_applicable <> 'oui' THEN 'a_surveiller:incertain' WHEN ai_type IN ('projet_consultation', 'lignes_directrices') AND preparation THEN 'pertinent:preparation'
    WHEN ai_type = 'projet_consultation' AND soft_law AND NOT law_named THEN 'a_surveiller:consultation_droit_souple'
    WHEN ai_type IN ('lignes_directrices', 'commentaire') AND NOT key_text THEN 'a_surveiller:guide_sans_texte' ELSE 'pertinent:' || ai_type END
  WHEN ai_type = 'politique' THEN 'a_surveiller:politique' ELSE 'pas_pertinent:' || ai_type END"""
_ANSWERS = f"SELECT *, ai_topic = 'oui' OR (cyber_text AND ai_type IN ('texte_officiel', 'projet_consultation', 'lignes_directrices', 'commentaire')) AS on_topic FROM ({SQL})"


@query(f"SELECT l_orderkey, l_linenumber, {_TRIAGE} AS told FROM ({_ANSWERS})")
def ai_decision(spark, d):
    return relevance.triage(situations(spark, d)).select(*_KEYS, F.concat("verdict", F.lit(":"), "reason").alias("told"))


@query(f"SELECT coalesce(ai_verdict, '-') AS stored, coalesce(string_split({_TRIAGE}, ':')[1], '-') AS now, count(*) AS n FROM ({_ANSWERS}) GROUP BY 1, 2")
def ai_reapplied(spark, d):
    """Stored answers judged anew: how verdicts change."""
    told = relevance.triage(situations(spark, d))
    return told.groupBy(F.coalesce("ai_verdict", F.lit("-")).alias("stored"), F.coalesce("verdict", F.lit("-")).alias("now")).agg(F.count("*").alias("n"))


@query(f"""
WITH s AS (SELECT *, CASE WHEN score >= 0.6 THEN 'elevee' WHEN score >= 0.4 THEN 'moyenne' WHEN score >= 0.2 THEN 'faible' ELSE 'ecarte' END AS level, tier_a AS essential FROM ({SQL})),
f AS (SELECT *, CASE WHEN feedback = 'important' THEN 'elevee' WHEN feedback = 'pas_pertinent' THEN 'ecarte' WHEN level = 'faible' AND (nature IN ('rkc', 'opinion') OR high_volume) THEN 'ecarte' ELSE level END AS final_level FROM s)
SELECT l_orderkey, l_linenumber, final_level, coalesce(feedback = 'important', false) OR (essential AND NOT coalesce(feedback = 'pas_pertinent', false)) AS final_essential,
  CASE WHEN final_level IN ('faible', 'ecarte') THEN 'autres' ELSE coalesce(text_rubric, keyword_rubric, theme_rubric, 'autres') END AS rubric FROM f""")
def post_rules(spark, d):
    s = F.col("score")
    level = F.when(s >= 0.6, "elevee").when(s >= 0.4, "moyenne").when(s >= 0.2, "faible").otherwise("ecarte")
    found = relevance.post_rules(situations(spark, d).withColumn("level", level).withColumn("essential", F.col("tier_a")))
    return found.select(*_KEYS, "final_level", "final_essential", "rubric")


@query(f"""
WITH s AS (SELECT *, CASE WHEN score >= 0.4 THEN 'elevee' WHEN score >= 0.2 THEN 'moyenne' ELSE 'ecarte' END AS level, tier_a AS essential, coalesce(nature = 'officielle', false) AS auth FROM ({SQL})),
n AS (SELECT *, NOT auth AND level = 'elevee' AND numbered AND ai_topic_yes AND ai_applies AS by_number FROM s),
g AS (SELECT *, CASE WHEN auth THEN status WHEN title_status IS NOT NULL THEN title_status WHEN by_number THEN 'adopte' END AS stage FROM n)
SELECT l_orderkey, l_linenumber, CASE
  WHEN base OR duplicate OR expert OR debate THEN NULL WHEN liked THEN 'signale' WHEN out_of_scope AND NOT key_text THEN NULL
  WHEN coalesce(ai_verdict = 'pertinent' AND ai_reason = 'preparation', false) AND level <> 'ecarte' AND auth AND european THEN 'proposition'
  WHEN NOT (essential OR by_number) OR level <> 'elevee' OR NOT european OR excluded OR (sme_only AND NOT key_text) THEN NULL
  WHEN NOT auth AND (stage IS NULL OR stage = 'lignes_directrices') THEN NULL
  WHEN key_text THEN CASE WHEN stage IN ('consultation', 'projet', 'lignes_directrices') THEN 'proposition' WHEN stage IN ('adopte', 'en_vigueur') THEN 'adopte' END
  WHEN NOT excluded_sector AND central_topic AND instrument AND coalesce(ai_type IN ('texte_officiel', 'projet_consultation', 'obligation_echeance'), true) AND (stage IS NOT NULL OR sig_fort) THEN 'a_qualifier'
  END AS alert FROM g""")
def alert_types(spark, d):
    return alerted(situations(spark, d)).select(*_KEYS, "alert")


def alerted(made):
    """Situations with the type of key point each makes."""
    s = F.col("score")
    made = made.withColumn("level", F.when(s >= 0.4, "elevee").when(s >= 0.2, "moyenne").otherwise("ecarte"))
    return relevance.alert_type(made.withColumns({"essential": F.col("tier_a"), "opinion": F.col("expert")}))


@query(f"""
SELECT l_orderkey, l_linenumber, CASE WHEN sme_only OR (public_only AND NOT company) OR out_of_field THEN NULL
  WHEN expert THEN CASE WHEN NOT cyber_text AND NOT cyber_topic THEN NULL WHEN key_text AND NOT change AND NOT intention THEN 'avis' WHEN key_text THEN 'evolution'
    WHEN intention OR unnamed_text THEN 'pressenti' END
  WHEN NOT ai_fits OR coalesce(ai_type IN ('texte_officiel', 'alerte_vulnerabilite', 'evenement'), false) THEN NULL
  WHEN key_text THEN CASE WHEN change AND (intention OR coalesce(ai_type = 'politique', false) OR (coalesce(ai_type = 'projet_consultation', false) AND NOT staged)) THEN 'evolution' END
  WHEN intention OR coalesce(ai_type = 'politique', false) THEN 'pressenti' END AS kind FROM ({SQL})""")
def expected_kinds(spark, d):
    return relevance.expected_kind(situations(spark, d)).select(*_KEYS, "kind")


@query(f"""
WITH s AS (SELECT *, CASE WHEN score >= 0.5 THEN 'moyenne' ELSE 'ecarte' END AS level, coalesce(nature, '') AS who FROM ({SQL})),
c AS (SELECT *, who NOT IN ('rkc', 'opinion') AND NOT base AND day >= DATE '2024-01-31' - 60 AND (level <> 'ecarte' OR score >= 0.33 OR who = 'officielle') AS to_read FROM s)
SELECT l_orderkey, l_linenumber, to_read, (to_read OR is_new) AND who <> 'opinion' AND NOT base
  AND (level <> 'ecarte' OR CASE WHEN noise THEN vulnerability AND sector_named ELSE who = 'officielle' OR score >= 0.45 END) AS to_ask FROM c""")
def reading_candidates(spark, d):
    made = situations(spark, d).withColumn("level", F.when(F.col("score") >= 0.5, "moyenne").otherwise("ecarte"))
    read = relevance.worth_reading("2024-01-31")
    return made.select(*_KEYS, read.alias("to_read"), relevance.worth_asking(read, F.col("is_new")).alias("to_ask"))


@query(f"""
WITH s AS (SELECT *, score >= 0.5 AS kept, l_linenumber > 2 AS several FROM ({SQL}))
SELECT l_orderkey, l_linenumber FROM s WHERE several AND kept AND NOT tier_a AND NOT base AND NOT key_text AND coalesce(nature <> 'opinion', true) AND sig_fort AND topic_strong""")
def unknown_essential(spark, d):
    """Unknown texts that several sources take up, with a strong signal: they enter the essential list, to be verified."""
    f = relevance.fact
    found = situations(spark, d).where((F.col("l_linenumber") > 2) & (F.col("score") >= 0.5) & ~f("tier_a") & ~f("base") & ~f("key_text") & f("sig_fort") & f("topic_strong"))
    return found.where(F.coalesce(F.col("nature") != "opinion", F.lit(True))).select(*_KEYS)


@query("""
WITH h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)), '^www\\.', '') AS dom,
  CASE page_id % 5 WHEN 0 THEN 'Avis d''expert' WHEN 1 THEN 'Cabinet d''avocats' WHEN 2 THEN 'Site officiel' WHEN 3 THEN 'Presse' ELSE 'Blog' END AS t FROM pages)
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'opinion' WHEN 1 THEN 'cabinet' WHEN 2 THEN 'officielle' ELSE CASE WHEN regexp_matches(dom, '[02468]\\.') THEN 'officielle' ELSE 'presse' END END AS nature FROM h""")
def source_natures(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ["Avis d'expert", "Cabinet d'avocats", "Site officiel", "Presse", "Blog"])), (F.col("page_id") % 5 + 1).cast("int"))
    return table(spark, d, "pages").select("page_id", relevance.source_nature(kind, T.domain(F.col("url")), r"[02468]\.").alias("nature"))


@query("""
WITH g AS (SELECT doc_id, list_filter([CASE WHEN contains(text, '@') THEN 'mail' END, CASE WHEN contains(text, '|') THEN 'rule' END, CASE WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 'licence' END], lambda x: x IS NOT NULL) AS g FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN list_contains(g, 'mail') OR list_contains(g, 'licence') THEN 0.6 WHEN len(g) > 0 THEN 0.45 ELSE 0.3 END::DOUBLE AS score FROM g""")
def fallback_scores(spark, d):
    text = F.col("text")
    groups = F.array_compact(F.array(F.when(text.contains("@"), "mail"), F.when(text.contains("|"), "rule"), F.when(F.rlike("text", F.lit("(?i)licen[sc]e")), "licence")))
    return table(spark, d, "documents").where("text is not null").select("doc_id", relevance.fallback_score(groups, ["rule"]).alias("score"))
