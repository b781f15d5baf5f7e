"""Decisions on an article, as ordered conditions over columns of facts: relevance, triage answers, post rules, kinds.

Facts are boolean columns (null counts as false) that the predicates of ``functions.signals`` or a join have made. Each
function adds columns and keeps all others. A level is one of elevee, moyenne, faible, ecarte.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scores from which an article counts as near, likely, related and very near.
THRESHOLDS = {"elevee": 0.55, "moyenne": 0.45, "bas": 0.33, "tres_haut": 0.70}
#: How far the score of a noise theme must lie above the article's.
NOISE_MARGIN = 0.02
#: Types of answers that state or prepare a rule, and those only watched.
OFFICIAL_TYPES = ("texte_officiel", "projet_consultation", "lignes_directrices", "obligation_echeance", "sanction")
WATCHED_TYPES = ("politique", "etude_enquete")
#: Types of answers that are no announcement, and statuses that announce a text.
SETTLED_TYPES = ("texte_officiel", "obligation_echeance", "sanction", "alerte_vulnerabilite", "attaque_incident", "entreprise_produit", "evenement", "financement", "etude_enquete", "autre")
STAGES = ("projet", "adopte", "en_vigueur")


def fact(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _is(name: str, *values: str) -> Column:
    return F.coalesce(F.col(name).isin(*values), F.lit(False))


def _first(steps: list[tuple[Column, Column | str | None]], otherwise: Column | str | None) -> Column:
    """The outcome of the first condition that holds."""
    found = reduce(lambda w, s: w.when(*s), steps[1:], F.when(*steps[0]))
    return found.otherwise(otherwise)


def relevance(df: DataFrame) -> DataFrame:
    """Adds level, essential and to_verify.

    Reads score, noise_score, ai_verdict, ai_reason, status, and the facts key_text, tier_a, gdpr_change, sig, sig_net, sig_fort,
    topic, topic_strong, noise, noise_strong, official, law_firm, worldwide, outside (outside Europe and Europe not
    cited), journal, journal_noise, telling (eight words or more), health_only, public_only, company, sme_only.
    """
    at = {k: F.lit(v) for k, v in THRESHOLDS.items()}
    s, up = F.coalesce("score", F.lit(0.0)), ("elevee", "moyenne")
    tc, official, sig, sig_net, topic = map(fact, ("key_text", "official", "sig", "sig_net", "topic"))
    near = s >= at["tres_haut"]
    noise = fact("noise") | fact("noise_strong") | F.coalesce(F.col("noise_score") > s + NOISE_MARGIN, F.lit(False))
    strong_noise = fact("noise_strong")
    gazette = fact("journal") & (fact("journal_noise") | (fact("telling") & ~tc & ~fact("topic_strong") & ~near))
    spared = ~fact("journal_noise") & fact("sig_fort") & (s >= at["elevee"])
    by_rules = _first(
        [
            (tc & sig & (s >= at["bas"]) & ~strong_noise, "elevee"),
            (tc, "moyenne"),
            (fact("outside") & ~fact("worldwide") & ~official, "ecarte"),
            (noise & ~official, "ecarte"),
            (noise & ~(sig_net & fact("topic_strong")), "ecarte"),
            (noise, "faible"),
            (topic & sig_net & (s >= at["elevee"]), "elevee"),
            (official & near & (sig_net | fact("sig_fort")), "elevee"),
            (topic & (s >= at["moyenne"]) & (sig | official), "moyenne"),
            (official & (topic | (s >= at["moyenne"])), "faible"),
            (official, "ecarte"),
            ((topic & (s >= at["bas"])) | (s >= at["moyenne"]), "faible"),
        ],
        "ecarte",
    )
    d = df.withColumns({"_gazette": gazette, "_noise": noise, "_level": by_rules})
    level = F.col("_level")
    d = d.withColumn("_level", F.when(fact("worldwide") & level.isin("faible", "ecarte") & ~F.col("_noise"), "moyenne").otherwise(level))
    d = d.withColumn("_level", F.when(level.isin(*up) & fact("health_only"), "faible").otherwise(level))
    # the triage answers
    no, watch, yes = (_is("ai_verdict", v) for v in ("pas_pertinent", "a_surveiller", "pertinent"))
    sector = _is("ai_reason", "vulnerabilite_secteur")
    d = d.withColumn(
        "_level",
        _first(
            [
                (no & tc & ~_is("ai_reason", "public_seul"), F.when(level.isin(*up), "faible").otherwise(level)),
                (no, F.lit("ecarte")),
                (watch & level.isin(*up), F.lit("faible")),
                (watch & (level == "ecarte") & ~F.col("_noise") & _is("ai_reason", "guide_sans_texte", "preparation", "consultation_droit_souple"), F.lit("faible")),
                (yes & sector, F.when(tc, "elevee").otherwise("moyenne")),
                (yes & tc & level.isin("moyenne", "faible"), F.lit("elevee")),
                (yes & (level == "faible"), F.lit("moyenne")),
                (yes & (level == "ecarte") & ~F.col("_noise"), F.lit("faible")),
            ],
            level,
        ),
    ).withColumn("_noise", F.col("_noise") & ~(yes & sector))
    # what a title rules out, unless the answers give another reason
    answered = F.col("ai_verdict").isNotNull() & ~_is("ai_reason", "public_seul", "pme")
    ruled_out = (fact("public_only") & ~fact("company")) | (fact("sme_only") & ~tc)
    d = d.withColumn("_level", F.when(~answered & ruled_out, "ecarte").otherwise(level))
    by_text = fact("tier_a") & tc | fact("gdpr_change") & tc
    announced = (s >= at["elevee"]) & fact("sig_fort") & (fact("topic_strong") | near)
    firm = fact("law_firm") & announced & _is("status", *STAGES)
    chosen = (level == "elevee") & (by_text | (official & announced) | firm)
    cancelled = strong_noise | (F.col("_noise") & ~(fact("tier_a") & tc))
    d = d.withColumn("essential", ~F.col("_gazette") & chosen & ~cancelled)
    d = d.withColumn("to_verify", ~F.col("_gazette") & chosen & F.when(by_text, ~official).otherwise(True))
    d = d.withColumn("level", F.when(F.col("_gazette"), F.when(spared, "faible").otherwise("ecarte")).otherwise(level))
    return d.drop("_gazette", "_noise", "_level")


def triage(df: DataFrame) -> DataFrame:
    """Adds verdict and reason from stored answers: ai_type, ai_topic, ai_applicable (oui, non, other), ai_exclusion,
    sector_named, and the facts key_text, cyber_text, sme_only, public_only, company, preparation, soft_law, law_named.
    Rows without answers get nulls. No model is asked, so a new table of rules can be run over all stored answers."""
    kind, official = F.col("ai_type"), _is("ai_type", *OFFICIAL_TYPES)
    ruled = official | _is("ai_type", "commentaire")
    on_topic = (F.col("ai_topic") == "oui") | (fact("cyber_text") & ruled)
    applies = F.col("ai_applicable") == "oui"
    yes, watch, no = "pertinent", "a_surveiller", "pas_pertinent"
    told = lambda verdict, reason: F.struct(F.lit(verdict).alias("verdict"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))
    found = _first(
        [
            (kind.isNull(), F.lit(None)),
            ((kind == "alerte_vulnerabilite") & fact("sector_named"), told(yes, "vulnerabilite_secteur")),
            (kind == "alerte_vulnerabilite", told(no, kind)),
            ((F.col("ai_exclusion") != "aucune") & ~(on_topic & applies), told(no, F.col("ai_exclusion"))),
            (~on_topic, told(no, "hors_sujet")),
            (F.col("ai_applicable") == "non", told(no, "non_applicable")),
            (fact("sme_only") & ~fact("key_text"), told(no, "pme")),
            (fact("public_only") & ~fact("company"), told(no, "public_seul")),
            (ruled & ~applies, told(watch, "incertain")),
            (_is("ai_type", "projet_consultation", "lignes_directrices") & fact("preparation"), told(yes, "preparation")),
            (_is("ai_type", "projet_consultation") & fact("soft_law") & ~fact("law_named"), told(watch, "consultation_droit_souple")),
            (_is("ai_type", "lignes_directrices", "commentaire") & ~fact("key_text"), told(watch, "guide_sans_texte")),
            (ruled, told(yes, kind)),
            (_is("ai_type", *WATCHED_TYPES), told(watch, kind)),
        ],
        told(no, kind),
    )
    return df.withColumn("_told", found).withColumns({"verdict": F.col("_told.verdict"), "reason": F.col("_told.reason")}).drop("_told")


def post_rules(df: DataFrame) -> DataFrame:
    """Adds final_level, final_essential and rubric to rows with level, essential, feedback, nature, high_volume, and the
    rubrics of the key text, the keywords and the best theme. A reader's verdict goes before everything."""
    liked, disliked = _is("feedback", "important"), _is("feedback", "pas_pertinent")
    weak = (F.col("level") == "faible") & F.col("feedback").isNull() & (_is("nature", "rkc", "opinion") | fact("high_volume"))
    level = F.when(liked, "elevee").when(disliked | weak, "ecarte").otherwise(F.col("level"))
    d = df.withColumn("final_level", level).withColumn("final_essential", liked | (F.col("essential") & ~disliked))
    named = F.coalesce("text_rubric", "keyword_rubric", "theme_rubric", F.lit("autres"))
    return d.withColumn("rubric", F.when(F.col("final_level").isin("elevee", "moyenne"), named).otherwise("autres"))


def alert_type(df: DataFrame) -> DataFrame:
    """Adds alert: the type of key point an article makes, or null. Facts: base, duplicate, opinion, debate, liked,
    out_of_scope, european, essential, numbered, ai_topic_yes, ai_applies, excluded (reviews, reports, fines, studies), sme_only,
    key_text, excluded_sector, central_topic, instrument, sig_fort; columns level, nature, status, title_status, ai_verdict,
    ai_reason, ai_type."""
    # columns, made once: written out wherever they are used, they make code that is too long to be compiled
    df = df.withColumn("_official", _is("nature", "officielle"))
    official, tc, numbered, stage, kind = F.col("_official"), fact("key_text"), F.col("_numbered"), F.col("_stage"), F.col("_kind")
    df = df.withColumn("_numbered", ~official & (F.col("level") == "elevee") & fact("numbered") & fact("ai_topic_yes") & fact("ai_applies"))
    df = df.withColumn("_stage", F.when(official, F.col("status")).otherwise(F.coalesce("title_status", F.when(numbered, "adopte"))))
    #: The type that a status gives.
    kinds = {"consultation": "proposition", "projet": "proposition", "lignes_directrices": "proposition", "adopte": "adopte", "en_vigueur": "adopte"}
    df = df.withColumn("_kind", F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[stage])
    typed = F.col("ai_type").isNull() | _is("ai_type", "texte_officiel", "projet_consultation", "obligation_echeance")
    unknown = F.when(~fact("excluded_sector") & fact("central_topic") & typed & fact("instrument") & (kind.isNotNull() | fact("sig_fort")), "a_qualifier")
    none = F.lit(None).cast("string")
    found = _first(
        [
            (fact("base") | fact("duplicate") | fact("opinion") | fact("debate"), none),
            (fact("liked"), F.lit("signale")),
            (fact("out_of_scope") & ~tc, none),
            (_is("ai_verdict", "pertinent") & _is("ai_reason", "preparation") & F.col("level").isin("elevee", "moyenne") & official & fact("european"), F.lit("proposition")),
            (~(fact("essential") | numbered) | (F.col("level") != "elevee") | ~fact("european"), none),
            (fact("excluded") | (fact("sme_only") & ~tc), none),
            (~official & stage.isNull(), none),
            (~official & F.coalesce(stage == "lignes_directrices", F.lit(False)), none),
            (~tc, unknown),
        ],
        kind,
    )
    return df.withColumn("alert", found).drop("_official", "_numbered", "_stage", "_kind")


def expected_kind(df: DataFrame) -> DataFrame:
    """Adds kind: avis, evolution or pressenti, what an article says of a text to come, or null. Facts: expert, sme_only,
    public_only, company, out_of_field, key_text, cyber_text, cyber_topic, change, intention, unnamed_text, ai_fits, staged;
    column ai_type."""
    tc, change, plan = fact("key_text"), fact("change"), fact("intention")
    ruled_out = fact("sme_only") | (fact("public_only") & ~fact("company")) | fact("out_of_field")
    none = F.lit(None).cast("string")
    politics = _is("ai_type", "politique")
    found = _first(
        [
            (ruled_out, none),
            (fact("expert") & ~(fact("cyber_text") | fact("cyber_topic")), none),
            (fact("expert") & tc & ~change & ~plan, F.lit("avis")),
            (fact("expert") & tc, F.lit("evolution")),
            (fact("expert"), F.when(plan | fact("unnamed_text"), "pressenti")),
            (~fact("ai_fits") | _is("ai_type", *SETTLED_TYPES), none),
            (tc, F.when((change & (plan | politics)) | (change & _is("ai_type", "projet_consultation") & ~fact("staged")), "evolution")),
            (plan | politics, F.lit("pressenti")),
        ],
        none,
    )
    return df.withColumn("kind", found)


def fallback_score(groups: Column, weak: list[str]) -> Column:
    """The score without a model: 0.6 with a group of keywords that suffices by itself, 0.45 with another, else 0.3."""
    return F.when(F.size(F.array_except(groups, F.array(*map(F.lit, weak)))) > 0, 0.6).when(F.size(groups) > 0, 0.45).otherwise(0.3)


def source_nature(kind: Column, domain: Column, official: str) -> Column:
    """opinion, cabinet, officielle or presse, from a source's type without marks and its domain."""
    t = F.lower(kind)
    return (
        F.when(t.contains("avis d'expert") | t.contains("non certifie") | t.startswith("opinion"), "opinion")
        .when(t.contains("avocat"), "cabinet")
        .when(t.contains("officiel") | t.contains("gouvernement") | F.rlike(domain, F.lit(official)), "officielle")
        .otherwise("presse")
    )


def worth_reading(as_of: str, days: int = 60) -> Column:
    """Whether a page is to be read: recent, neither base nor expert nor mail, and kept, near or official."""
    recent = F.col("day") >= F.date_sub(F.lit(as_of).cast("date"), days)
    return ~_is("nature", "rkc", "opinion") & ~fact("base") & recent & ((F.col("level") != "ecarte") | (F.coalesce("score", F.lit(0.0)) >= THRESHOLDS["bas"]) | _is("nature", "officielle"))


def worth_asking(candidate: Column, new: Column) -> Column:
    """Whether an article is put to the triage: kept, or set aside without noise and official or likely; of the noisy ones
    only vulnerabilities that speak of the sector."""
    likely = _is("nature", "officielle") | (F.coalesce("score", F.lit(0.0)) >= THRESHOLDS["moyenne"])
    aside = F.when(fact("noise"), fact("vulnerability") & fact("sector_named")).otherwise(likely)
    return (candidate | new) & ((F.col("level") != "ecarte") | aside) & ~_is("nature", "opinion") & ~fact("base")


def several_sources(df: DataFrame) -> DataFrame:
    """Adds raised: an unknown text of high level that other sources take up too, with a strong signal on a strong topic, enters
    the essential list. Facts: essential, base, key_text, sig_fort, topic_strong; columns level, nature, copies."""
    unknown = ~fact("essential") & ~fact("base") & ~fact("key_text") & ~_is("nature", "opinion")
    return df.withColumn("raised", unknown & _is("level", "elevee") & (F.coalesce("copies", F.lit(0)) > 0) & fact("sig_fort") & fact("topic_strong"))
