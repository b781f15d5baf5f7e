"""Ranked full-text search over a document table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import questions
from ..functions.text import folded
from ..session import Scratch
from .listing import sections

#: BM25's constants.
K1, B = 1.2, 0.75


def bm25(docs: DataFrame, key: str, words: str, query: list[str], top: int | None = None) -> DataFrame:
    """(key, score) of the documents with a word of the query; ``words`` is an array column.

    Each text is split once: its length and its counts of the query's words, a few numbers a row, are written as a table, from
    which come the statistics, which are one row, and the scores. No shuffle by document.
    """
    wanted = sorted(set(query))
    counts = [(F.size("_w") - F.size(F.array_remove("_w", w))).alias(f"tf_{i}") for i, w in enumerate(wanted)]
    # a row is exploded to itself: what is in front of that is computed once, however often it is used behind
    once = docs.select(F.col(key), F.explode(F.array(F.col(words))).alias("_w"))
    scratch = Scratch(docs.sparkSession)
    d = scratch.write(once.select(key, F.size("_w").alias("len"), *counts))
    some = [F.count(F.when(F.col(f"tf_{i}") > 0, 1)).alias(f"df_{i}") for i in range(len(wanted))]
    both = d.crossJoin(F.broadcast(d.agg(F.count("*").alias("n_docs"), F.avg("len").alias("mean"), *some)))

    def part(i: int) -> Column:
        tf, df = F.col(f"tf_{i}"), F.col(f"df_{i}")
        idf = F.log(1 + (F.col("n_docs") - df + 0.5) / (df + 0.5))
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("len") / F.col("mean")))

    hits = sum((F.col(f"tf_{i}") for i in range(1, len(wanted))), F.col("tf_0"))
    found = both.where(hits > 0).select(key, F.round(sum((part(i) for i in range(1, len(wanted))), part(0)), 6).alias("score"))
    return found.orderBy(F.desc("score"), key).limit(top) if top else found


def boosted(df: DataFrame, text_score: str, zones: list[str], topics: list[str], intents: list[str], horizon: int | None, as_of: str, has_words: bool = True) -> DataFrame:
    """Adds score, null for rows that the question rules out, and keeps only scores above 0.

    Reads kind (article, alerte, texte, date), zone, codes (array), level, essential, fine, status, type, day and the text
    score, which is 0 without a word in common. The weights are fixed values.
    """
    s, hit = F.col(text_score), F.col(text_score) > 0
    kind, day = F.col("kind"), F.col("day")
    asked = lambda i: F.lit(i in intents)
    is_in = lambda c, *values: F.coalesce(F.col(c).isin(*values), F.lit(False))
    on_topic = F.coalesce(F.arrays_overlap("codes", F.array(*map(F.lit, topics))), F.lit(False)) if topics else F.lit(False)
    plus = lambda c, n: F.when(c, F.lit(float(n))).otherwise(0.0)
    near = is_in("zone", *zones) if zones else F.lit(False)
    wide = (F.col("zone") == "Europe") & F.lit("Europe" not in zones) & (kind != "article") if zones else F.lit(False)
    out = F.lit(False)
    if has_words:
        out = out | (~hit & ~on_topic)
    if zones:
        out = out | ~(near | wide)
    if topics:
        out = out | (~on_topic & ~hit)
    dated = (kind == "date") | ((kind == "alerte") & is_in("type", "echeance"))
    since = F.datediff(F.lit(as_of).cast("date"), day)
    if horizon:
        late = ~dated & day.isNotNull() & (since > horizon) & ~asked("echeance")
        out = out | (dated & ~F.coalesce((-since).between(0, horizon), F.lit(False))) | late
    article, alert = kind == "article", kind == "alerte"
    told = s + plus(near, 3) + plus(~near & wide, 0.3)
    if topics:
        told = told + F.when(on_topic, 4.0).otherwise(-1.0)
    level = F.when(F.col("level") == "elevee", 1.5).when(F.col("level") == "moyenne", 0.7).otherwise(-0.5)
    told = told + F.when(article, level + plus(F.col("essential"), 1)).otherwise(0.0)
    told = told + F.when(article & asked("sanction"), F.when(F.col("fine") | is_in("status", "sanction"), 3.0).otherwise(-1.0)).otherwise(0.0)
    told = told + plus(article & asked("projet") & is_in("status", "projet", "consultation"), 2.5) + plus(article & asked("nouveau") & is_in("status", "adopte", "en_vigueur"), 1.5)
    told = told + plus(alert, 1.5) + plus(alert & asked("projet") & is_in("type", "proposition"), 2) + plus(alert & asked("nouveau") & is_in("type", "adopte"), 2)
    told = told + plus((kind == "texte") & asked("obligation"), 2) + plus(dated & asked("echeance"), 3)
    told = told + F.when(since.between(0, 30), 2.0 if "nouveau" in intents else 0.8).when(since <= 90, 0.4).otherwise(0.0)
    return df.withColumn("score", F.round(told, 6)).where(~out & (F.col("score") > 0))


@dataclass
class Question:
    """The parts of a question: zones, topics and intents it names, the days it looks ahead or back, and the words left."""

    zones: list[str] = field(default_factory=list)
    topics: list[str] = field(default_factory=list)
    intents: list[str] = field(default_factory=list)
    horizon: int | None = None
    words: list[str] = field(default_factory=list)


def understood(spark: SparkSession, question: str, zones: dict[str, str], topics: dict[str, str], intents: dict[str, str], known: list[str] | None = None) -> Question:
    """The parts of one question, by tables of patterns over its folded text. What a pattern has taken is no word to search."""
    text = folded(F.lit(question))
    left = text
    for pattern in [*zones.values(), *topics.values(), *intents.values(), questions.HORIZON]:
        left = F.regexp_replace(left, pattern, " ")
    words = F.filter(questions.residual(left, known or []), lambda w: ~F.rlike(w, F.lit("^[0-9]+$")))
    parts = [questions.named(text, rules).alias(name) for name, rules in (("zones", zones), ("topics", topics), ("intents", intents))]
    r = spark.range(1).select(*parts, questions.horizon(text).alias("horizon"), words.alias("words")).first()
    return Question(r["zones"], r["topics"], r["intents"], r["horizon"], r["words"])


#: Rows of each section of an answer.
SECTIONS = {"alerte": 5, "date": 8, "texte": 5, "article": 10}


def answer(docs: DataFrame, key: str, words: str, question: Question, as_of: str) -> DataFrame:
    """The sections of an answer: (section, kind, place, key, score), ``section`` the place of the kind.

    Words are scored by BM25 over all documents; its score is raised, lowered or ruled out by the other parts of the question
    (``boosted``, whose columns ``docs`` has). Deadlines asked for put dates first, obligations texts, other intents alerts;
    a question without an intent puts alerts first and then the kind with the best score. A question without any part has
    no answer.
    """
    q = question
    if not (q.zones or q.topics or q.intents or q.words):
        empty = docs.select(key, "kind").where("false")
        return empty.select(F.lit(0).alias("section"), "kind", F.lit(0).alias("place"), key, F.lit(0.0).alias("score"))
    told = docs.drop(words)
    if q.words:
        text = bm25(docs, key, words, q.words).withColumnRenamed("score", "_text")
        told = told.join(text, key, "left").withColumn("_text", F.coalesce("_text", F.lit(0.0)))
    else:
        told = told.withColumn("_text", F.lit(0.0))
    scored = boosted(told, "_text", q.zones, q.topics, q.intents, q.horizon, as_of, has_words=bool(q.words))
    found = sections(scored.select(key, "kind", "score"), "kind", [F.desc("score"), F.col(key)], SECTIONS)
    return found.join(F.broadcast(_order(found, q.intents)), "kind").select("section", "kind", "place", key, "score")


def _order(found: DataFrame, intents: list[str]) -> DataFrame:
    """(kind, section): a row for each kind of the answer."""
    first = ["date", "alerte", "texte"] if "echeance" in intents else ["texte", "alerte", "date"] if "obligation" in intents else ["alerte", "texte", "date"]
    fixed = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(first)], F.lit(3))
    kinds = found.groupBy("kind").agg(F.max("score").alias("best")).withColumn("fixed", fixed)
    order = ["fixed"] if intents else [F.col("kind") != "alerte", F.desc("best"), F.col("fixed")]
    return kinds.select("kind", F.row_number().over(Window.orderBy(*order)).alias("section"))  # four rows
