"""The register of expected topics: what articles announce before a text is out, over runs, until a key point shows it.

An article belongs to the topic of its text and zone, or of the name of a text yet unknown, or stands alone. Articles on a
package that changes several texts form one topic. A topic keeps its first signal over runs. A key point promotes it;
without new signals it expires. Running a day again on its own output changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import folded
from ..session import Scratch
from .relate import first_after, first_per

#: Days a promoted topic is shown, an opinion and any other topic last; articles listed.
SHOWN, OPINIONS, EXPIRES, LISTED = 28, 183, 365, 12
#: Types of key points that promote, statuses that one of their articles needs, the name of the package.
PROMOTING, OUT, PACKAGE = ("proposition", "adopte", "a_qualifier"), ("projet", "adopte", "en_vigueur"), "Digital Omnibus"
SCHEMA = "id string, kind string, text string, name string, zone string, first_signal date, last_signal date, articles array<long>, n long, sources long, status string, became date, key_point string"
_NAMES = [x.strip().split(" ")[0] for x in SCHEMA.split(", ")]
#: Letters of a name that lead to the texts that may hold it.
GRAM = 4


def topics(articles: DataFrame, active: DataFrame, today: str) -> DataFrame:
    """A topic for each text, name or lone article of ``articles``: id, source, day, kind (``relevance.expected_kind``), text,
    name, zone, package. ``active`` has the ids of articles of active key points, which are no longer expected.

    Articles without a kind or a day, and those older than 365 days, take no part; ids repeated in a topic count once, by
    their latest day. The latest twelve are listed, ties by id. Null and empty zones are Europe's; empty texts and names count as none.
    """
    oldest = F.date_sub(F.lit(today).cast("date"), EXPIRES)
    a = articles.where(F.col("kind").isNotNull() & (F.col("day") >= oldest)).join(active.select("id").distinct(), "id", "left_anti")
    package = F.coalesce("package", F.lit(False))
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    a = a.withColumn("text", F.when(~package, given("text")))
    a = a.withColumn("name", F.when(package, PACKAGE).when(F.col("text").isNull(), given("name")))
    a = a.withColumn("zone", F.when(package, "Europe").otherwise(F.coalesce(given("zone"), F.lit("Europe"))))
    part = F.when(F.col("text").isNotNull(), F.concat_ws("|", F.lit("t"), "text", "zone")).when(F.col("name").isNotNull(), F.concat_ws("|", F.lit("n"), folded(F.col("name")), "zone"))
    key = F.concat_ws("|", "kind", F.coalesce(part, F.concat(F.lit("a|"), F.col("id").cast("string")))).alias("_key")
    scratch = Scratch(articles.sparkSession)
    a = scratch.write(a.select(key, "id", "source", "day", "kind", "text", "name", "zone"))
    # one distinct count a pass: two in one would repeat each row for each of them
    g = a.groupBy("_key").agg(
        F.first("kind").alias("kind"), F.first("text").alias("text"), F.min("name").alias("name"), F.min("zone").alias("zone"), F.min("day").alias("first_signal"),
        F.max("day").alias("last_signal"), F.countDistinct("source").alias("sources"),
    )
    once = a.groupBy("_key", "id").agg(F.max("day").alias("day"))
    counted = once.groupBy("_key").agg(F.count("id").alias("n"))
    top = first_per(once, ["_key"], [F.desc("day"), F.asc("id")], LISTED, "_nth").groupBy("_key")
    top = top.agg(F.transform(F.sort_array(F.collect_list(F.struct("_nth", "id"))), lambda x: x["id"].cast("long")).alias("articles"))  # LISTED at most
    named = g.join(counted, "_key").join(top, "_key").withColumn("id", F.concat(F.lit("p"), F.substring(F.sha1("_key"), 1, 11)))
    none = F.lit(None)
    out = scratch.write(named.select("id", *_NAMES[1:10], F.lit("pressenti").alias("status"), none.cast("date").alias("became"), none.cast("string").alias("key_point")))
    scratch.leave(out)
    return out


def _grams(c: str, n: int):
    """The distinct runs of ``n`` characters."""
    starts = F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(c), i, F.lit(n))))


def named_in(names: DataFrame, told: DataFrame, name: str, text: str) -> DataFrame:
    """Pairs of rows whose ``name`` is a part of ``text``, anywhere in it, both as they are; empty names pair with nothing.

    A name is led by its rarest run of four characters (all of a shorter one) to the texts that have that run, and then
    compared: an equality join, so no name meets all texts, and no pair is lost.
    """
    n = names.where(F.length(name) > 0).withColumn("_len", F.least(F.length(name), F.lit(GRAM)))
    whole = [told.withColumn("_gram", F.explode(_grams(text, k))) for k in range(1, GRAM + 1)]
    held = whole[0]
    for more in whole[1:]:
        held = held.unionByName(more)
    own = F.when(F.col("_len") == GRAM, _grams(name, GRAM)).otherwise(F.array(name))
    runs = n.select(name, F.explode(own).alias("_gram")).distinct()
    held = held.join(runs.select("_gram").distinct(), "_gram", "left_semi")
    often = held.groupBy("_gram").agg(F.count("*").alias("_df"))
    # a name with a run that no text has is in no text
    rarest = runs.join(often, "_gram", "left").groupBy(name).agg(F.min_by("_gram", F.struct(F.coalesce("_df", F.lit(0)), "_gram")).alias("_gram"))
    return n.drop("_len").join(rarest, name).join(held, "_gram").where(F.contains(F.col(text), F.col(name))).drop("_gram")


def promotions(waiting: DataFrame, key_points: DataFrame) -> DataFrame:
    """(id, became, key_point): the first key point, by day and then id, that shows that an expected text is out.

    ``key_points``: id string, type, text, zone, told (its text and titles), detected, out (an article of its has a status of
    ``OUT``). It must promote by its type, be of the topic's zone, and not be older than the first signal. A topic of a
    known text needs that text; one of a name needs the name in what the key point tells, without accents or case.
    """
    zone = F.coalesce(F.nullif(F.col("zone"), F.lit("")), F.lit("Europe")).alias("zone")
    shown = key_points.where(F.col("type").isin(*PROMOTING) & F.col("out")).select(zone, "text", F.coalesce("told", F.lit("")).alias("told"), F.col("detected").alias("became"), F.col("id").alias("key_point"))
    scratch = Scratch(key_points.sparkSession)

    def firsts(k: DataFrame, by: str) -> DataFrame:
        """The first key point of each day: no other can be the first from a day on. They are combined before the shuffle."""
        return k.groupBy(by, "zone", "became").agg(F.min(F.struct("key_point")).alias("_first")).select(by, "zone", "became", "_first.key_point")

    w = waiting.select("id", "text", "zone", "first_signal", folded(F.coalesce("name", F.lit(""))).alias("_name"))
    by_text = first_after(w.where("text is not null").drop("_name"), firsts(shown.where("text is not null"), "text"), ["text", "zone"], "first_signal", "became", ["key_point"])
    by_text = by_text.where("became is not null").select("id", "became", "key_point")
    # one row for each name and telling, so that a wording repeated by many key points is compared once
    names = w.where("text is null and _name <> ''")
    tellings = scratch.write(firsts(firsts(shown, "told").withColumn("_told", folded(F.col("told"))).where("_told <> ''"), "_told"))
    pairs = named_in(names.select("_name").distinct(), tellings.select("_told").distinct(), "_name", "_told")
    tells = firsts(pairs.join(tellings, "_told"), "_name")
    by_name = first_after(names.drop("text"), tells, ["_name", "zone"], "first_signal", "became", ["key_point"])
    scratch.leave()
    return by_text.unionByName(by_name.where("became is not null").select("id", "became", "key_point"))


def advance(old: DataFrame, now: DataFrame, key_points: DataFrame, today: str) -> DataFrame:
    """The register after a run: ``old`` as the last run left it, ``now`` the topics it sees (``topics``).

    A topic seen again keeps its first signal, its status and its promotion and takes the rest anew; one not seen stays as it
    was. Then topics are promoted, opinions never, and those past their days leave: 28 from a promotion, 183 from an
    opinion's last signal, 365 from another's.
    """
    before = old.select("id", F.col("first_signal").alias("_first"), F.col("status").alias("_status"), F.col("became").alias("_became"), F.col("key_point").alias("_point"))
    seen = now.drop("status", "became", "key_point").join(before, "id", "left").withColumn("first_signal", F.least("first_signal", "_first"))
    seen = seen.withColumns({"status": F.coalesce("_status", F.lit("pressenti")), "became": F.col("_became"), "key_point": F.col("_point")}).select(*_NAMES)
    scratch = Scratch(now.sparkSession)
    # as a table, or each of the promotions' passes would make the topics anew
    state = scratch.write(seen.unionByName(old.join(now.select("id"), "id", "left_anti").select(*_NAMES)))
    waiting = state.where((F.col("kind") != "avis") & (F.col("status") != "devenu_projet"))
    out = promotions(waiting, key_points).select("id", F.col("became").alias("_b"), F.col("key_point").alias("_p"))
    state = state.join(out, "id", "left")
    state = state.withColumns(
        {"status": F.when(F.col("_b").isNotNull(), "devenu_projet").otherwise(F.col("status")), "became": F.coalesce("_b", "became"), "key_point": F.coalesce("_p", "key_point")}
    )
    past = lambda c, n: F.coalesce(F.datediff(F.lit(today).cast("date"), F.col(c)) > n, F.lit(False))
    gone = F.when(F.col("status") == "devenu_projet", past("became", SHOWN)).when(F.col("kind") == "avis", past("last_signal", OPINIONS)).otherwise(past("last_signal", EXPIRES))
    register = scratch.write(state.where(~gone).select(*_NAMES))
    scratch.leave(register)
    return register


def shown_order() -> list:
    """Topics still expected, then opinions, then promoted ones; the latest signal first, then by id."""
    return [F.col("status") == "devenu_projet", F.col("kind") == "avis", F.desc("last_signal"), F.asc("id")]
