"""The register of key points: windows of activity, their articles, deadlines, links to other articles, emerging names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .lifecycle import names_in_longer, sigla_of_names

#: Days a key point stays active, days a late publication counts from, articles and links it lists at most.
ACTIVE, LATE, OWN, LINKED = 28, 14, 6, 80
#: Articles a new name needs, with an official one and without, and sources.
FEW, MANY, SOURCES = 2, 3, 2


def windows(articles: DataFrame, keys: list[str], detected: str, published: str, to_verify: str, identity: str, as_of: str) -> DataFrame:
    """One row for each key: first and last detection, latest publication, count, lead, and until when it is active. The
    window starts with the first detection, or 14 days after the first publication where that was found late."""
    lead = F.max_by(identity, F.struct(published, detected, identity))
    g = articles.groupBy(*keys).agg(
        F.min(detected).alias("first_at"), F.max(detected).alias("last_at"), F.min(published).alias("first_published"), F.max(published).alias("latest"),
        F.count("*").alias("n"), F.bool_and(to_verify).alias("to_verify"), lead.alias("lead"),
    )
    start = F.least("first_at", F.date_add("first_published", LATE))
    g = g.withColumn("ends", F.date_add(start, ACTIVE)).drop("first_published")
    return g.withColumn("active", F.col("ends") >= F.lit(as_of).cast("date"))


def latest_articles(articles: DataFrame, keys: list[str], order: list[Column], identity: str, n: int = OWN) -> DataFrame:
    """Per key the identities of its latest ``n`` articles, in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    top = articles.select(*keys, identity, F.row_number().over(w).alias("_nth")).where(F.col("_nth") <= n)
    listed = F.sort_array(F.collect_list(F.struct("_nth", identity)))  # n at most
    return top.groupBy(*keys).agg(F.transform(listed, lambda x: x[identity]).alias("articles"))


def deadline_alerts(dated: DataFrame, zone: str, day: str, order: list[str], kept: list[str]) -> DataFrame:
    """One key point for each zone and day: of the first article that tells the date."""
    return dated.groupBy(zone, day).agg(F.min_by(F.struct(*kept), F.struct(*order)).alias("_f")).select(zone, day, *[F.col(f"_f.{k}").alias(k) for k in kept])


def linked(alerts: DataFrame, own: DataFrame, articles: DataFrame, alert: str, code: str, article: str, day: str, most: int = LINKED, own_most: int = OWN) -> DataFrame:
    """(alert, article, place): the latest articles that share a code with an alert and are not its own.

    ``alerts`` has a row for each alert and code, ``articles`` one for each article and code. An alert lists ``most`` at
    most and has ``own_most`` articles of its own, so no more than their sum of each code's latest can be listed: a code's
    other articles are left out before the join.
    """
    latest = Window.partitionBy(code).orderBy(F.desc(day), article)
    near = articles.dropDuplicates([code, article]).withColumn("_nth", F.row_number().over(latest)).where(F.col("_nth") <= most + own_most).drop("_nth")
    both = alerts.select(alert, code).distinct().join(near, code).select(alert, article, day).distinct().join(own.select(alert, article), [alert, article], "left_anti")
    place = F.row_number().over(Window.partitionBy(alert).orderBy(F.desc(day), article))
    return both.withColumn("place", place).where(F.col("place") <= most).select(alert, article, "place")


def emerging_names(terms: DataFrame, document: str) -> DataFrame:
    """(name, siglum, articles): names and sigla that appear in the window and never before it.

    Reads term, is_siglum, ``document``, source, in_window, official, keyed (the article cites a known text), signal. A siglum
    that starts the initials of a name with which it shares an article stands for that name. Needed: three articles, or two
    with an official one, two sources, a signal, and not mostly articles on known texts. A name inside a longer kept one
    that has half of its articles too is dropped; longer names are settled first.
    """
    known = terms.where(~F.col("in_window")).select(F.lower("term").alias("low")).distinct()
    seen = terms.where("in_window").join(known, F.lower("term") == F.col("low"), "left_anti")
    names, sigla = seen.where(~F.col("is_siglum")), seen.where("is_siglum")
    pairs = sigla_of_names(sigla.select(document, F.col("term").alias("siglum")), names.select(document, F.col("term").alias("name")), document, 3)
    alias = pairs.groupBy("siglum").agg(F.max_by("name", F.struct("shared", "name")).alias("name"))
    scratch = Scratch(terms.sparkSession)
    alias = scratch.write(alias)
    merged = scratch.write(seen.join(alias.withColumnRenamed("siglum", "term"), "term", "left").withColumn("name", F.coalesce("name", "term")))
    g = merged.groupBy("name").agg(
        F.countDistinct(document).alias("articles"), F.countDistinct("source").alias("sources"), F.bool_or("official").alias("official"),
        F.bool_or("signal").alias("signal"), F.countDistinct(F.when(F.col("keyed"), F.col(document))).alias("keyed"),
    )
    enough = (F.col("articles") >= MANY) | ((F.col("articles") >= FEW) & F.col("official"))
    kept = g.where(enough & (F.col("sources") >= SOURCES) & F.col("signal") & (2 * F.col("keyed") <= F.col("articles")))
    kept = scratch.write(kept)
    held = merged.join(kept.select("name"), "name", "left_semi").select(document, "name").distinct()
    inside = names_in_longer(held, document).select("name", "longer")
    kept = greedy_longest(kept.select("name", "articles"), inside)
    shown = alias.groupBy("name").agg(F.min("siglum").alias("siglum"))
    out = scratch.write(kept.join(shown, "name", "left").select("name", "siglum", "articles"))
    scratch.leave(out)
    return out


def greedy_longest(names: DataFrame, inside: DataFrame) -> DataFrame:
    """The names that no kept longer one (``inside``: name, longer) takes in: settled by number of words, the most first,
    once for each number that occurs."""
    scratch = Scratch(names.sparkSession)
    left, inside = scratch.write(names.withColumn("_w", F.size(F.split("name", " ")))), scratch.write(inside)
    sizes = sorted((r[0] for r in left.select("_w").distinct().collect()), reverse=True)  # numbers of words, not names
    kept = left.where("false")
    for size in sizes:
        now = left.where(F.col("_w") == size)
        if size != sizes[0]:
            taken = inside.join(kept.select(F.col("name").alias("longer")), "longer", "left_semi").select("name").distinct()
            now = now.join(taken, "name", "left_anti")
        kept = scratch.write(kept.unionByName(now))
    scratch.leave(kept)
    return kept.drop("_w")
