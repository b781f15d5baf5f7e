"""Registers over time: failure streaks, topic lifecycle, duplicate leaders, name joins, summaries in first-seen order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import initials
from . import ranks


def streak(df: DataFrame, key: str, order: list[str], failed: Column) -> DataFrame:
    """(key, streak): failures since the last success. Two grouped passes that combine before the shuffle, no window."""
    at = F.struct(*order)
    marked = df.select(key, at.alias("at"), failed.alias("failed"))
    last = marked.groupBy(key).agg(F.max(F.when(~F.col("failed"), F.col("at"))).alias("good"))
    after = marked.where("failed").join(last, key).where(F.col("good").isNull() | (F.col("at") > F.col("good")))
    counted = after.groupBy(key).agg(F.count("*").alias("streak"))
    return last.select(key).join(counted, key, "left").select(key, F.coalesce("streak", F.lit(0)).alias("streak"))


def lifecycle(topics: DataFrame, first: str, last: str, became: str, as_of: str, shown: int = 28, expires: int = 365) -> DataFrame:
    """Adds status: ``became`` for ``shown`` days after a promotion, then ``closed``; ``expired`` without a signal for
    ``expires`` days; else ``expected``. A promotion before the first signal does not count."""
    today = F.lit(as_of).cast("date")
    promoted = F.col(became) >= F.col(first)
    fresh = F.datediff(today, F.col(became)) <= shown
    status = F.when(promoted & fresh, "became").when(promoted, "closed").when(F.datediff(today, F.col(last)) > expires, "expired")
    return topics.withColumn("status", status.otherwise("expected"))


def duplicate_leaders(df: DataFrame, key: str, source: str, order: list[str]) -> DataFrame:
    """Adds leader: the first row of the same key, if it comes from another source; rows of the leader's source stay
    alone. One grouped minimum joined back, so copies make no pairs and a hot key no long task before the join."""
    lead = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("o"), F.min_by(source, F.struct(*order)).alias("lead_source"))
    lead = lead.select(key, F.col(f"o.{order[-1]}").alias("leader"), "lead_source")
    both = df.join(lead, key, "left")
    return both.withColumn("leader", F.when(F.col("lead_source") != F.col(source), F.col("leader"))).drop("lead_source")


def sigla_of_names(sigla: DataFrame, names: DataFrame, document: str, least: int = 2) -> DataFrame:
    """(siglum, name, shared): the siglum starts the name's initials and both occur in a document.

    The prefixes of the initials are few, so the comparison is an equality on (document, prefix) and no cross join.
    """
    n = names.select(document, "name", F.upper(initials(F.col("name"))).alias("i")).where(F.length("i") >= least)
    n = n.withColumn("siglum", F.explode(F.transform(F.sequence(F.lit(least), F.length("i")), lambda k: F.substring(F.col("i"), F.lit(1), k))))
    both = sigla.select(document, "siglum").distinct().join(n.select(document, "name", "siglum").distinct(), [document, "siglum"])
    return both.groupBy("siglum", "name").agg(F.count("*").alias("shared"))


def names_in_longer(names: DataFrame, document: str) -> DataFrame:
    """(name, longer): a name inside a longer one that at least half of its documents hold too.

    Each name gives all its runs of words, so containment is an equality as well; names are a few words long.
    """
    n = names.select(document, "name").distinct()
    words = F.split("name", " ")
    ends = F.sequence(F.lit(1), F.size("w"))
    runs = F.flatten(F.transform(ends, lambda i: F.transform(F.sequence(F.lit(1), F.size("w") - i + 1), lambda k: F.array_join(F.slice(F.col("w"), i, k), " "))))
    inside = n.withColumn("w", words).select(document, F.col("name").alias("longer"), F.explode(F.array_distinct(runs)).alias("name")).where("name <> longer")
    shared = n.join(inside, [document, "name"]).groupBy("name", "longer").agg(F.count("*").alias("shared"))
    return shared.join(n.groupBy("name").agg(F.count("*").alias("all")), "name").where("2 * shared >= all").select("name", "longer", "shared")


def first_seen_lists(df: DataFrame, key: str, value: str, day: str) -> DataFrame:
    """(key, listed, n, next_day): distinct values in the order first seen. Values combine before they are listed, so
    a list is as long as the value's domain, whatever the number of rows."""
    one = df.groupBy(key, value).agg(F.min(day).alias("first"), F.count("*").alias("n"), F.max(day).alias("latest"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("first", value))), lambda x: x[value])
    return one.groupBy(key).agg(F.array_join(listed, ",").alias("listed"), F.sum("n").alias("n"), F.max("latest").alias("latest"))


def blocks(df: DataFrame, key: str, order: list[Column], size: int = 6) -> DataFrame:
    """Adds block: the rows of each key in blocks of ``size``."""
    return ranks.placed(df, [key], order, "_place").withColumn("block", F.floor((F.col("_place") - 1) / size)).drop("_place")


def overlay(base: DataFrame, added: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """The base table and rows it lacks; removed keys stay, flagged."""
    new = added.join(base.select(key), key, "left_anti").dropDuplicates([key])
    gone = removed.select(key, F.lit(True).alias("inactive")).distinct()
    return base.unionByName(new).join(gone, key, "left").withColumn("inactive", F.coalesce("inactive", F.lit(False)))
