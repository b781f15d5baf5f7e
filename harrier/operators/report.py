"""Tables of a report: groups with their lead, summaries in a fixed order, calendars, footnotes, cut lists, sorted places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranks

#: Levels and types of key points in the order they are shown.
LEVELS = ("elevee", "moyenne", "faible", "ecarte")
TYPES = {"echeance": 1, "adopte": 2, "signale": 2, "proposition": 3, "a_qualifier": 4}


def rank_of(c: Column, order: tuple[str, ...] | dict[str, int], otherwise: int = 9) -> Column:
    """A value's place in an order, for sorting."""
    places = order if isinstance(order, dict) else {x: i for i, x in enumerate(order)}
    return F.coalesce(F.create_map(*[F.lit(x) for pair in places.items() for x in pair])[c], F.lit(otherwise))


def groups(articles: DataFrame, text: str, rest: list[str], identity: str, lead: list[Column], verify: Column) -> DataFrame:
    """Slide groups: articles of one text, zone and stage, those without a text alone; the lead is the first by ``lead``.
    One combined aggregate, no window: a struct orders the lead."""
    alone = F.when(F.col(text).isNull(), F.col(identity))
    d = articles.withColumn("_alone", alone)
    g = d.groupBy(text, *rest, "_alone").agg(F.count("*").alias("n"), F.min_by(identity, F.struct(*lead)).alias("lead"), F.bool_or(verify).alias("verify"))
    return g.drop("_alone")


def placed(df: DataFrame, within: list[str], orders: dict[str, list[Column]]) -> DataFrame:
    """Adds the place of each row under every order."""
    for name, order in orders.items():
        df = ranks.placed(df, within, order, name)
    return df


def cut(df: DataFrame, order: list[Column], most: int = 350) -> DataFrame:
    """The first ``most`` rows with their place from 1, and ``hidden``, the number of rows not shown."""
    shown = df.orderBy(*order).limit(most)
    total = df.agg(F.greatest(F.count("*") - most, F.lit(0)).alias("hidden"))
    place = F.row_number().over(Window.orderBy(*order))  # over most rows
    return shown.withColumn("place", place).crossJoin(F.broadcast(total))


def text_summary(articles: DataFrame, text: str, zone: str, stage: str, day: str, due: str, as_of: str) -> DataFrame:
    """Per text: zones and stages in the order first seen, articles and the next date due; ``place`` orders texts by articles, those
    without a name last. Values are combined before they are listed, so a list is no longer than the domain of its values."""

    def listed(value: str) -> DataFrame:
        one = articles.groupBy(text, value).agg(F.min(day).alias("_first"))
        names = F.transform(F.sort_array(F.collect_list(F.struct("_first", value))), lambda x: x[value])
        return one.groupBy(text).agg(F.array_join(names, ",").alias(f"{value}s"))

    total = articles.groupBy(text).agg(F.count("*").alias("n"), F.min(F.when(F.col(due) >= F.lit(as_of).cast("date"), F.col(due))).alias("next_due"))
    same = lambda a, b: a.join(b.withColumnRenamed(text, "_t"), F.col(text).eqNullSafe(F.col("_t"))).drop("_t")
    found = same(same(total, listed(zone)), listed(stage))
    unnamed = F.coalesce(F.col(text) == "", F.lit(True))
    return found.withColumn("place", F.row_number().over(Window.orderBy(unnamed, F.desc("n"), text)))  # a row for each text


def top_of_each(df: DataFrame, key: str, sections: dict[str, tuple[DataFrame, list[Column], Column, int]]) -> DataFrame:
    """(key, section, place, shown): the first rows of several lists for each key."""
    found = None
    for name, (rows, order, shown, most) in sections.items():
        place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
        one = rows.withColumn("place", place).where(F.col("place") <= most).select(key, F.lit(name).alias("section"), "place", shown.cast("string").alias("shown"))
        found = one if found is None else found.unionByName(one)
    return found.join(df.select(key).distinct(), key, "left_semi")
