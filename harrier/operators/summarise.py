"""Aggregations: facet counts, coverage, trends, registers, emerging terms, confusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facet_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n) of several columns in one pass; arrays count once for each value."""
    kinds = dict(df.dtypes)

    def values(c: str) -> Column:
        held = F.array_distinct(c) if kinds[c].startswith("array") else F.array(c)
        return F.transform(held, lambda v: F.struct(F.lit(c).alias("facet"), v.cast("string").alias("value")))

    one = df.select(F.explode(F.concat(*map(values, columns))).alias("f"))
    return one.groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


def coverage(df: DataFrame, row: str, column: str, day: str, as_of: str, stale: int = 60) -> DataFrame:
    """Latest day by row and column with a ``*`` total column; stale when older than ``stale`` days."""
    found = df.groupingSets([[F.col(row), F.col(column)], [F.col(row)]], row, column).agg(F.max(day).alias("latest"))
    name = F.coalesce(column, F.lit("*")).alias(column)
    return found.select(row, name, "latest", (F.datediff(F.lit(as_of).cast("date"), "latest") > stale).alias("stale"))


def trend(df: DataFrame, key: str, day: str, as_of: str, span: int, least: int = 2) -> DataFrame:
    age = F.datediff(F.lit(as_of).cast("date"), F.col(day))
    found = df.groupBy(key).agg(F.count(F.when(age.between(0, span), 1)).alias("now"), F.count(F.when(age.between(span + 1, 2 * span + 1), 1)).alias("before"))
    return found.where(F.col("now") >= least).withColumn("diff", F.col("now") - F.col("before"))


def emerging(df: DataFrame, term: str, document: str, source: str, day: str, since: str, documents: int = 3, sources: int = 2) -> DataFrame:
    """Terms never seen before ``since``, then in enough documents and sources."""
    old = F.col(day) < F.lit(since).cast("date")
    found = df.groupBy(term).agg(F.countDistinct(document).alias("documents"), F.countDistinct(source).alias("sources"), F.min(day).alias("first_seen"), F.bool_or(old).alias("known"))
    return found.where(~F.col("known") & (F.col("documents") >= documents) & (F.col("sources") >= sources)).drop("known")


def register(df: DataFrame, keys: list[str], at: str, identity: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row for each key: first and last detection, count, and the latest row's identity as lead."""
    named = [c.alias(n) for n, c in (extra or {}).items()]
    return df.groupBy(*keys).agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count("*").alias("n"), F.max_by(identity, F.struct(at, identity)).alias("lead"), *named)


def confusion(df: DataFrame, truth: str, told: str) -> DataFrame:
    return df.groupBy(truth, told).agg(F.count("*").alias("n"))
