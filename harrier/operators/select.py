"""Predicates and decisions: closed lists, first match, facets, exact and broad search, novelty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def codes(text: Column, rules: dict[str, str]) -> Column:
    """Codes of a closed list whose pattern is found in the text, in the list's order."""
    return F.array_compact(F.array(*[F.when(F.rlike(text, F.lit(p)), F.lit(code)) for code, p in rules.items()]))


def first_match(text: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The name of the first rule whose pattern is found; order matters."""
    return F.coalesce(*[F.when(F.rlike(text, F.lit(p)), F.lit(name)) for name, p in rules], F.lit(otherwise))


def facets(df: DataFrame, chosen: dict[str, list]) -> DataFrame:
    """Rows that match every facet; within a facet any value will do, arrays by overlap."""
    kinds = dict(df.dtypes)
    tests = [F.arrays_overlap(F.col(c), F.array(*map(F.lit, v))) if kinds[c].startswith("array") else F.col(c).isin(v) for c, v in chosen.items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def says(text: Column, phrase: str) -> Column:
    """Whole words, in this case, anywhere."""
    quoted = "".join(c if c.isalnum() or c == " " else f"\\{c}" for c in phrase)
    return F.rlike(text, F.lit(rf"(^|[^\p{{L}}\p{{N}}]){quoted}([^\p{{L}}\p{{N}}]|$)"))


def holds_all(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.contains(F.lower(text), F.lit(w.lower())) for w in words])


def recent(df: DataFrame, day: str, as_of: str, short: int = 30, long: int = 60, least: int = 25) -> DataFrame:
    """The last ``short`` days if they hold ``least`` rows, else the last ``long``: one row decides, broadcast."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col(day))
    window = df.agg(F.when(F.count(F.when(age.between(0, short), 1)) >= least, short).otherwise(long).alias("days_back"))
    return df.crossJoin(F.broadcast(window)).where(age.between(0, F.col("days_back"))).drop("days_back")


def new_rows(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return df.join(seen.select(key).distinct(), key, "left_anti")
