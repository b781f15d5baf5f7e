"""Relevance decisions as ordered conditions over boolean and numeric columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(steps: list[tuple[Column, str]], otherwise: str) -> Column:
    """The outcome of the first condition that holds; a null condition does not."""
    return F.coalesce(*[F.when(c, F.lit(v)) for c, v in steps], F.lit(otherwise))


def overridden(decision: Column, feedback: Column, up: str, down: str) -> Column:
    """A reader's verdict (1, 0 or null) goes before the rules."""
    return F.when(feedback == 1, up).when(feedback == 0, down).otherwise(decision)


def best_theme(similarities: Column) -> Column:
    """Of an array of structs (score, theme) the best; ties go to the first theme."""
    return F.array_max(F.transform(similarities, lambda x: F.struct(x["score"].alias("score"), (-x["theme"]).alias("back"))))
