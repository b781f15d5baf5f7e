"""What a text speaks of: its probable zone, its sentences with a clue, and the parts of a question, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import folded


def probable(text: Column, rules: dict[str, str], otherwise: str = "Worldwide") -> Column:
    """The name whose pattern is found most often; ties go to the first one, no hit to ``otherwise``."""
    hits = [F.struct(F.regexp_count(text, F.lit(p)).alias("n"), F.lit(-i).alias("back"), F.lit(name).alias("name")) for i, (name, p) in enumerate(rules.items())]
    best = F.array_max(F.array(*hits))
    return F.when(best["n"] > 0, best["name"]).otherwise(otherwise)


def clue_sentences(text: Column, clue: str, least: int = 40, most: int = 400) -> Column:
    """The sentences of a whole text that hold a clue and are neither a heading nor a run of lists."""
    sentences = F.transform(F.split(text, r"[.!?]+[ \n\t\r]+"), lambda s: F.trim(s))
    return F.filter(sentences, lambda s: F.length(s).between(least, most) & F.rlike(s, F.lit(clue)))


def named(text: Column, rules: dict[str, str]) -> Column:
    """All names whose pattern is found, in the order of the rules."""
    return F.array_compact(F.array(*[F.when(F.rlike(text, F.lit(p)), F.lit(name)) for name, p in rules.items()]))


#: Days of one unit of a horizon.
UNITS = {"day": 1, "week": 7, "month": 30, "year": 365}
HORIZON = rf"([0-9]{{1,3}}) ({'|'.join(UNITS)})s?"


def horizon(text: Column) -> Column:
    """Days a question looks ahead or back ("3 weeks"); null where it names none."""
    number = F.nullif(F.regexp_extract(folded(text), HORIZON, 1), F.lit("")).try_cast("int")
    unit = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    return number * F.try_element_at(unit, F.regexp_extract(folded(text), HORIZON, 2))


def residual(text: Column, known: list[str]) -> Column:
    """Distinct words of a question that no rule has taken, in order."""
    words = F.array_distinct(F.split(folded(text), "[^a-z0-9]+"))
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(known))
