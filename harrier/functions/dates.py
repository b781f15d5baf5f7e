"""Dates written in a text, and those that stand in a sentence about a deadline, as Column expressions.

A written date is a row of parts: Y a year, M a month's number, D a day, N a month's name. ``FORMS`` lists the orders of
parts with what stands between them; the patterns are made from them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import MONTHS, folded

_NAMES = {w: n for n, names in MONTHS.items() for w in names.split()}
_PARTS = {"Y": r"(\d{4})", "M": r"(\d{1,2})", "D": r"(\d{1,2})", "N": "(" + "|".join(_NAMES) + ")"}
#: What may follow a day's number, a month's name, and stand between parts.
_ORDINAL, _DOT, _OF = "(?:er|st|nd|rd|th|[.])?", "[.]?", " (?:de |of )?"
FORMS = [
    ["Y", "-", "M", "-", "D"],
    ["D", "[./]", "M", "[./]", "Y"],
    ["D", _ORDINAL + _OF, "N", _DOT + _OF, "Y"],
    ["N", _DOT + " ", "D", _ORDINAL + ",? ", "Y"],
    ["N", _DOT + _OF, "Y"],
]
#: Words of an obligation, of an occasion, and of an obligation that no occasion outweighs.
OBLIGATION = r"\b(deadline|must|shall|due|comply|applies from|no later than|au plus tard|doivent|frist|spatestens)\b"
OCCASION = r"\b(webinar|conference|workshop|event|consultation|hearing|seminar|colloque|webinaire)\b"
STRONG = r"\b(must comply|no later than|au plus tard|spatestens|enters into force)\b"


def _pattern(form: list[str]) -> str:
    return "".join(_PARTS.get(x, x) for x in form)


_LETTERS = sorted({w[0] for w in _NAMES})
#: What a date begins with, a digit or the first three letters of a month's name, told by the first one: most places are passed over by it.
_START = "(?=[0-9]|" + "|".join(f"{a}(?:{'|'.join(sorted({w[1:3] for w in _NAMES if w[0] == a}))})" for a in _LETTERS) + ")"
#: One pass over the text; at each place the fuller form is tried first, so spans never overlap.
_ANY = f"(?<![0-9a-z]){_START}(?:" + "|".join(map(_pattern, FORMS)) + ")(?![0-9a-z])"


def _day(span: Column, form: list[str]) -> Column:
    """The day a span of this form names, the first of the month where no day is written; null if there is none such."""
    parts = [x for x in form if x in _PARTS]
    part = {x: F.regexp_extract(span, f"^{_pattern(form)}$", i) for i, x in enumerate(parts, 1)}
    month = part["M"] if "M" in part else F.try_element_at(F.create_map(*[F.lit(x) for pair in _NAMES.items() for x in pair]), part["N"]).cast("string")
    return F.try_to_date(F.concat_ws("-", part["Y"], F.lpad(month, 2, "0"), F.lpad(part.get("D", F.lit("1")), 2, "0")), "yyyy-MM-dd")


def all_dates(c: Column) -> Column:
    """Array of (day, approx) in the text's order; approx if only the month is written. Impossible days are left out."""

    def one(span: Column) -> Column:
        told = [(F.rlike(span, F.lit(f"^{_pattern(f)}$")), _day(span, f), "D" not in f) for f in FORMS]
        day = F.coalesce(*[F.when(is_form, day) for is_form, day, _ in told])
        loose = F.coalesce(*[F.when(is_form, F.lit(rough)) for is_form, _, rough in told])
        return F.struct(day.alias("day"), loose.alias("approx"))

    spans = F.regexp_extract_all(folded(c), F.lit(_ANY), F.lit(0))
    return F.filter(F.transform(spans, one), lambda d: d["day"].isNotNull())


def first_date(c: Column, as_of: str) -> Column:
    """The first full date of the first form that gives one; none before 2000 or after the day behind ``as_of``."""
    spans = [(F.regexp_extract(folded(c), f"(?<![0-9a-z]){_pattern(f)}(?![0-9a-z])", 0), f) for f in FORMS if "D" in f]
    found = F.coalesce(*[_day(span, f) for span, f in spans])
    return F.when((found >= F.lit("2000-01-01").cast("date")) & (found <= F.date_add(F.lit(as_of).cast("date"), 1)), found)


def deadlines(c: Column) -> Column:
    """The dates of sentences that speak of an obligation and not of an occasion, unless in strong words."""
    sentences = F.split(folded(c), r"(?<=[.!?;])\s+(?=\S)|\n+")
    binding = F.filter(
        sentences,
        lambda s: (F.rlike(s, F.lit(OBLIGATION)) & ~F.rlike(s, F.lit(OCCASION))) | F.rlike(s, F.lit(STRONG)),
    )
    return F.flatten(F.transform(binding, all_dates))


#: Characters before and behind a date in which an obligation binds it.
BEFORE, BEHIND = 110, 60
_DUTIES = OBLIGATION.removeprefix(r"\b(").removesuffix(r")\b").split("|")
#: A date comes first, so that what stands before and behind is looked at beside dates only.
_NEAR = (
    f"(?s)(?={_ANY})(?:(?<=(?:{'|'.join(rf'{w}.{{0,{BEFORE - len(w)}}}' for w in _DUTIES)}))"
    f"|(?=(?>{_ANY})(?:{'|'.join(rf'.{{0,{BEHIND - len(w)}}}{w}' for w in _DUTIES)})))(?>{_ANY})"
)


def near_deadlines(c: Column, own_day: Column, as_of: str, back: int = 45, ahead: int = 3 * 365, most: int = 4) -> Column:
    """The full dates with an obligation near, in whatever sentence, and not in a sentence on an occasion unless that has
    strong words; within a span around ``as_of``, other than the text's own day; future ones first, ``most`` at most."""
    t = folded(c)
    # digits of other sentences are blanked, so that their dates go and distances stay; one without digits has none to blank
    sentences = F.transform(
        F.split(t, r"(?<=[.!?;])(?=\s)|(?<=\n)"),
        lambda s: F.when(F.rlike(s, F.lit("[0-9]")) & F.rlike(s, F.lit(OCCASION)) & ~F.rlike(s, F.lit(STRONG)), F.translate(s, "0123456789", "##########")).otherwise(s),
    )
    spans = F.regexp_extract_all(F.array_join(sentences, ""), F.lit(_NEAR), F.lit(0))
    found = F.filter(F.flatten(F.transform(spans, all_dates)), lambda d: ~d["approx"])
    today = F.lit(as_of).cast("date")
    days = F.filter(F.transform(found, lambda d: d["day"]), lambda d: d.between(F.date_sub(today, back), F.date_add(today, ahead)) & ~F.coalesce(d == own_day, F.lit(False)))
    return upcoming(days, as_of, most)


def upcoming(days: Column, as_of: str, most: int = 4) -> Column:
    """Of an array of days the future ones first, then by date, ``most`` at most."""
    today = F.lit(as_of).cast("date")
    keyed = F.transform(F.array_distinct(days), lambda d: F.struct((d < today).alias("past"), d.alias("day")))
    return F.slice(F.transform(F.array_sort(keyed), lambda x: x["day"]), 1, most)
