"""Predicates on what a text says, by tables of rules that are parameters: families of noise, signals, topics, places, numbered texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once, strip_marks


def flags(text: Column, rules: dict[str, str]) -> dict[str, Column]:
    """A boolean column for each rule: whether its pattern is found."""
    return {name: F.coalesce(F.rlike(text, F.lit(pattern)), F.lit(False)) for name, pattern in rules.items()}


def families(text: Column, rules: dict[str, str], strong: list[str]) -> Column:
    """(all, strong): the families of noise a text shows, and those of them that outweigh other signs."""
    held = F.array_compact(F.array(*[F.when(F.rlike(text, F.lit(p)), F.lit(name)) for name, p in rules.items()]))
    return F.struct(held.alias("all"), F.filter(held, lambda x: x.isin(strong)).alias("strong"))


def abroad(zone: Column, text: Column, europe: list[str], europe_named: str, elsewhere_named: str) -> Column:
    """Whether a text concerns places outside Europe alone: its source or its words are from elsewhere, Europe is not named."""
    return (~F.coalesce(zone.isin(europe), F.lit(False)) | F.rlike(text, F.lit(elsewhere_named))) & ~F.rlike(text, F.lit(europe_named))


#: Stems of the kinds of legal texts, and of the words for what an authority decides in a single case.
LEGAL = "law act regulation directive decree ordinance loi decret reglement ordonnance ley decreto reglamento legge regolamento gesetz verordnung richtlinie ustaw rozporzadz zakon wet lag forordning lov laki asetus torveny".split()
RULED = "decision deliberat resolution resolucion beschluss bescheid provvediment sanction amende fine order".split()
_KIND = rf"\b(?:{'|'.join(LEGAL)})\w{{0,4}}"
_YEAR = r"(?:19|20)\d\d\b"
#: What may stand between kind and number: bracketed letters and a word for "number".
_TO_NUMBER = r"\W*(?:\(\w+\)\W*)?(?:n\w{0,2}\W*)?"
_NUMBERED = rf"{_KIND}{_TO_NUMBER}\d{{1,5}}\s?[/-]\s?{_YEAR}"
_DATED = rf"{_KIND}\W+(?:\w{{1,4}}\W+){{1,2}}\d{{1,2}}\.?\s\w+\s{_YEAR}"


def numbered_text(c: Column, before: int = 40) -> Column:
    """Whether a text cites a law by number and year ("Act No. 12/2026") or by its day ("Loi du 3 mars 2026"). A citation with a
    word of an authority's ruling in it, or in the ``before`` characters in front, does not count; another one still does."""
    # each citation is put between two marks, so that the text is gone through once, and is then looked at with what is in front
    # of it; marks of the text's own become another control character
    t = F.translate(F.lower(strip_marks(c)), "\x01\x02", "\x03\x03")
    parts = F.split(F.regexp_replace(t, f"({_NUMBERED}|{_DATED})", "\x01$1\x02"), "\x02")
    cited = F.filter(parts, lambda x: F.contains(x, F.lit("\x01")))
    near = lambda x: F.concat(F.right(F.substring_index(x, "\x01", 1), F.lit(before)), F.substring_index(x, "\x01", -1))
    return F.exists(cited, lambda x: ~F.rlike(near(x), F.lit(rf"\b(?:{'|'.join(RULED)})")))


#: Names of official journals, and stems of "to publish".
JOURNALS = ["official journal", "journal officiel", "official gazette", "gazzetta ufficiale", "boletin oficial", "bundesgesetzblatt", "staatsblad", "dziennik ustaw", "diario da republica", "sbirka zakonu", "magyar kozlony"]
PUBLISH = "publi publik opublik veroffentlich pubblic parution kihirdet julkais".split()
_PUBLISH = rf"\b(?:{'|'.join(PUBLISH)})\w*"


def publication(near: Column, occasion: str) -> Column:
    """Whether the words around a date say that a legal text is published, and not that an event takes place: a journal is
    named, or a kind of text and "publish" stand at most eight words apart, whichever comes first."""
    # words and what parts them are never given back, as they cannot be cut elsewhere
    apart = r"(?:\W++\w++){0,8}\W++"
    between = F.lit(f"{_KIND}{apart}{_PUBLISH}|{_PUBLISH}{apart}{_KIND}")
    journal = lambda t: F.rlike(t, F.lit("|".join(JOURNALS)))
    return once(F.lower(strip_marks(near)), lambda t: (journal(t) | (F.rlike(t, F.lit("|".join(PUBLISH))) & F.rlike(t, between))) & ~F.rlike(t, F.lit(occasion)))


def concerned(sentences: Column, anchors: dict[str, str], near: Column, sure: float = 0.9, likely: float = 0.7) -> Column:
    """The kinds of actors a text is for: a sentence names one and the model is sure of that sentence, or likely of the text.

    ``sentences`` is an array of (sentence, probability); ``near`` the model's probability for the whole text.
    """

    def held(pattern: str) -> Column:
        return F.exists(sentences, lambda s: F.rlike(s["sentence"], F.lit(pattern)) & ((s["probability"] >= sure) | (near >= likely)))

    return F.array_compact(F.array(*[F.when(held(p), F.lit(name)) for name, p in anchors.items()]))


def best_rubric(text: Column, rules: list[tuple[str, str, int]], otherwise: str) -> Column:
    """The rubric whose keywords (rubric, pattern, weight) score most in a text; ties go to the one listed first."""
    names = list(dict.fromkeys(r for r, _, _ in rules))
    score = {n: sum((F.regexp_count(text, F.lit(p)) * w for r, p, w in rules if r == n), F.lit(0)) for n in names}
    best = F.array_max(F.array(*[F.struct(score[n].alias("score"), F.lit(-i).alias("back"), F.lit(n).alias("name")) for i, n in enumerate(names)]))
    return F.when(best["score"] > 0, best["name"]).otherwise(otherwise)


def best_chunk(text: Column, score, size: int = 600, step: int = 550) -> Column:
    """The greatest score of a text's overlapping parts, over the whole text; ``score`` maps a part to a number."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(step))
    return F.array_max(F.transform(starts, lambda i: score(F.substring(text, i, F.lit(size)))))
