"""Tables of pattern rules over whole texts in one pass: an automaton finds the rules that can hold, patterns confirm them.

Every match of a rule's pattern holds one of a few literal strings, which are read off the pattern. One Aho-Corasick automaton
over the literals of all rules scans a text once; only rules with a literal in the text are tried. Rules without a literal are
always tried. Rules that only match whole words are held against each distinct word instead, and what a word meets is kept
for the next texts. Texts are folded first: lower case, no marks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import folded


@dataclass(frozen=True)
class Rule:
    name: str
    family: str
    #: over folded text; ``\\b``, ``\\w`` and ``\\d`` are those of ASCII
    pattern: str
    weight: int = 1


def _alternatives(pattern: str) -> list[str]:
    """The alternatives of a pattern's top level."""
    out, depth, at, i = [], 0, 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif c == "[":
            i = pattern.index("]", i + 2)
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            out.append(pattern[at:i])
            at = i + 1
        i += 1
    return [*out, pattern[at:]]


def _longest(pattern: str) -> str:
    """The longest string that every match of an alternative holds; empty if that cannot be told."""
    best, run, i = "", "", 0

    def end() -> None:
        nonlocal best, run
        best, run = max(best, run, key=len), ""

    while i < len(pattern):
        c, size, literal = pattern[i], 1, None
        if c == "\\":
            size = 2
            literal = None if pattern[i + 1].isalnum() else pattern[i + 1]
            if pattern[i + 1] == "b":
                i += 2  # no character of its own
                continue
        elif c == "[":
            size = pattern.index("]", i + 2) - i + 1
        elif c == "(":
            depth, j = 1, i + 1
            while depth:
                j += 2 if pattern[j] == "\\" else 1
                depth += {"(": 1, ")": -1}.get(pattern[j - 1] if pattern[j - 2] != "\\" else "", 0)
            size = j - i
        elif c not in ".^$*+?{":
            literal = c
        after = pattern[i + size : i + size + 1]
        if literal is None or after in ("*", "?", "{"):
            end()
        else:
            run += literal
            if after == "+":
                end()
        i += size
        if after in ("*", "+", "?"):
            i += 1
        elif after == "{":
            i = pattern.index("}", i) + 1
    end()
    return best


def literals(pattern: str) -> list[str]:
    """Strings of which every match holds one; none if there are no such, as for patterns that look around."""
    if "(?" in pattern.replace("(?:", ""):
        return []
    found = [_longest(p) for p in _alternatives(pattern)]
    return sorted(set(found)) if all(len(x) > 1 for x in found) else []


_CLASS = r"\[(?:[a-z]-[a-z]|[A-Z]-[A-Z]|[0-9]-[0-9]|[A-Za-z0-9_])+\]"
_OF_WORDS = re.compile(rf"(?:[A-Za-z0-9_]|\\[wd]|{_CLASS}|\{{\d+(?:,\d*)?\}}|[*+?|)]|\(\?:)+")
_WORD = re.compile(r"\w+", re.ASCII)
#: Words whose rules are kept at a time, and the longest of them.
KEPT, LONGEST = 200_000, 64


def whole_word(pattern: str) -> str | None:
    """What stands between the two ends of a word in a pattern that matches one whole word and nothing else; None for others."""
    body = pattern.removeprefix(r"\b").removesuffix(r"\b")
    if pattern != rf"\b{body}\b" or not _OF_WORDS.fullmatch(body) or len(_alternatives(body)) > 1 or re.fullmatch(body, ""):
        return None
    return body


@dataclass
class RuleSet:
    rules: tuple[Rule, ...]
    _made: tuple | None = field(default=None, repr=False)
    _met: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"rules": self.rules, "_made": None, "_met": {}}

    def _tables(self):
        if self._made is None:
            import ahocorasick

            automaton, always, of, words = ahocorasick.Automaton(), [], {}, {}
            for i, r in enumerate(self.rules):
                body = whole_word(r.pattern)
                if body:
                    # by the first letter, where that is a letter of its own
                    first = body[0] if body[0].isalnum() and body[1:2] not in ("*", "?", "{") else ""
                    words.setdefault(first, []).append((i, re.compile(body, re.ASCII)))
                    continue
                some = literals(r.pattern)
                for s in some:
                    of.setdefault(s, []).append(i)
                if not some:
                    always.append(i)
            for s, which in of.items():
                automaton.add_word(s, tuple(which))
            if of:
                automaton.make_automaton()
            self._made = (automaton if of else None, always, [re.compile(r.pattern, re.ASCII) for r in self.rules], words)
        return self._made

    def _of_word(self, word: str) -> tuple[int, ...]:
        """The rules of whole words that a word meets."""
        met = self._met.get(word)
        if met is None:
            words = self._tables()[3]
            met = tuple(i for first in {"", word[0]} for i, p in words.get(first, ()) if p.fullmatch(word))
            if len(word) <= LONGEST:
                if len(self._met) >= KEPT:
                    self._met.clear()
                self._met[word] = met
        return met

    def hits(self, text: str) -> list[tuple[int, int]]:
        """(rule, matches) of the rules that hold in a folded text, in the order of the rules."""
        automaton, always, compiled, words = self._tables()
        maybe = set(always)
        if automaton is not None:
            for _, which in automaton.iter(text):
                maybe.update(which)
        found = Counter({i: sum(1 for _ in compiled[i].finditer(text)) for i in maybe})
        if words:
            for word, n in Counter(_WORD.findall(text)).items():
                for i in self._of_word(word):
                    found[i] += n
        return sorted((i, n) for i, n in found.items() if n)


def codes(docs: DataFrame, key: str, text: str | Column, rules: list[Rule]) -> DataFrame:
    """(key, codes, scores): of each document and family the names of the rules that hold, in their order, and the sum of
    weights times matches. Families without a rule that holds are left out; a null text has none."""
    known = RuleSet(tuple(rules))
    text = F.col(text) if isinstance(text, str) else text
    some = docs.select(F.col(key), folded(text).alias("_t"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, listed, summed = batch.column(1), [], []
            for i in range(batch.num_rows):
                names: dict[str, list[str]] = {}
                total: dict[str, int] = {}
                for k, n in known.hits(texts[i].as_py() or ""):
                    r = known.rules[k]
                    names.setdefault(r.family, []).append(r.name)
                    total[r.family] = total.get(r.family, 0) + n * r.weight
                listed.append(list(names.items()))
                summed.append(list(total.items()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(listed, pa.map_(pa.string(), pa.list_(pa.string()))), pa.array(summed, pa.map_(pa.string(), pa.int64()))], [key, "codes", "scores"]
            )

    return some.mapInArrow(run, f"{key} {kind}, codes map<string,array<string>>, scores map<string,bigint>")


def best_family(scores: Column, families: list[str], otherwise: str) -> Column:
    """The family with the highest score; ties go to the one listed first."""
    each = F.array(*[F.struct(F.coalesce(F.try_element_at(scores, F.lit(f)), F.lit(0)).alias("score"), F.lit(-i).alias("back"), F.lit(f).alias("family")) for i, f in enumerate(families)])
    best = F.array_max(each)
    return F.when(best["score"] > 0, best["family"]).otherwise(otherwise)
