"""Rules that match whole words are held against distinct words, with the counts that their patterns give."""

import re

from harrier.operators import rules


def test_rules_of_whole_words():
    told = {r"\bco(?:de|py)\b": True, r"licen[sc]e": False, r"\bthe \w+\b": False, r"\b[a-z]{9,}\b": True, r"\bab|cd\b": False, r"\bl?es\b": True, r"\b[a-z]*\b": False, r"\b[^a]b\b": False}
    assert [rules.whole_word(p) is not None for p in told] == list(told.values())
    known = rules.RuleSet(tuple(rules.Rule(p, "x", p) for p in told))
    for text in ("", "code copy the codes, licence es les\u00e9 ab cd abc xcd administration code_ code", "\u00f3es es"):
        assert known.hits(text) == [(i, n) for i, p in enumerate(told) if (n := sum(1 for _ in re.finditer(p, text, re.ASCII)))]
