"""Spelling variants against wildcards of every place."""

import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from brute import lowered  # noqa: E402

from harrier.llm import queries, spelling  # noqa: E402

NAMES = ["word", "form", "root", "n", "n_near", "form_n"]


def counts(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return found


def brute(found, least=2, times=10):
    n = {w: c for w, c in found.items() if c >= least}
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            if short in n:
                near[w].add(short)
                near[short].add(w)
            holes[w[:i], w[i + 1 :]].add(w)
    for some in holes.values():
        for w in some:
            near[w] |= some - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= times * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=repr)


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    want = brute(counts(docs))
    assert got(queries.queries()["op12_spelling_variants"](spark, sf_dir)) == want
    assert sum(r[1] is not None for r in want) > 20 and max(r[4] for r in want) > 2


def some_words(seed, n, alphabet="abcdé"):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(alphabet) for _ in range(rng.randint(7, 14))) for _ in range(n // 8)]
    found = {}
    for s in stems:
        found[s] = rng.choice([2, 30, 400, 5000])
        for _ in range(7):
            w, i = s, rng.randrange(len(s))
            kind = rng.randrange(4)
            w = [w[:i] + w[i + 1 :], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + rng.choice(alphabet) + w[i + 1 :], w[:i] + w[i + 1 :] + "a"][kind]
            if len(w) >= 7:
                found[w] = rng.choice([1, 2, 3, 20, 400])
    return found


@pytest.mark.parametrize("block", [2, 5, 128])
def test_blocks_are_subdivided(spark, block):
    """Long shared beginnings and ends, runs of a letter, and blocks of all sizes down to one open letter."""
    found = some_words(1, 800) | {"commonbeginning" + w: c for w, c in some_words(2, 400).items()} | {w + "commonending": c for w, c in some_words(3, 400).items()}
    found |= {"a" * k: 10**k for k in range(7, 13)} | {"aaab" * 4 + "c" * k: 3 for k in range(9)}
    found |= {"qqqqqq" + chr(c) + "wwwwww": 2 + c for c in range(97, 123)} | {"qqqqqqwwwwww": 100_000}
    words = spark.createDataFrame(list(found.items()), "word string, n long").repartition(6)
    # a block of one open letter may hold the whole alphabet, whatever the bound
    assert got(spelling.variants(words, block=block)) == brute(found)


def test_odd_documents(spark):
    long_run = "x" * 30_000
    docs = [
        (1, None), (2, ""), (3, "short words only"), (4, "Letters letters LETTERS Éclairs éclairs"), (4, "Letters letters LETTERS Éclairs éclairs"), (None, "letters lettters nameless nameless"),
        (5, long_run + " " + long_run + "y " + long_run), (6, long_run + "y"), (7, "lettersx " * 5000), (8, "naïveté×÷ naïveté×÷ l'éclairs été_letters9letters"), (9, "letters\n" * 300),
    ]
    df = spark.createDataFrame([(d, t, "w", 1, 0, "f") for d, t in docs], "doc_id long, text string, word string, n long, total int, fixed string").repartition(3)
    assert got(spelling.variants(spelling.word_counts(df))) == brute(counts(docs))
    assert got(spelling.variants(spelling.word_counts(df.where("false")))) == []


def test_texts_are_cut_between_runs(spark, monkeypatch):
    docs = [(i, " ".join(some_words(i, 80))) for i in range(30)]
    want = sorted(counts(docs).items())
    monkeypatch.setattr(spelling, "_SLICE", 20)
    monkeypatch.setattr(spelling, "_HELD", 50)
    assert sorted(map(tuple, spelling.word_counts(spark.createDataFrame(docs, "doc_id long, text string")).collect())) == want
