"""Each stage of the pipeline on its own input, against brute force."""

import sys
from pathlib import Path

import corpus_pipeline
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from test_llm import packed_right  # noqa: E402

from harrier.llm import queries  # noqa: E402


@pytest.fixture(scope="session")
def steps(spark, sf_dir, tmp_path_factory):
    """(docs, result) of every stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs, found = queries.table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        found[name] = (docs, after)
        docs = after
    return found


def pairs(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(steps):
    for name, (before, after) in steps.items():
        if name != "packing":
            assert after.columns == before.columns


def test_quality(steps):
    before, after = map(pairs, steps["quality"])
    assert set(after) <= set(before) and 0.5 * len(before) < len(after) < len(before)
    for _, t in after:
        n, *_, repeated = brute.quality_counts(t)
        assert n >= 50 and 100 * repeated <= 50 * n


def test_language_keeps_clean_text(steps):
    before, after = map(pairs, steps["language"])
    assert len(after) > 0.97 * len(before)


def test_near_duplicates(steps):
    before, after = map(pairs, steps["near_duplicates"])
    assert sorted(d for d, _ in after) == sorted({c for d, _, c in brute.components(before) if d == c})


def test_substring(steps):
    before, after = map(pairs, steps["substring"])
    told = {d: h for d, _, _, h in brute.repeats(before)}
    left = dict(after)
    for d, _ in before:
        assert brute.sha(" ".join(brute.words(left.get(d)))) == told[d]


def test_packing(steps):
    before, after = steps["packing"]
    assert packed_right(after.collect(), pairs(before)) > 0.95


def test_empty(spark, sf_dir, tmp_path):
    for t in ("documents", "labels"):
        queries.table(spark, sf_dir, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
