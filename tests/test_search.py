"""The index against BM25 over all rows, and the parts and sections of questions."""

import random

import pytest
from pyspark.sql import functions as F

from harrier.operators import postings, search


def documents(spark, n=600):
    rng = random.Random(2)
    # words by rank, a few in every document; long and short documents; copies; none at all
    rows = [(i, [f"w{min(int(rng.expovariate(0.05)), 300)}" for _ in range(rng.randint(3, 200))]) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(20)] + [(n + 50, []), (n + 51, None)]
    return spark.createDataFrame(rows, "id int, words array<string>").repartition(4)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "i")
    postings.build(documents(spark), "id", "words", path, segment=20, buckets=8)
    return postings.Index(spark, path, buckets=8)


@pytest.mark.parametrize("words", [["w1"], ["w250", "w3"], ["w0", "w1", "w2"], ["w299", "nowhere"], ["nowhere"]])
@pytest.mark.parametrize("top", [1, 10])
def test_index_gives_the_best_of_all(spark, index, words, top):
    want = [tuple(r) for r in search.bm25(documents(spark).na.fill({}), "id", "words", words, top).collect()]
    found, opened = index.search(words, top, first=2)
    assert sorted((r["key"], r["score"]) for r in found.collect()) == sorted(want)
    assert opened.count() <= index.bounds(words).count()


def test_blocks_stay_closed(spark, index):
    """Of the segments with a frequent word only some are opened, and bounds hold their best scores."""
    _, opened = index.search(["w0"], 3, first=2)
    assert 0 < opened.count() < index.bounds(["w0"]).count() / 2
    # of two words the bound adds up what may stand in different documents, so more are opened
    words = ["w0", "w1"]
    _, opened = index.search(words, 3, first=2)
    assert 0 < opened.count() < index.bounds(words).count()
    bound = {r["segment"]: r["bound"] for r in index.bounds(words).collect()}
    for s in list(bound)[:6]:
        best = index._scores(words, spark.createDataFrame([(s,)], "segment int")).agg({"score": "max"}).first()[0]
        assert best <= bound[s] + 1e-6


def test_empty_index(spark, tmp_path):
    path = str(tmp_path / "i")
    postings.build(documents(spark).limit(0), "id", "words", path)
    found, opened = postings.Index(spark, path).search(["w1"])
    assert found.count() == 0 and opened.count() == 0


ZONES, TOPICS = {"FR": r"\bfrance\b", "EU": r"\beurop\w*"}, {"toys": r"\btoys?\b"}
INTENTS = {"echeance": r"\bdeadlines?\b", "obligation": r"\bmust\b"}


def test_understood(spark):
    q = search.understood(spark, "Which deadlines for TOYS in Europe within 3 months, élevés 2024?", ZONES, TOPICS, INTENTS, ["for", "in", "which"])
    assert q == search.Question(["EU"], ["toys"], ["echeance"], 90, ["within", "eleves"])
    assert search.understood(spark, "", ZONES, TOPICS, INTENTS) == search.Question()


def test_sections_by_intent(spark):
    schema = "id int, kind string, zone string, codes array<string>, level string, essential boolean, fine boolean, status string, type string, day date, words array<string>"
    rows = [(i, k, "FR", ["toys"], "elevee", False, False, None, "proposition", None, ["a"] * (i % 4)) for i, k in enumerate(["article", "texte", "date", "alerte"] * 12)]
    docs = spark.createDataFrame(rows, schema)

    def order(**parts):
        rows = search.answer(docs, "id", "words", search.Question(**parts), "2024-01-31").orderBy("section", "place").collect()
        return list(dict.fromkeys(r["kind"] for r in rows)), len(rows)

    assert order(topics=["toys"], intents=["echeance"]) == (["date", "alerte", "texte", "article"], 28)
    assert order(topics=["toys"], intents=["obligation"]) == (["texte", "alerte", "date", "article"], 28)
    assert order(topics=["toys"], intents=["nouveau"]) == (["alerte", "texte", "date", "article"], 28)
    # without an intent the best kind comes behind the alerts
    assert order(topics=["toys"]) == (["alerte", "article", "texte", "date"], 28)
    assert order(words=["a"])[0][0] == "alerte" and order() == ([], 0)


def test_words_move_once(spark, tmp_path):
    """The build moves each document once, as its distinct words; blocks are made where a segment lies."""
    path, words = str(tmp_path / "i"), [["a"] * 400 + ["b"], ["b", "a", None], ["c"] * 3, [], None]
    rows = [(i % 300, words[i % 5]) for i in range(600)]  # each row twice
    docs = spark.createDataFrame(rows, "id int, words array<string>").repartition(4)
    said = {(r["key"], w["word"], w["tf"]) for r in postings._counted(docs.withColumnRenamed("id", "key")).collect() for w in r["said"]}
    assert said == {(i, w, (rows[i][1] or []).count(w)) for i in range(300) for w in set(rows[i][1] or [])}
    tracker = spark.sparkContext._jsc.sc().statusStore()

    def moved():
        stages = tracker.stageList(None, False, False, getattr(tracker, "stageList$default$4")(), getattr(tracker, "stageList$default$5")())
        seen = [stages.apply(i) for i in range(stages.size())]
        return {s.stageId(): s.shuffleWriteRecords() for s in seen}

    before = moved()
    postings.build(docs, "id", "words", path, segment=20, buckets=4)
    grown = [n for stage, n in moved().items() if stage not in before]
    # 360 documents with words move once; by posting it were 720 rows a shuffle, several times
    assert sum(grown) < 2 * len(rows)
    blocks = postings.Index(spark, path, buckets=4).blocks.select("segment", "word", "df", F.inline("postings")).collect()
    # a row that is repeated is one document with its words twice
    assert sorted((r["key"], str(r["word"]), r["tf"], r["len"]) for r in blocks) == sorted((k, str(w), 2 * n, len(rows[k][1])) for k, w, n in said)
    assert all(r["df"] <= 60 for r in blocks)


def test_long_documents_make_small_segments(spark):
    sized = spark.createDataFrame([(i, 5 if i < 3000 else 300_000) for i in range(3040)], "key int, len int")
    dealt = sized.join(postings._lengths(sized, 1024), "len").withColumn("segment", postings._segment(1024))
    sizes = dealt.groupBy("segment").agg(F.count("*").alias("n"), F.sum("len").alias("words")).collect()
    assert max(r["n"] for r in sizes) < 1200 and max(r["words"] for r in sizes) < 10 * postings.WORDS
    assert sum(r["n"] for r in sizes) == 3040
