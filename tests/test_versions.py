"""The register over runs against a plain loop, places of hot lists, as-of joins of hot keys, and themes in blocks."""

import datetime as dt
import random

from pyspark.sql import functions as F

from harrier.operators import ranks, relate, similarity, versions

DAY = dt.date(2024, 1, 1)
ARTICLE = "id long, text string, zone string, stage string, kind string, detected date, published date, version string"


def days(n):
    return DAY + dt.timedelta(days=n)


def brute(old, articles, known, run, today):
    groups = {}
    for a in articles:
        key = ("art", a[0]) if a[1] is None or a[4] == "a_qualifier" else ("txt", *a[1:4])
        groups.setdefault(key, []).append(a)
    out = {}
    for key, arts in groups.items():
        before = old.get(key)
        first = min([a[5] for a in arts] + ([before["first"]] if before else []))
        pubs = [a[6] for a in arts if a[6]]
        late = (min(pubs) if pubs else first) + dt.timedelta(days=14)
        latest = sorted(arts, key=lambda a: (a[6] or a[5], a[5], a[0]), reverse=True)[:6]
        version = before["version"] if before and before["version"] else min([a[7] for a in arts if a[7]], default=None)
        out[key] = {"first": first, "ends": min(first, late) + dt.timedelta(days=28), "n": len(arts), "version": version, "articles": [a[0] for a in latest]}
    for key, x in old.items():
        if key not in out and not set(x["articles"]) & known and x["ends"] >= today - dt.timedelta(days=730):
            out[key] = x
    return out


def test_runs_against_a_loop(spark, tmp_path):
    """Articles come, go with their source, or stay without being key points; runs are read back as of each."""
    rng = random.Random(3)
    store, old, told = versions.Store(spark, str(tmp_path / "r")), {}, {}
    pool = [(i, rng.choice(["t1", "t2", None]), rng.choice("ZY"), rng.choice("OF"), rng.choice(["adopte", "adopte", "a_qualifier"]), days(rng.randint(0, 60)), rng.choice([None, days(rng.randint(-60, 60))]), rng.choice([None, f"v{i % 7}"])) for i in range(60)]
    runs = [(f"2024-{k:02}", days(k * 15), None) for k in range(1, 6)] + [("2030-01", days(3000), None)]
    for run, today, _ in runs:
        seen = [a for a in pool if a[5] <= today and rng.random() < 0.8]
        known = {a[0] for a in pool if rng.random() < 0.6} | {a[0] for a in seen}
        args = spark.createDataFrame(seen, ARTICLE), spark.createDataFrame([(i,) for i in known], "id long"), run, str(today)
        store.run(*args)
        before = sorted(map(tuple, store.read().collect()), key=repr)
        old = told[run] = brute(old, seen, known, run, today)
        # the same run on its own output changes nothing
        store.run(*args)
        assert sorted(map(tuple, store.read().collect()), key=repr) == before
    for run in told:
        got = sorted(((r["first_at"], r["ends"], r["n"], r["version"], r["articles"]) for r in versions.as_of(store.read(), run).collect()), key=repr)
        assert got == sorted(((x["first"], x["ends"], x["n"], x["version"], x["articles"]) for x in told[run].values()), key=repr), run
    assert any(set(told[a]) - set(told[b]) for a in told for b in told if a < b)
    # an unfinished run leaves no trace
    spark.createDataFrame([], versions.SCHEMA).write.parquet(f"{store.path}/register-999999")
    assert versions.Store(spark, store.path).read().count() == store.read().count()


def test_places_of_a_hot_list(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i % 40}", rng.randint(0, 20), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(7)
    got = sorted((tuple(r) for r in ranks.placed(df, ["k"], [F.desc("v"), F.col("id")]).collect()), key=repr)
    lists = {}
    for k, v, i in rows:
        lists.setdefault(k, []).append((-v, i))
    want = [(k, -v, i, n) for k, x in lists.items() for n, (v, i) in enumerate(sorted(x), 1)]
    assert got == sorted(want, key=repr)
    assert ranks.placed(df.limit(0), ["k"], [F.col("id")]).count() == 0


def test_a_hot_list_lies_in_pieces(spark):
    from harrier.session import Scratch

    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.hash("id").alias("v"), "id")
    scratch = Scratch(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranks.dealt(df, ["k"], [F.col("v")], scratch).groupBy("_piece").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 8 and max(sizes) < 4 * sorted(sizes)[len(sizes) // 2]


def test_first_after_across_pieces(spark):
    rng = random.Random(6)
    asks = [(i, "hot" if i % 2 else f"k{i % 9}", rng.randint(0, 400)) for i in range(1500)]
    has = [("hot" if i % 3 else f"k{i % 9}", rng.randint(0, 400), i) for i in range(40)] + [("hot", 77, 100), ("hot", 77, 101)]
    left, right = spark.createDataFrame(asks, "id int, k string, t int"), spark.createDataFrame(has, "k string, at int, n int")
    got = {r["id"]: (r["at"], r["n"]) for r in relate.first_after(left, right, ["k"], "t", "at", ["n"]).collect()}
    want = {i: min(((a, n) for h, a, n in has if h == k and a >= t), default=(None, None)) for i, k, t in asks}
    assert got == want
    assert relate.first_after(left.limit(0), right, ["k"], "t", "at", ["n"]).count() == 0


def test_themes_in_blocks(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    phrases = [(f"t{rng.integers(0, 12):02}", float(rng.choice([0.5, 1.0, 1.2])), rng.normal(size=5).tolist()) for _ in range(90)]
    vectors = [(i, rng.normal(size=5).tolist()) for i in range(60)] + [(90, None), (91, [1.0])]
    v, p = spark.createDataFrame(vectors, "id int, v array<double>").repartition(3), spark.createDataFrame(phrases, "theme string, weight double, vector array<double>")
    want = {}
    for i, x in vectors:
        best = {}
        for t, w, y in phrases:
            if x and len(x) == 5:
                best[t] = max(best.get(t, -9), round(float(np.dot(x, np.array(y) * w)), 6))
        want[i] = [(s, t) for t, s in sorted(best.items(), key=lambda z: (-z[1], z[0]))[:2]]
    for block in (7, 4096):
        got = {r["id"]: [(b["score"], b["theme"]) for b in r["best"]] for r in similarity.best_themes(v, ["id"], "v", p, 2, block).collect()}
        assert got == want
    near = similarity.close_themes(similarity.best_themes(v, ["id"], "v", p), "id", 0.2)
    assert {(r["id"], r["theme"]) for r in near.collect()} == {(i, t) for i, x in want.items() for s, t in x if round(x[0][0] - s, 6) <= 0.2}


def test_keywords(spark):
    rows = [(0.5, True, True), (0.5, False, True), (0.5, False, False), (None, True, True), (None, True, False), (None, False, False)]
    df = spark.createDataFrame(rows, "s double, title boolean, text boolean")
    got = [r[0] for r in df.select(similarity.with_keywords(F.col("s"), F.col("title"), F.col("text"))).collect()]
    assert got == [0.58, 0.53, 0.5, 0.6, 0.45, 0.3]
