"""Transformations with state against the same in batch."""

import datetime as dt
import random

import pytest

from harrier.streaming import state


@pytest.fixture
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    yield state.with_state_store(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def fed(spark, path, schema, batches):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def drained(spark, df, name, mode, path):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", path).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None
    return spark.table(name).collect()


def test_seen_links_are_bounded(store, tmp_path):
    """Each link once; of an origin with more than three the oldest is forgotten, and is new when it comes again."""
    batches = [
        [("o", "a", "2024-01-01"), ("o", "b", "2024-01-02"), ("o", "a", "2024-01-03"), ("p", "a", "2024-01-01"), ("o", None, "2024-01-01")],
        [("o", "c", "2024-01-04"), ("o", "d", "2024-01-05"), ("o", "b", "2024-01-05"), ("p", "a", "2024-01-06")],
        [("o", "a", "2024-01-07"), ("o", "d", "2024-01-07")],
    ]
    live = fed(store, f"{tmp_path}/in", "origin string, link string, at string", batches)
    got = sorted((r["origin"], r["link"], str(r["at"].date())) for r in drained(store, state.unseen_links(live, "origin", "link", "at", 3), "links", "append", f"{tmp_path}/state"))
    assert got == [("o", "a", "2024-01-01"), ("o", "a", "2024-01-07"), ("o", "b", "2024-01-02"), ("o", "c", "2024-01-04"), ("o", "d", "2024-01-05"), ("p", "a", "2024-01-01")]


def test_topics_live_as_in_batch(store, tmp_path):
    rng, day = random.Random(7), dt.date(2024, 1, 1)
    rows = [(f"t{rng.randint(0, 25):02}", str(day + dt.timedelta(days=rng.randint(0, 240))), rng.choice(["signal", "signal", "opinion", "adopted"])) for _ in range(60)]
    rows += [("only opinion", "2024-02-01", "opinion"), ("only opinion", "2024-03-01", "adopted"), ("no signal", "2024-03-01", "adopted"), ("early", "2024-01-05", "adopted"), ("early", "2024-02-05", "signal"), ("quiet", "2024-01-02", "signal")]
    rows.sort(key=lambda r: r[1])
    ends = [("clock", "2024-12-01", "signal")], [("clock", "2025-02-20", "signal")], [("clock", "2025-02-21", "signal")]
    batches = [rows[i : i + 17] for i in range(0, len(rows), 17)] + list(ends)
    schema = "topic string, at string, kind string"
    live = fed(store, f"{tmp_path}/in", schema, batches)
    seen = drained(store, state.topic_lives(live, "0 days"), "topics", "update", f"{tmp_path}/state")
    last = {}
    for r in seen:
        # a topic's rows come in order; one that is gone may start again only with a new signal, of which there is none here
        last[r["topic"]] = (str(r["first_at"])[:10], str(r["last_at"])[:10], str(r["became_at"])[:10], r["status"])
    want = {r["topic"]: (str(r["first_at"])[:10], str(r["last_at"])[:10], str(r["became_at"])[:10], r["status"]) for r in state.topic_lives_batch(store.createDataFrame([x for b in batches for x in b], schema), "2025-02-21").collect()}
    assert set(last) == set(want) and "no signal" not in last
    assert last == want
    assert {x[3] for x in want.values()} >= {"expired", "closed", "expected"}
