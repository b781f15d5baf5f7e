"""The streams against the same register in batch, and the sources and sinks."""

from pyspark.sql import functions as F

from harrier.catalog import table
from harrier.sources import files
from harrier.streaming import registers


def run(spark, df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(60)
    return spark.table(name)


def stream(spark, sf_dir, tmp_path):
    table(spark, sf_dir, "events").limit(1000).repartition(3).write.parquet(f"{tmp_path}/in")
    batch = spark.read.parquet(f"{tmp_path}/in")
    return batch, spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


def test_first_seen(spark, sf_dir, tmp_path):
    batch, live = stream(spark, sf_dir, tmp_path)
    got = run(spark, registers.first_seen(live, "user_id", "ts"), "first_seen", "complete")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, registers.first_seen(batch, "user_id", "ts").collect()))


def test_once(spark, sf_dir, tmp_path):
    batch, live = stream(spark, sf_dir, tmp_path)
    got = run(spark, registers.once(live, "event_id", "ts", "60 days"), "once", "append")
    assert got.count() == batch.select("event_id").distinct().count()


def test_streaks(spark, sf_dir, tmp_path):
    """In files by time, so that batches come in order; the last row of each key counts."""
    events = table(spark, sf_dir, "events").where("user_id < 20").withColumn("failed", F.col("event_type").isin("error", "view", "click"))
    for i, day in enumerate(("2024-01-10", "2024-01-20", "2024-02-10")):
        low = ("2000-01-01", "2024-01-10", "2024-01-20")[i]
        events.where(f"ts >= '{low}' and ts < '{day}'").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    live = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = run(spark, registers.streaks(live, "user_id", "ts", "failed"), "streaks", "update")
    last = {}
    for r in events.orderBy("ts", "event_id").collect():
        last[r["user_id"]] = last.get(r["user_id"], 0) + 1 if r["failed"] else 0
    found = {}
    for r in got.collect():
        found.setdefault(r["user_id"], []).append(r["streak"])
    assert all(last[u] in n for u, n in found.items()) and set(found) == set(last)


def test_by_window(spark, sf_dir, tmp_path):
    batch, live = stream(spark, sf_dir, tmp_path)
    got = run(spark, registers.by_window(live, "event_type", "ts", "7 days", "60 days"), "by_window", "update")
    assert got.groupBy("start", "event_type").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0] == batch.count()


def test_lifecycle(spark, tmp_path):
    """A key without a signal for ten days expires when another one's moves the watermark on."""
    for i, rows in enumerate(([("a", "2024-01-01"), ("b", "2024-01-02")], [("a", "2024-01-03"), ("b", "2024-01-01")], [("b", "2024-02-01")], [("b", "2024-02-02")])):
        spark.createDataFrame(rows, "k string, at string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    live = spark.readStream.schema("k string, at string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = run(spark, registers.lifecycle(live, "k", "at", 10, "1 day"), "lifecycle", "update").collect()
    gone = [(r["k"], str(r["first_at"].date()), str(r["last_at"].date())) for r in got if r["status"] == "expired"]
    assert gone == [("a", "2024-01-01", "2024-01-03")]
    assert min(r["first_at"] for r in got if r["k"] == "b") == min(r["first_at"] for r in got if r["k"] == "b" and r["last_at"].month == 2)


def test_two_times(spark):
    items = spark.createDataFrame([(1, "2024-01-01", "2024-03-01"), (2, None, "2024-03-01"), (3, "2024-02-28", "2024-03-01"), (4, "2020-01-01", "2024-03-01")], "id int, p string, d string").select("id", F.col("p").cast("date").alias("p"), F.col("d").cast("date").alias("d"))
    got = {r["id"]: (str(r["day"]), r["estimated"], str(r["counts_from"])) for r in registers.two_times(items, "p", "d", "2023-01-01").collect()}
    assert got == {1: ("2024-01-01", False, "2024-01-15"), 2: ("2024-03-01", True, "2024-03-01"), 3: ("2024-02-28", False, "2024-03-01")}


def test_json(spark, tmp_path):
    assert files.read_json(spark, f"{tmp_path}/none", "id int").count() == 0
    (tmp_path / "j.json").write_text('{"id": 1}\nnot json\n')
    assert [r["id"] for r in files.read_json(spark, f"{tmp_path}/j.json", "id int").collect()] == [1]


def test_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    text = pages.select(files.main_text().alias("t"))
    assert text.where("t rlike '<script|<nav'").count() == 0
    assert files.read_links(pages).where(F.col("href").isNull()).count() == 0
