"""A register of key points over runs, as intervals of runs that can be read as of any run.

A row holds a key point as it stood from one run up to another. A run takes what it sees now, merges it with what the last
run left, and closes and opens only what changed. Running it again on its own output, or on a later one, first takes back
what it and later runs did, so the result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alerts import ACTIVE, LATE

#: Fixed value: days that a key point without articles is kept behind its end.
KEPT = 730
STATE = "kind string, text string, zone string, first_at date, last_at date, published date, latest date, ends date, n long, version string, articles array<long>"
_NAMES = [x.strip().split(" ")[0] for x in STATE.split(", ")]
SCHEMA = f"id string, {STATE}, valid_from string, valid_to string"


def key_points(articles: DataFrame, id_: str = "id") -> DataFrame:
    """What a run sees: a key point for each text, zone and stage of ``articles`` (id, text, zone, stage, kind, detected,
    published, version); an article without a text stands alone. Columns: id and ``STATE``; no more than six articles are
    listed, the latest."""
    alone = F.col("text").isNull() | (F.col("kind") == "a_qualifier")
    named = F.concat_ws("|", F.lit("txt"), "text", "zone", "stage")
    a = articles.withColumn("_key", F.when(alone, F.concat(F.lit("art|"), F.col(id_).cast("string"))).otherwise(named))
    latest = F.struct(F.coalesce("published", "detected").alias("p"), "detected", F.col(id_).alias("i"))
    # the greatest six are combined before the shuffle, so a text with very many articles hands on six a task
    six = F.slice(F.reverse(F.array_sort(F.collect_list("_l"))), 1, 6)
    some = a.withColumn("_l", latest)
    g = some.groupBy("_key").agg(
        F.min_by("kind", F.struct("detected", id_)).alias("kind"), F.first("text").alias("text"), F.min("zone").alias("zone"), F.min("detected").alias("first_at"), F.max("detected").alias("last_at"),
        F.min("published").alias("published"), F.max("published").alias("latest"), F.count("*").alias("n"), F.min("version").alias("version"),
    )
    from .relate import first_per

    top = first_per(some.select("_key", "_l"), ["_key"], [F.desc("_l")], 6).groupBy("_key").agg(six.alias("_six"))
    g = g.join(top, "_key").withColumn("articles", F.transform("_six", lambda x: x["i"].cast("long")))
    g = g.withColumn("ends", _ends())
    return g.select(F.concat(F.lit("k"), F.substring(F.sha1("_key"), 1, 11)).alias("id"), *_NAMES)


def _ends():
    """28 days behind the first detection, or behind 14 days after the first publication where it was found late."""
    return F.date_add(F.least("first_at", F.date_add(F.coalesce("published", "first_at"), LATE)), ACTIVE)


def taken_back(register: DataFrame, run: str) -> DataFrame:
    """The register as it stood in front of a run."""
    before = register.where(F.col("valid_from") < run)
    return before.withColumn("valid_to", F.when(F.col("valid_to") < run, F.col("valid_to")))


def as_of(register: DataFrame, run: str) -> DataFrame:
    """The key points as a run left them."""
    held = (F.col("valid_from") <= run) & (F.col("valid_to").isNull() | (F.col("valid_to") > run))
    return register.where(held).drop("valid_from", "valid_to")


def advance(register: DataFrame, now: DataFrame, known: DataFrame, run: str, today: str) -> DataFrame:
    """The register after a run that sees ``now`` (``key_points``); ``known`` has the ids of all articles still known.

    A key point seen before keeps its first detection and its version. One seen no more vanishes if an article of its is still
    known, as that no longer makes it one; it survives if its articles are gone, until 730 days behind its end.
    """
    past = taken_back(register, run)
    open_ = past.where("valid_to is null")
    gone = open_.join(now.select("id"), "id", "left_anti")
    still = gone.select("id", F.explode("articles").alias("article")).join(known.select(F.col("id").cast("long").alias("article")), "article", "left_semi").select("id").distinct()
    survive = gone.join(still, "id", "left_anti").where(F.col("ends") >= F.date_sub(F.lit(today).cast("date"), KEPT)).select("id", *_NAMES)
    old = open_.select("id", F.col("first_at").alias("_first"), F.col("version").alias("_version"), F.col("published").alias("_published"))
    seen = now.join(old, "id", "left").withColumn("first_at", F.least("first_at", "_first")).withColumn("version", F.coalesce("_version", "version"))
    seen = seen.withColumn("ends", _ends()).select("id", *_NAMES)
    state = seen.unionByName(survive)
    # what did not change goes on; what changed or vanished is closed, and what changed or is new is opened
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in _NAMES]
    both = open_.alias("a").join(state.alias("b"), F.col("a.id") == F.col("b.id"), "full_outer")
    unchanged = F.coalesce(F.array_min(F.array(*same)), F.lit(False)) & F.col("a.id").isNotNull() & F.col("b.id").isNotNull()
    row = lambda side, start, stop: F.when(F.col(f"{side}.id").isNotNull(), F.struct(*[F.col(f"{side}.{c}").alias(c) for c in ("id", *_NAMES)], start.alias("valid_from"), stop.alias("valid_to")))
    none = F.lit(None).cast("string")
    goes_on = F.array(row("a", F.col("a.valid_from"), none))
    turns = F.array(row("a", F.col("a.valid_from"), F.lit(run)), row("b", F.lit(run), none))
    changed = both.select(F.explode(F.array_compact(F.when(unchanged, goes_on).otherwise(turns))).alias("r")).select("r.*")
    return past.where("valid_to is not null").unionByName(changed)


class Store:
    """A register in a folder: each run writes a table of its own, then a row of the manifest that names it. Readers follow the
    manifest, so a run that fails halfway leaves the last one in force."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.manifest = spark.createDataFrame([], "seq long, run string, name string")
        self.refresh()

    def refresh(self) -> None:
        try:
            self.manifest = self.spark.read.parquet(f"{self.path}/manifest")
            self.manifest.isEmpty()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise

    def read(self) -> DataFrame:
        last = self.manifest.agg(F.max_by("name", "seq")).first()[0]
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{last}") if last else self.spark.createDataFrame([], SCHEMA)

    def commit(self, register: DataFrame, run: str) -> None:
        seq = (self.manifest.agg(F.max("seq")).first()[0] or 0) + 1
        name = f"register-{seq:06}"
        register.select(*[x.split(" ")[0] for x in SCHEMA.split(", ")]).write.mode("overwrite").parquet(f"{self.path}/{name}")
        self.spark.createDataFrame([(seq, run, name)], "seq long, run string, name string").coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        self.refresh()

    def run(self, articles: DataFrame, known: DataFrame, run: str, today: str) -> DataFrame:
        """Take a run's articles into the register and give the key points it leaves."""
        self.commit(advance(self.read(), key_points(articles), known, run, today), run)
        return as_of(self.read(), run)
