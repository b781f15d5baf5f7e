"""Duplicate groups over several keys a row (a title in any of its languages), settled greedily in an order of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch


def greedy_groups(df: DataFrame, identity: str, source: str, keys: str, order: list[str]) -> DataFrame:
    """(identity, leader): the leader a row is a duplicate of, null for rows that stand for themselves.

    Rows are taken in order. A row with a key that belongs to a leader of another source is that one's duplicate (by its
    first such key) and owns nothing; another row owns those of its keys that nobody owns yet. Groups are not closed over
    chains. Distinct identities; null and repeated keys are passed over.

    Instead of row by row this runs in rounds over all rows: a row is settled as soon as every key of its that is still
    free has no earlier unsettled row. The first unsettled row always is, so the rounds end; there are as many as the longest
    chain of rows that wait for one another. Each round joins and combines by key, no key's rows are gathered.
    """
    scratch = Scratch(df.sparkSession)
    rows = scratch.write(df.select(F.col(identity).alias("id"), F.col(source).alias("src"), F.struct(*dict.fromkeys([*order, identity])).alias("o"), F.array_distinct(F.array_compact(keys)).alias("keys")))
    left = scratch.write(rows.select("id", "src", "o", F.posexplode("keys").alias("pos", "key")))
    owned = scratch.write(left.select("key", F.col("id").alias("leader"), F.col("src").alias("l_src")).limit(0))
    found = rows.select("id", F.lit(None).cast(df.schema[identity].dataType).alias("leader")).limit(0)
    while not left.isEmpty():
        before = [left, owned, found]
        told = scratch.write(left.join(owned, "key", "left").withColumn("foreign", F.col("leader").isNotNull() & ~F.col("src").eqNullSafe(F.col("l_src"))))
        bound = told.groupBy("id").agg(F.bool_or("foreign").alias("copy"))
        seen = known = scratch.write(told.join(bound, "id"))
        # copies own nothing, so no row waits for them; a copy itself waits for its keys in front of the one it knows of
        front = seen.where("leader is null and not copy").groupBy("key").agg(F.min("o").alias("first"))
        waits = seen.where("leader is null").join(front, "key").where(F.col("first") < F.col("o")).groupBy("id").agg(F.min("pos").alias("wait"))
        seen = seen.join(waits, "id", "left")
        settled = scratch.write(seen.groupBy("id", "copy", "wait").agg(F.min(F.when(F.col("foreign"), F.struct("pos", "leader"))).alias("best")))
        done = settled.where(F.when(F.col("copy"), F.col("wait").isNull() | (F.col("wait") > F.col("best.pos"))).otherwise(F.col("wait").isNull()))
        found = scratch.write(found.union(done.where("copy").select("id", F.col("best.leader").alias("leader"))))
        fresh = seen.where("leader is null").join(done.where("not copy").select("id"), "id", "left_semi")
        owned = scratch.write(owned.union(fresh.select("key", F.col("id").alias("leader"), F.col("src").alias("l_src"))))
        left = scratch.write(left.join(done.select("id"), "id", "left_anti").select("id", "src", "o", "pos", "key"))
        scratch.empty(*before, told, known, settled)
    out = scratch.write(rows.select(F.col("id").alias(identity)).join(found.withColumnRenamed("id", identity), identity, "left"))
    scratch.leave(out)
    return out


def copies(df: DataFrame, leaders: DataFrame, identity: str, source: str) -> DataFrame:
    """(identity, copies, sources): of each leader its duplicates and the sources they come from; ``leaders`` is
    ``greedy_groups`` of ``df``. A null source counts for none. Combined before the shuffle, so a hot leader is no long task."""
    led = leaders.where("leader is not null").join(df.select(identity, source), identity)
    return led.groupBy(F.col("leader").alias(identity)).agg(F.count("*").alias("copies"), F.countDistinct(source).alias("sources"))
