"""Joins and windows: latest row per key, array containment, first match in a range, register merge, top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .ranks import dealt, same


def first_per(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank: str = "rank_in_group") -> DataFrame:
    """The first ``n`` rows of each key; Spark limits each partition's groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def contains_join(holders: DataFrame, array: str, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``holders`` for each key of ``wanted`` their array holds, once."""
    one = holders.withColumn(array, F.array_distinct(array)).withColumn(key, F.explode(array))
    return one.join(wanted, key)


def first_after(left: DataFrame, right: DataFrame, keys: list[str], start: str, at: str, tie: list[str]) -> DataFrame:
    """For each left row the first right row of its keys that is not before ``start``; none: nulls.

    Both sides are dealt by range of keys and time, backwards, so that a hot key lies in pieces of several tasks. In a piece
    each row is matched by an ordered window; what a piece's first rows find in later pieces is carried over to it by a
    second pass over one row a piece. Each row moves twice, and no key's rows are gathered in a task.
    """
    names = [c for c in right.columns if c not in keys]
    asks = left.select(*keys, F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.struct(*left.columns).alias("_ask"))
    has = right.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(at, *tie, *[n for n in names if n not in (at, *tie)]).alias("_has"))
    back = [F.desc("_at"), F.desc("_kind"), F.desc("_has")]
    scratch = Scratch(left.sparkSession)
    pieces = dealt(asks.unionByName(has, allowMissingColumns=True), keys, back, scratch)
    upto = Window.partitionBy(*keys, "_piece").orderBy(*back).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = pieces.withColumn("_own", F.last("_has", ignorenulls=True).over(upto)).where("_kind = 0")
    last = pieces.groupBy(*keys, "_piece").agg(F.min("_has").alias("_last"))
    later = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("_carried", F.last("_last", ignorenulls=True).over(later)).where("_carried is not null").select(*keys, "_piece", "_carried")
    found = own.alias("a").join(carried.alias("b"), same(keys, "a", "b"), "left").withColumn("_first", F.coalesce("_own", "_carried"))
    out = scratch.write(found.select("_ask.*", *[F.col(f"_first.{n}").alias(n) for n in names]))
    scratch.leave(out)
    return out


def merge_register(old: DataFrame, new: DataFrame, key: str, first: str, last: str, count: str) -> DataFrame:
    """Full outer merge: earliest first, latest last, counts added; rows of one side stay."""
    a, b = old.alias("a"), new.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    pick = lambda f, c: f(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c)
    added = (F.coalesce(f"a.{count}", F.lit(0)) + F.coalesce(f"b.{count}", F.lit(0))).alias(count)
    origin = F.when(F.col(f"a.{key}").isNull(), "new").when(F.col(f"b.{key}").isNull(), "kept").otherwise("updated")
    return both.select(pick(F.coalesce, key), pick(F.least, first), pick(F.greatest, last), added, origin.alias("origin"))


def group_breaks(df: DataFrame, group: Column, order: list[Column], within: str) -> DataFrame:
    """Marks each row that opens a new group in the sorted list of ``within``."""
    w = Window.partitionBy(within).orderBy(*order)
    return df.withColumn("opens", F.coalesce(F.lag(group).over(w) != group, F.lit(True)))
