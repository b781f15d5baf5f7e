"""Places in sorted lists without a window over a whole list.

Rows are dealt by range of (keys, order), so that a list lies in pieces of neighbouring tasks, whatever its length. Each piece
is numbered on its own; what lies in front of a piece is a running sum over the pieces of its list, a row each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch


def dealt(df: DataFrame, keys: list[str], order: list[Column], scratch: Scratch) -> DataFrame:
    """df with ``_piece``: ranges of (keys, order), numbered in that order, as a table."""
    return scratch.write(df.repartitionByRange(*[F.asc(k) for k in keys], *order).withColumn("_piece", F.spark_partition_id()))


def same(keys: list[str], left: str, right: str) -> Column:
    """Equal keys and pieces; nulls are equal."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in [*keys, "_piece"]])


def placed(df: DataFrame, keys: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """Adds the place of each row, from 1, in the list of its keys. ``order`` ends with a unique column, else ties go anyhow."""
    scratch = Scratch(df.sparkSession)
    pieces = dealt(df, keys, order, scratch)
    size = pieces.groupBy(*keys, "_piece").agg(F.count("*").alias("_size"))
    in_front = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    front = size.withColumn("_front", F.coalesce(F.sum("_size").over(in_front), F.lit(0))).drop("_size")
    own = pieces.withColumn("_own", F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(*order)))
    both = own.alias("a").join(front.alias("b"), same(keys, "a", "b"))
    out = scratch.write(both.select(*[F.col(f"a.{c}") for c in df.columns], (F.col("_front") + F.col("_own")).cast("int").alias(name)))
    scratch.leave(out)
    return out
