"""Lists of a report: sections, queues, joins on either of two keys, months without rows, hot and cold rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sections(df: DataFrame, kind: str, order: list[Column], sizes: dict[str, int], otherwise: int = 5) -> DataFrame:
    """The first rows of each section, as many as ``sizes`` says for its kind."""
    size = F.coalesce(*[F.when(F.col(kind) == k, F.lit(n)) for k, n in sizes.items()], F.lit(otherwise))
    place = F.row_number().over(Window.partitionBy(kind).orderBy(*order))
    # the constant bound lets Spark keep each partition's best rows before the shuffle
    found = df.withColumn("place", place).where(F.col("place") <= max(otherwise, *sizes.values()))
    return found.where(F.col("place") <= size)


def queue(df: DataFrame, wanted: Column, order: list[Column], budget: int) -> DataFrame:
    """The rows a run has the budget for, most urgent first; what is left is found again by the next run."""
    return df.where(wanted).orderBy(*order).limit(budget)


def either_join(left: DataFrame, right: DataFrame, keys: list[str], zone: str, ids: list[str]) -> DataFrame:
    """Pairs of ``ids`` that agree on the zone and on any one of ``keys``: an equality join for each key, each pair once."""
    found = [left.join(right, [zone, k]).select(*ids) for k in keys]
    both = found[0]
    for more in found[1:]:
        both = both.union(more)
    return both.distinct()


def by_month(df: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """(month, n) for every month of the span, those without a row too. The span's months are the broadcast side."""
    months = df.sparkSession.range(1).select(F.explode(F.expr(f"sequence(date'{first}', date'{last}', interval 1 month)")).alias("month"))
    counted = df.groupBy(F.trunc(day, "month").alias("month")).agg(F.count("*").alias("n"))
    return months.join(counted, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("n"))


def latest_example(df: DataFrame, key: str, example: str, order: list[str]) -> DataFrame:
    """(key, n, example): how many rows, and the last one's example."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.max_by(example, F.struct(*order)).alias("example"))


def appended(loaded: DataFrame, archive: DataFrame, key: str) -> DataFrame:
    """The loaded rows and those of the archive that are not loaded yet."""
    return loaded.unionByName(archive.join(loaded.select(key), key, "left_anti"))


def ranked_runs(df: DataFrame, run: str) -> DataFrame:
    """Adds rank: the place of the row's run among all runs. Only the runs themselves, a row each, are ordered."""
    runs = df.select(run).distinct()
    return df.join(runs.withColumn("rank", F.dense_rank().over(Window.orderBy(run))), run)


def hot(df: DataFrame, key: str, day: str, base: Column, active: DataFrame, as_of: str, days: int = 183) -> DataFrame:
    """Adds hot: rows of the last ``days``, of the base, or that ``active`` names; the others belong to the archive."""
    held = active.select(key, F.lit(True).alias("_active")).distinct()
    recent = F.col(day) >= F.date_sub(F.lit(as_of).cast("date"), days)
    return df.join(held, key, "left").withColumn("hot", F.coalesce(recent | base | F.col("_active"), F.coalesce(recent, F.lit(False)) | F.coalesce(base, F.lit(False)))).drop("_active")
