"""The registers as streams: first and last detection, new rows once, failure streaks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def first_seen(events: DataFrame, key: str, at: str) -> DataFrame:
    """A running register (complete or update mode): the first detection never moves later."""
    return events.groupBy(key).agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count("*").alias("n"))


def once(events: DataFrame, key: str, at: str, delay: str) -> DataFrame:
    """Each key once within the watermark, so the state stays bounded."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def by_window(events: DataFrame, key: str, at: str, width: str, delay: str) -> DataFrame:
    w = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).groupBy(F.window(at, width).alias("w"), key)
    return w.agg(F.count("*").alias("n")).select("w.start", "w.end", key, "n")


def two_times(items: DataFrame, published: str, detected: str, floor: str | None = None, late: int = 14) -> DataFrame:
    """Adds day (of publication, or of detection where that is missing), estimated, and counts_from: the detection, or
    ``late`` days after the publication where that was found later still. Items before ``floor`` are left out, not by the
    watermark but for good."""
    d = items.withColumn("day", F.coalesce(published, detected)).withColumn("estimated", F.col(published).isNull())
    d = d.withColumn("counts_from", F.least(detected, F.date_add("day", late)))
    return d.where(F.col("day") >= F.lit(floor).cast("date")) if floor else d


def lifecycle(events: DataFrame, key: str, at: str, days: int, delay: str) -> DataFrame:
    """(key, first_at, last_at, status): ``expected`` after each batch with a signal, ``expired`` once the watermark lies
    ``days`` days behind the last one; the key's state is then dropped. A first detection never moves later."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            first, last = state.get
            state.remove()
            yield pd.DataFrame({key: [k[0]], "first_at": [first], "last_at": [last], "status": ["expired"]})
            return
        first, last = state.get if state.exists else (None, None)
        for rows in frames:
            low, high = rows[at].min(), rows[at].max()
            first, last = min(x for x in (first, low) if x is not None), max(x for x in (last, high) if x is not None)
        state.update((first, last))
        due = int(pd.Timestamp(last).value // 1_000_000) + days * 86_400_000
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [k[0]], "first_at": [first], "last_at": [last], "status": ["expected"]})

    kind = dict(events.dtypes)[key]
    some = events.select(key, F.col(at).cast("timestamp").alias(at)).withWatermark(at, delay)
    return some.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, first_at timestamp, last_at timestamp, status string", "first_at timestamp, last_at timestamp", "update", GroupStateTimeout.EventTimeTimeout)


def streaks(events: DataFrame, key: str, at: str, failed: str) -> DataFrame:
    """(key, streak) after each batch: failures in a row up to the latest row."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else 0
        good, bad = None, pd.Series(dtype="datetime64[ns]")
        # only the failures behind the latest success so far are held
        for rows in frames:
            last = rows.loc[~rows[failed], at].max()
            good = last if good is None or (pd.notna(last) and last > good) else good
            bad = pd.concat([x for x in (bad, rows.loc[rows[failed], at]) if len(x)]) if len(bad) or rows[failed].any() else bad
            if pd.notna(good):
                bad = bad[bad > good]
        n = len(bad) if pd.notna(good) and good is not None else before + len(bad)
        state.update((n,))
        yield pd.DataFrame({key: [k[0]], "streak": [n]})

    some = events.select(key, at, failed)
    return some.groupBy(key).applyInPandasWithState(step, f"{key} {dict(events.dtypes)[key]}, streak long", "streak long", "update", GroupStateTimeout.NoTimeout)
