"""Registers with their own state: the links seen of each origin, and the life of expected topics, as transformations with
state that is read key by key, bounded and timed. They need the RocksDB state store (``with_state_store``).

What they give over a drained stream is what a batch gives over the same rows: first detections never move later, promotions
and expiries come once each, and a link that was evicted counts as new again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Links remembered of an origin; days that a topic without a signal is kept, an opinion, and a promoted one.
SEEN, EXPECTED, OPINION, BECAME = 5_000, 365, 183, 28
_DAY = 86_400_000


def with_state_store(spark: SparkSession) -> SparkSession:
    """The session, set to the state store that these transformations need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def _ms(day: Any) -> int:
    return int(pd.Timestamp(day).value // 1_000_000)


class SeenLinks(StatefulProcessor):
    """Of each origin the links not seen before, each with the time it was first seen; of more than ``most`` the oldest are
    forgotten, by time and link, whenever a batch ends."""

    def __init__(self, most: int = SEEN):
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.links = handle.getMapState("links", "link string", "at timestamp")
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        for some in rows:
            some = some.dropna(subset=["link"]).sort_values(["at", "link"]).drop_duplicates("link")
            new = some[[not self.links.containsKey((x,)) for x in some["link"]]]
            for link, at in zip(new["link"], new["at"], strict=True):
                self.links.updateValue((link,), (at,))
            n += len(new)
            if len(new):
                yield pd.DataFrame({"origin": key[0], "link": new["link"].to_numpy(), "at": new["at"].to_numpy()})
        if n > self.most:
            held = sorted((v[0], k[0]) for k, v in self.links.iterator())
            for _, link in held[: n - self.most]:
                self.links.removeKey((link,))
            n = self.most
        self.count.update((n,))

    def close(self) -> None:
        pass


def unseen_links(items: DataFrame, origin: str, link: str, at: str, most: int = SEEN) -> DataFrame:
    """(origin, link, at): the stream's links that their origin has not shown among its last ``most``."""
    some = items.select(F.col(origin).alias("origin"), F.col(link).alias("link"), F.col(at).cast("timestamp").alias("at"))
    return some.groupBy("origin").transformWithStateInPandas(statefulProcessor=SeenLinks(most), outputStructType="origin string, link string, at timestamp", outputMode="Append", timeMode="None")


class Topics(StatefulProcessor):
    """The life of a topic: expected from its first signal, promoted by the first adoption that is not older than that, gone
    some time after the last signal or the promotion."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.life = handle.getValueState("life", "first timestamp, last timestamp, became timestamp, opinion boolean")
        # adoptions that came in front of any signal wait for one
        self.waiting = handle.getListState("waiting", "at timestamp")

    def _row(self, key: Any, status: str) -> pd.DataFrame:
        first, last, became, _ = self.life.get()
        stamp = lambda x: pd.Series([x], dtype="datetime64[us]")
        return pd.DataFrame({"topic": [key[0]], "first_at": stamp(first), "last_at": stamp(last), "became_at": stamp(became), "status": [status]})

    def _due(self) -> int:
        _, last, became, opinion = self.life.get()
        start, days = (became, BECAME) if became is not None else (last, OPINION if opinion else EXPECTED)
        # gone on the day after the last one it is kept
        return _ms(start) + (days + 1) * _DAY

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first, last, became, opinion = self.life.get() if self.life.exists() else (None, None, None, True)
        adopted = [x[0] for x in self.waiting.get()] if self.waiting.exists() else []
        seen = first is not None
        for some in rows:
            signals = some[some["kind"] != "adopted"]
            adopted += list(some.loc[some["kind"] == "adopted", "at"])
            if len(signals):
                low, high = signals["at"].min(), signals["at"].max()
                first, last = (low if first is None else min(first, low)), (high if last is None else max(last, high))
                # one signal that is more than an opinion makes it more for good
                opinion = bool(opinion) and bool((signals["kind"] == "opinion").all())
                seen = True
        if not seen:
            if adopted:
                self.waiting.put([(x,) for x in adopted])
            return
        if not opinion and became is None:
            became = min((x for x in adopted if x >= first), default=None)
        if became is None and adopted:
            self.waiting.put([(x,) for x in adopted])
        elif self.waiting.exists():
            self.waiting.clear()
        stamp = lambda x: None if x is None or pd.isna(x) else pd.Timestamp(x).to_pydatetime()
        self.life.update((stamp(first), stamp(last), stamp(became), opinion))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(max(self._due(), timerValues.getCurrentWatermarkInMs() + 1))
        yield self._row(key, "expected" if became is None else "became")

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if self.life.exists():
            yield self._row(key, "expired" if self.life.get()[2] is None else "closed")
            self.life.clear()

    def close(self) -> None:
        pass


TOPIC = "topic string, first_at timestamp, last_at timestamp, became_at timestamp, status string"


def topic_lives(events: DataFrame, delay: str) -> DataFrame:
    """(topic, first_at, last_at, became_at, status) after each batch that changes a topic, and when it goes. ``events`` has topic,
    at, kind: ``signal``, ``opinion`` or ``adopted``."""
    some = events.select("topic", F.col("at").cast("timestamp").alias("at"), "kind").withWatermark("at", delay)
    return some.groupBy("topic").transformWithStateInPandas(statefulProcessor=Topics(), outputStructType=TOPIC, outputMode="Update", timeMode="EventTime")


def topic_lives_batch(events: DataFrame, as_of: str) -> DataFrame:
    """The same from all events at once, as things stand on a day."""
    at, today = F.col("at").cast("timestamp"), F.lit(as_of).cast("timestamp")
    signal = F.col("kind") != "adopted"
    g = events.groupBy("topic").agg(F.min(F.when(signal, at)).alias("first_at"), F.max(F.when(signal, at)).alias("last_at"), F.bool_and(F.when(signal, F.col("kind") == "opinion")).alias("opinion"))
    adopted = events.where(~signal).select("topic", at.alias("adopted"))
    became = adopted.join(g.where("first_at is not null and not opinion").select("topic", "first_at"), "topic").where("adopted >= first_at").groupBy("topic").agg(F.min("adopted").alias("became_at"))
    lives = g.where("first_at is not null").join(became, "topic", "left")
    age = lambda c: F.datediff(today, c)
    kept = F.when(F.col("opinion"), OPINION).otherwise(EXPECTED)
    status = F.when(F.col("became_at").isNotNull(), F.when(age("became_at") > BECAME, "closed").otherwise("became")).when(age("last_at") > kept, "expired").otherwise("expected")
    return lives.select("topic", "first_at", "last_at", "became_at", status.alias("status"))
