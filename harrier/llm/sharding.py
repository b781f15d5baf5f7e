"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, with DataFrame functions only.

The ring has a fixed number of slots; each shard owns the arcs that end at its virtual nodes. A key belongs to the slot of
its hash and to the arc that slot lies in. Every shard has a capacity in rows, and keys that find their shard full go on
clockwise to the next virtual node whose shard has room. What moves is decided from the number of keys of each arc alone,
which is bounded by the ring, so the driver sees shards x virtual nodes counts and no rows.

A key is a row's doc_id with the size and checksum of its text, so rows without an id spread over the ring as well. A slot
with many more rows than others (rows repeated whole) is split into parts, so that no window holds it.

With no slack the capacities add up to the number of rows, so every shard ends exactly full: counts are at most one
apart, whatever the keys (law ``rows``).

Defined cases: a null text has no bytes and the checksum of the empty text. Rows with null doc_id are placed by their text, repeated rows
each. A very long text is one row of its size, larger than the others' as it is. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, plain

SLOTS = 1 << 16
#: Rows of one part of a slot, at least; above, also a few times the mean of all slots.
PART = 20_000


def ring(shards: int, nodes: int = 64, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(slot, shard) of the virtual nodes, clockwise; of nodes that fall in one slot the lowest shard's counts."""
    found: dict[int, int] = {}
    for s in range(shards):
        for v in range(nodes):
            at = int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % slots
            found[at] = min(s, found.get(at, s))
    return sorted(found.items())


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows each shard may hold: equal, the first ones one more; with slack so much more."""
    if slack:
        return [-(-int(rows * (1 + slack)) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def flows(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Where the keys of each arc go: (arc, shard, first rank, last rank + 1, first place in the shard).

    First every arc's keys go to its owner, clockwise, as far as there is room. Then what is left of each arc goes on from
    virtual node to virtual node. The lowest ranks of an arc stay at home.
    """
    room, used, done = list(room), [0] * len(room), [0] * len(counts)
    out = []
    for step in range(len(counts)):
        for arc, n in enumerate(counts):
            shard = owners[(arc + step) % len(counts)]
            take = min(n - done[arc], room[shard])
            if take > 0:
                out.append((arc, shard, done[arc], done[arc] + take, used[shard]))
                done[arc] += take
                used[shard] += take
                room[shard] -= take
        if done == list(counts):
            break
    return out


def shard(docs: DataFrame, shards: int = 8, nodes: int = 64, slack: float = 0.0) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    # a table of literals: LocalTableScan, no Python behind it
    table = lambda names, found: spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, found))} AS t({names})")
    points = ring(shards, nodes)
    arcs = [(i, (points[i - 1][0] + 1) if i else 0, p) for i, (p, _) in enumerate(points)]
    # slots behind the last node belong to the first one's arc, in front of slot 0
    spans = [(a, lo, hi, 1) for a, lo, hi in arcs] + ([(0, points[-1][0] + 1, SLOTS - 1, 0)] if points[-1][0] < SLOTS - 1 else [])
    slots = table("arc, lo, hi, turn", spans).select("arc", "turn", F.explode(F.sequence("lo", "hi")).alias("ring_slot"))

    text = F.coalesce("text", F.lit(""))
    found = plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    found = found.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"))
    # written, so that every pass sees a row under the same number
    found = Scratch(spark).write(found.withColumn("ring_slot", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(SLOTS)).cast("int")))
    by_slot = found.groupBy("ring_slot").agg(F.count("*").alias("n"))  # SLOTS rows
    part_rows = F.greatest(F.lit(PART), F.ceil(F.sum("n").over(Window.partitionBy()) / SLOTS * 4))
    hot = by_slot.withColumn("parts", F.ceil(F.col("n") / part_rows)).where("parts > 1").select("ring_slot", "parts")
    found = found.join(F.broadcast(hot), "ring_slot", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0)).cast("int"))
    by_part = found.groupBy("ring_slot", "part").agg(F.count("*").alias("n")).join(F.broadcast(slots), "ring_slot")  # at most 2 * SLOTS rows
    clockwise = Window.partitionBy("arc").orderBy("turn", "ring_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select("ring_slot", "part", "arc", F.coalesce(F.sum("n").over(clockwise), F.lit(0)).alias("before"), "n")
    counted = {r["arc"]: r["n"] for r in by_part.groupBy("arc").agg(F.sum("n").alias("n")).collect()}  # an arc each
    counts = [counted.get(i, 0) for i in range(len(points))]
    moved = flows(counts, [s for _, s in points], capacities(sum(counts), shards, slack))
    moved = table("arc, shard, first, last, place", moved or [(-1, 0, 0, 0, 0)])

    nth = Window.partitionBy("ring_slot", "part").orderBy(F.xxhash64("doc_id"), "doc_id", "size", "text_crc32", "row")
    rows = found.withColumn("nth", F.row_number().over(nth) - 1).join(F.broadcast(by_part.drop("n")), ["ring_slot", "part"])
    rows = rows.withColumn("rank", F.col("before") + F.col("nth"))
    rows = rows.join(F.broadcast(moved), (rows["arc"] == moved["arc"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows" if not slack else "bounded").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("place") + F.col("rank") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
