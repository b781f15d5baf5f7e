"""Document fingerprints: a threshold-scaled sketch.

Every five-word shingle hash below a fixed fraction of the hash range is retained. Sketches of any two texts, or of
unions of texts, compare without regard to their lengths: the same shingle is kept in all or in none. A retained hash is
cut to its first 40 bits. The printed form is ``<fraction>:<key>:<shingles>:<retained hashes>``, hex but for the hashes, which
are base 64 of five bytes each; the key of the whole shingle set tells equal sets apart from sets whose sketches happen to be
equal or empty.

Likeness is an estimate without bias: of two sets with u shingles in all and similarity j its standard deviation is
about ``sqrt(j (1 - j) (fraction - 1) / u)``, so 0.05 at most for u = 100 and 0.016 for u = 1000. Of sets of a few shingles it says
little, but that equal sets are equal. The key of a union is that of the keys of its different parts, so
unions of the same texts are alike in any order. Sketches of two fractions are compared at the smaller one.

Defined cases: a null or empty text has no shingle; two such are alike (1). Texts with fewer than five words are one
shingle. Rows go in descending doc_id, then by the text's hash; null doc_ids come last. A single row is its own next one.
Rows that repeat doc_id and text follow one another. Very long texts are taken whole. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import xor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain, rows, set_key, shingle_set, utf8

FRACTION = 2
#: Bits of a retained hash.
BITS = 40
#: Ranges of ids at most: a bound on the heads every task is given.
RANGES = 65_536


def _packed(kept: np.ndarray) -> str:
    return base64.b64encode(kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes()).decode()


def _unpacked(printed: str) -> np.ndarray:
    some = np.frombuffer(base64.b64decode(printed), np.uint8).reshape(-1, BITS // 8)
    return np.pad(some, ((0, 0), (8 - BITS // 8, 0))).reshape(-1).view(">u8").astype(np.uint64)


@dataclass
class Sketch:
    key: int
    n: int
    kept: np.ndarray
    fraction: int = FRACTION
    #: keys of the texts a union was made of; their xor is its key
    parts: frozenset[int] = frozenset()

    @classmethod
    def of(cls, text: str | None, fraction: int = FRACTION) -> Sketch:
        t = shingle_set(utf8(text).lower())
        key = set_key(t) & ((1 << 64) - 1)
        kept = np.unique(t[t < np.uint64((1 << 64) // fraction)] >> np.uint64(64 - BITS))
        return cls(key, len(t), kept, fraction, frozenset([key]))

    def __str__(self) -> str:
        return f"{self.fraction:x}:{self.key:016x}:{self.n:x}:{_packed(self.kept)}"

    @classmethod
    def parse(cls, printed: str) -> Sketch:
        fraction, key, n, kept = printed.split(":")
        return cls(int(key, 16), int(n, 16), _unpacked(kept), int(fraction, 16), frozenset([int(key, 16)]))

    def _at(self, fraction: int) -> np.ndarray:
        return self.kept if fraction == self.fraction else self.kept[self.kept < np.uint64((1 << BITS) // fraction)]

    def union(self, other: Sketch) -> Sketch:
        """The sketch of both texts' shingles. Its count is an estimate, except where one text's shingles are the other's."""
        if self.key == other.key:
            return self
        fraction = max(self.fraction, other.fraction)
        kept, parts = np.union1d(self._at(fraction), other._at(fraction)), self.parts | other.parts
        key = next(iter(parts)) if len(parts) == 1 else reduce(xor, parts)
        return Sketch(key, max(self.n, other.n, len(kept) * fraction), kept, fraction, parts)

    def _shared(self, other: Sketch) -> tuple[int, int, int]:
        """Retained hashes of both, of this and of the other one, at one fraction."""
        fraction = max(self.fraction, other.fraction)
        a, b = self._at(fraction), other._at(fraction)
        return len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)

    def likeness(self, other: Sketch) -> float:
        """Estimate of the Jaccard similarity of the shingle sets."""
        if self.key == other.key:
            return 1.0
        shared, a, b = self._shared(other)
        return shared / (a + b - shared) if a + b else 0.0

    def contained(self, other: Sketch) -> float:
        """Estimate of the share of this text's shingles that the other has too."""
        if self.key == other.key:
            return 1.0
        shared, a, _ = self._shared(other)
        return shared / a if a else 0.0


def sketches(docs: DataFrame, fraction: int = FRACTION) -> DataFrame:
    """Per document: doc_id, fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fingerprint": pa.array([str(Sketch.of(texts[i].as_py(), fraction)) for i in range(batch.num_rows)], pa.string())})

    return plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, fingerprint string")


def _with_neighbours(docs: DataFrame, rows_a_range: int = 5_000) -> DataFrame:
    """Rows (place, role, doc_id, text): ranges of (id, text hash), each followed by the first row of the next range (role 1).

    Only ids and hashes are sorted to find the ranges, so rows without an id spread too; texts move once.
    """
    source = plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    source = source.select(F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("at"), F.xxhash64("text").alias("th"), "doc_id", "text")
    ids = source.select("at", "th").distinct()
    n = min(RANGES, source.count() // rows_a_range + 1)
    order = [F.desc("at"), F.desc("th")]
    ranged = ids.repartitionByRange(n, *order).select("at", "th", F.spark_partition_id().alias("place"))
    heads = ranged.groupBy("place").agg(F.max(F.struct("at", "th")).alias("head")).collect()  # one for each range
    ascending = sorted((r["head"]["at"], r["head"]["th"]) for r in heads)
    low, below = (np.array(x, np.int64) for x in zip(*ascending, strict=True)) if ascending else (np.empty(0, np.int64),) * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            # place 0 has the largest: the range of the least head not below (at, th), among heads of the same id by hash
            first, last = np.searchsorted(low, at, side="left"), np.searchsorted(low, at, side="right")
            up = first.copy()
            for i in np.flatnonzero(last > first):
                up[i] += np.searchsorted(below[first[i] : last[i]], th[i], side="left")
            place = len(low) - 1 - up
            near = np.minimum(up, len(low) - 1)
            head = np.flatnonzero((low[near] == at) & (below[near] == th))
            pick = pa.array(np.concatenate([np.arange(len(at)), head]))
            role = np.concatenate([np.zeros(len(at), np.int32), np.ones(len(head), np.int32)])
            before = (place[head] - 1) % len(low)
            yield pa.RecordBatch.from_pydict(
                {"place": pa.array(np.concatenate([place, before]).astype(np.int32)), "role": pa.array(role)} | {n: batch.column(i).take(pick) for i, n in enumerate(("at", "th", "doc_id", "text"))}
            )

    placed = source.mapInArrow(run, "place int, role int, at long, th long, doc_id long, text string")
    return placed.repartition("place").sortWithinPartitions("place", "role", *order)


def edited(text: str, following: str) -> str:
    """The last third of a text replaced with as many characters from the start of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def edited_likeness(docs: DataFrame, fraction: int = FRACTION) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    columns = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        last: tuple | None = None  # place, doc_id, text, sketch of the row that waits for its next one

        def result(own: tuple, text: str, sketch: Sketch) -> tuple:
            _, doc_id, mine, fingerprint = own
            new = edited(mine, text)
            other = Sketch.of(new, fraction)
            return (doc_id, len(mine), hashlib.sha256(utf8(new)).hexdigest(), str(fingerprint), str(other), fingerprint.likeness(other), fingerprint.likeness(sketch))

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), columns.values(), strict=True)], list(columns))

        for place, role, doc_id, text in rows(batches, "place", "role", "doc_id", "text"):
            text = text or ""
            sketch = Sketch.of(text, fraction)
            if last and last[0] == place:
                out.append(result(last, text, sketch))
                size += len(out[-1][3]) + len(out[-1][4])
            # of several rows under a head's id only the first is the next one
            last = (place, doc_id, text, sketch) if role == 0 else None
            if size > 8_000_000:
                yield flush()
                out, size = [], 0
        if out:
            yield flush()

    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _with_neighbours(docs).mapInArrow(run, kinds)
