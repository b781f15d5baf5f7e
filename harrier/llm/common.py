"""Helpers the training-data operators share: word hashing in numpy, checkpoints, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, shared_folder

#: ASCII white space that separates words everywhere in this package: ``[\x20\x09-\x0D]``.
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_BLOCK = 1 << 20
_MASK = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Odd multipliers, one for each place in a shingle.
_PLACES = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over an array of uint64."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, _BLOCK + 1)
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, r, np.uint64))]) for r in (_R, pow(_R, -1, 1 << 64))]
    return _powers[0], _powers[1]


def _hash_block(b: np.ndarray) -> np.ndarray:
    white = _WHITE[b]
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    starts = edge[~white[edge]]
    ends = edge[white[edge]]
    if not white[0]:
        starts = np.concatenate([[0], starts])
    if not white[-1]:
        ends = np.concatenate([ends, [len(b)]])
    power, inverse = _pow(len(b))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * power[: len(b)], out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of ``data``, in order. Long texts go block by block, cut at white space."""
    if not data or data.isspace():
        return np.empty(0, np.uint64)
    b = np.frombuffer(data, np.uint8)
    if len(b) <= _BLOCK:
        return _hash_block(b)
    out, at = [], 0
    while at < len(b):
        end, span = len(b), _BLOCK
        while at + span < len(b):
            gaps = np.flatnonzero(_WHITE[b[at : at + span]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            span *= 2
        out.append(_hash_block(b[at:end]))
        at = end
    return np.concatenate(out)


def join_hashes(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of pairs of neighbouring windows, so of a window up to twice as long."""
    return mix(left * _PLACES[salt] + right * _PLACES[salt + 1])


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = h[:n] * _PLACES[0]
    for i in range(1, k):
        total += h[i : i + n] * _PLACES[i]
    return mix(total)


def shingle_set(data: bytes, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; with fewer words the whole sequence is one shingle."""
    h = word_hashes(data)
    if not len(h):
        return h
    return np.unique(windows(h, min(k, len(h))) + np.uint64(min(k, len(h)) % k))


def set_key(values: np.ndarray) -> int:
    """One signed 64-bit key of a sorted set of hashes."""
    with np.errstate(over="ignore"):
        place = np.arange(1, len(values) + 1, dtype=np.uint64) * np.uint64(_R)
        h = mix(np.array([mix(values ^ place).sum(dtype=np.uint64) + np.uint64(len(values))], np.uint64))
    return int(h.view(np.int64)[0])


def rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Python values of the named columns, row by row, so that one long text at a time is held."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a file in the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def plain(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, under aliases no other column can clash with."""
    return df.select(*[F.col(f"`{n}`").alias(n) for n in names])


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, label, old), label the smallest node of the component.

    Labels spread along edges by a grouped minimum, then jump to the label of their label. The minimum is
    combined before the shuffle, so a node with very many edges does not gather them in a task. Each round is written as
    a table: a checkpointed frame would hand its plan's constraints on, which double with every round.
    """
    both = scratch.write(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = scratch.write(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        lower = labels.join(near, "node").select("node", F.least("label", "m").alias("new"), F.col("label").alias("old"))
        # only labels that have a lower label themselves; both sides are shuffled as they are, so a label of very many nodes may be split
        jump = labels.where("label < node").select(F.col("node").alias("new"), F.col("label").alias("further"))
        after = scratch.write(lower.join(jump, "new", "left").select("node", F.least("new", "further").alias("label"), "old"))
        scratch.empty(labels)
        if after.where("label <> old").isEmpty():
            scratch.empty(both)
            return after
        labels = after
