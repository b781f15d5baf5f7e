"""Substring dedup by level-wise doubling.

A window is ``size`` consecutive words. Windows are judged at three lengths, each about twice the one before, so 9, 18
and 35 words for the default: only windows whose part of one length occurs twice are extended to the next.

1. Each window is stood for by the smallest hash among its short parts (the same words choose the same part), so only
   about one word in fourteen sends a row. Parts that occur once end all windows they stand for.
2. What is left is stood for by its smallest part of twice that length. One row holds all windows that share a part.
3. Within each repeated part the whole windows are counted.

Each task first combines equal hashes of its own slice: what it has seen twice is known to repeat and is sent on once, so a
passage in a third of all rows sends one row for each slice, not one for each copy. A row that repeats doc_id and text is
read once in a slice, with all its windows known to repeat.

Defined cases: a null or empty text has no words; n_words 0 and the digest of the empty text. Texts shorter than a
window keep all words. Repeated rows repeat each other's windows. Null doc_ids are rows like others. Very long texts
are windowed block by block. An empty table gives an empty result; other columns, whatever their names, are ignored by
``repeats`` and kept by ``remove``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import join_hashes, rows, utf8, windows, word_hashes

WINDOW = 35
_BLOCK = 1 << 19
_SLICE = 1_000_000


def lengths(size: int) -> tuple[int, int]:
    """The two lengths below ``size``: halves, rounded up."""
    half = -(-size // 2)
    return -(-half // 2), half


def _smallest(h: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` hashes the place of the smallest, the first of equals."""
    n = len(h) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    key = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width * 2 <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    key = np.minimum(key[:n], key[span - width : span - width + n])
    return (key & np.uint64((1 << 20) - 1)).astype(np.int64)


def _blocks(h: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of words that overlap by a window less one, so that each window lies whole in one block."""
    for at in range(0, len(h) - size + 1, _BLOCK):
        yield at, h[at : at + _BLOCK + size - 1]


class _Levels:
    """Hashes of one block at each length."""

    def __init__(self, words: np.ndarray, size: int):
        self.size = size
        self.short, self.half = lengths(size)
        self.h1 = windows(words, self.short)
        self.at1 = _smallest(self.h1, size - self.short + 1)

    def double(self) -> None:
        self.h2 = join_hashes(self.h1[: len(self.h1) - (self.half - self.short)], self.h1[self.half - self.short :], 40)
        self.at2 = _smallest(self.h2, self.size - self.half + 1)
        self.h3 = join_hashes(self.h2[: len(self.h2) - (self.size - self.half)], self.h2[self.size - self.half :], 42)


def _twice(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes occur more than once here, and which rows are the first of theirs."""
    _, first, back, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    lead = np.zeros(len(h), bool)
    lead[first] = True
    return (n > 1)[back], lead


class _Slice:
    """The blocks a task holds until they are compared, each document once."""

    def __init__(self):
        self.held: list[tuple] = []
        self.count = 0
        self.seen: dict[tuple, list] = {}

    def again(self, doc_id: int | None, th: int) -> bool:
        """Whether the document is held already; if so its blocks are marked as repeated."""
        mark = self.seen.get((doc_id, th))
        if mark is None:
            self.seen[doc_id, th] = [False]
            return False
        mark[0] = True
        return True

    def add(self, *entry) -> None:
        self.held.append((*entry, self.seen[entry[-2:]]))
        self.count += len(entry[0])

    def repeated(self, owner: np.ndarray) -> np.ndarray:
        return np.array([x[-1][0] for x in self.held])[owner]


def _first_level(size: int):
    """Rows (part, doc_id, th, at, n): n is 1 for a part seen once in the slice, 2 for the one row that stands for a
    part seen more often, and 0 for a place already known to repeat, which needs no comparison."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = _Slice()

        def flush() -> pa.RecordBatch:
            held = some.held
            h = np.concatenate([x[0] for x in held])
            at = np.concatenate([x[1] for x in held])
            owner = np.repeat(np.arange(len(held)), [len(x[0]) for x in held])
            many, lead = _twice(h)
            many |= some.repeated(owner)
            once, stand = np.flatnonzero(~many), np.flatnonzero(many & lead)
            known = np.flatnonzero(many)
            pick = np.concatenate([once, stand, known])
            n = np.concatenate([np.ones(len(once), np.int32), np.full(len(stand), 2, np.int32), np.zeros(len(known), np.int32)])
            ids = pa.array([x[2] for x in held], pa.int64()).take(pa.array(owner[pick]))
            th = np.array([x[3] for x in held], np.int64)[owner[pick]]
            # known places are spread by their document, not gathered by their part
            part = np.where(n == 0, th ^ at[pick], h.view(np.int64)[pick])
            return pa.RecordBatch.from_pydict({"part": pa.array(part), "doc_id": ids, "th": pa.array(th), "at": pa.array(at[pick]), "n": pa.array(n)})

        for doc_id, text, th in rows(batches, "doc_id", "text", "th"):
            if some.again(doc_id, th):
                continue
            for start, words in _blocks(word_hashes(utf8(text)), size):
                level = _Levels(words, size)
                at = np.unique(level.at1)
                some.add(level.h1[at], at + start, doc_id, th)
            if some.count >= _SLICE:
                yield flush()
                some = _Slice()
        if some.held:
            yield flush()

    return run


def _next_levels(size: int):
    """Rows (part, doc_id, th, base, n, whole): per part of half length the hashes of the whole windows it stands
    for, by offset from ``base``. n as above; with n 0, ``whole`` holds one bit mask of offsets known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = _Slice()
        width = size - lengths(size)[1] + 1

        def flush() -> pa.RecordBatch:
            # one entry for each window still alive
            held = some.held
            part, base, offset, whole = (np.concatenate([x[i] for x in held]) for i in range(4))
            owner = np.repeat(np.arange(len(held)), [len(x[0]) for x in held])
            many, lead = _twice(whole)
            many |= some.repeated(owner)
            ids, ths = pa.array([x[4] for x in held], pa.int64()), np.array([x[5] for x in held], np.int64)
            out = {k: [] for k in ("part", "doc_id", "th", "base", "n", "whole")}
            for n, pick in ((1, ~many), (2, many & lead), (0, many)):
                i = np.flatnonzero(pick)
                if not len(i):
                    continue
                # windows of one part of one document are neighbours: cut where either changes
                cut = np.flatnonzero(np.concatenate([[True], (base[i][1:] != base[i][:-1]) | (owner[i][1:] != owner[i][:-1])]))
                first = i[cut]
                ends = np.append(cut[1:], len(i))
                out["doc_id"].append(ids.take(pa.array(owner[first])))
                out["th"].append(ths[owner[first]])
                out["base"].append(base[first])
                out["n"].append(np.full(len(first), n, np.int32))
                if n:
                    out["part"].append(part[first].view(np.int64))
                    row = np.repeat(np.arange(len(cut)), ends - cut)
                    table = np.zeros((len(cut), width), np.int64)
                    table[row, offset[i]] = whole[i].view(np.int64)
                    table = table.reshape(-1)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(table) + 1, width, dtype=np.int32)), pa.array(table, mask=table == 0))
                else:
                    out["part"].append(ths[owner[first]] ^ base[first])
                    mask = np.bitwise_or.reduceat(np.left_shift(np.int64(1), offset[i]), cut)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(mask) + 1, dtype=np.int32)), pa.array(mask))
                out["whole"].append(lists)
            return pa.RecordBatch.from_pydict({k: pa.concat_arrays(v) if isinstance(v[0], pa.Array) else pa.array(np.concatenate(v)) for k, v in out.items()})

        for doc_id, text, th, places in rows(batches, "doc_id", "text", "th", "places"):
            if some.again(doc_id, th):
                continue
            known = np.array(places, np.int64)
            for start, words in _blocks(word_hashes(utf8(text)), size):
                level = _Levels(words, size)
                alive = np.flatnonzero(np.isin(level.at1 + start, known))
                if not len(alive):
                    continue
                level.double()
                part = level.at2[alive]
                base = part - (width - 1)
                whole = level.h3[alive]
                whole[whole == 0] = 1
                some.add(level.h2[part], base + start, alive - base, whole, doc_id, th)
            if some.count >= _SLICE:
                yield flush()
                some = _Slice()
        if some.held:
            yield flush()

    return run


def _covered(n: int, marks: list[dict], size: int) -> np.ndarray:
    """Words covered by the marked windows."""
    step = np.zeros(n + 1, np.int64)
    if marks:
        base = np.array([m["base"] for m in marks], np.int64)
        mask = np.array([m["mask"] for m in marks], np.int64)
        for o in range(size - lengths(size)[1] + 1):
            at = base[(mask >> o) & 1 == 1] + o
            np.add.at(step, at, 1)
            np.add.at(step, at + size, -1)
    return np.cumsum(step)[:n] > 0


def marks(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows (doc_id, th, marks): for each text with repeated windows where they start, as (base, mask of offsets)."""
    source = _source(docs)
    part = Window.partitionBy("part")
    first = source.mapInArrow(_first_level(size), "part long, doc_id long, th long, at long, n int")
    # n is 0 for places known to repeat; of a part sent as 2 the row itself is among those
    first = first.withColumn("total", F.sum("n").over(part)).where("n = 0 or (n = 1 and total > 1)")
    places = first.groupBy(F.col("doc_id").alias("p_id"), F.col("th").alias("p_th")).agg(F.collect_set("at").alias("places"))
    found = source.join(places, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("th") == F.col("p_th"))).select("doc_id", "text", "th", "places")
    # identical rows share their places; only the rows of one (doc_id, th) meet here
    later = found.mapInArrow(_next_levels(size), "part long, doc_id long, th long, base long, n int, whole array<long>")
    later = later.withColumn("total", F.sum("n").over(part)).where("n = 0 or total > 1")
    later = later.select("part", "doc_id", "th", "base", "n", F.posexplode("whole").alias("o", "h")).where("h is not null")
    later = later.withColumn("total", F.sum("n").over(Window.partitionBy("part", "h"))).where("n = 0 or (n = 1 and total > 1)")
    bits = F.when(F.col("n") == 0, F.col("h")).otherwise(F.expr("shiftleft(1L, o)"))
    later = later.groupBy("part", "doc_id", "th", "base").agg(F.bit_or(bits).alias("mask"))
    return later.groupBy("doc_id", "th").agg(F.collect_list(F.struct("base", "mask")).alias("marks"))


def _source(docs: DataFrame, *more: Column) -> DataFrame:
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.xxhash64("text").alias("th")]
    return docs.select(*own, *more)


def _with_marks(docs: DataFrame, size: int, *more: Column) -> DataFrame:
    """Rows (doc_id, text, th, more.., marks)."""
    found = marks(docs, size).withColumnRenamed("doc_id", "m_id").withColumnRenamed("th", "m_th")
    both = _source(docs, *more).join(found, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("th") == F.col("m_th")), "left")
    return both.drop("m_id", "m_th")


def _kept_words(text: str | None, found: list[dict] | None, size: int) -> tuple[list[bytes], int]:
    words = utf8(text).split()
    if not found:
        return words, len(words)
    gone = _covered(len(words), found, size)
    return [words[i] for i in np.flatnonzero(~gone)], len(words)


def repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (the words left, joined by a space)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, digest = [], [], []
            for text, found in rows([batch], "text", "marks"):
                left, total = _kept_words(text, found, size)
                n.append(total)
                removed.append(total - len(left))
                digest.append(hashlib.sha256(b" ".join(left)).hexdigest())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())})

    return _with_marks(docs, size).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without the words of repeated windows. A text that loses none is left as it is; a text that
    loses all its words is dropped. n_chars, where there is one, follows the text. Other columns stay."""
    joined = _with_marks(docs, size, F.struct("*").alias("row")).select("row", "text", "marks")
    kinds = {"doc_id": LongType(), "n_chars": LongType()}
    fields = StructType([StructField(f.name, kinds.get(f.name, f.dataType)) for f in docs.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = [], []
            for text, found in rows([batch], "text", "marks"):
                if found:
                    left, _ = _kept_words(text, found, size)
                    text = b" ".join(left).decode("utf-8", "surrogatepass")
                    keep.append(bool(left))
                else:
                    keep.append(True)
                texts.append(text)
            out = {f.name: column for f, column in zip(fields, batch.column(0).flatten(), strict=True)} | {"text": pa.array(texts, pa.string())}
            if "n_chars" in out:
                out["n_chars"] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            out["doc_id"] = out["doc_id"].cast(pa.int64())
            yield pa.RecordBatch.from_pydict(out).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, fields)
