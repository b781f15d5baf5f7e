"""Spelling variant grouping by forward and reversed sorted dictionaries.

Two words that differ by one edit share either all of one half in front of it or all of the other half behind it. So every
word is entered in a forward dictionary, by its first half, and in a reversed one, by its last half, for both lengths that the
longer word of a pair may have. Words that agree there are neighbours in sorted order: a block. The dictionaries are dealt
out by range, sorted, and scanned block by block; the words of a block are compared with one another.

A block leaves open where in a span of letters the edit is. One with more than ``BLOCK`` words is subdivided: the span is
halved and each word entered once for either half, with all other letters fixed. In a span of one letter no block has more
words than the alphabet and one, so blocks stay small whatever the words, and no pair is lost. A pair counts in the one
block whose span holds its first difference.

Defined cases: a null or empty text has no word; a null doc_id counts as an empty one. Ties among forms go to the smaller word
in code-point order. Repeated rows count again. Very long texts and runs are taken whole. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, plain, rows

#: Words of a block that are compared with one another; more than the letters of the alphabet.
BLOCK = 128
_HELD, _SLICE, _CELLS = 200_000, 1 << 20, 4_000_000
_LOWER = {c: c + 32 for c in range(65, 91)}
_KEY = ("total", "start", "stop", "fixed")
_OTHER = re.compile("[^A-Za-zÀ-ÿ]")


def word_counts(docs: DataFrame, least_length: int = 7, one_in: int = 31) -> DataFrame:
    """Words (word, n) of all texts: runs of letters, in lower case; one run in ``one_in`` lacks a letter, by a hash."""
    letters = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

        for doc_id, text in rows(batches, "doc_id", "text"):
            salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            at = 0
            while text and at < len(text):
                end = _OTHER.search(text, at + _SLICE)
                end = end.start() if end else len(text)
                for word, n in Counter(letters.findall(text, at, end)).items():
                    word = word.lower() if word.isascii() else word.translate(_LOWER)
                    h = zlib.crc32(word.encode(), salt)
                    if h % one_in == 0:
                        gone = h % len(word)
                        word = word[:gone] + word[gone + 1 :]
                        if len(word) < least_length:
                            continue
                    found[word] += n
                at = end
                if len(found) > _HELD:
                    yield flush()
                    found.clear()
        if found:
            yield flush()

    counted = plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _entry(total: Column, start: Column, stop: Column) -> Column:
    """A word's entry in the block that leaves letters start to stop open, in words of ``total`` letters or one less."""
    last = F.lit(1) + F.char_length("word") - (total - stop)
    fixed = F.concat(F.substring("word", F.lit(1), start), F.lit("|"), F.substring("word", last, total - stop))
    return F.struct(total.alias("total"), start.alias("start"), stop.alias("stop"), fixed.alias("fixed"))


def entries(words: DataFrame) -> DataFrame:
    """Entries (total, start, stop, fixed, word, n): the forward and the reversed dictionary."""
    size = F.char_length("word")
    found = []
    for total in (size, size + 1):
        half = F.floor(total / 2).cast("int")
        found += [_entry(total, half, total), _entry(total, F.lit(0), half)]
    return words.select(F.explode(F.array(*found)).alias("e"), "word", "n").select("e.*", "word", "n")


def halved(found: DataFrame) -> DataFrame:
    """Each entry once for either half of its open span."""
    middle = F.floor((F.col("start") + F.col("stop")) / 2).cast("int")
    two = F.array(_entry(F.col("total"), F.col("start"), middle), _entry(F.col("total"), middle, F.col("stop")))
    return found.select(F.explode(two).alias("e"), "word", "n").select("e.*", "word", "n")


def small_blocks(words: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """Entries whose blocks have at most ``block`` words, or leave one letter open."""
    found, all_ = entries(words), None
    while True:
        large = scratch.write(found.groupBy(*_KEY).count().where((F.col("count") > block) & (F.col("stop") - F.col("start") > 1)).select(*_KEY))
        done = large.isEmpty()
        small = found if done else found.join(large, [*_KEY], "left_anti")
        all_ = small if all_ is None else all_.unionByName(small)
        if done:
            return all_
        # the next level reads what is left of this one, not all levels before
        found = scratch.write(halved(found.join(large, [*_KEY], "left_semi")))


def _one_edit(letters: np.ndarray, size: np.ndarray, total: np.ndarray, start: np.ndarray, stop: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of pairs of rows of a block those one edit apart, whose first difference lies in the block's span."""
    a, b = np.where(size[a] >= size[b], a, b), np.where(size[a] >= size[b], b, a)
    right = size[a] == total[a]
    a, b = a[right], b[right]
    x, y = letters[a], letters[b]
    differ = x != y
    first = differ.argmax(1)
    same_size = size[a] == size[b]
    replaced = same_size & (differ.sum(1) == 1)
    moved = (x[:, 1:] != y[:, :-1]) & (np.arange(x.shape[1] - 1) >= first[:, None])
    near = (replaced | (~same_size & ~moved.any(1))) & (first >= start[a]) & (first < stop[a])
    return np.column_stack([a[near], b[near]])


def _pairs(block: np.ndarray, at: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of the same block, the first of them in at..end."""
    last = np.searchsorted(block, block[at:end], side="right")
    more = last - np.arange(at, end) - 1
    first = np.repeat(np.arange(at, end), more)
    return first, first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(more) - more, more)


def near_words(found: DataFrame) -> DataFrame:
    """Pairs (word, near, near_n) in both directions, each once, of sorted entries scanned block by block."""

    def scan(rows_: pa.Table) -> Iterator[pa.RecordBatch]:
        total, start, stop, n = (rows_[c].to_numpy() for c in ("total", "start", "stop", "n"))
        fixed, words = rows_["fixed"].to_numpy(), rows_["word"].to_numpy()
        new = (total[1:] != total[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1]) | (fixed[1:] != fixed[:-1])
        block = np.cumsum(np.append(0, new))
        # words of one block only have no partner
        size = np.array([len(w) for w in words])
        at = 0
        while at < len(words):
            # rows of whole blocks, as many as fit into a matrix of bounded size
            end = min(len(words), at + max(1, _CELLS // (int(size[at]) + 1) // BLOCK))
            width = int(size[at : np.searchsorted(block, block[end - 1], side="right")].max()) + 1
            a, b = _pairs(block, at, end)
            if len(a):
                low, high = at, int(b.max()) + 1
                letters = np.array([w.encode("latin-1") for w in words[low:high]], f"S{width}").view(np.uint8).reshape(high - low, width)
                part = slice(low, high)
                pair = _one_edit(letters, size[part], total[part], start[part], stop[part], a - low, b - low) + low
                x, y = pair[:, 0], pair[:, 1]
                one, two = np.concatenate([x, y]), np.concatenate([y, x])
                if len(one):
                    yield pa.RecordBatch.from_pydict({"word": pa.array(words[one], pa.string()), "near": pa.array(words[two], pa.string()), "near_n": pa.array(n[two], pa.int64())})
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows_ = pa.Table.from_batches([batch])
            rows_ = rows_ if held is None else pa.concat_tables([held, rows_])
            if not rows_.num_rows:
                continue
            # the last block may go on in the next batch
            key = rows_.slice(rows_.num_rows - 1).select(list(_KEY)).to_pylist()[0]
            same = np.ones(rows_.num_rows, bool)
            for c in _KEY:
                same &= rows_[c].to_numpy() == key[c]
            whole = rows_.num_rows - int(same.sum())
            if whole:
                yield from scan(rows_.slice(0, whole))
            held = rows_.slice(whole)
        if held is not None and held.num_rows:
            yield from scan(held)

    ordered = found.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY, "word")
    return ordered.mapInArrow(run, "word string, near string, near_n long")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (word, root): the end of each word's chain of forms (word, form), by doubling. A form is more frequent, so chains end."""
    tops = scratch.write(forms.select("word", F.col("form").alias("root")))
    while True:
        further = tops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = scratch.write(tops.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        scratch.empty(tops)
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        tops = after


def variants(words: DataFrame, least: int = 2, times: int = 10, block: int = BLOCK) -> DataFrame:
    """Words (word, n) with their spelling: word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word, if that is ``times`` as frequent; its root the last of the chain of forms.
    """
    scratch = Scratch(words.sparkSession)
    known = scratch.write(words.where(F.col("n") >= least))
    near = near_words(small_blocks(known, scratch, block))
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    joined = known.join(best, "word", "left")
    form = (-F.col("best.less") >= F.col("n") * times) & F.col("best").isNotNull()
    spelt = scratch.write(
        joined.select("word", F.when(form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form, -F.col("best.less")).alias("form_n"))
    )
    ends = roots(spelt.where(F.col("form").isNotNull()), scratch)
    out = scratch.write(spelt.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
    scratch.empty(*[df for df, _ in list(scratch.paths.values()) if df is not out])
    return out
