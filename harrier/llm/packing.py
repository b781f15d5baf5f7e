"""Harmonic packing of token ids into fixed-size sequences.

A document is cut greedily into pieces of harmonic lengths capacity // k, largest first, so every piece fills its
reciprocal-capacity class exactly: k pieces of a class fill one sequence. (Cut so, a document's rest needs two or three
pieces.) Pieces are dealt to buckets by hash; each bucket fills the bins of each class with a fixed number of pieces
on its own. What is left of the classes in a bucket, less than one bin each, is laid end to end and cut at the sequence
ends, so one sequence of a bucket is partly filled. Buckets hold about ``bucket_tokens`` tokens, so many that the bins of
classes hold nearly all of them.

Defined cases: a null or empty text is one id, the end of document. Repeated rows are packed each, and dealt to all buckets. Very long texts
give full sequences, dealt to all buckets. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import plain, rows, utf8

CAPACITY = 2048
#: Bytes of words and their ids that a Python worker remembers, counting so many for an entry besides.
MEMO, ENTRY = 80_000_000, 160
#: Punctuation that is a token run of its own behind an ASCII letter or digit, or another letter that stays one letter.
_TAIL = b"!.,;:?*$%&#|>"
_encoders: dict = {}


class WordIds:
    """Ids of texts by a tokenizer that lower-cases and drops white space, so that words can be encoded apart.

    Words seen before come from a memo. Of a new word a tail of punctuation is looked up apart, and what is still
    unknown is encoded by the library in one batch for each text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.memo: dict[bytes, bytes] = {}
        self.held = 0
        # byte-level vocabularies show bytes that do not print as the code points from 256 on, in order
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.shown = dict(zip([b for b in range(256) if b not in prints], range(256, 512), strict=False))

    def __call__(self, data: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        # lower-casing first makes words meet in the memo; not beside combining marks or special tokens, which it could alter
        plain_case = b"<|" not in data and (data.isascii() or (b"\xcc" not in data and b"\xcd" not in data))
        words = (data.lower() if plain_case else data).split()
        memo = self.memo
        if self.held > MEMO:
            memo.clear()
            self.held = 0
        got = list(map(memo.get, words))
        missing = [i for i, g in enumerate(got) if g is None]
        if missing:
            new, parts = set(), []
            for i in missing:
                word = words[i]
                stem = word.rstrip(_TAIL)
                if stem and len(stem) < len(word) and plain_case and (stem[-1:].isalnum() or _one_letter(stem.decode("utf-8", "replace")[-1])):
                    tail = word[len(stem) :]
                    known = stem in memo
                    if not known:
                        new.add(stem)
                    if tail not in memo:
                        new.add(tail)
                    parts.append((stem, tail, known))
                else:
                    new.add(word)
                    parts.append((word, b"", False))
            if new:
                other = []
                for w in new:
                    text = w.decode("utf-8", "replace")
                    # a run of Latin letters is one word to the tokenizer, which its model takes byte by byte
                    if text.isalpha() and max(text) < "\u0130":
                        ids = [t.id for t in self.model.tokenize(text.lower().encode().decode("latin-1").translate(self.shown))]
                        memo[w] = struct.pack(f"<{len(ids)}I", *ids)
                    else:
                        other.append((w, text))
                for (w, _), e in zip(other, self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False), strict=True):
                    memo[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)
                self.held += sum(len(w) + len(memo[w]) + ENTRY for w in new)
            for i, (stem, tail, known) in zip(missing, parts, strict=True):
                got[i] = memo[stem] + memo[tail] if tail else memo[stem]
                if known:
                    memo[words[i]] = got[i]
                    self.held += len(words[i]) + len(got[i]) + ENTRY
        return b"".join(got)


def _one_letter(c: str) -> bool:
    """Whether a letter is one letter in lower case and composed form too. Another ends in a mark, which the tokenizer
    takes together with punctuation behind it."""
    shown = unicodedata.normalize("NFC", c.lower())
    return c.isalpha() and len(shown) == 1 and shown.isalpha()


def word_ids(path: str) -> Callable[[bytes], bytes]:
    """The worker's encoder for a vocabulary file, built once."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def harmonic(length: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document: largest capacity // k that still fits, again and again."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        piece = capacity // -(-capacity // rest) if rest else 0
        out.append(piece)
        rest -= piece
    return out


def _pieces(path: str, end: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path)
        last = np.array([end], "<u4").tobytes()
        out: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            c = list(zip(*out, strict=True))
            kinds = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "ids": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(c, kinds.values(), strict=True)], list(kinds))

        for doc_id, text in rows(batches, "doc_id", "text"):
            ids = encode(utf8(text)) + last
            total, at = len(ids) // 4, 0
            for n in harmonic(total, capacity):
                piece = ids[4 * at : 4 * (at + n)]
                out.append((doc_id, at, n, zlib.crc32(piece), total, piece))
                at += n
                held += n
            if held >= 1_000_000:
                yield flush()
                out, held = [], 0
        if out:
            yield flush()

    return run


def tokenised(docs: DataFrame, path: str, end: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Harmonic pieces of every whole text: doc_id, start, length, ids_crc32, doc_tokens, ids (binary)."""
    source = plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(_pieces(path, end, capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def bucket_count(docs: DataFrame, bucket_tokens: int = 1 << 22, chars_a_token: float = 2.7) -> int:
    """Buckets for about ``bucket_tokens`` tokens each, judged by the characters of all texts."""
    chars = docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    return max(1, round(chars / chars_a_token / bucket_tokens))


def pack(pieces: DataFrame, buckets: int, capacity: int = CAPACITY) -> DataFrame:
    """Place pieces (doc_id, start, length, ids_crc32, doc_tokens, ids) in sequences: adds sequence_id and offset.

    Of the left pieces one that a sequence end cuts becomes two, so ids_crc32 is taken again there. The ids of
    sequences are unique, not consecutive: bucket, class and bin. A sequence that one document fills is a bin of
    class 1.
    """
    place = ["doc_id", "start", "ids_crc32", "row"]
    by_class = Window.partitionBy("bucket", "length")
    # equal rows differ in where they were read
    part = pieces.withColumn("row", F.monotonically_increasing_id()).withColumn("bucket", F.pmod(F.xxhash64(*place), F.lit(buckets)))
    part = part.repartition("bucket")
    part = part.withColumn("k", F.floor(F.lit(capacity) / F.col("length")))
    part = part.withColumn("nth", F.row_number().over(by_class.orderBy(*place)) - 1).withColumn("in_class", F.count("*").over(by_class))
    part = part.withColumn("bin", F.floor(F.col("nth") / F.col("k")))
    part = part.withColumn("whole", (F.col("bin") + 1) * F.col("k") <= F.col("in_class"))
    # the rests of all classes, the longest pieces first, end to end
    before = Window.partitionBy("bucket").orderBy("whole", F.desc("length"), *place).rowsBetween(Window.unboundedPreceding, -1)
    part = part.withColumn("rest_at", F.coalesce(F.sum(F.when(~F.col("whole"), F.col("length"))).over(before), F.lit(0)))
    # a piece lies in one sequence, or is cut by the end of one
    room = F.lit(capacity) - F.col("rest_at") % capacity
    none = F.lit(0).cast("long")
    cuts = F.when(
        F.col("whole") | (F.col("length") <= room), F.array(F.struct(none.alias("skip"), F.col("length").alias("take")))
    ).otherwise(F.array(F.struct(none.alias("skip"), room.alias("take")), F.struct(room.alias("skip"), (F.col("length") - room).alias("take"))))
    part = part.withColumn("cut", F.explode(cuts)).withColumn("at", F.col("rest_at") + F.col("cut.skip"))
    split = F.col("cut.take") < F.col("length")
    some = F.expr("substring(ids, cast(4 * cut.skip + 1 as int), cast(4 * cut.take as int))")
    return part.select(
        "doc_id",
        (F.col("start") + F.col("cut.skip")).alias("start"),
        F.col("cut.take").alias("length"),
        F.when(split, F.crc32(some)).otherwise(F.col("ids_crc32")).alias("ids_crc32"),
        "doc_tokens",
        F.when(split, some).otherwise(F.col("ids")).alias("ids"),
        F.when(F.col("whole"), _sequence(F.col("length"), F.col("bin"))).otherwise(_sequence(none, F.floor(F.col("at") / capacity))).alias("sequence_id"),
        F.when(F.col("whole"), F.col("nth") % F.col("k") * F.col("length")).otherwise(F.col("at") % capacity).alias("offset"),
    )


def _sequence(of_class: Column, nth: Column) -> Column:
    """Bucket, class (12 bits) and bin (20 bits) in one number."""
    return F.shiftleft("bucket", 32) + F.shiftleft(of_class.cast("long"), 20) + nth.cast("long")
