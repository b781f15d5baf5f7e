"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams by language are summed by Spark, a block of at most ``max_langs`` languages at a time, and kept as a table
for each block. Texts are scored block by block, each in a pass of its own with its own broadcast: the block's counts, at most
languages x buckets of 16 bytes each, so 105 MB whatever the number of labels. A worker turns them into the log-probability
matrix once, scores its texts sparsely in numpy, and hands on the best language so far. So every label is learned, and
neither driver nor broadcast grows with the labels.

Defined cases: a null text, or one with no letter, is ``und`` with score 0. Rows with null lang teach nothing. With no
labelled row every text is ``und``. Of languages with equal scores the first in order of names is taken. Above ``max_langs``
labels each further block costs another pass. Long texts are scored block by block. Repeated rows each give a row, an empty
table none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix, plain, rows

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 15
_BLOCK = 1 << 18
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)


def grams(text: str, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the lower-cased text, a block at a time; blocks overlap by the longest n-gram."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    code = np.where((code >= 9) & (code <= 13), np.uint64(32), code)
    last = max(ORDERS) - 1
    for at in range(0, max(len(code), 1), _BLOCK):
        c = code[at : at + _BLOCK + last]
        out = []
        for n in ORDERS:
            m = min(len(c) - n + 1, _BLOCK)
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for i in range(n):
                h = h * np.uint64(0x100000001B3) + c[i : i + m] * _MULT[i]
            out.append((mix(h) & np.uint64(buckets - 1)).astype(np.int64))
        if out:
            yield np.concatenate(out)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Block:
    """A block of languages: their priors, and bucket, language in the block and count of the counts above 0."""

    langs: list[str]
    prior: np.ndarray
    counts: tuple[np.ndarray, np.ndarray, np.ndarray]
    buckets: int
    smooth: float
    _logp: np.ndarray | None = None

    def logp(self) -> np.ndarray:
        """buckets x languages, made once in a worker."""
        if self._logp is None:
            b, k, n = self.counts
            total = np.full((self.buckets, len(self.langs)), self.smooth)
            total[b, k] += n
            self._logp = np.log(total / total.sum(axis=0))
        return self._logp

    def score(self, text: str) -> tuple[str, float, float]:
        """The block's best language of a text, its score, and the sum of all its languages' shares relative to it."""
        logp = self.logp()
        score = np.zeros(logp.shape[1])
        for bucket in grams(text, len(logp)):
            # the block's sparse count vector times the matrix
            count = np.bincount(bucket, minlength=len(logp)) if len(bucket) > len(logp) else None
            score += count @ logp if count is not None else logp[bucket].sum(axis=0, dtype=np.float64)
        # n-grams of several orders tell the same letters again, so their evidence is averaged over the orders
        margin = score / len(ORDERS) + self.prior
        k = int(np.argmax(margin))
        return self.langs[k], float(margin[k]), float(np.exp(margin - margin[k]).sum())


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray
    buckets: int = BUCKETS
    smooth: float = 0.5
    #: languages to a block
    wide: int = 200
    #: the counts of each block: k (language in the block), b (bucket), n
    tables: list[DataFrame] = field(default_factory=list)

    def block(self, i: int) -> Block:
        got = self.tables[i].toArrow()  # languages x buckets at most
        at = slice(i * self.wide, (i + 1) * self.wide)
        b, k = (got.column(c).to_numpy().astype(np.int32) for c in "bk")
        return Block(self.langs[at], self.prior[at], (b, k, got.column("n").to_numpy()), self.buckets, self.smooth)


def fit(docs: DataFrame, buckets: int = BUCKETS, smooth: float = 0.5, max_langs: int = 200) -> Model:
    """Learn from the (text, lang) columns of every row of ``docs`` that has a lang, ``max_langs`` languages at a time."""
    labelled = plain(docs, "text", "lang").where("lang is not null and text is not null")
    by = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # a row for each label
    langs = sorted(by)
    if not langs:
        return Model([], np.zeros(0))
    scratch = Scratch(docs.sparkSession)

    def counted(some: list[str]) -> DataFrame:
        index = {name: i for i, name in enumerate(some)}

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Combine a task's counts before the shuffle: at most languages x buckets rows leave it."""
            total = np.zeros((len(some), buckets), np.int64)
            for text, lang in rows(batches, "text", "lang"):
                if lang in index and has_letter(text):
                    for b in grams(text, buckets):
                        np.add.at(total[index[lang]], b, 1)
            k, b = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({"k": pa.array(k.astype(np.int32)), "b": pa.array(b.astype(np.int32)), "n": pa.array(total[k, b])})

        return scratch.write(labelled.mapInArrow(count, "k int, b int, n long").groupBy("k", "b").agg(F.sum("n").alias("n")))

    prior = np.log(np.array([by[x] for x in langs]) / sum(by.values()))
    return Model(langs, prior, buckets, smooth, max_langs, [counted(langs[at : at + max_langs]) for at in range(0, len(langs), max_langs)])


def _scored(docs: DataFrame, model: Model) -> tuple[DataFrame, str, Column]:
    """docs with the name of a column that holds the predicted language, null if there is none, and the score.

    One pass for each block; all but the last are written, so that one block's broadcast is held at a time."""
    spark = docs.sparkSession
    best, most, total = (next(f"{name}{'_' * n}" for n in range(1, 99) if f"{name}{'_' * n}" not in docs.columns) for name in ("best", "most", "total"))
    docs = docs.withColumns({best: F.lit(None).cast("string"), most: F.lit(float("-inf")), total: F.lit(0.0)})
    scratch, before = Scratch(spark), None
    for i in range(len(model.tables)):
        broadcast = spark.sparkContext.broadcast(model.block(i))

        def run(batches: Iterator[pa.RecordBatch], broadcast=broadcast) -> Iterator[pa.RecordBatch]:
            block = broadcast.value
            for batch in batches:
                at = {n: batch.schema.get_field_index(n) for n in ("text", best, most, total)}
                texts = batch.column(at["text"])
                b, m, t = (batch.column(at[n]).to_pylist() for n in (best, most, total))
                for j in range(len(texts)):
                    text = texts[j].as_py()
                    if has_letter(text):
                        lang, margin, share = block.score(text)
                        if margin > m[j]:
                            b[j], m[j], t[j] = lang, margin, share + t[j] * np.exp(m[j] - margin)
                        else:
                            t[j] += share * np.exp(margin - m[j])
                for n, values, kind in ((best, b, pa.string()), (most, m, pa.float64()), (total, t, pa.float64())):
                    batch = batch.set_column(at[n], n, pa.array(values, kind))
                yield batch

        docs = docs.mapInArrow(run, docs.schema)
        if i + 1 < len(model.tables):
            docs = scratch.write(docs)
            scratch.empty(before)
            before = docs
            broadcast.unpersist()
    return docs, best, F.when(F.col(best).isNotNull(), 1 / F.col(total)).otherwise(0.0)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, lang_pred, score."""
    found, best, score = _scored(plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")), model)
    return found.select("doc_id", F.coalesce(best, F.lit("und")).alias("lang_pred"), score.alias("score"))


def keep(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents whose language is known with a score of ``least``; a missing lang is filled with the prediction."""
    found, best, score = _scored(docs, model)
    kept = found.where(F.col(best).isNotNull() & (score >= least))
    return kept.select(*[F.coalesce("lang", best).alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns])
