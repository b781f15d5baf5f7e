"""Themes of vectors: products with blocks of weighted phrases, the best themes kept as they go."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch

#: Phrases to a block, and digits of a score.
BLOCK, DIGITS = 4_096, 6
#: How far a second theme may lie behind the best one; what keywords in a title and in a text add; scores
#: that stand in where there is no vector, by the number of keyword hits.
SECOND, TITLE, TEXT, FALLBACK = 0.06, 0.08, 0.03, (0.3, 0.45, 0.6)


@dataclass
class Phrases:
    """A block of phrases sorted by theme: vectors times weights, the themes, and where each theme begins."""

    matrix: np.ndarray
    themes: list
    starts: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Phrases:
        rows = sorted(rows, key=lambda r: r[0])
        themes = [r[0] for r in rows]
        starts = [i for i, t in enumerate(themes) if i == 0 or t != themes[i - 1]]
        return cls(np.array([np.array(v, float) * w for _, w, v in rows]), [themes[i] for i in starts], np.array(starts))

    def best(self, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector the ``most`` best themes (their numbers) and scores; a theme's score is that of its best phrase."""
        score = np.maximum.reduceat(np.round(vectors @ self.matrix.T, DIGITS), self.starts, axis=1)
        top = np.argsort(-score, axis=1, kind="stable")[:, :most]
        return top, np.take_along_axis(score, top, axis=1)


def best_themes(vectors: DataFrame, key: list[str], vector: str, phrases: DataFrame, most: int = 2, block: int = BLOCK) -> DataFrame:
    """(key, best): the ``most`` themes with the highest scores, best first, ties by theme; best is an array of (score, theme).

    ``phrases`` has theme, weight and vector. A theme scores as its best phrase, times that one's weight. Phrases are taken a
    block at a time, each block broadcast in its pass; a vector's list of a block is merged with its list so far. That loses no
    theme: where one scores best, no ``most`` others are above it unless they are so at the end. Rows without a
    vector, or of another length than the phrases, have an empty list.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    kind = phrases.schema["theme"].dataType.simpleString()
    known = phrases.select("theme", F.col("weight").cast("double").alias("weight"), "vector").where("theme is not null and vector is not null")
    blocks = max(1, -(-known.count() // block))
    known = known.withColumn("_block", F.pmod(F.xxhash64("theme", "weight", "vector"), F.lit(blocks)))
    found = vectors.select(*key, F.col(vector).alias("_v"), F.array().cast(f"array<struct<score:double,theme:{kind}>>").alias("best"))
    before = None
    for i in range(blocks):
        rows = [(r[0], r[1], r[2]) for r in known.where(F.col("_block") == i).select("theme", "weight", "vector").collect()]  # a block
        if not rows:
            continue
        shared = spark.sparkContext.broadcast(Phrases.of(rows))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            p = shared.value
            for batch in batches:
                at = batch.schema.get_field_index("best")
                listed, best = batch.column(batch.schema.get_field_index("_v")), batch.column(at).to_pylist()
                fits = [j for j in range(batch.num_rows) if listed[j].is_valid and len(listed[j]) == p.matrix.shape[1]]
                if fits:
                    flat = listed.take(pa.array(fits)).flatten()
                    theme, score = p.best(flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(fits), -1), most)
                    for j, t, s in zip(fits, theme.tolist(), score.tolist(), strict=True):
                        mine = {x["theme"]: x["score"] for x in best[j]}
                        for k, v in zip(t, s, strict=True):
                            mine[p.themes[k]] = max(v, mine.get(p.themes[k], v))
                        best[j] = [{"score": v, "theme": k} for k, v in sorted(mine.items(), key=lambda x: (-x[1], x[0]))[:most]]
                yield batch.set_column(at, batch.schema.field(at), pa.array(best, batch.schema.field(at).type))

        found = found.mapInArrow(run, found.schema)
        if i + 1 < blocks:
            found = scratch.write(found)
            scratch.empty(before)
            before = found
    return found.drop("_v")


def of_documents(chunks: DataFrame, key: str, most: int = 2) -> DataFrame:
    """(key, theme, score, place): of the lists of a document's chunks the best themes, a theme's score its best in any chunk."""
    one = chunks.select(key, F.inline("best")).groupBy(key, "theme").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "theme"))
    return one.withColumn("place", place).where(F.col("place") <= most).select(key, "theme", "score", "place")


def close_themes(found: DataFrame, key: str, within: float = SECOND) -> DataFrame:
    """(key, theme, score, place) of a list of best themes: the first, and others not further than ``within`` behind it."""
    top = F.get("best", F.lit(0))["score"]
    each = found.select(key, top.alias("_top"), F.posexplode("best").alias("_i", "_t"))
    return each.where(F.round(F.col("_top") - F.col("_t.score"), DIGITS) <= within).select(key, F.col("_t.theme").alias("theme"), F.col("_t.score").alias("score"), (F.col("_i") + 1).alias("place"))


def with_keywords(similarity: Column, in_title: Column, in_text: Column) -> Column:
    """A similarity with what keywords add; without one the keywords alone decide."""
    hits = in_title.cast("int") + in_text.cast("int")
    alone = F.get(F.array(*map(F.lit, FALLBACK)), hits)
    return F.coalesce(F.round(similarity + F.when(in_title, TITLE).when(in_text, TEXT).otherwise(0.0), DIGITS), alone)
