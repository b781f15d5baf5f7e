"""Hard-negative mining with a pivot table.

An inner product becomes a Euclidean distance: an item x gets one more component, sqrt(M^2 - |x|^2), where M is the greatest
norm of all items, and an anchor q gets a zero. Then |x' - q'|^2 = M^2 + |q|^2 - 2 x.q, so the nearest items are those of the
highest scores. The pivot table stores each item's distances to a few pivots. By the triangle inequality the distances of
item and anchor to a pivot bracket their distance, and so their score: runs of items first, by the least and greatest stored
distance, then single items. Only those whose bracket reaches an anchor's running best, or its window, are scored exactly.

Anchors and items meet in cells: a bounded number of anchors, and a share of the items sorted by their nearest pivot. A cell
gives each anchor's best of its items; the best of all cells are ranked per anchor. The first pass finds the positives, the
second the negatives of each positive's window of scores. Every item is indexed and every survivor scored: nothing is lost.
Pivots are picked, each far from the others, from ``sample`` items of the smallest hash, a bounded sample.

Defined cases: rows with a null id, label, vector or component, or a component that is not finite, take no part, nor do
vectors whose squared norm reaches 2^53, as their scores would not be exact. Of vectors of different lengths the shorter one
counts as continued with zeros; an empty vector scores 0. Ties go by the smaller id. Repeated rows each count, but rows with
the anchor's own id are never its positives or negatives, and anchors repeated whole are one anchor. Few or no items of the
same label give few or no positives. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Anchors and items of a cell, about; items that are bracketed together.
ANCHORS, ITEMS, SPAN = 1_024, 32_768, 2_048
PIVOTS, SAMPLE = 16, 2_000
_LOW = -(1 << 62)


def usable(df: DataFrame, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """Rows (id, label, v) that take part; v holds floor(256 x) of each component, as doubles."""
    rows = df.select(vec_id.cast("long").alias("id"), label.cast("long").alias("label"), vector.cast("array<double>").alias("raw"))
    finite = ~F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("raw", lambda x: F.floor(F.least(F.greatest(x * 256, F.lit(-2.0**60)), F.lit(2.0**60))).cast("double"))
    kept = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull() & finite).select("id", "label", whole.alias("v"))
    return kept.where(_norm("v") < 2.0**53)


def _norm(v: str) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)


def _matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """A column of arrays as rows of a matrix, short ones continued with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    n = max(width, int(sizes.max()) if len(sizes) else 0)
    if (sizes == n).all():
        return flat.reshape(len(sizes), n)
    out = np.zeros((len(sizes), n))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _wide(m: np.ndarray, n: int) -> np.ndarray:
    return m if m.shape[1] == n else np.pad(m, ((0, 0), (0, n - m.shape[1])))


class Pivots:
    """Pivots with the component that is added to items, and the greatest norm of all items."""

    def __init__(self, sample: np.ndarray, top: float, count: int = PIVOTS):
        self.top = top
        raised = self._raised(sample)
        at = [int(np.argmax(((raised - raised.mean(0)) ** 2).sum(1)))]
        away = ((raised - raised[at[0]]) ** 2).sum(1)
        while len(at) < min(count, len(sample)) and away.max() > 0:
            at.append(int(np.argmax(away)))
            away = np.minimum(away, ((raised - raised[at[-1]]) ** 2).sum(1))
        self.points, self.extra = sample[at], raised[at, -1]
        self.square = (raised[at] ** 2).sum(1)

    def _raised(self, items: np.ndarray) -> np.ndarray:
        return np.column_stack([items, np.sqrt(np.maximum(self.top - (items**2).sum(1), 0))])

    def _to(self, points: np.ndarray, extra: np.ndarray, square: np.ndarray) -> np.ndarray:
        n = max(points.shape[1], self.points.shape[1])
        product = _wide(points, n) @ _wide(self.points, n).T + extra[:, None] * self.extra
        return np.sqrt(np.maximum(square[:, None] + self.square - 2 * product, 0))

    def of_items(self, items: np.ndarray) -> np.ndarray:
        norm = (items**2).sum(1)
        return self._to(items, np.sqrt(np.maximum(self.top - norm, 0)), np.full(len(items), self.top))

    def of_anchors(self, anchors: np.ndarray) -> np.ndarray:
        return self._to(anchors, np.zeros(len(anchors)), (anchors**2).sum(1))


def fit(items: DataFrame, sample: int = SAMPLE, count: int = PIVOTS) -> Pivots | None:
    """Pivots from the ``sample`` items of the smallest hash; None without items."""
    top = items.agg(F.max(_norm("v"))).first()[0]
    if top is None:
        return None
    some = items.orderBy(F.xxhash64("id", "label"), "id").limit(sample).select("v").collect()
    return Pivots(_matrix(pa.array([r[0] for r in some], pa.list_(pa.float64()))), top, count)


def pivot_table(items: DataFrame, pivots: Pivots) -> DataFrame:
    """Items (slot, id, label, v) with ``away``, the distances to all pivots, and the nearest pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = pivots.of_items(_matrix(batch.column("v"))) if batch.num_rows else np.empty((0, len(pivots.points)))
            flat = pa.array(away.ravel(), pa.float64())
            ends = pa.array(np.arange(len(away) + 1, dtype=np.int32) * away.shape[1], pa.int32())
            near = pa.array(away.argmin(1).astype(np.int32) if len(away) else np.empty(0, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, flat), near], [*batch.schema.names, "away", "near"])

    # places in the table, not ids, are dealt to cells: rows that repeat an id spread too
    return items.select(F.monotonically_increasing_id().alias("slot"), "id", "label", "v").mapInArrow(run, "slot long, id long, label long, v array<double>, away array<double>, near int")


def _best(scores: np.ndarray, ids: np.ndarray, fit_: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the k highest of the scores that fit, and ties of the k-th: (row, score, id)."""
    s = np.where(fit_, scores, -np.inf)
    if s.shape[1] > k:
        least = -np.partition(-s, k - 1, axis=1)[:, k - 1]
        fit_ = fit_ & (s >= least[:, None])
    row, column = np.nonzero(fit_)
    return row, s[row, column].astype(np.int64), ids[column]


class _Running:
    """The k best (score, id) of each of n rows so far."""

    def __init__(self, n: int, k: int):
        self.k, self.row, self.score, self.id = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.least = np.full(n, _LOW, np.int64)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(row):
            return
        row, score, ids = (np.concatenate(x) for x in ((self.row, row), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        stay = place < self.k
        self.row, self.score, self.id = row[stay], score[stay], ids[stay]
        last = place == self.k - 1
        self.least[row[last]] = score[last]


class _Cell:
    """The anchors of a cell, and what is found for them while its items go by."""

    def __init__(self, rows: pa.Table, pivots: Pivots):
        self.pivots = pivots
        self.key, self.id, self.label = (rows[n].to_numpy() for n in ("slot", "id", "label"))
        self.q = _matrix(rows["v"].combine_chunks())
        self.away = pivots.of_anchors(self.q)
        self.square = (self.q**2).sum(1)

    def bracket(self, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Highest and lowest scores of anchors with items, or runs of items, whose distances to pivots lie in [near, far]."""
        low, high = np.zeros((len(self.q), len(near))), np.full((len(self.q), len(near)), np.inf)
        for p in range(self.away.shape[1]):
            a = self.away[:, p, None]
            np.maximum(low, np.maximum(near[:, p] - a, a - far[:, p]), out=low)
            np.minimum(high, a + far[:, p], out=high)
        slack = 1e-6 * (self.pivots.top**0.5 + np.sqrt(self.square))[:, None]
        whole = (self.pivots.top + self.square)[:, None]
        return (whole - np.maximum(low - slack, 0) ** 2) / 2 + 1, (whole - (high + slack) ** 2) / 2 - 1

    def wanted(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores below the first, or above the second, change nothing for an anchor."""
        raise NotImplementedError

    def take(self, anchors: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, may: np.ndarray) -> None:
        raise NotImplementedError

    def items(self, rows: pa.Table) -> None:
        v, away = _matrix(rows["v"].combine_chunks()), _matrix(rows["away"].combine_chunks())
        ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        for at in range(0, len(ids), SPAN):
            some = slice(at, at + SPAN)
            d = away[some]
            least, most = self.wanted()
            upper, lower = self.bracket(d.min(0)[None], d.max(0)[None])
            open_ = np.flatnonzero((upper[:, 0] >= least) & (lower[:, 0] <= most))
            if not len(open_):
                continue
            upper, lower = self._of(open_).bracket(d, d)
            may = (upper >= least[open_, None]) & (lower <= most[open_, None])
            rows_in, items_in = may.any(1), may.any(0)
            if not rows_in.any():
                continue
            open_, x = open_[rows_in], v[some][items_in]
            n = max(self.q.shape[1], x.shape[1])
            scores = _wide(self.q[open_], n) @ _wide(x, n).T
            self.take(open_, scores, ids[some][items_in], labels[some][items_in], may[np.ix_(rows_in, items_in)])

    def _of(self, anchors: np.ndarray) -> _Cell:
        part = object.__new__(_Cell)
        part.pivots, part.q, part.away, part.square = self.pivots, self.q[anchors], self.away[anchors], self.square[anchors]
        return part


class _Positives(_Cell):
    def __init__(self, rows: pa.Table, pivots: Pivots, count: int):
        super().__init__(rows, pivots)
        self.best = _Running(len(self.id), count)

    def wanted(self) -> tuple[np.ndarray, np.ndarray]:
        return self.best.least, np.full(len(self.id), 1 << 62)

    def take(self, anchors, scores, ids, labels, may) -> None:
        row, score, found = _best(scores, ids, may & (self.label[anchors, None] == labels) & (self.id[anchors, None] != ids), self.best.k)
        self.best.add(anchors[row], score, found)

    def result(self) -> dict[str, np.ndarray]:
        b = self.best
        return {"anchor": self.key[b.row], "id": b.id, "score": b.score}


class _Negatives(_Cell):
    def __init__(self, rows: pa.Table, pivots: Pivots, count: int, low: int, high: int):
        super().__init__(rows, pivots)
        lists = rows["positive_scores"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        self.first = np.cumsum(sizes) - sizes
        self.of = np.repeat(np.arange(len(sizes)), sizes)
        self.p_score = lists.flatten().to_numpy()
        self.p_id = rows["positive_ids"].combine_chunks().flatten().to_numpy()
        # least and greatest whole scores s with low * p <= 100 * s <= high * p
        self.low, self.high = -((-low * self.p_score) // 100), (high * self.p_score) // 100
        self.best = _Running(len(self.of), count)

    def wanted(self) -> tuple[np.ndarray, np.ndarray]:
        least, most = np.full(len(self.id), 1 << 62), np.full(len(self.id), _LOW)
        on = self.low <= self.high
        np.minimum.at(least, self.of[on], np.maximum(self.low, self.best.least)[on])
        np.maximum.at(most, self.of[on], self.high[on])
        return least, most

    def take(self, anchors, scores, ids, labels, may) -> None:
        may = may & (self.label[anchors, None] != labels) & (self.id[anchors, None] != ids)
        place = np.full(len(self.id), -1)
        place[anchors] = np.arange(len(anchors))
        windows = np.flatnonzero(place[self.of] >= 0)
        nth = windows - self.first[self.of[windows]]
        for j in range(int(nth.max()) + 1 if len(nth) else 0):
            w = windows[nth == j]
            at = place[self.of[w]]
            s = scores[at]
            row, score, found = _best(s, ids, may[at] & (s >= np.maximum(self.low, self.best.least)[w, None]) & (s <= self.high[w, None]), self.best.k)
            self.best.add(w[row], score, found)

    def result(self) -> dict[str, np.ndarray]:
        b = self.best
        a = self.of[b.row]
        return {"anchor": self.key[a], "nth": b.row - self.first[a], "anchor_id": self.id[a], "positive_id": self.p_id[b.row], "positive_score": self.p_score[b.row], "id": b.id, "score": b.score}


def _search(table: DataFrame, anchors: DataFrame, groups: int, cells: int, pivots: Pivots, kind: type[_Cell], schema: str, *args: int) -> DataFrame:
    """Every group of anchors against every cell of items: what each cell finds."""
    extra = [c for c in ("positive_ids", "positive_scores") if c in anchors.columns]
    none = F.array().cast("array<double>")
    left = anchors.select("g", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("c"), F.lit(-1).alias("near"), "slot", "id", "label", "v", none.alias("away"), *extra)
    right = table.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.pmod("slot", F.lit(cells)).cast("int").alias("c"), "near", "slot", "id", "label", "v", "away", *[F.array().cast("array<long>").alias(c) for c in extra]
    )
    # anchors come first in a cell, then its items from pivot to pivot
    ordered = left.union(right).repartition("g", "c").sortWithinPartitions("g", "c", "near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, at = None, [], None

        def out(found: dict[str, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in found.items()})

        for batch in batches:
            g, c, near = (batch.column(n).to_numpy() for n in ("g", "c", "near"))
            edge = np.flatnonzero((np.diff(g) != 0) | (np.diff(c) != 0) | ((near[1:] < 0) != (near[:-1] < 0))) + 1
            for x, y in zip([0, *edge.tolist()], [*edge.tolist(), len(g)], strict=True):
                if x == y:
                    continue
                if (g[x], c[x]) != at:
                    if cell is not None:
                        yield out(cell.result())
                    cell, held, at = None, [], (g[x], c[x])
                rows = pa.Table.from_batches([batch.slice(x, y - x)])
                if near[x] < 0:
                    held.append(rows)
                    continue
                if cell is None and held:
                    cell, held = kind(pa.concat_tables(held), pivots, *args), []
                if cell is not None:
                    cell.items(rows)
        if cell is not None:
            yield out(cell.result())

    return ordered.mapInArrow(run, schema)


def mine(items: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """For each anchor and each of its positives, the hardest negatives in the positive's window of scores.

    ``items`` has id, label and v (see ``usable``). Positives are the first items of the anchor's label, negatives the first of
    other labels with ``low * positive_score <= 100 * negative_score <= high * positive_score``.
    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = items.sparkSession
    pivots = fit(items)
    if pivots is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    scratch = Scratch(spark)
    table = scratch.write(pivot_table(items, pivots))
    picked = scratch.write(items.where(is_anchor).distinct().select(F.monotonically_increasing_id().alias("slot"), "id", "label", "v"))
    n, wanted = table.count(), picked.count()
    groups = max(1, -(-wanted // ANCHORS))
    cells = max(spark.sparkContext.defaultParallelism, -(-n // ITEMS))
    anchors = picked.withColumn("g", F.pmod(F.xxhash64("slot"), F.lit(groups)).cast("int"))
    first = _search(table, anchors, groups, cells, pivots, _Positives, "anchor long, id long, score long", positives)
    of_anchor = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    ranked = first.withColumn("rank", F.row_number().over(of_anchor)).where(F.col("rank") <= positives)
    lists = ranked.groupBy(F.col("anchor").alias("slot")).agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    known = scratch.write(anchors.join(lists, "slot").select("g", "slot", "id", "label", "v", F.col("p.id").alias("positive_ids"), F.col("p.score").alias("positive_scores")))
    kinds = "anchor long, nth long, anchor_id long, positive_id long, positive_score long, id long, score long"
    second = _search(table, known, groups, cells, pivots, _Negatives, kinds, negatives, low, high)
    of_positive = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id")
    found = scratch.write(second.withColumn("rank", F.row_number().over(of_positive)).where(F.col("rank") <= negatives).drop("anchor", "nth"))
    scratch.empty(table, picked, known)
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


#: The same rows from scores of all anchors with all rows.
ORACLE = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w ::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
"""
