"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints.

Statistics are taken from whole texts inside Arrow tasks. The trees are fitted on at most ``max_rows`` labelled
documents (a documented bound, chosen by hash) and flattened to numpy node arrays, which score whole batches.

Defined cases: a null or empty text has all statistics 0, fails the base rules and is not kept. Repeated rows and
repeated doc_ids each give a row, an empty table none. Very long texts are taken whole. With no labels, or labels of one kind, there is no model: the base rules decide.
Other columns of the input are ignored by ``score`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain, rows, utf8, windows, word_hashes

#: Statistics the trees see, with the sign of their constraint: -1 lets quality only fall as the statistic grows.
FEATURES = {
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "shout_share": -1,
    "bang_share": -1,
    "pipe_share": -1,
    "mean_word": 0,
    "stop_share": 0,
    "log_words": 0,
    "line_words": 0,
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_SPACES = np.frombuffer(b" \t\n\v\f\r", np.uint8)
_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_TAIL = np.arange(0x80, 0xC0)


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of ``COUNTS`` and the values of ``FEATURES`` of one whole text."""
    data = utf8(text)
    byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, np.int64)
    h = word_hashes(data)
    n = len(h)
    chars = len(data) - int(byte[_TAIL].sum()) - int(byte[_SPACES].sum())
    symbols = int(byte[_SYMBOLS].sum())
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
    dup = len(lines) - len(set(lines))
    repeated = 0
    if n >= 3:
        grams = windows(h, 3)
        _, back, count = np.unique(grams, return_inverse=True, return_counts=True)
        twice = count[back] >= 2
        covered = np.zeros(n, bool)
        for i in range(3):
            covered[i : n - 2 + i] |= twice
        repeated = int(covered.sum())
    upper, lower = int(byte[_UPPER].sum()), int(byte[_LOWER].sum())
    distinct = len(np.unique(h))
    features = [
        symbols / max(chars, 1),
        dup / max(len(lines), 1),
        repeated / max(n, 1),
        upper / max(upper + lower, 1),
        int(byte[33]) / max(n, 1),
        int(byte[124]) / max(n, 1),
        chars / max(n, 1),
        1 - distinct / max(n, 1),
        float(np.log1p(n)),
        n / max(len(lines), 1),
    ]
    return [n, chars, symbols, dup, repeated], features


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf points to itself, so scoring is ``depth`` gathers."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)


def fit_trees(x: np.ndarray, y: np.ndarray, signs: list[int], rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, leaf: int = 8, l2: float = 1.0) -> Trees | None:
    """Boost logistic-loss trees on quantile bins.

    A split on a constrained feature whose children order against its sign is refused, and the middle of the two
    child values bounds what lies below, so the whole sum of trees is monotonic in that feature.
    """
    if not len(y) or y.min() == y.max():
        return None
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    share = float(y.mean())
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    margin = np.full(len(y), base)

    def weight(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + l2), low, high))

    def gain(g, h, w):
        return -(g * w + 0.5 * (h + l2) * w * w)

    def grow(index: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float, step: np.ndarray) -> int:
        me = len(feature)
        own = weight(g[index].sum(), h[index].sum(), low, high)
        for store, v in ((feature, 0), (threshold, np.inf), (left, me), (right, me), (value, rate * own)):
            store.append(v)
        best = (1e-3, None)
        if level < depth and len(index) >= 2 * leaf:
            total_g, total_h = g[index].sum(), h[index].sum()
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                size = len(c) + 1
                of = code[index, j]
                cg, ch, cn = (np.cumsum(np.bincount(of, weights=w, minlength=size))[:-1] for w in (g[index], h[index], np.ones(len(index))))
                wl = np.clip(-cg / (ch + l2), low, high)
                wr = np.clip(-(total_g - cg) / (total_h - ch + l2), low, high)
                won = gain(cg, ch, wl) + gain(total_g - cg, total_h - ch, wr) - gain(total_g, total_h, own)
                won[(cn < leaf) | (len(index) - cn < leaf)] = -1
                if signs[j]:
                    won[(wr - wl) * signs[j] < 0] = -1
                k = int(np.argmax(won))
                if won[k] > best[0]:
                    best = (float(won[k]), (j, k, float(wl[k]), float(wr[k])))
        if best[1] is None:
            step[index] = rate * own
            return me
        j, k, wl, wr = best[1]
        go = code[index, j] <= k
        mid = (wl + wr) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[signs[j]]
        feature[me], threshold[me] = j, float(cuts[j][k])
        left[me] = grow(index[go], g, h, level + 1, *bounds[0], step)
        right[me] = grow(index[~go], g, h, level + 1, *bounds[1], step)
        return me

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        roots.append(grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), 0, -np.inf, np.inf, step))
        margin += step
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots), depth, base)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Trees | None:
    """Fit on at most ``max_rows`` labelled documents, taken by hash of the id whatever their order or file."""
    some = (
        plain(labels, "doc_id", "quality")
        .where("doc_id is not null and quality is not null")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(max_rows)
    )
    # max_rows rows of two numbers: a proven bound for the broadcast
    train = plain(docs, "doc_id", "text").join(F.broadcast(some), "doc_id").mapInArrow(_train_rows, _TRAIN)
    got = train.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *FEATURES).limit(max_rows).toArrow()
    x = np.stack([got.column(n).to_numpy() for n in FEATURES], axis=1) if got.num_rows else np.zeros((0, len(FEATURES)))
    return fit_trees(x, got.column("quality").to_numpy().astype(float), list(FEATURES.values()))


_TRAIN = "doc_id long, quality int, " + ", ".join(f"{n} double" for n in FEATURES)


def _train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for doc_id, text, quality in rows(batches, "doc_id", "text", "quality"):
        out.append((doc_id, int(quality > 0), *statistics(text)[1]))
    if out:
        columns = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int32(), *[pa.float64()] * len(FEATURES)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "quality", *FEATURES])


def _scorer(trees: Trees | None, min_words: int, max_repeat: int, cut: float, carry: list[str]):
    """carry: columns handed on as they are; with any, only kept rows are returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            got = [statistics(texts[i].as_py()) for i in range(batch.num_rows)]
            counts = np.array([c for c, _ in got], np.int64).reshape(-1, len(COUNTS))
            x = np.array([f for _, f in got]).reshape(-1, len(FEATURES))
            failed = (counts[:, 0] < min_words) | (100 * counts[:, 4] > max_repeat * counts[:, 0])
            score = np.ones(len(x)) if trees is None else 1 / (1 + np.exp(-trees.margin(x)))
            kept = ~failed & (score >= cut)
            if carry:
                yield batch.select(carry).filter(pa.array(kept))
                continue
            columns = {"doc_id": batch.column(batch.schema.get_field_index("doc_id"))}
            columns |= {n: pa.array(counts[:, i]) for i, n in enumerate(COUNTS)}
            yield pa.RecordBatch.from_pydict(columns | {"base_failed": pa.array(failed), "kept": pa.array(kept), "score": pa.array(score)})

    return run


def score(docs: DataFrame, trees: Trees | None, min_words: int = 50, max_repeat: int = 50, cut: float = 0.5) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept and the model's score (1 without a model)."""
    counts = ", ".join(f"{n} long" for n in COUNTS)
    return plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        _scorer(trees, min_words, max_repeat, cut, []), f"doc_id long, {counts}, base_failed boolean, kept boolean, score double"
    )


def keep(docs: DataFrame, trees: Trees | None, min_words: int = 50, max_repeat: int = 50, cut: float = 0.5) -> DataFrame:
    """The documents that pass, with all their columns."""
    return docs.mapInArrow(_scorer(trees, min_words, max_repeat, cut, docs.columns), docs.schema)
