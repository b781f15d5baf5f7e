"""Hard negatives against scores of all pairs, and against the SQL."""

import math
import random
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from harrier.llm import negatives, queries  # noqa: E402

NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, positives=5, found=10, low=30, high=90):
    """Rows (id, label, whole numbers); anchors have an id divisible by 100."""
    out = []
    for a in {(i, label, tuple(v)) for i, label, v in rows if i % 100 == 0}:
        scored = sorted(((-int(sum(x * y for x, y in zip(a[2], v, strict=False))), i, label) for i, label, v in rows if i != a[0]))
        for s, p, _ in [x for x in scored if x[2] == a[1]][:positives]:
            fits = [x for x in scored if x[2] != a[1] and low * -s <= 100 * -x[0] <= high * -s][:found]
            out += [(a[0], p, k, n, -s, -t) for k, (t, n, _) in enumerate(fits, 1)]
    return sorted(out)


def usable(rows):
    out = []
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole = [float(math.floor(256 * x)) for x in v]
            if sum(x * x for x in whole) < 2**53:
                out.append((i, label, whole))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, label, v, 7, [1.0], 2) for i, label, v in rows], "vec_id long, label int, embedding array<double>, id long, v array<double>, slot int").repartition(5)


def mined(spark, rows):
    items = negatives.usable(frame(spark, rows), F.col("vec_id"), F.col("label"), F.col("embedding"))
    return sorted(tuple(r) for r in negatives.mine(items, F.col("id") % 100 == 0).select(*NAMES).collect())


def clustered(n, seed, dim=6, labels=3):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    return [(i * 5, rng.randrange(labels), [c + rng.gauss(0, 0.3) for c in middle[rng.randrange(5)]]) for i in range(n)]


def test_odd_rows(spark):
    rows = clustered(300, 1)
    one = [0.5, -0.25, 0.125, 1.0, 0.0, -1.0]
    rows += [(5000 + i, i % 2, one) for i in range(150)]  # one vector many times: ties by id
    rows += [(5000, 0, one), (5000, 0, one), (200, 1, rows[7][2])]  # repeated rows, a repeated anchor, an id of two rows
    rows += [(None, 1, one), (6100, None, one), (6200, 1, None), (6300, 1, [0.1, None, 0.2, 0.3, 0.4, 0.5]), (6400, 1, [float("nan")] * 6), (6500, 2, [float("inf")] * 6)]
    rows += [(6600, 1, []), (6700, 1, [0.5]), (6800, 2, [0.5] * 9), (6900, 2, [1e300] * 6), (7000, 9, one), (7100, 1, [0.0] * 6), (-100, 1, one)]
    assert mined(spark, rows) == brute(usable(rows))
    assert len(brute(usable(rows))) > 500


@pytest.mark.parametrize("rows", [[], [(100, 1, [0.5, 0.5])], [(100, 1, [0.5, 0.5]), (101, 1, [0.5, 0.5]), (102, 2, [0.25, 0.25])], [(100, None, None)]])
def test_few_rows(spark, rows):
    assert mined(spark, rows) == brute(usable(rows))


def test_many_cells_and_groups(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "ITEMS", 60)
    monkeypatch.setattr(negatives, "SPAN", 16)
    rows = [(i * 5, label, v) for i, (_, label, v) in enumerate(clustered(900, 2))]
    assert mined(spark, rows) == brute(usable(rows))


def test_brackets_hold_the_scores():
    import numpy as np

    rng = np.random.default_rng(3)
    items, q = np.floor(rng.normal(0, 80, (500, 24))), np.floor(rng.normal(0, 80, (40, 24)))
    pivots = negatives.Pivots(items[:100], (items**2).sum(1).max())
    assert len(pivots.points) == negatives.PIVOTS
    cell = object.__new__(negatives._Cell)
    cell.pivots, cell.q, cell.away, cell.square = pivots, q, pivots.of_anchors(q), (q**2).sum(1)
    away = pivots.of_items(items)
    upper, lower = cell.bracket(away, away)
    scores = q @ items.T
    assert (lower <= scores).all() and (scores <= upper).all()
    # an item that is a pivot is bracketed exactly, but for the slack
    own = [int(np.flatnonzero((items == p).all(1))[0]) for p in pivots.points]
    assert (upper - lower)[:, own].max() < 10


def test_brackets_leave_items_out():
    """On clustered vectors most items are settled without a score."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    middle = rng.normal(0, 100, (8, 12))
    of = np.sort(rng.integers(0, 8, 8000))
    items = np.floor(middle[of] + rng.normal(0, 3, (8000, 12)))
    pivots = negatives.Pivots(items[::80], (items**2).sum(1).max())
    away = pivots.of_items(items)
    listed = lambda m: pa.array(list(m), pa.list_(pa.float64()))
    anchors = pa.table({"slot": [0, 1], "id": [-1, -2], "label": [0, 0], "v": listed(items[[5, 4000]])})
    scored = []

    class Counting(negatives._Positives):
        def take(self, anchors, scores, ids, labels, may):
            scored.append(int(may.sum()))
            super().take(anchors, scores, ids, labels, may)

    cell = Counting(anchors, pivots, 5)
    order = rng.permutation(8)
    for c in order:
        at = np.flatnonzero(of == c)
        cell.items(pa.table({"id": at, "label": np.zeros(len(at), np.int64), "v": listed(items[at]), "away": listed(away[at])}))
    assert sum(scored) < 2 * 8000 / 2
    want = [sorted(range(8000), key=lambda i, s=items @ a: (-s[i], i))[:5] for a in items[[5, 4000]]]
    assert [cell.best.id[cell.best.row == k].tolist() for k in range(2)] == want


def test_query_and_sql(spark, sf_dir):
    found = queries.queries()["op11_hard_negatives"](spark, sf_dir)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = sorted(con.sql(queries.oracle_sql()["op11_hard_negatives"]).fetchall())
    assert sorted(tuple(r) for r in found.select(*NAMES).collect()) == want and want
    rows = [(r[0], (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2], r[1]) for r in con.sql("SELECT * FROM embeddings").fetchall()]
    assert brute(usable(rows)) == want
