"""Greedy duplicate groups against a plain loop."""

import random

from harrier.operators import duplicates


def brute(rows):
    owner, out = {}, {}
    for i, source, keys, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        keys = list(dict.fromkeys(k for k in keys or [] if k is not None))
        lead = next((owner[k][0] for k in keys if k in owner and owner[k][1] != source), None)
        out[i] = lead
        if lead is None:
            for k in keys:
                owner.setdefault(k, (i, source))
    return out


def test_greedy_groups(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "c", None]), [rng.choice("klmnopqrst") + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 3))], rng.randint(0, 20)) for i in range(120)]
    rows += [(200, "a", None, 1), (201, "b", [None, "k1"], 0)]
    df = spark.createDataFrame(rows, "id int, source string, keys array<string>, day int")
    got = {r["id"]: r["leader"] for r in duplicates.greedy_groups(df, "id", "source", "keys", ["day"]).collect()}
    assert got == brute(rows)
    assert duplicates.greedy_groups(df.limit(0), "id", "source", "keys", ["day"]).count() == 0


def test_copies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None), (5, "c")], "id int, source string")
    leaders = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 1), (5, None)], "id int, leader int")
    assert [tuple(r) for r in duplicates.copies(df, leaders, "id", "source").collect()] == [(1, 3, 1)]
    assert duplicates.copies(df, leaders.limit(0), "id", "source").count() == 0
