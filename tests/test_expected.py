"""The register of expected topics on literal rows and against a loop, and names inside texts against all pairs."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from harrier.operators import expected, relevance
from harrier.plans import decisions
from harrier.plans.situations import situations

ARTICLES = "id long, source string, day date, kind string, text string, name string, zone string, package boolean"
POINTS = "id string, type string, text string, zone string, told string, detected date, out boolean"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def run(spark, old, articles, points, today, active=()):
    a = spark.createDataFrame(articles, ARTICLES)
    ids = spark.createDataFrame([(x,) for x in active], "id long")
    out = expected.advance(old, expected.topics(a, ids, str(today)), spark.createDataFrame(points, POINTS), str(today))
    return spark.createDataFrame(out.collect(), expected.SCHEMA)


def brute(old, articles, points, today, active=()):
    """The same over plain rows: {key: state}."""
    groups = {}
    for i, source, at, kind, text, name, zone, package in articles:
        if kind is None or at is None or at < today - dt.timedelta(365) or i in active:
            continue
        text, name = (None, "digital omnibus") if package else (text or None, None if text else (name or "").lower() or None)
        zone = "Europe" if package else zone or "Europe"
        groups.setdefault((kind, text, name, zone, None if text or name else i), {})[i] = (at, source)
    state = dict(old)
    for key, own in groups.items():
        order = sorted(own, key=lambda i: (-own[i][0].toordinal(), i))
        days, was = [x[0] for x in own.values()], old.get(key)
        first = min([*days, was["first"]] if was else days)
        kept = {"status": was["status"], "became": was["became"], "point": was["point"]} if was else {"status": "pressenti", "became": None, "point": None}
        state[key] = {"first": first, "last": max(days), "ids": order[:12], "n": len(own), "sources": len({x[1] for x in own.values()}), **kept}
    out = {}
    for key, s in state.items():
        kind, text, name, zone, _ = key
        if kind != "avis" and s["status"] != "devenu_projet" and (text or name):
            fits = [
                (at, i) for i, type_, t, z, told, at, is_out in points
                if type_ in expected.PROMOTING and is_out and at >= s["first"] and (z or "Europe") == zone and (t == text if text else name in (told or "").lower())
            ]
            if fits:
                at, i = min(fits)
                s = {**s, "status": "devenu_projet", "became": at, "point": i}
        age = lambda at: (today - at).days
        if not (age(s["became"]) > 28 if s["status"] == "devenu_projet" else age(s["last"]) > (183 if kind == "avis" else 365)):
            out[key] = s
    return out


def flat(rows):
    return sorted((r["kind"], r["text"] or "", (r["name"] or "").lower(), r["zone"], r["first_signal"], r["last_signal"], r["articles"], r["n"], r["sources"], r["status"], str(r["became"]), str(r["key_point"])) for r in rows)


def flat_brute(state):
    return sorted((k[0], k[1] or "", k[2] or "", k[3], s["first"], s["last"], s["ids"], s["n"], s["sources"], s["status"], str(s["became"]), str(s["point"])) for k, s in state.items())


def test_lives_of_topics(spark):
    empty = spark.createDataFrame([], expected.SCHEMA)
    first = [
        (1, "a", day(0), "pressenti", "NIS2", None, "FR", False),
        (2, "b", day(5), "pressenti", "NIS2", None, "FR", False),
        (2, "b", day(5), "pressenti", "NIS2", None, "FR", False),  # repeated
        (3, "a", day(5), "pressenti", None, "Cyber Résilience Act", "", None),
        (4, "a", day(6), "evolution", "GDPR", None, "DE", True),  # the package, whatever its text and zone
        (5, "c", day(6), "evolution", "NIS2", "x", "IT", True),
        (6, "c", day(6), "avis", "NIS2", None, "FR", False),
        (7, "c", day(6), "pressenti", None, None, None, None),
        (8, "c", None, "pressenti", "DSA", None, "FR", False),
        (9, "c", day(6), None, "DSA", None, "FR", False),
        (10, "c", day(6), "pressenti", "DSA", None, "FR", False),  # in an active key point
    ]
    one = run(spark, empty, first, [], day(7), [10])
    got = {(r["kind"], r["text"], r["name"]): r for r in one.collect()}
    assert len(got) == 5
    assert got["pressenti", "NIS2", None]["articles"] == [2, 1] and got["pressenti", "NIS2", None]["n"] == 2
    assert got["evolution", None, "Digital Omnibus"]["articles"] == [4, 5] and got["evolution", None, "Digital Omnibus"]["zone"] == "Europe"
    assert flat(run(spark, one, first, [], day(7), [10]).collect()) == flat(one.collect())  # again: nothing changes
    points = [
        ("k1", "adopte", "NIS2", "FR", "", day(3), True),
        ("k0", "adopte", "NIS2", "FR", "", day(4), True),
        ("k2", "echeance", None, "", "the cyber resilience act", day(8), True),  # not of a type that promotes
        ("k3", "adopte", None, "", "the cyber resilience act", day(8), False),  # guidance only
        ("k4", "a_qualifier", None, None, "On the CYBER RESILIENCE ACTs", day(9), True),
        ("k5", "adopte", "NIS2", "DE", None, day(1), True),
    ]
    two = run(spark, one, [], points, day(10))
    got = {(r["kind"], r["text"], r["name"]): (r["status"], r["became"], r["key_point"]) for r in two.collect()}
    assert got["pressenti", "NIS2", None] == ("devenu_projet", day(3), "k1")
    assert got["pressenti", None, "Cyber Résilience Act"] == ("devenu_projet", day(9), "k4")
    assert got["avis", "NIS2", None] == ("pressenti", None, None)  # an opinion is never promoted
    late = run(spark, two, [], [], day(3 + 29))
    assert {(r["kind"], r["text"], r["name"]) for r in late.collect()} == set(got) - {("pressenti", "NIS2", None)}
    assert {r["kind"] for r in run(spark, two, [], [], day(6 + 184)).collect()} == {"evolution", "pressenti"}
    assert run(spark, two, [], [], day(6 + 366)).count() == 0
    assert [r["kind"] for r in two.orderBy(*expected.shown_order()).collect()] == ["evolution", "pressenti", "avis", "pressenti", "pressenti"]


def test_runs_against_a_loop(spark):
    rng = random.Random(7)
    table, state = spark.createDataFrame([], expected.SCHEMA), {}
    for week in range(4):
        today = day(150 * week)
        articles = [
            (i, rng.choice("abc"), today - dt.timedelta(rng.randint(0, 200)), rng.choice(["pressenti", "evolution", "avis", None]), rng.choice(["T1", "T1", "T2", "", None]),
             rng.choice(["Ab", "cable law", "able", None, ""]), rng.choice(["FR", "Europe", "", None]), rng.random() < 0.1)
            for i in range(1000 * week, 1000 * week + 80)
        ]
        points = [
            (f"k{week}-{i}", rng.choice(["adopte", "proposition", "echeance"]), rng.choice(["T1", "T3", None]), rng.choice(["FR", "", None, "DE"]), rng.choice([None, "a Cable Law", "tab", "digital omnibus x"]),
             today - dt.timedelta(rng.randint(0, 40)), rng.random() < 0.5)
            for i in range(12)
        ]
        active = [a[0] for a in articles if rng.random() < 0.1]
        table, state = run(spark, table, articles, points, today, active), brute(state, articles, points, today, active)
        assert flat(table.collect()) == flat_brute(state)
        assert state


def test_named_in(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ab ç") for _ in range(n))
    names = list({word(rng.randint(0, 7)) for _ in range(60)}) + [None]
    texts = list({word(rng.randint(0, 30)) for _ in range(40)}) + [None]
    a, b = spark.createDataFrame([(x,) for x in names], "name string"), spark.createDataFrame([(x,) for x in texts], "told string")
    got = sorted(tuple(r) for r in expected.named_in(a, b, "name", "told").select("name", "told").collect())
    assert got == sorted((x, y) for x in names for y in texts if x and y and x in y)
    plan = expected.named_in(a, b, "name", "told")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert expected.named_in(a.limit(0), b, "name", "told").where(F.lit(True)).count() == 0


def test_topics_are_made_once(spark):
    """What the passes of a run read are tables: no pass makes the topics or the register anew."""
    articles = spark.createDataFrame([(1, "a", day(0), "pressenti", "NIS2", None, "FR", False), (2, "b", day(0), "pressenti", None, "Ab", "FR", False)], ARTICLES)
    points = spark.createDataFrame([(f"k{n}", "adopte", "NIS2", "FR", "an AB", day(1 + n // 3), True) for n in (4, 2, 1, 0)], POINTS)
    now = expected.topics(articles, spark.createDataFrame([], "id long"), str(day(7)))
    after = expected.advance(spark.createDataFrame([], expected.SCHEMA), now, points, str(day(7)))
    for made in (now, after):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Aggregate" not in plan
    assert {(r["text"], r["name"], r["became"], r["key_point"]) for r in after.collect()} == {("NIS2", None, day(1), "k0"), (None, "Ab", day(1), "k0")}


def test_decisions_are_compiled(spark, capsys):
    """The JVM compiles no method of more than 8000 bytes; the columns that the register takes along count too."""
    more = ["l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "day", "key_text", "unnamed_text", "status"]
    made = situations(spark, "/root/testdata/sf0.001", "l_partkey", "l_suppkey", "l_returnflag")
    for decided, name in ((decisions.alerted, "alert"), (relevance.expected_kind, "kind")):
        capsys.readouterr()
        decided(made).select(name, *more).explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) <= 8000
