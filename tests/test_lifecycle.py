"""Dates in texts and the name joins on small literal tables."""

import datetime as dt

from pyspark.sql import functions as F

from harrier.functions import dates
from harrier.operators import lifecycle


def found(spark, text, f):
    got = spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("d")).first()["d"]
    return got if got is None else [(x["day"], x["approx"]) for x in got]


def test_all_dates(spark):
    text = "On 2024-02-30 and 2024-02-29, le 1er février 2025, 3.4.2026, March 5, 2027 and août 2028; x2024-01-01."
    want = [(dt.date(2024, 2, 29), False), (dt.date(2025, 2, 1), False), (dt.date(2026, 4, 3), False), (dt.date(2027, 3, 5), False), (dt.date(2028, 8, 1), True)]
    assert found(spark, text, dates.all_dates) == want
    assert found(spark, "", dates.all_dates) == []
    assert found(spark, None, dates.all_dates) is None


def test_deadlines(spark):
    text = "A seminar is due on 2024-05-01. All firms must file by 2024-06-01. The event: comply no later than 2024-07-01! Signed 2024-08-01."
    assert [d for d, _ in found(spark, text, dates.deadlines)] == [dt.date(2024, 6, 1), dt.date(2024, 7, 1)]


def test_sigla_of_names(spark):
    sigla = spark.createDataFrame([(1, "DSA"), (2, "DSA"), (3, "XX")], "doc int, siglum string")
    names = spark.createDataFrame([(1, "Digital Services Act Package"), (2, "Digital Services Act Package"), (4, "Data Sharing Act"), (3, None)], "doc int, name string")
    assert [tuple(r) for r in lifecycle.sigla_of_names(sigla, names, "doc").collect()] == [("DSA", "Digital Services Act Package", 2)]


def test_names_in_longer(spark):
    names = spark.createDataFrame([(1, "Services Act"), (1, "Digital Services Act"), (2, "Services Act"), (3, "Act"), (4, "Act"), (5, "Act"), (1, "Act")], "doc int, name string")
    got = {tuple(r) for r in lifecycle.names_in_longer(names, "doc").collect()}
    assert got == {("Services Act", "Digital Services Act", 1)}
