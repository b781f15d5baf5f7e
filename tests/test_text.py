"""Text functions on literal texts."""

from pyspark.sql import functions as F

from harrier.functions import spans


def test_largest_fine(spark):
    far = "x" * 110
    told = {
        "a fine of $5 million": 4_600_000,
        "a 5 million euro penalty": 5_000_000,
        "The firm was fined GBP 14.47m": 16_929_900,
        "fined EUR5 million": 5_000_000,
        "a fine of 2 000 euros, then of 3 million euros": 3_000_000,
        "a fine of 3 million euros, then of 2 000 euros": 3_000_000,
        "a sanction of 1 500 euros and, by a further penalty, of \u20ac1.200.000,50": 1_200_001,
        "fined 1\u202f200\u00a0000\u00a0euros": 1_200_000,
        "fines in 2020, 5 million euros": 5_000_000,
        f"fine {far} 7000 euros": 7000,
        f"7000 euros {far[:70]} fine": 7000,
        f"fine {far}{far} 7000 euros {far[:80]} fine": None,
        f"fine {far} 6000 euros {far} 9000 euros": 6000,
        "a fine of 900 euros": None,
        "a fee of 5 million euros": None,
        "an entrepreneur 5000 fine": None,
        "": None,
    }
    texts = spark.createDataFrame([(t,) for t in [*told, None]], "t string").withColumn("k", F.col("t"))
    rows = spans.largest_fine(spans.spans(texts, "k", "t"), "k").withColumnRenamed("k", "t").collect()
    assert {r["t"]: r["fine"] for r in rows} == told | {None: None}
