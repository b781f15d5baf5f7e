"""Every registered query against its SQL in DuckDB, rows compared whole."""

import math
from decimal import Decimal

import duckdb
import pytest

from harrier.plans import catalogue


@pytest.fixture(scope="session")
def con(sf_dir):
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float) and not math.isnan(v):
        return round(v, 5)
    return float(v) if isinstance(v, Decimal) else v


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_same_rows(spark, sf_dir, con, name):
    df = catalogue.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    mine = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    theirs = con.sql(f"SELECT {', '.join(columns)} FROM ({catalogue.oracle_sql()[name]})").fetchall()
    assert mine == sorted((tuple(map(plain, r)) for r in theirs), key=repr)
    assert mine


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    """The smallest tables with a row of nulls and a repeated row more."""
    folder = tmp_path_factory.mktemp("odd")
    for t in TABLES:
        df = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
        nulls = spark.createDataFrame([tuple([None] * len(df.columns))], df.schema)
        df.union(nulls).union(df.limit(1)).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for t in TABLES:
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(0).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_odd_and_empty_tables(spark, odd_dir, empty_dir, name):
    """No query fails on nulls, repeated rows or empty tables."""
    for folder in (odd_dir, empty_dir):
        catalogue.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
