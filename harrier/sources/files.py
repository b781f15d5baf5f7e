"""Scans with a default, and sinks of text files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; a missing path is an empty table, a corrupt line a row of nulls that is dropped."""
    try:
        found = spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return found.where(F.col("_bad").isNull()).drop("_bad")


def write_csv(df: DataFrame, path: str) -> None:
    """Semicolons, quotes only where needed and doubled inside, lines ended as spreadsheets expect, a byte order mark in
    front of each file's header, arrays joined by a comma."""
    flat = [F.array_join(c, ", ").alias(c) if k.startswith("array") else F.col(c).cast("string").alias(c) for c, k in df.dtypes]
    quoted = lambda c: F.when(F.rlike(c, F.lit('[";\r\n]')), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(c, F.lit("")))
    line = F.concat_ws(";", *[quoted(c) for c in flat])
    # the first row of each file brings the header
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    head = F.lit("\ufeff" + ";".join(df.columns) + "\r\n")
    df.select(F.when(first, F.concat(head, line)).otherwise(line).alias("value")).write.option("lineSep", "\r\n").text(path)


def write_hot_and_cold(df: DataFrame, path: str, day: str) -> None:
    """By month, so that a reader of recent months opens only those folders. Each task writes its own file of a month: no
    month goes through one task."""
    df.withColumn("month", F.date_format(day, "yyyy-MM")).write.partitionBy("month").parquet(path)


def read_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row for each link of a page: href and text, both from the markup."""
    pattern = r'(?is)<a\s[^>]*href="([^"#][^"]*)"[^>]*>(.*?)</a>'
    hrefs, texts = (F.regexp_extract_all(html, F.lit(pattern), F.lit(i)) for i in (1, 2))
    link = F.explode(F.arrays_zip(hrefs.alias("href"), texts.alias("text"))).alias("link")
    return pages.select("page_id", link).select("page_id", "link.href", F.trim(F.regexp_replace("link.text", "<[^>]+>|\\s+", " ")).alias("text"))


def main_text(html: str = "html"):
    """Paragraphs of a page's article, or else its main part, or else all of it, in order: scripts, styles, comments and
    navigation go first; short paragraphs are noise."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|nav)\b.*?</\1>", " ")
    inner = [F.nullif(F.regexp_extract(bare, rf"(?is)<{tag}\b[^>]*>(.*)</{tag}>", 1), F.lit("")) for tag in ("article", "main")]
    parts = F.regexp_extract_all(F.coalesce(*inner, bare), F.lit(r"(?is)<(p|li|h2|h3)\b[^>]*>(.*?)</\1>"), F.lit(2))
    parts = F.transform(parts, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", " "), r"\s+", " ")))
    return F.array_join(F.filter(parts, lambda x: F.length(x) >= 50), "\n")
