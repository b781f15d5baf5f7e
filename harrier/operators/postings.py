"""An inverted index for ranked search: postings in blocks with an upper bound of their score, read block by block.

Documents are dealt to segments of about ``SEGMENT``, or of ``WORDS`` words where they are long, by their length, so that those
of a segment are alike. A row of the index is a block: the postings of one word in one segment, with the most that the word
gives to one of its documents, but for the word's weight. Rows lie in buckets by word,
so that a question reads the buckets of its own words, and of most blocks the bounds alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .search import B, K1

SEGMENT, BUCKETS, FIRST = 1_024, 64, 8
#: Words of a segment of long documents: what a task counts and sorts.
WORDS = 1 << 20
BLOCK = "segment int, word string, postings array<struct<key:{key},tf:int,len:int>>, df long, most double, bucket int"


def build(docs: DataFrame, key: str, words: str, path: str, segment: int = SEGMENT, buckets: int = BUCKETS) -> None:
    """Write the index of ``docs`` (``words`` is an array column) to a folder: blocks, and a row of statistics.

    Each document's words are counted in its own row; its distinct words and their counts move once, to the task of its
    segment, which makes the blocks and writes them. The postings of a word that all documents have are spread over all
    segments. A document without words is in no block, one without an array of words does not count in the mean length."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    sized = scratch.write(_counted(docs.select(F.col(key).alias("key"), F.col(words).alias("words"))))
    stats = sized.agg(F.count("*").alias("n_docs"), F.avg("len").alias("mean"), F.min("key").alias("least_key"), F.sum("len").alias("words"))
    stats.write.mode("overwrite").parquet(f"{path}/statistics")
    stats = spark.read.parquet(f"{path}/statistics")
    total, mean = stats.first(), F.broadcast(stats.select("mean"))
    tasks = max(1, min(8, -(-total["n_docs"] // segment)), -(-(total["words"] or 0) // (4 * WORDS)))
    dealt = sized.where("len > 0").join(scratch.write(_lengths(sized, segment)), "len").withColumn("segment", _segment(segment))
    # of a segment's rows none leaves its task again: the groups below hold its column
    said = dealt.select("segment", "key", "len", "said").repartition(tasks, "segment").select("segment", "key", "len", F.inline("said"))
    said = said.groupBy("segment", "word", "key", "len").agg(F.sum("tf").alias("tf")).crossJoin(mean).withColumn("gain", _gain(F.col("tf").cast("double"), F.col("len")))
    blocks = said.groupBy("segment", "word").agg(
        F.sort_array(F.collect_list(F.struct("key", F.col("tf").cast("int").alias("tf"), "len"))).alias("postings"), F.count("*").alias("df"), F.max("gain").alias("most")
    )
    bucket = F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int")
    blocks.withColumn("bucket", bucket).sortWithinPartitions("bucket", "word", "segment").write.mode("overwrite").partitionBy("bucket").option("compression", "zstd").parquet(f"{path}/blocks")
    scratch.leave()


def _counted(docs: DataFrame) -> DataFrame:
    """(key, len, said): the distinct words of ``words`` and how often each stands there, from the sorted array."""
    # a row is exploded to itself: what is in front of that is computed once, however often it is used behind
    once = docs.select("key", F.size("words").alias("len"), F.explode(F.array(F.sort_array("words"))).alias("w"))
    first = lambda i: (i == 0) | ~F.get("w", i).eqNullSafe(F.get("w", i - 1))
    starts = F.filter(F.sequence(F.lit(0), F.col("len") - 1), first)
    none = F.array().cast("array<int>")
    once = once.select("key", "len", "w", F.explode(F.array(F.when(F.col("len") > 0, starts).otherwise(none))).alias("at"))
    tf = lambda i, n: F.coalesce(F.get("at", n + 1), F.col("len")) - i
    return once.select("key", "len", F.transform("at", lambda i, n: F.struct(F.get("w", i).alias("word"), tf(i, n).alias("tf"))).alias("said"))


def _weight(segment: int) -> Column:
    """How much of a segment's places a document takes: one, or more if it is long."""
    return F.greatest(F.lit(1).cast("long"), F.floor(F.col("len").cast("long") * segment / WORDS))


def _lengths(sized: DataFrame, segment: int) -> DataFrame:
    """(len, same, front): documents of each length, and the places of all shorter ones.

    A row for each length, of which a text of n words in all has less than the root of 2n; so they are summed in one task."""
    each = sized.where("len > 0").groupBy("len").agg(F.count("*").alias("same"))
    shorter = Window.orderBy("len").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("front", F.coalesce(F.sum(F.col("same") * _weight(segment)).over(shorter), F.lit(0)))


def _segment(segment: int) -> Column:
    """Documents of one length are dealt by the hash of their key, so a key that is repeated stays together."""
    place = F.pmod(F.xxhash64("key"), F.col("same")) * _weight(segment) + F.col("front")
    return F.floor(place / segment).cast("int")


def _gain(tf: Column, length: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.col("mean")))


class Index:
    """An index that was built to ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.statistics = spark.read.parquet(f"{path}/statistics")
        # an index without blocks has no file to tell its columns
        self.blocks = spark.read.schema(BLOCK.format(key=dict(self.statistics.dtypes)["least_key"])).parquet(f"{path}/blocks")

    def _of(self, words: list[str]) -> DataFrame:
        """The blocks of these words, from their own buckets, with the words' weights."""
        wanted = self.spark.createDataFrame([(w,) for w in sorted(set(words))], "word string")
        own = [r[0] for r in wanted.select(F.pmod(F.xxhash64("word"), F.lit(self.buckets)).cast("int")).distinct().collect()]
        some = self.blocks.where(F.col("bucket").isin(own) & F.col("word").isin(sorted(set(words))))
        df = some.groupBy("word").agg(F.sum("df").alias("all"))  # a row for each word of the question
        weight = F.log(1 + (F.col("n_docs") - F.col("all") + 0.5) / (F.col("all") + 0.5))
        weights = df.crossJoin(F.broadcast(self.statistics)).select("word", weight.alias("weight"), "mean")
        return some.join(F.broadcast(weights), "word")

    def bounds(self, words: list[str]) -> DataFrame:
        """(segment, bound, blocks): the most that a document of each segment can score."""
        return self._of(words).groupBy("segment").agg(F.sum(F.col("weight") * F.col("most")).alias("bound"), F.count("*").alias("blocks"))

    def _scores(self, words: list[str], segments: DataFrame) -> DataFrame:
        opened = self._of(words).join(segments.select("segment"), "segment", "left_semi").select("word", "weight", "mean", F.inline("postings"))
        return opened.groupBy("key").agg(F.round(F.sum(F.col("weight") * _gain(F.col("tf").cast("double"), F.col("len"))), 6).alias("score"))

    def search(self, words: list[str], top: int = 10, first: int = FIRST) -> tuple[DataFrame, DataFrame]:
        """(key, score) of the ``top`` best documents by BM25, ties by key, and (segment, bound, blocks) of the segments opened.

        The ``first`` segments with the highest bounds are opened; of the others only those whose bound reaches the score of
        the last place so far can hold a better document, and they are opened next. Nothing else is read, nothing is missed."""
        scratch = Scratch(self.spark)
        bounds = scratch.write(self.bounds(words))
        best = bounds.orderBy(F.desc("bound"), "segment").limit(first)
        floor = self._scores(words, best).orderBy(F.desc("score"), "key").limit(top).agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
        # scores are rounded, so bounds may fall short of them by that much
        reach = F.col("bound") + 1e-6 >= floor["least"] if floor["n"] == top else F.lit(True)
        opened = scratch.write(bounds.where(reach).unionByName(best).distinct())
        found = scratch.write(self._scores(words, opened).orderBy(F.desc("score"), "key").limit(top))
        scratch.leave(found, opened)
        return found, opened
