"""What a run takes in: gates on new items, seen titles, source states, stamped work, keyword lists, links of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import domain, normal_url
from ..sources.feeds import resolve
from ..sources.pages import page_links

#: Days a first visit looks back, and days an item is kept.
FIRST_VISIT, KEPT = 60, 365
#: Endings of addresses that are pages to read; others are files.
PAGES = "asp aspx cfm do htm html jsf jsp pdf php shtml xhtml".split()


def admitted(items: DataFrame, seen: DataFrame, visited: DataFrame, key: str, origin: str, day: str, floor: str, as_of: str) -> DataFrame:
    """Items never seen, neither before the floor nor past the time they are kept; of an origin visited for the first time
    only dated and recent ones. An item without a day of a known origin passes."""
    today = F.lit(as_of).cast("date")
    known = visited.select(origin, F.lit(True).alias("_known")).distinct()
    new = items.join(seen.select(key).distinct(), key, "left_anti").join(known, origin, "left")
    age = F.datediff(today, F.col(day))
    fresh = F.coalesce((F.col(day) >= F.lit(floor).cast("date")) & (age <= KEPT), F.col("_known"))
    return new.where(F.when(F.col("_known"), fresh).otherwise(fresh & (age <= FIRST_VISIT))).drop("_known")


def unseen(items: DataFrame, seen: DataFrame, keys: list[str], order: list[str], identity: str) -> DataFrame:
    """The first item of each key that was not seen under that key. A grouped minimum, no window."""
    first = items.join(seen.select(*keys).distinct(), keys, "left_anti").groupBy(*keys).agg(F.min(F.struct(*order)).alias("_f"))
    return first.select(*keys, F.col(f"_f.{identity}").alias(identity))


def source_states(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """(key, found, failures, to_remove): ``now`` has found and failed, ``before`` failures; a failure adds one to the run
    of failures, a success ends it; two in a row mark a source for removal. Sources not read keep their state."""
    both = now.join(before.select(key, F.col("failures").alias("_b")), key, "full_outer")
    failures = F.when(F.col("failed").isNull(), F.col("_b")).when(F.col("failed"), F.coalesce("_b", F.lit(0)) + 1).otherwise(0)
    return both.select(key, F.coalesce("found", F.lit(0)).alias("found"), failures.cast("long").alias("failures")).withColumn("to_remove", F.col("failures") >= 2)


def unfinished(df: DataFrame, stamp: str, current: str, order: list[Column], budget: int) -> DataFrame:
    """The rows whose stamp is not the current one, as many as the budget allows; the next run finds the rest again."""
    return df.where(F.col(stamp).isNull() | (F.col(stamp) != current)).orderBy(*order).limit(budget)


def keyword_lists(wide: DataFrame, key: str, groups: list[str]) -> DataFrame:
    """(grp, label, variants): columns of keywords turned to rows, empty cells dropped, a list for each group and label."""
    long = wide.unpivot([key], groups, "grp", "label").where("label is not null and label <> ''")
    return long.groupBy("grp", "label").agg(F.array_sort(F.collect_set(F.col(key))).alias("variants"))


def _readable(path: Column) -> Column:
    """Whether a path ends in a page's name: without an ending, or with one of a page."""
    ending = F.lower(F.regexp_extract(path, r"\.([A-Za-z][A-Za-z0-9]{1,4})/?$", 1))
    return ending.isin("", *PAGES)


def article_links(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """(key, link, title, day, summary): the links of a page that may be articles, each once, with the day that stands near.

    An article is on the page's host, on a page of its own that is no file, and has a title of 25 to 260 characters. Menus,
    headers, footers, forms and asides are left out."""
    found = page_links(pages, key, html, url).withColumn("link", resolve(F.col("href"), F.col("url")))
    path = F.coalesce(F.try_parse_url("link", F.lit("PATH")), F.lit(""))
    elsewhere = F.col("href").startswith("#") | ~F.rlike("link", F.lit("^https?://")) | (domain(F.col("link")) != domain(F.col("url")))
    own = normal_url(F.col("link"))
    kept = found.where(~elsewhere & F.length("title").between(25, 260) & (F.length(F.replace(path, F.lit("/"))) > 0) & _readable(path) & (own != normal_url(F.col("url"))))
    # the same article may stand there twice: the one with a day, then the first by title
    best = F.min(F.struct(F.col("day").isNull().alias("undated"), "title", "day", "summary")).alias("b")
    return kept.groupBy(key, own.alias("link")).agg(best).select(key, "link", "b.title", "b.day", "b.summary")
