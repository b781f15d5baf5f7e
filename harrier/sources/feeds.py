"""Feeds, alert mails, source tables and archives as DataFrames, and sinks of feeds and sealed registers."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean, normal_url, strip_marks, unescape


def is_feed(content: Column) -> Column:
    """Whether a document's root element is that of RSS, RDF or Atom: the first one behind head, comments and types."""
    root = F.regexp_extract(content, r"(?s)^[^<]*(?:<[?!].*?>\s*)*<(?:\w+:)?(\w+)", 1)
    return F.lower(root).isin("rss", "rdf", "feed")


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _tag(item: Column, names: str) -> Column:
    """The text of the first of these elements."""
    return F.trim(F.regexp_extract(item, rf"(?is)<(?:\w+:)?(?:{names})\b[^>]*>(.*?)</(?:\w+:)?(?:{names})>", 1))


def read_feed(feeds: DataFrame, content: str, key: str) -> DataFrame:
    """(key, title, link, summary, dated) for each item of RSS and RDF or entry of Atom that has a title and a link.

    Items are cut out by their tags, so an ampersand that is not escaped, control characters or a torn end spoil no more than
    the item they stand in.
    """
    sound = F.regexp_replace(content, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    # what is quoted as CDATA is escaped instead, so that tags in it end no item
    quoted = F.array_distinct(F.regexp_extract_all(sound, F.lit(r"(?s)<!\[CDATA\[.*?\]\]>"), F.lit(0)))
    sound = F.aggregate(quoted, sound, lambda all_, q: F.replace(all_, q, _escaped(F.substring(q, F.lit(10), F.length(q) - 12))))
    items = F.regexp_extract_all(sound, F.lit(r"(?is)<(?:\w+:)?(item|entry)\b.*?</(?:\w+:)?\1>"), F.lit(0))
    i = feeds.select(key, F.explode(items).alias("item"))
    item = F.col("item")
    attribute = F.regexp_extract(item, r"""(?is)<link\b(?![^>]*rel=["'](?!alternate))[^>]*href=["']([^"']+)["']""", 1)
    guid = F.regexp_extract(item, r"(?is)<(?:guid|id)\b[^>]*>\s*(http[^<]+)<", 1)
    link = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in (attribute, _tag(item, "link"), guid)])
    summary = F.coalesce(F.nullif(_tag(item, "description|summary"), F.lit("")), _tag(item, "content|encoded"))
    found = i.select(key, clean(_tag(item, "title")).alias("title"), unescape(link).alias("link"), clean(summary, 420).alias("summary"), _tag(item, "pubDate|published|date|updated|issued|created").alias("dated"))
    return found.where("title <> '' and link is not null")


def resolve(href: Column, base: Column) -> Column:
    """An address relative to a page: whole, of the same scheme, of the same host, or beside the page."""
    root = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(?<=[^/:]/)[^/]*$", "")
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(root, F.lit("/")))
    return (
        F.when(F.rlike(href, F.lit("^[a-zA-Z][a-zA-Z+.-]*:")), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([a-zA-Z]+:)", 1), href))
        .when(href.startswith("/"), F.concat(root, href))
        .otherwise(F.concat(folder, href))
    )


def mail_articles(mails: DataFrame, text: str, key: str) -> DataFrame:
    """(key, nth, title, source, dated, summary): the articles of an alert mail. Blocks are parted by empty lines; a block is
    a title, a line "source | date", and the lines of a summary. Other blocks are passed over."""
    blocks = F.posexplode(F.split(F.regexp_replace(text, r"\r\n?", "\n"), r"\n[ \t]*\n+"))
    b = mails.select(key, blocks.alias("nth", "block"))
    form = r"(?s)^\s*([^\n]+)\n([^|\n]+?)\s*\|\s*([^\n]+)(?:\n(.*))?$"
    part = lambda n: F.trim(F.regexp_replace(F.regexp_extract("block", form, n), r"\s+", " "))
    return b.where(F.rlike("block", F.lit(form))).select(key, "nth", part(1).alias("title"), part(2).alias("source"), part(3).alias("dated"), part(4).alias("summary"))


def read_sources(spark: SparkSession, path: str, wanted: dict[str, str]) -> DataFrame:
    """A table of sources whose headers only resemble the wanted ones: a column is taken where its header, without marks and
    case, contains the wanted word; one that none resembles is null. ``urls`` cells hold several addresses; each source counts once by its first one."""
    raw = spark.read.option("header", True).option("sep", ";").csv(path)
    plain = {c: _folded(c) for c in raw.columns}
    alike = {name: next((c for c in raw.columns if word in plain[c]), None) for name, word in wanted.items()}
    picked = [(F.col(f"`{c}`") if c else F.lit(None).cast("string")).alias(name) for name, c in alike.items()]
    d = raw.select(*picked).withColumn("urls", F.filter(F.split("urls", r"[\s;,]+"), lambda u: u != ""))
    return d.withColumn("url", normal_url(F.get("urls", F.lit(0)))).where("url is not null").dropDuplicates(["url"])


def _folded(name: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", name) if unicodedata.category(c) != "Mn").lower()


#: Stems, without marks, of acts that concern single persons, by what is done with them.
PERSONAL = {
    "office": ["nomin", "nomm", "recrut", "reclass", "cessation de fonction", "fin de fonction", "delegation de signature", "delegue signature"],
    "career": ["titularis", "promotion au grade", "promu", "avancement", "detach", "mutat", "retrait", "radiation des cadres"],
    "contest": ["concours", "examen pro", "admis a", "jury"],
    "honour": ["medaill", "decor", "legion d'honneur", "ordre national", "palmes"],
    "status": ["naturalis", "changement de nom", "perte de la nationalite"],
}


def general_acts(df: DataFrame, title: str) -> DataFrame:
    """Acts of general reach: no appointments, medals, contests and the like."""
    stems = "|".join(x for some in PERSONAL.values() for x in some)
    return df.where(~F.rlike(F.lower(strip_marks(F.col(title))), F.lit(rf"\b(?:{stems})")))


def newer_archives(spark: SparkSession, path: str, after: str | None) -> DataFrame:
    """The files of a folder of archives whose names lie behind the last one read, with their texts."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(path).withColumn("name", F.element_at(F.split("path", "/"), -1))
    return (files.where(F.col("name") > after) if after else files).select("name", F.decode("content", "UTF-8").alias("content"))


def rss(df: DataFrame, title: str, link: str, day: str, order: list[Column], most: int = 60) -> DataFrame:
    """One row, xml: a feed of the first ``most`` rows."""
    safe = lambda c: F.replace(F.replace(F.replace(F.col(c).cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    item = F.concat(F.lit("<item><title>"), safe(title), F.lit("</title><link>"), safe(link), F.lit("</link><pubDate>"), F.date_format(day, "EEE, dd MMM yyyy"), F.lit("</pubDate></item>"))
    top = df.select(item.alias("item"), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("o")).orderBy("o").limit(most)
    items = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o", "item"))), lambda x: x["item"]), "")  # most rows
    return top.agg(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel>'), items, F.lit("</channel></rss>")).alias("xml"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, as ``files.read_json`` reads them; null fields stay, so that every line has all of them."""
    df.write.option("ignoreNullFields", False).json(path)


def sealing_key(password: str, salt: bytes, rounds: int = 310_000) -> str:
    """The hex key a password gives, the costly way."""
    return hashlib.pbkdf2_hmac("sha256", password.encode(), salt, rounds).hex()


def sealed(c: Column, key: str) -> Column:
    return F.base64(F.aes_encrypt(c, F.unhex(F.lit(key)), F.lit("GCM")))


def opened(c: Column, key: str) -> Column:
    """The sealed text; null under a wrong key."""
    return F.try_aes_decrypt(F.unbase64(c), F.unhex(F.lit(key)), F.lit("GCM")).cast("string")
