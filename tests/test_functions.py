"""Text functions, dates, feeds and sinks on literal texts, with nulls and empty texts."""

import datetime as dt

from pyspark.sql import functions as F

from harrier.functions import dates, signals
from harrier.functions import text as T
from harrier.sources import feeds, files


def values(spark, texts, f):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", f(F.col("t")).alias("v")).collect()
    return [r["v"] for r in sorted(rows)]


def test_marks_of_all_alphabets(spark):
    assert values(spark, ["Łódź Żółć", "Příliš žluťoučký", "Ποιότητα Ώρα", "Ёлка й", "e\u0301te\u0301", "", None], T.folded) == ["łodz zołc", "prilis zlutoucky", "ποιοτητα ωρα", "елка и", "ete", "", None]


def test_clean_twice_written(spark):
    assert values(spark, ["a &amp;lt;b&amp;gt; c", "x &lt;i&gt;y&lt;/i&gt;", "w " * 300, None], T.clean)[:2] == ["a c", "x y"]
    assert values(spark, ["word " * 100], T.clean)[0].endswith("word…")


def test_titles(spark):
    url = F.lit("https://x.org/2026/2026-09-guidelines_on_ai%20transparency.pdf")
    got = values(spark, ["Read more", "Lire la suite : Un titre assez long", "CELEX:32026D1: A decision on data", "A guide to the act [pdf, 300 ko]", "report_final.pdf", "", None], lambda c: T.clean_title(c, url))
    assert got == ["2026 09 guidelines on ai transparency", "Un titre assez long", "A decision on data", "A guide to the act", "2026 09 guidelines on ai transparency", "2026 09 guidelines on ai transparency", None]
    assert values(spark, ["https://x.org/a/b-c", "https://x.org/new-rules-for-all-a1b2c3d4e5.html", None], T.slug_title) == [None, "New rules for all", None]


def test_unwrap(spark):
    links = ["https://urldefense.com/v3/__https://a.org/b*21c__;abc", "https://urldefense.proofpoint.com/v2/url?u=https-3A__a.org_b-2Dc&d=x", "https://e.safelinks.protection.outlook.com/?url=https%3A%2F%2Fa.org%2Fb&x=1", " https://a.org ", None]
    assert values(spark, links, T.unwrap) == ["https://a.org/b!c", "https://a.org/b-c", "https://a.org/b", "https://a.org", None]


def test_quotes(spark):
    text = F.lit("He said: \u201cThe rules apply   from the first of May\u201d.")
    assert values(spark, ['"the rules apply from the first of may"', "the rules", "the rules apply from the second of May", "", None], lambda c: T.quoted_in(c, text)) == [True, False, False, False, None]


def test_degenerate(spark):
    source = F.lit("a short source text")
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    assert values(spark, [long, "abc abc abc abc abc", "a b a b a b a b a b a b", "fine text", "", None], lambda c: T.degenerate(source, c)) == [True, True, True, False, False, False]
    assert values(spark, ["ha ha ha ha ha ha"], lambda c: T.degenerate(F.lit("ho ho ho ho ho ho and some more words"), c)) == [False]


def test_small_functions(spark):
    assert values(spark, ["National Security Act", "", None], T.initials) == ["NSA", "", None]
    assert values(spark, ["regulations", "laws", "items", None], T.stem) == ["regul", "laws", "item", None]
    assert values(spark, ["The Règlements, NIS2 и Закон", "", None], lambda c: T.tokens(c, ("the",))) == [["regle", "nis2", "закон"], [], None]
    assert values(spark, ["2024-01-01", None], lambda c: T.days_since(c.cast("date"), "2024-01-31")) == [30, 99999]
    assert values(spark, ["on the Cyber Resilience Act today"], T.name_terms) == [["Resilience Act", "Cyber Resilience Act"]]
    assert values(spark, ["the rules of NIS and NIS, DORA", "ALL CAPS", None], T.sigla) == [["NIS", "DORA"], [], None]
    assert values(spark, ["New rules By Anna Body 22 Sep", "Rules 3 min Sector", "By the way"], T.before_byline) == ["New rules", "Rules", "By the way"]
    assert values(spark, ["1500000", "2000", "12"], lambda c: T.shown_amount(c.cast("double"), "fr")) == ["1,5 M€", "2 k€", "12 €"]


def test_dates_of_many_languages(spark):
    told = {"1 stycznia 2025": (2025, 1, 1), "12. kwietnia 2024": (2024, 4, 12), "5 de março de 2023": (2023, 3, 5), "March 3rd, 2022": (2022, 3, 3), "7 syyskuuta 2021": (2021, 9, 7), "3 okt": None, "31.02.2024": None, "1999-01-01": None, "": None}
    got = values(spark, list(told), lambda c: dates.first_date(c, "2026-01-01"))
    assert got == [dt.date(*x) if x else None for x in told.values()]
    day = lambda x: F.lit(x).cast("date")
    some = F.array(day("2024-05-01"), day("2023-01-01"), day("2024-03-01"), day("2024-05-01"))
    assert spark.range(1).select(dates.upcoming(some, "2024-02-01", 3).alias("v")).first()["v"] == [dt.date(2024, 3, 1), dt.date(2024, 5, 1), dt.date(2023, 1, 1)]


def test_near_deadlines(spark):
    texts = ["Firms shall report. First by 1 June 2024, then by 2024-07-01.", "A workshop on 2024-06-01 on what firms must do.", "x" * 120 + " 2024-06-01", "must" + " " * 120 + "2024-06-01", "must by 2024-05-05 and 2030-01-01 and 2024-05-20", "", None]
    got = values(spark, texts, lambda c: dates.near_deadlines(c, F.lit("2024-05-05").cast("date"), "2024-05-01"))
    assert got == [[dt.date(2024, 6, 1), dt.date(2024, 7, 1)], [], [], [], [dt.date(2024, 5, 20)], [], None]


def test_signals(spark):
    assert values(spark, ["Law No. 12/2026 passed", "Décision sur la loi n° 12/2026", "Loi 12", "", None], signals.numbered_text) == [True, False, False, False, None]
    assert values(spark, ["the law was published today", "published in the Official Journal, at a webinar", "a report was published"], lambda c: signals.publication(c, dates.OCCASION)) == [True, False, False]


def test_feeds(spark):
    rss = "junk<?xml version='1.0'?><rss><channel><title>no</title><item><title>A &amp; B</title><link>https://a.org/1</link><description><![CDATA[<p>x</p>]]></description></item><item><title></title><link>l</link></item><item><title>no link</title></item></channel></rss>"
    atom = "<feed><entry><title>C</title><link rel='enclosure' href='no'/><link href='https://a.org/2'/><content>y</content><updated>2024-01-01</updated></entry></feed>"
    df = spark.createDataFrame([(1, rss), (2, atom), (3, ""), (4, None), (5, "<html>")], "k int, x string")
    got = sorted(tuple(r) for r in feeds.read_feed(df, "x", "k").collect())
    assert got == [(1, "A & B", "https://a.org/1", "x", ""), (2, "C", "https://a.org/2", "y", "2024-01-01")]
    assert {r["k"]: r["v"] for r in df.select("k", feeds.is_feed(F.col("x")).alias("v")).collect()} == {1: True, 2: True, 3: False, 4: None, 5: False}


def test_sources_and_archives(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Nom de la source;Adresses des actualités;Zone géographique\nA;https://a.org/x/ , https://b.org;FR\nB;HTTPS://A.org/x;DE\nC;;FR\n", encoding="utf-8")
    got = feeds.read_sources(spark, f"{tmp_path}/s.csv", {"name": "nom", "urls": "actualites", "zone": "geographique"}).collect()
    assert len(got) == 1 and got[0]["url"] == "https://a.org/x"
    for n in ("2024-01", "2024-02", "2024-03"):
        (tmp_path / f"{n}.xml").write_text(f"<a>{n}</a>")
    assert [tuple(r) for r in feeds.newer_archives(spark, str(tmp_path), "2024-02.xml").collect()] == [("2024-03.xml", "<a>2024-03</a>")]
    assert feeds.newer_archives(spark, str(tmp_path), None).count() == 3


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a;"b"', ["x", "y"], None), (2, "plain", [], "z")], "id int, text string, tags array<string>, more string").coalesce(1)
    files.write_csv(df, f"{tmp_path}/csv")
    text = b"".join(sorted(p.read_bytes() for p in (tmp_path / "csv").glob("part-*"))).decode()
    assert text == '\ufeffid;text;tags;more\r\n1;"a;""b""";x, y;\r\n2;plain;;z\r\n'
    feeds.write_json(df, f"{tmp_path}/json")
    assert sorted(map(tuple, files.read_json(spark, f"{tmp_path}/json", "id int, text string, tags array<string>, more string").collect())) == sorted(map(tuple, df.collect()))
    files.write_hot_and_cold(spark.createDataFrame([(1, dt.date(2024, 1, 2)), (2, dt.date(2024, 2, 2))], "id int, day date"), f"{tmp_path}/hot", "day")
    assert spark.read.parquet(f"{tmp_path}/hot").where("month = '2024-02'").select("id").first()["id"] == 2
    xml = feeds.rss(spark.createDataFrame([("A & B", "https://a", dt.date(2024, 1, 1)), ("C", "https://c", dt.date(2024, 1, 2))], "t string, l string, d date"), "t", "l", "d", [-F.unix_date("d")], 1).first()["xml"]
    assert "<title>C</title>" in xml and "A &amp;" not in xml
    key = feeds.sealing_key("secret", b"salt", 1000)
    sealed = spark.createDataFrame([("text",), (None,)], "t string").select(feeds.sealed(F.col("t"), key).alias("s"))
    assert {r[0] for r in sealed.select(feeds.opened(F.col("s"), key)).collect()} == {"text", None}
    assert {r[0] for r in sealed.select(feeds.opened(F.col("s"), feeds.sealing_key("other", b"salt", 1000))).collect()} == {None}


def test_titles_led_by_any_words(spark):
    url = F.lit("https://x.org/a/b")
    told = {
        "Mehr erfahren zur Verordnung über Daten": "Verordnung über Daten",
        "Download: The yearly overview of rules": "The yearly overview of rules",
        "Download the yearly overview": "yearly overview",
        "See the report": "",
        "An overview of rules (1,5 Mo)": "An overview of rules",
        "An overview of rules (2026)": "An overview of rules (2026)",
        "overview_of_rules_2026": "",
        "More rules for makers of toys": "More rules for makers of toys",
    }
    assert values(spark, list(told), lambda c: T.clean_title(c, url)) == list(told.values())


def test_unwrap_more(spark):
    links = ["https://urldefense.com/v3/__https://a.org/?a=1&b=50*25*2Bc__;Kys!!x", "https://nam.safelinks.protection.outlook.com/?data=1&target=https%3A%2F%2Fa.org%2F%3Fq%3D1%26r%3D2#x", "https://urldefense.com/v9/none", "https://a.org/?url=https%3A%2F%2Fb.org"]
    assert values(spark, links, T.unwrap) == ["https://a.org/?a=1&b=50%+c", "https://a.org/?q=1&r=2", links[2], links[3]]


def test_citations(spark):
    told = {"Loi du 3 mars 2026 sur les jeux": True, "The Regulation (EU) 2026/1234 applies": False, "Directive 12/2026": True, "decision on law 1/2026. And then came, much later than all that, the Act no. 7/2026": True, "Gesetz vom 12. Mai 2026": True, "law 12 of 2026": False}
    assert values(spark, list(told), signals.numbered_text) == list(told.values())
    near = ["opublikowano w Dzienniku, ustawa wchodzi", "the bill was read", "Published today: the long awaited new act", "see the Boletín Oficial", None]
    assert values(spark, near, lambda c: signals.publication(c, dates.OCCASION)) == [True, False, True, True, None]


def test_general_acts_and_feeds_by_root(spark):
    df = spark.createDataFrame([("Arrêté portant nomination",), ("Décret sur les données",), ("Avis de concours externe",), ("Décret relatif aux admissions de navires",)], "title string")
    assert {r["title"] for r in feeds.general_acts(df, "title").collect()} == {"Décret sur les données", "Décret relatif aux admissions de navires"}
    roots = ["<?xml version='1.0'?>\n<!-- a <rss> --><!DOCTYPE x><rdf:RDF>", "\ufeff<feed xmlns='a'>", "<html><rss></html>", "no mark"]
    assert values(spark, roots, feeds.is_feed) == [True, True, False, False]


def test_titles_that_begin_with_joining_words(spark):
    url = F.lit("https://x.org/a/some-notes-on-page-12345.html")
    told = {
        "Read more about: The the rules of a town": "The the rules of a town",
        "La la rules of a town": "La la rules of a town",
        "Les Les Les Les Les": "Les Les Les Les Les",
        "The the read more: overview of rules": "overview of rules",
        "Read the document": "Some notes on page 12345",
    }
    assert values(spark, list(told), lambda c: T.clean_title(c, url)) == list(told.values())
    assert values(spark, ["Rules of &quot;A &amp;amp; B&quot; &#38; C"], lambda c: T.clean_title(c, url, ["amp"])) == ["Rules of &quot;A & B&quot; &#38; C"]


def test_long_numbers_in_addresses(spark):
    told = {
        "https://x.org/some-new-rules_of-12345-20240131.pdf/": "Some new rules of 12345",
        "https://x.org/some-notes-on-page-20240131.html": "Some notes on page 20240131",
        "https://x.org/new-rules-for-all-1234567": "New rules for all",
        "https://x.org/a-page-1234567": None,
        "https://x.org/rules-hereof-1234567-now": "Rules hereof now",
    }
    assert values(spark, list(told), T.slug_title) == list(told.values())


def test_words_beside_marked_letters(spark):
    assert values(spark, ["óthe", "the", "athe", "the_", None], lambda c: F.rlike(c, F.lit(T.word("the|les")))) == [True, True, False, False, None]


def test_starts_of_dates():
    import re

    assert all(re.match(dates._START, x) for x in [*dates._NAMES, "2024-01-02", "3 may 1996"])
    assert not any(re.match(dates._START, x) for x in ("long", "text", "that", "plain", "while"))


def test_citations_with_what_stands_in_front(spark):
    told = {
        "Act No. 1/2026 and the decision on law 2/2026": True,
        "decision on law 1/2026, law 2/2026": True,
        "decision on law 1/2026": False,
        "decision\x01 on law 1/2026": False,
        "\x02Act No. 1/2026\x01": True,
        "nothing of the kind": False,
        None: None,
    }
    assert values(spark, list(told), signals.numbered_text) == list(told.values())


def test_titles_that_only_look_like_links_or_files(spark):
    url = F.lit("https://x.org/a/some-notes-on-page-12345.html")
    slug = "Some notes on page 12345"
    told = {
        "john.smith.91@mail9.example.com": "john.smith.91@mail9.example.com",
        "Threering.hlfck": "Threering.hlfck",
        "Here here here here here": "Here here here here here",
        "The full story of the toys": "The full story of the toys",
        "On-line games: the new rules": "On-line games: the new rules",
        "More on-line services for all": "More on-line services for all",
        "Leer más sobre: Las reglas de la ciudad": "Las reglas de la ciudad",
        "Leer más sobre Las reglas de la ciudad": "Las reglas de la ciudad",
        "Télécharger - Les règles de la ville": "Les règles de la ville",
        "More information on toys and games": "toys and games",
        "Details: the rules of a town": "the rules of a town",
        "report-of-the-year.PDF": slug,
        "rules_of_the-year": slug,
        "Read the full document": slug,
        "More information here": slug,
        "Read more about: the report": slug,
        "CELEX:32026D1:Rules of a town": "Rules of a town",
        "CELEX:32026D0499: ": slug,
    }
    assert values(spark, list(told), lambda c: T.clean_title(c, url)) == list(told.values())


def test_titles_of_pages_without_text(spark, tmp_path):
    from harrier.plans import catalogue

    rows = [(i, None) for i in range(4)] + [(None, "<title>Rules of the town</title>")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r["title"] for r in catalogue.queries()["clean_titles"](spark, str(tmp_path)).collect()}
    assert got == {i: f"Some notes on page {i}" for i in range(4)} | {None: None}


def test_every_step_of_a_title(spark):
    url = F.lit("https://x.org/a/some-notes-on-page-12345.html")
    slug = "Some notes on page 12345"
    told = {
        "Caf&eacute; &amp;amp; bar &#8211; &quot;the rules&quot;": 'Café & bar – "the rules"',
        "Rules&nbsp;of&amp;nbsp;the   town": "Rules of the town",
        "Rules of A &amp B &#x26 C": "Rules of A & B & C",
        "A &amp; B &amp; C": slug,
        "More information about the rules of toys": "the rules of toys",
        "Davantage d’informations sur les règles de la ville": "les règles de la ville",
        "Access to the publication: Rules of a town": "Rules of a town",
        "Více informací: Pravidla pro obce": "Pravidla pro obce",
        "TÉLÉCHARGER les règles de la ville": "les règles de la ville",
        "An overview of rules (xlsx , 12 o )": "An overview of rules",
        "Plans for data (up to 5 GB)": "Plans for data (up to 5 GB)",
        "Report of the year 2026.pdf": slug,
        "Communiqué de presse": slug,
        "Les lignes directrices": slug,
        "See legislative record": slug,
        "Continue reading »": slug,
        "Read more about: Rules": "Read more about: Rules",
    }
    assert values(spark, list(told), lambda c: T.clean_title(c, url)) == list(told.values())


def test_entities_of_html5(spark):
    import html

    texts = ["&#0; &#x80; &#xD800; &#x110000; &#99999999999; &#1;|&#xfffe;|&#13;", "&notit; &not; &NotEqualTilde; &nosuch; &amp", "\x01amp\x02 &amp;lt; &;&#; &#x; &", "&ampamp;lt &CounterClockwiseContourIntegral;", ""]
    assert values(spark, [*texts, None], T.unescape_html5) == [*map(html.unescape, texts), None]


def test_titles_of_pages_by_every_step(spark, tmp_path):
    import duckdb

    from harrier.plans import catalogue

    titles = ["Rules &quot;A&quot; &eacute;t&eacute;", "A &amp; B &amp;", "Hi", "rules_of_the_town.pdf", "Lire la suite : Les règles de la ville", "Rules&nbsp;of the town [pdf, 300 ko]", "the press release", ""]
    rows = [(4 * i + k, f"<html><title>\n{t} </title></html>") for i, t in enumerate(titles) for k in range(4)] + [(100, None), (None, "<title>Rules</title>")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r["title"] for r in catalogue.queries()["clean_titles"](spark, str(tmp_path)).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 4, 5, 8, 9, 14, 16, 17, 22, 26, 100)] == [
        'Rules "A" été', 'Rules "A" été', 'Rules "A" été', "Some notes on page 3", "Read more about: A & B &", "Some notes on page 5", "Read more about: Hi", "Some notes on page 9",
        "Some notes on page 14", "Lire la suite : Les règles de la ville", "Les règles de la ville", "Rules of the town [pdf, 300 ko]", "Some notes on page 26", "Some notes on page 100",
    ]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert dict(con.sql(f"SELECT page_id, title FROM ({catalogue.oracle_sql()['clean_titles']})").fetchall()) == got
