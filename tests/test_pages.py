"""Links of pages by hand, workbooks made in the test, and entities."""

import datetime as dt
import zipfile

from pyspark.sql import functions as F

from harrier.functions import text as T
from harrier.operators import intake
from harrier.sources import feeds, pages, workbooks


def read(html):
    reader = pages.Links()
    reader.feed(html)
    return [(x.href, x.title, x.day, x.summary) for x in reader.finish()]


def test_links_with_days():
    day = dt.date(2024, 5, 3)
    assert read('<div><p><a href="/a">One <b>title</b></a></p><span>3 May 2024</span></div>') == [("/a", "One title", day, None)]
    assert read("<li><a href='/a'>One</a> 3.5.2024<li><a href='/b'>Two</a><li>4.5.2024") == [("/a", "One", day, None), ("/b", "Two", None, None)]
    # a time element goes before the text, three elements out and no further
    assert read('<div>1 May 2020 <i><b><u><a href="/a">x</a></u></b></i></div>')[0][2] is None
    assert read('<div><time datetime="2024-05-03T10:00">yesterday</time><i><a href="/a">x</a></i> 1 May 2020</div>')[0][2] == day
    # two links in an element: its day may be either's
    assert [x[2] for x in read('<div><h3><a href="/a">x</a></h3><a href="/b">y</a> 3 May 2024</div>')] == [None, None]
    assert read('<nav><a href="/n">menu</a></nav><a href="/t" title="From the title"><img src="x"></a><a>no address</a><a href="/q?a=1&amp;b=2">q</a>') == [("/t", "From the title", None, None), ("/q?a=1&b=2", "q", None, None)]
    assert read("<div><a href='/a'>open <div>3 May 2024</p></div>")[0][:2] == ("/a", "open 3 May 2024")
    assert read("") == [] and read("no < tags & such") == []
    long = "and then some more words about it"
    assert read(f'<div><a href="/a">Title</a> 3 May 2024 {long}</div>')[0][3] == f"3 May 2024 {long}"


def test_article_links(spark):
    title = "A title that is long enough for news"
    html = f"<div><a href='/n/1#top'>{title}</a> 3 May 2024</div><p><a href='https://h.org/n/1?utm_x=1'>{title}</a></p><a href='/f.zip'>{title}</a><a href='/'>{title}</a><a href='#x'>{title}</a><a href='mailto:a@b.c'>{title}</a><a href='https://o.org/n'>{title}</a><a href='/n/2.html'>short</a>"
    df = spark.createDataFrame([(1, html, "https://www.h.org/"), (2, None, "https://h.org"), (3, "", None)], "page_id int, html string, url string")
    got = [tuple(r) for r in intake.article_links(df).select("page_id", "link", "day").collect()]
    assert sorted(got, key=repr) == sorted([(1, "https://www.h.org/n/1", dt.date(2024, 5, 3)), (1, "https://h.org/n/1", None)], key=repr)


SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData></worksheet>'


def book(path, sheets, shared):
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="rId{i}" Target="{"/xl/" if i == 2 else ""}worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si><r><t>{s[:2]}</t></r><r><t>{s[2:]}</t></r></si>" for s in shared) + "</sst>")
        for i, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", SHEET.format(rows))


def test_workbooks(spark, tmp_path):
    s = lambda r, n: f'<c r="{r}" t="s"><v>{n}</v></c>'
    shared = ["Liste", "Nom de la source", "Adresses du site", "Journal", "https://a.org/x/; https://a.org/y", "Pays"]
    one = f'<row r="1">{s("A1", 0)}</row><row r="3">{s("B3", 1)}{s("D3", 2)}</row><row r="4">{s("B4", 3)}{s("D4", 4)}<c r="E4"><v>7</v></c></row><row r="5"><c r="B5" t="inlineStr"><is><t>Autre</t></is></c><c r="D5" t="str"><v>https://A.org/x</v></c></row><row r="6"/>'
    two = f'<row r="1">{s("A1", 5)}</row><row r="2">{s("A2", 3)}</row>'
    (tmp_path / "in").mkdir()
    book(tmp_path / "in/b.xlsx", {"Sources": one, "Rest": two}, shared)
    (tmp_path / "in/no.xlsx").write_text("no zip")
    (tmp_path / "in/notes.txt").write_text("x")
    spark.dataSource.register(workbooks.Workbooks)
    rows = spark.read.format("workbook").load(str(tmp_path / "in"))
    assert rows.where("sheet is null").select("file").collect() == [("no.xlsx",)]
    wanted = {"name": "nom", "urls": "adresse", "zone": "pays"}
    found = workbooks.tables(rows, wanted)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([("b.xlsx", "Sources", 4, "Journal", "https://a.org/x/; https://a.org/y", None), ("b.xlsx", "Sources", 5, "Autre", "https://A.org/x", None), ("b.xlsx", "Rest", 2, None, None, "Journal")], key=repr)
    assert [(r["name"], r["urls"], r["url"]) for r in workbooks.sources(found).collect()] == [("Journal", ["https://a.org/x/", "https://a.org/y"], "https://a.org/x")]
    single = spark.read.format("workbook").load(str(tmp_path / "in/b.xlsx"))
    assert workbooks.tables(single, {"name": "nowhere"}).count() == 0


def test_missing_header(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Nom;Adresse\nA;https://a.org\n")
    got = feeds.read_sources(spark, str(tmp_path / "s.csv"), {"name": "nom", "urls": "adresse", "zone": "pays"}).collect()
    assert [(r["name"], r["zone"]) for r in got] == [("A", None)]


def test_quoted_items(spark):
    rss = "<rss><item><title><![CDATA[A </item> & b]]></title><link>https://a.org/1</link><description><![CDATA[<p>x &amp; y</p>]]></description></item></rss>"
    got = feeds.read_feed(spark.createDataFrame([(1, rss)], "k int, x string"), "x", "k").first()
    assert (got["title"], got["link"], got["summary"]) == ("A & b", "https://a.org/1", "x & y")


def test_entities(spark):
    told = {"&#233;&Uuml;&eacute;": "éÜé", "&#x1F600;": "\U0001f600", "&amp;lt;": "&lt;", "&unknown; &#0; &#xD800; &": "&unknown; &#0; &#xD800; &", "a&nbsp;b": "a b", "none": "none", None: None}
    df = spark.createDataFrame([(t,) for t in told], "t string")
    assert [r[0] for r in df.select(T.unescape(F.col("t"))).collect()] == list(told.values())
    quote = spark.createDataFrame([("the ﬁrst ofﬁce of all the land", "It is the first office of all the land.")], "q string, t string")
    assert quote.select(T.quoted_in(F.col("q"), F.col("t"))).first()[0]
