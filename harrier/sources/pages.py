"""Links of news pages with the day and the text beside them, from a page's elements as they open and close."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spans import dates, fold, tokens

#: Elements whose content is no news, elements without content, and elements that end one of their own kind.
LEFT_OUT = {"script", "style", "noscript", "header", "footer", "nav", "form", "aside"}
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: In what an element that ends one of its own kind is looked for.
ENDING = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "dt": {"dl"}, "dd": {"dl"}, "p": {"div", "li", "td", "section", "article"}, "option": {"select"}, "a": {"div", "li", "td", "p"}}
#: Elements around a link in which its day is looked for, and characters of their text that are read.
AROUND, READ = 3, 400


class _Element:
    def __init__(self, tag: str):
        self.tag, self.text, self.links, self.time, self.waiting = tag, [], 0, None, []


class _Link:
    def __init__(self, href: str, title: str):
        self.href, self.label, self.title, self.day, self.summary, self.seen = href, title, "", None, None, 0


class Links(HTMLParser):
    """Reads a page once. A stack holds the open elements; a link waits in the element around it until that one closes, for a
    day, in a time element or in the text, and moves on outwards at most three times. An element with a second link
    ends the search, as a day there may be the other one's. Elements left open are closed by what encloses them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack, self.found, self.skipped = [_Element("")], [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in EMPTY:
            return
        for e in reversed(self.stack[1:]) if tag in ENDING else ():
            if e.tag in ENDING[tag]:
                break
            if e.tag == tag:
                while self.stack[-1] is not e:
                    self._close()
                self._close()
                break
        if tag in LEFT_OUT:
            self.skipped += 1
        e, told = _Element(tag), dict(attrs)
        if tag == "time" and not self.skipped:
            e.time = told.get("datetime") or ""
        if tag == "a" and told.get("href") and not self.skipped:
            e.waiting.append(_Link(told["href"].strip(), told.get("title") or ""))
        self.stack.append(e)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in EMPTY:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.stack[-1].text.append(data)

    def handle_endtag(self, tag: str) -> None:
        if any(e.tag == tag for e in self.stack[1:]):
            while self.stack[-1].tag != tag:
                self._close()
            self._close()

    def finish(self) -> list[_Link]:
        self.close()
        while len(self.stack) > 1:
            self._close()
        self.found += self.stack[0].waiting
        return self.found

    def _close(self) -> None:
        e, outer = self.stack.pop(), self.stack[-1]
        self.skipped -= e.tag in LEFT_OUT
        text = "".join(e.text)
        if e.tag == "a":
            for link in e.waiting:
                link.title = " ".join((text if text.strip() else link.label).split())
            e.links += len(e.waiting)
        else:
            still = []
            for link in e.waiting:
                link.seen += 1
                if e.links > 1:
                    self.found.append(link)
                    continue
                link.day = _day(e.time) or _day(text[:READ])
                if link.day:
                    about = " ".join(text.split())
                    link.summary = about.replace(link.title, "", 1).strip()[:300] if len(about) > len(link.title) + 30 else None
                (self.found if link.day or link.seen == AROUND else still).append(link)
            e.waiting = still
        outer.waiting += e.waiting
        outer.links += e.links
        outer.text.append(f" {text} " if e.tag not in ("b", "i", "em", "strong", "span", "a") else text)
        outer.time = outer.time or (e.time if e.tag != "time" else e.time or text)


def _day(text: str | None):
    found = [d for _, _, d, approx in dates(tokens(fold(text))) if not approx] if text else []
    return found[0] if found else None


def page_links(pages: DataFrame, key: str, html: str, url: str) -> DataFrame:
    """(key, url, href, title, day, summary): all links of whole pages, as they stand there; day and summary may be null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in (key, "url", "href", "title", "day", "summary")}
            for k, u, page in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                reader = Links()
                reader.feed(page or "")
                for link in reader.finish():
                    for n, v in zip(out, (k, u, link.href, link.title, link.day, link.summary), strict=True):
                        out[n].append(v)
            kinds = [batch.schema.field(0).type, pa.string(), pa.string(), pa.string(), pa.date32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    kind = pages.schema[key].dataType.simpleString()
    some = pages.select(key, F.col(url).alias("url"), F.col(html).alias("html"))
    return some.mapInArrow(run, f"{key} {kind}, url string, href string, title string, day date, summary string")
