"""Workbooks (xlsx) as a data source, and tables in them whose headers only resemble the wanted ones.

``spark.dataSource.register(Workbooks)``, then ``spark.read.format("workbook").load(file or folder)``. A workbook is one partition; its
sheets are read row by row out of the zip, only its shared strings are held. Rows (file, sheet, row, cells): cells are strings
in the order of columns, null where a cell is empty. A file that is no workbook gives one row with no sheet.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import folded, normal_url

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


class Workbook(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _place(reference: str) -> int:
    """The number of a cell's column from 0: A is 0, AA is 26."""
    n = 0
    for c in re.match("[A-Z]*", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def rows_of(data: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row, cells) of a workbook."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as f:
                for _, e in ElementTree.iterparse(f):
                    if e.tag == f"{_MAIN}si":
                        shared.append("".join(t.text or "" for t in e.iter(f"{_MAIN}t")))
                        e.clear()
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            target = links[sheet.get(_LINK)]
            with book.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as f:
                for _, e in ElementTree.iterparse(f):
                    if e.tag == f"{_MAIN}row":
                        cells: list[str | None] = []
                        for c in e.iter(f"{_MAIN}c"):
                            at = _place(c.get("r")) if c.get("r") else len(cells)
                            cells += [None] * (at - len(cells))
                            value = c.findtext(f"{_MAIN}v")
                            if c.get("t") == "s" and value is not None:
                                value = shared[int(value)]
                            elif c.get("t") == "inlineStr":
                                value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                            cells.append(value or None)
                        yield sheet.get("name"), int(e.get("r") or 0), cells
                        e.clear()


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def _open(self, path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")

    def partitions(self) -> list[Workbook]:
        from pyarrow import fs

        files, path = self._open(self.path.rstrip("/"))
        info = files.get_file_info(path)
        found = [f for f in files.get_file_info(fs.FileSelector(path)) if f.is_file and f.base_name.endswith(".xlsx")] if info.type == fs.FileType.Directory else [info]
        scheme = self.path.split("://")[0] + "://" if "://" in self.path else ""
        return [Workbook(scheme + f.path) for f in sorted(found, key=lambda f: f.path)]

    def read(self, partition: Workbook | None) -> Iterator[tuple]:
        if not isinstance(partition, Workbook):
            return
        files, path = self._open(partition.path)
        name = path.rsplit("/", 1)[-1]
        with files.open_input_file(path) as f:
            data = f.read()
        try:
            for sheet, row, cells in rows_of(data):
                yield name, sheet, row, cells
        except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
            yield name, None, None, None


class Workbooks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return "file string, sheet string, row int, cells array<string>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def tables(rows: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """(file, sheet, row, *wanted): the rows below each sheet's header, by columns whose header, without marks and case, contains
    a wanted word. The header is the first row with most of the wanted words, at least one; a sheet without one gives no rows. A
    column that no header resembles is null. Empty rows are left out."""
    said = F.transform("cells", lambda c: folded(c))
    found = F.array(*[F.array_position(_holds(said, word), True) for word in wanted.values()])
    scored = rows.where("sheet is not null").select("file", "sheet", F.col("row").alias("_head"), found.alias("_at"))
    scored = scored.withColumn("_n", F.size(F.filter("_at", lambda x: x > 0))).where("_n > 0")
    head = scored.groupBy("file", "sheet").agg(F.max_by(F.struct("_head", "_at"), F.struct("_n", -F.col("_head"))).alias("h")).select("file", "sheet", "h.*")
    below = rows.join(head, ["file", "sheet"]).where(F.col("row") > F.col("_head"))
    value = lambda i: F.when(F.col("_at")[i] > 0, F.get("cells", (F.col("_at")[i] - 1).cast("int")))
    out = below.select("file", "sheet", "row", *[F.trim(value(i)).alias(name) for i, name in enumerate(wanted)])
    return out.where(F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in wanted]).isNotNull())


def _holds(said, word: str):
    return F.transform(said, lambda c: F.coalesce(F.contains(c, F.lit(word)), F.lit(False)))


def sources(found: DataFrame, urls: str = "urls") -> DataFrame:
    """The rows with their addresses as an array and ``url``, the first one in normal form; each source counts once, by its first
    sheet and row."""
    d = found.withColumn(urls, F.filter(F.split(urls, r"[\s;,]+"), lambda u: u != "")).withColumn("url", normal_url(F.get(urls, F.lit(0)))).where("url is not null")
    first = d.groupBy("url").agg(F.min(F.struct("file", "sheet", "row")).alias("f")).select(F.col("url").alias("_url"), "f.*")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("file", "sheet", "row")]
    return d.alias("a").join(first.alias("b"), (F.col("a.url") == F.col("b._url")) & same[0] & same[1] & same[2], "left_semi")
