"""Archives of texts (tar.gz of XML files) as a data source for batches and streams.

``spark.dataSource.register(TextArchives)``, then ``spark.read.format("text_archives").load(folder)`` or ``readStream``. Each
archive is one partition, so one task; its members are read one after another from the unpacking stream, none is held longer
than its row takes. Names order the archives in time: a batch reads those behind the option ``after``, and a stream's offset
is the last name read, so a stream that is started again goes on behind it. Folders of any file system that Arrow opens will do.

Rows (archive, member, content, error). A torn archive gives the members in front of the tear and a last row with the
error alone; others are not touched. Members that are not UTF-8 come with replacement characters. An empty folder gives no rows.
"""

from __future__ import annotations

import re
import tarfile
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .feeds import general_acts

SCHEMA = "archive string, member string, content string, error string"


class Archive(InputPartition):
    def __init__(self, name: str, path: str):
        self.name, self.path = name, path


class _Folder:
    """The archives of a folder, by name, and what is in one."""

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].rstrip("/")
        self.named = re.compile(options.get("names", r".*\.tar\.gz"))
        self.members = re.compile(options.get("members", r".*\.xml"))
        self.after = options.get("after", "")
        self.most = int(options.get("mostArchives", "0"))

    def archives(self, after: str, upto: str | None = None) -> list[Archive]:
        from pyarrow import fs

        files, folder = fs.FileSystem.from_uri(self.folder if "://" in self.folder else f"file://{self.folder}")
        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        names = sorted(f.base_name for f in found if f.is_file and self.named.fullmatch(f.base_name))
        names = [n for n in names if n > after and (upto is None or n <= upto)]
        return [Archive(n, f"{self.folder}/{n}") for n in names]

    def read(self, partition: Archive | None) -> Iterator[tuple]:
        from pyarrow import fs

        if not isinstance(partition, Archive):  # Spark asks for one partition where there is none
            return

        files, path = fs.FileSystem.from_uri(partition.path if "://" in partition.path else f"file://{partition.path}")
        try:
            with files.open_input_stream(path, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|gz") as tar:
                for member in tar:
                    if member.isfile() and self.members.fullmatch(member.name):
                        yield partition.name, member.name, tar.extractfile(member).read().decode("utf-8", "replace"), None
        except (tarfile.TarError, EOFError, OSError, zlib.error) as e:
            yield partition.name, None, None, f"{type(e).__name__}: {e}"[:200]


class _Batch(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.source = _Folder(options)

    def partitions(self) -> list[Archive]:
        return self.source.archives(self.source.after)

    def read(self, partition: Archive) -> Iterator[tuple]:
        return self.source.read(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.source = _Folder(options)
        self.last = self.source.after

    def initialOffset(self) -> dict:
        return {"after": self.source.after}

    def latestOffset(self) -> dict:
        newer = self.source.archives(self.last)
        newer = newer[: self.source.most] if self.source.most else newer
        self.last = newer[-1].name if newer else self.last
        return {"after": self.last}

    def partitions(self, start: dict, end: dict) -> list[Archive]:
        # a stream started again learns here where it stands
        self.last = max(self.last, end["after"])
        return self.source.archives(start["after"], end["after"])

    def read(self, partition: Archive) -> Iterator[tuple]:
        return self.source.read(partition)


class TextArchives(DataSource):
    """Options: ``path``; ``names`` and ``members``, patterns of the archives and of the files in them; ``after``, a name;
    ``mostArchives``, archives to a batch of a stream."""

    @classmethod
    def name(cls) -> str:
        return "text_archives"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(dict(self.options))


def legal_texts(members: DataFrame, prefix: str = "") -> DataFrame:
    """(id, title, kind, day, number) of the texts in archive members, without acts that concern single persons.

    Elements are looked up by name wherever they stand. A text without a title, or whose id does not start with ``prefix``,
    is left out; one that comes again, in whatever archive, counts once, by its last archive. A day that is none is null.
    """

    def element(*names: str):
        found = [F.nullif(F.trim(F.regexp_replace(F.regexp_extract("content", rf"(?s)<(?:\w+:)?{n}(?:\s[^>]*)?>([^<]+)<", 1), r"\s+", " ")), F.lit("")) for n in names]
        return F.coalesce(*found)

    stem = F.regexp_extract("member", r"([^/]*?)(?:\.[^./]*)?$", 1)
    texts = members.where("content is not null").select(
        "archive",
        "member",
        F.coalesce(element("CID", "ID"), stem).alias("id"),
        element("TITREFULL", "TITRE").alias("title"),
        F.upper(element("NATURE")).alias("kind"),
        F.try_to_date(F.left(element("DATE_PUBLI"), F.lit(10)), "yyyy-MM-dd").alias("day"),
        element("NOR").alias("number"),
    )
    kept = general_acts(texts.where(F.col("title").isNotNull() & F.col("id").startswith(prefix)), "title")
    return kept.groupBy("id").agg(F.max_by(F.struct("title", "kind", "day", "number"), F.struct("archive", "member")).alias("t")).select("id", "t.*")
