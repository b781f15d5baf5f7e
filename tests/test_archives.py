"""Archives read by a batch and by a stream that is started again."""

import io
import tarfile

from harrier.sources import archives


def packed(path, members, torn=False):
    data = io.BytesIO()
    with tarfile.open(fileobj=data, mode="w:gz") as tar:
        for name, text in members.items():
            body = text.encode() if isinstance(text, str) else text
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    whole = data.getvalue()
    path.write_bytes(whole[: len(whole) * 2 // 3] if torn else whole)


def text(ident, title, day="2026-01-02", kind="loi"):
    return f"<TEXTE><META><ID>{ident}</ID><NATURE>{kind}</NATURE><DATE_PUBLI>{day}</DATE_PUBLI><NOR>N{ident}</NOR></META><TITREFULL>{title}\n</TITREFULL></TEXTE>"


def folder(tmp_path):
    import random

    noise = lambda i: "".join(chr(random.Random(i).randint(33, 126)) for _ in range(30_000)).replace("<", "")
    d = tmp_path / "in"
    d.mkdir()
    packed(d / "A_20260101.tar.gz", {"a/T1.xml": text("T1", "Loi sur  les données"), "a/T2.xml": text("T2", "Décret portant nomination"), "a/read.me": "no", "a/X9.xml": text("X9", "Loi")})
    packed(d / "A_20260102.tar.gz", {"b/T3.xml": text("T3", "Décret sur les jeux", "no day"), **{f"b/T{i}.xml": text(f"T{i}", f"Loi {i}") + noise(i) for i in range(30, 50)}}, torn=True)
    packed(d / "A_20260103.tar.gz", {"c/T1.xml": text("T1", "Loi sur les données, corrigée"), "c/T5.xml": text("T5", "").replace("TITREFULL", "OTHER"), "c/T6.xml": b"<ID>T6</ID><TITRE>Avis \xff</TITRE>"})
    (d / "notes.txt").write_text("no archive")
    return d


def test_batch(spark, tmp_path):
    spark.dataSource.register(archives.TextArchives)
    d = folder(tmp_path)
    read = spark.read.format("text_archives").load(str(d))
    assert read.rdd.getNumPartitions() == 3
    rows = read.collect()
    bad = [r for r in rows if r["error"]]
    assert [(r["archive"], r["member"]) for r in bad] == [("A_20260102.tar.gz", None)]
    torn = [r["member"] for r in rows if r["archive"] == "A_20260102.tar.gz" and r["member"]]
    assert 0 < len(torn) < 21 and torn[0] == "b/T3.xml"
    got = {r["id"]: (r["title"], r["kind"], str(r["day"]), r["number"]) for r in archives.legal_texts(read, "T").collect()}
    assert got["T1"] == ("Loi sur les données, corrigée", "LOI", "2026-01-02", "NT1")
    assert got["T3"] == ("Décret sur les jeux", "LOI", "None", "NT3") and got["T6"] == ("Avis �", None, "None", None)
    assert not {"T2", "T5", "X9"} & set(got)
    newer = spark.read.format("text_archives").option("after", "A_20260102.tar.gz").load(str(d))
    assert {r["archive"] for r in newer.collect()} == {"A_20260103.tar.gz"}
    empty = tmp_path / "none"
    assert spark.read.format("text_archives").load(str(empty)).count() == 0
    assert spark.read.format("text_archives").option("members", ".*me").load(str(d)).where("error is null").count() == 1


def test_stream_goes_on_behind_the_last_archive(spark, tmp_path):
    spark.dataSource.register(archives.TextArchives)
    d, out, state = folder(tmp_path), str(tmp_path / "out"), str(tmp_path / "state")

    def drain():
        seen = []
        stream = spark.readStream.format("text_archives").option("mostArchives", 2).load(str(d))
        query = stream.writeStream.foreachBatch(lambda df, i: (seen.append(sorted({r["archive"] for r in df.select("archive").collect()})), df.write.mode("append").parquet(out))[1])
        query.option("checkpointLocation", state).start().processAllAvailable()
        for q in spark.streams.active:
            q.stop()
        return [s for s in seen if s]

    assert sorted(sum(drain(), [])) == ["A_20260101.tar.gz", "A_20260102.tar.gz", "A_20260103.tar.gz"]
    packed(d / "A_20260104.tar.gz", {"d/T8.xml": text("T8", "Loi de plus")})
    assert drain() == [["A_20260104.tar.gz"]]
    assert drain() == []
    stored = spark.read.parquet(out)
    assert stored.where("error is null").select("member").distinct().count() == stored.where("error is null").count()
    assert {r["id"] for r in archives.legal_texts(stored, "T8").collect()} == {"T8"}
