"""SentencePiece encoding and decoding against the library."""

import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

sys.path.insert(0, str(Path(__file__).parent))

from harrier.llm import pieces, queries  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceBPE(PATH)


def strange():
    rng = random.Random(4)
    known = [p for p, _, kind in pieces.read_model(PATH)[0] if kind == 1]
    texts = ["", " ", "  ", "   a", " " * 37 + "x" + " " * 50, "\n\n  \n", "▁", "▁▁a ▁b", "<s></s><unk><0x41>", "a" * 3000, "ab" * 1000, " " * 10_000, "é́ ﻿\x00\x7f", "日本語テキスト" * 200, "the" * 400, "=" * 40 + " ----- ......", "\U0010ffff\U0001f600"]
    texts += ["".join(rng.choice(known) for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x1FFFF), 32, 32, 10, 97])) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    return texts + ["".join(rng.choice("aeo rst nhi") for _ in range(rng.randint(1, 60))) for _ in range(1500)]


def test_equals_the_library(model, library):
    texts = strange()
    got, want = model.encode(texts), library.encode(texts, add_eos=True)
    assert [g.tolist() for g in got] == want
    tokens = pieces.PieceBytes(PATH)
    assert [tokens.decode(g) for g in got] == library.decode(want)


def test_every_character(model, library):
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(chr(c) for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    assert [g.tolist() for g in model.encode(texts)] == library.encode(texts, add_eos=True)


def test_decodes_any_ids(library):
    rng, tokens = random.Random(5), pieces.PieceBytes(PATH)
    for _ in range(3000):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(0, 31_999)]) for _ in range(rng.randint(0, 12))]
        assert tokens.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_long_texts_go_by_blocks(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 50)
    texts = [t for t in strange()[17:600] if t] + ["x" * 130 + " y" * 70, " " * 120 + "z"]
    assert [g.tolist() for g in model.encode(texts)] == library.encode(texts, add_eos=True)


def test_the_memo_is_emptied(library, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 5_000)
    model, texts = pieces.PieceBPE(PATH), strange()[:400]
    for _ in range(2):
        for i in range(0, 400, 20):
            assert [g.tolist() for g in model.encode(texts[i : i + 20])] == library.encode(texts[i : i + 20], add_eos=True)


def digests(rows, library):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_eos=True)
        out.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query(spark, sf_dir, library):
    found = queries.queries()["op13_sentencepiece"](spark, sf_dir)
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert sorted(map(tuple, found.collect()), key=repr) == digests(docs, library)


def test_odd_tables(spark, library):
    rows = [(1, None, "a"), (1, "", "b"), (2, "one\ntwo", "c"), (2, "one\ntwo", "c"), (None, "x  y", None), (3, "word " * 40_000, "d")]
    schema = "doc_id long, text string, ids string"
    for some in (rows, []):
        coded = pieces.decode(pieces.encode(spark.createDataFrame(some, schema).repartition(3), PATH), PATH)
        want = [(d, library.encode(t or "", add_eos=True), library.decode(library.encode(t or ""))) for d, t, _ in some]
        assert sorted(((r.doc_id, list(r.ids), r.decoded) for r in coded.collect()), key=repr) == sorted(want, key=repr)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as format_

    model = format_.ModelProto()
    model.ParseFromString(Path(PATH).read_bytes())
    model.trainer_spec.model_type = 1
    (tmp_path / "unigram.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="only BPE"):
        pieces.PieceBPE(str(tmp_path / "unigram.model"))
