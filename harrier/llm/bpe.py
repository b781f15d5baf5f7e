"""Byte-level BPE encoding and decoding with forced boundaries.

From the vocabulary comes the table of byte pairs that occur inside any token. A pair outside it can never be merged
across, so the text is cut there for certain, each fragment is encoded on its own, and the ids are put together. Cuts are
used at two places: in front of white space, found for the whole text by one table look-up in numpy, and within a word
of the split pattern. Fragments are remembered, so frequent ones are encoded once for each Python worker.

Classes of characters are those of the split pattern's library here. Fragments with a character whose class has changed
since Unicode 3.2, or that was added since, are encoded by the tokenizers library, whose tables may be of another version.

Defined cases: a null or empty text has no ids and decodes to the empty text. Ids that do not form UTF-8 decode to
replacement characters. Strings of added tokens in a text become their ids, as the library does. Very long fragments
are merged with a heap. Repeated rows each give a row, an empty table none; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain, rows

#: Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of fragments and their ids that a Python worker remembers, counting so many for an entry besides.
MEMO, ENTRY = 240_000_000, 160
_NONE = 1 << 62
_OLD = unicodedata.ucd_3_2_0
_loaded: dict = {}


def shown_bytes() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if it prints, else from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(hidden)) for b in range(256)]


def settled(c: str) -> bool:
    """Whether a character has been a letter, a number, a space or none of them in all versions of Unicode since 3.2."""
    kind, old = unicodedata.category(c), _OLD.category(c)
    return kind != "Cn" and (kind == old or (kind[0] == old[0] and kind[0] in "LNPS"))


class ByteBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        byte_of = {c: b for b, c in enumerate(shown_bytes())}
        vocab = model["vocab"]
        self.first = [vocab[c] for c in shown_bytes()]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # one number for each pair: its rank above the id it gives, so that the least is the next merge
        self.merges = {(vocab[a] << 32) | vocab[b]: (rank << 32) | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        self.inside = np.zeros((256, 256), bool)
        for t in vocab:
            b = np.array([byte_of[c] for c in t], np.uint8)
            self.inside[b[:-1], b[1:]] = True
        self.joins = self.inside.tobytes()
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens") or []}
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.split = regex.compile(PATTERN)
        self.path, self.library = path, None
        self.sure: dict[str, bool] = {}
        self.memo: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}
        self.held = 0

    def cuts(self, b: np.ndarray) -> np.ndarray:
        """Where a pair is never inside a token and the split pattern starts anew: in front of white space.

        Behind a printing ASCII byte any ASCII white space will do. Behind other bytes, which may end a wider white
        space, only a single space in front of a printing byte.
        """
        if len(b) < 2:
            return np.empty(0, np.int64)
        left, right = b[:-1], b[1:]
        prints = (b > 32) & (b < 127)
        white = (right == 32) | ((right >= 9) & (right <= 13))
        single = (right == 32) & np.append(prints[2:], False)
        sure = (prints[:-1] & white) | ((left > 127) & single)
        at = np.flatnonzero(sure)
        return at[~self.inside[left[at], right[at]]] + 1

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of a fragment by the merges, lowest rank and leftmost first."""
        ids = [self.first[b] for b in fragment]
        if len(ids) > 200:
            return self._merge_long(ids)
        get = self.merges.get
        ranks = [get((x << 32) | y, _NONE) for x, y in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            ids[i] = best & 0xFFFFFFFF
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1] << 32) | ids[i], _NONE)
            if i < len(ranks):
                ranks[i] = get((ids[i] << 32) | ids[i + 1], _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        get = self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get((ids[i] << 32) | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get((ids[i] << 32) | ids[j]) != r:
                continue
            ids[i], ids[j] = r & 0xFFFFFFFF, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := get((ids[a] << 32) | ids[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return [x for x in ids if x >= 0]

    def fragment(self, data: bytes) -> bytes:
        """Little-endian ids of a fragment that may hold several words of the split pattern."""
        out: list[bytes] = []
        known, joins = self.parts, self.joins
        # one space and ASCII letters are one word of the split pattern
        if data.isalpha() or (data[:1] == b" " and data[1:].isalpha()):
            words = [data]
        else:
            text = data.decode("utf-8", "surrogatepass")
            if not data.isascii() and not all(self._sure(c) for c in set(text)):
                return self._by_library(text)
            words = [w.encode("utf-8", "surrogatepass") for w in self.split.findall(text)]
        for w in words:
            got = known.get(w)
            if got is not None:
                out.append(got)
                continue
            at = [0, *[i for i, (x, y) in enumerate(zip(w, w[1:], strict=False), 1) if not joins[x << 8 | y]], len(w)]
            for x, y in zip(at, at[1:], strict=False):
                part = w[x:y]
                got = known.get(part)
                if got is None:
                    ids = self.merge(part)
                    got = struct.pack(f"<{len(ids)}i", *ids)
                    if len(part) < 40:
                        known[part] = got
                        self.held += len(part) + len(got) + ENTRY
                out.append(got)
        return out[0] if len(out) == 1 else b"".join(out)

    def _sure(self, c: str) -> bool:
        got = self.sure.get(c)
        if got is None:
            got = self.sure[c] = settled(c)
        return got

    def _by_library(self, text: str) -> bytes:
        if self.library is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
            self.library.no_truncation()
            self.library.no_padding()
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}i", *ids)

    def _plain(self, text: str) -> bytes:
        data = text.encode("utf-8", "surrogatepass")
        at = self.cuts(np.frombuffer(data, np.uint8)).tolist()
        pieces = [data[x:y] for x, y in zip([0, *at], [*at, len(data)], strict=True)]
        memo = self.memo
        if self.held > MEMO:
            memo.clear()
            self.parts.clear()
            self.held = 0
        got = list(map(memo.get, pieces))
        for i in [i for i, g in enumerate(got) if g is None]:
            piece = pieces[i]
            got[i] = memo.get(piece)
            if got[i] is None:
                # a fragment of one part is remembered as a part first, as a fragment when it comes again
                again = piece in self.parts
                got[i] = self.fragment(piece)
                if len(piece) < 400 and (again or piece not in self.parts):
                    memo[piece] = got[i]
                    self.held += len(piece) + len(got[i]) + ENTRY
        return b"".join(got)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.empty(0, np.int32)
        if self.special is None or not self.special.search(text):
            return np.frombuffer(self._plain(text), "<i4")
        out, at = [], 0
        for m in self.special.finditer(text):
            if m.start() > at:
                out.append(self._plain(text[at : m.start()]))
            out.append(struct.pack("<i", self.added[m[0]]))
            at = m.end()
        if at < len(text):
            out.append(self._plain(text[at:]))
        return np.frombuffer(b"".join(out), "<i4")


class TokenBytes:
    """The bytes of all tokens end to end, so that ids are decoded by one gather for a block of them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(shown_bytes())}
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        tokens |= {a["id"]: a["content"].encode() for a in spec.get("added_tokens") or []}
        self.sizes = np.array([len(tokens.get(i, b"")) for i in range(max(tokens) + 1)], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)

    def decode(self, ids: np.ndarray, block: int = 1 << 18) -> str:
        out = []
        for at in range(0, len(ids), block):
            some = ids[at : at + block]
            size = self.sizes[some]
            ends = np.cumsum(size)
            out.append(self.bytes[np.repeat(self.starts[some] - ends + size, size) + np.arange(ends[-1])].tobytes())
        return b"".join(out).decode("utf-8", "replace")


def load(path: str, kind: type = ByteBPE):
    """The worker's tables for a vocabulary file, built once."""
    if (path, kind) not in _loaded:
        _loaded[path, kind] = kind(path)
    return _loaded[path, kind]


def _arrays(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32), pa.int32()))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id and ids, the token ids of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        ids, out, held = [], [], 0
        for doc_id, text in rows(batches, "doc_id", "text"):
            ids.append(doc_id)
            out.append(bpe.encode(text))
            held += len(out[-1])
            if held > 1_000_000 or len(ids) >= 5_000:
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "ids": _arrays(out)})
                ids, out, held = [], [], 0
        if ids:
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "ids": _arrays(out)})

    return plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of (doc_id, ids): both, and decoded, the text of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(path, TokenBytes)
        for batch in batches:
            column = batch.column(1)
            texts = [tokens.decode(column[i].values.to_numpy() if column[i].is_valid else np.empty(0, np.int32)) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "ids": column, "decoded": pa.array(texts, pa.string())})

    return plain(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
