"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut in front of each space that follows another character, where no piece of the vocabulary reaches across.
The fragments of a block of texts that are not remembered yet become one flat numpy array of symbols. It is cut into words
wherever two characters are never neighbours inside a piece. In a round each word's minimum pair rank is found by a
segmented reduction, all pairs of that rank are merged from the left, the array is compacted and only ranks beside a merge
are looked up again; words without a pair leave. Rounds go on until no pair remains.

The library merges one pair at a time. Merging all of a rank at once gives the same unless a merge opens a pair that is
due before the rest of its rank (pieces of equal score, such as runs of spaces, do). Each round looks for that, and such
words, like those of more than ``LONG`` symbols, are merged one pair at a time with a heap.

Defined cases: a null or empty text has the end id alone and decodes to the empty text. A character of no piece becomes its
UTF-8 bytes. Ids whose bytes are not UTF-8 decode to a replacement character a byte. Very long texts go block by block.
Repeated rows each give a row, an empty table none; other columns are ignored. Models other than BPE with byte fallback
and the identity normaliser are refused.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import TokenBytes, _arrays, load
from .common import plain, rows

#: The character that stands for a space in pieces; fixed by the file format.
SPACE = "▁"
#: Bytes of fragments and ids that a Python worker remembers, counting so many for an entry besides.
MEMO, ENTRY = 60_000_000, 200
#: Symbols of a word above which it is merged with a heap; characters of texts that are encoded together.
LONG, BLOCK = 512, 1 << 18
_NONE = np.int64(1 << 40)
_FRAGMENT = re.compile(" +[^ ]*")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def starts_of(word: np.ndarray) -> np.ndarray:
    """The places where another word begins."""
    return np.flatnonzero(np.append(True, word[1:] != word[:-1]))


def read_model(path: str):
    """The pieces of a model file: (piece, score, kind) by id, and the end id."""
    from sentencepiece import sentencepiece_model_pb2 as format_

    model = format_.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, trained = model.normalizer_spec, model.trainer_spec
    pieces = [(p.piece, p.score, p.type) for p in model.pieces]
    plain_form = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
    if trained.model_type != 2 or not trained.byte_fallback or not plain_form or trained.treat_whitespace_as_suffix:
        raise ValueError(f"{path}: only BPE with byte fallback, the identity normaliser and a space put in front is encoded")
    if {kind for _, _, kind in pieces} - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
        raise ValueError(f"{path}: pieces defined by a user or unused are not encoded")
    return pieces, trained.eos_id, trained.unk_surface


class PieceBPE:
    def __init__(self, path: str):
        pieces, self.end, _ = read_model(path)
        self.size = len(pieces)
        symbol = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == _NORMAL}
        self.byte = np.zeros(256, np.int32)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == _BYTE:
                self.byte[int(p[1:-1], 16)] = i
        if any(" " in p or SPACE in p.lstrip(SPACE) for p in symbol):
            raise ValueError(f"{path}: a piece reaches across the space in front of a word")
        normal = list(symbol)
        # characters of pieces that are no piece of their own may be merged as well
        for p in normal:
            for c in p:
                symbol.setdefault(c, self.size + len(symbol))
        rank = {s: r for r, s in enumerate(sorted({pieces[symbol[p]][1] for p in normal}, reverse=True))}
        pairs = sorted(
            (symbol[p[:i]] << 32 | symbol[p[i:]], rank[pieces[symbol[p]][1]], symbol[p])
            for p in normal
            for i in range(1, len(p))
            if p[:i] in symbol and p[i:] in symbol
        )
        self.key, self.rank, self.merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.pairs = {k: (r, m) for k, r, m in pairs}
        # code points to symbols; those of no piece are negative, so that they merge with nothing
        self.of = -np.arange(1, 0x110001, dtype=np.int64)
        for p, s in symbol.items():
            if len(p) == 1:
                self.of[ord(p)] = s
        self.of[32] = self.of[ord(SPACE)]
        self.near = np.unique(np.array([symbol[a] << 32 | symbol[b] for p in normal for a, b in zip(p, p[1:], strict=False)], np.int64))
        self.memo: dict[str, bytes] = {}
        self.held = 0

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; rank _NONE where the vocabulary has none."""
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        same = (self.key[at] == wanted) & (left >= 0)
        return np.where(same, self.rank[at], _NONE), self.merged[at]

    def rounds(self, ids: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols and their words, ascending, after all merges; and the words left out, whose merges depend on one another."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        left_out: list[np.ndarray] = []
        rank, merged = np.full(len(ids), _NONE), np.zeros(len(ids), np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], merged[inner] = self._found(ids[inner], ids[inner + 1])
        before = many = None
        while len(ids):
            starts = starts_of(word)
            least = np.minimum.reduceat(rank, starts)
            out = least == _NONE
            late = np.zeros(len(starts), bool) if before is None else many & (least <= before)
            if out.any() or late.any():
                counts = np.diff(np.append(starts, len(ids)))
                gone = np.repeat(out, counts)
                done.append((word[gone], ids[gone]))
                left_out.append(word[starts[late]])
                stay = ~np.repeat(out | late, counts)
                ids, word, rank, merged = ids[stay], word[stay], rank[stay], merged[stay]
                least = least[~(out | late)]
                if not len(ids):
                    break
                starts = starts_of(word)
            number = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
            at = np.flatnonzero(rank == least[number])
            # of pairs that overlap, every other one from the left; a word's last symbol has no pair, so none reach across
            new = np.append(True, np.diff(at) != 1)
            at = at[(at - at[new][np.cumsum(new) - 1]) % 2 == 0]
            of = number[at]
            many = np.bincount(of, minlength=len(starts)) > 1
            before = least
            # a merge next to the following one: the pair of its result and that one's left symbol may be due first
            beside = np.flatnonzero((np.diff(at) == 2) & (of[1:] == of[:-1]))
            between, _ = self._found(merged[at[beside]], ids[at[beside + 1]])
            sooner = of[beside[between <= least[of[beside]]]]
            ids[at] = merged[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, word, rank, merged = ids[stay], word[stay], rank[stay], merged[stay]
            place = at - np.arange(len(at))
            behind = place[(place > 0)] - 1
            touched = np.zeros(len(ids), bool)
            touched[place] = touched[behind] = True
            look = np.flatnonzero(touched[:-1])
            same = word[look] == word[look + 1]
            rank[place] = _NONE
            look = look[same]
            rank[look], merged[look] = self._found(ids[look], ids[look + 1])
            if len(sooner):
                odd = np.zeros(len(starts), bool)
                odd[sooner] = True
                gone = odd[np.searchsorted(word[starts_of(word)], word)]
                left_out.append(np.unique(word[gone]))
                ids, word, rank, merged = ids[~gone], word[~gone], rank[~gone], merged[~gone]
                before, many = before[~odd], many[~odd]
        none = np.empty(0, np.int64)
        words, symbols = (np.concatenate([none, *x]) for x in (zip(*done, strict=True) if done else ((), ())))
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order], np.concatenate([none, *left_out])

    def one_by_one(self, ids: list[int]) -> list[int]:
        """All merges of a word in the library's order: best rank first, then leftmost."""
        n, get = len(ids), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int, j: int) -> None:
            if ids[i] >= 0 and ids[j] >= 0 and (found := get(ids[i] << 32 | ids[j])):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = [False] * n
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or ids[i] != left or ids[j] != right:
                continue
            ids[i], gone[j] = merged, True
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [x for x, g in zip(ids, gone, strict=True) if not g]

    def _ids(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of symbols: a character that is no piece becomes its bytes."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.size))
        if not len(odd):
            return symbols.astype("<i4")
        out, at = [], 0
        char = {s: c for c, s in enumerate(self.of.tolist()) if s >= self.size} if (symbols >= self.size).any() else {}
        for i in odd.tolist():
            out.append(symbols[at:i])
            point = -int(symbols[i]) - 1 if symbols[i] < 0 else char[int(symbols[i])]
            out.append(self.byte[np.frombuffer(chr(point).encode("utf-8", "surrogatepass"), np.uint8)])
            at = i + 1
        out.append(symbols[at:])
        return np.concatenate(out).astype("<i4")

    def fragments(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of fragments, each with its leading space left out."""
        flat = "".join([" " + t for t in texts])
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        symbols = self.of[np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), "<u4")]
        owner = np.repeat(np.arange(len(texts)), sizes)
        # a new word at each fragment and between characters that are never neighbours inside a piece
        wanted = (symbols[:-1] << 32) | symbols[1:]
        near = self.near[np.minimum(np.searchsorted(self.near, wanted), len(self.near) - 1)] == wanted
        word = np.cumsum(np.append(0, (owner[1:] != owner[:-1]) | ~near | (symbols[:-1] < 0)))
        edges = starts_of(word)
        long = np.repeat(np.diff(np.append(edges, len(word))) > LONG, np.diff(np.append(edges, len(word))))
        merged, of, alone = self.rounds(symbols[~long].copy(), word[~long])
        alone = np.concatenate([alone, np.unique(word[long])])
        if len(alone):
            ends = np.append(edges[1:], len(word))
            # a word's number is its place among the words
            more = [np.array(self.one_by_one(symbols[edges[w] : ends[w]].tolist()), np.int64) for w in alone.tolist()]
            merged = np.concatenate([merged, *more])
            of = np.concatenate([of, np.repeat(alone, [len(m) for m in more])])
            order = np.argsort(of, kind="stable")
            merged, of = merged[order], of[order]
        cut = np.searchsorted(owner[edges[of]], np.arange(len(texts) + 1))
        single = (merged < 0) & (merged >= -128)
        merged[single] = self.byte[-merged[single] - 1]
        odd = (merged < 0) | (merged >= self.size)
        whole = merged.astype("<i4").tobytes()
        if not odd.any():
            return [whole[4 * x : 4 * y] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        strange = np.add.reduceat(np.append(odd, False), cut[:-1]) > 0
        return [self._ids(merged[x:y]).tobytes() if s else whole[4 * x : 4 * y] for x, y, s in zip(cut[:-1].tolist(), cut[1:].tolist(), strange.tolist(), strict=True)]

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """The fragments of a text, each without its leading space, for about BLOCK characters at a time."""
        text = " " + text.replace(SPACE, " ")
        at = 0
        while at < len(text):
            end = at + BLOCK
            while 0 < end < len(text) and not (text[end] == " " and text[end - 1] != " "):
                end = text.find(" ", end + 1)
            end = len(text) if end < 0 else end
            parts = text[at + 1 : end].split(" ")
            yield [x[1:] for x in _FRAGMENT.findall(text[at:end])] if "" in parts else parts
            at = end

    def _settle(self, held: list[list[str]], out: list[list[bytes]], of: list[int]) -> None:
        """Put the ids of lists of fragments behind those of their texts; unknown fragments are encoded together."""
        memo = self.memo
        missing = list({p for parts in held for p in parts if p not in memo})
        found = dict(zip(missing, self.fragments(missing), strict=True)) if missing else {}
        short = {p: f for p, f in found.items() if len(p) < 200}
        size = sum(map(len, short)) + sum(map(len, short.values())) + ENTRY * len(short)
        if self.held + size > MEMO:
            found |= {p: memo[p] for parts in held for p in parts if p in memo}
            memo.clear()
            self.held = 0
        self.held += size
        memo |= short
        for parts, i in zip(held, of, strict=True):
            got = list(map(memo.get, parts))
            out[i].append(b"".join([found[p] if g is None else g for p, g in zip(parts, got, strict=True)] if None in got else got))

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of whole texts, each with the end id."""
        out: list[list[bytes]] = []
        held, of, chars = [], [], 0
        for i, text in enumerate(texts):
            out.append([])
            for parts in self._blocks(text) if text else ():
                held.append(parts)
                of.append(i)
                chars += len(text) if len(text) < BLOCK else BLOCK
                if chars >= BLOCK:
                    self._settle(held, out, of)
                    held, of, chars = [], [], 0
        self._settle(held, out, of)
        end = np.int32(self.end).tobytes()
        return [np.frombuffer(b"".join([*x, end]), "<i4") for x in out]


class PieceBytes(TokenBytes):
    """The bytes of all pieces end to end; control pieces have none."""

    def __init__(self, path: str):
        pieces, _, unknown = read_model(path)

        def shown(piece: str, kind: int) -> bytes:
            if kind == _BYTE:
                return bytes([int(piece[1:-1], 16)])
            return {_CONTROL: "", _UNKNOWN: unknown}.get(kind, piece.replace(SPACE, " ")).encode()

        tokens = [shown(p, kind) for p, _, kind in pieces]
        self.silent = np.array([kind == _CONTROL for _, _, kind in pieces])
        self.spaced = np.array([kind == _NORMAL and p.startswith(SPACE) for p, _, kind in pieces])
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray, block: int = 1 << 18) -> str:
        out = []
        for at in range(0, len(ids), block):
            some = ids[at : at + block]
            size = self.sizes[some]
            ends = np.cumsum(size)
            out.append(self.bytes[np.repeat(self.starts[some] - ends + size, size) + np.arange(ends[-1])].tobytes())
        data = b"".join(out)
        heard = np.flatnonzero(~self.silent[ids])
        if len(heard) and self.spaced[ids[heard[0]]]:
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return re.sub("[\udc80-\udcff]", "�", data.decode("utf-8", "surrogateescape"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id and ids, the piece ids of the whole text and the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path, PieceBPE)
        ids, texts, out, chars, held = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "ids": _arrays(out)})

        for doc_id, text in rows(batches, "doc_id", "text"):
            ids.append(doc_id)
            texts.append(text)
            chars += len(text or "")
            if chars > BLOCK or len(texts) >= 2_000:
                out += model.encode(texts)
                held, texts, chars = held + sum(map(len, out[-len(texts) :])), [], 0
            if held > 1_000_000 or len(ids) >= 5_000:
                out += model.encode(texts)
                yield flush()
                ids, texts, out, chars, held = [], [], [], 0, 0
        out += model.encode(texts)
        if ids:
            yield flush()

    return plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of (doc_id, ids): both, and decoded, the text of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(path, PieceBytes)
        for batch in batches:
            column = batch.column(1)
            texts = [tokens.decode(column[i].values.to_numpy() if column[i].is_valid else np.empty(0, np.int32)) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "ids": column, "decoded": pa.array(texts, pa.string())})

    return plain(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
