"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer is the composition of a normaliser (blank to word mark, a word mark in front), a piece acceptor and byte fallback.
Its states after the normaliser are the last piece read; piece b may follow piece a only if merging the characters of
ab by the vocabulary's scores gives back a, b: else the arc's weight is infinite. Composed with an input, exactly one
path of finite weight is left, which is the sequence that best-first merging of the whole input gives, because merges on either
side of a lasting cut can't see past it. The tropical shortest path finds it from left to right: every prefix of the input has one
best last piece. Arcs are made when they are first needed and kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words (with ids, some 250 bytes each) and arcs kept per Python worker; the longest word kept.
WORDS, ARCS, LONGEST = 600_000, 1_000_000, 48
INFINITE = float("inf")


class Transducer:
    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        if sp.normalize("ﬁ Ａ é") != f"{MARK}ﬁ{MARK}Ａ{MARK}é":
            raise ValueError("only models whose normaliser leaves characters alone are read")
        self.unknown, self.bytes = sp.unk_id(), {}
        self.text: list[bytes] = []
        self.ids, self.score = {}, {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.text.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.text.append(" ⁇ ".encode() if sp.is_unknown(i) else b"")
            else:
                self.ids[piece], self.score[piece] = i, sp.get_score(i)
                self.text.append(piece.replace(MARK, " ").encode())
        # pieces that merging their own characters gives, and what pieces start with
        self.pieces = {p: True for p in self.ids if self._merged(p) == [p]}
        self.starts = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}
        self.arcs: dict[str, dict[str, bool]] = {}
        self.n_arcs = 0
        self.words: dict[str, bytes] = {}

    def _row(self, a: str) -> dict[str, bool]:
        """The arcs that leave the state of piece ``a`` as far as they are known: whether their weight is finite."""
        if a not in self.arcs and self.n_arcs >= ARCS:
            self.arcs, self.n_arcs = {}, 0
        return self.arcs.setdefault(a, {})

    def _merged(self, text: str) -> list[str]:
        """Best-first merging: the adjacent pair whose piece scores highest, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = -INFINITE, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1], -INFINITE)
                if s > best:
                    best, at = s, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def path(self, word: str) -> list[str]:
        """The shortest path through the composition with ``word``: its pieces; characters without a piece stand for themselves.

        Arcs weigh zero or infinity, so the first finite one that reaches a place is the shortest.
        """
        n, starts, pieces = len(word), self.starts, self.pieces
        last: list[str | None] = ["", *[None] * n]
        for start in range(n):
            a = last[start]
            row = self._row(a) if start else pieces
            for end in range(start + 1, n + 1):
                piece = word[start:end]
                if end == start + 1 and piece not in pieces:
                    last[end] = last[end] or piece  # its bytes
                if piece not in starts:
                    break
                if last[end] is None and piece in pieces:
                    finite = row.get(piece)
                    if finite is None:
                        finite = row[piece] = self._merged(a + piece) == [a, piece]
                        self.n_arcs += 1
                    if finite:
                        last[end] = piece
        out, end = [], n
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def word_ids(self, word: str) -> bytes:
        ids = []
        for piece in self.path(word):
            i = self.ids.get(piece)
            if i is not None:
                ids.append(i)
            else:
                ids += [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        # no piece but runs of marks holds a mark behind its start, so words are composed one by one
        marked = MARK + text.replace(" ", MARK)
        words = re.findall(f"{MARK}+[^{MARK}]*", marked) if MARK * 2 in marked else [MARK + w for w in marked.split(MARK)[1:]]
        known = self.words
        out = []
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = self.word_ids(w)
                if len(w) <= LONGEST:
                    if len(known) >= WORDS:
                        for k in [k for k in known if len(k) > 9]:
                            del known[k]
                    known[w] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text that ids stand for, without the blank of the first word mark; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_TRANSDUCERS: dict[str, Transducer] = {}


def transducer(model: str) -> Transducer:
    """One for each model and Python worker; later tasks go on with the arcs and words it knows."""
    if model not in _TRANSDUCERS:
        _TRANSDUCERS[model] = Transducer(model)
    return _TRANSDUCERS[model]


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row, ids as binary (little-endian unsigned 32-bit). NULL and empty texts have no id; repeated rows stay."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([t.encode(x or "") for x in some.column(1).to_pylist()], pa.binary())], schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, ids, text) of every row of ids; NULL ids give an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([t.decode(x or b"") for x in some.column(1).to_pylist()], pa.string())], schema=schema)

    return encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, ids binary, text string")
