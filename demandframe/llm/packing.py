"""Vector bin packing of token sequences: limits on tokens, segments and loss-bearing tokens hold at once.

A sequence is filled by the dot-product heuristic: of the waiting pieces that fit all three limits, the one whose
demand vector (each demand as a share of its limit) has the largest dot product with what is left of the limits
goes in next, so that a scarce limit is spent on the pieces that need it least. Each task packs the rows of its own partition from a
pool of bounded size; no row is shuffled, and no limit depends on a key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.llm.tokenise import KEPT, encoder


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 256
    loss_tokens: int = 1024


#: Pieces that wait in a task at most, and texts that are encoded at a time.
POOL, TEXTS = 512, 256


class Pool:
    """Waiting pieces with their demands; ``fill`` makes the next sequence."""

    def __init__(self, limits: Limits, cut: bool):
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.cut, self.need, self.pieces = cut, np.zeros((0, 3)), []
        self.waiting: list[tuple[object, tuple[int, int, int]]] = []

    def add(self, piece, tokens: int, loss: int) -> None:
        self.waiting.append((piece, (tokens, 1, loss)))

    def __len__(self) -> int:
        return len(self.pieces) + len(self.waiting)

    def fill(self) -> list[tuple[object, int]]:
        """Pieces of one sequence in order, each with the number of its tokens taken. Cut pieces wait on with their rest."""
        if self.waiting:
            self.need = np.concatenate([self.need, np.array([n for _, n in self.waiting], float)])
            self.pieces += [p for p, _ in self.waiting]
            self.waiting = []
        left, out, free = self.caps.copy(), [], np.ones(len(self.pieces), bool)
        while free.any() and left[0] >= 1 and left[1] >= 1:
            fits = free & (self.need <= left).all(axis=1)
            if fits.any():
                score = np.where(fits, self.need @ (left / self.caps**2), -1)
                i = int(score.argmax())
                out.append((self.pieces[i], int(self.need[i, 0])))
                left -= self.need[i]
                free[i] = False
                continue
            # nothing fits as a whole: the longest piece is cut (there each token bears loss, or none does)
            i = int(np.where(free, self.need[:, 0], -1).argmax())
            take = int(min(left[0], left[2])) if self.need[i, 2] else int(left[0])
            if not self.cut or take < 1:
                break
            out.append((self.pieces[i], take))
            left -= [take, 1, take if self.need[i, 2] else 0]
            self.need[i] -= [take, 0, take if self.need[i, 2] else 0]
            break
        self.need, self.pieces = self.need[free], [p for p, f in zip(self.pieces, free, strict=True) if f]
        return out


def powers(n: int) -> list[int]:
    """``n`` as a sum of powers of two, the largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, limits: Limits = Limits(), doc_id: str = "doc_id", text: str = "text", blank_in_chunk: bool = True, with_ids: bool = False, special_as_text: bool = True, kept: int = KEPT) -> DataFrame:
    """Pack whole texts, each followed by ``end_id``; texts may be cut. One row for each piece.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with ``with_ids`` also ``ids`` (binary,
    little-endian unsigned 32-bit). Every id lies in exactly one piece. All tokens of a document bear loss. Sequences of a task
    are full but for its last ones, which are cut to lengths that are powers of two. NULL texts count as empty (one id), a
    NULL doc_id stays NULL, repeated rows are packed each for itself; an empty table gives no row. ``kept``: chunks whose ids a
    Python worker remembers; fewer take less of its memory and more time, the ids are the same.
    """
    whole, end = min(limits.tokens, limits.loss_tokens), np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in names])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pool, rows = encoder(tokenizer, blank_in_chunk, special_as_text, kept).encode, Pool(limits, cut=True), []
        sequence = TaskContext.get().partitionId() << 40

        def put(pieces: list[tuple[list, int]]) -> None:
            """A piece is [doc_id, ids, start, tokens of the document]; its start moves on with what is taken."""
            nonlocal sequence
            offset = 0
            for piece, n in pieces:
                d, ids, start, total = piece
                own = ids[4 * start : 4 * (start + n)]
                rows.append((d, start, n, zlib.crc32(own), total, sequence, offset) + ((own,) if with_ids else ()))
                piece[2], offset = start + n, offset + n
            sequence += bool(pieces)

        def last(pieces: list[tuple[list, int]]) -> None:
            """A sequence that isn't full: dealt out to sequences whose lengths are powers of two."""
            left = [[p, n] for p, n in pieces]
            for size in powers(sum(n for _, n in pieces)):
                own = []
                while size:
                    n = min(size, left[0][1])
                    own.append((left[0][0], n))
                    left[0][1] -= n
                    size -= n
                    if not left[0][1]:
                        left.pop(0)
                put(own)

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows.clear()
            return batch

        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                some = batch.slice(i, TEXTS)
                for d, ids in zip(some.column(0).to_pylist(), encode(some.column(1).to_pylist()), strict=True):
                    ids += end
                    n = len(ids) // 4
                    piece = [d, ids, 0, n]
                    for _ in range(n // whole):
                        put([(piece, whole)])
                    if n % whole:
                        pool.add(piece, n % whole, n % whole)
                while len(pool) >= POOL:
                    put(pool.fill())
                if len(rows) >= 4096:
                    yield out()
        while len(pool):
            pieces = pool.fill()
            put(pieces) if len(pool) or sum(n for _, n in pieces) == limits.tokens else last(pieces)
        if rows:
            yield out()

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return narrow.mapInArrow(packed, ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names))


def pack_examples(examples: DataFrame, example_id: str, tokens: str, loss_tokens: str, limits: Limits = Limits()) -> DataFrame:
    """Pack whole examples (instruction data: each with its numbers of tokens and loss-bearing tokens), never cut.

    Returns ``examples`` columns example_id, tokens, loss_tokens with sequence_id and offset (NULL where an example alone
    breaks a limit, or a number is NULL or negative). Repeated rows are packed each for itself.
    """
    made = examples.select(F.col(example_id), F.col(tokens).cast("long"), F.col(loss_tokens).cast("long"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, sequence, rows = Pool(limits, cut=False), TaskContext.get().partitionId() << 40, []

        def put(pieces) -> None:
            nonlocal sequence
            offset = 0
            for row, n in pieces:
                rows.append((*row, sequence, offset))
                offset += n
            sequence += 1

        def out(schema: pa.Schema) -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows.clear()
            return batch

        schema = None
        for batch in batches:
            schema = pa.schema([*batch.schema, pa.field("sequence_id", pa.int64()), pa.field("offset", pa.int64())])
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, n, loss = row
                if n is None or loss is None or not (0 <= loss <= limits.loss_tokens and 0 <= n <= limits.tokens):
                    rows.append((*row, None, None))
                else:
                    pool.add(row, n, loss)
                if len(pool) >= POOL:
                    put(pool.fill())
            if rows:
                yield out(schema)
        while len(pool):
            put(pool.fill())
        if rows:
            yield out(schema)

    kind = dict(made.dtypes)[example_id]
    return made.mapInArrow(packed, f"`{example_id}` {kind}, `{tokens}` long, `{loss_tokens}` long, sequence_id long, offset long")
