"""Token ids as binary files of directly addressable codes.

An id is cut into chunks of eight bits. Level 0 holds the low chunk of every id and one bit per id that says whether
it goes on; level 1 holds the next chunk of those that go on, in the same order, and so on. The place of an id on
the next level is the number of set bits before it (its rank), which a directory of counts at every 512th bit and a
count inside one block give. So any id is read without decoding a block of others.

File of one shard (little-endian): ``DAC1``, u32 levels, u64 ids, u64 documents; per level u64 n, n chunk bytes, the
bitmap (ceil(n / 8) bytes, low bit first), u32 counts of set bits before each block of 512; then u64 first token of
every document and, last, the end.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandframe.llm.common import fresh, new_path
from demandframe.llm.tokenise import encoder

MAGIC, BLOCK = b"DAC1", 512
#: Ids from which a shard is closed, and texts that are encoded at a time.
SHARD_IDS, TEXTS = 1 << 18, 256
_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def pack_ids(ids: np.ndarray, starts: np.ndarray) -> bytes:
    """The file of one shard. ``starts``: first token of every document, then the number of ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        low, rest = (rest & 255).astype(np.uint8), rest >> 8
        more = rest > 0
        bitmap = np.packbits(more, bitorder="little")
        at = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0, int))])
        levels.append(struct.pack("<Q", len(low)) + low.tobytes() + bitmap.tobytes() + at[: -(-len(low) // BLOCK)].astype("<u4").tobytes())
        rest = rest[more]
        if not len(rest):
            break
    return MAGIC + struct.pack("<IQQ", len(levels), len(ids), len(starts) - 1) + b"".join(levels) + np.asarray(starts, "<u8").tobytes()


class Shard:
    """Reads a shard's file: ``shard[i]`` is one id, ``ids(a, b)`` a run of them, ``starts`` the documents' first tokens."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        n_levels, self.n, n_docs = struct.unpack_from("<IQQ", data, 4)
        at, self.levels = 24, []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bitmap = np.frombuffer(data, np.uint8, -(-n // 8), at + 8 + n)
            counts = np.frombuffer(data, "<u4", -(-n // BLOCK), at + 8 + n + len(bitmap))
            at += 8 + n + len(bitmap) + 4 * len(counts)
            self.levels.append((chunks, bitmap, counts))
        self.starts = np.frombuffer(data, "<u8", n_docs + 1, at)

    def __len__(self) -> int:
        return self.n

    def _rank(self, level: int, i: int) -> int:
        """Set bits before place ``i``."""
        _, bitmap, counts = self.levels[level]
        block, byte = i // BLOCK, i // 8
        inside = int(_BITS[bitmap[block * BLOCK // 8 : byte]].sum())
        return int(counts[block]) + inside + bin(int(bitmap[byte]) & ((1 << i % 8) - 1)).count("1")

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k, (chunks, bitmap, _) in enumerate(self.levels):
            out |= int(chunks[i]) << 8 * k
            if not bitmap[i // 8] >> i % 8 & 1:
                break
            i = self._rank(k, i)
        return out

    def ids(self, a: int = 0, b: int | None = None) -> np.ndarray:
        b = self.n if b is None else min(b, self.n)
        out, where = np.zeros(max(0, b - a), np.uint32), np.arange(max(0, b - a))
        for k, (chunks, bitmap, _) in enumerate(self.levels):
            if a >= b:
                break
            out[where] |= chunks[a:b].astype(np.uint32) << np.uint32(8 * k)
            more = np.unpackbits(bitmap[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)
            where = where[more]
            if not len(where):
                break
            a = self._rank(k, a)
            b = a + len(where)
        return out


def write(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", blank_in_chunk: bool = False, path: str | None = None, special_as_text: bool = True) -> str:
    """Encode all texts and write them as shard files in ascending ``doc_id`` order; returns the table's path.

    The table has one row for each shard (part, shard, n_docs, n_tokens, doc_ids, data). NULL texts count as empty and
    hold the end id alone; NULL doc_ids come first; rows of one doc_id follow in the order of the input. Nothing is dropped.
    """
    order = fresh(docs.columns, "row_order")[0]
    # the order of rows in the files splits an id that very many rows share
    placed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias(order))
    placed = placed.repartitionByRange("doc_id", order).sortWithinPartitions("doc_id", order).select("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, n = encoder(tokenizer, blank_in_chunk, special_as_text).encode, TaskContext.get().partitionId(), 0
        docs_, lengths, parts, size = [], [], [], 0

        def closed() -> pa.RecordBatch:
            starts = np.concatenate([[0], np.cumsum(lengths)])
            data = pack_ids(np.frombuffer(b"".join(parts), "<u4"), starts)
            return pa.RecordBatch.from_pydict({"part": [part], "shard": [n], "n_docs": [len(docs_)], "n_tokens": [size], "doc_ids": [docs_], "data": [data]}, schema=pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("data", pa.binary())]))

        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                some = batch.slice(i, TEXTS)
                for d, ids in zip(some.column(0).to_pylist(), encode(some.column(1).to_pylist()), strict=True):
                    docs_.append(d)
                    parts.append(ids + end)
                    lengths.append(len(ids) // 4 + 1)
                    size += lengths[-1]
                    if size >= SHARD_IDS:
                        yield closed()
                        n, docs_, lengths, parts, size = n + 1, [], [], [], 0
        if docs_:
            yield closed()

    path = path or new_path(docs.sparkSession, "tokens")
    placed.mapInArrow(shards, "part long, shard long, n_docs long, n_tokens long, doc_ids array<long>, data binary").write.parquet(path)
    return path


def read_documents(spark, path: str) -> DataFrame:
    """From the files alone, one row per document: doc_id, start (ids of all documents before it), n_tokens, ids (array of int)."""
    return _with_starts(spark, path, lambda ids: pa.array(ids.astype(np.int32)), "ids array<int>", pa.list_(pa.int32()))


def read_digest(spark, path: str) -> DataFrame:
    """As ``read_documents`` but for ``ids_crc32``: the unsigned CRC-32 of the ids as little-endian 32-bit integers."""
    return _with_starts(spark, path, None, "ids_crc32 long", pa.int64())


def _with_starts(spark, path: str, made, column: str, kind: pa.DataType) -> DataFrame:
    name = column.split(" ")[0]
    schema = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("doc_id", pa.int64()), ("inside", pa.int64()), ("n_tokens", pa.int64()), (name, kind)])

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                shard, doc_ids = Shard(row.column(3)[0].as_py()), row.column(2)[0].as_py()
                ids, starts = shard.ids().astype("<u4"), shard.starts.astype(np.int64)
                raw, n = memoryview(ids.tobytes()), len(doc_ids)
                if made is None:
                    values = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                else:
                    values = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), made(ids))
                yield pa.RecordBatch.from_arrays([pa.array([row.column(0)[0].as_py()] * n, pa.int64()), pa.array([row.column(1)[0].as_py()] * n, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(starts[:-1]), pa.array(np.diff(starts)), values if made else pa.array(values, kind)], schema=schema)

    files = spark.read.schema("part long, shard long, n_docs long, n_tokens long, doc_ids array<long>, data binary").parquet(path)
    docs = files.select("part", "shard", "doc_ids", "data").mapInArrow(opened, f"part long, shard long, doc_id long, inside long, n_tokens long, {column}")
    # starts of the shards: sums over the parts (one row each), then inside each part
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before("part")), F.lit(0)).alias("part_start"))
    shards = files.select("part", "shard", F.coalesce(F.sum("n_tokens").over(before("part", "shard")), F.lit(0)).alias("shard_start"))
    starts = shards.join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("base"))
    return docs.join(starts, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", name)
