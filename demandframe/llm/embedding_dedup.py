"""Near-duplicate vectors by Euclidean p-stable hashing, checked by the exact cosine.

Normalised vectors are projected on Gaussian directions, shifted and cut into cells of ``width``; ``cells`` of these numbers
make a bucket of one table, and there are ``tables`` tables. At cosine 0.95 two unit vectors are 0.316 apart: with the
values below they share a given bucket with probability 0.2, one of 24 with 0.995; two unrelated ones share a bucket
once in 6,000. All pairs of a bucket are compared in double precision. A bucket with many members is dealt out as pairs
of chunks, so that no task holds more than two chunks and no pair is left out. A pair counts in the first table it shares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.llm.common import materialise
from demandframe.llm.simhash import smallest_linked, with_component

CELLS, TABLES, WIDTH, SEED = 12, 24, 2.0, 20
#: Members of a bucket, or of one chunk of it.
CHUNK = 1024


def _keys(unit: np.ndarray, cells: int, tables: int, width: float) -> np.ndarray:
    """(n, tables) bucket keys of (n, d) unit vectors."""
    d = unit.shape[1]
    rng = np.random.default_rng([SEED, d])
    directions, shift = rng.standard_normal((d, tables * cells)), rng.uniform(0, width, tables * cells)
    mix = rng.integers(-(1 << 63), 1 << 63, tables * cells, dtype=np.int64) | 1
    cell = np.floor((unit @ directions + shift) / width).astype(np.int64)
    with np.errstate(over="ignore"):
        return (cell * mix).reshape(-1, tables, cells).sum(axis=2) + rng.integers(-(1 << 62), 1 << 62, tables, dtype=np.int64)


def _prepared(classes: DataFrame, cells: int, tables: int, width: float) -> DataFrame:
    schema = pa.schema([("node", pa.int64()), ("copies", pa.int64()), ("keys", pa.list_(pa.int64())), ("unit", pa.list_(pa.float64()))])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                some = batch.slice(i, 2048)
                vectors = some.column(2)
                sizes = vectors.value_lengths().to_numpy()
                for d in np.unique(sizes):
                    own = some.filter(pa.array(sizes == d))
                    x = own.column(2).flatten().to_numpy().astype(np.float64).reshape(-1, d)
                    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
                    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                    keys = _keys(x, cells, tables, width)
                    rows = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(0, a.size + 1, a.shape[1]), pa.int32()), pa.array(a.ravel()))
                    yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), rows(keys), rows(x)], schema=schema)

    return classes.select("node", "copies", "v").mapInArrow(made, "node long, copies long, keys array<long>, unit array<double>")


def _compared(pairs: DataFrame, threshold: float) -> DataFrame:
    """From rows (bucket, one, two, chunk, table, node, copies, keys, unit): (a, b, n) with n links more for a, and b linked to a unless NULL."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def links(group: pa.RecordBatch) -> pa.RecordBatch:
        n, table = group.num_rows, group.column(4)[0].as_py()
        node, copies, chunk = (group.column(k).to_numpy() for k in (5, 6, 3))
        keys, unit = (group.column(k).flatten().to_numpy().reshape(n, -1) for k in (7, 8))
        if group.column(1)[0].as_py() == group.column(2)[0].as_py():
            i, j = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
        else:
            left, right = np.flatnonzero(chunk == group.column(1)[0].as_py()), np.flatnonzero(chunk == group.column(2)[0].as_py())
            i, j = np.nonzero(unit[left] @ unit[right].T >= threshold)
            i, j = left[i], right[j]
        new = np.ones(len(i), bool)
        for t in range(table):
            new &= keys[i, t] != keys[j, t]
        i, j = i[new], j[new]
        count = np.zeros(n, np.int64)
        np.add.at(count, i, copies[j])
        np.add.at(count, j, copies[i])
        root = smallest_linked(n, i, j)
        own = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[root[own]]), pa.array(count[own])], schema=schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            head = [batch.column(k).to_numpy() for k in range(3)]
            ends = np.flatnonzero(np.logical_or.reduce([np.diff(h) != 0 for h in head])) + 1
            at = 0
            for end in ends.tolist():
                if end - at > 1:
                    yield links(batch.slice(at, end - at))
                at = end
            rest = batch.slice(at)
        if rest is not None and rest.num_rows > 1:
            yield links(rest)

    cols = ["bucket", "one", "two", "chunk", "table", "node", "copies", "keys", "unit"]
    return pairs.select(cols).repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two", "node").mapInArrow(compare, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding", cells: int = CELLS, tables: int = TABLES, width: float = WIDTH) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row, links being pairs with cosine >= ``threshold``.

    Equal vectors are compared once and counted as often as they occur. NULL, empty and zero vectors, and ones with a NULL or
    non-finite component, link with nothing; so do vectors of different lengths. ``component_id`` is the smallest vec_id
    that links lead to; where all of a component's are NULL it is NULL and ``kept`` false. An empty table gives no row.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    fine = F.size("v") > 0
    fine &= ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    classes = rows.where(fine).groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    ready = materialise(_prepared(classes, cells, tables, width), "prepared")
    keys = ready.select("node", F.posexplode("keys").alias("table", "bucket"))
    counts = materialise(keys.groupBy("table", "bucket").agg(F.count("*").alias("members")).where("members > 1"), "counts")
    dealt = keys.join(counts, ["table", "bucket"])
    dealt = dealt.withColumn("chunks", F.ceil(F.col("members") / CHUNK).cast("int"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("table", "bucket", "node", "chunk", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"))
    # tables share no bucket: their keys are shifted by random numbers, and the table is told apart below as well
    found = materialise(_compared(dealt.withColumn("bucket", F.xxhash64("bucket", "table")).join(ready, "node"), threshold), "found")
    links = found.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "node")
    components = with_component(classes.select("node", "first"), found.where("a != b").select("a", "b"), "node")
    told = materialise(classes.select("node", "v", "copies").join(links, "node", "left").join(components, "node").select("v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"), "told")
    out = rows.join(told, "v", "left")
    known = F.col("n_links").isNotNull()
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(known, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
