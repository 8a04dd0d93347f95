"""SimHash near-duplicates by a binary trie self-join.

Different fingerprints are joined with themselves by walking their binary trie in pairs of nodes: both nodes go down one
bit at a time, differing bits add up, and a pair is given up once they exceed the budget. The trie is dealt out by parts of
the fingerprint: with a budget of e bits, cut into e + 1 parts, two linked fingerprints agree in one part at least, so each
fingerprint goes to e + 1 buckets (all that agree in that part) and every bucket is walked on its own. A bucket
with too many members is cut in the same way by its remaining bits, again and again; after a few levels the
remaining bits alone bound its size. Inside a bucket links are contracted to one link per fingerprint, so a
group never yields all of its pairs, and no link between two components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandframe.llm.common import materialise
from demandframe.llm.components import connected

#: Members of a bucket that is walked in one go; larger ones are cut further, ``LEVELS`` times at most.
BUCKET, LEVELS = 2048, 4
#: Sum of squared bucket sizes that are walked together: bounds the pairs of nodes in memory.
PAIRS = 1 << 22


def shingle_hashes(text: str, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle (repeats included) of A-Z lower-cased words between ASCII white space; fewer words: all of them."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([h(b" ".join(w), seed)], np.uint64)
    return np.array([h(b" ".join(s), seed) for s in zip(*(w[i:] for i in range(words)), strict=False)], np.uint64)


def majority(hashes: np.ndarray) -> np.ndarray:
    """Bits set in more than half of the rows of an (n, k) array of 64-bit words: k words."""
    n, k = hashes.shape
    ones = np.zeros(64 * k, np.int64)
    for i in range(0, n, 8192):
        ones += np.unpackbits(np.ascontiguousarray(hashes[i : i + 8192]).view(np.uint8).reshape(-1, 8 * k), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n, bitorder="little").view(np.uint64)


def fingerprints(docs: DataFrame, words: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint as a signed long; zero for a text without a word or a NULL text."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                out = [int(majority(shingle_hashes(t, words)[:, None]).view(np.int64)[0]) if t else 0 for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(out, pa.int64())], schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(made, "doc_id long, fp long")


def trie_links(fp: np.ndarray, bounds: np.ndarray, budget: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of fingerprints of one bucket that differ in at most ``budget`` bits.

    ``fp`` is ascending inside each bucket ``bounds[k]:bounds[k + 1]`` and holds no value twice there.
    A node is a run of places with a common prefix; its lower half has a 0 next, its upper half a 1.
    """
    lo, hi = bounds[:-1], bounds[1:]
    a, b, c, e, d = lo, hi, lo, hi, np.zeros(len(lo), np.int8)  # pairs of nodes a:b and c:e that differ in d bits so far
    found = []
    for bit in range(bits - 1, -1, -1):
        keep = (b > a) & (e > c) & (d <= budget) & ~((a == c) & (b - a == 1))
        a, b, c, e, d = a[keep], b[keep], c[keep], e[keep], d[keep]
        leaf = (a != c) & (b - a == 1) & (e - c == 1)
        if leaf.any():
            found.append((a[leaf], c[leaf]))
            a, b, c, e, d = a[~leaf], b[~leaf], c[~leaf], e[~leaf], d[~leaf]
        if not len(a):
            break
        ones = np.concatenate([[0], np.cumsum((fp >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        m, n = b - (ones[b] - ones[a]), e - (ones[e] - ones[c])
        other = a != c  # of a node with itself, one of the two crossings is enough
        a, b, c, e, d = (
            np.concatenate([a, m, a, m[other]]), np.concatenate([m, b, m, b[other]]), np.concatenate([c, n, n, c[other]]),
            np.concatenate([n, e, e, n[other]]), np.concatenate([d, d, d + np.int8(1), d[other] + np.int8(1)]),
        )
    keep = (b > a) & (e > c) & (d <= budget) & (a != c)
    found.append((a[keep], c[keep]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    near = np.bitwise_count(fp[i] ^ fp[j]) <= budget
    return i[near], j[near]


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For places 0..n-1 the smallest place that links lead to."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root


def _masks(budget: int, levels: int) -> list[list[list[int]]]:
    """Per level and bucket path, the masks of the next level: each adds one part of the bits that are left."""

    def parts(bits: list[int]) -> list[list[int]]:
        return [p.tolist() for p in np.array_split(np.array(bits), budget + 1)]

    paths, out = [(0, list(range(64)))], []
    for _ in range(levels):
        grown = [(mask | sum(1 << x for x in p), [x for x in left if x not in p]) for mask, left in paths for p in parts(left)]
        out.append([[m for m, _ in grown[k : k + budget + 1]] for k in range(0, len(grown), budget + 1)])
        paths = grown
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def linked(fps: DataFrame, budget: int = 2, fp: str = "fp") -> DataFrame:
    """Links (a, b) between values of ``fp`` (long, each once) with at most ``budget`` differing bits: enough to connect all that such links connect."""
    rows = fps.select(F.col(fp).alias("fp"), F.lit(0).alias("path"))
    found = None
    for level, masks in enumerate(_masks(budget, LEVELS)):
        options = F.array(*[F.array(*[F.struct(F.lit(k * (budget + 1) + j).alias("path"), F.lit(_signed(m)).alias("mask")) for j, m in enumerate(ms)]) for k, ms in enumerate(masks)])
        cut = rows.select("fp", F.explode(options[F.col("path")]).alias("o"))
        cut = cut.select("fp", F.col("o.path").alias("path"), F.xxhash64("o.path", F.col("fp").bitwiseAND(F.col("o.mask"))).alias("bucket"))
        counts = materialise(cut.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "counts")
        tagged = cut.join(counts, "bucket")
        final = level == LEVELS - 1
        own = _walked(tagged if final else tagged.where(F.col("members") <= BUCKET), budget)
        found = own if found is None else found.union(own)
        if final or counts.where(F.col("members") > BUCKET).isEmpty():
            return found
        rows = materialise(tagged.where(F.col("members") > BUCKET).select("fp", "path"), "crowded")
    return found


def _walked(tagged: DataFrame, budget: int) -> DataFrame:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(keys: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        i, j = trie_links(fp, bounds, budget)
        root = smallest_linked(len(fp), i, j)
        own = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[root[own]].view(np.int64)), pa.array(fp[own].view(np.int64))], schema=schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            # whole buckets, so many that their squares stay in bounds; the last one may go on in the next batch
            starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
            load = np.cumsum(np.diff(starts).astype(float) ** 2)
            done = 0
            while done < len(load):
                most = max(done + 1, int(np.searchsorted(load, (load[done - 1] if done else 0) + PAIRS, "right")))
                yield links(keys[starts[done] : starts[most]], fp[starts[done] : starts[most]])
                done = most
            keys, fp = keys[starts[done] :], fp[starts[done] :]
        if len(keys):
            yield links(keys, fp)

    # ascending as unsigned numbers: the sign bit turned
    unsigned = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))
    return tagged.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket", unsigned).mapInArrow(walk, "a long, b long")


def groups(docs: DataFrame, words: int = 3, budget: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row: fingerprints with at most ``budget`` differing bits link.

    ``component_id`` is the smallest doc_id that links lead to, itself included. Texts without a word, NULL ones too, have
    fingerprint zero and link like any other. A NULL doc_id is never a component_id while its component has another one. Repeated rows
    all stay; an empty table gives no row.
    """
    rows = materialise(fingerprints(docs, words, doc_id, text), "fingerprints")
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    return rows.join(with_component(classes, linked(classes, budget)), "fp").select("doc_id", "fp", "component_id")


def with_component(classes: DataFrame, links: DataFrame, key: str = "fp") -> DataFrame:
    """(key, component_id): the smallest ``first`` of each component of ``classes``; kept as a table, so that a hot key splits in a later join."""
    roots = connected(links)
    rooted = classes.join(roots.withColumnRenamed("node", key), key, "left").withColumn("root", F.coalesce("root", key))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return materialise(rooted.select(key, "root").join(smallest, "root").select(key, "component_id"), "members")


def hex16(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))
