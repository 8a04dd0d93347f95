"""Near-copies of whole texts: five-word shingles, Jaccard similarity 0.8 or more, decided exactly.

Three routes give candidates. One SimHash of the different words, which few edits change little, is cut into ``TABLES`` keys of 40
bits; the trie self-join links keys with at most two differing bits. MinHashes of the shingles make ``BANDS`` keys of ``ROWS``
values each: at similarity 0.8 two texts share one with probability 1 - (1 - 0.8^6)^24 = 0.9993, however they differ and however
short they are. Texts of few shingles also share one of the first shingles in the order of hashes (prefix filter), so that no pair with a
text of ``SHORT`` shingles or fewer is missed. Candidates whose MinHashes agree too seldom for the wanted similarity, by a margin of
almost five standard deviations, are put out; what is left is joined into clusters, and inside a cluster all pairs are decided by their
shingle hash sets. Exact copies are one text from the start. A large crowd or cluster is dealt out as pairs of chunks, so that no task
holds more than two chunks; every pair is compared, unless both texts are connected already.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandframe.llm.common import fresh, materialise
from demandframe.llm.components import connected
from demandframe.llm.simhash import linked, majority, shingle_hashes, smallest_linked, with_component

TABLES, KEY_BITS = 10, 40
#: MinHash keys, values of one, and how far the share of agreeing values may lie under the similarity that is wanted.
BANDS, ROWS, MARGIN = 24, 6, 0.16
#: Shingles up to which a text's partners are found without fail.
SHORT = 16
#: Texts of one chunk of a crowd, and their shingles.
CHUNK, CHUNK_SHINGLES = 512, 1 << 19


def _wide(h: np.ndarray, words: int) -> np.ndarray:
    """(n, words) more hashes of each 64-bit hash."""
    x = h[:, None] + np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sketch(h: np.ndarray, words: int) -> np.ndarray:
    return majority(_wide(h, words)) if len(h) else np.zeros(words, np.uint64)


def keys_of(text: str) -> list[int]:
    """The keys: three parts of 21 bits, each with the table's number, so keys of two tables differ in three bits at least."""
    words = {*text.encode("utf-8", "surrogatepass").lower().split()}
    h = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64)
    bits = np.unpackbits(_sketch(h, -(-TABLES * KEY_BITS // 64)).view(np.uint8), bitorder="little")[: TABLES * KEY_BITS].reshape(TABLES, KEY_BITS)
    value = bits @ (np.int64(1) << np.arange(KEY_BITS, dtype=np.int64))
    cut = lambda v, t: sum(((t << 14) | p) << (21 * k) for k, p in enumerate((v & 0x1FFF, v >> 13 & 0x1FFF, v >> 26)))
    return [cut(int(v), t) for t, v in enumerate(value)]


def _min_hashes(h: np.ndarray) -> np.ndarray:
    """The smallest of ``h`` by each of BANDS * ROWS orders."""
    rng = np.random.default_rng(8)
    turn, times = rng.integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
    out = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for i in range(0, len(h), 1024):
        x = (h[i : i + 1024, None] ^ turn) * (times | np.uint64(1))
        np.minimum(out, (x ^ x >> np.uint64(32)).min(axis=0), out=out)
    return out


def bands_of(h: np.ndarray, mins: np.ndarray, least: float) -> list[int]:
    """Keys of which two texts of similarity ``least`` share one: MinHash bands, and for few shingles the first ones of ascending ``h``."""
    keys = [xxhash.xxh64_intdigest(band.tobytes(), t) for t, band in enumerate(mins.reshape(BANDS, ROWS))]
    if len(h) <= SHORT / least:
        keys += [xxhash.xxh64_intdigest(x.tobytes(), BANDS) for x in h[: len(h) - math.ceil(least * len(h) - 1e-9) + 1]]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _features(texts: DataFrame, words: int, least: float) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("keys", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64())), ("n", pa.int64()), ("sketch", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                keys, bands, sizes, sketches = [], [], [], []
                for t in some.column(3).to_pylist():
                    h = np.unique(shingle_hashes(t, words))
                    mins = _min_hashes(h)
                    keys.append(keys_of(t) if len(h) else [])
                    bands.append(bands_of(h, mins, least) if len(h) else [])
                    sizes.append(len(h))
                    sketches.append((mins * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.uint8).tobytes())
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (keys, bands)]
                yield pa.RecordBatch.from_arrays([*some.columns[:3], *lists, pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())], schema=schema)

    return texts.mapInArrow(made, "doc_id long, t1 long, t2 long, keys array<long>, bands array<long>, n long, sketch binary")


def _hash_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, n, sketch, hashes) from (node, n, sketch, text): the ascending hashes of the different shingles."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("hashes", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                sets = [np.unique(shingle_hashes(t, words)).tobytes() for t in some.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns[:3], pa.array(sets, pa.binary())], schema=schema)

    return texts.select("node", "n", "sketch", "text").mapInArrow(made, "node long, n long, sketch binary, hashes binary")


def similar(sketch: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j), i of ``left`` and j of ``right``, of different texts that may have a similarity of ``least``; the likest first."""
    low, high = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
    words, most = sketch.view(np.uint64), int((1 - least + MARGIN) * sketch.shape[1])
    found = [(left[:0], right[:0], left[:0])]
    for a in range(0, len(left), 64):
        some = left[a : a + 64]
        x = words[some, None, :] ^ words[None, right, :]
        differ = np.bitwise_count(((x & low) + low | x) & high).sum(axis=2, dtype=np.int64)  # bytes that aren't zero
        # no similarity is over the smaller number of shingles by the larger one
        may = (differ <= most) & (np.minimum(n[some, None], n[None, right]) >= least * np.maximum(n[some, None], n[None, right]))
        i, j = np.nonzero(may & (some[:, None] != right[None, :]))
        found.append((some[i], right[j], differ[i, j]))
    i, j, differ = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(differ, kind="stable")
    return i[order], j[order]


def smallest_similar(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """For places of ``sets`` the smallest place that those of the pairs (i, j) with a Jaccard similarity of ``least`` lead to."""
    root = np.arange(len(sets))
    for at in range(0, len(i), 4096):
        some_i, some_j = i[at : at + 4096], j[at : at + 4096]
        open_ = root[some_i] != root[some_j]
        for x, y in zip(some_i[open_].tolist(), some_j[open_].tolist(), strict=True):
            if root[x] == root[y]:
                continue
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if both >= least * (len(sets[x]) + len(sets[y]) - both):
                low, up = sorted((root[x], root[y]))
                root[root == up] = low
    return root


def _decided(pairs: DataFrame, least: float) -> DataFrame:
    """From rows (crowd, one, two, chunk, node, n, sketch, hashes): links (a, b) that connect what similar pairs of the chunks connect.

    Without hashes (NULL) pairs that may be similar count.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(group: pa.RecordBatch) -> pa.RecordBatch:
        one, two = (group.column(k)[0].as_py() for k in (1, 2))
        chunk, node = (group.column(k).to_numpy() for k in (3, 4))
        sketch = np.frombuffer(b"".join(group.column(6).to_pylist()), np.uint8).reshape(len(node), -1)
        i, j = similar(sketch, group.column(5).to_numpy(), np.flatnonzero(chunk == one), np.flatnonzero(chunk == two), least)
        if group.column(7).null_count:
            root = smallest_linked(len(node), i, j)
        else:
            root = smallest_similar([np.frombuffer(x, np.uint64) for x in group.column(7).to_pylist()], i, j, least)
        own = np.flatnonzero(root != np.arange(len(node)))
        return pa.RecordBatch.from_arrays([pa.array(node[root[own]]), pa.array(node[own])], schema=schema)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            head = [batch.column(k).to_numpy() for k in range(3)]
            at = 0
            for end in (np.flatnonzero(np.logical_or.reduce([np.diff(h) != 0 for h in head])) + 1).tolist():
                if end - at > 1:
                    yield links(batch.slice(at, end - at))
                at = end
            rest = batch.slice(at)
        if rest is not None and rest.num_rows > 1:
            yield links(rest)

    cols = ["crowd", "one", "two", "chunk", "node", "n", "sketch", "hashes"]
    return pairs.select(cols).repartition("crowd", "one", "two").sortWithinPartitions("crowd", "one", "two", "node").mapInArrow(decide, "a long, b long")


def _pairs(dealt: DataFrame, other: Column) -> DataFrame:
    """Every row of ``dealt`` once for each chunk that its own one is compared with."""
    dealt = dealt.withColumn("other", F.explode(other))
    return dealt.select("crowd", "node", "chunk", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"))


def _connecting(crowds: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that connect what similar pairs inside the crowds (crowd, node, held) connect, in two rounds.

    ``held`` is the number of hashes that a text brings along.
    First every chunk is compared with itself and with the first one. In a crowd of more than two chunks, what that leaves outside the
    crowd's largest component is then compared with the whole crowd; only pairs that are connected already are not looked at.
    """
    place = lambda chunks: F.pmod(F.xxhash64("node", "crowd"), chunks).cast("int")
    count = lambda n, held: F.greatest(F.ceil(n / CHUNK), F.ceil(held / CHUNK_SHINGLES)).cast("int")
    sizes = crowds.groupBy("crowd").agg(F.count("*").alias("size"), F.sum("held").alias("held")).where("size > 1")
    sizes = materialise(sizes.select("crowd", count(F.col("size"), F.col("held")).alias("chunks")), "sizes")
    dealt = crowds.join(sizes, "crowd").withColumn("chunk", place(F.col("chunks")))
    dealt = _pairs(dealt, F.when(F.col("chunk") == 0, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(F.lit(0), "chunk")))
    links = materialise(_decided(dealt.join(texts, "node"), least), "links")
    large = sizes.where("chunks > 2")
    if large.isEmpty():
        return links
    rooted = crowds.join(large, "crowd", "left_semi").join(connected(links), "node", "left")
    rooted = materialise(rooted.select("crowd", "node", "held", F.coalesce("root", "node").alias("root")), "rooted")
    parts = rooted.groupBy("crowd", "root").agg(F.count("*").alias("n"), F.sum("held").alias("held"))
    parts = parts.groupBy("crowd").agg(F.max(F.struct("n", "root", "held")).alias("main"), F.sum("n").alias("n"), F.sum("held").alias("held")).where("main.n < n")
    outer, inner = count(F.col("n") - F.col("main.n"), F.col("held") - F.col("main.held")), count(F.col("main.n"), F.col("main.held"))
    parts = materialise(parts.select("crowd", F.col("main.root").alias("main"), outer.alias("outer"), inner.alias("inner")), "parts")
    # the outer chunks come first; they meet all chunks, the largest component's only them
    inside = F.col("root") == F.col("main")
    dealt = rooted.join(parts, "crowd").withColumn("chunk", F.when(inside, F.col("outer") + place(F.col("inner"))).otherwise(place(F.col("outer"))))
    dealt = _pairs(dealt, F.sequence(F.lit(0), F.when(inside, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1))
    return links.union(materialise(_decided(dealt.join(texts, "node"), least), "links"))


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near-copies: the smallest doc_id (NULL last; equal ones: the smallest text hash).

    NULL and empty texts are copies of each other. Of repeated rows one stays. Other documents stay as they are.
    """
    t1, t2, keeper = fresh(docs.columns, "t1", "t2", "keeper")
    t = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = materialise(_features(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2"), t.alias("text")), words, similarity), "features")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")
    texts = rows.groupBy("t1", "t2").agg(F.min(first).alias("first"), F.first("keys").alias("keys"), F.first("bands").alias("bands"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    texts = materialise(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    keyed = materialise(texts.select("node", F.explode("keys").alias("key")), "keyed")
    counts = materialise(keyed.groupBy("key").agg(F.count("*").alias("members")), "keys")
    near = materialise(linked(counts, 2, "key"), "near")
    crowds = near.select(F.col("a").alias("crowd"), F.col("b").alias("key")).union(near.select("a", "a")).union(counts.where("members > 1").select("key", "key")).distinct()
    crowds = keyed.join(materialise(crowds, "crowds"), "key").select("crowd", "node").union(texts.select(F.explode("bands").alias("crowd"), "node")).distinct()
    crowds = materialise(crowds.withColumn("held", F.lit(0)), "crowds")
    may = connected(_connecting(crowds, texts.select("node", "n", "sketch", F.lit(None).cast("binary").alias("hashes")), similarity))
    clusters = materialise(may.select(F.col("root").alias("crowd"), "node").join(texts.select("node", "n", "sketch", "first"), "node"), "clusters")
    same = docs[doc_id].cast("long").eqNullSafe(clusters["first.doc_id"]) & (F.xxhash64(t) == clusters["first.t1"]) & (F.xxhash64(F.lit(1), t) == clusters["first.t2"])
    held = docs.join(clusters, same).select(clusters["node"], clusters["n"], clusters["sketch"], t.alias("text")).groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("text").alias("text"))
    links = _connecting(clusters.select("crowd", "node", F.col("n").alias("held")), materialise(_hash_sets(held, words), "sets"), similarity)
    members = with_component(texts.select("node", "first"), links, "node")
    kept = texts.join(members, "node").where(F.col("first") == F.col("component_id")).select(F.col("first.doc_id").alias(keeper), F.col("t1").alias(t1), F.col("t2").alias(t2))
    kept = materialise(kept, "kept")
    same = docs[doc_id].cast("long").eqNullSafe(kept[keeper]) & (F.xxhash64(t) == kept[t1]) & (F.xxhash64(F.lit(1), t) == kept[t2])
    return docs.join(kept, same, "left_semi").dropDuplicates([doc_id, text])
