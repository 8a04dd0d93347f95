"""The trie of all prefixes of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; the root is the empty one. ``numbered`` gives every turn its place in its
conversation, ``places`` names the node of every prefix, and ``trie`` counts members, children, leaves and the
bytes that sharing prefixes saves.

*Names.* A prefix is named by the exclusive or of a hash of each place with that turn's digest (two lanes of 64 bits). The
operation is associative, so names are running sums: windows run over blocks of 4,096 turns of a conversation, and one
row per block carries the state on. No conversation, however long, is gathered.

*Rollup.* Each component of the parent-edge forest is split at its centroid (the deepest node whose subtree holds
more than half of the component) into the subtrees below and the rest above. The totals of the parts below make
the centroid's total, which is added to every node on the path from the centroid up to the component's top; that path
is a range of places of one conversation, so it is looked up, not walked. What is left of a component has at most half
of its nodes, so there are at most log2(nodes) rounds whatever the shape; all components are split in the same round.
Components of up to BLOCK nodes are dealt out whole and finished in the same way inside a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandframe.llm.common import materialise

#: Nodes of a component that one task finishes; turns in a row that one window runs over; conversation ids in one piece of a digest (bits).
BLOCK, RUN, PIECE_BITS = 4096, 4096, 12
WEIGHTS = ("n_leaves", "saved_tokens")


def numbered(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, da, db, bytes) of every turn: its place from 1, its digest in two numbers, the UTF-8 bytes of its text.

    Turns are ordered by ``turn``, NULL first, then by digest; identical rows are turns of their own. NULL roles and texts
    are empty; rows without a conversation are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    rows = df.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    rows = rows.select("conv_id", "turn", half(1).alias("da"), half(16).alias("db"), "bytes", F.monotonically_increasing_id().alias("row"))
    order = ["turn", "da", "db", "row"]
    placed = materialise(rows.repartitionByRange("conv_id", *order).withColumn("range", F.spark_partition_id()), "turns")
    sizes = placed.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv_id", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*order))
    return placed.withColumn("k", inside).join(sizes, ["conv_id", "range"]).select("conv_id", (F.col("base") + F.col("k")).alias("pos"), "da", "db", "bytes")


def places(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, pos, bytes, node, parent) of every prefix, from place 0, the root, which each of ``convs`` (conv_id) has.

    ``turns`` as from ``numbered``, with dense places from 1. Nodes are structs of two longs.
    """
    lanes = turns.withColumns({"run": F.floor(F.col("pos") / RUN), "fa": F.xxhash64(F.lit(1), "pos", "da", "db"), "fb": F.xxhash64(F.lit(2), "db", "da", "pos")})
    lanes = materialise(lanes.select("conv_id", "run", "pos", "bytes", "fa", "fb"), "lanes")
    runs = lanes.groupBy("conv_id", "run").agg(F.bit_xor("fa").alias("ra"), F.bit_xor("fb").alias("rb"))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    runs = runs.select("conv_id", "run", *[F.coalesce(F.bit_xor(c).over(before), zero).alias(c) for c in ("ra", "rb")])
    inside = Window.partitionBy("conv_id", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = lanes.withColumns({"xa": F.bit_xor("fa").over(inside), "xb": F.bit_xor("fb").over(inside)}).join(runs, ["conv_id", "run"])
    at = at.select("conv_id", "pos", "bytes", "fa", "fb", F.col("xa").bitwiseXOR(F.col("ra")).alias("xa"), F.col("xb").bitwiseXOR(F.col("rb")).alias("xb"))
    up = F.struct(F.col("xa").bitwiseXOR(F.col("fa")).alias("a"), F.col("xb").bitwiseXOR(F.col("fb")).alias("b"))
    prefixes = at.select("conv_id", "pos", "bytes", F.struct(F.col("xa").alias("a"), F.col("xb").alias("b")).alias("node"), up.alias("parent"))
    root = F.struct(zero.alias("a"), zero.alias("b"))
    return materialise(convs.select("conv_id", zero.alias("pos"), zero.alias("bytes"), root.alias("node"), F.when(F.lit(False), root).alias("parent")).union(prefixes), "places")


def _sizes(at: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, size): nodes in each node's subtree. Every node is owned by its smallest member, and what a conversation owns is
    the last part of its places; so a node's subtree is what its members own from there on."""
    owned = at.join(nodes.select("node", F.col("conv_id").alias("owner")), "node").groupBy("conv_id").agg(F.sum((F.col("owner") != F.col("conv_id")).cast("long")).alias("others"), F.max("pos").alias("last"))
    return at.join(owned, "conv_id").groupBy("node").agg(F.sum(F.col("last") - F.greatest("others", F.col("pos")) + 1).alias("size"))


def _split(active: DataFrame, at: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: (what is finished, the rows of the parts). Every component is split at its centroid."""
    pick = F.struct("size", "node", "conv_id", "depth", *WEIGHTS, *[f"more_{w}" for w in WEIGHTS])
    cents = materialise(active.where(2 * F.col("size") > F.col("n")).groupBy("comp", "top").agg(F.min(pick).alias("c")), "centroids")
    rows = active.join(cents.select("comp", F.col("c.node").alias("cut"), F.col("c.depth").alias("cut_depth")), "comp").where("node <> cut")
    steps = at.select("conv_id", F.col("pos").alias("step"), F.col("node").alias("child"), F.col("parent").alias("child_of"))
    rows = rows.withColumn("step", F.when(F.col("depth") > F.col("cut_depth"), F.col("cut_depth") + 1)).join(steps, ["conv_id", "step"], "left")
    part = F.when(F.col("child_of") == F.col("cut"), F.col("child")).otherwise(F.col("comp"))
    rows = materialise(rows.withColumn("part", part).select(*active.columns, "part"), "parts")
    totals = rows.groupBy("comp", "part").agg(F.count("*").alias("n"), *[F.sum(w).alias(w) for w in WEIGHTS])
    totals = materialise(totals, "totals")
    below = totals.where("part <> comp").groupBy("comp").agg(*[F.sum(w).alias(f"below_{w}") for w in WEIGHTS])
    cents = cents.join(below, "comp", "left").select("comp", "top", "c.*", *[(F.col(f"c.{w}") + F.coalesce(f"below_{w}", F.lit(0))).alias(f"total_{w}") for w in WEIGHTS])
    cents = materialise(cents, "totals")
    done = cents.select("node", *[(F.col(f"total_{w}") + F.col(f"more_{w}")).alias(w) for w in WEIGHTS])
    # the path from above the centroid to the top: places of the centroid's smallest member
    spans = cents.select("conv_id", "top", "depth", F.col("size").alias("gone"), *[f"total_{w}" for w in WEIGHTS])
    path = at.select("conv_id", "pos", "node").join(spans, "conv_id").where("pos >= top AND pos < depth").select("node", "gone", *[f"total_{w}" for w in WEIGHTS])
    left = rows.drop("n").join(totals.select("part", "n"), "part").join(path, "node", "left")
    more = [(F.col(f"more_{w}") + F.coalesce(f"total_{w}", F.lit(0))).alias(f"more_{w}") for w in WEIGHTS]
    top = F.when(F.col("part") == F.col("comp"), F.col("top")).otherwise(F.col("cut_top"))
    cut = cents.select("comp", (F.col("depth") + 1).alias("cut_top"))
    left = left.join(cut, "comp").select("node", "parent", "conv_id", "depth", F.col("part").alias("comp"), top.alias("top"), "n", (F.col("size") - F.coalesce("gone", F.lit(0))).alias("size"), *WEIGHTS, *more)
    return done, materialise(left, "active")


def finish(parents: list[int], weights: list[list[int]]) -> list[list[int]]:
    """Subtree totals of one component by the same decomposition; parents come before children, the first node is the top."""
    n = len(parents)
    total = [[0] * n for _ in weights]
    todo = [list(range(n))]
    while todo:
        part = todo.pop()
        if not part:
            continue
        inside, size = set(part), dict.fromkeys(part, 1)
        for v in reversed(part[1:]):
            size[parents[v]] += size[v]
        cut = min((v for v in part if 2 * size[v] > len(part)), key=size.__getitem__)
        owner = {cut: cut}
        for v in part:  # the child of the cut above each node below it
            up = owner.get(parents[v])
            if up is not None and v != cut:
                owner[v] = v if up == cut else up
        path, v = [cut], cut
        while v != part[0]:
            v = parents[v]
            path.append(v)
        for w, t in zip(weights, total, strict=True):
            own = sum(w[x] for x in owner)
            for v in path:
                t[v] += own
        pieces: dict[int, list[int]] = {}
        for v in part:
            if v != cut and v in inside:
                pieces.setdefault(owner.get(v, part[0]), []).append(v)
        todo += pieces.values()
    return total


def _finished(small: DataFrame) -> DataFrame:
    """(node, totals) of components that fit into a task; a partition streams through, one component at a time."""
    cols = ["comp.a AS ca", "comp.b AS cb", "node.a AS na", "node.b AS nb", "parent.a AS pa", "parent.b AS pb", *WEIGHTS, *[f"more_{w}" for w in WEIGHTS]]
    rows = small.repartition("comp").sortWithinPartitions("comp", "depth").selectExpr(*cols)
    schema = pa.schema([(c, pa.int64()) for c in ("a", "b", *WEIGHTS)])
    k = len(WEIGHTS)

    def totals(component: list[tuple]) -> Iterator[tuple]:
        at = {r[2:4]: i for i, r in enumerate(component)}
        found = finish([at.get(r[4:6], -1) for r in component], [[r[6 + j] for r in component] for j in range(k)])
        for i, r in enumerate(component):
            yield (*r[2:4], *[found[j][i] + r[6 + k + j] for j in range(k)])

    def table(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if open_ and open_[0][:2] != r[:2]:
                    out += totals(open_)
                    open_ = []
                open_.append(r)
            if out:
                yield table(out)
        if open_:
            yield table(list(totals(open_)))

    found = rows.mapInArrow(run, ", ".join(f"{c} long" for c in ("a", "b", *WEIGHTS)))
    return found.select(F.struct("a", "b").alias("node"), *WEIGHTS)


def rollup(nodes: DataFrame, at: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, totals): for every node the sums of WEIGHTS over its subtree. ``nodes``: node, parent, conv_id, depth, weights; ``at`` as from ``places``."""
    sizes = _sizes(at, nodes)
    base = nodes.join(sizes, "node").select("node", "parent", "conv_id", "depth", *WEIGHTS, "size")
    zero = F.lit(0).cast("long")
    root = F.struct(zero.alias("a"), zero.alias("b"))
    n = F.lit(nodes.count()).cast("long")
    active = base.select("node", "parent", "conv_id", "depth", root.alias("comp"), zero.alias("top"), n.alias("n"), "size", *WEIGHTS, *[zero.alias(f"more_{w}") for w in WEIGHTS])
    active = materialise(active, "active")
    small, done = [], []
    while True:
        small.append(active.where(F.col("n") <= block))
        large = active.where(F.col("n") > block)
        if large.isEmpty():
            break
        finished, active = _split(large, at)
        done.append(finished)
    rest = small[0]
    for s in small[1:]:
        rest = rest.union(s)
    out = _finished(rest)
    for d in done:
        out = out.union(d)
    return materialise(out, "rolled")


def _ends(at: DataFrame) -> DataFrame:
    """(node, ends_sha256): the digest of the ids of conversations that end at a node, in ascending order.

    Ids are joined in pieces of 4,096 consecutive numbers; a task then feeds the pieces of a node to its digest one
    after the other, so memory is bounded however many copies end there.
    """
    last = at.groupBy("conv_id").agg(F.max(F.struct("pos", "node"))["node"].alias("node"))
    bucket = F.shiftright("conv_id", PIECE_BITS)
    pieces = last.groupBy("node", bucket.alias("bucket")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    rows = pieces.repartition("node").sortWithinPartitions("node", "bucket").select("node.a", "node.b", "ids")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            out = []
            for a, b, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (a, b) != node:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (a, b), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], schema=schema)
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())], schema=schema)

    return rows.mapInArrow(run, "a long, b long, ends_sha256 string").select(F.struct("a", "b").alias("node"), "ends_sha256")


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` as from ``numbered`` (dense places), ``convs`` the distinct conversations, those without turns included. No
    conversations, no rows; a root without turns below it is its own leaf.
    """
    at = places(turns, convs)
    groups = at.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("pos").alias("depth"), F.max("parent").alias("parent"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"))
    groups = materialise(groups, "nodes")
    kids = groups.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    count: Column = F.coalesce("n_children", F.lit(0).cast("long"))
    weights = [F.when(count == 0, 1).otherwise(0).cast("long").alias(WEIGHTS[0]), ((F.col("n_convs") - 1) * F.col("bytes")).alias(WEIGHTS[1])]
    nodes = materialise(groups.join(kids, "node", "left").select("node", "conv_id", "depth", "parent", "n_convs", count.alias("n_children"), *weights), "nodes")
    rolled = rollup(nodes, at, block)
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop(*WEIGHTS).join(rolled, "node").join(_ends(at), "node", "left").join(above, "parent", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *WEIGHTS, F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
