import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from demandframe.llm import conversation_trie, queries
from demandframe.llm.common import materialise


def plain_trie(convs):
    """Nodes of {conversation: [(role, text), …]} by their definition."""
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
            if d:
                kids[tuple(ts[: d - 1])].add(tuple(ts[:d]))
        ends[tuple(ts)].append(c)
    out = []
    for node, ms in members.items():
        under = [x for x in members if x[: len(node)] == node]
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(kids[node]), sum(not kids[x] for x in under),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x), hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()))
    return sorted(out, key=str)


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts, key=lambda x: x[:2])] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def some_rows(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        for k in range(rng.choice([1, 2, 5, 9, 14])):
            rows.append((c, k if k else rng.choice([0, None]), rng.choice(["user", None]), rng.choice(["a", "bé", None, ""])))
    return rows


@pytest.mark.parametrize("block", [1, 3, 50, 4096])
def test_query_against_definition(spark, block):
    rows = some_rows(60)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as pos", "2 as node").repartition(4)
    turns = materialise(conversation_trie.numbered(df))
    got = conversation_trie.trie(*queries.rebuilt(turns), block=block).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == plain_trie(plain_rebuilt(rows))


def trie_of(spark, convs, block):
    rows = [(c, k, "user", t) for c, ts in convs.items() for k, t in enumerate(ts)]
    turns = materialise(conversation_trie.numbered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)))
    return turns, sorted(map(tuple, conversation_trie.trie(turns, turns.select("conv_id").distinct(), block).select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("convs", [
    {1: [str(i) for i in range(300)], -7: [str(i) for i in range(200)] + ["x"], 9000: ["0"]},  # a path
    {i: [str(i)] for i in range(-50, 5000, 61)},  # a star
    {i: ["same", "same", "same"] for i in range(0, 20_000, 97)},  # copies, many pieces of ids
    {i: list(format(i, "06b")) for i in range(64)},  # a full tree
])
def test_shapes(spark, convs):
    turns, got = trie_of(spark, convs, 7)
    assert got == plain_trie({c: [("user", t) for t in ts] for c, ts in convs.items()})
    assert {(r.conv_id, r.pos) for r in turns.collect()} == {(c, k + 1) for c, ts in convs.items() for k in range(len(ts))}


def test_a_long_conversation_is_cut(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "RUN", 10)
    convs = {1: [str(i % 7) for i in range(95)], 2: [str(i % 7) for i in range(40)] + ["x"]}
    assert trie_of(spark, convs, 16)[1] == plain_trie({c: [("user", t) for t in ts] for c, ts in convs.items()})


def test_empty_and_null(spark):
    kind = "conv_id long, turn long, role string, text string"
    none = spark.createDataFrame([(None, 1, "user", "x")], kind)
    turns = materialise(conversation_trie.numbered(none))
    assert conversation_trie.trie(*queries.rebuilt(turns)).count() == 0
    # turnless: conversation 1 keeps nothing, its donor is absent
    lone = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 3)
    turns = materialise(conversation_trie.numbered(spark.createDataFrame([(lone, 0, "user", "x"), (lone, 0, "user", "x")], kind)))
    got = conversation_trie.trie(*queries.rebuilt(turns)).select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == plain_trie({lone: []})


def test_rounds_halve_components():
    rng = random.Random(1)
    for n in (1, 2, 40, 200):
        parents = [-1] + [rng.randrange(max(0, i - 3), i) for i in range(1, n)]
        weights = [[rng.randrange(10) for _ in range(n)], [1] * n]
        expected = [list(w) for w in weights]
        for e in expected:
            for v in range(n - 1, 0, -1):
                e[parents[v]] += e[v]
        assert conversation_trie.finish(parents, weights) == expected
