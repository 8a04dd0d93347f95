import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from demandframe.llm import embedding_dedup, line_dedup, near_copies, simhash
from demandframe.llm.components import connected
from plain_versions import plain_near_copies


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(60)], [(0, i) for i in range(60)], [(3, 3)], []])
def test_components(spark, links):
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for l in links if l[0] != l[1] for x in l}
    assert set(got) == nodes and len(set(got.values())) == (1 if nodes else 0)


def some_fingerprints():
    rng = random.Random(0)
    out = set()
    for _ in range(25):
        b = rng.getrandbits(64)
        for _ in range(25):
            out.add(b ^ sum(1 << k for k in {rng.randrange(64) for _ in range(rng.randrange(4))}))
    return np.array(sorted(out), np.uint64)


def test_trie_finds_each_link_once():
    fp = some_fingerprints()
    i, j = simhash.trie_links(fp, np.array([0, len(fp)]), 2)
    got = [tuple(sorted(x)) for x in zip(i.tolist(), j.tolist(), strict=True)]
    assert len(got) == len(set(got))
    assert set(got) == {(x, y) for x in range(len(fp)) for y in range(x + 1, len(fp)) if int(fp[x] ^ fp[y]).bit_count() <= 2}


@pytest.mark.parametrize("bucket", [2048, 10])
def test_linked_connects_what_links_connect(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    fp = some_fingerprints()
    signed = [int(x) for x in fp.view(np.int64)]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.fp: r.component_id for r in simhash.with_component(df.selectExpr("fp", "fp as first"), simhash.linked(df)).collect()}
    r = roots(len(fp), [(x, y) for x in range(len(fp)) for y in range(x) if int(fp[x] ^ fp[y]).bit_count() <= 2])
    assert all((r[x] == r[y]) == (got[signed[x]] == got[signed[y]]) for x in range(len(fp)) for y in range(x))


def fingerprint(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_groups_on_documents(spark, documents):
    text = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    ids = sorted(text)
    fp = [fingerprint(text[d]) for d in ids]
    r = roots(len(ids), [(x, y) for x in range(len(ids)) for y in range(x) if (fp[x] ^ fp[y]).bit_count() <= 2])
    got = {x.doc_id: (x.fp % (1 << 64), x.component_id) for x in simhash.groups(documents).collect()}
    assert got == {d: (fp[k], ids[r[k]]) for k, d in enumerate(ids)}


def test_groups_on_odd_rows(spark, odd_docs):
    got = [(r.doc_id, r.component_id) for r in simhash.groups(odd_docs).collect()]
    # texts without a word are one group: doc_ids 2, 3, 4 and a NULL
    assert sorted(got, key=str) == sorted([(1, 1), (1, 1), (None, None), (2, 2), (3, 2), (4, 2), (5, 5), (6, 6), (None, 2)], key=str)
    assert simhash.groups(odd_docs.limit(0)).count() == 0


def near_texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts, group = [], []
    for g in range(12):
        base = [word() for _ in range(400)]
        texts.append(" ".join(base))
        group.append(g)
        for _ in range(4):
            new = base.copy()
            for _ in range(rng.randrange(1, 5)):
                new[rng.randrange(400)] = word()
            texts.append(" ".join(new))
            group.append(g)
        texts += ["\n" + texts[-1].upper(), texts[-1]]
        group += [g, g]
        far = [w if i % 10 else word() for i, w in enumerate(base)]  # similarity under a half
        texts.append(" ".join(far))
        group.append(100 + g)
    return texts, group


@pytest.mark.parametrize("chunk", [512, 4])
def test_near_copies_keep_one_of_each_group(spark, monkeypatch, chunk):
    monkeypatch.setattr(near_copies, "CHUNK", chunk)
    texts, group = near_texts()
    kept = [r.doc_id for r in near_copies.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()]
    assert sorted(group[k] for k in kept) == sorted(set(group))
    assert all(k == group.index(group[k]) for k in kept)


def edited(rng, words, edits):
    out = list(words)
    for k in rng.sample(range(len(out)), edits):
        out[k] = f"w{rng.random()}"
    return out


def test_near_copies_against_exact_similarities(spark, monkeypatch):
    """Copies of one original that are unlike each other, pairs in a crowd of the same words, texts of few shingles, cut and appended copies."""
    monkeypatch.setattr(near_copies, "CHUNK", 8)
    rng = random.Random(4)
    base = [f"b{k}" for k in range(400)]
    texts = [edited(rng, base, 8) for _ in range(60)]
    texts.insert(37, base)
    same = [f"v{k}" for k in range(60)]
    for _ in range(30):
        rng.shuffle(same)
        texts += [list(same), [*same[:-2], same[-1], same[-2]]]
    for n in range(1, 30):
        for more in range(n // 3 + 2):
            own = [f"s{n}.{more}.{k}" for k in range(n + 4)]
            texts += [own, own + [f"e{n}.{more}.{k}" for k in range(more)]]
    for k in range(40):
        own = [f"l{k}.{m}" for m in range(204)]
        texts += [own, own + [f"m{k}.{m}" for m in range(40 + 20 * (k % 2))], own[k % 5 * 5 + 20 :]]
    rng.shuffle(texts)
    texts = [" ".join(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = plain_near_copies(df.toPandas().set_index("doc_id"), 0.8)
    assert max(map(len, groups)) > 30
    assert {r.doc_id for r in near_copies.keep_one(df).collect()} == {min(g) for g in groups}


def test_near_copies_of_odd_rows(spark, odd_docs):
    got = near_copies.keep_one(odd_docs)
    assert got.columns == odd_docs.columns
    assert sorted([r.doc_id for r in got.collect()], key=str) == sorted([1, None, 2, 4, 5, 6], key=str)
    assert near_copies.keep_one(odd_docs.limit(0)).count() == 0


def test_keys_of_two_tables_never_link():
    one, two = near_copies.keys_of("a b c"), near_copies.keys_of("d e f")
    assert all((x ^ y).bit_count() > 2 for k, x in enumerate(one) for m, y in enumerate(two) if k != m)


def by_cosine(v, least):
    ok = {i for i, x in v if x and all(c is not None and np.isfinite(c) for c in x) and any(x)}
    v = dict(v)
    cos = lambda a, b: np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b)) if len(a) == len(b) else -1
    ids = sorted(v)
    links = {(a, b) for a in ids for b in ids if a < b and a in ok and b in ok and cos(np.array(v[a]), np.array(v[b])) >= least}
    r = roots(len(ids), [(ids.index(a), ids.index(b)) for a, b in links])
    return {i: (sum(i in l for l in links), ids[r[k]]) for k, i in enumerate(ids)}


@pytest.mark.parametrize("chunk", [1024, 5])
def test_vectors_against_all_cosines(spark, monkeypatch, chunk):
    monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
    rng = np.random.default_rng(0)
    base = rng.standard_normal((30, 16))
    near = np.repeat(base, 8, axis=0) + 0.12 * rng.standard_normal((240, 16))
    v = [(i, [float(x) for x in r]) for i, r in enumerate(near)]
    v += [(300 + i, v[0][1]) for i in range(40)] + [(400, None), (401, []), (402, [0.0] * 16), (403, [None] + [1.0] * 15), (404, [float("nan")] + [1.0] * 15), (405, [float("inf")] + [1.0] * 15), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (408, [2 * x for x in v[0][1]])]
    expected = by_cosine(v, 0.95)
    got = embedding_dedup.near_duplicates(spark.createDataFrame(v, "vec_id long, embedding array<double>"), 0.95).collect()
    wrong = [r for r in got if (r.n_links, r.component_id) != expected[r.vec_id]]
    links, found = sum(n for n, _ in expected.values()), sum(r.n_links for r in got)
    assert found >= 0.99 * links and all(r.n_links <= expected[r.vec_id][0] for r in got) and len(wrong) <= 4
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and len(got) == len(v)


def test_vectors_repeated_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (None, None)], "vec_id long, embedding array<float>")
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, False)], key=str)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("keep", [False, True])
def test_lines_on_many_sites_go_and_copies_stay_if_asked(spark, keep):
    rows = [(i, f"own text number {i} which nobody else has\nAll rights reserved.\nmore of {i}", f"s{i}") for i in range(8)]
    rows += [(20 + i, "copied first line of some length\ncopied second line of some length\ncopied third line", f"s{i}") for i in range(8)]
    rows += [(40 + i, f"only on one site {i}\nsite's own footer", "s0") for i in range(8)]
    got = {r.doc_id: r for r in line_dedup.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep_copies=keep).collect()}
    for d, text, _ in rows:
        emptied = 20 <= d < 40 and not keep
        assert got[d].text == (text.replace("\nAll rights reserved.", "") if d < 20 else "" if emptied else text)
        assert (got[d].n_lines, got[d].n_removed) == (len(text.split("\n")), 3 if emptied else int(d < 20))


def test_every_line_on_many_sites_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    sites = defaultdict(set)
    for r in rows:
        for line in r.text.split("\n"):
            sites[line.strip(line_dedup.BLANKS)].add(r.source)
    wide = {x for x, s in sites.items() if x and len(s) >= 5}
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.remove_boilerplate(docs).collect()}
    for r in rows:
        lines = r.text.split("\n")
        kept = [x for x in lines if x.strip(line_dedup.BLANKS) not in wide]
        assert got[r.doc_id] == ("\n".join(kept), len(lines) - len(kept))
    assert wide


def test_a_long_text_of_shared_lines(spark):
    """A hundred thousand lines, two thirds of them removed."""
    shared = [f"line {i} of the licence" for i in range(100_000)]
    rows = [(i, "\n".join(f"own {i} {k}" if k % 3 == 0 else x for k, x in enumerate(shared)), f"s{i}") for i in range(5)]
    got = line_dedup.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(r.n_removed == 66_666 and r.text.split("\n") == [f"own {r.doc_id} {k}" for k in range(0, 100_000, 3)] for r in got) and len(got) == 5


def test_exact_count_near_the_threshold(spark):
    rows = [(100 * n + i, f"text {n} {i} alone\nline on {n} sites", f"s{i}") for n in (3, 4, 5, 6, 7) for i in range(n)]
    got = line_dedup.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=5)
    assert {r.doc_id // 100 for r in got.where("n_removed = 1").collect()} == {5, 6, 7}


def test_lines_of_odd_rows(spark, odd_docs):
    got = line_dedup.remove_boilerplate(odd_docs)
    assert got.columns == [*odd_docs.columns, "n_lines", "n_removed"]
    assert sorted(map(str, got.select(odd_docs.columns).collect())) == sorted(map(str, odd_docs.collect()))
    assert line_dedup.remove_boilerplate(odd_docs.limit(0)).count() == 0
