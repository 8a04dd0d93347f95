"""Classes of unlike texts and revealing terms against plain versions."""

import math
import random
import re
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from demandframe.llm import pii


def shingles(text):
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def classes(texts):
    """The class of each text: links by at least half of all shingles, followed to the end."""
    s, up = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in combinations(range(len(texts)), 2):
        if len(s[i] & s[j]) >= 0.5 * len(s[i] | s[j]):
            up[find(i)] = find(j)
    return {t: find(i) for i, t in enumerate(texts)}


def words(text):
    return {w for w in re.split(r"[\W\d_]+", text.lower()) if len(w) >= 2}


def plain_terms(rows, disclosure=0.8, least=3):
    texts = set(rows)
    where = defaultdict(set)
    for t in texts:
        for e in re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", t):
            where[e].add(t)
    where = {e: ts for e, ts in where.items() if len(ts) >= least}
    of = classes(sorted(set().union(*where.values())))
    holds = defaultdict(set)
    for t in texts:
        for w in words(t):
            holds[w].add(t)
    out = {}
    for e, ts in where.items():
        for w in set().union(*(words(re.sub(r"\S*[@0-9]\S*", " ", t)) for t in ts)):
            both = {t for t in ts if w in words(re.sub(r"\S*[@0-9]\S*", " ", t))}
            if len({of[t] for t in ts}) < least or len({of[t] for t in both}) < least:
                continue
            share = 1 - math.log2(max(len(holds[w]) / len(both), 1)) / math.log2(max(len(texts) / len(ts), 2))
            if share >= disclosure:
                out[w] = max(out.get(w, 0), share)
    return out


@pytest.fixture(scope="module")
def planted():
    """People with an address each, in texts of their own, in edited and exact copies of these, beside names that say less."""
    rng = random.Random(4)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru", "se") for b in ("ba", "de", "fi", "no", "tu") for c in ("l", "m", "n", "r", "s", "ng", "k", "t")]
    rows = [" ".join(rng.choices(vocabulary, k=40)) for _ in range(250)]
    for p in range(14):
        mail = f"person{p}@site{p % 3}.example"
        for k in range(rng.randint(2, 7)):
            w = rng.choices(vocabulary, k=40)
            w[rng.randrange(18)] = f"Name{'abcdefghijklmn'[p]}son"  # touches no digit
            if p % 2 == 0:
                w[rng.randrange(18, 30)] = "Helpdesk"  # seen with many addresses
            w[35] = mail
            text = " ".join(w)
            rows += [text] * rng.randint(1, 3)
            if p >= 10 and k == 0:  # many edited copies of one text are one context
                for _ in range(6):
                    v = list(w)
                    v[rng.randrange(30, 35)] = rng.choice(vocabulary)
                    rows.append(" ".join(v))
    rows += ["", "one", None, " "]
    rng.shuffle(rows)
    return rows


def test_terms_are_those_of_the_plain_version(spark, planted):
    expected = plain_terms([r or "" for r in planted])
    df = spark.createDataFrame(list(enumerate(planted)), "doc_id long, text string")
    found = {r.term: r.disclosure for r in pii.revealing_terms(df, pii.found_entities(df, "doc_id", "text")).collect()}
    assert found == pytest.approx(expected) and len(expected) >= 5
    assert any(w.startswith("name") for w in expected) and "helpdesk" not in expected


def test_spans_of_terms_are_their_places(spark, planted):
    df = spark.createDataFrame(list(enumerate(planted)), "doc_id long, text string")
    terms = set(plain_terms([r or "" for r in planted]))
    for r in pii.find(df).collect():
        text = planted[r.doc_id] or ""
        got = [(s.start, s.end, s.value) for s in r.spans if s.kind == len(pii.KINDS) - 1]
        assert got == [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W\d_]+", text) if m[0].lower() in terms]


def test_classes_keep_links_and_make_no_others(spark):
    """Chains of edits, crowds around one original, and pages of one template that are unlike each other."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for g in range(12):
        w = rng.choices(vocabulary, k=60)
        for _ in range(12):  # a chain, or a crowd around one text
            texts.append(" ".join(w))
            v = list(w)
            for at in rng.sample(range(60), 2):
                v[at] = rng.choice(vocabulary)
            if g % 2:
                w = v
            else:
                texts.append(" ".join(v))
    footer = rng.choices(vocabulary, k=20)
    texts += [" ".join(rng.choices(vocabulary, k=30) + footer) for _ in range(60)]
    texts = sorted(set(texts))
    exact = classes(texts)
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).alias("text_key"), "text")
    got = {r.text: r.context for r in pii._classes(df).join(df, "text_key").collect()}
    same = [(a, b) for a, b in combinations(texts, 2) if exact[a] == exact[b]]
    assert sum(got[a] == got[b] for a, b in same) >= 0.99 * len(same) and len(same) > 500
    assert all(exact[a] == exact[b] for a, b in combinations(texts, 2) if got[a] == got[b])


def test_all_texts_of_a_key_are_compared(spark):
    """Pages that share most of their text, and so their keys, but are unlike, except for pairs of them: the classes of all pairs that share a key."""
    rng = random.Random(5)
    shared = " ".join(f"s{i}" for i in range(190))
    texts = []
    for g in range(80):
        more = " ".join(f"m{g}x{i}" for i in range(16))
        texts += [f"{shared} {' '.join(f'p{g}y{k}z{i}' for i in range(80))} {more}" for k in range(2)]
        texts.append(f"{shared} {' '.join(f'q{g}z{i}' for i in range(100))}")
    rng.shuffle(texts)
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).alias("text_key"), "text")
    sets, keyed = pii._keyed(df)
    own = {r.node: set(r.h) for r in sets.collect()}
    keys = {}
    for r in keyed.collect():
        keys.setdefault(r.key, set()).add(r.node)
    links = {(a, b) for nodes in keys.values() for a, b in combinations(sorted(nodes), 2) if len(own[a] & own[b]) >= pii.ALIKE * len(own[a] | own[b])}
    # nearly all of them meet in large groups only
    assert len(links) > 50 and max(map(len, keys.values())) > 4 * pii.CHUNK
    first = {r.text_key: r.node for r in sets.collect()}
    got = {first[r.text_key]: r.context for r in pii._classes(df).collect()}
    assert all(got[a] == got[b] for a, b in links)
    assert len(set(got.values())) == len(own) - len(links)  # each pair is a class of its own


def test_words_are_counted_before_they_meet_pairs(spark, planted, monkeypatch):
    """Each word's different texts are those of a plain count, and no row per text and word reaches a join on the word."""
    df, joined = spark.createDataFrame(list(enumerate(planted)), "doc_id long, text string"), []
    join = type(df).join

    def noted(self, other, on=None, how="inner"):
        if on == "term" and set(self.columns) >= {"entity", "n_te"}:
            joined.append(other)
        return join(self, other, on, how)

    monkeypatch.setattr(type(df), "join", noted)
    kept, materialise = [], pii.materialise
    monkeypatch.setattr(pii, "materialise", lambda d, what="part", *f: (kept.append((what, d)), materialise(d, what, *f))[1])
    assert not pii.revealing_terms(df, pii.found_entities(df, "doc_id", "text")).isEmpty()
    holds = defaultdict(set)
    for t in {r or "" for r in planted}:
        for w in words(t):
            holds[w].add(t)
    assert len(planted) > len(set(planted))
    got = joined[-1].collect()
    assert {r.term: r.n_t for r in got} == {w: len(ts) for w, ts in holds.items()} and len(got) == len(holds)
    # below a join on the word, an aggregate folds the words as soon as texts are cut into them
    plan = next(d for what, d in kept if what == "terms")._jdf.queryExecution().optimizedPlan().toString()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above = []
    for line in plan.splitlines():
        above = [a for a in above if depth(a) < depth(line)] + [line]
        if "Generate explode" in line:
            last = next(a for a in reversed(above[:-1]) if "Join Inner" in a or "Aggregate" in a)
            assert "Aggregate [term" in last
