import random
import re
import zlib
from collections import Counter

import pytest

from demandframe.llm import queries, spelling


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_pairs(words):
    """Candidates by the letters left when one is taken out, then the definition."""
    by = {}
    for w in words:
        for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by.setdefault(k, set()).add(w)
    return {(a, b) for ws in by.values() for a in ws for b in ws if near(a, b)}


def plain_groups(counts, times=5):
    others, out = {}, {}
    for a, b in plain_pairs(counts):
        others.setdefault(a, set()).add(b)
    for w, n in counts.items():
        best = min(others.get(w, ()), key=lambda o: (-counts[o], o), default=None)
        out[w] = best if best is not None and counts[best] >= times * n else None
    def root(w):
        return root(out[w]) if out[w] is not None else w
    return sorted(((w, n, len(others.get(w, ())), counts[f] if f is not None else None, f, root(w)) for (w, n), f in zip(counts.items(), out.values())), key=str)


def some_words(sizes, alphabet, n, seed):
    rng = random.Random(seed)
    words = set()
    for _ in range(n):
        w = "".join(rng.choice(alphabet) for _ in range(rng.choice(sizes)))
        words.add(w)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(w) + 1)
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(alphabet) + w[k:], w[:k] + rng.choice(alphabet) + w[k + 1 :]])
            words.add(w)
    return sorted(words)


@pytest.mark.parametrize("sizes, alphabet", [
    (range(6, 13), "abcé"), (range(8), "ab"), (range(14, 45), "ab"), ([15, 16, 17, 23, 24, 25, 33, 300], "a"), ([16, 17, 24, 40], "xy😀"),
])
def test_all_pairs_are_found(spark, sizes, alphabet):
    words = some_words(list(sizes), alphabet, 150, len(alphabet))
    df = spark.createDataFrame([(w,) for w in words] + [(None,), (words[0],)], "word string").repartition(3)
    got = [tuple(r) for r in spelling.neighbours(df).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_pairs(words)


def test_forms_and_roots(spark):
    rng = random.Random(2)
    words = some_words(range(4, 9), "abc", 100, 8)
    counts = {w: rng.choice([1, 5, 5, 25, 26, 125, 700, 5000]) for w in words} | {"zzzzzz": 5, "zzzzzy": 25, "zzzzyy": 125, "zzzyyy": 625, "zzyyyy": 3125}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").selectExpr("*", "1 as node", "2 as level")
    got = spelling.groups(df).select("word", "n", "n_near", "form_n", "form", "root")
    assert sorted(map(tuple, got.collect()), key=str) == plain_groups(counts)
    assert spelling.groups(df.limit(0)).count() == 0
    lone = spelling.groups(spark.createDataFrame([("lonely", 3)], "word string, n long")).collect()
    assert [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in lone] == [("lonely", None, "lonely", 3, 0, None)]


def plain_words(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 5 and len(w) >= 6}


def test_words(spark, odd_docs, documents):
    rows = [(i % 50, "Abcdef ÀÉabcdé× " + "x" * 700 + " short 12345 Zzzzzzz÷") for i in range(1500)]
    rows += [(r.doc_id, r.text) for r in odd_docs.collect() for _ in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as run", "2 as word", "3 as h")
    assert {r.word: r.n for r in queries.mangled_words(df).collect()} == plain_words(rows)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert {r.word: r.n for r in queries.mangled_words(documents).collect()} == plain_words(rows)


def test_query(spark, documents):
    expected = plain_groups(plain_words([(r.doc_id, r.text) for r in documents.collect()]))
    got = queries.op13_spelling(spark, "/root/testdata/sf0.001").select("word", "n", "n_near", "form_n", "form", "root").collect()
    assert sorted(map(tuple, got), key=str) == expected
