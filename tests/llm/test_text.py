import tracemalloc
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandframe.llm import hashing, pii, quality, toxicity

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def fine(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
        return 14 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0
    return kind != "phone" or 10 <= len(d) <= 15


def base_spans(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if fine(kind, m.group())]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_base_spans_of_odd_texts(spark):
    rng = random.Random(3)
    parts = ["a", "b@c.d", "@", ".", "..", "1", "12", "255", "256", "+", "+4", "-", " ", "_", "%", "é", "😀", "4111111111111111", "4111 1111 1111 1111", "10.0.0.1", "\n", "(0)", "5", ".e", "+49 30 1234567"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["", "9" * 20_000, "a" * 50_000, "1." * 5000, "+1" + " " * 5000, "a@b.c," * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in df.select("doc_id", pii.told(pii._base_spans(F.col("text"))).alias("s")).collect()}
    assert all(got[i] == base_spans(t) for i, t in enumerate(texts))


def test_terms_that_give_an_entity_away(spark):
    rng = random.Random(1)
    rows = [(i, f"Agent Zorblax number {i} wrote from zed@x.org on day {'abcdef'[i]}\n" + " ".join(word(rng) for _ in range(30))) for i in range(6)]
    rows += [(10 + i, f"Agent number {i} wrote on day {i} from home") for i in range(200)]
    base = [word(rng) for _ in range(80)]  # one text, however often, and with a word changed here and there
    rows += [(400 + i, "Copied Quuxfoo mail q@y.org\n" + " ".join(base[: i % 7 + 70] + [word(rng)] * (i % 2))) for i in range(50)]
    rows += [(500, "Zorblax without mail"), (501, None), (None, "zorblax"), (500, "Zorblax without mail")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as term")
    found = pii.find(df).collect()
    words = Counter(s.value.lower() for r in found for s in r.spans if s.kind == 4)
    assert words["zorblax"] == 6 + 3 and not words.keys() & {"agent", "wrote", "from", "quuxfoo", "number"}
    assert len(found) == len(rows)
    clean = pii.sanitise(df)
    texts = [r.text for r in clean.collect()]
    assert clean.columns == df.columns and len(texts) == len(rows) and texts.count(None) == 1
    assert not any("zed@" in t or "orblax" in t for t in texts if t) and any(t.startswith("Agent [TERM] number 0 wrote from [EMAIL] on day a\n") for t in texts if t)


def terms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {s.value.lower() for r in pii.find(df).collect() for s in r.spans if s.kind == 4}


def test_terms_stay_terms_in_many_texts(spark):
    rng = random.Random(2)
    common, words = ["the", "of", "and", "to"], [word(rng) for _ in range(3000)]
    body = lambda: " ".join(rng.choice(common if k % 2 else words) for k in range(150))
    # texts that are really different but share their frequent words
    assert "zorblax" in terms(spark, [f"Zorblax zed@x.org\n{body()}" for _ in range(400)] + [body() for _ in range(600)])


def test_copies_take_no_terms_away(spark):
    rng = random.Random(3)
    body = lambda: " ".join(word(rng) for _ in range(60))
    texts = [f"Zorblax zed@x.org\n{body()}" for _ in range(5)]
    assert terms(spark, texts + [texts[0]] * 300 + [body() for _ in range(200)]) == {"zorblax"}


def test_terms_on_other_lines_and_short_names(spark):
    rng = random.Random(4)
    body = lambda: " ".join(word(rng) + "xx" for _ in range(40))
    texts = [f"{body()}\nKim\n李\n{body()}\nWu: kim@x.org\n{body()}\nZorblax" for _ in range(4)]
    assert terms(spark, texts + [body() for _ in range(200)]) == {"kim", "李", "wu", "zorblax"}


def test_overlapping_spans_become_one(spark):
    df = spark.createDataFrame([(1, "call +10.0.0.1234567 now"), (2, "a@10.0.0.1 😀 b@c.de!")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.sanitise(df).collect()} == {1: "call [PHONE] now", 2: "[EMAIL] 😀 [EMAIL]!"}


def test_personal_data_in_documents_and_odd_rows(spark, documents, odd_docs):
    for df in (documents, odd_docs):
        base = F.filter("spans", lambda s: s["kind"] < 4)
        got = sorted(((r.doc_id, r.s) for r in pii.find(df).select("doc_id", F.sha2(pii.told(base), 256).alias("s")).collect()), key=str)
        assert got == sorted(((r.doc_id, hashlib.sha256(base_spans(r.text or "").encode()).hexdigest()) for r in df.select("doc_id", "text").collect()), key=str)
    assert pii.sanitise(odd_docs).count() == odd_docs.count()
    assert pii.find(odd_docs.limit(0)).count() == 0


def word(rng):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 8)))


def labelled(n, seed):
    """Documents of many sentences; the toxic ones hold one or two sentences with a bad word."""
    rng = random.Random(seed)
    common = [word(random.Random(k)) for k in range(300)]
    rows = []
    for i in range(n):
        s = [" ".join(rng.choice(common) for _ in range(8)) for _ in range(rng.randrange(3, 30))]
        bad = i % 3 == 0
        for _ in range(rng.randrange(1, 3) if bad else 0):
            s[rng.randrange(len(s))] += " " + rng.choice(["vilest", "vilely", "scummy", "scumbag"])
        rows.append((i, ". ".join(s) + ".", int(bad)))
    return rows


def test_toxicity_from_document_labels(spark):
    train, test = labelled(500, 1), labelled(300, 2)
    docs = spark.createDataFrame([(i, t) for i, t, _ in train], "doc_id long, text string").selectExpr("*", "1 as score")
    labels = spark.createDataFrame([(i, y) for i, _, y in train] + [(None, 1), (3, None), (99_999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scored = toxicity.scored(spark.createDataFrame(test, "doc_id long, text string, y int"), model).collect()
    assert np.mean([(r.score >= 0.7) == r.y for r in scored]) > 0.97
    bad = toxicity.offending(docs, model).collect()
    assert bad and np.mean([bool(re.search("vile|scum", r.sentence)) for r in bad]) > 0.97


def test_toxicity_of_odd_rows(spark, odd_docs):
    nothing = toxicity.train(odd_docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.scored(odd_docs, nothing, out="p").collect()
    assert len(got) == odd_docs.count() and all(r.p < 0.01 for r in got) and all(r.p == 0 for r in got if not (r.text or "").strip())
    assert toxicity.scored(odd_docs.limit(0), nothing, out="p").count() == 0
    only = toxicity.train(odd_docs, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int"))
    assert all(0 <= r.p <= 1 for r in toxicity.scored(odd_docs, only, out="p").collect())


def test_toxicity_score_replaces_a_column_of_its_name(spark, odd_docs):
    nothing = toxicity.train(odd_docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.scored(odd_docs.selectExpr("*", "'old' as Score"), nothing)
    assert [c for c in got.columns if c.lower() == "score"] == ["score"] and got.where("score > 0.01").count() == 0
    with pytest.raises(ValueError, match="replace the text"):
        toxicity.scored(odd_docs, nothing, out="text")


def test_noisy_or_over_sentences():
    m = toxicity.Model(np.zeros(0, int), np.zeros(0), -2.0)
    p = 1 / (1 + np.exp(2.0))
    assert np.allclose(m.scores(["one. two! three?", "", "...", "one one one"]), [1 - (1 - p) ** 3, 0, 0, p])


def test_held_out_rows(spark):
    import zlib

    got = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


def counted(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    three = list(zip(w, w[1:], w[2:], strict=False))
    many = Counter(three)
    inside = {i + k for i, x in enumerate(three) if many[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)


@pytest.mark.parametrize("text", ["", "a", "a b c", "a b c a b c a", "a a a a", "é\n\né\n é\né", "\x1c \x85 \xa0 x", "#*$%&|<> \n \n", "w " * 5000, "x\ry\x0bz\x0cq"])
def test_counts(text):
    assert quality.counts(text) == counted(text)


def test_quality_on_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.train(documents, labels)
    got = {r.doc_id: r for r in quality.judged(documents, model).collect()}
    text = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    for d, r in got.items():
        assert tuple(r)[1:6] == counted(text[d])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.probability >= 0.5)
    known = [r for r in labels.collect() if not got[r.doc_id].base_failed]
    assert np.mean([got[r.doc_id].kept == r.quality for r in known]) > 0.9


def test_quality_learns_junk(spark):
    rng = random.Random(5)

    def row(i, junk):
        w = [word(rng) for _ in range(120)]
        return i, " ".join(x.upper() + "!!" if junk else x for x in w), int(not junk)

    train, test = [row(i, i % 4 == 0) for i in range(300)], [row(i, i % 4 == 0) for i in range(200)]
    model = quality.train(spark.createDataFrame(train, "doc_id long, text string, q int"), spark.createDataFrame([(i, q) for i, _, q in train], "doc_id long, quality int"))
    got = quality.judged(spark.createDataFrame(test, "doc_id long, text string, q int"), model).collect()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in got)


def test_quality_fit_holds_one_group_of_texts(monkeypatch):
    """Texts of very many different n-grams: the same model however they are grouped, in memory that does not grow with them."""
    rng = random.Random(3)
    good = np.array([i % 3 > 0 for i in range(60)])
    texts = [" ".join(("%x" % rng.getrandbits(64)) + (" fine" if g else " junk") * (k % 5 == 0) for k in range(2000)) for g in good]
    tracemalloc.start()
    one = quality.fit(texts, good)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    monkeypatch.setattr(hashing, "GROUP", 1 << 15)
    two = quality.fit(texts, good)
    assert np.allclose(one.probabilities(texts), two.probabilities(texts), atol=1e-6)
    assert np.mean((one.probabilities(texts) >= 0.5) == good) > 0.9


def test_quality_of_odd_rows(spark, odd_docs):
    model = quality.train(odd_docs.limit(0), spark.createDataFrame([], "doc_id long, quality int"))
    got = quality.judged(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and not any(r.kept for r in got if r.n_words < 50)
    assert quality.judged(odd_docs.limit(0), model).count() == 0
