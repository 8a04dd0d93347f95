import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE
from test_tokens import odd_texts

from demandframe.llm import bpe_backtrack, queries
from demandframe.llm.bpe_backtrack import Merges, Offsets
from demandframe.llm.tokenise import Recent

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
SPECIAL = ["<|endoftext|>", "a<|startoftext|> b<|endoftext|>", "<|EndOfText|> <|endoftext|", "İΣς Σ\x1c\x1d x\x85y z", "a" * 5000, "é ́ x"]


def some_texts():
    rng = random.Random(3)
    mixed = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(128, 0x2000), rng.randrange(97, 103)])) for _ in range(rng.randrange(60))) for _ in range(300)]
    return odd_texts(300) + mixed + ["".join(rng.choice("abinthe ") for _ in range(200)) for _ in range(200)] + SPECIAL


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_and_texts_are_the_library_s(path):
    m, library, texts = Merges(path), Tokenizer.from_file(path), some_texts()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from what is known
        assert [np.frombuffer(x, "<u4").tolist() for x in m.encode(texts)] == expected
    ends = np.cumsum([len(x) for x in expected])
    assert Offsets(path).decode(np.array(sum(expected, []), np.int64), ends).to_pylist() == library.decode_batch(expected, skip_special_tokens=False)


def merged(symbols, ranks):
    """Byte-pair merges by their definition: the lowest rank first, the leftmost of equals."""
    parts = list(symbols)
    while True:
        found = [(ranks[a, b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (a, b) in ranks]
        if not found:
            return parts
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_random_vocabularies(tmp_path):
    """Merges that shadow each other, equal strings by other merges, tokens that no text gives."""
    rng = random.Random(5)
    for k in range(12):
        tokens, ranks = ["a", "b", "c"], {}
        while len(ranks) < 40:
            a, b = rng.choice(tokens), rng.choice(tokens)
            if (a, b) not in ranks and len(a + b) < 9:
                ranks[a, b] = len(ranks)
                if a + b not in tokens:
                    tokens.append(a + b)
        path = str(tmp_path / f"{k}.json")
        vocab = {t: i for i, t in enumerate(tokens)}
        Tokenizer(BPE(vocab, [*ranks])).save(path)
        m = Merges.__new__(Merges)
        m.end, m.words, m.pairs = "", Recent(50, 48), {}
        m._tokens(vocab, [*ranks])
        words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 40))) for _ in range(300)] + ["a" * 50, "ab" * 30]
        for w, ids in zip(words * 2, m._words(words) + m._words(words)):
            expected = merged(w, ranks)
            if all(vocab[t] in m.right for t in expected):
                assert [tokens[i] for i in np.frombuffer(ids, "<u4")] == expected, (k, w)


def test_rows(spark, odd_docs):
    library = Tokenizer.from_file(WORD)
    ids = bpe_backtrack.encode(odd_docs.withColumn("ids", F.lit("old")), WORD)
    back = bpe_backtrack.decode(ids, WORD)
    assert sorted(back.columns) == sorted([*odd_docs.columns, "ids"])
    got = sorted((str(r.doc_id), r.ids, r.text) for r in back.collect())
    texts = [(str(r.doc_id), library.encode(r.text or "", add_special_tokens=False).ids) for r in odd_docs.collect()]
    assert got == sorted((d, i, library.decode(i, skip_special_tokens=False)) for d, i in texts)
    assert bpe_backtrack.decode(bpe_backtrack.encode(odd_docs.limit(0), WORD), WORD).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 5, 10**6, -1])], "k int, ids array<int>")
    assert [r.text for r in bpe_backtrack.decode(odd, WORD).orderBy("k").collect()] == ["", "", library.decode([5])]


def test_query(spark):
    import hashlib

    library, folder = Tokenizer.from_file(WORD), "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = {}
    for d, t in zip(docs.doc_id, docs.text):
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected[d] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    got = queries.op11_bpe(spark, folder).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == expected and len(got) == len(docs)


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_new_words_cost_no_step_of_their_own(monkeypatch):
    """Plain words that were never seen: the library's cutter sees none of them, and no loop runs over one word alone."""
    rng = random.Random(7)
    m, library = Merges(WORD), Tokenizer.from_file(WORD)
    words = ["".join(rng.choice(["th", "er", "ation", "é", "ß", "Un", "z"]) for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    texts = [" ".join(w + rng.choice(["", ",", ".", "!!"]) for w in words[i : i + 100]) for i in range(0, len(words), 100)]
    cut, alone, seen = m.cut, m._word, []
    monkeypatch.setattr(m, "cut", lambda s: seen.append(len(s)) or cut(s))
    monkeypatch.setattr(m, "_word", lambda *a: seen.append(1000) or alone(*a))
    got = [np.frombuffer(x, "<u4").tolist() for x in m.encode(texts)]
    assert sum(seen) < 100, sum(seen)
    assert got == ids_of(library, texts)


def test_plain_words_and_marks(monkeypatch):
    monkeypatch.setattr(bpe_backtrack, "TAILS", 3)
    rng = random.Random(8)
    m, library = Merges(WORD), Tokenizer.from_file(WORD)
    assert m.plain_words and not Merges(BYTE).plain_words
    letters, marks = "abzAÀÖØöøÿßÞẞŸ×÷ªµ", "!'\"-_`~{}#*.,$"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))) + "".join(rng.choice(marks) for _ in range(rng.randrange(6))) for _ in range(3000)]
    texts += ["don't", "we'll'", "L'été,", "éa!", "a̧", "A" * 48 + "!", "A" * 49 + "!", "é" * 48, "<|endoftext|", "a'S", "ab's."]
    for _ in range(2):
        for i in range(0, len(texts), 500):
            assert [np.frombuffer(x, "<u4").tolist() for x in m.encode(texts[i : i + 500])] == ids_of(library, texts[i : i + 500])


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_together_as_alone(path, monkeypatch):
    """Short words, long words in stretches, and a table of pairs with few places."""
    monkeypatch.setattr(bpe_backtrack, "PLACES", 5)
    rng = random.Random(9)
    m, library = Merges(path), Tokenizer.from_file(path)
    words = ["".join(rng.choice("abinthe") for _ in range(n)) for n in [*range(1, 60)] * 5 + [200, 500, 3000, 20_000]] + ["a" * n for n in (1, 2, 47, 48, 49, 3000)]
    expected = ids_of(library, words)
    assert [np.frombuffer(x, "<u4").tolist() for x in m._together(words)] == expected
    assert [np.frombuffer(x, "<u4").tolist() for w in (words, words[-1:]) for x in m._alone(w)] == [*expected, expected[-1]]
    assert [np.frombuffer(x, "<u4").tolist() for x in m._words(words)] == expected


def test_edges():
    rng = random.Random(10)
    child = {rng.randrange(1000) * 50 + rng.randrange(50): i for i in range(20_000)}
    edges = bpe_backtrack.Edges(child, 50)
    nodes, symbols = (x.ravel() for x in np.meshgrid(np.arange(1000), np.arange(50)))
    assert edges.find(nodes, symbols).tolist() == [child.get(k, -1) for k in (nodes * 50 + symbols).tolist()]
