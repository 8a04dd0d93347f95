import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandframe.llm import packing, sentencepiece_fst, token_store
from demandframe.llm.tokenise import ChunkEncoder

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "ß", "1", "23", ".", "!", "　", "́", "Σ", "<|endoftext|>", "😀", "xxxxx", "▁", "the", "ing", "梦想"]


def odd_texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(50))) for _ in range(n)] + ["", " ", "\n", "word " * 2000, "x" * 3000]


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda texts: [np.array(e.ids, "<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path, blank", [(BYTE, True), (WORD, False)])
@pytest.mark.parametrize("kept", [900_000, 50])
def test_chunks_give_the_library_s_ids(path, blank, kept):
    encoder, texts = ChunkEncoder(path, blank, kept), odd_texts(400)
    for part in (texts[:200], texts[200:], texts[:200]):
        assert encoder.encode(part) == [x.tobytes() for x in library(path)(part)]


@pytest.mark.parametrize("path, blank", [(BYTE, True), (WORD, False)])
def test_special_tokens_and_marks(path, blank):
    encoder, t = ChunkEncoder(path, blank, 50, special_as_text=False), Tokenizer.from_file(path)
    rng = random.Random(4)
    marked = [" ".join("".join(rng.choice(["a", "é", "ß", "the", "梦", "1", "'s", "x."]) for _ in range(rng.randrange(1, 5))) + rng.choice(["", ".", ",", "?!", ":", "'", ".'"]) for _ in range(30)) for _ in range(100)]
    texts = odd_texts(300, 2) + marked + ["a<|endoftext|>b", "<|endoftext|>", "\x1cb \x1f. \x85x\xa0y\u2028z"]
    for _ in range(2):
        assert encoder.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]


def odd_table(spark):
    texts = odd_texts(120, 1)
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)] + [(None, "null id"), (5000, None), (5001, "twice"), (5001, "twice")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as row_order").repartition(3), rows


def test_packing_is_an_exact_partition(spark):
    df, rows = odd_table(spark)
    ids = [np.append(x, 0).astype("<u4") for x in library(BYTE)([t or "" for _, t in rows])]
    limits = packing.Limits(tokens=128, segments=6, loss_tokens=128)
    got = packing.pack_documents(df, BYTE, 0, limits, with_ids=True).collect()
    # whole documents put together again, as a bag
    at, docs = defaultdict(list), []
    for r in sorted(got, key=lambda r: (str(r.doc_id), r.doc_tokens, r.start)):
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        at[r.doc_id, r.doc_tokens].append(r)
    for (d, n), pieces in at.items():
        assert sum(p.length for p in pieces) % n == 0
        if sum(p.length for p in pieces) == n:
            docs.append((d, b"".join(p.ids for p in pieces)))
    expected = [(d, x.tobytes()) for (d, _), x in zip(rows, ids, strict=True) if d != 5001]
    assert sorted(docs, key=str) == sorted(expected, key=str)
    padding = 0
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0] + [p.length for p in pieces])[:-1].tolist()
        used = sum(p.length for p in pieces)
        assert used <= 128 and len(pieces) <= 6
        padding += (128 - used) if used & (used - 1) else 0
    assert padding <= 0.1 * sum(map(len, ids))
    assert packing.pack_documents(df.limit(0), BYTE, 0).count() == 0


def test_examples_keep_all_three_limits(spark):
    rng = random.Random(0)
    rows = [(i, n := rng.randrange(1, 400), rng.randrange(0, n + 1)) for i in range(600)] + [(900, 2000, 3), (901, None, 1), (902, 10, 900), (None, 5, 5), (903, 0, 0)]
    limits = packing.Limits(1024, 8, 500)
    got = packing.pack_examples(spark.createDataFrame(rows, "id long, tokens long, loss long"), "id", "tokens", "loss", limits).collect()
    assert sorted((str(r.id), r.tokens, r.loss) for r in got) == sorted((str(a), b, c) for a, b, c in rows) if None not in [r.tokens for r in got] else len(got) == len(rows)
    assert {r.id for r in got if r.sequence_id is None} == {900, 901, 902}
    by = defaultdict(list)
    for r in got:
        if r.sequence_id is not None:
            by[r.sequence_id].append(r)
    for rs in by.values():
        assert sum(r.tokens for r in rs) <= 1024 and len(rs) <= 8 and sum(r.loss for r in rs) <= 500
    # near the bound that the scarcest limit gives
    least = max(sum(r.tokens for rs in by.values() for r in rs) / 1024, sum(r.loss for rs in by.values() for r in rs) / 500)
    assert len(by) <= 1.3 * least + 8


def test_cutting_a_piece_takes_what_is_left():
    pool = packing.Pool(packing.Limits(10, 3, 10), cut=True)
    for name, n in (("a", 7), ("b", 7), ("c", 7)):
        pool.add(name, n, n)
    filled = []
    while len(pool):
        filled.append([n for _, n in pool.fill()])
    assert sum(map(sum, filled)) == 21 and [sum(f) for f in filled] == [10, 10, 1]
    assert packing.powers(1000) == [512, 256, 128, 64, 32, 8]


@pytest.mark.parametrize("top", [1, 200, 256, 49408, 1 << 31])
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_shard_gives_any_id(top, n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype("<u4")
    ids[::3] %= 100
    shard = token_store.Shard(token_store.pack_ids(ids, np.array([0, n // 2, n])))
    assert (shard.ids() == ids).all() and len(shard) == n and shard.starts.tolist() == [0, n // 2, n]
    assert all(shard[i] == ids[i] for i in range(0, n, 13))
    for a, b in ((0, n), (n // 3, n // 2), (n - 1, n + 5), (7, 7)):
        if 0 <= a:
            assert (shard.ids(a, b) == ids[a:b]).all()
    with pytest.raises(IndexError):
        shard[n]
    with pytest.raises(ValueError):
        token_store.Shard(b"nothing of the kind")


def test_store_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_IDS", 300)
    df, rows = odd_table(spark)
    path = token_store.write(df, WORD, 2)
    got = token_store.read_documents(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    texts = defaultdict(list)
    for d, t in rows:
        texts[d].append(np.append(library(WORD)([t or ""])[0], 2).tolist())
    assert all(r.ids in texts[r.doc_id] and r.n_tokens == len(r.ids) for r in got)
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in token_store.read_digest(spark, path).collect()}
    assert digest == {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}
    empty = token_store.write(df.limit(0), WORD, 2)
    assert token_store.read_digest(spark, empty).count() == 0


def test_shortest_path_is_the_library_s_encoding():
    import sentencepiece

    sp, mine = sentencepiece.SentencePieceProcessor(model_file=PIECE), sentencepiece_fst.transducer(PIECE)
    for t in odd_texts(800, 3) + ["  lead", "trail  ", "a" * 40, "=" * 50, "\x00\x01", "ＡＢ ﬁ"]:
        ids = mine.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == sp.encode(t), t
        assert mine.decode(ids) == t.replace("▁", " "), t


def test_pieces_on_documents(spark, documents, odd_docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for df in (documents, odd_docs):
        got = sentencepiece_fst.decode(sentencepiece_fst.encode(df, PIECE), PIECE).collect()
        expected = [(r.doc_id, np.array(sp.encode(r.text or ""), "<u4").tobytes(), r.text or "") for r in df.select("doc_id", "text").collect()]
        assert sorted(((r.doc_id, bytes(r.ids), r.text) for r in got), key=str) == sorted(expected, key=str)
    assert sentencepiece_fst.encode(odd_docs.limit(0), PIECE).count() == 0


def test_the_arcs_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(sentencepiece_fst, "ARCS", 20)
    monkeypatch.setattr(sentencepiece_fst, "WORDS", 5)
    small, full = sentencepiece_fst.Transducer(PIECE), sentencepiece_fst.transducer(PIECE)
    for t in odd_texts(60, 4):
        assert small.encode(t) == full.encode(t)


@pytest.mark.parametrize("path, blank", [(BYTE, True), (WORD, False)])
@pytest.mark.parametrize("special_as_text", [True, False])
def test_words_go_to_the_model(path, blank, special_as_text):
    """Ids are the library's for words of all the letters that go to its model, with marks and line ends, and such words go no other way."""
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = special_as_text
    rng, encoder = random.Random(6), ChunkEncoder(path, blank, 500, special_as_text)
    letters = [chr(c) for c in range(0xC0, 0x100)] + list("abcdefghijklmnopqrstuvwxyzABCST") * 2 + ["'s", "µ", "ª"]
    word = lambda: "".join(rng.choices(letters, k=rng.randrange(1, 12))) + rng.choice(["", "", ".", ",\n", "\n", ".\n", "!?", "'", "***", ".\n\n", "$%&#!", "\t"])
    texts = ["".join(word() + rng.choice([" ", " ", ""]) for _ in range(60)).rstrip() for _ in range(300)] + ["<|EndOfText|> A.", "<|endoftext|> A", "A<|endoftext|", "İi A, Σ Σ."]
    for _ in range(2):
        assert encoder.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    went = []
    encoder._chunks = lambda chunks: went.extend(chunks) or iter(())
    encoder.encode(["x Newword, Éàword newerword."])
    assert went == []
    encoder.encode(["x newestword,\nÉànewestword."])  # a line's end between words
    assert went == []


def test_memory_of_a_worker():
    """Chunks are forgotten however short they are, and a worker keeps one vocabulary or model, not those of all stages."""
    from demandframe.llm import common, tokenise, toxicity

    path, words = public_tokenizers.path("byte_bpe_50k.json"), [f"{k:06x}" for k in range(4000)]
    encoder = tokenise.encoder(path, True, kept=1000)
    for i in range(0, 4000, 100):
        encoder.encode([" ".join(words[i : i + 100])])
        assert len(encoder.memo) <= 1000
    assert tokenise.encoder(path, True, kept=1000) is encoder
    model = toxicity._model(toxicity.pickle.dumps((np.array([3]), np.array([0.5]), -1.0)))
    assert list(common._HELD.values()) == [model]
    assert tokenise.encoder(path, True, kept=1000) is not encoder
    common.release()
    assert not common._HELD
