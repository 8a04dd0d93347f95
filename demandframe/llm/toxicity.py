"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, trained from labels of whole documents.

A sentence's score is the logistic function of a bias and the weights of its hashed words and character n-grams; a
document is clean only if all its sentences are: 1 - prod(1 - p). Only documents are labelled, so the gradient itself finds
the sentences that explain a label, and the same scores then locate them in new texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandframe.llm.common import held, materialise, release
from demandframe.llm.hashing import BITS, Bytes, bucket, gradient_steps, groups

#: Labelled documents of each class that the model is fitted on at most, features it keeps, and documents a feature needs.
SAMPLE, FEATURES, LEAST_DOCS = 2000, 3000, 4
SIZES = (4, 5, 6)
L1, L2 = 1e-4, 1e-5
_SPECIAL = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BREAK = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])


class Sentences(Bytes):
    """Words end at anything but letters and digits, sentences at ``. ! ?`` and line breaks."""

    def __init__(self, texts: Sequence[str]):
        super().__init__([t.lower().encode("utf-8", "replace") for t in texts], _SPECIAL)
        self.break_at = np.flatnonzero(_BREAK[self.raw])  # the first and the last byte are breaks
        # sentences with a word: (start, end) in bytes and the text they lie in
        words = np.searchsorted(self.break_at, self.word_at)
        self.number = np.unique(words)
        self.at, self.end = self.break_at[self.number - 1] + 1, self.break_at[self.number]
        self.text = np.searchsorted(self.starts, self.at, "right") - 1

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield self.word_at, bucket(self.word_hashes(), 0)
        for n in SIZES:
            yield self.ngrams(n)


class Model:
    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.table, self.bias = np.zeros(1 << BITS, np.float32), bias
        self.table[features] = weights

    def sentences(self, texts: Sequence[str]) -> tuple[Sentences, np.ndarray]:
        """The sentences of texts and the logits of each."""
        s = Sentences(texts)
        logit = np.full(len(s.text), self.bias)
        parts = []
        for at, f in s.features():
            told = np.flatnonzero(self.table[f])
            # of an n-gram that begins with the blank before a word, the word's sentence is what counts
            parts.append(np.searchsorted(s.end, at[told] + s.is_blank[at[told]], "right") << BITS | f[told])
        once = np.unique(np.concatenate(parts))  # a feature counts once in a sentence, as in training
        return s, logit + np.bincount(once >> BITS, self.table[once & ((1 << BITS) - 1)], minlength=len(logit))

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b in groups(texts):
            s, logit = self.sentences(texts[a:b])
            out[a:b] = -np.expm1(-np.bincount(s.text, np.logaddexp(0, logit), minlength=b - a))
        return out


def fit(texts: Sequence[str], toxic: np.ndarray, features: int = FEATURES, steps: int = 300) -> Model:
    """Fit on documents and their labels. The features kept are those whose share of toxic documents stands out most."""
    if not len(texts) or toxic.min() == toxic.max():
        return Model(np.zeros(0, int), np.zeros(0), float(-20 if not len(texts) or not toxic.max() else 0))
    y = toxic.astype(float)
    # once over the texts to choose features, once more to keep where the chosen ones stand: memory is that of one group
    seen, bad = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for a, b in groups(texts):
        s = Sentences(texts[a:b])
        if len(s.text):
            held = [np.unique(f << 32 | s.text[np.searchsorted(s.end, at + s.is_blank[at], "right")]) for at, f in s.features()]
            once = np.unique(np.concatenate(held))
            seen += np.bincount(once >> 32, minlength=1 << BITS)
            bad += np.bincount(once >> 32, y[a + (once & 0xFFFFFFFF)], minlength=1 << BITS)
    expected = seen * y.mean()
    stands_out = np.where(seen >= LEAST_DOCS, (bad - expected) / np.sqrt(expected * (1 - y.mean()) + 1), 0)
    kept = np.argsort(-stands_out, kind="stable")[:features]
    kept = kept[stands_out[kept] > 2]
    place = np.full(1 << BITS, -1)
    place[kept] = np.arange(len(kept))
    parts, n_sentences, doc_of = [np.zeros(0, np.int64)], 0, [np.zeros(0, np.int64)]
    for a, b in groups(texts):
        s = Sentences(texts[a:b])
        for at, f in s.features():
            at, f = at[place[f] >= 0], place[f[place[f] >= 0]]
            k = np.searchsorted(s.end, at + s.is_blank[at], "right")
            parts.append(np.unique((k + n_sentences) << BITS | f))
        doc_of.append(s.text + a)
        n_sentences += len(s.text)
    doc_of, pairs = np.concatenate(doc_of), np.unique(np.concatenate(parts))
    sentence, f = pairs >> BITS, pairs & ((1 << BITS) - 1)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))

    def gradient(w: np.ndarray) -> np.ndarray:
        logit = np.bincount(sentence, w[f], minlength=n_sentences) + w[-1]
        log_clean = np.bincount(doc_of, -np.logaddexp(0, logit), minlength=len(y))
        # d(-log p)/d(log_clean) for a toxic document, -1 for a clean one; the sentence's part is its own p
        outer = np.where(y > 0, np.exp(log_clean) / np.maximum(-np.expm1(log_clean), 1e-9), -1.0) * weight
        inner = outer[doc_of] * -1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        g = np.append(np.bincount(f, inner[sentence], minlength=len(kept)), inner.sum())
        g[:-1] += L1 + L2 * w[:-1]
        return g

    # a sentence is toxic by what it holds, never clean by it: no weight below zero
    floor = np.append(np.zeros(len(kept)), -30.0)
    w = gradient_steps(gradient, np.append(np.zeros(len(kept)), -6.0), steps, 0.2, floor)
    return Model(kept, w[:-1], float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> bytes:
    """A pickled Model, fitted by one task on at most ``sample`` labelled documents of each class (those of the smallest hash).

    Rows with a NULL doc_id or label, or a label without a document, teach nothing; of several labels the highest counts.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y is not null").groupBy("id").agg((F.max("y") > 0).cast("int").alias("y"))
    chosen = [known.where(F.col("y") == k).orderBy(F.xxhash64("id"), "id").limit(sample) for k in (0, 1)]
    chosen = materialise(chosen[0].union(chosen[1]), "sample")
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(chosen, "id")
    rows = rows.groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y"))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        all_ = [(t, y) for b in batches for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        model = fit([t for t, _ in all_], np.array([y for _, y in all_]))
        used = np.flatnonzero(model.table)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps((used, model.table[used], model.bias))]}, schema=pa.schema([("model", pa.binary())]))

    out = rows.select("text", "y", "id").repartition(1).sortWithinPartitions("id").select("text", "y").mapInArrow(fitted, "model binary").collect()
    return bytes(out[0].model) if out else pickle.dumps((np.zeros(0, int), np.zeros(0), -20.0))


def load(model: bytes) -> Model:
    return Model(*pickle.loads(model))


def _model(model: bytes) -> Model:
    return held(("toxicity", model), lambda: load(model))


def scored(docs: DataFrame, model: bytes, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with each whole text's score from 0 to 1; NULL and empty texts have 0. All rows stay, and all columns but one named ``out``, which the score replaces."""
    if text.lower() == out.lower():
        raise ValueError("the score can't replace the text it is taken from")
    docs = docs.select(*[c for c in docs.columns if c.lower() != out.lower()])
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                some = batch.slice(i, 512)
                texts = some.column(some.schema.get_field_index(text)).to_pylist()
                values = m.scores([t or "" for t in texts])
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(values)], names=[*some.schema.names, out])

    return docs.mapInArrow(run, schema)


def offending(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, sentence, probability) of the sentences whose own score is at least ``least``."""

    schema = pa.schema([("doc_id", pa.int64()), ("sentence", pa.string()), ("probability", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in groups(texts):
                s, logit = m.sentences(texts[a:b])
                p = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
                bad = np.flatnonzero(p >= least)
                raw = s.raw.tobytes()
                yield pa.RecordBatch.from_pydict({"doc_id": [ids[a + s.text[k]] for k in bad], "sentence": [raw[s.at[k] : s.end[k]].decode("utf-8", "replace").strip() for k in bad], "probability": p[bad]}, schema=schema)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, "doc_id long, sentence string, probability double")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
