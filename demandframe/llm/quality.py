"""Quality rules: base counts, and a calibrated logistic regression on hashed word and character n-grams.

A text's features are the shares of its words' hashes, of its pairs of neighbouring words, and of its character n-grams
inside words, all case-sensitive; one more feature is the share of words that repeat the word before. The regression is fitted on
labelled rows, and its output on rows kept out of the fit is mapped to a probability (a line in the logit), so the
fixed threshold is on a probability. Texts are scored in Arrow batches.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.llm.common import materialise
from demandframe.llm.hashing import BITS, Bytes, bucket, gradient_steps, groups

#: Labelled documents of each class that the model is fitted on at most, features it keeps, and documents a feature needs.
SAMPLE, FEATURES, LEAST_DOCS = 2000, 3000, 5
SIZES = (2, 3, 4)
#: Kept if the probability of good quality is at least this.
THRESHOLD = 0.5
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\x0b\x0c\r"
_BLANK = np.isin(np.arange(256), [ord(c) for c in BLANKS])
_SAME = 0  # the feature of a word that repeats the last one


class Words(Bytes):
    def __init__(self, texts: Sequence[str]):
        super().__init__([t.encode("utf-8", "surrogatepass") for t in texts], _BLANK)
        self.word_text = np.searchsorted(self.starts, self.word_at, "right") - 1
        self.n_words = np.bincount(self.word_text, minlength=len(texts))

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, feature) of every n-gram."""
        h = self.word_hashes()
        yield self.word_text, bucket(h, 0)
        two = np.flatnonzero(self.word_text[1:] == self.word_text[:-1])
        same = h[two] == h[two + 1]
        yield self.word_text[two], np.where(same, _SAME, bucket(h[two] * np.uint64(3) ^ h[two + 1], 1))
        for n in SIZES:
            at, f = self.ngrams(n)
            yield np.searchsorted(self.starts, at + 1, "right") - 1, f


class Model:
    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.table, self.bias, self.slope, self.shift = np.zeros(1 << BITS), bias, slope, shift
        self.table[features] = weights

    def probabilities(self, texts: Sequence[str]) -> np.ndarray:
        """Of good quality; for a text without a word, that of a text without features."""
        out = np.zeros(len(texts))
        for a, b in groups(texts):
            w = Words(texts[a:b])
            total = sum(np.bincount(t, self.table[f], minlength=b - a) for t, f in w.features())
            out[a:b] = total / np.maximum(w.n_words, 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * (out + self.bias) + self.shift, -50, 50)))


def fit(texts: Sequence[str], good: np.ndarray, stands_for: np.ndarray | None = None, features: int = FEATURES, steps: int = 300) -> Model:
    """Fit on texts and their labels; every fifth text is kept out of the fit and calibrates it.

    ``stands_for``: of how many labelled texts each is the sample, so that probabilities hold for all of them.
    """
    stands_for = np.ones(len(texts)) if stands_for is None else stands_for
    if not len(texts) or good.min() == good.max():
        return Model(np.zeros(0, int), np.zeros(0), 0.0, 0.0, 20.0 if not len(texts) or good.max() else -20.0)
    y = good.astype(float)
    fitted = np.arange(len(y)) % 5 != 4
    if y[fitted].min() == y[fitted].max():
        fitted[:] = True
    n = np.array([(fitted & (y == k)).sum() for k in (0, 1)])

    def shares(chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, feature, share of its words) of the chosen features, for a group of texts at a time."""
        for a, b in groups(texts):
            w = Words(texts[a:b])
            found = [np.unique((t[u] + a) << BITS | f[u], return_counts=True) for t, f in w.features() for u in [chosen[f]]]
            pairs, counts = (np.concatenate(z) for z in zip(*found, strict=True))
            yield pairs >> BITS, pairs & ((1 << BITS) - 1), counts / np.maximum(w.n_words, 1)[(pairs >> BITS) - a]

    # once over the texts to choose features, once more to keep where the chosen ones stand: memory is that of one group
    seen, sums, squares = np.zeros(1 << BITS), np.zeros((2, 1 << BITS)), np.zeros((2, 1 << BITS))
    for doc, f, x in shares(np.ones(1 << BITS, bool)):
        seen += np.bincount(f, fitted[doc], minlength=1 << BITS)
        for k in (0, 1):
            mine = (fitted & (y == k))[doc]
            sums[k] += np.bincount(f[mine], x[mine], minlength=1 << BITS)
            squares[k] += np.bincount(f[mine], x[mine] ** 2, minlength=1 << BITS)
    mean = [sums[k] / n[k] for k in (0, 1)]
    var = [np.maximum(squares[k] / n[k] - mean[k] ** 2, 0) for k in (0, 1)]
    apart = np.where(seen >= LEAST_DOCS, np.abs(mean[1] - mean[0]) / np.sqrt(var[0] / n[0] + var[1] / n[1] + 1e-12), 0)
    kept = np.argsort(-apart, kind="stable")[:features]
    kept = kept[apart[kept] > 2]
    scale = np.sqrt((var[0] + var[1])[kept] / 2 + (mean[1] - mean[0])[kept] ** 2 / 4) + 1e-9
    place = np.full(1 << BITS, -1)
    place[kept] = np.arange(len(kept))
    doc, f, x = (np.concatenate(z) for z in zip(*shares(place >= 0), strict=True))
    f = place[f]
    x = x / scale[f]
    weight = np.where(fitted, np.where(y > 0, 0.5 / n[1], 0.5 / n[0]), 0)

    def logits(w: np.ndarray) -> np.ndarray:
        return np.bincount(doc, w[f] * x, minlength=len(y)) + w[-1]

    def gradient(w: np.ndarray) -> np.ndarray:
        g = weight * (1 / (1 + np.exp(-np.clip(logits(w), -50, 50))) - y)
        out = np.append(np.bincount(f, g[doc] * x, minlength=len(kept)), g.sum())
        out[:-1] += 1e-2 * w[:-1]
        return out

    w = gradient_steps(gradient, np.zeros(len(kept) + 1), steps, 0.05)
    z = logits(w)
    held = ~fitted if (~fitted).any() else fitted

    def line(ab: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(ab[0] * z[held] + ab[1], -50, 50)))
        # labels drawn in from 0 and 1, as few rows can't show certainty
        t = np.where(y[held] > 0, (y[held].sum() + 1) / (y[held].sum() + 2), 1 / ((1 - y[held]).sum() + 2))
        return np.array([np.average((p - t) * z[held], weights=stands_for[held]), np.average(p - t, weights=stands_for[held])])

    slope, shift = gradient_steps(line, np.array([1.0, 0.0]), 400, 0.02)
    return Model(kept, w[:-1] / scale, float(w[-1]), float(max(slope, 0.01)), float(shift))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> bytes:
    """A pickled model, fitted by one task on at most ``sample`` labelled documents of each class (those of the smallest hash).

    Rows with a NULL doc_id or label, or a label without a document, teach nothing; of several labels the lowest counts.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y is not null").groupBy("id").agg((F.min("y") > 0).cast("int").alias("y"))
    chosen = [known.where(F.col("y") == k).orderBy(F.xxhash64("id"), "id").limit(sample) for k in (0, 1)]
    chosen = chosen[0].union(chosen[1]).join(known.groupBy("y").agg(F.count("*").alias("n")), "y")
    chosen = materialise(chosen.select("id", "y", (F.col("n") / F.least("n", F.lit(sample))).alias("stands_for")), "sample")
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(chosen, "id")
    rows = rows.groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y"), F.max("stands_for").alias("stands_for"))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ = [x for b in batches for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        m = fit([t for t, _, _ in all_], np.array([y for _, y, _ in all_]), np.array([n for _, _, n in all_]))
        used = np.flatnonzero(m.table)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps((used, m.table[used], m.bias, m.slope, m.shift))]}, schema=pa.schema([("model", pa.binary())]))

    out = rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id").select("text", "y", "stands_for").mapInArrow(fitted, "model binary").collect()
    return bytes(out[0].model) if out else pickle.dumps((np.zeros(0, int), np.zeros(0), 0.0, 0.0, 20.0))


_LOADED: dict[int, Model] = {}


def _model(model: bytes) -> Model:
    if hash(model) not in _LOADED:
        _LOADED.clear()
        _LOADED[hash(model)] = Model(*pickle.loads(model))
    return _LOADED[hash(model)]


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.uint64)
    repeated = 0
    if n > 3:
        two = np.unique(ids[:-1] * np.uint64(len(known)) + ids[1:], return_inverse=True)[1].astype(np.uint64)
        _, at, many = np.unique(two[:-1] * np.uint64(len(known)) + ids[2:], return_inverse=True, return_counts=True)
        twice = many[at] > 1
        cover = np.zeros(n, bool)
        for k in range(3):
            cover[k : n - 2 + k] |= twice
        repeated = int(cover.sum())
    seen, dup = set(), 0
    if "\n" in text:
        for line in text.split("\n"):
            if line.strip(BLANKS):
                dup += line in seen
                seen.add(line)
    return n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup, repeated


def judged(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, probability) for every row.

    NULL texts count as empty; those have no word and fail. NULL doc_ids and repeated rows stay, an empty table gives no row.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in names], ("probability", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                some = batch.slice(i, 512)
                texts = [t or "" for t in some.column(1).to_pylist()]
                columns = list(zip(*map(counts, texts), strict=True))
                yield pa.RecordBatch.from_arrays([some.column(0), *[pa.array(c, pa.int64()) for c in columns], pa.array(m.probabilities(texts))], schema=schema)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, ", ".join(["doc_id long", *[f"{n} long" for n in names], "probability double"]))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select("doc_id", *names, failed.alias("base_failed"), (~failed & (F.col("probability") >= threshold)).alias("kept"), "probability")
