"""Byte-pair ids of whole texts by a backtracking encoder, and texts of ids by an offset table.

A sequence of tokens is the result of all merges if and only if each token is what the merges make of its own
characters, and no merge would ever have joined the characters on both sides of a border between two tokens. So a
word is encoded from left to right: an Aho-Corasick automaton over the reversed tokens gives the longest token that
starts at each place; a token that may not follow its predecessor is replaced by the next shorter one, and when none
is left the predecessor is taken back. A place from which there was no way on is never tried again, so the work is
linear in the word. Short words go through both together, one step of each at a time; long ones alone.

*Pair compatibility.* While merges run in the order of their ranks, the piece left of a border goes through the right
edge of the left token's merge tree, the piece right of it through the left edge of the right token's. Each of
these pieces exists up to the rank that makes the next one. The border holds if no two pieces have a merge whose
rank comes before the end of either; at equal ranks the leftmost merge is first, so it must come before the end of the
left one, and not after that of the right one. Answers are kept as a table, by pair of tokens.

The library's own normaliser and cutter say what the words are (for a plain word and the marks after it they are asked
once, for every letter and mark), and its added tokens are taken out before, as in the library; merging, ids and
decoding are done here.
"""

from __future__ import annotations

import json
import math
import os
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandframe.llm.tokenise import SPELT, WORD, Recent, _gaps

#: Chunks of a generation that a Python worker keeps (some 200 bytes each), the longest ones (also the longest words that are encoded
#: together), long words' pairs until they are judged anew, and places of the table of pairs, as a power of two.
KEPT, LONGEST, PAIRS, PLACES = 200_000, 48, 300_000, 20
#: Runs of marks behind words that are kept.
TAILS = 10_000
#: Spreads keys over the places of a table.
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Characters (or ids) that are worked on at a time; a longer text is worked on alone.
TOGETHER = 1 << 18
#: The last character of a word is another symbol where the vocabulary marks word ends: that code point further up.
LAST = 0x1000


def _read(path: str) -> tuple[dict, str | None]:
    """The vocabulary file and the kind of its decoder."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, decoder = spec["model"], (spec["decoder"] or {}).get("type")
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
    if model["type"] != "BPE" or odd or decoder not in (None, "ByteLevel") or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError(f"{path}: only plain byte-pair vocabularies are read here {odd}")
    return spec, decoder


class Edges:
    """The edges of a trie, by node and symbol."""

    def __init__(self, child: dict[int, int], symbols: int):
        self.symbols = symbols
        bits = (4 * len(child)).bit_length()
        self.shift = np.uint64(64 - bits)
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        keys, to = (np.fromiter(x, np.int64, len(child)) for x in (child.keys(), child.values()))
        slots = self._slots(keys)
        while len(keys):  # the first of a slot stays, the others go one further
            free = self.keys[slots] < 0
            _, first = np.unique(slots, return_index=True)
            first = first[free[first]]
            self.keys[slots[first]], self.to[slots[first]] = keys[first], to[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, to, slots = keys[rest], to[rest], slots[rest] + 1 & len(self.keys) - 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * MIX >> self.shift).astype(np.int64)

    def find(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Where each edge leads, or -1."""
        keys = nodes.astype(np.int64) * self.symbols + symbols
        slots = self._slots(keys)
        there = self.keys[slots]
        others = np.flatnonzero((there != keys) & (there >= 0))
        while others.size:
            slots[others] = slots[others] + 1 & len(self.keys) - 1
            there[others] = self.keys[slots[others]]
            others = others[(there[others] != keys[others]) & (there[others] >= 0)]
        return np.where(there == keys, self.to[slots], -1)


class Merges:
    """The tokens of a byte-pair vocabulary, and which of them may follow each other."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        spec, _ = _read(path)
        model = spec["model"]
        library = Tokenizer.from_file(path)
        normal, cutter = library.normalizer, library.pre_tokenizer
        self.normal = normal.normalize_str if normal else str
        self.cut = cutter.pre_tokenize_str
        self.end = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        # a cutter that drops white space never joins characters across it, so the chunks between can be encoded one by one;
        # a few characters are white space for Python's split() only, and texts with them aren't split so
        self.by_chunk = [w for w, _ in self.cut(self.normal("a b  c\n d"))] == ["a", "b", "c", "d"]
        self.no_space = [c for c in map(chr, range(0x3001)) if c.isspace() and self.normal(f"a{c}b") != "a b"]
        self._tokens(model["vocab"], [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]])
        self.chunks = Recent(KEPT, LONGEST)
        self.pairs: dict[int, bool] = {}
        self.tails: dict[str, bytes] = {}
        self.plain_words = self.by_chunk and self._plain_words()

    def _plain_words(self) -> bool:
        """A word of ``WORD``, lower-cased and spelt in bytes, is a piece of its own before any ASCII marks."""
        marks = [c for c in map(chr, range(33, 127)) if not c.isalnum()]
        letters = [c for c in map(chr, range(256)) if WORD.fullmatch(c)]
        probes = [f"{a}{c}{a}" for c in letters for a in "aZé"] + [f"{c}{a}{b}" for c in "aZé" for a in marks for b in marks]
        pieces = [p for t in probes for p, _ in self.cut(self.normal(t))]
        parts = [WORD.fullmatch(t).groups("")[:2] for t in probes]
        return pieces == [p for w, tail in parts for p in (w.lower().translate(SPELT), tail) if p]

    def _tokens(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        """Symbols of every token, edges of its merge tree, the next shorter token, and the automaton."""
        alphabet = {c for t in vocab for c in t}
        size = max(vocab.values()) + 1
        symbols: list[str | None] = [None] * size
        for c in alphabet:
            if c in vocab:
                symbols[vocab[c]] = c
            if self.end and c + self.end in vocab:
                symbols[vocab[c + self.end]] = chr(ord(c) + LAST)
        single = [i for i, s in enumerate(symbols) if s]
        # the last and the first part of each token, and the rank that joins them (ends them as pieces of their own)
        self.right: dict[int, tuple[int, float] | None] = dict.fromkeys(single)
        self.left = dict(self.right)
        self.size, self.rank = size, {}
        ranked = []
        for k, (a, b) in enumerate(merges):
            x, y = vocab[a], vocab[b]
            new = vocab[(a.removesuffix(self.end) if self.end else a) + b] if a + b not in vocab else vocab[a + b]
            self.rank.setdefault(x * size + y, k)
            ranked.append((x, y, new))
        for k, (x, y, new) in enumerate(ranked):
            if symbols[x] is None or symbols[y] is None:
                raise ValueError("a merge comes before the ones that make its parts")
            symbols[new] = symbols[x] + symbols[y]
            # a token that the merges don't make of its own characters stands in no result
            if new not in self.right and x in self.right and y in self.right and self._holds(x, y, k):
                self.right[new], self.left[new] = (y, k), (x, k)
        by_text = {symbols[i]: i for i in self.right}
        self.sizes, self.shorter = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        for text, i in by_text.items():
            self.sizes[i] = len(text)
            self.shorter[i] = next((by_text[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in by_text), -1)
        self.known = np.full(1 << PLACES, -1, np.int64)  # twice the pair's key, and one if it holds
        self._automaton(by_text)

    def _automaton(self, by_text: dict[str, int]) -> None:
        """The automaton over the reversed tokens: edges, where to go on without one, the longest token that ends a state's characters."""
        alphabet = sorted({ord(c) for t in by_text for c in t})
        self.symbol = np.zeros(alphabet[-1] + 2, np.int32)
        self.symbol[alphabet] = np.arange(1, len(alphabet) + 1)
        child: dict[int, int] = {}
        of, symbol, token, depth = [0], [0], [0], [0]
        code = dict(zip(map(chr, alphabet), range(1, len(alphabet) + 1), strict=True))
        for text, i in by_text.items():
            node = 0
            for d, c in enumerate(reversed(text), 1):
                key = node * (len(alphabet) + 1) + code[c]
                to = child.get(key)
                if to is None:
                    to = child[key] = len(of)
                    of.append(node)
                    symbol.append(code[c])
                    token.append(-1)
                    depth.append(d)
                node = to
            token[node] = i
        self.edges = Edges(child, len(alphabet) + 1)
        of, symbol, depth = (np.array(x, np.int32) for x in (of, symbol, depth))
        self.longest, self.back = np.array(token, np.int32), np.zeros(len(of), np.int32)
        for d in range(1, depth.max() + 1):
            nodes = np.flatnonzero(depth == d)
            if d > 1:
                self.back[nodes] = self._go(self.back[of[nodes]], symbol[nodes])
            none = nodes[self.longest[nodes] < 0]
            self.longest[none] = self.longest[self.back[none]]

    def _go(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next state of each."""
        to = self.edges.find(state, symbols)
        stuck = np.flatnonzero((to < 0) & (state > 0))
        state = state[stuck]
        while stuck.size:
            state = self.back[state]
            to[stuck] = self.edges.find(state, symbols[stuck])
            still = (to[stuck] < 0) & (state > 0)
            stuck, state = stuck[still], state[still]
        return np.maximum(to, 0)

    def _holds(self, x: int, y: int, before: float = math.inf) -> bool:
        """No merge of a rank under ``before`` joins the neighbours x and y, or pieces of them, across their border."""
        rank, size, first = self.rank, self.size, []
        part = y, math.inf
        while part:
            first.append(part)
            part = self.left[part[0]]
        part = x, math.inf
        while part:
            a, ends_a = part
            for b, ends_b in first:
                k = rank.get(a * size + b)
                if k is not None and k < before and k < ends_a and k <= ends_b:
                    return False
            part = self.right[a]
        return True

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which pairs hold; a pair gives way in the table to another one of its place."""
        keys = left.astype(np.int64) * self.size + right
        places = (keys.view(np.uint64) * MIX >> np.uint64(64 - PLACES)).astype(np.int64)
        found = self.known[places]
        new = np.flatnonzero(found >> 1 != keys)
        if new.size:
            each, which = np.unique(keys[new], return_inverse=True)
            judged = [2 * k + self._holds(*divmod(k, self.size)) for k in each.tolist()]
            found[new] = np.array(judged, np.int64)[which]
            self.known[places[new]] = found[new]
        return (found & 1).astype(bool)

    def _symbols(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The lengths of words, where they stop in one run with a gap behind each, and the symbols of that run."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths + 1) - 1
        points = np.frombuffer("\x00".join([*words, ""]).encode("utf-32-le"), "<u4").copy()
        if self.end:
            points[stops - 1] += LAST
        return lengths, stops, self.symbol[np.minimum(points, len(self.symbol) - 1)]

    def _together(self, words: Sequence[str]) -> list[bytes]:
        """The ids of many short words: first the longest token at each place, from behind, then the borders."""
        lengths, stops, symbols = self._symbols(words)
        longest = np.zeros(len(symbols), np.int32)
        order = np.argsort(-lengths, kind="stable")
        ends, state = stops[order], np.zeros(len(words), np.int32)
        reach = np.searchsorted(-lengths[order], -np.arange(1, lengths.max() + 1), "right").tolist()
        for k, n in enumerate(reach, 1):  # n words have k symbols or more
            state = self._go(state[:n], symbols[ends[:n] - k])
            longest[ends[:n] - k] = self.longest[state]
        sizes, shorter = self.sizes, self.shorter
        starts, dead, out, counts = stops - lengths, np.zeros(len(symbols), bool), np.zeros(len(symbols), "<u4"), np.zeros(len(words), np.int64)
        live, first, stop = np.arange(len(words)), starts, stops
        at, top, token = starts.copy(), starts.copy(), longest[starts]
        while live.size:
            end = at + sizes[token]
            fits = ~dead[end]
            judge = np.flatnonzero(fits & (top > first))
            fits[judge] = self._fit(out[top[judge] - 1], token[judge])
            on = np.flatnonzero(fits)
            out[top[on]] = token[on]
            top[on] += 1
            at[on] = end[on]
            token = np.where(fits, longest[end], shorter[token])
            none = np.flatnonzero(token < 0)
            while none.size:  # no way on from here: the token before ends elsewhere
                dead[at[none]] = True
                top[none] -= 1
                last = out[top[none]]
                at[none] -= sizes[last]
                token[none] = shorter[last]
                none = none[token[none] < 0]
            left = at < stop
            if not left.all():
                counts[live[~left]] = (top - first)[~left]
                live, first, stop, at, top, token = (x[left] for x in (live, first, stop, at, top, token))
        raw = out.tobytes()
        return [raw[a:b] for a, b in zip((4 * starts).tolist(), (4 * (starts + counts)).tolist(), strict=True)]

    def _alone(self, words: Sequence[str]) -> Iterator[bytes]:
        """The ids of words of any length, one after the other; the longest tokens of all are found at once."""
        lengths, stops, symbols = self._symbols(words)
        longest = self._longest(symbols)
        for n, stop in zip(lengths.tolist(), stops.tolist(), strict=True):
            yield np.array(self._word(n, longest[stop - n : stop].tolist()), "<u4").tobytes()

    def _word(self, n: int, longest: Sequence[int]) -> list[int]:
        """The ids of a word of n symbols; ``longest``: the longest token that starts at each."""
        out: list[int] = []
        size, shorter, pairs = self.sizes.item, self.shorter.item, self.pairs
        dead, at, token = bytearray(n + 1), 0, longest[0]
        while True:
            end = at + size(token)
            if not dead[end]:
                if out:
                    key = out[-1] << 32 | token
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = self._holds(out[-1], token)
                else:
                    fits = True
                if fits:
                    out.append(token)
                    if end == n:
                        return out
                    at, token = end, longest[end]
                    continue
            token = shorter(token)
            while token < 0:  # no way on from here: the token before ends elsewhere
                dead[at] = 1
                token = out.pop()
                at -= size(token)
                token = shorter(token)

    def _longest(self, symbols: np.ndarray) -> np.ndarray:
        """The longest token that starts at each place of a run, from stretches that are gone through together.

        A state holds no more symbols than the longest token has, so each stretch begins that much behind its end.
        """
        deep = int(self.sizes.max())
        stretch = max(deep, math.isqrt(len(symbols)))
        starts = np.arange(0, len(symbols), stretch)
        ends = np.minimum(starts + stretch + deep, len(symbols))
        out, state = np.zeros(len(symbols), np.int32), np.zeros(len(ends), np.int32)
        for k in range(1, int((ends - starts).max()) + 1):
            places = ends - k
            go = np.flatnonzero(places >= starts)
            state[go] = self._go(state[go], symbols[places[go]])
            own = go[places[go] < starts[go] + stretch]
            out[places[own]] = self.longest[state[own]]
        return out

    def _words(self, words: Sequence[str]) -> list[bytes]:
        """The ids of each word; short ones are encoded together."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        each = {*words}
        short = [w for w in each if len(w) <= LONGEST]
        new = dict(zip(short, self._together(short), strict=True)) if short else {}
        if len(short) < len(each):
            long = [w for w in each if len(w) > LONGEST]
            new.update(zip(long, self._alone(long), strict=True))
        return [new[w] for w in words]

    def _chunks(self, chunks: Sequence[str]) -> dict[str, bytes]:
        """The ids of chunks between white space: of plain words and the marks behind them apart, of others by the library's cutter."""
        if len(self.tails) > TAILS:
            self.tails.clear()
        parts = [(k, *m.group(1, 2)) for k in chunks if (m := WORD.fullmatch(k))] if self.plain_words else []
        tails = [*{t for _, _, t in parts} - self.tails.keys()]
        self.tails.update(zip(tails, self._units(tails), strict=True))
        spelt = [w.lower() if w.isascii() else w.lower().translate(SPELT) for _, w, _ in parts]
        new = {k: ids + self.tails[t] if t else ids for (k, _, t), ids in zip(parts, self._words(spelt), strict=True)}
        others = [k for k in chunks if k not in new]
        new.update(zip(others, self._units(others), strict=True))
        return new

    def _units(self, units: Sequence[str]) -> list[bytes]:
        """The ids of several chunks or texts, which never join."""
        if self.by_chunk:
            normal = self.normal(" ".join(units)).split(" ")
            if len(normal) != len(units):  # white space inside of one
                normal = [self.normal(u) for u in units]
            ends = np.cumsum([len(u) + 1 for u in normal])
            pieces = self.cut(" ".join(normal))
            owner = np.searchsorted(ends, [a for _, (a, _) in pieces], "right").tolist()
            pieces = [p for p, _ in pieces]
        else:
            each = [[p for p, _ in self.cut(self.normal(u))] for u in units]
            owner, pieces = [i for i, ps in enumerate(each) for _ in ps], [p for ps in each for p in ps]
        out: list[list[bytes]] = [[] for _ in units]
        for i, ids in zip(owner, self._words(pieces), strict=True):
            out[i].append(ids)
        return [b"".join(x) for x in out]

    def _plain(self, texts: Sequence[str]) -> list[bytes]:
        if not self.by_chunk:
            return self._units(texts)
        cut = [[t] if any(c in t for c in self.no_space) else t.split() for t in texts]
        ends = np.cumsum([0, *map(len, cut)]).tolist()
        flat = list(chain.from_iterable(cut))
        found = self.chunks.find(flat)
        gaps = [*_gaps(found)]
        new = self._chunks([*{flat[i] for i in gaps}])
        for i in gaps:
            found[i] = new[flat[i]]
        self.chunks.add(new)
        return [b"".join(found[a:b]) for a, b in zip(ends, ends[1:], strict=False)]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        odd = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        out = self._plain(["" if i in odd else t for i, t in enumerate(texts)] if odd else texts)
        for i in odd:
            marks = [np.array([self.added[m]], "<u4").tobytes() for m in self.added_cut.findall(texts[i])]
            parts = self._plain(self.added_cut.split(texts[i]))
            out[i] = b"".join(x for pair in zip(parts, [*marks, b""], strict=True) for x in pair)
        return out


class Offsets:
    """All tokens' bytes in one run, and where each begins."""

    def __init__(self, path: str):
        spec, decoder = _read(path)
        vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.joined_by = b"" if decoder else b" "
        written = [b""] * (max(vocab.values()) + 1)
        if decoder:
            keep = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or 174 <= b]
            byte = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}
        for t, i in vocab.items():
            plain = decoder and all(c in byte for c in t)
            written[i] = (bytes(byte[c] for c in t) if plain else t.encode()) + self.joined_by
        self.blob = np.frombuffer(b"".join(written), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(w) for w in written])])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of many runs of ids; ``ends``: where each run ends. Ids that name no token are left out, as in the library."""
        there = (ids >= 0) & (ids < len(self.offsets) - 1)
        there[there] &= self.offsets[ids[there] + 1] > self.offsets[ids[there]]
        ends, ids = np.concatenate([[0], np.cumsum(there)])[ends], ids[there]
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        to = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.blob[np.repeat(starts - to[:-1], sizes) + np.arange(to[-1])]
        bounds = np.concatenate([[0], to[ends]]).tolist()
        cut, raw = len(self.joined_by), raw.tobytes()
        return pa.array([raw[a : max(a, b - cut)].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:], strict=False)], pa.string())


_MERGES: dict[str, Merges] = {}
_OFFSETS: dict[str, Offsets] = {}


def merges(path: str) -> Merges:
    """One for each vocabulary and Python worker; later tasks go on with the chunks it knows."""
    if path not in _MERGES:
        _MERGES[path] = Merges(path)
    return _MERGES[path]


def offsets(path: str) -> Offsets:
    if path not in _OFFSETS:
        _OFFSETS[path] = Offsets(path)
    return _OFFSETS[path]


def _runs(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Runs a:b of rows of some TOGETHER units."""
    a = total = 0
    for b, n in enumerate(sizes):
        if b > a and total + n > TOGETHER:
            yield a, b
            a, total = b, 0
        total += n
    if len(sizes):
        yield a, len(sizes)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with ``ids`` (array of int) in the place of ``text``; a column that is called ``ids`` already is replaced.

    NULL and empty texts have no ids (an empty array). Texts are never cut, however long; repeated rows stay.
    """
    kept = [c for c in df.columns if c not in (text, ids)]
    rows = df.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merges(path)
        for batch in batches:
            for a, b in _runs(pc.utf8_length(batch.column(0)).to_pylist()):
                found = m.encode(batch.column(0).slice(a, b - a).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype("<i4")
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))
                yield pa.RecordBatch.from_arrays([lists, *batch.slice(a, b - a).columns[1:]], ["i", *batch.schema.names[1:]])

    out = rows.mapInArrow(run, T.StructType([T.StructField("i", T.ArrayType(T.IntegerType())), *rows.schema.fields[1:]]))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], F.col("i").alias(ids))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` and the ``text`` of its ``ids``; a column that is called ``text`` already is replaced.

    NULL and empty arrays give an empty text; NULLs in an array and ids that name no token are left out. Bytes that are no
    UTF-8 become U+FFFD. A vocabulary without a decoder joins its tokens by blanks, as the library does.
    """
    kept = [c for c in df.columns if c != text]
    clean = F.filter(F.coalesce(F.col(ids), F.array().cast("array<int>")), lambda x: x.isNotNull())
    rows = df.select(clean.cast("array<int>").alias("i"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = offsets(path)
        for batch in batches:
            lists = batch.column(0)
            ends = np.asarray(lists.offsets)
            values, ends = np.asarray(lists.values), ends.astype(np.int64)
            for a, b in _runs(np.diff(ends).tolist()):
                texts = m.decode(values[ends[a] : ends[b]].astype(np.int64), ends[a + 1 : b + 1] - ends[a])
                yield pa.RecordBatch.from_arrays([texts, *batch.slice(a, b - a).columns[1:]], ["t", *batch.schema.names[1:]])

    out = rows.mapInArrow(run, T.StructType([T.StructField("t", T.StringType()), *rows.schema.fields[1:]]))
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)], F.col("t").alias(text))
