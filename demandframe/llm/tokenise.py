"""Ids of whole texts by the ``tokenizers`` library, encoding each different chunk between blanks once.

A tokenizer that first cuts text at white space never joins characters across a single blank, so the ids of a text
are the ids of its chunks one after the other. Chunks repeat far more often than texts do.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import numpy as np

from demandframe.llm.common import held

#: Chunks kept per Python worker (some 200 bytes each); when there are more, those longer than SHORT go (the short ones are
#: the frequent ones), and ever shorter ones until half is free. Longer chunks than LONGEST are never kept. So many new chunks go to the library as one text.
KEPT, SHORT, LONGEST, TOGETHER = 900_000, 8, 48, 128
#: A word and the ASCII marks after it, of letters that composing leaves as they are and that lower-case to one letter; then
#: perhaps a line's end, which is a token of its own between a mark or letter and a letter, and such a word again.
WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]{1,48})([!-/:-@\[-`{-~]{0,4})(?:(\n)([A-Za-zÀ-ÖØ-öø-ÿ]{1,48})([!-/:-@\[-`{-~]{0,4}))?")
#: How byte-level vocabularies spell these letters: one character for each byte of UTF-8.
SPELT = {c: "".join(chr(b if 0xA1 <= b != 0xAD else 0x122 + b - 0x80 if b <= 0xA0 else 0x143) for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class Recent:
    """Results that were needed of late, up to twice ``kept``: what is looked up again stays, the rest goes when a generation is full."""

    def __init__(self, kept: int, longest: int):
        self.kept, self.longest = kept, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, keys: Sequence[str]) -> list[bytes | None]:
        found = list(map(self.young.get, keys))
        if self.old:
            i = -1
            for _ in range(found.count(None)):
                i = found.index(None, i + 1)
                found[i] = self.old.get(keys[i])
                if found[i] is not None:
                    self.young[keys[i]] = found[i]
        return found

    def add(self, new: dict[str, bytes]) -> None:
        if len(self.young) + len(new) > self.kept:
            self.old, self.young = self.young, {}
        self.young.update((k, v) for k, v in new.items() if len(k) <= self.longest)


def _gaps(found: list[bytes | None]) -> Iterator[int]:
    """The places that hold nothing, looked for only as often as there are some."""
    at = -1
    for _ in range(found.count(None)):
        at = found.index(None, at + 1)
        yield at


class ChunkEncoder:
    """``blank_in_chunk``: the blank before a chunk belongs to it (byte-level vocabularies); else white space is dropped.

    ``special_as_text``: the strings of special tokens are ordinary text; else they are the special tokens, as the library has it by default.
    """

    def __init__(self, path: str, blank_in_chunk: bool, kept: int = KEPT, special_as_text: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.special = [] if special_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.blank, self.kept = blank_in_chunk, kept
        self.memo: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        # words go to the library's model itself where all that comes before it is known to leave a word whole
        model, cutter, normal = self.tokenizer.model, repr(self.tokenizer.pre_tokenizer), repr(self.tokenizer.normalizer)
        self.lower = normal.endswith("Lowercase()])")
        known = "ByteLevel(add_prefix_space=False" in cutter and (self.lower if not blank_in_chunk else self.tokenizer.normalizer is None)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = model if known and type(model).__name__ == "BPE" and not any(c[0].isalpha() for c in added) else None

    def _lowered(self, text: str) -> str:
        """``text`` in lower case if the vocabulary lower-cases, all its characters do so one by one, and no special token comes of it."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        low = text.lower()
        return text if any(c in low for c in self.special) else low

    def _word(self, word: str, first: str) -> bytes:
        spelt = first + (word.lower() if self.lower else word)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelt if word.isascii() else spelt.translate(SPELT))])

    def _new(self, chunks: Sequence[str]) -> dict[str, bytes]:
        """The ids of each chunk after a blank: a word's from the model, then its marks'; other chunks go the whole way."""
        made, first = {}, "\u0120" if self.blank else ""
        parts = [(k, *m.groups("")) for k in chunks if (m := WORD.fullmatch(k))] if self.model else []
        tails = [*{t for _, _, one, end, _, two in parts for t in (one + end, two)} - self.marks.keys()]
        self.marks.update(zip(tails, self._whole(tails), strict=True))
        for k, word, one, end, more, two in parts:
            ids = self.memo.get(word) if one or end else None
            made[k] = (self._word(word, first) if ids is None else ids) + self.marks[one + end]
            if more:
                made[k] += self._word(more, "") + self.marks[two]
        others = [k for k in chunks if k not in made]
        made.update(zip(others, self._chunks(others), strict=True))
        return made

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, chunks: Sequence[str]) -> Iterator[bytes]:
        """The ids of each chunk after a blank, from texts of many chunks that are cut again where each chunk's characters end."""
        groups = [chunks[i : i + TOGETHER] for i in range(0, len(chunks), TOGETHER)]
        first = " " if self.blank else ""
        for group, e in zip(groups, self.tokenizer.encode_batch([first + " ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ends = np.cumsum([len(c) + 1 for c in group])
            ids, starts = np.array(e.ids, "<u4").tobytes(), np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids))
            cuts = [0, *(4 * np.searchsorted(starts, ends)).tolist()]
            yield from map(ids.__getitem__, map(slice, cuts, cuts[1:]))

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        out = [b""] * len(texts)
        texts = [self._lowered(t) for t in texts] if self.lower else texts
        # several blanks in a row make one token where the blank counts: such texts go whole, and those with special tokens
        whole = [i for i, t in enumerate(texts) if self.blank and "  " in t or any(c in t for c in self.special)]
        for i, ids in zip(whole, self._whole([texts[i] for i in whole]), strict=True):
            out[i] = ids
        skip, memo = {*whole}, self.memo
        # where white space is dropped, a line's end is a blank
        cut = [[] if i in skip else (t if self.blank else t.replace("\n", " ")).split(" ") for i, t in enumerate(texts)]
        if self.blank:  # no blank before the first chunk
            for i, ids in enumerate(self._whole([c[0] if c else "" for c in cut])):
                out[i] += ids
            cut = [c[1:] for c in cut]
        found = [list(map(memo.get, c)) for c in cut]
        gaps = [(i, j) for i, f in enumerate(found) for j in _gaps(f)]
        missing = [*{cut[i][j] for i, j in gaps}]
        new = self._new(missing)
        for i, j in gaps:
            found[i][j] = new[cut[i][j]]
        if len(memo) + len(new) > self.kept:
            for longest in range(SHORT, -1, -1):
                memo = self.memo = {k: ids for k, ids in memo.items() if len(k) <= longest}
                if 2 * len(memo) <= self.kept:
                    break
        memo.update((k, ids) for k, ids in new.items() if len(k) <= LONGEST)
        for i, f in enumerate(found):
            out[i] += b"".join(f)
        return out


def encoder(path: str, blank_in_chunk: bool, special_as_text: bool = True, kept: int = KEPT) -> ChunkEncoder:
    """One encoder for each vocabulary and Python worker; later tasks of the worker go on with what it knows, until the worker holds something else."""
    return held(("encoder", path, blank_in_chunk, special_as_text, kept), lambda: ChunkEncoder(path, blank_in_chunk, kept, special_as_text))
