"""Encoding whole texts with a public byte-level BPE, fast on one core.

The pre-tokenizer of a byte-level BPE always starts a new piece at a space
that a non-space follows, so a text may be cut before each such space and the
parts encoded one by one: the ids are the same.  Parts repeat (words do), so
each Python worker remembers the ids of parts it has seen, up to a bound in
bytes.  Most parts are a Latin word with punctuation behind it or a line's end inside:
they are put together from the word, the punctuation and the line's end, which are
pieces of their own, so each word goes through the model once whatever stands behind
it.  A text that holds a control string of the vocabulary (``<|endoftext|>``)
goes through the library whole: it gives the control's id, as the plain call does.
``guard_control=True`` encodes control strings as ordinary text instead.

A column of texts is cut by Arrow and each of its different parts looked up once, in a
memory of Arrow and numpy columns (``encode_column``): it holds several times the parts
that a dict holds in the same bytes.

The vocabulary file is looked up by name on the worker and never copied.
"""

from __future__ import annotations

import re
from functools import lru_cache
from operator import attrgetter
from struct import Struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_VOCAB = "byte_bpe_50k.json"
MEMORY_BYTES = 128 << 20                    # remembered parts per worker, both generations
LONG_PART = 64                              # characters: longer parts are not remembered
_ENTRY_BYTES = 150                          # of a remembered part besides its characters and ids
_PART_BYTES = 64                            # the same in Parts, the index made for a look-up with it
_CUT = re.compile(r" (?=\S)")
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"               # letters, all of them
_WORD = re.compile(f"([{_LATIN}]+)([!-&(-/:-@\\[-`{{-~]*)")           # an apostrophe may start a piece: not here
_IDS = attrgetter("id")


def _byte_chars() -> dict[int, str]:
    """Byte-level BPE's printable stand-in for every byte: printable Latin-1
    characters stand for themselves, the others take code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Odd(Exception):
    """A space that white space or the text's end follows: no place to cut."""


class Memory(dict):
    """A function's values, bounded in bytes.  Two generations: once the younger
    holds half the bound it becomes the older one, whose entries stay only if they
    are asked for again."""

    def __init__(self, fn, most_bytes: int) -> None:
        super().__init__()
        self.fn, self.most, self.held, self.old = fn, most_bytes // 2, 0, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.fn(key)
        if len(key) <= LONG_PART and (key == "\n" or "\n" not in key):         # lines' ends seldom repeat
            if self.held > self.most:
                self.old, self.held = dict(self), 0
                self.clear()
            self[key] = got
            self.held += _ENTRY_BYTES + len(key) + len(got)
        return got


class Parts:
    """Ids of parts in Arrow and numpy columns: a part takes a quarter of what it takes in a
    :class:`Memory`, and a whole column is looked up at once.  Past the bound the parts that
    were asked for last stay, up to half of it."""

    def __init__(self, kind: np.dtype, most_bytes: int) -> None:
        self.most, self.turn = most_bytes, 0
        self.parts = pa.array([], pa.large_string())
        self.ids, self.size = np.zeros(0, dtype=kind), np.zeros(0, dtype=np.int32)
        self.used = np.zeros(0, dtype=np.int32)              # the turn that last asked

    def find(self, asked: pa.Array) -> np.ndarray:
        """Each part's place, -1 if it is not held."""
        self.turn += 1
        at = pc.fill_null(pc.index_in(asked, value_set=self.parts), -1).to_numpy().astype(np.int64)
        self.used[at[at >= 0]] = self.turn
        return at

    def add(self, parts: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        self.parts = pa.concat_arrays([self.parts, parts])
        self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size.astype(np.int32)])
        self.used = np.concatenate([self.used, np.full(len(parts), self.turn, dtype=np.int32)])
        each = _PART_BYTES + pc.binary_length(self.parts).to_numpy() + self.size * self.ids.itemsize
        if each.sum() > self.most:
            last = np.argsort(-self.used, kind="stable")
            keep = np.zeros(len(last), dtype=bool)
            keep[last[np.cumsum(each[last]) <= self.most // 2]] = True
            self.parts, self.used = self.parts.filter(pa.array(keep)), self.used[keep]
            self.ids, self.size = self.ids[np.repeat(keep, self.size)], self.size[keep]


class TextEncoder:
    """ids of whole texts, as little-endian unsigned integers of ``width`` bytes
    (2 while the vocabulary's ids fit, else 4)."""

    def __init__(self, vocab: str = DEFAULT_VOCAB, memory_bytes: int = MEMORY_BYTES, guard_control: bool = False) -> None:
        import os

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(vocab if "/" in vocab else public_tokenizers.path(vocab))
        self.tok.encode_special_tokens = guard_control
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.controls = [] if guard_control else added
        self.control = re.compile("|".join(map(re.escape, added))) if self.controls else None
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.type = np.dtype(f"<u{self.width}")
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.chars = _byte_chars()
        self.letters = {c: chr(c).encode().decode("latin-1").translate(self.chars) for c in (*range(65, 123), *range(0xC0, 0x250))}
        self.packs = [Struct(f"<{n}{'H' if self.width == 2 else 'I'}").pack for n in range(LONG_PART)]
        self.tokenize = self.tok.model.tokenize
        self.parts = Parts(self.type, memory_bytes * 5 // 8)                # parts that follow a space, by the column
        self.inner = Memory(self._inner, memory_bytes // 8)                 # the same, one by one
        self.first = Memory(self._first, memory_bytes // 4)                 # words and marks without one

    def _piece(self, piece: str) -> list[int]:
        word = piece.encode("utf-8").decode("latin-1").translate(self.chars)
        return [t.id for t in self.tokenize(word)]

    def _packed(self, ids) -> bytes:
        n = len(ids)
        return self.packs[n](*ids) if n < LONG_PART else np.array(ids, dtype=self.type).tobytes()

    def _word(self, word: str, lead: str = "") -> bytes:
        """Ids of Latin letters: one piece."""
        return self._packed(tuple(map(_IDS, self.tokenize(lead + (word if word.isascii() else word.translate(self.letters))))))

    def _joined(self, part: str, words: Memory) -> bytes | None:
        """Ids of a part from those of its pieces, or None; ``words`` are remembered with
        or without the space before them."""
        at = _WORD.match(part) if len(part) <= LONG_PART else None
        if at is None:
            return None
        end = at.end()
        if end == len(part):
            word, marks = at.groups()
            return words[word] + self.first[marks] if marks else self._word(word, "\u0120" if words is self.inner else "")
        # A single line's end between two non-spaces is a piece.
        if part[end] == "\n" and end + 1 < len(part) and not part[end + 1].isspace():
            return words[part[:end]] + self.first["\n"] + self.first[part[end + 1:]]
        return None

    def _inner(self, part: str) -> bytes:
        if part.isascii() and part.isalpha():
            ids = [t.id for t in self.tokenize("\u0120" + part)]
            return self._packed(ids)
        if not part or part[0].isspace():
            raise _Odd
        got = self._joined(part, self.inner)
        return self._part(" " + part) if got is None else got

    def _first(self, part: str) -> bytes:
        got = self._joined(part, self.first)
        return self._part(part) if got is None else got

    def _part(self, s: str) -> bytes:
        """Ids of one part (none for an empty one).  Latin letters take the model directly (the pattern's
        classes are settled there); other scripts take the whole library path."""
        if not s:
            return b""
        if not s.isascii() and max(s) >= "ɐ":
            return self._whole(s)
        return self._packed([i for piece in self.pieces(s) for i in self._piece(piece)])

    def _whole(self, s: str) -> bytes:
        return self._packed(self.tok.encode(s, add_special_tokens=False).ids)

    def encode_one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.control is not None and self.control.search(text):
            return self._whole(text)
        parts = text.split(" ")
        try:
            return self.first[parts[0]] + b"".join(map(self.inner.__getitem__, parts[1:]))
        except _Odd:
            parts = _CUT.split(text)
            return self.first[parts[0]] + b"".join(map(self.inner.__getitem__, parts[1:]))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self.encode_one(t) for t in texts]

    def encode_column(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """(ids, cuts) of an Arrow column of texts, ``end`` behind each one's ids: text i has
        ids[cuts[i]:cuts[i + 1]].  A part is asked for once, however often the column holds it."""
        n = len(texts)
        if not n:
            return np.zeros(0, dtype=self.type), np.zeros(1, dtype=np.int64)
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        parts = pc.split_pattern(texts, " ")
        words, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy().astype(np.int64)
        first = np.cumsum(sizes) - sizes
        behind = np.ones(len(words), dtype=bool)             # a space
        behind[first] = False
        found = words.filter(pa.array(behind)).dictionary_encode()
        asked, held = found.dictionary, self.parts.find(found.dictionary)
        new, got, odd = np.flatnonzero(held < 0), [], []
        for k, part in zip(new.tolist(), asked.take(pa.array(new)).to_numpy(zero_copy_only=False)):
            try:
                got.append(self.inner[part])
            except _Odd:
                odd.append(k)
                got.append(b"")
        code = np.empty(len(words) + 1, dtype=np.int64)
        code[:-1][behind] = found.indices.to_numpy()
        # Texts that their parts do not tell go alone: all ids stand in the place of the first part.
        alone = np.zeros(n, dtype=bool)
        for control in self.controls:
            alone |= pc.match_substring(texts, control).to_numpy(zero_copy_only=False)
        if odd:
            strange = behind.copy()
            strange[behind] = np.isin(code[:-1][behind], odd)
            alone |= np.logical_or.reduceat(strange, first)
        # The end ids of a text stand before the first part of the next one.
        heads = words.take(pa.array(first)).to_pylist()
        got += [(end if i else b"") + (self.encode_one(texts[i].as_py()) if whole else self.first[head])
                for i, (head, whole) in enumerate(zip(heads, alone.tolist()))]
        got.append(end)
        fresh = np.frombuffer(b"".join(got), dtype=self.type)
        size = np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // self.width
        # Places of the held parts' ids, then of the new ones', the first parts' and the end's.
        pool = np.concatenate([self.parts.ids, fresh])
        sizes_of = np.concatenate([self.parts.size, size])
        starts = np.cumsum(sizes_of) - sizes_of
        held[new] = len(self.parts.size) + np.arange(len(new))
        code[:-1][behind] = held[code[:-1][behind]]
        code[first] = np.arange(len(starts) - n - 1, len(starts) - 1)
        code[-1] = len(starts) - 1
        each = sizes_of[code]
        if alone.any():
            each[:-1][np.repeat(alone, sizes) & behind] = 0
        upto = np.cumsum(each)
        at = np.repeat(starts[code] - (upto - each), each)
        at += np.arange(len(at))
        cuts = np.append(upto[first] - each[first] + len(end) // self.width, len(at))
        cuts[0] = 0
        ids = pool[at]
        self._remember(asked, new, fresh, size, odd)
        return ids, cuts

    def _remember(self, asked: pa.Array, new: np.ndarray, ids: np.ndarray, size: np.ndarray, odd: list[int]) -> None:
        """The ``new`` parts but for long, odd and many-line ones: ``ids`` and ``size`` begin with theirs."""
        parts, size = asked.take(pa.array(new)), size[:len(new)]
        keep = (pc.utf8_length(parts).to_numpy() <= LONG_PART) & ~np.isin(new, odd) \
            & ~pc.match_substring(parts, "\n").to_numpy(zero_copy_only=False)
        self.parts.add(parts.filter(pa.array(keep)), ids[:size.sum()][np.repeat(keep, size)], size[keep])


@lru_cache(maxsize=2)
def encoder(vocab: str = DEFAULT_VOCAB) -> TextEncoder:
    """One encoder per worker process and vocabulary."""
    return TextEncoder(vocab)
