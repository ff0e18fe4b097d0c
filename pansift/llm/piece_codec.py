"""SentencePiece BPE on whole texts: counting, encoding and decoding.

A text is cut into *pre-tokens* (a run of word marks and what follows up to
the next mark).  No piece of the vocabulary holds a mark after another
character, which is checked when a table is built, so no merge crosses a
pre-token's edge and pre-tokens encode on their own.  Each Python worker
remembers a bounded number of them.
"""

from __future__ import annotations

import functools
import re
import struct
import sys
from array import array

MARK = "▁"
#: Remembered pre-tokens of a worker and bytes that they may take; beyond either the
#: memory starts anew.  Longer pre-tokens are not remembered.
REMEMBERED, REMEMBERED_BYTES, LONGEST = 400_000, 96 << 20, 64
_CUT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text with its leading mark.  ``w`` without a mark
    stands for mark + ``w``; longer runs of marks are spelt out."""
    if not text:
        return []
    s = text.replace(" ", MARK)
    if MARK + MARK not in s and s[0] != MARK and s[-1] != MARK:
        return s.split(MARK)
    return [t[1:] if t[0] == MARK and t[1:2] != MARK else t for t in _CUT.findall(MARK + s)]


def spelt(key: str) -> str:
    """A pre-token with its marks."""
    return key if key[:1] == MARK else MARK + key


class Remembered(dict):
    """A memory of ``make(key)``, bounded in entries and in bytes; ``fixed`` entries
    stay.  Keys that are strings of more than ``LONGEST`` characters are made anew
    each time, so one entry is small and a text without spaces leaves nothing behind."""

    def __init__(self, make, fixed=(), most: int = REMEMBERED, most_bytes: int = REMEMBERED_BYTES):
        super().__init__(fixed)
        self.make, self.fixed, self.most, self.most_bytes, self.held = make, dict(fixed), most, most_bytes, 0

    def __missing__(self, key):
        value = self.make(key)
        if isinstance(key, str) and len(key) > LONGEST:
            return value
        size = 120 + sys.getsizeof(key) + _size(value)
        if len(self) >= self.most + len(self.fixed) or self.held + size > self.most_bytes:
            self.clear()
            self.update(self.fixed)
            self.held = 0
        self.held += size
        self[key] = value
        return value


def _size(value) -> int:
    """Bytes of a value; numbers in lists count as objects of their own."""
    if isinstance(value, (list, tuple)):
        return sys.getsizeof(value) + sum(map(_size, value))
    return sys.getsizeof(value)


class Pieces:
    """The vocabulary of a BPE model with byte fallback."""

    def __init__(self, model: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        sp = self.sp
        ids = range(sp.vocab_size())
        self.texts = [sp.id_to_piece(i) for i in ids]
        self.plain = {self.texts[i]: i for i in ids
                      if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.scores = {p: sp.get_score(i) for p, i in self.plain.items()}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        if any(not sp.is_byte(i) for i in self.byte_ids):
            raise ValueError("the vocabulary has no byte fallback")
        if any(MARK in p.lstrip(MARK) for p in self.plain):
            raise ValueError("a piece holds a word mark after another character")
        if any(c not in self.plain for p in self.plain for c in p):
            raise ValueError("a piece holds a character that is no piece itself")


@functools.lru_cache(maxsize=4)
def pieces(model: str) -> Pieces:
    return Pieces(model)


# -- counting ----------------------------------------------------------------

def whole_tokens(model: str) -> dict[str, int]:
    """Pre-tokens proved to encode alone as exactly one token: each piece that
    begins with a mark is given to the library itself."""
    p = pieces(model)
    keys = [t[1:] for t in p.plain if t[0] == MARK and MARK not in t[1:]]
    return {k: 1 for k, got in zip(keys, p.sp.encode(keys)) if got == [p.plain[MARK + k]]}


@functools.lru_cache(maxsize=4)
def counter(model: str) -> Remembered:
    """Tokens of a pre-token: 1 by the shortcut, else by merging it."""
    sp = pieces(model).sp
    # the library puts one mark before what it is given
    return Remembered(lambda key: len(sp.encode(spelt(key)[1:])) if key else 1, whole_tokens(model))


def count_tokens(text: str, counts: Remembered) -> int:
    return sum(map(counts.__getitem__, pre_tokens(text)))


# -- encoding ----------------------------------------------------------------

class PrefixCodec:
    """Encodes by a table of each prefix's last token.

    The encoding of a text is a chain of tokens in which every two neighbours
    are *compatible*: merged on their own they give just these two.  For each
    prefix exactly one piece that ends there is compatible with the last token
    of the prefix before it; an automaton over all pieces lists those that end
    there.  The ids are read backwards from the last prefix.
    """

    def __init__(self, model: str):
        import ahocorasick
        self.p = pieces(model)
        self.automaton = ahocorasick.Automaton()
        self.sizes = [len(t) for t in self.p.texts]
        for text, i in self.p.plain.items():
            if self.merged(text) == [text]:  # else no text gives this piece
                self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.compatible = Remembered(self._pair, most=2_000_000, most_bytes=256 << 20)
        self.singles = frozenset(t for t in self.p.plain if len(t) == 1)

    def merged(self, text: str) -> list[str]:
        """Plain merging: the best-scored neighbours first, the left one of equals."""
        parts, scores = list(text), self.p.scores
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = scores.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _pair(self, key: int) -> bool:
        a, b = self.p.texts[key >> 20], self.p.texts[key & 0xFFFFF]
        return self.merged(a + b) == [a, b]

    def _known(self, text: str) -> list[int]:
        """Ids of a text of which every character is a piece."""
        n = len(text)
        last = [-1] * (n + 1)
        fits, sizes = self.compatible, self.sizes
        for end, i in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                m = sizes[i]
                if m == end or m == 1 or fits[last[end - m] << 20 | i]:  # the shortest comes last: it must fit
                    last[end] = i
        ids = []
        while n:
            i = last[n]
            ids.append(i)
            n -= sizes[i]
        return ids[::-1]

    def ids(self, text: str) -> list[int]:
        """Ids of a pre-token; characters outside the vocabulary become bytes."""
        if self.singles.issuperset(text):
            return self._known(text)
        out, run = [], ""
        for c in text:
            if c in self.singles:
                run += c
                continue
            out += self._known(run) if run else []
            out += [self.p.byte_ids[b] for b in c.encode()]
            run = ""
        return out + (self._known(run) if run else [])

    def surface(self, ids: list[int]) -> str:
        """Decoded text of ids (without begin and end), its first mark kept as a space."""
        if self.p.byte_of.keys().isdisjoint(ids):
            return "".join(map(self.p.texts.__getitem__, ids)).replace(MARK, " ")
        out, run = [], bytearray()
        for i in ids:
            b = self.p.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run.clear()
            out.append(self.p.texts[i])
        if run:
            out.append(run.decode(errors="replace"))
        return "".join(out).replace(MARK, " ")


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class TextCodec:
    """Whole texts: ids as little-endian bytes, and their decoding."""

    def __init__(self, model: str):
        self.codec = PrefixCodec(model)
        sp = self.codec.p.sp
        self.begin, self.end = packed([sp.bos_id()]), packed([sp.eos_id()])
        texts, byte_of = self.codec.p.texts, self.codec.p.byte_of
        self.controls = frozenset(i for i in range(len(texts)) if sp.is_control(i))
        # a byte below 128 is a character of its own; the others are decoded in runs
        self.surfaces = ["" if i in self.controls else chr(byte_of[i]) if byte_of.get(i, 128) < 128 else t.replace(MARK, " ")
                         for i, t in enumerate(texts)]
        self.in_runs = frozenset(i for i, b in byte_of.items() if b >= 128)
        self.known = Remembered(lambda key: packed(self.codec.ids(spelt(key))))

    def encode(self, text: str) -> bytes:
        return self.begin + b"".join(map(self.known.__getitem__, pre_tokens(text))) + self.end

    def decode(self, ids: bytes) -> str:
        """Text of ids in the form that ``encode`` returns."""
        got = struct.unpack(f"<{len(ids) // 4}I", ids)
        if self.in_runs.isdisjoint(got):
            text = "".join(map(self.surfaces.__getitem__, got))
        else:
            text = self.codec.surface([i for i in got if i not in self.controls])
        return text[1:] if text[:1] == " " else text


@functools.lru_cache(maxsize=2)
def text_codec(model: str) -> TextCodec:
    return TextCodec(model)
