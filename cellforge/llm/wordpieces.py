"""Subword ids of words for a BPE vocabulary with word ends, held by the words' hashes.

White space ends every pre-token of such a vocabulary and is dropped, so the ids
of a text are those of its words one after another. Words are cut further into
runs of letters, single digits and runs of other signs, as the vocabulary's own
pattern does; a word with characters outside Latin letters and common signs, or
with the mark of a special token, is left to the library as a whole. The pieces
of new words are merged by tiktoken with the vocabulary's own ranks, a line feed
standing for the word's end; the tests hold this against the library word by word.
New words of ASCII and accented letters, digits and signs are cut into pieces all at once.

The table is an open-addressing one in numpy: 64-bit hash -> place and number of
ids. Words of up to eight bytes have hashes of their own; of longer ones two
different words meet with a chance of 2 ** -64 a pair. It starts anew when it holds
CACHE_WORDS words or CACHE_BYTES of ids, so a worker keeps some 40 MB at most.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache

import numpy as np

from . import kernel

#: Words and bytes of ids held; beyond either, the table starts anew.
CACHE_WORDS, CACHE_BYTES = 1 << 20, 16 << 20
#: The vocabulary's pattern, in full and on lower-case ASCII.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Bytes of a piece: lower-case letters, single digits, other signs; what else there is (apostrophes begin pieces of their own, "<" may begin a special token).
_LETTER, _DIGIT, _SIGN, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _SIGN
_KIND[48:58], _KIND[97:123], _KIND[[39, 60]] = _DIGIT, _LETTER, _OTHER
_UNUSUAL = re.compile("[^\x21-\x7e\xa1-\xac\xae-įĲ-ž‐-…€]|<\\|")


@cache
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _pattern():
    import regex

    return regex.compile(_PATTERN)


@cache
def _ranks(path: str):
    """(tiktoken encoding whose pieces end with a line feed, whether an id ends its piece)."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
    ranks, ends = {}, np.zeros(max(vocabulary.values()) + 1, bool)
    for token, k in vocabulary.items():
        if token.startswith("<|"):
            continue
        ends[k] = token.endswith("</w>")
        ranks[bytes(byte[c] for c in token.removesuffix("</w>")) + (b"\n" if ends[k] else b"")] = k
    return tiktoken.Encoding("pieces", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={}), ends


def encode_words(path: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all words, how many each has, whether the ids spell the word: no case, form or sign is lost)."""
    find = _pattern().findall
    size, same = np.zeros(len(words), np.int64), np.ones(len(words), bool)
    pieces: list[str] = []
    whole: dict[int, list[int]] = {}  # what the library encodes itself
    counts = np.zeros(len(words), np.int64)
    for i, (w, text) in enumerate(zip(words, b" ".join(words).decode("utf-8", "replace").split(" "), strict=True)):
        if w.isalpha():  # ASCII letters only: one piece
            low, own = text.lower(), None
        elif _UNUSUAL.search(text):
            whole[i] = library(path).encode(text, add_special_tokens=False).ids
            low = unicodedata.normalize("NFC", text).lower()
            same[i] = low == text and "".join(text.split()) == text and "<|" not in text
            continue
        else:
            low = text.lower()
            own = None if low.isalpha() else (_ASCII.findall if w.isascii() else find)(low)
        same[i] = low == text
        if own is None:
            pieces.append(low)
            counts[i] = 1
        else:
            pieces += own
            counts[i] = len(own)
    encoding, ends = _ranks(path)
    parts = [encoding.encode_to_numpy("\n".join(pieces[a : a + 8192]) + "\n") for a in range(0, len(pieces), 8192)]
    ids = np.concatenate(parts).astype(np.uint32) if parts else np.zeros(0, np.uint32)
    stop = np.concatenate([[0], np.flatnonzero(ends[ids]) + 1])  # pieces' ends
    edge = stop[np.concatenate([[0], np.cumsum(counts)])]
    size = np.diff(edge)
    for i, own in whole.items():
        size[i] = len(own)
    if not whole:
        return ids, size, same
    out, at = np.empty(int(size.sum()), np.uint32), np.concatenate([[0], np.cumsum(size)])
    fill = np.ones(len(out), bool)
    for i, own in whole.items():
        out[at[i] : at[i + 1]] = own
        fill[at[i] : at[i + 1]] = False
    out[fill] = ids
    return out, size, same


def _encode_plain(path: str, data: np.ndarray, kind: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, how many each has) of words without bytes of kind _OTHER, one after another, without a step a word."""
    if not len(length):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    first = np.cumsum(length) - length
    begins = np.ones(len(data), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    begins[first] = True
    piece = np.cumsum(begins) - 1
    text = np.full(len(data) + int(piece[-1]) + 1, 10, np.uint8)  # a line feed after every piece
    text[np.arange(len(data)) + piece] = data
    encoding, ends = _ranks(path)
    ids = encoding.encode_to_numpy(text.tobytes().decode()).astype(np.uint32)
    stop = np.concatenate([[0], np.flatnonzero(ends[ids]) + 1])
    return ids, np.diff(stop[np.append(piece[first], piece[-1] + 1)])


def encode_chosen(path: str, words: kernel.Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What encode_words gives for these words of a block."""
    length = words.length[chosen]
    first = np.cumsum(length) - length
    data = words.data[np.repeat(words.start[chosen] - first, length) + np.arange(int(length.sum()))]
    low = kernel._LOWER[data]
    # after C3, the lower-case letters from U+00DF on are letters as well
    kind, next_ = _KIND[low], np.append(low[1:], np.uint8(0))
    accent = np.flatnonzero((low == 0xC3) & (next_ >= 0x9F) & (next_ <= 0xBF) & (next_ != 0xB7))
    kind[accent] = kind[accent + 1] = _LETTER
    rest = np.logical_or.reduceat(kind == _OTHER, first)
    same = np.ones(len(chosen), bool) if words.lower else ~np.logical_or.reduceat(low != data, first)
    if not rest.any():
        return *_encode_plain(path, low, kind, length), same
    size, here = np.zeros(len(chosen), np.int64), ~np.repeat(rest, length)
    other, size[rest], same[rest] = encode_words(path, words.texts(chosen[rest]))
    plain, size[~rest] = _encode_plain(path, low[here], kind[here], length[~rest])
    of = np.repeat(rest, size)
    ids = np.empty(len(of), np.uint32)
    ids[of], ids[~of] = other, plain
    return ids, size, same


class Slots:
    """An open-addressing table in numpy: 64-bit hash -> entry."""

    def __init__(self, h: np.ndarray) -> None:
        """Of distinct hashes, whose entries are their places."""
        slots = 1 << 10
        while 2 * len(h) > slots:
            slots *= 2
        self.hash = h if len(h) else np.zeros(1, np.uint64)
        self._room(slots)
        self._put(np.arange(len(h), dtype=np.int32))

    def _room(self, slots: int) -> None:
        self.slot = np.full(slots, -1, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        mask = len(self.slot) - 1
        at = (h & np.uint64(mask)).view(np.int64)
        out = self.slot[at]
        todo = np.flatnonzero((self.hash[out] != h) & (out >= 0))
        at = at[todo]
        while len(todo):
            at = (at + 1) & mask
            entry = self.slot[at]
            out[todo] = entry
            go = (self.hash[entry] != h[todo]) & (entry >= 0)
            todo, at = todo[go], at[go]
        return out

    def _put(self, entry: np.ndarray) -> None:
        """Entries whose hashes are distinct and not in the table."""
        mask = len(self.slot) - 1
        at = (self.hash[entry] & np.uint64(mask)).view(np.int64)
        while len(entry):
            free = self.slot[at] < 0
            won = np.zeros(len(entry), bool)
            place, one = np.unique(at[free], return_index=True)
            first = np.flatnonzero(free)[one]
            self.slot[place] = entry[first]
            won[first] = True
            entry, at = entry[~won], (at[~won] + 1) & mask


class WordIds(Slots):
    """Ids of words; `stray` takes the place of special tokens inside words and of words without ids."""

    def __init__(self, path: str, stray: int | None = None, special: int = 1 << 30, limit: int = CACHE_WORDS) -> None:
        self.path, self.stray, self.special, self.limit = path, stray, special, limit
        self._clear()

    def _clear(self) -> None:
        self._room(1 << 14)
        self.hash, self.first, self.size, self.same = (np.zeros(1 << 13, t) for t in (np.uint64, np.int32, np.int32, bool))
        self.extra: tuple[Slots | None, np.ndarray] = (None, np.zeros(0, np.int32))
        self.pool = np.zeros(1 << 15, np.uint16 if len(_ranks(self.path)[1]) < 1 << 16 else np.uint32)
        self.n = self.used = 0
        if self.stray is not None:  # entries of the two special ids, which no hash leads to
            self.starts, self.ends, self.n, self.used = 0, 1, 2, 2
            self.first[1], self.size[:2], self.pool[:2] = 1, 1, (self.special, self.special + 1)

    def entries(self, words: kernel.Words) -> np.ndarray:
        """The entry of every word, new ones learnt."""
        if self.n > self.limit or self.pool[: self.used].nbytes > CACHE_BYTES:
            self._clear()
        h = words.hashes()
        out = self.find(h)
        new = np.flatnonzero(out < 0)
        if len(new):
            fresh, at = np.unique(h[new], return_index=True)
            self._learn(fresh, words, new[at])
            out[new] = self.find(h[new])
        return out

    def found(self, other: Slots, entries: np.ndarray) -> np.ndarray:
        """Of these words, the entries in another table, or -1; each word of this one is sought there once."""
        of, known = self.extra
        if of is not other:
            known = known[:0]
        if len(known) < self.n:
            self.extra = other, np.append(known, other.find(self.hash[len(known) : self.n]))
        return self.extra[1][entries]

    def _learn(self, h: np.ndarray, words: kernel.Words, chosen: np.ndarray) -> None:
        ids, size, same = encode_chosen(self.path, words, chosen)
        if self.stray is not None:
            ids = np.where(ids >= self.special, np.uint32(self.stray), ids)
            if (size == 0).any():
                at = np.cumsum(size) - size
                ids, size = np.insert(ids, at[size == 0], self.stray), np.maximum(size, 1)
        n, used = self.n + len(h), self.used + len(ids)
        for name, need in (("hash", n), ("first", n), ("size", n), ("same", n), ("pool", used)):
            a = getattr(self, name)
            if need > len(a):
                b = np.zeros(max(need, 2 * len(a)), a.dtype)
                b[: len(a)] = a
                setattr(self, name, b)
        self.hash[self.n : n] = h
        if 2 * n > len(self.slot):
            slots = len(self.slot)
            while 2 * n > slots:
                slots *= 2
            self._room(slots)
            self._put(np.arange(0 if self.stray is None else 2, self.n, dtype=np.int32))
        self.first[self.n : n] = self.used + np.cumsum(size) - size
        self.size[self.n : n], self.same[self.n : n] = size, same
        self.pool[self.used : used] = ids
        self._put(np.arange(self.n, n, dtype=np.int32))
        self.n, self.used = n, used

    def ids(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of these words one after another, how many each has)."""
        size = self.size[entries].astype(np.int64)
        at = np.cumsum(size)
        where = np.repeat(self.first[entries] - at + size, size) + np.arange(at[-1] if len(at) else 0)
        return self.pool[where].astype(np.uint32), size


@cache
def shared(path: str, stray: int | None = None, special: int = 1 << 30, limit: int = CACHE_WORDS) -> WordIds:
    """The table of this process, which later tasks of the same worker find filled."""
    return WordIds(path, stray, special, limit)
