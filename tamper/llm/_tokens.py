"""Token ids of whole texts, exactly as the ``tokenizers`` library gives them, at numpy speed.

A byte-level BPE file first splits a text into pre-tokens (letters, digits, other marks,
white space; a blank joins what follows it) and then merges within each pre-token. The
split is done here on arrays of code points; each distinct pre-token is encoded once by
``tokenizers`` and kept in a table of bounded size. Texts with characters whose class
depends on the Unicode version, or with a special token's string, go to ``tokenizers`` as
a whole. Nothing is trained."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

from tamper.llm import _text as X

LETTER, NUMBER, SPACE, OTHER, ODD = range(5)
SPECIAL = "<|endoftext|>"
SLOTS = 1 << 21  # two ways: a pre-token may stand in a slot or the one beside it
IDS = 1 << 24    # ids kept at most; 17 bytes a slot and 4 an id: 105 MB
LONGEST = 64  # longer pre-tokens are encoded each time, not kept
ENCODED = 4096


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = LETTER
        elif kind[0] == "N":
            out[c] = NUMBER
        elif kind[0] == "Z":
            out[c] = SPACE
        elif kind[0] == "C":
            out[c] = ODD
    out[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = SPACE
    return out


def split(points: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of many texts in one array of code points; ``offsets``
    are the n + 1 text borders, ``kind`` the class of each point."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.empty(n, bool)
    start[0] = True
    start[1:] = kind[1:] != kind[:-1]
    start |= edge[:n]
    space = kind == SPACE
    # the last white space before a visible character of the same text stands apart ...
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~edge[1:n]
    start |= last
    # ... and if it is a blank, that character's run begins with it
    blank = last & (points == 0x20)
    after = np.flatnonzero(blank) + 1
    start[after] = False
    # contractions: a lone apostrophe that begins a run, before s t m d re ve ll
    quote = np.flatnonzero(start & (points == 0x27))
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~edge[quote + 1]]
    if len(quote):
        one = points[quote + 1]
        two = np.where(quote + 2 < n, points[np.minimum(quote + 2, n - 1)], 0)
        two = np.where(edge[np.minimum(quote + 2, n)], 0, two)
        short = np.isin(one, [0x73, 0x74, 0x6D, 0x64])
        long = (((one == 0x72) | (one == 0x76)) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C))
        for hit, size in ((short, 2), (long & ~short, 3)):
            at = quote[hit]
            start[at + 1] = False
            end = at + size
            end = end[end < n]
            start[end] = True
    return np.flatnonzero(start)


class Tokens:
    """``encode(texts)`` -> (ids as uint32, first id of each text, n + 1 entries)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self):
        self.key = np.zeros(SLOTS, np.uint64)
        self.at, self.size = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.uint8)
        self.ids, self.fill = np.zeros(1 << 20, np.uint32), 0

    def _keep(self, ids: list[int]) -> int:
        if self.fill + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(ids)), np.uint32)))
        self.ids[self.fill:self.fill + len(ids)] = ids
        self.fill += len(ids)
        return self.fill - len(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        table = classes()
        joined = "".join(texts)
        whole = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        kind = table[whole]
        odd = set(np.unique(np.searchsorted(offsets, np.flatnonzero(kind == ODD), "right") - 1).tolist())
        odd |= {i for i, t in enumerate(texts) if SPECIAL in t}
        starts = split(whole, offsets, kind)
        ends = np.append(starts[1:], len(whole))
        with np.errstate(over="ignore"):
            h = X.hash_spans(whole, starts, ends, long=LONGEST) | np.uint64(1)
        if self.fill > IDS:  # bounded memory
            self._clear()
        slot = (h >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)
        slot ^= self.key[slot] != h  # the other way, where the first holds something else
        at, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        miss = np.flatnonzero((self.key[slot] != h) | (ends - starts > LONGEST))
        if len(miss):
            _, lead, back = np.unique(h[miss], return_index=True, return_inverse=True)
            lead = miss[lead]
            strings = [joined[a:b] for a, b in zip(starts[lead].tolist(), ends[lead].tolist(), strict=True)]
            where, count = np.empty(len(lead), np.int64), np.empty(len(lead), np.int64)
            # an encoding is far larger than its ids: few are held at a time
            for lo in range(0, len(strings), ENCODED):
                some = self.tokenizer.encode_batch_fast(strings[lo:lo + ENCODED], add_special_tokens=False)
                found = [e.ids for e in some]
                sizes = np.array([len(ids) for ids in found])
                count[lo:lo + len(found)] = sizes
                where[lo:lo + len(found)] = self._keep([i for ids in found for i in ids]) + np.cumsum(sizes) - sizes
            at[miss], size[miss] = where[back], count[back]
            short = ends[lead] - starts[lead] <= LONGEST
            put = (h[lead][short] >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)
            put ^= (self.key[put] != 0) & (self.key[put ^ 1] == 0)  # a free way, else the first
            self.key[put], self.at[put], self.size[put] = h[lead][short], where[short], count[short]
            # of two pre-tokens with one slot, the later wins in all three arrays alike
        total = np.concatenate(([0], np.cumsum(size)))
        take = np.arange(total[-1]) + np.repeat(at - total[:-1], size)
        ids, first = self.ids[take], total[np.searchsorted(starts, offsets)]
        if odd:
            parts = [np.asarray(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
                     if i in odd else ids[first[i]:first[i + 1]] for i, t in enumerate(texts)]
            ids = np.concatenate(parts)
            first = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return ids, first


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    """One per Python worker."""
    return Tokens(path)
