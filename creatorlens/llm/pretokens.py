"""Pre-tokenised words of whole texts, found by numpy over bytes (for tokenizer files that lower-case, drop
white space and split letters, single digits and runs of signs).

A text is *plain* if it holds only ASCII and Latin-1 letters, no special token and no run of over
``LONGEST`` bytes; the words of plain texts are found here, whole slices at a time.  Any other text is left
to the caller, who asks the tokenizer's own normaliser and pre-tokeniser; both give the same words.
"""

from __future__ import annotations

import numpy as np

from creatorlens.llm.words import _VALUES, _tables, mix, text_bytes

LONGEST = 255
_BLANK, _LETTER, _DIGIT, _SIGN = range(4)
_CLASS = np.full(256, _LETTER, np.int8)
for _c in range(128):
    _CLASS[_c] = _BLANK if _c == 32 or 9 <= _c <= 13 else _LETTER if chr(_c).isalpha() else _DIGIT if chr(_c).isdigit() else _SIGN


def ragged_take(values: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists ``which`` of the ragged (values, offsets), end to end, and their new offsets."""
    sizes = (offsets[1:] - offsets[:-1])[which]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(ends[-1]) + np.repeat(offsets[:-1][which] - ends[:-1], sizes)
    return values[index], ends


def plain_texts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts are plain."""
    odd = data >= 128
    lead = data == 0xC3
    ok = lead.copy()  # a Latin-1 letter: C3 and 80-BF but the signs 97 and B7
    ok[1:] |= lead[:-1] & (data[1:] != 0x97) & (data[1:] != 0xB7)
    bad = odd & ~ok
    bad[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    blank = np.concatenate([[-1], np.flatnonzero(_CLASS[data] == _BLANK), [len(data)]])
    wide = np.flatnonzero(np.diff(blank) > LONGEST)
    found = np.concatenate([np.flatnonzero(bad), blank[wide] + 1, np.minimum(blank[wide + 1], len(data)) - 1])
    plain = np.ones(len(bounds) - 1, bool)
    rows = np.searchsorted(bounds, found[found < len(data)], side="right") - 1
    plain[rows] = False
    return plain


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of all words, and the offsets of the texts' words."""
    n = len(data)
    low = data.copy()
    capital = (data >= 65) & (data <= 90)
    capital[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    low[capital] += 32
    kind = _CLASS[data]
    first = np.ones(n, bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    first[bounds[:-1][bounds[:-1] < n]] = True
    first &= kind != _BLANK
    # 's 't 'm 'd 're 've 'll: an apostrophe alone, right before letters, takes one or two of them along
    at = np.flatnonzero((low == 39) & first)
    at = at[at + 1 < n]
    at = at[first[at + 1] & (kind[at + 1] == _LETTER)]
    at = at[~np.isin(at + 1, bounds)]
    if len(at):
        one = low[at + 1]
        two = np.where(at + 2 < n, low[np.minimum(at + 2, n - 1)], 0)
        two = np.where(first[np.minimum(at + 2, n - 1)] | (at + 2 >= n), 0, two)
        size = np.where(np.isin(one, list(b"stmd")), 1, 0)
        size[((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))] = 2
        at, size = at[size > 0], size[size > 0]
        first[at + 1] = False
        rest = at + 1 + size
        rest = rest[rest < n]
        first[rest] |= (kind[rest] == _LETTER) & (kind[rest - 1] == _LETTER)
    starts = np.flatnonzero(first)
    stop = np.ones(n + 1, bool)
    stop[:n] = first | (kind == _BLANK)
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, side="right")]
    return low, starts, ends, np.searchsorted(starts, bounds)


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _tables(len(low) + 1)
    run = np.empty(len(low) + 1, np.uint64)
    run[0] = 0
    with np.errstate(over="ignore"):
        np.cumsum(_VALUES[low] * up[:len(low)], out=run[1:])
        return mix((run[ends] - run[starts]) * down[starts])


class WordMemo:
    """Ids of words seen before, by hash: sorted arrays of at most ``most`` words plus one slice's."""

    def __init__(self, most: int = 300_000):
        self.most = most
        self.keys, self.ids, self.offsets = np.empty(0, np.uint64), np.empty(0, np.int32), np.zeros(1, np.int64)

    def find(self, low, starts, ends, encode_words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The memo's (ids, offsets) and each word's place in it; ``encode_words(flat bytes, offsets)`` gives
        the ids and offsets of the words that are new."""
        hashes = word_hashes(low, starts, ends)
        own, example, place = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, own)
        known = np.zeros(len(own), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == own[inside]
        if len(self.keys) + (~known).sum() > self.most:  # keep what this slice uses
            self.ids, self.offsets = ragged_take(self.ids, self.offsets, at[known])
            self.keys = own[known]
        if not known.all():
            new = example[~known]
            edges = np.empty(2 * len(new), np.int64)
            edges[0::2], edges[1::2] = starts[new], ends[new]
            flat, offsets = ragged_take(low, np.append(edges, edges[-1:]), np.arange(0, 2 * len(new), 2))
            ids, ends_of = encode_words(flat, offsets)
            keys = np.concatenate([self.keys, own[~known]])
            offsets = np.concatenate([self.offsets, self.offsets[-1] + ends_of[1:]])
            order = np.argsort(keys, kind="stable")
            self.ids, self.offsets = ragged_take(np.concatenate([self.ids, ids]), offsets, order)
            self.keys = keys[order]
        return self.ids, self.offsets, np.searchsorted(self.keys, own)[place]


def encode_column(column, memo: WordMemo, encode_words, encode_other) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column, end to end, and the texts' offsets; ``encode_other(text)`` encodes the
    texts that are not plain."""
    data, bounds = text_bytes(column)
    if not len(data):
        return np.empty(0, np.int32), np.zeros(len(bounds), np.int64)
    plain = plain_texts(data, bounds)
    if plain.all():
        low, starts, ends, of = words(data, bounds)
    else:
        part, edges = ragged_take(data, bounds, np.flatnonzero(plain))
        low, starts, ends, of = words(part, edges)
    if len(starts):
        ids, offsets, place = memo.find(low, starts, ends, encode_words)
        flat, word_ends = ragged_take(ids, offsets, place)
        of = word_ends[of]
    else:
        flat, of = np.empty(0, np.int32), np.zeros(len(of), np.int64)
    if plain.all():
        return flat, of
    sizes = np.zeros(len(plain), np.int64)
    sizes[plain] = np.diff(of)
    other = {i: np.array(encode_other(bytes(data[bounds[i]:bounds[i + 1]]).decode()), np.int32) for i in np.flatnonzero(~plain).tolist()}
    for i, got in other.items():
        sizes[i] = len(got)
    out_of = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(out_of[-1]), np.int32)
    keep = np.ones(len(out), bool)
    for i, got in other.items():
        out[out_of[i]:out_of[i + 1]] = got
        keep[out_of[i]:out_of[i + 1]] = False
    out[keep] = flat
    return out, out_of
