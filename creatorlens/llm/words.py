"""Vectorised word hashing over Arrow string columns (shared helper of the text operators).

Texts are handled as UTF-8 bytes, a few MB at a time, with numpy only: no Python loop runs per word.
A word's 64-bit hash is the polynomial of its mapped bytes, taken from one running sum, so the cost per
byte is constant and memory is bounded by ``CHUNK_BYTES`` plus eight bytes per word of one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
        k += m
    return out


_CACHE: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _CACHE or len(_CACHE["up"]) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 1))
        _CACHE["up"] = _powers(_BASE, size)
        _CACHE["down"] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _CACHE["up"], _CACHE["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

#: Separators of the blank-delimited words ``[^\x20\x09-\x0D]+``.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: Separators of bare words: every ASCII byte that is neither letter nor digit.
NON_ALNUM = bytes(c for c in range(128) if not chr(c).isalnum())


class WordHasher:
    """Splits texts at ``separators`` (ASCII bytes), lower-cases A-Z (or not) and hashes the words."""

    def __init__(self, separators: bytes = BLANKS, lower_case: bool = True):
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        lower = np.arange(256)
        lower[65:91] += 32 * lower_case
        self.value = np.where(self.is_word, _VALUES[lower], np.uint64(0)).astype(np.uint64)

    def _chunk(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of ``data``, whose texts start and end at ``bounds``: hash, text index, start and end byte."""
        n = len(data)
        word = self.is_word[data]
        before = np.empty(n + 1, bool)
        before[0], before[1:] = False, word
        cut = np.zeros(n + 1, bool)
        cut[bounds] = True
        starts = np.flatnonzero(word & (~before[:-1] | cut[:-1]))
        after = np.empty(n, bool)
        after[:-1], after[-1:] = word[1:], False
        ends = np.flatnonzero(word & (~after | cut[1:])) + 1
        up, down = _tables(n + 1)
        run = np.empty(n + 1, np.uint64)
        run[0] = 0
        with np.errstate(over="ignore"):
            np.cumsum(self.value[data] * up[:n], out=run[1:])
            hashes = mix((run[ends] - run[starts]) * down[starts])
        text = np.searchsorted(bounds, starts, side="right") - 1
        return hashes, text, starts, ends

    def texts(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For each run of whole texts: (first row, end row, word hashes, offsets of the rows' words).

        A null text has no words.  A text longer than ``CHUNK_BYTES`` forms a run of its own and is
        hashed piece by piece, cut at separators.
        """
        data, bounds = text_bytes(column)
        rows = len(bounds) - 1
        first = 0
        while first < rows:
            end = int(np.searchsorted(bounds, bounds[first] + CHUNK_BYTES, side="right")) - 1
            end = min(max(end, first + 1), rows)
            lo, hi = int(bounds[first]), int(bounds[end])
            if hi - lo <= CHUNK_BYTES:
                if hi == lo:
                    hashes, text = np.empty(0, np.uint64), np.empty(0, np.int64)
                else:
                    hashes, text, _, _ = self._chunk(data[lo:hi], bounds[first:end + 1] - lo)
                offsets = np.searchsorted(text, np.arange(end - first + 1))
            else:
                hashes = self._long(data[lo:hi])
                offsets = np.array([0, len(hashes)])
            yield first, end, hashes, offsets
            first = end

    def _long(self, data: np.ndarray) -> np.ndarray:
        pieces, at = [], 0
        while at < len(data):
            to = min(at + CHUNK_BYTES, len(data))
            if to < len(data):
                blank = np.flatnonzero(~self.is_word[data[at:to]])
                while not len(blank) and to < len(data):  # one word longer than a chunk
                    step = np.flatnonzero(~self.is_word[data[to:to + CHUNK_BYTES]])
                    to = to + int(step[0]) if len(step) else min(to + CHUNK_BYTES, len(data))
                    blank = np.array([to - at - 1]) if len(step) or to == len(data) else blank
                to = at + int(blank[-1]) + 1
            pieces.append(self._chunk(data[at:to], np.array([0, to - at]))[0])
            at = to
        return np.concatenate(pieces)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the row bounds of a string column (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    base = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.empty(0, np.uint8)
    return base[bounds[0]:bounds[-1]], bounds - bounds[0]


def ngrams(hashes: np.ndarray, offsets: np.ndarray, n: int, whole_if_shorter: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word sequences of each text and their offsets.

    A text with fewer words gives its whole sequence as one n-gram if ``whole_if_shorter``, else none.
    """
    with np.errstate(over="ignore"):
        return _ngrams(hashes, offsets, n, whole_if_shorter)


def _ngrams(hashes: np.ndarray, offsets: np.ndarray, n: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    words = np.diff(offsets)
    counts = np.maximum(words - n + 1, 0)
    short = (words > 0) & (words < n) if whole else np.zeros(len(words), bool)
    size = len(hashes)
    full = np.zeros(max(size - n + 1, 0), np.uint64)
    for k in range(n):
        full += hashes[k:k + len(full)] * np.uint64(pow(_BASE, k + 1, 1 << 64))
    full = mix(full + np.uint64(n))
    starts = np.arange(len(full))
    text = np.searchsorted(offsets, starts, side="right") - 1
    good = starts + n <= offsets[text + 1] if len(full) else np.empty(0, bool)
    if not short.any():
        return full[good], np.concatenate([[0], np.cumsum(counts)])
    counts = counts + short
    out = np.empty(int(counts.sum()), np.uint64)
    at = np.concatenate([[0], np.cumsum(counts)])
    slot = np.zeros(len(out), bool)
    slot[at[:-1][short]] = True
    out[~slot] = full[good]
    tail = []
    for i in np.flatnonzero(short):
        h = hashes[offsets[i]:offsets[i + 1]]
        p = np.array([pow(_BASE, k + 1, 1 << 64) for k in range(len(h))], np.uint64)
        tail.append(int(mix(np.array([(h * p).sum(dtype=np.uint64) + np.uint64(len(h))], np.uint64))[0]))
    out[slot] = np.array(tail, np.uint64)
    return out, at


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, their offsets, and how often each occurs."""
    values = values.copy()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        values[a:b].sort()  # many short sorts are far cheaper than one sort by text and value
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[offsets[:-1][offsets[:-1] < len(values)]] = True
    at = np.flatnonzero(first)
    return values[at], np.searchsorted(at, offsets), np.diff(np.append(at, len(values)))


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each text's values (rows of ``values``), 0 for an empty one."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        with np.errstate(over="ignore"):
            out[full] = np.add.reduceat(values, offsets[full], axis=0)
    return out


def _places(hashes: np.ndarray, size: int):
    """Four bits of a table of ``size`` bits (a power of two) for each hash."""
    down, mask = np.uint64(65 - size.bit_length()), np.uint64(size - 1)
    for _ in range(2):
        hashes = mix(hashes + np.uint64(1))
        yield hashes >> down
        yield hashes & mask


def mark(packed: np.ndarray, hashes: np.ndarray) -> None:
    """Mark hashes in a Bloom filter (packed bits)."""
    for at in _places(hashes, len(packed) * 8):
        np.bitwise_or.at(packed, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def marked(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be marked: all that are, and about one in five thousand others at 32 bits for each."""
    out = np.zeros(len(hashes), bool)
    left = np.arange(len(hashes))
    first, *rest = _places(hashes, len(packed) * 8)
    left = left[(packed[first >> np.uint64(3)] >> (first & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    for at in rest:
        at = at[left]
        left = left[(packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    out[left] = True
    return out
