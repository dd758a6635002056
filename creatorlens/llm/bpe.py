"""BPE encoding and decoding by forced-boundary splitting.

A pair of neighbouring symbols that occurs inside no token of the vocabulary can never be covered by one
token, whatever merges are made, so a word may be cut there for certain: merges never cross the cut, and
the fragments are encoded independently and concatenated.  Fragments of one length form the rows of a
matrix, whose merges numpy makes side by side; a bounded memo keeps words seen before.

Texts are cut into words as the tokenizer file's normaliser and pre-tokeniser do (``pretokens``); merges
and decoding are done here.

Nulls count as empty texts (no ids, decoded text empty); empty and blank texts likewise.  Repeated rows are
encoded row by row.  Input columns other than the id and the text are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creatorlens.llm.common import slices, table
from creatorlens.llm.pretokens import WordMemo, encode_column, ragged_take

END = "</w>"
WIDE, ROWS = 64, 1 << 14  # symbols of a fragment merged in a matrix, and rows of one
NONE = np.int32(2**31 - 1)  # the rank of a pair that no merge joins


def symbols(word: str) -> list[str]:
    return [*word[:-1], word[-1] + END]


class ForcedBoundaryBpe:
    """Encoder and decoder of one tokenizer file (BPE over byte symbols with word ends)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.added).items()}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self._symbols()
        pairs = [tuple(p) if isinstance(p, list) else tuple(p.split(" ")) for p in model["merges"]]
        keys = np.array([self.vocab[a] << 32 | self.vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([self.vocab[a + b] for a, b in pairs] + [0], np.int32)
        self.merges = {(int(k >> 32), int(k & 0xFFFFFFFF)): r for r, k in enumerate(keys)}
        self.memo = WordMemo()
        names = [(self.names.get(i, "") + " ").encode() for i in range(max(self.names) + 1)]
        self.name_bytes = np.frombuffer(b"".join(names), np.uint8)
        self.name_offsets = np.concatenate([[0], np.cumsum([len(x) for x in names])])

    def _symbols(self) -> None:
        """Symbol ids of bytes inside a word and at its end, and the pairs found inside some token."""
        chars = [chr(c) for c in range(256)]
        for k, c in enumerate([c for c in range(256) if not (33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255)]):
            chars[c] = chr(256 + k)  # the byte-level alphabet: a printable stand-in for every other byte
        self.char = {ch: c for c, ch in enumerate(chars)}
        self.inner = np.array([self.vocab[ch] for ch in chars], np.int32)
        self.final = np.array([self.vocab[ch + END] for ch in chars], np.int32)
        size = int(max(self.inner.max(), self.final.max())) + 1
        self.inside = np.zeros((size, size), bool)
        for token in self.vocab:
            plain = [self.vocab[c] for c in token]
            self.inside[plain[:-1], plain[1:]] = True
            if token.endswith(END) and len(token) > len(END):  # its end may mark a word's end, or be plain symbols:
                own = [self.vocab[c] for c in symbols(token[:-len(END)])]  # reading it both ways can only forbid a cut
                self.inside[own[:-1], own[1:]] = True

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], NONE)

    def merge(self, fragment: list[int]) -> list[int]:
        """Merge the pair of lowest rank, the leftmost of equals, until none is left (long fragments)."""
        part: list[int | None] = list(fragment)
        n = len(part)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(self.merges[p], i, p) for i, p in enumerate(zip(fragment, fragment[1:])) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            rank, i, (a, b) = heapq.heappop(heap)
            j = right[i]
            if part[i] != a or j < 0 or part[j] != b:
                continue  # one of the two has been merged since
            part[i], part[j] = int(self.made[rank]), None
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (p := (part[i], part[k])) in self.merges:
                    heapq.heappush(heap, (self.merges[p], i, p))
            if (h := left[i]) >= 0 and (p := (part[h], part[i])) in self.merges:
                heapq.heappush(heap, (self.merges[p], h, p))
        return [p for p in part if p is not None]

    def merge_equal(self, rows: np.ndarray) -> np.ndarray:
        """The same for many fragments of one length at a time: a round makes one merge in each row."""
        n, width = rows.shape
        rank = self.rank(rows[:, :-1], rows[:, 1:])
        live, out, columns = np.arange(n), rows.copy(), np.arange(width)
        while len(live):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(live)), at]
            go = best < NONE
            out[live[~go]] = rows[~go]
            if not go.any():
                break
            live, rows, rank, at, best = live[go], rows[go], rank[go], at[go], best[go]
            k = np.arange(len(live))
            shift = columns + (columns > at[:, None])
            rows = np.take_along_axis(np.pad(rows, ((0, 0), (0, 1)), constant_values=-1), shift, axis=1)
            rows[k, at] = self.made[best]
            rank = np.take_along_axis(np.pad(rank, ((0, 0), (0, 2)), constant_values=NONE), shift[:, :-1], axis=1)
            rank[k, np.minimum(at, width - 2)] = NONE
            inner = at < width - 1
            rank[k[inner], at[inner]] = self.rank(rows[k[inner], at[inner]], rows[k[inner], at[inner] + 1])
            first = at > 0
            rank[k[first], at[first] - 1] = self.rank(rows[k[first], at[first] - 1], rows[k[first], at[first]])
        return out

    def encode_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and offsets of pre-tokenised words (their bytes end to end): cut at the forced boundaries,
        merge each fragment, concatenate."""
        ends = offsets[1:]
        own = self.inner[data]
        own[ends - 1] = self.final[data[ends - 1]]
        cut = np.ones(len(own), bool)
        cut[1:] = ~self.inside[own[:-1], own[1:]]
        cut[ends[:-1]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(np.append(starts, len(own)))
        ids = np.full(len(own), -1, np.int32)
        for size in np.unique(sizes):
            at = starts[sizes == size]
            if size == 1:
                ids[at] = own[at]
            elif size <= WIDE:
                for first in range(0, len(at), ROWS):
                    grid = at[first:first + ROWS, None] + np.arange(size)
                    ids[grid] = self.merge_equal(own[grid])
            else:
                for a in at:
                    got = self.merge(own[a:a + size].tolist())
                    ids[a:a + len(got)] = got
        return ids[ids >= 0], np.concatenate([[0], np.cumsum(ids >= 0)])[offsets]

    def encode_other(self, text: str) -> list[int]:
        """Ids of a text of any kind, by the file's own normaliser and pre-tokeniser."""
        out: list[int] = []
        for part in self.split_added.split(text) if self.split_added else [text]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                found = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(part))
                words = [bytes(map(self.char.__getitem__, w)) for w, _ in found]
                if words:
                    flat = np.frombuffer(b"".join(words), np.uint8)
                    out.extend(self.encode_words(flat, np.concatenate([[0], np.cumsum([len(w) for w in words])]))[0].tolist())
        return out

    def column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the column's texts, end to end, and the texts' offsets."""
        return encode_column(column, self.memo, self.encode_words, self.encode_other)

    def encode(self, text: str | None) -> list[int]:
        return self.column(pa.array([text], pa.string()))[0].tolist()

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Each list's token strings, joined by blanks (the file names no decoder); special tokens stay."""
        data, ends = ragged_take(self.name_bytes, self.name_offsets, ids)
        edges = ends[offsets]
        full = np.flatnonzero(np.diff(offsets) > 0)
        keep = np.ones(len(data), bool)
        keep[edges[full + 1] - 1] = False  # the blank after a list's last token
        edges = edges - np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        return pa.Array.from_buffers(pa.string(), len(offsets) - 1,
                                     [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data[keep])])

    def decode(self, ids) -> str:
        known = np.array([i for i in ids if i in self.names], np.int64)
        return self.decode_all(known, np.array([0, len(known)]))[0].as_py()


_LOADED: dict[str, ForcedBoundaryBpe] = {}


def encoder(path: str) -> ForcedBoundaryBpe:
    """One encoder per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = ForcedBoundaryBpe(path)
    return _LOADED[path]


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every row; one map over the scan, no shuffle.

    Memory per task: one Arrow batch of texts, about 2 MB of them at work, and the memo of words.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_path)
        for batch in batches:
            for part in slices(batch, text_col, 2 << 20):
                ids, offsets = bpe.column(part.column(text_col))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(id_col), lists, bpe.decode_all(ids, offsets)],
                                                 names=[id_col, "ids", "decoded"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 in place of the ids and the decoded text."""
    rest = [c for c in encoded.columns if c not in ("ids", "decoded")]
    return encoded.select(
        *rest, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents")
    return digests(encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")))
