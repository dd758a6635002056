"""Substring dedup by super-k-mers: windows of 50 words that an earlier document holds, too, are removed.

A window is ``WINDOW`` consecutive words of a document.  Its minimiser is the smallest hash among its sequences of
``SEED`` words; consecutive windows that share one travel together, as one packed string of their words (a
super-k-mer), to the bucket of that minimiser.  Equal windows have equal minimisers, so all of them meet there.

1. One pass over the texts lists the super-k-mers by a 128-bit name of their words.  Equal ones collapse before the
   shuffle; minimisers that lie in two documents at least are marked in a bit table of bounded size.
2. One pass packs the words of the marked super-k-mers, once for each name and task.
3. Each bucket sorts its windows: their words become ranks, and pairs of ranks of 1, 2, 4, ... 32 words are sorted
   into ranks of twice the length until a rank stands for the whole window.  No window is taken for another.  The
   smallest document of each distinct window is its first.
4. The super-k-mers' firsts go back to all documents that hold them; windows with a smaller first are repeats, and the
   words that they cover are removed.

Hot groups: copies of a super-k-mer are counted, not listed, in a bucket; a bucket of more than ``BUCKET`` distinct
super-k-mers is not collected, its windows are counted one by one by their 128-bit names (partial aggregates); a
super-k-mer that more than ``HOT`` documents hold meets them in ``SALTS`` parts.  Bit tables with many marks let
more through, which the sort tells apart: slower, not different.

Words are maximal runs of characters other than blank and 09-0D, unchanged; null texts have none.  A document is a
row; rows with equal ids are not earlier than each other.  A row without an id has no order: it loses nothing and
takes nothing.  A document of fewer than ``WINDOW`` words has no window and stays whole.  Words are told apart by 64
bits of their hashes.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creatorlens.llm.common import mark_table, row_keys, slices, table, written
from creatorlens.llm.words import BLANKS, WordHasher, _tables, marked, mix

WINDOW, SEED = 50, 8  # words of a window and of the sequences that minimisers are taken from
LONGEST = 512  # windows of a super-k-mer at most: longer ones (of repeated words) are cut
BUCKET = 1 << 13  # distinct super-k-mers that a bucket may sort
HOT, SALTS = 1 << 14, 64  # copies of a super-k-mer from which its documents are dealt over so many parts
CHUNK = 1 << 20  # words sorted at a time, and words of one text handled at a time
_words = WordHasher(BLANKS, lower_case=False)


# ---------------------------------------------------------------- super-k-mers

def minimisers(hashes: np.ndarray, window: int = WINDOW, seed: int = SEED) -> np.ndarray:
    """For each window of one word sequence the smallest mixed hash of its ``seed``-word sequences."""
    if len(hashes) < window:
        return np.empty(0, np.uint64)
    up, _ = _tables(seed + 1)
    with np.errstate(over="ignore"):
        best = np.zeros(len(hashes) - seed + 1, np.uint64)
        for i in range(seed):
            best += hashes[i:i + len(best)] * up[i + 1]
        best = mix(best)
    wide, have = window - seed + 1, 1
    while have * 2 <= wide:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    return np.minimum(best[:len(hashes) - window + 1], best[wide - have:][:len(hashes) - window + 1])


def names(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each stretch of words: two polynomials of their hashes, and the length."""
    up, down = _tables(len(hashes) + 1)
    out = []
    with np.errstate(over="ignore"):
        for salt in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47):
            run = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(mix(hashes ^ np.uint64(salt)) * up[:len(hashes)], out=run[1:])
            out.append(mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def stretches(hashes: np.ndarray, split: np.ndarray | None = None, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, windows) of one text's super-k-mers.  Windows of minimisers marked in ``split`` come one by one."""
    found = minimisers(hashes, window)
    if not len(found):
        return found, np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.ones(len(found), bool)
    cut[1:] = found[1:] != found[:-1]
    at = np.flatnonzero(cut)
    cut[(np.arange(len(found)) - np.repeat(at, np.diff(np.append(at, len(found))))) % LONGEST == 0] = True
    if split is not None:
        alone = marked(split, found)
        cut |= alone
        cut[1:] |= alone[:-1]
    at = np.flatnonzero(cut)
    return found[at], at, np.diff(np.append(at, len(found)))


def _pieces(batch: pa.RecordBatch, text: int, window: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, first word, word hashes): the texts with windows; long ones in pieces that overlap by ``window`` - 1."""
    for first, end, hashes, offsets in _words.texts(batch.column(text)):
        for row, a, b in zip(range(first, end), offsets[:-1].tolist(), offsets[1:].tolist()):
            for at in range(a, b - window + 1, CHUNK):
                yield row, at - a, hashes[at:min(at + CHUNK + window - 1, b)]


def listed(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(m, a, b, id, k, l, start): every super-k-mer: minimiser, name, document, row and first word."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                found = []
                for row, first, hashes in _pieces(part, 1, window):
                    m, at, n = stretches(hashes, None, window)
                    found.append((m.view(np.int64), *names(hashes, at, at + n + window - 1), np.full(len(m), row), first + at))
                if found:
                    m, a, b, row, start = (np.concatenate(x) for x in zip(*found))
                    of = part.select([0, 2, 3]).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(a), pa.array(b), *of.columns, pa.array(start.astype(np.int32))],
                                                     names=["m", "a", "b", "id", "k", "l", "start"])

    rows = docs.filter(F.col(id_col).isNotNull()).select(id_col, text_col, *row_keys(id_col, text_col))
    return rows.mapInArrow(run, f"m long, a long, b long, id {id_type}, k long, l long, start int")


def packed(docs: DataFrame, id_col: str, text_col: str, shared: np.ndarray, split: np.ndarray, window: int) -> DataFrame:
    """(m, a, b, words, id, k, l, start): the marked super-k-mers with their packed words, once a task; and, with null
    words, the single windows of the minimisers marked in ``split`` with their documents."""
    id_type = docs.schema[id_col].dataType.simpleString()
    columns = ["m", "a", "b", "words", "id", "k", "l", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for part in slices(batch, text_col):
                rows = []
                for row, first, hashes in _pieces(part, 1, window):
                    m, at, n = stretches(hashes, split, window)
                    some = np.flatnonzero(marked(shared, m))
                    m, at, n = m[some], at[some], n[some]
                    alone = marked(split, m)
                    a, b = names(hashes, at, at + n + window - 1)
                    for i, (x, y, z, lone) in enumerate(zip(m.view(np.int64).tolist(), a.tolist(), b.tolist(), alone.tolist())):
                        if lone:
                            rows.append((x, y, z, None, row, first + int(at[i])))
                        elif (y, z) not in seen:
                            if len(seen) >= 200_000:
                                seen.clear()
                            seen.add((y, z))
                            rows.append((x, y, z, hashes[at[i]:at[i] + n[i] + window - 1].tobytes(), None, None))
                if rows:
                    m, a, b, words, row, start = zip(*rows)
                    of = part.select([0, 2, 3]).take(pa.array(row, pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(words, pa.binary()),
                                                      *of.columns, pa.array(start, pa.int32())], names=columns)

    rows = docs.filter(F.col(id_col).isNotNull()).select(id_col, text_col, *row_keys(id_col, text_col))
    return rows.mapInArrow(run, f"m long, a long, b long, words binary, id {id_type}, k long, l long, start int")


# ---------------------------------------------------------------- buckets

def window_ranks(words: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A number for each window that starts at ``starts``; equal windows, and no others, have equal numbers."""
    _, rank = np.unique(words, return_inverse=True)
    have = 1
    while have * 2 <= window:
        _, rank = np.unique(rank[:-have] * np.int64(len(words)) + rank[have:], return_inverse=True)
        have *= 2
    _, rank = np.unique(rank[starts] * np.int64(len(words)) + rank[starts + window - have], return_inverse=True)
    return rank


def firsts(own: DataFrame, id_type: str, window: int) -> DataFrame:
    """(a, b, firsts): of each super-k-mer that holds a repeat, the first document of each of its windows.

    ``own`` has (m, a, b, words, lo, hi): distinct super-k-mers, the smallest and largest document of each."""
    def sorted_(rows: list[tuple]) -> pa.RecordBatch | None:
        a, b, words, lo, hi = zip(*rows)
        sizes = np.array([len(w) // 8 for w in words])
        ends = np.cumsum(sizes)
        count = sizes - window + 1
        at = np.cumsum(count) - count
        starts = np.arange(count.sum()) - np.repeat(at, count) + np.repeat(ends - sizes, count)
        rank = window_ranks(np.frombuffer(b"".join(words), np.uint64), starts, window)
        values, place = np.unique(np.array(lo), return_inverse=True)
        least = np.full(rank.max() + 1, len(values))
        np.minimum.at(least, rank, np.repeat(place, count))
        first = least[rank]
        some = np.flatnonzero(np.array(hi) > values[np.minimum.reduceat(first, at)])
        if not len(some):
            return None
        keep = np.zeros(len(rows), bool)
        keep[some] = True
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count[some])]), pa.int32()), pa.array(values[first[np.repeat(keep, count)]].tolist()))
        return pa.RecordBatch.from_arrays([pa.array([a[i] for i in some], pa.int64()), pa.array([b[i] for i in some], pa.int64()), lists], names=["a", "b", "firsts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for x in batches for r in zip(*(c.to_pylist() for c in x.columns)))
        held, size = [], 0
        for _, bucket in itertools.groupby(rows, key=lambda r: r[0]):
            one = [r[1:] for r in bucket]
            held += one
            size += sum(len(r[2]) for r in one) // 8
            if size >= CHUNK:
                if (out := sorted_(held)) is not None:
                    yield out
                held, size = [], 0
        if held and (out := sorted_(held)) is not None:
            yield out

    dealt = own.select("m", "a", "b", "words", "lo", "hi").repartition("m").sortWithinPartitions("m")
    return dealt.mapInArrow(run, f"a long, b long, firsts array<{id_type}>")


def _dealt(rows: DataFrame, busy: np.ndarray, every: bool) -> DataFrame:
    """``rows`` (with a, b) with a part number: for names marked in ``busy`` any of ``SALTS``, by the row's key or (if
    ``every``) all of them; 0 for others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hot = marked(busy, batch.column(0).to_numpy().view(np.uint64))
            if every:
                times = np.where(hot, SALTS, 1)
                ends = np.cumsum(times)
                part = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - times, times)
                batch = batch.take(pa.array(np.repeat(np.arange(len(hot)), times)))
            else:
                part = np.where(hot, batch.column(2).to_numpy().view(np.uint64) % np.uint64(SALTS), np.uint64(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], names=[*batch.schema.names, "part"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, part int")


def repeated_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(k, l, covered): of each row (``row_keys``) with repeats, the word ranges [start, end) that they cover."""
    id_type = docs.schema[id_col].dataType.simpleString()
    every = written(listed(docs, id_col, text_col, window), "super-kmers")
    groups = every.groupBy("m", "a", "b").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    met = groups.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter(F.col("lo") < F.col("hi"))
    met = written(met.select("m", "n"), "minimisers")
    shared, split = mark_table(met.select("m")), mark_table(met.filter(F.col("n") > BUCKET).select("m"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.column(0).to_numpy().view(np.uint64)
            yield batch.filter(pa.array(marked(shared, m) & ~marked(split, m)))

    rows = every.mapInArrow(chosen, every.schema)
    strings = written(packed(docs, id_col, text_col, shared, split, window), "packed")
    lone = strings.filter(F.col("words").isNull()).select("a", "b", "k", "id", "l", "start")
    # buckets: the distinct super-k-mers, and how many rows hold each
    counted = rows.groupBy("m", "a", "b").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("copies"))
    own = (strings.filter(F.col("words").isNotNull()).groupBy("m", "a", "b").agg(F.first("words").alias("words"))
           .join(counted.join(met.select("m"), "m", "left_semi"), ["m", "a", "b"]))
    known = written(firsts(own, id_type, window), "firsts")
    single = (lone.groupBy("a", "b").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("copies")))
    known = known.unionByName(single.filter(F.col("lo") < F.col("hi")).select("a", "b", F.array("lo").alias("firsts")))
    busy = mark_table(counted.select("a", "copies").unionByName(single.select("a", "copies")).filter(F.col("copies") > HOT).select("a"))
    holders = rows.select("a", "b", "k", "id", "l", "start").unionByName(lone)
    met_again = _dealt(holders, busy, False).join(_dealt(known, busy, True), ["a", "b", "part"])
    # runs of windows whose first document is smaller
    late = F.transform("firsts", lambda f: f < F.col("id"))
    ranges = met_again.select("k", "l", "start", late.alias("late")).mapInArrow(_covered(window), "k long, l long, start int, end int")
    return ranges.groupBy("k", "l").agg(F.collect_set(F.struct("start", "end")).alias("covered"))


def _covered(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            late = batch.column(3)
            flat = late.flatten().to_numpy(zero_copy_only=False).astype(bool)
            sizes = late.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            before = np.concatenate([[False], flat[:-1] & (row[1:] == row[:-1])]) if len(flat) else flat
            after = np.concatenate([flat[1:] & (row[1:] == row[:-1]), [False]]) if len(flat) else flat
            first, last = np.flatnonzero(flat & ~before), np.flatnonzero(flat & ~after)
            start = batch.column(2).to_numpy()[row[first]]
            of = batch.select([0, 1]).take(pa.array(row[first]))
            yield pa.RecordBatch.from_arrays([*of.columns, pa.array((start + place[first]).astype(np.int32)), pa.array((start + place[last] + window).astype(np.int32))],
                                             names=["k", "l", "start", "end"])

    return run


# ---------------------------------------------------------------- texts

def kept_words(text: str | None, covered: list[dict] | None) -> tuple[int, int, bytes]:
    """(words, words removed, kept words joined by a blank); ``bytes.split`` cuts at blank and 09-0D."""
    words = (text or "").encode().split()
    if not covered:
        return len(words), 0, b" ".join(words)
    kept, at = [], 0
    for start, end in sorted((c["start"], c["end"]) for c in covered):
        if start > at:
            kept += words[at:start]
        at = max(at, end)
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, digest: bool = False) -> DataFrame:
    """Every row's (id, n_words, n_removed, kept): the text that stays, its words joined by one blank; with ``digest``
    the lowercase hex SHA-256 of its UTF-8 in its place, so that whole texts without repeats need no shuffle."""
    shown = (lambda kept: hashlib.sha256(kept).hexdigest()) if digest else bytes.decode
    found = written(repeated_stretches(docs, id_col, text_col, window), "covered")
    touched = mark_table(found.select("k"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows without repeats are done here; only the others' texts go on to the join."""
        for batch in batches:
            for part in slices(batch, text_col):
                hit = marked(touched, part.column(2).to_numpy().view(np.uint64))
                done = [(None, None) if h else kept_words(t, None)[::2] for h, t in zip(hit.tolist(), part.column(1).to_pylist())]
                texts = pa.array([t if h else None for h, t in zip(hit.tolist(), part.column(1).to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), texts, pa.array([n for n, _ in done], pa.int64()),
                                                  pa.array([k if k is None else shown(k) for _, k in done], pa.string())],
                                                 names=["id", "k", "l", "text", "n_words", "kept"])

    rows = docs.select(id_col, text_col, *row_keys(id_col, text_col)).mapInArrow(whole, f"id {id_type}, k long, l long, text string, n_words long, kept string")
    joined = rows.join(found, ["k", "l"], "left").select("id", "text", "n_words", "kept", "covered")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 200) for i in range(0, batch.num_rows, 200)):
                out = []
                for text, n, kept, covered in zip(*(part.column(i).to_pylist() for i in range(1, 5))):
                    if n is not None:
                        out.append((n, 0, kept))
                    else:
                        n, gone, left = kept_words(text, covered)
                        out.append((n, gone, shown(left)))
                n, gone, kept = zip(*out) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                                 names=["id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(cut, f"id {id_type}, n_words long, n_removed long, kept string")


def op11_repeats(spark, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"), digest=True)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT row, doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50),
h AS (SELECT row, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
g AS (SELECT DISTINCT row, i + unnest(generate_series(0, 49)) AS i FROM h JOIN f USING (h) WHERE first < doc_id),
o AS (SELECT row, doc_id, len(w) AS n, unnest(w) AS w, unnest(generate_series(1, len(w))) AS i FROM d),
k AS (SELECT o.row, count(*) AS kept, string_agg(o.w, ' ' ORDER BY o.i) AS text FROM o ANTI JOIN g ON o.row = g.row AND o.i = g.i GROUP BY o.row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN k USING (row)
"""
