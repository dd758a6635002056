"""Quality classifier: a factorisation machine over hashed words, structure statistics and text metadata.

score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j).  The pairwise part takes linear time by
the sum-of-squares identity: half the sum over factors of (sum v_if x_i)^2 - sum v_if^2 x_i^2.

Words (split at ASCII signs and blanks, A-Z lower-cased) are hashed into ``BUCKETS`` features with damped,
length-normalised counts; statistics are shares of byte classes, of repeated words and lines, and lengths,
standardised by the training sample.  Only the text is read: no label, language, source or id is an input.

The model is fitted on at most ``TRAIN_MOST`` labelled documents (those with the smallest hash of their id), of
which only features travel; every document is scored where it is scanned.  Null and empty texts have no words
and zero statistics and get a score like any other.  A document's labels are averaged over repeated label rows
(0.5 counts as 1); null labels are left out.  With labels of fewer than two classes every score is their
share, or 1 without labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from creatorlens.llm.common import slices, table
from creatorlens.llm.words import NON_ALNUM, WordHasher, distinct, segment_sums, text_bytes

BUCKETS, FACTORS, TRAIN_MOST = 1 << 14, 8, 4000
SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]


def _byte_classes() -> np.ndarray:
    sets = [range(65, 91), range(97, 123), range(48, 58), SIGNS, [32], [10], [9, 11, 12, 13], range(128, 256),
            [c for c in range(32) if not 9 <= c <= 13], *([c] for c in SIGNS)]
    out = np.zeros((256, len(sets)), np.float32)
    for i, own in enumerate(sets):
        out[list(own), i] = 1
    return out


_CLASSES = _byte_classes()
STATS = _CLASSES.shape[1] + 8
_words, _lines = WordHasher(NON_ALNUM), WordHasher(b"\n")


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, values, offsets, statistics) of a column's texts."""
    data, bounds = text_bytes(column)
    rows = len(bounds) - 1
    stats = np.zeros((rows, STATS), np.float32)
    size = np.maximum(np.diff(bounds), 1)[:, None]
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        stats[i, :-8] = np.bincount(data[a:b], minlength=256) @ _CLASSES
    stats[:, :-8] = np.sqrt(stats[:, :-8] / size)
    buckets, values, offsets = [], [], [np.zeros(1, np.int64)]
    for first, end, hashes, at in _words.texts(column):
        own, own_at, counts = distinct(hashes, at)
        words, kinds = np.maximum(np.diff(at), 1), np.diff(own_at)
        most = np.zeros(end - first)
        full = np.flatnonzero(kinds)
        if len(full):
            most[full] = np.maximum.reduceat(counts, own_at[full])
        x = np.log1p(counts)
        norm = np.sqrt(segment_sums(x * x, own_at))
        buckets.append((own % np.uint64(BUCKETS)).astype(np.int32))
        values.append((x / np.repeat(np.maximum(norm, 1e-9), kinds)).astype(np.float32))
        offsets.append(offsets[-1][-1] + own_at[1:])
        stats[first:end, -8] = kinds / words
        stats[first:end, -7] = most / words
        stats[first:end, -6] = np.log1p(np.diff(at))
        stats[first:end, -5] = np.diff(bounds)[first:end] / words / 10
        stats[first:end, -4] = segment_sums((counts == 1).astype(np.float64), own_at) / words
    for first, end, hashes, at in _lines.texts(column):
        lines = np.diff(at)
        stats[first:end, -3] = np.diff(distinct(hashes, at)[1]) / np.maximum(lines, 1)
        stats[first:end, -2] = np.log1p(lines)
        stats[first:end, -1] = np.log1p(np.diff(bounds)[first:end] / np.maximum(lines, 1))
    stats[np.diff(bounds) == 0] = 0
    empty = lambda kind: np.empty(0, kind)
    return (np.concatenate(buckets or [empty(np.int32)]), np.concatenate(values or [empty(np.float32)]),
            np.concatenate(offsets), stats)


class FactorisationMachine:
    """Weights and factors of the words' buckets (rows) followed by those of the statistics."""

    def __init__(self, seed: int = 1):
        random = np.random.default_rng(seed)
        n = BUCKETS + STATS
        self.bias, self.weight = 0.0, np.zeros(n, np.float32)
        self.factor = random.normal(0, 0.02, (n, FACTORS)).astype(np.float32)
        self.mean, self.scale = np.zeros(STATS, np.float32), np.ones(STATS, np.float32)
        self.constant: float | None = None

    def _join(self, buckets, values, offsets, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words and standardised statistics as one sparse matrix."""
        rows, wide = len(stats), np.arange(STATS)
        sizes = np.diff(offsets)
        at = np.arange(len(buckets)) + np.repeat(np.arange(rows) * STATS, sizes)
        index = np.empty(len(buckets) + rows * STATS, np.int64)
        x = np.empty(len(index), np.float32)
        rest = np.ones(len(index), bool)
        rest[at] = False
        index[at], x[at] = buckets, values
        index[rest] = np.tile(BUCKETS + wide, rows)
        x[rest] = np.clip((stats - self.mean) / self.scale, -4, 4).ravel()
        return index, x, offsets + np.arange(rows + 1) * STATS

    def _raw(self, index, x, offsets) -> tuple[np.ndarray, np.ndarray]:
        v = self.factor[index] * x[:, None]
        sums = segment_sums(v, offsets)
        pairs = 0.5 * ((sums ** 2).sum(1) - segment_sums((v * v).sum(1), offsets))
        return self.bias + segment_sums(self.weight[index] * x, offsets) + pairs, sums

    def score(self, buckets, values, offsets, stats) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(stats), self.constant)
        raw, _ = self._raw(*self._join(buckets, values, offsets, stats))
        return 1 / (1 + np.exp(-np.clip(raw.astype(np.float64), -30, 30)))

    def fit(self, buckets, values, offsets, stats, labels: np.ndarray, epochs: int = 12, batch: int = 128,
            rate: float = 0.05, decay: float = 1e-5, seed: int = 1) -> FactorisationMachine:
        """AdaGrad on the logistic loss, in a seeded order."""
        if len(np.unique(labels)) < 2:
            self.constant = float(labels.mean()) if len(labels) else 1.0
            return self
        self.mean, self.scale = stats.mean(0), np.maximum(stats.std(0), 1e-3)
        index, x, offsets = self._join(buckets, values, offsets, stats)
        random = np.random.default_rng(seed)
        squares_w, squares_v, squares_b = np.full(len(self.weight), 1e-6, np.float32), np.full(self.factor.shape, 1e-6, np.float32), 1e-6
        for _ in range(epochs):
            order = random.permutation(len(labels))
            for rows in (order[i:i + batch] for i in range(0, len(order), batch)):
                sizes = (offsets[1:] - offsets[:-1])[rows]
                at = np.concatenate([[0], np.cumsum(sizes)])
                pick = np.arange(at[-1]) + np.repeat(offsets[:-1][rows] - at[:-1], sizes)
                i, xi = index[pick], x[pick]
                raw, sums = self._raw(i, xi, at)
                error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[rows]).astype(np.float32) / len(rows)
                e = np.repeat(error, sizes) * xi
                own, place = np.unique(i, return_inverse=True)
                by = np.argsort(place, kind="stable")
                edges = np.searchsorted(place[by], np.arange(len(own) + 1))
                grad_w = segment_sums(e[by], edges) + decay * self.weight[own]
                grad_v = segment_sums((e[:, None] * (np.repeat(sums, sizes, axis=0) - self.factor[i] * xi[:, None]))[by], edges) + decay * self.factor[own]
                squares_w[own] += grad_w ** 2
                squares_v[own] += grad_v ** 2
                squares_b += float(error.sum()) ** 2
                self.weight[own] -= rate * grad_w / np.sqrt(squares_w[own])
                self.factor[own] -= 0.3 * rate * grad_v / np.sqrt(squares_v[own])
                self.bias -= rate * float(error.sum()) / squares_b ** 0.5
        return self


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3 (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> FactorisationMachine:
    """Fit on the documents with labels whose fold is not 1, at most ``TRAIN_MOST``."""
    own = (labels.filter((fold(id_col) != 1) & F.col(label_col).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label")))
    sample = own.orderBy(F.xxhash64("id"), "id").limit(TRAIN_MOST)  # so small that it may be broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                buckets, values, offsets, stats = features(part.column("text"))
                ends = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("label"), pa.ListArray.from_arrays(ends, pa.array(buckets)),
                    pa.ListArray.from_arrays(ends, pa.array(values)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(stats) + 1) * STATS, pa.int32()), pa.array(stats.ravel()))],
                    names=["id", "label", "buckets", "values", "stats"])

    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
            .mapInArrow(run, "id long, label int, buckets array<int>, values array<float>, stats array<float>")
            .orderBy(F.xxhash64("id", "buckets"), "id").limit(TRAIN_MOST).toArrow())  # bounded by TRAIN_MOST
    flat = lambda name, kind: rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
    sizes = np.array([len(x) for x in rows.column("buckets")], np.int64)
    return FactorisationMachine().fit(flat("buckets", np.int32), flat("values", np.float32), np.concatenate([[0], np.cumsum(sizes)]),
                                      flat("stats", np.float32).reshape(-1, STATS), rows.column("label").to_numpy())


def scored(docs: DataFrame, model: FactorisationMachine, text_col: str = "text", out: str = "score") -> DataFrame:
    """The documents with a column ``out`` (an input column of that name is replaced)."""
    rows = docs.drop(out)
    schema = StructType([*rows.schema.fields, StructField(out, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                score = pa.array(model.score(*features(part.column(text_col))), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, score], names=[*part.schema.names, out])

    return rows.mapInArrow(run, schema)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(fold("doc_id") == 1, F.lit(True)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
