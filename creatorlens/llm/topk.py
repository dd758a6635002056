"""Exact top-k search by inner product with a pivot table (elimination by precomputed distances).

Every vector carries its distances to ``PIVOTS`` pivots.  For a query q, a candidate x and any pivot p the
triangle inequality gives d(q, x) >= |d(q, p) - d(x, p)|, and with the norms the greatest of these lower
bounds gives an upper bound of the score: q.x <= (|q|^2 + |x|^2 - lower^2) / 2.  Each query evaluates the
candidates with its ``STEP`` highest bounds, then those whose bounds still reach its k-th best score: in the order
of its bounds, ``STEP`` at a time, or, where the queries of a tile leave mostly the same ones, all by one matrix
product.  No other candidate can be among the k best, so the result is exact.  ``evaluated`` is how many
candidates a query's bounds left to be scored.

Queries and candidates meet in blocks (a stated query set against all rows): block sizes are bounded, copies
of one vector spread over the blocks by a hash of their id, and each block hands on k rows per query at most.
The pivots, and the seeds whose scores start every query's k-th best, come from a bounded sample of ``SAMPLE``
rows (those with the smallest hash); they steer the work and never the result.  A pivot is chosen for what it
adds to the greatest lower bounds of ``PAIRS`` pairs of sample rows.

Components are floor(64 * x).  Vectors that are null or hold null or non-finite components take no part; a
shorter vector counts as padded with zeros.  A query row is compared with all rows of other ids; repeated rows
count as candidates each, equal query rows are asked once; null ids are candidates that lose all ties, never
queries.  Scores beyond a long are cut to its limits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creatorlens.llm.common import table, written

PIVOTS, SAMPLE, PAIRS = 512, 2000, 2048
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 4096
TILE, STEP = 16, 256
SHARED = 4  # a tile is scored by one product if its queries leave at least 1 / SHARED of that product open
SCALE = 64


def integer_rows(lists: pa.Array, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integer-valued components (as doubles, end to end), row offsets, and which rows may take part."""
    lists = lists.cast(pa.list_(pa.float64()))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    good = flat.is_valid().to_numpy(zero_copy_only=False)
    values = np.floor(flat.fill_null(0.0).to_numpy(zero_copy_only=False) * scale)
    good &= np.isfinite(values)
    offsets = offsets - offsets[0]
    bad = np.concatenate([[0], np.cumsum(~good)])[offsets]
    return values, offsets, lists.is_valid().to_numpy(zero_copy_only=False) & (np.diff(bad) == 0)


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>): the vectors that take part, as integer-valued components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets, good = integer_rows(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "v"]).filter(pa.array(good))

    return vectors.select(F.col(id_col).cast("long"), vector_col).mapInArrow(run, "id long, v array<double>")


def dense(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Sample rows with the most pruning power: each adds the most to the sum, over ``PAIRS`` pairs of sample
    rows, of the greatest lower bound that the pivots chosen before give."""
    if len(sample) < 2:
        return sample
    at = np.random.default_rng(5).integers(0, len(sample), (2, PAIRS))
    near = pivot_distances(sample, sample).astype(np.float32)
    gain = np.abs(near[at[0]] - near[at[1]]).T.copy()  # pivot x pair
    chosen, lower = [], np.zeros(PAIRS, np.float32)
    while len(chosen) < min(count, len(sample)):
        i = int(np.maximum(gain, lower).sum(1).argmax())
        better = np.maximum(gain[i], lower)
        if not (better > lower).any():
            break
        chosen.append(i)
        lower = better
    return sample[chosen or [0]]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x ** 2).sum(1)[:, None] + (pivots ** 2).sum(1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integer-valued doubles: exact, in doubles where no sum can pass 2**53, else in integers."""
    if not a.size or not b.size or np.sqrt((a ** 2).sum(1).max()) * np.sqrt((b ** 2).sum(1).max()) < 2.0 ** 52:
        return a @ b.T
    whole = lambda m: np.array([[int(v) for v in r] for r in m], object)
    return whole(a) @ whole(b).T


class Eliminator:
    """The k best of one block of candidates for a block of queries."""

    def __init__(self, ids: pa.Array, x: np.ndarray, table_: np.ndarray, k: int):
        self.null, self.ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(2**63 - 1).to_numpy()
        self.x, self.near, self.k = x, np.ascontiguousarray(table_.T, np.float32), k
        self.square = (x ** 2).sum(1)
        self.unit = self.whole = None

    def _in_units(self, unit: float) -> np.ndarray:
        if self.unit != unit:
            self.unit, self.whole = unit, (self.near / unit).astype(np.int16)
        return self.whole

    def bounds(self, q: np.ndarray, table_: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of a tile of queries (rows) with all candidates."""
        most = max(table_.max(initial=0), self.near.max(initial=0))
        unit = max(float(most) / 32000, 1e-300)  # distances in 16 bits: a gap of whole units is at most one too large
        asked, near = (table_ / unit).astype(np.int16), self._in_units(unit)
        lower, gap = np.zeros((2, len(q), len(self.x)), np.int16)
        for p in range(table_.shape[1]):
            np.subtract(asked[:, p, None], near[p], out=gap)
            np.abs(gap, out=gap)
            np.maximum(lower, gap, out=lower)
        lower = np.maximum((lower - 1.0) * unit - (1e-5 * float(most) + 1e-3), 0)
        bound = ((q ** 2).sum(1)[:, None] + self.square - lower ** 2) / 2
        return bound + 1 + 1e-9 * np.abs(bound)

    def search(self, own: np.ndarray, q: np.ndarray, table_: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, candidate, score) and each query's number of evaluated candidates, for a tile of queries with ids
        ``own``; ``least``: a score that each query's k-th best is known to reach."""
        bounds, counts = self.bounds(q, table_), np.zeros(len(q), np.int64)
        bounds[(self.ids == own[:, None]) & ~self.null] = -np.inf  # not its own rows
        best = [float(s) for s in least]
        found = [(np.empty(0, np.int64), np.empty(0))] * len(q)

        def score(i: int, some: np.ndarray, scores: np.ndarray) -> None:
            counts[i] += len(some)
            keep = scores >= best[i]
            at, all_ = np.concatenate([found[i][0], some[keep]]), np.concatenate([found[i][1], scores[keep]])
            order = np.lexsort((self.ids[at], self.null[at], -all_))[:self.k]
            found[i] = at[order], all_[order]
            if len(order) == self.k:
                best[i] = max(best[i], float(all_[order[-1]]))

        open_ = (bounds >= least[:, None]) & (bounds > -np.inf)
        for i, bound in enumerate(bounds):  # the highest bounds first: their scores raise what the others must reach
            some = np.argpartition(-bound, STEP - 1)[:STEP] if len(bound) > STEP else np.arange(len(bound))
            some = some[open_[i, some]]
            if len(some):
                score(i, some, products(q[i:i + 1], self.x[some])[0])
            open_[i, some] = False
            open_[i] &= bound >= best[i]
        union = np.flatnonzero(open_.any(0))
        if open_.sum() * SHARED >= len(q) * len(union):  # most queries of the tile need the same candidates: one product
            together = products(q, self.x[union])
            for i in np.flatnonzero(open_.any(1)):
                own_ = open_[i, union]
                score(i, union[own_], together[i, own_])
        else:
            for i in np.flatnonzero(open_.any(1)):
                order = np.flatnonzero(open_[i])
                order = order[np.argsort(-bounds[i, order], kind="stable")]
                for first in range(0, len(order), STEP):
                    some = order[first:first + STEP]
                    some = some[bounds[i, some] >= best[i]]
                    if not len(some):
                        break
                    score(i, some, products(q[i:i + 1], self.x[some])[0])
        out = [(np.full(len(at), i), at, scores) for i, (at, scores) in enumerate(found)]
        whole = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return (*whole, counts)


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score, evaluated): each query row's k highest scores, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    rows = written(integer_vectors(vectors, id_col, vector_col), "vectors")
    mixed = F.xxhash64("id", F.lit(7))
    n, width, asked = rows.agg(F.count("*"), F.max(F.size("v")), F.count_if(is_query)).first()
    if not n or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long, evaluated long")
    sample = rows.orderBy(mixed, "id", "v").limit(SAMPLE).collect()  # bounded by SAMPLE
    seeds, seed_ids = dense([r.v for r in sample], width), np.array([-1 if r.id is None else r.id for r in sample], np.int64)
    pivots = choose_pivots(seeds, PIVOTS)

    def with_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = dense(batch.column("v").to_pylist(), width)
            flat = pivot_distances(x, pivots).astype(np.float32)
            lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists(x), lists(flat)], names=["id", "v", "near"])

    tabled = rows.mapInArrow(with_table, "id long, v array<double>, near array<float>")
    query_blocks, blocks = math.ceil(asked / QUERY_BLOCK), math.ceil(n / CANDIDATE_BLOCK)
    place = F.xxhash64("id", "v", F.lit(11))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    # own names for the candidates: both sides come from one plan, and with equal names a later drop() lost their columns
    candidates = (tabled.select(F.col("id").alias("vec"), F.col("v").alias("x"), F.col("near").alias("far"),
                                F.pmod(place, F.lit(blocks)).cast("int").alias("b")).withColumn("a", every(query_blocks)))
    queries = (tabled.filter(is_query).dropDuplicates(["id", "v"])
               .withColumn("a", F.pmod(place, F.lit(query_blocks)).cast("int")).withColumn("b", every(blocks)))

    def matrix(column) -> np.ndarray:
        flat = column.combine_chunks()
        return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)

    schema = pa.schema([("query_id", pa.int64()), ("asked", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("evaluated", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        block = Eliminator(right.column("vec").combine_chunks(), matrix(right.column("x")), matrix(right.column("far")), k)
        own, q, near = left.column("id").to_numpy(), matrix(left.column("v")), matrix(left.column("near"))
        asked_ = left.column("asked").to_numpy()
        out = []
        for first in range(0, len(own), TILE):
            tile = np.arange(first, min(first + TILE, len(own)))
            least = np.full(len(tile), -np.inf)
            if len(seeds) > k:
                score = products(q[tile], seeds).astype(np.float64)
                score[seed_ids == own[tile][:, None]] = -np.inf  # a null id's seed may be left out too
                least = np.partition(score, len(seeds) - k, axis=1)[:, len(seeds) - k]
                least = least - np.abs(least) * 1e-12
            i, j, score, counts = block.search(own[tile], q[tile], near[tile], least)
            limit = 2**63 - 1
            whole = [max(min(int(s), limit), -limit - 1) for s in score] if score.dtype == object else np.clip(score, -limit, limit).astype(np.int64)
            out.append(pa.table([pa.array(own[tile][i]), pa.array(asked_[tile][i]), right.column("vec").take(pa.array(j)).combine_chunks(),
                                 pa.array(whole, pa.int64()), pa.nulls(len(i), pa.int64())], schema=schema))
            out.append(pa.table([pa.array(own[tile]), pa.array(asked_[tile]), pa.nulls(len(tile), pa.int64()), pa.nulls(len(tile), pa.int64()),
                                 pa.array(counts)], schema=schema))  # a row per query and block that counts
        return pa.concat_tables(out)

    queries = queries.withColumn("asked", F.xxhash64("id", "v"))
    best = queries.groupBy("a", "b").cogroup(candidates.groupBy("a", "b")).applyInArrow(
        search, "query_id long, asked long, vec_id long, score long, evaluated long")
    one = Window.partitionBy("query_id", "asked")
    order = one.orderBy(F.desc_nulls_last("score"), F.asc_nulls_last("vec_id"))
    return (best.withColumn("rank", F.row_number().over(order)).withColumn("total", F.sum("evaluated").over(one))
            .filter((F.col("rank") <= k) & F.col("score").isNotNull())
            .select("query_id", "rank", "vec_id", "score", F.col("total").alias("evaluated")))


def op2_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20).drop("evaluated")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""
