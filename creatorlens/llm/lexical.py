"""Ranked lexical search by pair-bound MaxScore.

Documents are indexed in *shards* of bounded size; a shard's postings hold, for every term that some query may hold
(a bit table of bounded size lets few others in), its documents and counts.  Queries are taken in blocks of bounded
size.  For a block the impacts of its terms are computed once and written with the *term-pair intersection lists*: for
pairs of the heaviest terms of a query, the documents of the shard that hold both, and their greatest joint impact.

A query in a shard (all of it exact, in 64-bit integers):

1. Terms are matched into pairs, greatest saving first.  A pair's bound is the greatest of its joint impact and the
   two single maxima, for a document holds both terms or one; that is often far below the sum of the two maxima.
   Terms stand in ascending order of their maxima; the bound of the first i is the sum of their maxima less the
   savings of the pairs among them, never more than without pairs.
2. The threshold is the score of the k-th best document known: from the shards searched first, and from the
   documents of the query's own intersection lists, which are scored first.
3. The longest run of first terms whose bound stays below the threshold is skipped: a document that holds no other
   term cannot enter the ranking, so only documents of the others are candidates.
4. The skipped terms are added in descending order, to candidates whose score can still reach the threshold with the
   bound of those left.

Only scores strictly below the threshold are given up, so ties are decided by the document's id.  Each shard hands
on at most k documents a query.

Terms are maximal runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased, told apart by 64
bits of their hashes; null texts have none.  A document is a row: rows with equal ids are ranked each; null ids come
last among equal scores.  Items equal in id and text are one query; items without terms find nothing.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creatorlens.llm.common import mark_table, row_keys, slices, table, written
from creatorlens.llm.words import NON_ALNUM, WordHasher, marked

TOP = 20
SHARD_DOCS, SHARD_BYTES = 1 << 14, 1 << 25  # documents and bytes of text of a shard
BLOCK_TERMS = 1 << 18  # terms of the queries searched at a time, about
HEAVY = 12  # heaviest terms of a query whose pairs have intersection lists
FIRST = 8  # one in so many shards is searched first, for thresholds
_terms = WordHasher(NON_ALNUM)


# ---------------------------------------------------------------- index

def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k, l, item, terms, times): the distinct terms of each query and how often it holds them."""
    id_type = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for first, end, hashes, offsets in _terms.texts(batch.column(1)):
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    terms, times = np.unique(hashes[a:b], return_counts=True)
                    rows.append((terms.view(np.int64).tolist(), times.tolist()))
            terms, times = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), batch.column(0), pa.array(terms, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                                             names=["k", "l", "item", "terms", "times"])

    rows = items.select(id_col, text_col, *row_keys(id_col, text_col)).mapInArrow(run, f"k long, l long, item {id_type}, terms array<long>, times array<long>")
    return rows.dropDuplicates(["k", "l"])


def shards(docs: DataFrame, id_col: str, text_col: str, wanted: np.ndarray) -> DataFrame:
    """(ids, sizes, terms, starts, docs, counts, total, filled): one row a shard.  ``ids`` ascend (nulls last), a posting
    names documents by their place; ``sizes`` are all terms of each document, ``total`` their sum, ``filled`` the
    documents with terms."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def shard(parts: list[tuple]) -> pa.RecordBatch:
        ids = pa.concat_arrays([p[0] for p in parts])
        sizes = np.concatenate([p[1] for p in parts])
        base = np.cumsum([0, *(len(p[1]) for p in parts)])
        order = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        doc = place[np.concatenate([p[2] + b for p, b in zip(parts, base)])]
        term, count = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts])
        by = np.lexsort((doc, term))
        doc, term, count = doc[by], term[by], count[by]
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.empty(0, np.int64)
        blob = lambda x, t: pa.array([np.ascontiguousarray(x, t).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))), blob(sizes[order], np.int64), blob(term[first], np.uint64),
            blob(np.append(first, len(term)), np.int32), blob(doc, np.int32), blob(count, np.int32), pa.array([int(sizes.sum())], pa.int64()), pa.array([int((sizes > 0).sum())], pa.int64())],
            names=["ids", "sizes", "terms", "starts", "docs", "counts", "total", "filled"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401  (used as pa.compute)
        held, n, size = [], 0, 0
        for batch in batches:
            for part in slices(batch, text_col):
                for first, end, hashes, offsets in _terms.texts(part.column(1)):
                    rows = end - first
                    some = np.flatnonzero(marked(wanted, hashes))
                    doc, term = np.searchsorted(offsets, some, side="right") - 1, hashes[some]
                    by = np.lexsort((term, doc))
                    doc, term = doc[by], term[by]
                    at = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])])) if len(term) else np.empty(0, np.int64)
                    held.append((part.column(0).slice(first, rows), np.diff(offsets), doc[at], term[at], np.diff(np.append(at, len(term)))))
                    n += rows
                    size += 24 * len(at) + 8 * len(hashes)
                    if n >= SHARD_DOCS or size >= SHARD_BYTES:
                        yield shard(held)
                        held, n, size = [], 0, 0
        if held:
            yield shard(held)

    return docs.select(id_col, text_col).mapInArrow(
        run, f"ids array<{id_type}>, sizes binary, terms binary, starts binary, docs binary, counts binary, total long, filled long")


def document_frequencies(index: DataFrame) -> DataFrame:
    """(term, df) over all shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, starts in zip(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms.as_buffer(), np.int64)), pa.array(np.diff(np.frombuffer(starts.as_buffer(), np.int32)).astype(np.int64))], names=["term", "df"])

    return index.select("terms", "starts").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


# ---------------------------------------------------------------- queries

class Queries:
    """A block of queries: ``terms`` (ascending), their ``weights``, and for each query its (places of) terms, how often
    it holds each, and the pairs of its heaviest terms."""

    def __init__(self, rows: list[tuple[list[int], list[int]]], df: dict[int, int], n: int, heavy: int = HEAVY):
        self.terms = np.unique(np.array([t for terms, _ in rows for t in terms if t in df], np.int64).view(np.uint64))
        self.weights = np.array([weight(n, df[t]) for t in self.terms.view(np.int64).tolist()], np.int64)
        place = {t: i for i, t in enumerate(self.terms.view(np.int64).tolist())}
        self.queries = []
        pairs = set()
        for terms, times in rows:
            own = [(place[t], c) for t, c in zip(terms, times) if t in place and self.weights[place[t]] > 0]
            top = sorted(i for i, _ in sorted(own, key=lambda x: (-self.weights[x[0]] * x[1], x[0]))[:heavy])
            mine = list(itertools.combinations(top, 2))
            pairs.update(mine)
            self.queries.append((np.array([i for i, _ in own], np.int64), np.array([c for _, c in own], np.int64), mine))
        self.pairs = sorted(pairs)
        number = {p: i for i, p in enumerate(self.pairs)}
        self.queries = [(t, c, [number[p] for p in mine]) for t, c, mine in self.queries]


IMPACTS = "ids array<{}>, present binary, starts binary, docs binary, impacts binary, joint binary, pair_starts binary, pair_docs binary"


def impact_lists(index: DataFrame, block: Queries, n: int, total: int, id_type: str) -> DataFrame:
    """The block's part of each shard: postings with impacts, and the pairs' intersection lists with joint maxima."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lambda x, t: np.frombuffer(x.as_buffer(), t)
        blob = lambda x, t: pa.array([np.ascontiguousarray(x, t).tobytes()], pa.binary())
        for batch in batches:
            for row in range(batch.num_rows):
                ids, sizes, terms, starts, docs, counts = (batch.column(i)[row] for i in range(6))
                sizes, terms, starts = read(sizes, np.int64), read(terms, np.uint64), read(starts, np.int32)
                docs, counts = read(docs, np.int32), read(counts, np.int32)
                at = np.searchsorted(terms, block.terms)
                at[at == len(terms)] = 0
                have = np.flatnonzero(terms[at] == block.terms) if len(terms) else np.empty(0, np.int64)
                norm = 100 - 25 + (25 * sizes * n) // total if total else sizes
                lists, impacts = [], []
                for i, t in zip(have.tolist(), at[have].tolist()):
                    doc, tf = docs[starts[t]:starts[t + 1]], counts[starts[t]:starts[t + 1]].astype(np.int64)
                    lists.append(doc)
                    impacts.append(block.weights[i] * ((1_000_000_000 * tf) // (1000 * tf + 12 * norm[doc])))
                number = np.full(len(block.terms), -1)
                number[have] = np.arange(len(have))
                joint, meet = np.zeros(len(block.pairs), np.int64), []
                for p, (x, y) in enumerate(block.pairs):
                    x, y = number[x], number[y]
                    if x < 0 or y < 0:
                        meet.append(np.empty(0, np.int32))
                        continue
                    if len(lists[x]) > len(lists[y]):
                        x, y = y, x
                    place = np.searchsorted(lists[y], lists[x])
                    place[place == len(lists[y])] = 0
                    both = np.flatnonzero(lists[y][place] == lists[x])
                    meet.append(lists[x][both])
                    if len(both):
                        joint[p] = (impacts[x][both] + impacts[y][place[both]]).max()
                flat = lambda xs, t: np.concatenate(xs) if xs else np.empty(0, t)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, 1), blob(have, np.int32), blob(np.cumsum([0, *map(len, lists)]), np.int64), blob(flat(lists, np.int32), np.int32), blob(flat(impacts, np.int64), np.int64),
                    blob(joint, np.int64), blob(np.cumsum([0, *map(len, meet)]), np.int64), blob(flat(meet, np.int32), np.int32)],
                    names=["ids", "present", "starts", "docs", "impacts", "joint", "pair_starts", "pair_docs"])

    return index.select("ids", "sizes", "terms", "starts", "docs", "counts").mapInArrow(run, IMPACTS.format(id_type))


class Shard:
    """One shard's lists for a block of queries."""

    def __init__(self, block: Queries, size: int, present, starts, docs, impacts, joint, pair_starts, pair_docs):
        self.block, self.size, self.joint, self.pair_starts, self.pair_docs = block, size, joint, pair_starts, pair_docs
        self.lists = {t: (docs[a:b], impacts[a:b]) for t, a, b in zip(present.tolist(), starts[:-1].tolist(), starts[1:].tolist())}
        self.most = {t: int(x.max()) for t, (_, x) in self.lists.items()}
        self.evaluated = 0  # documents whose scores were begun

    def add(self, score: np.ndarray, docs: np.ndarray, term: int, times: int) -> np.ndarray:
        """``score`` of ``docs`` (ascending) with the term's impacts."""
        own, impacts = self.lists[term]
        place = np.searchsorted(own, docs)
        place[place == len(own)] = 0
        return score + np.where(own[place] == docs, impacts[place] * times, 0)

    def bounds(self, query: int, use_pairs: bool = True) -> tuple[list[tuple[int, int]], list[int]]:
        """The query's (term, times) in ascending order of their maxima, and for each prefix of them the bound of a
        document that holds terms of the prefix only: the maxima's sum less what the pairs inside the prefix save."""
        terms, times, pairs = self.block.queries[query]
        times = {t: c for t, c in zip(terms.tolist(), times.tolist()) if t in self.lists}
        bound = {t: self.most[t] * c for t, c in times.items()}
        order = sorted(bound, key=lambda t: (bound[t], t))
        place = {t: i for i, t in enumerate(order)}
        savings = []
        for p in pairs if use_pairs else ():
            x, y = self.block.pairs[p]
            if x in bound and y in bound:
                c, both = min(times[x], times[y]), 0
                if self.joint[p]:  # a document of both terms: the common times of the pair, and what one has more
                    both = c * int(self.joint[p]) + (times[x] - c) * self.most[x] + (times[y] - c) * self.most[y]
                savings.append((bound[x] + bound[y] - max(both, bound[x], bound[y]), x, y))
        saved, free = [0] * len(order), set(order)
        for saving, x, y in sorted(savings, reverse=True):
            if saving > 0 and x in free and y in free:
                free -= {x, y}
                saved[max(place[x], place[y])] = saving
        reach = list(itertools.accumulate(bound[t] - s for t, s in zip(order, saved)))
        return [(t, times[t]) for t in order], reach

    def seeds(self, query: int, k: int) -> np.ndarray:
        """Documents of the query's intersection lists, greatest joint impact first, until there are ``k``."""
        pairs = sorted((p for p in self.block.queries[query][2] if self.joint[p]), key=lambda p: -self.joint[p])
        found = np.empty(0, np.int32)
        for p in pairs[:8]:
            found = np.union1d(found, self.pair_docs[self.pair_starts[p]:self.pair_starts[p + 1]])
            if len(found) >= k:
                break
        return found

    def search(self, query: int, k: int = TOP, least: int = 1, use_pairs: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the query's ``k`` best with ``least`` or more, ties to smaller places."""
        terms, reach = self.bounds(query, use_pairs)
        least = max(least, 1)
        if not terms:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if len(first := self.seeds(query, k)) >= k:
            score = np.zeros(len(first), np.int64)
            for t, c in terms:
                score = self.add(score, first, t, c)
            least = max(least, int(np.partition(score, -k)[-k]))
        skip = sum(r < least for r in reach)
        acc = np.zeros(self.size, np.int64)
        for t, c in terms[skip:]:
            docs, impacts = self.lists[t]
            acc[docs] += impacts * c
        docs = np.flatnonzero(acc)
        score = acc[docs]
        self.evaluated += len(docs)
        for i in range(skip - 1, -1, -1):
            if len(docs) > k:  # impacts only add up: the k-th score so far bounds the last one from below
                least = max(least, int(np.partition(score, -k)[-k]))
            stay = score + reach[i] >= least
            docs, score = docs[stay], score[stay]
            score = self.add(score, docs, *terms[i])
        stay = score >= least
        docs, score = docs[stay], score[stay]
        best = np.lexsort((docs, -score))[:k]
        return docs[best], score[best]


def _search(lists: DataFrame, block: Queries, keys: list[tuple], least: list[int], k: int, id_type: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (np.int32, np.int64, np.int32, np.int64, np.int64, np.int64, np.int32)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column(0)[row].values
                shard = Shard(block, len(ids), *(np.frombuffer(batch.column(i + 1)[row].as_buffer(), t) for i, t in enumerate(kinds)))
                query, place, scores = [], [], []
                for q in range(len(block.queries)):
                    docs, score = shard.search(q, k, least[q])
                    query.append(np.full(len(docs), q))
                    place.append(docs)
                    scores.append(score)
                query, place, scores = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (query, place, scores))
                key = np.array(keys, np.int64).reshape(-1, 2)[query]
                yield pa.RecordBatch.from_arrays([pa.array(key[:, 0]), pa.array(key[:, 1]), ids.take(pa.array(place, pa.int64())), pa.array(scores)], names=["k", "l", "id", "score"])

    return lists.mapInArrow(run, f"k long, l long, id {id_type}, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("k", "l").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked(items: DataFrame, docs: DataFrame, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text", k: int = TOP) -> DataFrame:
    """(item, rank, id, score): each item's ``k`` best documents."""
    id_type = docs.schema[id_col].dataType.simpleString()
    queries = written(query_terms(items, item_col, text_col), "queries")
    terms = queries.select(F.explode("terms").alias("term"))
    wanted = mark_table(terms.distinct())
    index = written(shards(docs, id_col, text_col, wanted), "shards")
    frequency = written(document_frequencies(index).join(terms.distinct(), "term", "left_semi"), "document-frequencies")
    n, total = index.agg(F.coalesce(F.sum("filled"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    blocks = -(-(queries.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS)
    found = None
    for number in range(blocks):  # each holds about BLOCK_TERMS terms, however many items there are
        own = queries.filter(F.pmod(F.xxhash64("k", "l"), F.lit(blocks)) == number)
        rows = own.select("k", "l", "terms", "times").orderBy("k", "l").collect()
        df = {r.term: r.df for r in frequency.join(own.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi").collect()}
        block, keys = Queries([(r.terms, r.times) for r in rows], df, n), [(r.k, r.l) for r in rows]
        lists = written(impact_lists(index, block, n, total, id_type).withColumn("first", F.pmod(F.xxhash64("present", "starts"), F.lit(FIRST)) == 0), "impact-lists")
        start = written(_search(lists.filter("first").drop("first"), block, keys, [1] * len(keys), k, id_type), "found-first")
        kth = {(r.k, r.l): r.score for r in _best(start, k).filter(F.col("rank") == k).select("k", "l", "score").collect()}  # one a query at most
        rest = _search(lists.filter(~F.col("first")).drop("first"), block, keys, [kth.get(key, 1) for key in keys], k, id_type)
        both = written(start.unionByName(rest), "found")
        found = both if found is None else found.unionByName(both)
    named = queries.select("k", "l", "item")
    if found is None:
        return named.select("item", F.lit(1).alias("rank"), F.lit(None).cast(id_type).alias("id"), F.lit(0).cast("long").alias("score")).limit(0)
    return _best(found, k).join(named, ["k", "l"]).select("item", F.col("rank").cast("int").alias("rank"), "id", "score")


def op12_search(spark, sf_dir: str) -> DataFrame:
    return (ranked(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))
            .select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS t FROM documents),
s AS (SELECT count(*) FILTER (len(t) > 0) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d),
m AS (SELECT row, doc_id, 100 - 25 + ((25 * len(t) * s.n) // s.l) AS m FROM d, s WHERE len(t) > 0),
p AS (SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(t) AS t FROM d) GROUP BY row, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(s.n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY t),
q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY item_id, t),
z AS (SELECT item_id, row, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (t) JOIN p USING (t) JOIN m USING (row) GROUP BY item_id, row, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM z WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""
