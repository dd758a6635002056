"""Benchmark decontamination: n-gram seeds, weighted by rarity, join passages with test items; Smith-Waterman scores them.

1. The documents that hold each 3-word sequence of the benchmark are counted (per task first).
2. All of an item's sequences that any document holds are its seeds.  Its rarer half of them are rare seeds.
   Seeds and rare seeds are marked in bit tables of bounded size, so documents are searched where they are scanned.
3. Around two seed hits, or one of a rare seed, a passage of the document is cut out, wide enough for the longest
   item; passages that meet become one.  Equal passages of many documents are handled once.
4. Passages and items that share two different seeds, or a rare one of the item, are aligned word by word:
   local alignment with match 2, mismatch and gap -1.  The score is divided by that of a perfect copy, so
   edited and paraphrased copies keep most of it; ``SCORE_LEAST`` or more is a leak.

Words are runs of letters and digits, in lower case.  Null and empty texts have no words and match nothing.  An
item of fewer than three words is found only in a document of exactly these words.  Items of equal words are
one, named by the smallest id (null ids last).  Repeated rows give the same pairs once.  Input columns other
than ids and texts are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creatorlens.llm.common import mark_table, slices, table, written
from creatorlens.llm.words import NON_ALNUM, WordHasher, marked, mix, ngrams, segment_sums

SEED, HITS_LEAST, SCORE_LEAST = 3, 2, 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
CELLS = 1 << 20  # of the alignments computed side by side
_words = WordHasher(NON_ALNUM)


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat))


def item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words, grams): the distinct items' word hashes and sequences."""
    id_type = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for first, end, hashes, offsets in _words.texts(part.column(1)):
                    grams, at = ngrams(hashes, offsets, SEED, whole_if_shorter=True)
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(first, end - first), _lists(hashes, offsets), _lists(grams, at)], names=["item_id", "words", "grams"])

    found = items.select(F.col(id_col), F.lower(text_col).alias("text")).mapInArrow(run, f"item_id {id_type}, words array<long>, grams array<long>")
    place = F.struct(F.col("item_id").isNull().alias("none"), "item_id")
    return (found.filter(F.size("words") > 0).groupBy("words", "grams").agg(F.min(place).alias("least"))
            .select(F.col("least.item_id").alias("item_id"), "words", "grams"))


def _grams(column: pa.Array) -> Iterator[tuple]:
    for first, end, hashes, offsets in _words.texts(column):
        grams, at = ngrams(hashes, offsets, SEED, whole_if_shorter=True)
        yield first, end, hashes, offsets, grams, at


def document_counts(texts: DataFrame, marks: np.ndarray) -> DataFrame:
    """(hash, documents) of the marked sequences, counted per task and then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts, pa.int64())], names=["hash", "documents"])

        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                for _, _, _, _, grams, at in _grams(part.column(0)):
                    hit = np.flatnonzero(marked(marks, grams))
                    own = np.unique(np.stack([np.searchsorted(at, hit, side="right").astype(np.uint64), grams[hit]]), axis=1)[1] if len(hit) else grams[hit]
                    held.append(own)
                    size += len(own)
                    if size > 1 << 20:
                        yield counted()
                        held, size = [], 0
        if held:
            yield counted()

    return texts.mapInArrow(run, "hash long, documents long").groupBy("hash").agg(F.sum("documents").alias("documents"))


def weighted_seeds(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(item_id, hash, weight): each item's sequences that documents hold; one of the rarer half counts for
    ``HITS_LEAST`` hits."""
    grams = items.select("item_id", F.explode(F.array_distinct("grams")).alias("hash"))
    spread = grams.groupBy("hash").agg(F.count("*").alias("items"))
    known = grams.join(spread, "hash").join(counts, "hash").withColumn("often", F.col("documents") * F.col("items"))
    by = Window.partitionBy("item_id")
    ranked = known.select("item_id", "hash", F.row_number().over(by.orderBy("often", "hash")).alias("rank"), F.count("*").over(by).alias("n"))
    return ranked.select("item_id", "hash", F.when(F.col("rank") <= F.ceil(F.col("n") / 2), HITS_LEAST).otherwise(1).alias("weight"))


def passages(docs: DataFrame, marks: np.ndarray, rare: np.ndarray, reach: int) -> DataFrame:
    """(id, start, key, also, words, hits): passages of ``reach`` words around ``HITS_LEAST`` sequences of
    ``marks`` or one of ``rare``."""
    id_type = docs.schema["id"].simpleString().split(":", 1)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                ids = part.column(0)
                for first, _, hashes, offsets, grams, at in _grams(part.column(1)):
                    hit = np.flatnonzero(marked(marks, grams))
                    if not len(hit):
                        continue
                    row = np.searchsorted(at, hit, side="right") - 1
                    place = hit - at[row]  # the sequence's first word within its text
                    new = np.ones(len(hit), bool)
                    new[1:] = (row[1:] != row[:-1]) | (place[1:] - place[:-1] > 2 * reach)
                    starts = np.flatnonzero(new)
                    ends = np.append(starts[1:], len(hit))
                    wide = (ends - starts >= HITS_LEAST) | np.logical_or.reduceat(marked(rare, grams[hit]), starts)
                    starts, ends = starts[wide], ends[wide]
                    if not len(starts):
                        continue
                    text = row[starts]
                    size = (offsets[1:] - offsets[:-1])[text]
                    low = np.maximum(place[starts] - reach, 0)
                    high = np.minimum(place[ends - 1] + SEED + reach, size)
                    words, hits = [], []
                    for t, a, b, x, y in zip(text.tolist(), low.tolist(), high.tolist(), starts.tolist(), ends.tolist()):
                        words.append(hashes[offsets[t] + a:offsets[t] + b])
                        hits.append(np.unique(grams[hit[x:y]]))
                    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
                    flat = np.concatenate(words)
                    rank = (np.arange(len(flat)) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.uint64)
                    with np.errstate(over="ignore"):
                        key = mix(segment_sums(mix(flat + rank * np.uint64(0x9E3779B97F4A7C15)), bounds))
                        also = mix(segment_sums(mix(flat ^ mix(rank)), bounds) + np.diff(bounds).astype(np.uint64))
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(first + text)), pa.array(low), pa.array(key.view(np.int64)), pa.array(also.view(np.int64)), _lists(flat, bounds),
                        _lists(np.concatenate(hits), np.concatenate([[0], np.cumsum([len(h) for h in hits])]))],
                        names=["id", "start", "key", "also", "words", "hits"])

    return docs.select("id", "text").mapInArrow(run, f"id {id_type}, start long, key long, also long, words array<long>, hits array<long>")


# ---------------------------------------------------------------- alignment

def align(items: list[np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Smith-Waterman scores of pairs of word sequences, padded and computed side by side, row by row.

    Within a row a gap in the item only costs ``GAP`` per word, so a running maximum replaces the inner loop.
    """
    count, rows, wide = len(items), max(map(len, items)), max(map(len, texts))
    a, b = np.zeros((count, rows), np.uint64), np.zeros((count, wide), np.uint64)
    real_a, real_b = np.zeros((count, rows), bool), np.zeros((count, wide), bool)
    for i, (x, y) in enumerate(zip(items, texts)):
        a[i, :len(x)], real_a[i, :len(x)] = x, True
        b[i, :len(y)], real_b[i, :len(y)] = y, True
    slope = (-GAP * np.arange(wide + 1)).astype(np.int32)
    last, best = np.zeros((count, wide + 1), np.int32), np.zeros(count, np.int32)
    for i in range(rows):
        same = (a[:, i, None] == b) & real_a[:, i, None] & real_b
        now = np.maximum(last + GAP, 0)
        np.maximum(now[:, 1:], last[:, :-1] + np.where(same, MATCH, MISMATCH).astype(np.int32), out=now[:, 1:])
        last = np.maximum.accumulate(now + slope, axis=1) - slope
        np.maximum(best, last.max(axis=1), out=best)
    return best


def similarity(pairs: DataFrame) -> DataFrame:
    """(item_id, key, also, score) for rows (item_id, item, key, also, words): score over a perfect copy's."""
    id_type = pairs.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            items = [batch.column("item")[i].values.to_numpy() for i in range(rows)]
            texts = [batch.column("words")[i].values.to_numpy() for i in range(rows)]
            cells = np.array([len(x) for x in items]) * np.array([len(y) for y in texts])
            score, order, first = np.zeros(rows), np.argsort(cells, kind="stable"), 0
            while first < rows:  # pairs of like size together
                end = first + 1
                tall, wide = len(items[order[first]]), len(texts[order[first]])
                while end < rows:
                    tall, wide = max(tall, len(items[order[end]])), max(wide, len(texts[order[end]]))
                    if (end + 1 - first) * wide > CELLS // 8 or tall * wide > 4 * cells[order[first]] + 10_000:
                        break
                    end += 1
                some = order[first:end]
                score[some] = align([items[i] for i in some], [texts[i] for i in some]) / [MATCH * len(items[i]) for i in some]
                first = end
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("key"), batch.column("also"), pa.array(score)], names=["item_id", "key", "also", "score"])

    return pairs.select("item_id", "item", "key", "also", "words").mapInArrow(run, f"item_id {id_type}, key long, also long, score double")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", least: float = SCORE_LEAST) -> DataFrame:
    """(id, item_id, score, start): the document's best score with each item that leaks into it, and the first
    word of that passage."""
    known = written(item_words(items, item_col, item_text), "items")
    rows = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("text"))
    grams = known.select(F.explode("grams").alias("hash")).distinct()
    counts = document_counts(rows.select("text"), mark_table(grams))
    seeds = written(weighted_seeds(known, counts), "seeds")
    reach = known.agg(F.max(F.size("words"))).first()[0] or 0
    marks, rare = (mark_table(some.select("hash").distinct()) for some in (seeds, seeds.filter(F.col("weight") == HITS_LEAST)))
    found = written(passages(rows, marks, rare, reach + reach // 2 + 1), "passages")
    own = found.dropDuplicates(["key", "also"])
    hits = own.select("key", "also", F.explode("hits").alias("hash")).join(seeds, "hash")
    pairs = hits.groupBy("key", "also", "item_id").agg(F.sum("weight").alias("weight")).filter(F.col("weight") >= HITS_LEAST).select("key", "also", "item_id")
    both = pairs.join(known.select("item_id", F.col("words").alias("item")), "item_id").join(own.select("key", "also", "words"), ["key", "also"])
    scores = written(similarity(both).filter(F.col("score") >= least), "scores")
    best = found.select("id", "start", "key", "also").join(scores, ["key", "also"])
    return (best.groupBy("id", "item_id").agg(F.max(F.struct("score", -F.col("start"))).alias("best"))
            .select("id", "item_id", "best.score", (-F.col("best.col2")).alias("start")))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without a leak (rows with a null id are never named by one and stay)."""
    bad = leaks(docs, items, id_col, text_col).select(F.col("id").alias("__bad")).distinct()
    return docs.join(bad, F.col(id_col) == F.col("__bad"), "left_anti")


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")
