"""URL filter: rules by host and path, and for the rest a classifier over segmented host and path words.

1. The word counts of all pages' visible texts form a unigram model.  Its ``LEXICON`` most frequent words travel
   with the tasks; all rarer ones are looked up by a join with the pieces of the urls' letter runs (words of more
   than ``PIECE`` letters by their first ``PIECE``).  ``LEXICON`` and ``PIECE`` steer the work, not the result.
2. A Viterbi search splits the letters of host labels and path parts into the likeliest words, whole runs at a time.
3. Multinomial naive Bayes learns from every url that a rule decides and judges the urls that no rule fits;
   words are hashed into ``BUCKETS`` counters per class, so the model has a fixed size.  The part of a url
   that its rule names is left out in learning, or the model would only repeat the rules.

A rule ``host/path`` fits its host and all subdomains, if the url's path starts with the rule's path; the
longest rule wins.  Counts are made per task before they are shuffled; what reaches the driver is bounded by
``LEXICON``, ``BUCKETS`` and the largest Bloom filter (``common.MARK_BITS``).  A null url, or one without ``://``, has
empty host and path.  With no decided url of both classes all others are allowed.  Repeated rows are judged each; other
columns are not read.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creatorlens.llm.common import mark_table, table, written
from creatorlens.llm.words import marked

LEXICON, BUCKETS, PIECE, FLUSH = 20_000, 1 << 16, 24, 100_000
STRETCH, SALTS = 256, 8  # places of a letter run looked at together; parts of a hot url or word
ALLOW, BLOCK = "allow", "block"
RULES = [(ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


# ---------------------------------------------------------------- words

def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, n): the words of A-Z, lower-cased, in the visible texts of all pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
        counts: Counter = Counter()
        for batch in batches:
            for html in batch.column(0):
                text = re.sub(r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ", (html.as_py() or "").lower())
                counts.update(re.findall(r"[a-z]+", text))
                if len(counts) > FLUSH:
                    yield rows()
                    counts.clear()
        yield rows()

    return pages.select(html_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(counts: DataFrame) -> tuple[dict[str, int], int, DataFrame]:
    """The most frequent words with their counts, the sum of all counts, and the rarer words."""
    rows = counts.orderBy(F.desc("n"), "word").limit(LEXICON).collect()  # bounded by LEXICON
    total = counts.agg(F.sum("n")).first()[0] or 0
    rarer = counts.filter(F.lit(False))
    if len(rows) == LEXICON:
        last = rows[-1]
        rarer = counts.filter((F.col("n") < last.n) | ((F.col("n") == last.n) & (F.col("word") > last.word)))
    return {r.word: r.n for r in rows}, total, rarer


def letter_runs(host: str, path: str) -> list[str]:
    """The different letter runs of a host and a path."""
    return list(dict.fromkeys(re.findall(r"[a-z]+", f"{host}/{path.lower()}")))


def rarer_words(places: DataFrame, rarer: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(k, rarer): the words of the table ``rarer`` (word, n) in the letter runs of each place (k, host, path).

    Tasks send the pieces that a Bloom filter of the words' first ``PIECE`` letters lets pass.  It may let others
    pass, and a word of more letters may only start like a piece: a word too many in the list splits nothing else."""
    rarer = rarer.withColumn("piece", F.substring("word", 1, PIECE))
    marks = mark_table(rarer.select(F.xxhash64("piece")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(20_000)
        def likely(text: str, starts: int) -> list[str]:
            found = list({text[i:i + n] for i in range(starts) for n in range(1, min(PIECE, len(text) - i) + 1)} - frequent.keys())
            hashes = np.array([xxhash.xxh64_intdigest(x, 42) for x in found], np.uint64)  # as Spark's xxhash64
            return [found[i] for i in np.flatnonzero(marked(marks, hashes))]

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(pieces, pa.string()), pa.array(most, pa.int64())], names=["k", "piece", "most"])

        keys, pieces, most = [], [], []
        for batch in batches:
            for k, host, path in zip(*(c.to_pylist() for c in batch.columns)):
                runs = letter_runs(host, path)
                longest = max(map(len, runs), default=0)
                for text in runs:
                    for first in range(0, len(text), STRETCH):
                        stretch = text[first:first + STRETCH + PIECE - 1]
                        some = likely(stretch, min(STRETCH, len(stretch)))
                        keys += [k] * len(some)
                        pieces += some
                        most += [longest] * len(some)
                        if len(keys) > FLUSH:
                            yield rows()
                            keys, pieces, most = [], [], []
        yield rows()

    pieces = written(places.mapInArrow(run, "k long, piece string, most long").distinct(), "pieces")
    known = rarer.join(pieces.select("piece").distinct(), "piece", "left_semi")
    known = known.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return (pieces.withColumn("salt", F.pmod("k", F.lit(SALTS)).cast("int")).join(known, ["piece", "salt"])
            .filter(F.length("word") <= F.col("most")).groupBy("k").agg(F.collect_set(F.struct("word", "n")).alias("rarer")))


class Segmenter:
    """Viterbi search for the likeliest split into words under a unigram model of ``total`` words; a stretch of
    letters of any length may be an unknown word."""

    def __init__(self, counts: dict[str, int], total: int):
        self.total = max(total, 1)
        self.cost = {w: self.known(n) for w, n in counts.items()}
        self.lengths = sorted(set(map(len, counts)))
        self.unknown = math.log(self.total) + math.log(10)  # for a first unknown letter; a hundred times less likely for each more
        self.more = 2.0 * math.log(10)
        self.short = lru_cache(100_000)(self._split)

    def known(self, n: int) -> float:
        return math.log(self.total / n)

    def split(self, text: str, rarer: list[dict] | None = None) -> tuple[str, ...]:
        """``rarer``: words beside the model's own with their counts."""
        if rarer:
            return self._split(text, {r["word"]: self.known(r["n"]) for r in rarer})
        return self.short(text) if len(text) <= STRETCH else self._split(text)

    def _split(self, text: str, rarer: dict[str, float] | None = None) -> tuple[str, ...]:
        cost, lengths = self.cost, self.lengths
        if rarer:
            lengths = sorted({*lengths, *map(len, rarer)})
        best, back, stretch, begin = [0.0], [0], math.inf, 0
        for end in range(1, len(text) + 1):
            stretch += self.more
            if best[-1] + self.unknown < stretch:
                stretch, begin = best[-1] + self.unknown, end - 1
            least = stretch, begin
            for n in lengths:
                if n > end:
                    break
                word = text[end - n:end]
                price = cost.get(word)
                if price is None and rarer:
                    price = rarer.get(word)
                if price is not None:
                    least = min(least, (best[end - n] + price, end - n))
            best.append(least[0])
            back.append(least[1])
        out, end = [], len(text)
        while end:
            out.append(text[back[end]:end])
            end = back[end]
        return tuple(reversed(out))


def tokens(host: str, path: str, split) -> list[str]:
    """Words of the host (its last label apart) and of the path; numbers by their length."""
    *labels, last = host.split(".")
    out = [f"t:{last}"] if last else []
    for mark, text in [*(("h", label) for label in labels), ("p", path.lower())]:
        for run in re.findall(r"[a-z]+|[0-9]+|[^\x00-\x7f]+", text):
            if run[0].isdigit():
                out.append(f"{mark}:#{len(run)}")
            else:
                out.extend(f"{mark}:{w}" for w in split(run))
    return out


def bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % BUCKETS


def beside_rule(host: Column, path: Column, rule: Column) -> tuple[Column, Column]:
    """Host and path without what the rule names."""
    name = F.substring_index(rule, "/", 1)
    start = F.length(rule) - F.length(name)
    return (F.substr(host, F.lit(1), F.greatest(F.length(host) - F.length(name) - 1, F.lit(0))), F.substr(path, start + 1))


def train(decided: DataFrame, counts: dict[str, int], total: int) -> np.ndarray | None:
    """Log-odds of block against allow: one per bucket, and at the end that of the classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, sums = Segmenter(counts, total).split, np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for host, path, verdict, rarer in zip(*(c.to_pylist() for c in batch.columns)):
                own = [bucket(t) for t in tokens(host, path, partial(split, rarer=rarer))]
                np.add.at(sums[int(verdict == BLOCK)], [*own, BUCKETS], 1)
        at = np.flatnonzero(sums.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], names=["at", "allow", "block"])

    rows = (decided.select(*beside_rule(F.col("host"), F.col("path"), F.col("rule")), "verdict", "rarer").mapInArrow(run, "at long, allow long, block long")
            .groupBy("at").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).collect())  # at most BUCKETS + 1
    sums = np.zeros((2, BUCKETS + 1))
    for r in rows:
        sums[:, r["at"]] = r["allow"], r["block"]
    if not sums[:, -1].all():
        return None
    words = sums[:, :-1] + 1
    share = np.log(words / words.sum(1, keepdims=True))
    return np.append(share[1] - share[0], math.log(sums[1, -1] / sums[0, -1]))


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict, words, odds) of every row; odds: the log-odds for block (null under a rule)."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumns({"by": rule_of(F.col("host"), F.col("path"), rules), "k": F.xxhash64("host", "path")})
    rows = rows.select("id", "host", "path", "by.rule", "by.verdict", "k")
    counts, total, rarer = lexicon(written(word_counts(pages, html_col), "words"))
    found = rarer_words(rows.select("k", "host", "path").distinct(), rarer, counts)
    # a url that many rows repeat meets its words in SALTS parts
    found = found.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    rows = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    rows = written(rows.join(found, ["k", "salt"], "left").select("id", "host", "path", "rule", "verdict", "rarer"), "urls")
    odds = train(rows.filter(F.col("verdict").isNotNull()), counts, total)
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Segmenter(counts, total).split
        for batch in batches:
            hosts, paths, verdicts, lists = (batch.column(c).to_pylist() for c in ("host", "path", "verdict", "rarer"))
            words, scores, out = [], [], []
            for host, path, verdict, rarer in zip(hosts, paths, verdicts, lists):
                own = tokens(host, path, partial(split, rarer=rarer))
                score = None
                if verdict is None:
                    score = 0.0 if odds is None else float(odds[-1] + odds[[bucket(t) for t in own]].sum()) if own else float(odds[-1])
                    verdict = BLOCK if score > 0 else ALLOW
                words.append(own)
                scores.append(score)
                out.append(verdict)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out), pa.array(words, pa.list_(pa.string())), pa.array(scores, pa.float64())],
                                             names=["id", "host", "path", "rule", "verdict", "words", "odds"])

    return rows.mapInArrow(run, f"id {id_type}, host string, path string, rule string, verdict string, words array<string>, odds double")


def op1_urls(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id").select("page_id", "host", "path", "rule", "verdict", "odds")
