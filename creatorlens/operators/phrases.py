"""Multi-word lexicon entries in token lists (T3 / J4 in intent mode, and the hits that T6 folds over).

The lexicon is a table of any size, and nothing of it is collected but a bounded filter: tasks hash every run of up to
``longest`` tokens over Arrow batches and hand on those that the filter lets pass, which are all that can match and few
others.  These are joined with the lexicon by equality; which side travels is left to Spark's size statistics.  A
text's hits come back as one sorted array, longest first at each place, and a fold walks over them from left to right:
a hit that starts inside the one taken before is passed over.  The arrays are as long as their text at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from creatorlens.functions.text import keep_letters, remove_mentions, remove_urls, tokens
from creatorlens.llm.common import mark_table, written
from creatorlens.llm.words import WordHasher, marked, ngrams
from creatorlens.session import literal_frame

LONGEST = 4
_words = WordHasher(b" ", lower_case=False)


def cased_tokens(text) -> Column:
    """Tokens of the cleaned text (T1, T2) with their capitals."""
    return tokens(keep_letters(remove_mentions(remove_urls(text))))


def entry_marks(entries: DataFrame) -> np.ndarray:
    """The filter of ``entries``' phrases in lower case (``llm.common.mark_table``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, hashes, offsets in _words.texts(batch.column(0)):
                sizes = np.diff(offsets)
                for n in np.unique(sizes[sizes > 0]).tolist():
                    grams, at = ngrams(hashes, offsets, n, whole_if_shorter=False)
                    yield pa.RecordBatch.from_arrays([pa.array(grams[at[:-1][sizes == n]].view(np.int64))], names=["h"])

    return mark_table(entries.select(F.lower("phrase").alias("p")).mapInArrow(run, "h long"))


def marked_runs(texts: DataFrame, key: str, token_col: str, marks: np.ndarray, longest: int) -> DataFrame:
    """(key, at, len, phrase): the runs of one to ``longest`` tokens, words joined by a blank, that ``marks`` lets pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, cased, low = batch.columns
            for first, _, hashes, offsets in _words.texts(low):
                parts = []
                for n in range(1, longest + 1):
                    grams, starts = ngrams(hashes, offsets, n, whole_if_shorter=False)
                    some = np.flatnonzero(marked(marks, grams))
                    row = np.searchsorted(starts, some, side="right") - 1
                    parts.append((row, some - starts[row], np.full(len(some), n)))
                row, at, size = map(np.concatenate, zip(*parts, strict=True))
                order = np.argsort(row, kind="stable")
                row, at, size = row[order], at[order], size[order]
                phrases, last, words = [], -1, []
                for r, i, n in zip(row.tolist(), at.tolist(), size.tolist(), strict=True):
                    if r != last:
                        last, words = r, cased[first + r].as_py().split(" ")
                    phrases.append(" ".join(words[i:i + n]))
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(first + row)), pa.array(at, pa.int32()), pa.array(size, pa.int32()), pa.array(phrases, pa.string())],
                                                 names=[key, "at", "len", "phrase"])

    joined = F.array_join(token_col, " ")
    source = texts.select(key, joined.alias("_cased"), F.lower(joined).alias("_low"))
    return source.mapInArrow(run, StructType([source.schema[0], StructField("at", IntegerType()), StructField("len", IntegerType()), StructField("phrase", StringType())]))


def normal_phrase(phrase) -> Column:
    """Words of an entry joined by single blanks (null for an entry without any)."""
    words = tokens(F.col(phrase) if isinstance(phrase, str) else phrase)
    return F.when(F.size(words) > 0, F.array_join(words, " "))


def phrase_hits(texts: DataFrame, lexicon: DataFrame, *, key: str, token_col: str, values: list[str] = (), longest: int = LONGEST) -> DataFrame:
    """(key, hits): for texts with any hit, the sorted array<struct<at, shorter, values...>>; ``shorter`` is minus the
    hit's words.  ``lexicon``: phrase, exact (whether capitals count) and ``values``.  Rows of equal ``key`` must have
    equal tokens, none empty or with white space in it; their hits are listed once.  Entries of more than ``longest``
    words never match."""
    entries = lexicon.select(normal_phrase("phrase").alias("phrase"), F.coalesce(F.col("exact"), F.lit(False)).alias("exact"), *values).where("phrase IS NOT NULL")
    entries = entries.where(F.size(F.split("phrase", " ")) <= longest).withColumn("phrase", F.when(F.col("exact"), F.col("phrase")).otherwise(F.lower("phrase")))
    entries = written(entries.distinct(), "phrases")
    most = entries.agg(F.max(F.size(F.split("phrase", " ")))).first()[0] or 1
    runs = marked_runs(texts, key, token_col, entry_marks(entries), most)
    entries = entries.select(F.lower("phrase").alias("_p"), F.col("phrase").alias("_as_is"), "exact", *values)
    met = runs.withColumn("_p", F.lower("phrase")).join(entries, "_p").where(~F.col("exact") | (F.col("phrase") == F.col("_as_is")))
    hit = F.struct("at", (-F.col("len")).alias("shorter"), *values)
    return met.groupBy(key).agg(F.array_sort(F.collect_set(hit)).alias("hits"))


def count_phrases(texts: DataFrame, lexicon: DataFrame, *, id_col: str, text_col: str = "text", longest: int = LONGEST) -> DataFrame:
    """T3 / J4 in intent mode: every row's ``id_col`` and ``phrases``, the lexicon entries found from left to right, the
    longest at each place, none inside another.  Null texts have none; rows with equal ids are counted each."""
    staged = keyed(texts.select(id_col, lettered(text_col).alias("_raw")), "_raw", id_col)
    hits = phrase_hits(staged.select("_list", cased_tokens(F.get("_raw", F.lit(0))).alias("_toks")), lexicon, key="_list", token_col="_toks", longest=longest)
    start = F.struct(F.lit(0).alias("next"), F.lit(0).cast("long").alias("n"))
    taken = F.aggregate("hits", start, lambda s, h: F.when(h["at"] < s["next"], s).otherwise(
        F.struct((h["at"] - h["shorter"]).alias("next"), (s["n"] + 1).alias("n"))), lambda s: s["n"])
    found = hits.select("_list", taken.alias("phrases"))
    return join_back(staged, found).select(id_col, F.coalesce("phrases", F.lit(0)).cast("long").alias("phrases"))


def lettered(text_col: str) -> Column:
    """The text as a list of one, for :func:`keyed`: equal texts have equal tokens, and only the side that looks for hits
    has to clean them.  Null without an ASCII letter, as there are no tokens then."""
    return F.when(F.col(text_col).rlike("[a-zA-Z]"), F.array(text_col))


SALTS = 8


def keyed(rows: DataFrame, token_col: str, *spread_by: str) -> DataFrame:
    """``rows`` with ``_list`` (names the token list) and ``_salt``.  Rows without tokens get a name of their own kind
    for each salt, so that they don't meet in one task."""
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    name = F.sha2(F.array_join(token_col, " "), 256)
    return rows.withColumns({"_salt": salt, "_list": F.when(F.coalesce(F.size(token_col), F.lit(0)) > 0, name).otherwise(F.concat(F.lit("none "), F.xxhash64(*spread_by).cast("string")))})


def join_back(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Left join of ``keyed`` rows with one small row per token list.  A list that a third of all rows share meets them
    in ``SALTS`` parts: the small rows are repeated, never the texts."""
    spread = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(spread, ["_list", "_salt"], "left")


def keyword_entries(spark, keywords) -> DataFrame:
    """(phrase, exact) of a list: an entry in capitals only matches as it is written, others in any case."""
    return literal_frame(spark, [(k, k.isupper()) for k in dict.fromkeys(keywords)], "phrase string, exact boolean")

