"""Lexicon operators over texts (U1, T5, A10, P19, J4, J5 as table operators).

Literal lists (hundreds of terms) are compiled into the projection - one
hash-set probe per token for J4, one pass with a prefix-tree pattern for J5 - or
counted over Arrow batches (A10).  Lexicons stored as tables may have any size:
``operators.phrases`` for token entries, :func:`terms_present` for substrings.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from creatorlens import lexicons as L
from creatorlens.functions.text import char_class
from creatorlens.operators.phrases import SALTS, join_back
from creatorlens.session import literal_frame, materialize


def lexicon_union(keywords: Sequence[str] = L.GENZ_KEYWORDS, emojis: Sequence[str] = L.GENZ_EMOJIS,
                  hashtags: Sequence[str] = L.GENZ_HASHTAGS) -> list[tuple[str, str]]:
    """Keywords + emojis + hashtags, first occurrence of each term kept."""
    seen, out = set(), []
    for kind, terms in (("keyword", keywords), ("emoji", emojis), ("hashtag", hashtags)):
        for t in terms:
            if t and t not in seen:
                seen.add(t)
                out.append((kind, t))
    return out


def lexicon_frame(spark: SparkSession, entries: Sequence[tuple[str, str]]) -> DataFrame:
    """U1 as a DataFrame ``(kind, term)``."""
    return literal_frame(spark, list(entries), "kind string, term string")


def count_terms(texts: pa.Array, terms: Sequence[str]) -> np.ndarray:
    """Non-overlapping occurrences of each term in a column of texts, left to right (counted in Arrow's own code).

    Terms are taken by their first characters: those that start with a letter or digit are searched in every text,
    the others (emoji, hashtags) only in the texts that one scan for their first characters leaves."""
    total = np.zeros(len(terms), np.int64)
    plain = [i for i, t in enumerate(terms) if t[0].isascii() and t[0].isalnum()]
    other = [i for i in range(len(terms)) if i not in set(plain)]
    if other:
        few = texts.filter(pc.match_substring_regex(texts, f"[{char_class(terms[i][0] for i in other)}]"))
        if len(few):
            marks: dict[str, list[int]] = {}
            for i in other:
                marks.setdefault(terms[i][0], []).append(i)
            for first, own in marks.items():
                some = few.filter(pc.match_substring(few, first)) if len(own) > 1 else few
                for i in own if len(some) else ():
                    total[i] = pc.sum(pc.count_substring(some, terms[i])).as_py() or 0
    for i in plain:
        total[i] = pc.sum(pc.count_substring(texts, terms[i])).as_py() or 0
    return total


def term_frequency(texts: DataFrame, terms: Sequence[str], text_col: str = "text", lower: bool = True) -> DataFrame:
    """Corpus frequency of each term - non-overlapping substring
    occurrences per text (case-folded), summed over texts; zero counts dropped.

    Each task counts over Arrow batches and hands on one row per term that it found, so the shuffle carries as many
    rows as there are terms and tasks.  Null texts hold nothing; repeated terms are counted once.
    """
    spark = texts.sparkSession
    terms = [t for t in dict.fromkeys(terms) if t]
    if not terms:
        return spark.createDataFrame([], "term string, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            column = batch.column(0).drop_null()
            total += count_terms(column, terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([terms[i] for i in some], pa.string()), pa.array(total[some])], names=["term", "n"])

    low = texts.select((F.lower(text_col) if lower else F.col(text_col)).alias("_low"))
    return low.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def terms_from_table(lexicon: DataFrame, kinds: Sequence[str] | None = None) -> list[str]:
    """U1 for a lexicon stored as a table ``(kind, term)``: the distinct terms as
    the list that the text operators compile in.  A lexicon is configuration: it
    must fit into an expression."""
    df = lexicon if kinds is None else lexicon.where(F.col("kind").isin(list(kinds)))
    rows = df.select("term").where(F.length("term") > 0).distinct().collect()
    return sorted(r["term"] for r in rows)


GRAM = 3
AUTOMATON_TERMS, AUTOMATON_LETTERS = 100_000, 4_000_000


def shippable(terms: DataFrame) -> bool:
    """Whether a table of terms is small enough to travel with the tasks (both sizes are checked, not guessed)."""
    size = terms.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("term")), F.lit(0)).alias("letters")).first()
    return size.n <= AUTOMATON_TERMS and size.letters <= AUTOMATON_LETTERS


def automaton(terms: Sequence[str]):
    """All terms in one pass over a text; a hit gives the term's number."""
    import ahocorasick
    out = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        out.add_word(term, number)
    out.make_automaton()
    return out


def _pieces(text, n: int):
    """The ``n``-grams of a text, repeats included (one pass; substring() would count from the start each time)."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))


def term_candidates(texts: DataFrame, terms: DataFrame, key: str, text_col: str, q: int = GRAM) -> DataFrame:
    """(key, term): every term (distinct rows of ``terms``) that a text (one per ``key``) holds as a substring, and others
    that share its rarest ``q``-gram; ask ``contains`` of each.

    An inverted index of the terms: each lies under its rarest ``q``-gram (the one that fewest terms hold; a shorter
    term under itself).  The texts' distinct grams are joined with it.  Nothing is collected; terms that share a
    frequent gram meet only where no rarer one tells them apart."""
    own = F.when(F.length("term") >= q, F.array_distinct(_pieces(F.col("term"), q))).otherwise(F.array("term"))
    grams = terms.select("term", F.explode(own).alias("gram"))
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    index = grams.join(held, "gram").groupBy("term").agg(F.min(F.struct("n", "gram")).alias("g")).select("term", F.col("g.gram").alias("gram"))
    every = F.concat(*[_pieces(F.col(text_col), n) for n in range(1, q + 1)])
    return texts.select(key, F.explode(F.array_distinct(every)).alias("gram")).join(index, "gram").select(key, "term")


def terms_present(texts: DataFrame, lexicon: DataFrame, *, id_col: str, text_col: str = "text", q: int = GRAM, lower: bool = True) -> DataFrame:
    """J5 for a lexicon stored as a table (column ``term``) of any size: every row's ``id_col`` and ``n_terms``, how many
    distinct terms its text holds as substrings.

    A lexicon of checked size (:func:`shippable`) travels with the tasks as one automaton, and no text is shuffled; a
    larger one is joined by its grams (:func:`term_candidates`).  Both count the same.  Texts are folded to lower case
    (terms are used as given); null texts hold nothing; empty and null terms are left out."""
    text = F.lower(text_col) if lower else F.col(text_col)
    terms = materialize(lexicon.select(F.col("term").cast("string").alias("term")).where(F.length("term") > 0).distinct())
    staged = texts.select(F.col(id_col).alias(id_col), F.coalesce(text, F.lit("")).alias("_text"))
    if shippable(terms):
        words = [r.term for r in terms.collect()]  # bounded by the check

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = automaton(words)
            for batch in batches:
                n = [len({i for _, i in found.iter(t.as_py())}) if words else 0 for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32())], names=[id_col, "n_terms"])

        return staged.mapInArrow(run, StructType([staged.schema[0], StructField("n_terms", IntegerType())]))
    staged = staged.withColumns({"_list": F.unhex(F.md5("_text")), "_salt": F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int")})
    met = term_candidates(staged, terms, "_list", "_text", q).groupBy("_list").agg(F.collect_set("term").alias("_terms"))
    found = F.size(F.filter("_terms", lambda t: F.contains(F.col("_text"), t)))
    return join_back(staged, met).select(id_col, F.when(F.col("_terms").isNotNull(), found).otherwise(F.lit(0)).alias("n_terms"))
