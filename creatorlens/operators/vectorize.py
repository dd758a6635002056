"""TF-IDF in long form.

``(doc_id, term, tfidf)`` rows, computed with the usual definition:
tokens = runs of >= 2 word characters of the lower-cased text, stop words
removed, n-grams joined by a space; tf = raw count; idf = ln((1 + n) / (1 + df))
+ 1 (smoothed); optional df pruning (``min_df``/``max_df`` as counts or
fractions) and ``max_features`` (highest corpus counts, ties alphabetical);
rows L2-normalised per document.

Plan: explode terms per document and reduce them per (doc, term) with a
partial aggregate; document frequencies are a second aggregate over those
pairs; the vocabulary joins back on ``term`` (AQE broadcasts it when small,
splits hot terms otherwise); the L2 norm is a window per document (bounded by
the document's distinct terms).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def analyze(text: Column, *, ngram_range: tuple[int, int] = (1, 1), stop_words: Sequence[str] | None = None,
            lowercase: bool = True) -> Column:
    """Terms of one text: tokens, stop words removed, n-grams (array<string>)."""
    t = F.lower(text) if lowercase else text
    toks = F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), 0)
    if stop_words:
        stops = sorted(set(stop_words))
        toks = F.filter(toks, lambda x: ~x.isin(stops))
    lo, hi = ngram_range
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(toks)
        else:
            shifted = [F.slice(toks, i + 1, F.greatest(F.size(toks) - i, F.lit(0))) for i in range(n)]
            grams = F.arrays_zip(*shifted)
            parts.append(F.transform(F.filter(grams, lambda g: g[str(n - 1)].isNotNull()),
                                     lambda g: F.concat_ws(" ", *[g[str(i)] for i in range(n)])))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def term_counts(docs: DataFrame, id_col: str, text_col: str, **kw) -> DataFrame:
    """Raw term frequency per (doc, term)."""
    terms = docs.select(F.col(id_col).alias("doc_id"), F.explode(analyze(F.col(text_col), **kw)).alias("term"))
    # the explicit not-null filter keeps the vocabulary branch and the weighting
    # branch identical, so Spark reuses one shuffle of the counts for both
    return terms.where(F.col("term").isNotNull()).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def _bound(v, n: Column) -> Column:
    return F.lit(float(v)) * n if isinstance(v, float) else F.lit(v)


def vocabulary(tf: DataFrame, n_docs: Column, *, min_df: float | int = 1, max_df: float | int = 1.0,
               max_features: int | None = None) -> DataFrame:
    """``term, df, ctf`` of the kept terms (df pruning, then max_features)."""
    dfs = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf"))
    kept = dfs.where((F.col("df") >= _bound(min_df, n_docs)) & (F.col("df") <= _bound(max_df, n_docs)))
    if max_features is not None:
        kept = kept.orderBy(F.desc("ctf"), F.asc("term")).limit(max_features)
    return kept


def tfidf(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
          ngram_range: tuple[int, int] = (1, 1), stop_words: Sequence[str] | None = None,
          min_df: float | int = 1, max_df: float | int = 1.0, max_features: int | None = None,
          norm: bool = True) -> DataFrame:
    """``doc_id, term, tfidf``."""
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    tf = term_counts(docs, id_col, text_col, ngram_range=ngram_range, stop_words=stop_words)
    vocab = vocabulary(tf, n_docs, min_df=min_df, max_df=max_df, max_features=max_features)
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    w = tf.join(vocab.select("term", "df"), "term").select("doc_id", "term", (F.col("tf") * idf).alias("tfidf"))
    if norm:
        l2 = F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf")).over(Window.partitionBy("doc_id")))
        w = w.select("doc_id", "term", (F.col("tfidf") / l2).alias("tfidf"))
    return w


def stop_word_union(*word_sets: Sequence[str]) -> list[str]:
    """Union of stop-word lists (first occurrence order)."""
    return list(dict.fromkeys(w for ws in word_sets for w in ws))


def default_stop_words(spark=None, extra: Sequence[str] = ()) -> list[str]:
    """Spark's English stop-word list united with ``extra`` (U2).  Entries are
    compared with lower-cased tokens, so capitalised extras never match."""
    from pyspark.ml.feature import StopWordsRemover
    return stop_word_union(StopWordsRemover.loadDefaultStopWords("english"), extra)


def tfidf_vectorizer(text_col: str = "title", *, ngram_range: tuple[int, int] = (1, 2),
                           stop_words: Sequence[str] | None = None, min_df: float = 1.0, max_df: float = 1.0,
                           vocab_size: int = 2**31 - 1, out: str = "features"):
    """T7 in MLlib form (sparse vectors for clustering / classification):
    tokens -> stop words -> n-grams -> counts with df limits -> IDF -> L2, with
    the weights of the long form: ln((n + 1) / (df + 1)) + 1.  By default every
    term is kept (``vocab_size`` is a feature limit for those who want one)."""
    from creatorlens.operators.kernels import SmoothIDF
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import CountVectorizer, NGram, Normalizer, RegexTokenizer, SQLTransformer
    from pyspark.ml.feature import StopWordsRemover
    stages = [RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=TOKEN_PATTERN, gaps=False),
              StopWordsRemover(inputCol="_tok", outputCol="_tok1", stopWords=list(stop_words or []))]
    lo, hi = ngram_range
    cols = []
    for n in range(lo, hi + 1):
        if n == 1:
            cols.append("_tok1")
        else:
            stages.append(NGram(n=n, inputCol="_tok1", outputCol=f"_ng{n}"))
            cols.append(f"_ng{n}")
    stages.append(SQLTransformer(statement=f"SELECT *, concat({', '.join(cols)}) AS _terms FROM __THIS__"))
    stages += [CountVectorizer(inputCol="_terms", outputCol="_tf", minDF=min_df, maxDF=max_df, vocabSize=vocab_size),
               SmoothIDF(inputCol="_tf", outputCol="_idf"), Normalizer(inputCol="_idf", outputCol=out, p=2.0)]
    return Pipeline(stages=stages)
