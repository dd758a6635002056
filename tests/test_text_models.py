"""Sentiment histogram, term frequency, TF-IDF and silhouette against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from creatorlens.operators import cluster as clu
from creatorlens.operators import lexicon as lex
from creatorlens.operators import sentiment as sent
from creatorlens.operators import vectorize as vec


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.uniform(-1, 1, 300), 3)
    df = spark.createDataFrame([(float(v),) for v in vals], "polarity double")
    got = sent.histogram(df, "polarity", 5).orderBy("bin").collect()
    counts, edges = np.histogram(vals, bins=5)
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["lo"] for r in got] == pytest.approx(edges[:-1].tolist())
    one = spark.createDataFrame([(0.25,), (0.25,)], "polarity double")
    c1, _ = np.histogram([0.25, 0.25], bins=5)
    assert [r["n"] for r in sent.histogram(one, "polarity", 5).orderBy("bin").collect()] == c1.tolist()


def test_term_frequency_matches_str_count(spark):
    texts = ["Lit LIT lit", "aaaa", "#art #artist", "none here"]
    terms = ["lit", "aa", "#art", "zz"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["term"]: r["n"] for r in lex.term_frequency(df, terms).collect()}
    exp = {t: sum(x.lower().count(t) for x in texts) for t in terms}
    assert got == {k: v for k, v in exp.items() if v > 0}


def _py_tfidf(docs, ngram=(1, 2), stops=(), min_df=1, max_df=1.0):
    def terms(t):
        toks = [w for w in re.findall(r"(?u)\b\w\w+\b", t.lower()) if w not in stops]
        out = []
        for n in range(ngram[0], ngram[1] + 1):
            out += [" ".join(toks[i:i + n]) for i in range(len(toks) - n + 1)]
        return out
    tfs = {i: Counter(terms(t)) for i, t in docs}
    n = len(docs)
    df = Counter(w for c in tfs.values() for w in c)
    lo = min_df * n if isinstance(min_df, float) else min_df
    hi = max_df * n if isinstance(max_df, float) else max_df
    vocab = {w for w, d in df.items() if lo <= d <= hi}
    out = {}
    for i, c in tfs.items():
        w = {t: c[t] * (math.log((1 + n) / (1 + df[t])) + 1) for t in c if t in vocab}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, t): x / norm for t, x in w.items()})
    return out


def test_tfidf_matches_definition(spark):
    docs = [(1, "Red running shoes"), (2, "red shoes and red bags"), (3, "Blue bags"), (4, "the shoes"), (5, "")]
    df = spark.createDataFrame(docs, "id long, text string")
    got = {(r["doc_id"], r["term"]): r["tfidf"] for r in
           vec.tfidf(df, "id", "text", ngram_range=(1, 2), stop_words=["and", "the"], max_df=0.5).collect()}
    exp = _py_tfidf(docs, stops=("and", "the"), max_df=0.5)
    assert got.keys() == exp.keys()
    for k, v in exp.items():
        assert got[k] == pytest.approx(v)


def test_silhouette_mean_matches_mllib(spark):
    rng = np.random.default_rng(2)
    pts = [(i, int(i % 3), [float(x) for x in rng.normal(i % 3, 1.0, 4)]) for i in range(90)] + [(90, 3, [9.0, 9.0, 9.0, 9.0])]
    df = spark.createDataFrame(pts, "id long, cluster int, features array<double>")
    sil = clu.silhouette(df, "id")
    mean = sil.agg(F.avg("silhouette")).first()[0]
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector
    v = df.withColumn("v", array_to_vector("features")).withColumn("prediction", F.col("cluster").cast("double"))
    mll = ClusteringEvaluator(featuresCol="v", predictionCol="prediction").evaluate(v)
    assert mean == pytest.approx(mll, abs=1e-9)
    assert sil.where("id = 90").first()["silhouette"] == 0.0      # singleton


def test_term_frequency_counts_like_str_count(spark):
    texts = ["Lit LIT lit 🔥🔥 #art #artist 🔥🔥🔥", "aaaa abab ababab", "none here", None, "", "listlit (x) [y] a.b a+b"]
    terms = ["lit", "aa", "#art", "#artist", "🔥", "🔥🔥", "zz", "A", "abab", "ab", "a", "(x)", "[y]", "a.b", "a+", "li", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["term"]: r["n"] for r in lex.term_frequency(df, terms).collect()}
    want = {t: sum(x.lower().count(t) for x in texts if x) for t in terms if t}
    assert got == {k: v for k, v in want.items() if v > 0}
    from creatorlens.functions import text as tx
    row = df.select("text", tx.occurrence_total("text", terms, True).alias("n"), tx.count_present("text", terms, True).alias("p")).collect()
    for r in row:
        low = (r["text"] or "").lower()
        if r["text"] is not None:
            assert r["n"] == sum(low.count(t) for t in terms if t) and r["p"] == sum(t in low for t in terms if t)
    assert lex.term_frequency(df, []).collect() == []
