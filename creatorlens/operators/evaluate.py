"""Ranking and classifier evaluation.

All metrics are aggregates: one pass with partial aggregation, scalar values
(quantile, class totals) injected as scalar subqueries, and curve prefix sums
computed range-partitioned (``ordered.running_sums``), never in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creatorlens import lexicons as L
from creatorlens.operators.ordered import running_sums
from creatorlens.session import literal_frame, materialize


# ---------------------------------------------------------------- A11
def quantile(df: DataFrame, col: str, q: float) -> Column:
    """Exact linearly interpolated quantile (pandas/numpy ``linear``) of a
    column, NULLs skipped, as a scalar-subquery Column.

    Values are counted per distinct value, ranked with range-partitioned
    running counts, and only the one or two distinct values that hold ranks
    floor/ceil((n - 1) q) are kept.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be within [0, 1]")
    counts = materialize(df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v"))
                         .agg(F.count(F.lit(1)).alias("_c")))
    ranked = running_sums(counts, "_v", ["_c"])
    n = counts.agg(F.sum("_c")).scalar()
    pos = (n - 1) * F.lit(float(q))
    lo, hi = F.floor(pos), F.ceil(pos)
    start = F.col("cum__c") - F.col("_c")
    has_lo = (start <= lo) & (lo < F.col("cum__c"))
    has_hi = (start <= hi) & (hi < F.col("cum__c"))
    picked = ranked.where(has_lo | has_hi).agg(
        F.max(F.when(has_lo, F.col("_v"))).alias("vlo"), F.max(F.when(has_hi, F.col("_v"))).alias("vhi"))
    value = F.col("vlo") + (F.col("vhi") - F.col("vlo")) * (pos - lo)
    return picked.select(value).scalar()


# ---------------------------------------------------------------- P17 / A12 / R5
def self_labels(df: DataFrame, score: str, q: float = L.DECILE_QUANTILE, out: str = "label",
                threshold: Column | None = None) -> DataFrame:
    """``(score >= quantile(score, q)).cast(int)``."""
    thr = quantile(df, score, q) if threshold is None else threshold
    return df.withColumn(out, (F.col(score) >= thr).cast("int"))


def decile_metrics(df: DataFrame, score: str, q: float = L.DECILE_QUANTILE,
                   recommended_fraction: float = 0.1, materialize_input: bool = True,
                   threshold: Column | None = None) -> DataFrame:
    """TP = rows with score >= quantile; TP + FP = fraction * n; FN = n - TP - FP.
    One row: ``threshold, tp, fp, fn, precision, recall, f1``."""
    if materialize_input:
        df = materialize(df.select(score))
    thr = quantile(df, score, q) if threshold is None else threshold
    g = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(score) >= thr).alias("tp"))
    tp = F.col("tp").cast("double")
    fp = F.col("n") * F.lit(float(recommended_fraction)) - tp
    fn = F.col("n") - tp - fp
    p = F.try_divide(tp, tp + fp)
    r = F.try_divide(tp, tp + fn)
    return g.select(thr.alias("threshold"), F.col("tp"), fp.alias("fp"), fn.alias("fn"), p.alias("precision"),
                    r.alias("recall"), F.try_divide(2 * p * r, p + r).alias("f1"))


# ---------------------------------------------------------------- W1 / A16
def _score_counts(df: DataFrame, label: str, score: str, pos_label=1) -> DataFrame:
    """Positives / negatives per distinct score, written once (it is scanned
    for the bucket bounds, the running sums and the class totals)."""
    is_pos = F.col(label) == F.lit(pos_label)
    return materialize(df.where(F.col(score).isNotNull())
                       .groupBy(F.col(score).alias("threshold"))
                       .agg(F.count_if(is_pos).alias("pos"), F.count_if(~is_pos | F.col(label).isNull()).alias("neg")))


def roc_pr_curve(df: DataFrame, label: str, score: str, pos_label=1) -> DataFrame:
    """W1/A16 curve points, one per distinct score (descending thresholds):
    ``threshold, tps, fps, tpr, fpr, precision, recall``.  The (0, 0) ROC start
    and the (recall 0, precision 1) PR end are implicit."""
    counts = _score_counts(df, label, score, pos_label)
    cum = running_sums(counts, "threshold", ["pos", "neg"], descending=True)
    totals = counts.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()
    tps, fps = F.col("cum_pos"), F.col("cum_neg")
    return cum.select("threshold", tps.alias("tps"), fps.alias("fps"),
                      F.try_divide(tps.cast("double"), totals["P"]).alias("tpr"),
                      F.try_divide(fps.cast("double"), totals["N"]).alias("fpr"),
                      F.try_divide(tps.cast("double"), tps + fps).alias("precision"),
                      F.try_divide(tps.cast("double"), totals["P"]).alias("recall"))


def roc_pr_summary(df: DataFrame, label: str, score: str, pos_label=1) -> DataFrame:
    """``auc`` (trapezoidal ROC area) and ``ap`` (sum of recall steps
    times precision), plus class totals; one row."""
    counts = _score_counts(df, label, score, pos_label)
    cum = running_sums(counts, "threshold", ["pos", "neg"], descending=True)
    g = cum.agg(F.sum(F.col("neg") * (2 * F.col("cum_pos") - F.col("pos"))).alias("_auc2"),
                F.sum(F.col("pos") * F.try_divide(F.col("cum_pos").cast("double"),
                                                  F.col("cum_pos") + F.col("cum_neg"))).alias("_ap"),
                F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return g.select(F.try_divide(F.col("_auc2").cast("double"), 2.0 * F.col("n_pos") * F.col("n_neg")).alias("auc"),
                    F.try_divide(F.col("_ap"), F.col("n_pos").cast("double")).alias("ap"),
                    F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg"))


def ranking_evaluation(scored: DataFrame, score: str = "similarity_score", q: float = L.DECILE_QUANTILE) -> DataFrame:
    """Decile P/R/F1 plus ROC AUC and AP against the self-labels."""
    scored = materialize(scored.select(score))
    thr = quantile(scored, score, q)
    labelled = self_labels(scored, score, q, threshold=thr)
    m = decile_metrics(scored, score, q, materialize_input=False, threshold=thr)
    s = roc_pr_summary(labelled, "label", score)
    return _one_row_join(m.select("threshold", "precision", "recall", "f1"), s.select("auc", "ap"))


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame ``b`` to the one-row frame ``a``."""
    sb = b.select(F.struct(*b.columns).alias("_b")).scalar()
    return a.select("*", *[sb[c].alias(c) for c in b.columns])


# ---------------------------------------------------------------- A13 / A14 / A15
def accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Share of rows with ``y = yhat``; one row ``accuracy, n``."""
    return df.agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, yhat: str, classes: Sequence) -> DataFrame:
    """Wide confusion matrix in a fixed class order: one row per true
    class (all classes listed, zero-filled), one ``pred_<c>`` column per class."""
    spark = df.sparkSession
    # only listed classes are counted, so the broadcast side has at most len(classes) rows
    known = df.where(F.col(y).isin(list(classes)))
    wide = known.groupBy(F.col(y).cast("string").alias("label")).pivot(yhat, list(classes)).agg(F.count(F.lit(1)))
    rows = literal_frame(spark, [(str(c), i) for i, c in enumerate(classes)], "label string, class_order int")
    out = rows.join(F.broadcast(wide), "label", "left")
    return out.select("label", "class_order",
                      *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias(f"pred_{c}") for c in classes])


def classification_report(df: DataFrame, y: str, yhat: str, classes: Sequence) -> DataFrame:
    """Per class precision, recall, f1 and support, then ``macro avg`` and
    ``weighted avg``; 0/0 is reported as 0.  A single aggregate pass computes
    three counts per class."""
    aggs = []
    for i, c in enumerate(classes):
        yc, pc = F.col(y) == F.lit(c), F.col(yhat) == F.lit(c)
        aggs += [F.count_if(yc & pc).alias(f"tp{i}"), F.count_if(pc).alias(f"pp{i}"), F.count_if(yc).alias(f"sp{i}")]
    g = df.agg(*aggs)
    per = []
    for i, c in enumerate(classes):
        tp, pp, sp = F.col(f"tp{i}").cast("double"), F.col(f"pp{i}"), F.col(f"sp{i}")
        p = F.coalesce(F.try_divide(tp, pp), F.lit(0.0))
        r = F.coalesce(F.try_divide(tp, sp), F.lit(0.0))
        f = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
        per.append(F.struct(F.lit(str(c)).alias("label"), F.lit(i).alias("row_order"), p.alias("precision"),
                            r.alias("recall"), f.alias("f1"), sp.cast("bigint").alias("support")))
    rows = g.select(F.inline(F.array(*per)))
    k = len(classes)
    summary = rows.agg(
        F.struct(F.lit("macro avg").alias("label"), F.lit(k).alias("row_order"),
                 F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                 F.sum("support").cast("bigint").alias("support")).alias("m"),
        F.struct(F.lit("weighted avg").alias("label"), F.lit(k + 1).alias("row_order"),
                 F.coalesce(F.try_divide(F.sum(F.col("precision") * F.col("support")), F.sum("support")), F.lit(0.0)).alias("precision"),
                 F.coalesce(F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support")), F.lit(0.0)).alias("recall"),
                 F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")), F.lit(0.0)).alias("f1"),
                 F.sum("support").cast("bigint").alias("support")).alias("w"))
    return rows.unionByName(summary.select(F.inline(F.array("m", "w"))))
