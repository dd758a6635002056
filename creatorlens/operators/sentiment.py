"""Lexicon sentiment.

Polarity of a text = mean polarity of its lexicon words, a word directly after a
negator contributing ``negation_factor`` times its polarity; no lexicon word ->
0.0.  The lexicon is an input table ``(word, polarity)``.

Plan: a text's polarity depends on its tokens alone.  Tokens are exploded next
to their predecessor, joined with the lexicon and averaged per token list (named
by its hash), and the texts join these averages, dealt over several parts so that
a text that a third of all rows repeat is no hot key; texts without tokens join
nothing.  All tokens of a text live in one input partition, so the partial
aggregate collapses them before the shuffle: the exchanges carry one small row
per text, never the text.  Which
side of the lexicon join travels is left to Spark's own size statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creatorlens.functions.text import clean_text, tokens
from creatorlens.operators.phrases import LONGEST, join_back, keyed, lettered, phrase_hits
from creatorlens.session import literal_frame, materialize

DEFAULT_NEGATORS = ("not",)


def lexicon_frame(spark, entries: dict[str, float] | Sequence[tuple[str, float]]) -> DataFrame:
    rows = list(entries.items()) if isinstance(entries, dict) else list(entries)
    return literal_frame(spark, rows, "word string, polarity double")


def _dedup_lexicon(lexicon: DataFrame) -> DataFrame:
    """One polarity per lower-cased word; entries without word or polarity are left out."""
    return (lexicon.select(F.lower(F.col("word")).alias("_w"), F.col("polarity").cast("double").alias("_pol"))
            .where(F.col("_w").isNotNull() & F.col("_pol").isNotNull()).groupBy("_w").agg(F.avg("_pol").alias("_pol")))


def score_texts(texts: DataFrame, lexicon: DataFrame, *, id_col: str, text_col: str = "text",
                carry: Sequence[str] = (), extra: dict | None = None,
                negators: Sequence[str] = DEFAULT_NEGATORS, negation_factor: float = -0.5) -> DataFrame:
    """One row per input row: ``id_col``, ``carry`` columns, ``extra`` in-row
    expressions (computed on the raw text) and ``polarity``."""
    extra = dict(extra or {})
    keep = [id_col, *carry]
    toks = texts.select(*keep, *[e.alias(n) for n, e in extra.items()], tokens(clean_text(F.col(text_col))).alias("_toks"))
    staged = keyed(toks, "_toks", id_col)
    pairs = F.zip_with(F.col("_toks"), F.concat(F.array(F.lit(None).cast("string")), F.col("_toks")),
                       lambda w, p: F.struct(w.alias("w"), p.alias("prev")))
    negs = sorted({n.lower() for n in negators})
    factor = (F.when(F.col("_t.prev").isin(negs), F.lit(float(negation_factor))).otherwise(F.lit(1.0)) if negs else F.lit(1.0))
    words = staged.select("_list", F.explode(pairs).alias("_t")).select("_list", F.col("_t.w").alias("_w"), factor.alias("_f"))
    # a list that several texts share is counted for each of them, which leaves its mean as it is
    means = words.join(_dedup_lexicon(lexicon), "_w").groupBy("_list").agg(F.avg(F.col("_pol") * F.col("_f")).alias("polarity"))
    return (join_back(staged.drop("_toks"), means)
            .select(*keep, *extra.keys(), F.coalesce("polarity", F.lit(0.0)).alias("polarity")))


NEGATION_WINDOW = 3


def modified_polarity(hits, window: int = NEGATION_WINDOW, negation_factor: float = -0.5) -> Column:
    """T6 with modifiers: the polarity of one text from its sorted lexicon hits (``phrases.phrase_hits`` with polarity,
    intensity and negates), as a fold that carries the pending intensity, how far a negation reaches and the sums.

    * A hit inside the one taken before is passed over (longest entry first).
    * A negator holds for the next ``window`` tokens, up to the next opinion.
    * A modifier multiplies what is pending ("very very"); intensity only reaches the very next token.
    * An opinion counts polarity x intensity, within [-1, 1]; if negated, polarity / intensity x ``negation_factor``.

    The polarity is the mean over the opinions, null without any."""
    start = F.struct(F.lit(0).alias("next"), F.lit(-1).alias("until"), F.lit(1.0).alias("amp"), F.lit(-1).alias("amp_at"),
                     F.lit(0.0).alias("sum"), F.lit(0).alias("n"))

    def state(s, next_, until, amp, amp_at, total, n) -> Column:
        return F.struct(next_.alias("next"), until.alias("until"), amp.alias("amp"), amp_at.alias("amp_at"), total.alias("sum"), n.alias("n"))

    def step(s, h) -> Column:
        end = h["at"] - h["shorter"]
        amp = F.when(h["at"] == s["amp_at"], s["amp"]).otherwise(F.lit(1.0))
        negated = h["at"] <= s["until"]
        scaled = F.when(negated, h["polarity"] / amp).otherwise(h["polarity"] * amp)
        value = F.greatest(F.least(scaled, F.lit(1.0)), F.lit(-1.0)) * F.when(negated, F.lit(float(negation_factor))).otherwise(F.lit(1.0))
        return (F.when(h["at"] < s["next"], s)
                .when(h["negates"], state(s, end, end - 1 + window, amp, end, s["sum"], s["n"]))
                .when(h["polarity"].isNull(), state(s, end, s["until"], amp * h["intensity"], end, s["sum"], s["n"]))
                .otherwise(state(s, end, F.lit(-1), F.lit(1.0), F.lit(-1), s["sum"] + value, s["n"] + 1)))

    return F.aggregate(hits, start, step, lambda s: F.when(s["n"] > 0, s["sum"] / s["n"]))


def score_modified(texts: DataFrame, lexicon: DataFrame, *, id_col: str, text_col: str = "text", carry: Sequence[str] = (),
                   window: int = NEGATION_WINDOW, negation_factor: float = -0.5, longest: int = LONGEST) -> DataFrame:
    """T6 with modifiers: one row per input row, ``id_col``, ``carry`` and ``polarity`` (0.0 without an opinion).

    ``lexicon``: phrase (of any number of words up to ``longest``), polarity (null for modifiers and negators),
    intensity (null is 1) and negates (null is false).  Entries in another case, and repeated ones, are merged: mean
    polarity, mean intensity, negator if any is."""
    entries = (lexicon.select(F.lower("phrase").alias("phrase"), F.col("polarity").cast("double").alias("polarity"),
                              F.col("intensity").cast("double").alias("intensity"), F.coalesce("negates", F.lit(False)).alias("negates"))
               .groupBy("phrase").agg(F.avg("polarity").alias("polarity"), F.coalesce(F.avg("intensity"), F.lit(1.0)).alias("intensity"), F.max("negates").alias("negates"))
               .withColumn("exact", F.lit(False)))
    staged = keyed(texts.select(id_col, *carry, lettered(text_col).alias("_raw")), "_raw", id_col)
    cleaned = staged.select("_list", tokens(clean_text(F.get("_raw", F.lit(0)))).alias("_toks"))
    hits = phrase_hits(cleaned, entries, key="_list", token_col="_toks", values=["polarity", "intensity", "negates"], longest=longest)
    found = hits.select("_list", modified_polarity("hits", window, negation_factor).alias("polarity"))
    return join_back(staged.drop("_raw"), found).select(id_col, *carry, F.coalesce("polarity", F.lit(0.0)).alias("polarity"))


def is_positive(polarity="polarity"):
    """P18."""
    return F.col(polarity) > 0 if isinstance(polarity, str) else polarity > 0


def mean_sentiment(scored: DataFrame, polarity: str = "polarity") -> DataFrame:
    """One row, ``mean_polarity`` and ``n``."""
    return scored.agg(F.avg(polarity).alias("mean_polarity"), F.count(F.lit(1)).alias("n"))


def histogram(scored: DataFrame, value: str = "polarity", bins: int = 5,
              materialize_input: bool = True) -> DataFrame:
    """Equal-width histogram over [min, max] with the last bin closed,
    empty bins kept.  Degenerate range (min = max) uses [v - 0.5, v + 0.5].

    Bin index = floor((x - lo) * bins / (hi - lo)), corrected by one where the
    float product lands on the wrong side of an edge ``lo + i * (hi - lo) / bins``.
    The range comes from a scalar subquery; the counts are a partial/final
    aggregate over at most ``bins`` keys, joined to the ``bins``-row bin table.
    """
    spark = scored.sparkSession
    if materialize_input:        # two passes (range, then bins): score the texts once
        scored = materialize(scored.select(value))
    rng = scored.agg(F.struct(F.min(value).alias("mn"), F.max(value).alias("mx"))).scalar()
    # Each step is its own projection and each value is used several times by
    # the next one, so Catalyst keeps them apart: the range subquery runs once
    # and the bin expression does not grow with every correction.
    x = F.col(value)
    b1 = scored.where(x.isNotNull()).select(x.alias("_x"), rng.alias("_r"))
    b2 = b1.select("_x", F.when(F.col("_r.mn") == F.col("_r.mx"), F.col("_r.mn") - 0.5)
                   .otherwise(F.col("_r.mn")).alias("_lo"),
                   F.when(F.col("_r.mn") == F.col("_r.mx"), F.col("_r.mx") + 0.5)
                   .otherwise(F.col("_r.mx")).alias("_hi"))
    lo, hi, xx = F.col("_lo"), F.col("_hi"), F.col("_x")

    def edge(i):
        return F.when(i >= bins, hi).otherwise(lo + i * ((hi - lo) / bins))

    b3 = b2.select("_x", "_lo", "_hi", F.least(F.floor((xx - lo) * (F.lit(float(bins)) / (hi - lo))).cast("int"),
                                                F.lit(bins - 1)).alias("_raw"))
    b4 = b3.select("_x", "_lo", "_hi", F.when(xx < edge(F.col("_raw")), F.col("_raw") - 1)
                   .otherwise(F.col("_raw")).alias("_i"))
    i = F.col("_i")
    b5 = b4.select(F.when((xx >= edge(i + 1)) & (i != bins - 1), i + 1).otherwise(i).alias("bin"), "_lo", "_hi")
    counts = b5.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"),
                                   F.first("_hi").alias("_hi"))
    table = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    rng_lo = F.when(rng["mn"] == rng["mx"], rng["mn"] - 0.5).otherwise(rng["mn"])
    rng_hi = F.when(rng["mn"] == rng["mx"], rng["mx"] + 0.5).otherwise(rng["mx"])
    edges = table.select("bin", rng_lo.alias("_lo"), rng_hi.alias("_hi"))
    return (edges.join(F.broadcast(counts.select("bin", "n")), "bin", "left")
            .select("bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))
