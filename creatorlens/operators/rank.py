"""Brand <-> influencer ranking.

Feature table columns: ``username, category, engagement_rate, alignment_genZ``
(+ ``hashtag_score`` for the baseline).  The one-hot category block of the
brand and influencer vectors collapses algebraically: its dot product is
``category = brand_category`` and each norm gets ``+1``, so no vector is ever
materialised and the score is a single generated-code projection.

The normalising maximum (J3) is a scalar subquery: Spark runs one partial/final
aggregate and substitutes the value, so there is no join and no single-partition
window.  Top-k uses ``orderBy().limit()`` (TakeOrderedAndProject: each task keeps
k rows), per-brand top-k uses ``row_number() <= k`` which Spark turns into a
map-side WindowGroupLimit before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creatorlens import lexicons as L
from creatorlens.functions.text import format_score, profile_url
from creatorlens.functions.vector import cosine
from creatorlens.session import materialize


# ---------------------------------------------------------------- P9 / P10 / P11
def validate_category(category: str | None, domain: Sequence[str] = L.CATEGORIES,
                      case_insensitive: bool = True) -> str:
    """Check a requested category against the domain; returns it lower-cased."""
    if not category:
        raise ValueError("Invalid or missing category")
    allowed = {c.lower() for c in domain} if case_insensitive else set(domain)
    probe = category.lower() if case_insensitive else category
    if probe not in allowed:
        raise ValueError(f"Invalid category: {category!r}")
    return category.lower()


def normalize_category(df: DataFrame, col: str = "category") -> DataFrame:
    """P10: ``lower(trim(category))``."""
    return df.withColumn(col, F.lower(F.trim(F.col(col))))


def in_domain(df: DataFrame, domain: Sequence[str], col: str = "category") -> DataFrame:
    """P9 on rows: keep rows whose category is in the domain."""
    return df.where(F.col(col).isin(list(domain)))


# ---------------------------------------------------------------- K1 / K2 / K3
def _score_order(score: str, tiebreak: str):
    return [F.desc_nulls_last(score), F.asc(tiebreak)]


def sort_by_score(df: DataFrame, score: str = "similarity_score", tiebreak: str = "username") -> DataFrame:
    """K1: descending score, NULL last, user name as deterministic tie-break."""
    return df.orderBy(*_score_order(score, tiebreak))


def top_k(df: DataFrame, k: int = L.TOP_K, score: str = "similarity_score",
          tiebreak: str = "username") -> DataFrame:
    """K2: the first ``k`` rows of K1."""
    return sort_by_score(df, score, tiebreak).limit(k)


def page(df: DataFrame, page_no: int, size: int = L.TOP_K, score: str = "similarity_score",
         tiebreak: str = "username") -> DataFrame:
    """K3: page ``page_no`` (0-based) of the ranking, ``size`` rows each."""
    return sort_by_score(df, score, tiebreak).offset(page_no * size).limit(size)


def top_k_per(df: DataFrame, group: str, k: int = L.TOP_K, score: str = "similarity_score",
              tiebreak: str = "username") -> DataFrame:
    """K2 per group (brand): ``row_number() <= k``."""
    w = Window.partitionBy(group).orderBy(*_score_order(score, tiebreak))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ---------------------------------------------------------------- scoring
def largest(col: str = "engagement_rate") -> Column:
    """A3: the maximum of the numbers; NULL and NaN rates are passed over."""
    return F.max(F.when(~F.isnan(col), F.col(col)))


def _with_max(rows: DataFrame, col: str = "engagement_rate") -> DataFrame:
    """The global maximum attached as column ``_m`` through ONE scalar
    subquery (partial/final aggregate), staged in its own projection so every
    later use reads the column instead of repeating the subquery."""
    return rows.select("*", rows.agg(largest(col)).scalar().alias("_m"))


def _maybe_round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def brand_similarity(rate_norm: Column, alignment: Column, same_category: Column,
                     brand_rate_norm: Column, brand_target: Column) -> Column:
    """F17 with the F18 one-hot collapsed: cos([r, g, onehot], [b, a, onehot_b])."""
    onehot_dot = same_category.cast("double")
    dot = rate_norm * brand_rate_norm + alignment * brand_target + onehot_dot
    n1 = F.sqrt(rate_norm * rate_norm + alignment * alignment + F.lit(1.0))
    n2 = F.sqrt(brand_rate_norm * brand_rate_norm + brand_target * brand_target + F.lit(1.0))
    return dot / (n1 * n2)


def rank_in_category(features: DataFrame, category: str = L.DEFAULT_CATEGORY, *,
                     engagement_target: float = L.SERVICE_ENGAGEMENT_TARGET,
                     audience_target: float = 1.0, k: int | None = L.TOP_K,
                     domain: Sequence[str] = L.CATEGORIES, digits: int | None = None) -> DataFrame:
    """Influencers of one category ranked against a brand of that category.

    P10 normalise -> P8 filter -> A3 max (scalar subquery) -> F19/J3 normalise ->
    F17 cosine -> K1/K2.  Output ``username, similarity_score``.
    """
    cat = validate_category(category, domain)
    rows = _with_max(normalize_category(features).where(F.col("category") == cat))
    m = F.col("_m")
    t = F.lit(float(engagement_target))
    r = F.try_divide(F.col("engagement_rate"), m)
    b = F.try_divide(t, F.greatest(m, t))
    score = brand_similarity(r, F.col("alignment_genZ"), F.lit(True), b, F.lit(float(audience_target)))
    out = rows.select("username", _maybe_round(score, digits).alias("similarity_score"))
    return out if k is None else top_k(out, k)


def rank_all(features: DataFrame, brand_category: str, *,
             engagement_target: float = L.SCRIPT_ENGAGEMENT_TARGET, audience_target: float = 1.0,
             digits: int | None = None) -> DataFrame:
    """R2: every influencer scored against one brand; the category block is a
    one-hot over the categories present (learned), so it contributes
    ``category = brand_category`` to the dot product and 1 to each norm.
    Output ``username, category, similarity_score`` sorted by K1."""
    rows = _with_max(normalize_category(features))
    m = F.col("_m")
    t = F.lit(float(engagement_target))
    r = F.try_divide(F.col("engagement_rate"), m)
    b = F.try_divide(t, F.greatest(m, t))
    same = F.coalesce(F.col("category") == F.lit(brand_category.lower().strip()), F.lit(False))
    score = brand_similarity(r, F.col("alignment_genZ"), same, b, F.lit(float(audience_target)))
    return sort_by_score(rows.select("username", "category", _maybe_round(score, digits).alias("similarity_score")))


def rank_baseline(features: DataFrame, *, engagement_target: float = L.SCRIPT_ENGAGEMENT_TARGET,
                  hashtag_target: float = L.BRAND_HASHTAG_TARGET, digits: int | None = None) -> DataFrame:
    """Two-feature cosine of (normalised engagement, hashtag score) against
    (normalised brand engagement, brand hashtag target)."""
    rows = _with_max(features)
    m = F.col("_m")
    t = F.lit(float(engagement_target))
    r = F.try_divide(F.col("engagement_rate"), m)
    b = F.try_divide(t, F.greatest(m, t))
    score = cosine([r, F.col("hashtag_score")], [b, F.lit(float(hashtag_target))])
    return rows.select("username", _maybe_round(score, digits).alias("similarity_score"))


def brand_search(features: DataFrame, category: str, engagement_pct: float, genz_audience: str | bool, *,
                 k: int | None = L.TOP_K, domain: Sequence[str] = L.CATEGORIES,
                 digits: int | None = None) -> DataFrame:
    """The search form - category, engagement 0-100 %, Gen-Z audience yes/no."""
    if not 0 <= float(engagement_pct) <= 100:
        raise ValueError("engagement percentage must be within 0..100")
    if isinstance(genz_audience, str):
        target = 1.0 if genz_audience.strip().lower() in ("yes", "y", "true", "1") else 0.0
    else:
        target = 1.0 if genz_audience else 0.0
    return rank_in_category(features, category, engagement_target=float(engagement_pct) / 100.0,
                            audience_target=target, k=k, domain=domain, digits=digits)


GRID = 32  # cells on each axis of a category's (rate, alignment) plane


def _angle(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Angle between (x1, y1, 1) and (x2, y2, 1)."""
    cos = (x1 * x2 + y1 * y2 + 1.0) / (F.sqrt(x1 * x1 + y1 * y1 + 1.0) * F.sqrt(x2 * x2 + y2 * y2 + 1.0))
    return F.acos(F.greatest(F.least(cos, F.lit(1.0)), F.lit(-1.0)))


def _grid_rows(features: DataFrame, k: int) -> DataFrame:
    """The influencers with their place ``_r, _g`` in the category's plane and their ``_cell`` (-1: no numbers).

    Of the rows at one place only the first ``k`` by name can be among the best, so copies of one place don't pile up;
    rows whose score is null, or NaN, whatever the target count as one place each."""
    rows = normalize_category(features)
    rows = rows.join(rows.groupBy("category").agg(largest().alias("_m")), "category")
    rows = rows.select("category", "username", "engagement_rate", "alignment_genZ", "_m", F.try_divide("engagement_rate", "_m").alias("_r"),
                       F.col("alignment_genZ").cast("double").alias("_g"))
    number = lambda c: ~F.isnan(c) & (F.abs(c) < float("inf"))
    kind = F.when(F.col("_r").isNull() | F.col("_g").isNull(), 0).when(number(F.col("_r")) & number(F.col("_g")), 2).otherwise(1)
    rows = rows.withColumn("_kind", kind)
    place = [F.when(F.col("_kind") == 2, F.col(c)) for c in ("_r", "_g")]
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("category", "_kind", *place).orderBy("username"))).where(F.col("_n") <= k).drop("_n")
    rows = materialize(rows)  # scanned three times below
    numbers = rows.where("_kind = 2")
    spans = numbers.groupBy("category").agg(*[f(c).alias(f"{n}{c}") for c in ("_r", "_g") for n, f in (("lo", F.min), ("hi", F.max))])

    def step(c: str) -> Column:
        share = F.try_divide(F.col(c) - F.col(f"lo{c}"), F.col(f"hi{c}") - F.col(f"lo{c}"))
        return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * GRID), F.lit(GRID - 1)).cast("int")

    cell = F.when(F.col("_kind") == 2, step("_r") * GRID + step("_g")).otherwise(F.lit(-1))
    return rows.join(spans, "category", "left").withColumn("_cell", cell).drop("lo_r", "hi_r", "lo_g", "hi_g", "_kind")


def brand_candidates(features: DataFrame, brands: DataFrame, *, k: int = L.TOP_K, digits: int | None = None) -> DataFrame:
    """The (target, influencer) pairs that :func:`rank_for_brands` scores.

    In a category the score depends on two numbers, so influencers are dealt to the cells of a grid over that plane.  The
    angle between a target and a cell's middle, and the cell's angular radius, bound the scores of its rows from both
    sides.  A target's cells by falling lower bound, until they hold ``k`` rows, give a score that its k-th best reaches;
    only cells whose upper bound reaches it are joined, by (category, cell).  Exact: bounds are widened by more than the
    rounding of the arithmetic and of ``digits``; targets without numbers meet all cells."""
    rows = _grid_rows(features, k)
    x = lambda c: (F.col(f"lo{c}") + F.col(f"hi{c}")) / 2
    corners = [_angle(x("_r"), x("_g"), F.col(f"{i}_r"), F.col(f"{j}_g")) for i in ("lo", "hi") for j in ("lo", "hi")]
    cells = (rows.groupBy("category", "_cell", "_m").agg(F.count(F.lit(1)).alias("_rows"), *[f(c).alias(f"{n}{c}") for c in ("_r", "_g") for n, f in (("lo", F.min), ("hi", F.max))])
             .withColumn("_wide", F.greatest(*corners)))
    wanted = brands.select(F.lower(F.trim("category")).alias("category"), F.col("intended_engagement_rate").cast("double").alias("_t"),
                           F.col("target_audience_genZ").cast("double").alias("_a")).distinct()
    met = cells.join(wanted, "category").withColumn("_b", F.try_divide("_t", F.greatest("_m", "_t")))
    off = _angle(F.col("_b"), F.col("_a"), x("_r"), x("_g"))
    sure = (F.col("_cell") >= 0) & (F.col("_wide") < 1.5) & ~F.isnan(off)
    slack = 1e-7 + (0.0 if digits is None else 10.0 ** -digits)
    met = met.withColumns({"_low": F.when(sure, F.cos(F.least(off + F.col("_wide"), F.lit(3.2))) - 1e-7), "_high": F.when(sure, F.cos(F.greatest(off - F.col("_wide"), F.lit(0.0))) + slack)})
    target = Window.partitionBy("category", "_t", "_a")
    met = met.withColumn("_held", F.sum(F.when(F.col("_low").isNotNull(), F.col("_rows"))).over(target.orderBy(F.desc_nulls_last("_low"), "_cell")))
    met = met.withColumn("_least", F.max(F.when(F.col("_held") >= k, F.col("_low"))).over(target))
    kept = met.where(F.coalesce(F.col("_high") >= F.col("_least"), F.lit(True))).select("category", "_cell", "_t", "_a", "_b")
    return rows.join(kept, ["category", "_cell"])


def rank_for_brands(features: DataFrame, brands: DataFrame, *, k: int = L.TOP_K,
                    digits: int | None = None) -> DataFrame:
    """R1 for many brands at once (J7 as an equi-join on category and cell).

    ``brands``: ``brand_id, category, intended_engagement_rate,
    target_audience_genZ``.  Brands that want the same (category, rate,
    audience) get the same ranking, so the distinct targets meet the influencers
    of the cells that can hold their k best (:func:`brand_candidates`), are cut
    to k rows each, and the brands join these.  Output ``brand_id, username,
    similarity_score, rank``.
    """
    target = ["category", "_t", "_a"]
    b = brands.select("brand_id", F.lower(F.trim("category")).alias("category"),
                      F.col("intended_engagement_rate").cast("double").alias("_t"),
                      F.col("target_audience_genZ").cast("double").alias("_a"))
    cand = brand_candidates(features, brands, k=k, digits=digits)
    score = brand_similarity(F.col("_r"), F.col("alignment_genZ"), F.lit(True), F.col("_b"), F.col("_a"))
    scored = cand.select(F.struct(*target).alias("_target"), "username", _maybe_round(score, digits).alias("similarity_score"))
    best = top_k_per(scored, "_target", k)
    return (b.withColumn("_target", F.struct(*target)).join(best, "_target")
            .select("brand_id", "username", "similarity_score", "rank"))


# ---------------------------------------------------------------- P20
def display_rows(ranked: DataFrame, prefix: str = L.PROFILE_URL_PREFIX) -> DataFrame:
    """P20: profile link and the score to two decimals for each ranked row."""
    return ranked.select("username", profile_url(F.col("username"), prefix).alias("profile_url"),
                         format_score(F.col("similarity_score"), 2).alias("score_display"))
