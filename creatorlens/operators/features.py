"""Per-influencer features.

Every feature is one plan: posts are reduced per key with a partial + final
aggregate (a hot user costs one hash-map slot per partition, not a big group)
and only then joined to the influencer list, so the join sees one row per user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creatorlens import lexicons as L
from creatorlens.functions.json import json_double, json_string, json_string_array
from creatorlens.functions.text import (
    clean_text, count_present, keyword_token_count, occurrence_total, tokens,
)
from creatorlens.operators.sentiment import score_texts


# ---------------------------------------------------------------- J2 helpers
def prefix_keys(df: DataFrame, key: str, out: str = "username") -> DataFrame:
    """J2 prefix mode as an equi-join input: one row per prefix of ``key``.

    ``startswith(key, username)`` is a theta join (nested loop); expanding each
    distinct key into its ``length(key)`` prefixes turns it into a hash/sort-merge
    equi-join on ``out``.
    """
    return df.withColumn(out, F.explode(F.expr(
        f"transform(sequence(1, greatest(length(`{key}`), 1)), i -> substring(`{key}`, 1, i))")))


def match_to_influencers(per_key: DataFrame, influencers: DataFrame, *, key: str = "username",
                         sums: Sequence[str], match: str = "exact", how: str = "left") -> DataFrame:
    """Attach per-key partial sums to influencers.

    ``match="exact"`` joins ``key == username``.  ``match="prefix"`` reproduces
    the ``{username}*`` file glob: every key whose text starts with the user
    name belongs to that user (so ``anna`` also collects ``annabel``'s files).
    """
    if match == "exact":
        stats = per_key.withColumnRenamed(key, "username") if key != "username" else per_key
    elif match == "prefix":
        # the prefixes are summed per task before they travel, so a one-letter prefix is one row per task
        stats = (prefix_keys(per_key.withColumnRenamed(key, "_file_key"), "_file_key", "username")
                 .groupBy("username").agg(*[F.sum(c).alias(c) for c in sums])
                 .join(influencers.select("username").distinct(), "username", "left_semi"))
    else:
        raise ValueError(f"match must be 'exact' or 'prefix', got {match!r}")
    return influencers.join(stats, "username", how)


# ---------------------------------------------------------------- A1 / P5 / P6
def post_likes(posts: DataFrame, *, key: str = "username", value: str = "value",
               like_path: str = "$.like_count") -> DataFrame:
    """F10 per post, then partial+final sum/count per key."""
    return (posts.select(F.col(key).alias(key), json_double(value, like_path).alias("likes"))
            .groupBy(key).agg(F.sum("likes").alias("sum_likes"), F.count(F.lit(1)).alias("n_posts")))


def engagement_rate_expr(followers: Column, sum_likes: Column, n_posts: Column) -> Column:
    """Mean of ``likes / followers * 100`` over a user's posts, 0.0 when
    followers is not positive (or unknown); NULL when the user has no posts."""
    mean_likes = F.try_divide(sum_likes, n_posts.cast("double"))
    return F.when(followers > 0, mean_likes / followers * 100.0).otherwise(F.lit(0.0))


def engagement_rates(influencers: DataFrame, posts: DataFrame, *, key: str = "username",
                     value: str = "value", like_path: str = "$.like_count",
                     match: str = "exact") -> DataFrame:
    """A1: ``(username, engagement_rate)`` for every influencer row.

    ``influencers`` needs ``username, followers``; ``posts`` a key column and a
    raw JSON line.  Malformed posts count as 0 likes (F10).
    """
    stats = post_likes(posts, key=key, value=value, like_path=like_path)
    joined = match_to_influencers(stats, influencers.select("username", "followers"), key=key,
                                  sums=["sum_likes", "n_posts"], match=match)
    return joined.select("username", engagement_rate_expr(F.col("followers"), F.col("sum_likes"),
                                                           F.col("n_posts")).alias("engagement_rate"))


# ---------------------------------------------------------------- U4 / A2
def post_texts(posts: DataFrame, *, key: str = "username", value: str = "value",
               id_col: str | None = None) -> DataFrame:
    """U4 + A2: the caption and every comment of each post as one long text
    stream ``(text_id, username, kind, text)``.

    This is the gathered form of a user's texts.  Rows are never collected
    into per-user arrays: a user with a third of all posts would otherwise
    become one giant row in one task.
    """
    # one scan; each JSON is read into its parts once, and these become one list per post.  Without an
    # id column a post is named by its user and line, so ids do not depend on files or retries
    own = F.col(id_col).cast("string") if id_col else F.sha2(F.concat_ws("\n", F.col(key).cast("string"), F.col(value)), 256)
    base = posts.select(F.col(key).alias("username"), own.alias("post_id"),
                        json_string(value, "$.caption").alias("caption"),
                        json_string_array(value, "$.comments").alias("comments"))
    caption = F.array(F.struct(F.lit("c").alias("part"), F.lit("caption").alias("kind"), F.col("caption").alias("text")))
    comments = F.transform(F.coalesce("comments", F.array().cast("array<string>")), lambda t, i: F.struct(
        i.cast("string").alias("part"), F.lit("comment").alias("kind"), t.alias("text")))
    return (base.select("username", "post_id", F.explode(F.concat(caption, comments)).alias("t")).where(F.col("t.text").isNotNull())
            .select("username", F.concat_ws(":", "post_id", "t.part").alias("text_id"), "t.kind", "t.text"))


def text_counts(texts: DataFrame) -> DataFrame:
    """A4: captions, comments and total texts per user."""
    return texts.groupBy("username").agg(
        F.count_if(F.col("kind") == "caption").alias("n_captions"),
        F.count_if(F.col("kind") == "comment").alias("n_comments"),
        F.count(F.lit(1)).alias("n_texts"))


# ---------------------------------------------------------------- T3 / T4
def trait_count(text: Column, *, keywords: Sequence[str] = L.GENZ_KEYWORDS,
                emojis: Sequence[str] = L.GENZ_EMOJIS, hashtags: Sequence[str] = L.GENZ_HASHTAGS,
                mode: str = "intent", lowered: Column | None = None) -> Column:
    """Keyword tokens + emoji occurrences + distinct hashtags present.

    ``mode="intent"``: keywords on the cleaned text, emojis and hashtags on the
    lower-cased raw text.  ``mode="literal"``: cleaning removes ``#`` and emoji
    before they are searched, so only keyword tokens can count.
    """
    kw = keyword_token_count(tokens(clean_text(text)), keywords)
    if mode == "literal":
        return kw
    if mode != "intent":
        raise ValueError("mode must be 'intent' or 'literal'")
    return (kw + occurrence_total(text, emojis, case_insensitive=True, lowered=lowered)
            + count_present(text, hashtags, case_insensitive=True, lowered=lowered))


def hashtag_count(text: Column, *, hashtags: Sequence[str] = L.GENZ_HASHTAGS, mode: str = "intent",
                  lowered: Column | None = None) -> Column:
    """T4: distinct hashtags present (``literal`` mode searches the cleaned text)."""
    if mode == "intent":
        return count_present(text, hashtags, case_insensitive=True, lowered=lowered)
    return count_present(clean_text(text), hashtags)


# ---------------------------------------------------------------- A5 / A6 / A7 / P7
def collapse_above(score: Column, threshold: float = L.ALIGNMENT_THRESHOLD) -> Column:
    """Scores above ``threshold`` become 1.0, others stay."""
    return F.when(score > threshold, F.lit(1.0)).otherwise(score)


def scored_texts(texts: DataFrame, lexicon: DataFrame, *, keywords=L.GENZ_KEYWORDS,
                 emojis=L.GENZ_EMOJIS, hashtags=L.GENZ_HASHTAGS, mode: str = "intent",
                 negators=("not",)) -> DataFrame:
    """Per text: traits (T3), hashtags (T4) and polarity (T6).  The lower-cased
    text is computed once in its own projection and shared by every term."""
    t, low = F.col("text"), F.col("_low")
    staged = texts.select("text_id", "username", "kind", "text", F.lower(t).alias("_low"))
    return score_texts(staged, lexicon, id_col="text_id", carry=["username", "kind"],
                       extra={"traits": trait_count(t, keywords=keywords, emojis=emojis,
                                                    hashtags=hashtags, mode=mode, lowered=low),
                              "hashtags": hashtag_count(t, hashtags=hashtags, mode=mode, lowered=low)},
                       negators=negators)


def alignment_scores(scored: DataFrame, *, threshold: float | None = L.ALIGNMENT_THRESHOLD) -> DataFrame:
    """A5 + A6 (+ P7): ``(username, alignment_genZ)``.

    alignment = (sum of traits + positive ratio * 100) / number of texts, with
    positive ratio = texts with polarity > 0 / max(number of texts, 1).
    """
    g = scored.groupBy("username").agg(
        F.sum("traits").alias("_traits"), F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("polarity") > 0).alias("_pos"))
    ratio = F.col("_pos") / F.greatest(F.col("_n"), F.lit(1))
    score = F.try_divide(F.col("_traits") + ratio * 100.0, F.col("_n").cast("double"))
    if threshold is not None:
        score = collapse_above(score, threshold)
    return g.select("username", score.alias("alignment_genZ"))


def hashtag_scores(scored: DataFrame) -> DataFrame:
    """``(username, hashtag_score)`` over captions only:
    (hashtags present + positive ratio * 100) / number of captions."""
    g = scored.where(F.col("kind") == "caption").groupBy("username").agg(
        F.sum("hashtags").alias("_tags"), F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("polarity") > 0).alias("_pos"))
    ratio = F.col("_pos") / F.greatest(F.col("_n"), F.lit(1))
    return g.select("username", F.try_divide(F.col("_tags") + ratio * 100.0,
                                             F.col("_n").cast("double")).alias("hashtag_score"))


# ---------------------------------------------------------------- J1
def merge_features(engagement: DataFrame, alignment: DataFrame, hashtags: DataFrame,
                   categories: DataFrame | None = None) -> DataFrame:
    """Inner join of the three feature sets on one ``username`` column,
    plus the influencer ``category`` when a category table is given."""
    out = engagement.join(alignment, "username").join(hashtags, "username")
    if categories is not None:
        out = out.join(categories.select("username", "category"), "username")
    return out
