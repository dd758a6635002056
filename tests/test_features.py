"""A1 / J2 / A6 / A7 on hand-made fixtures with edge rows."""

import pytest
from pyspark.sql import functions as F

from creatorlens.operators import features as feat
from creatorlens.operators.sentiment import lexicon_frame, score_texts


@pytest.fixture()
def influencers(spark):
    return spark.createDataFrame(
        [("anna", 100), ("annabel", 50), ("bob", 0), ("carl", -5), ("dora", None), ("eve", 10)],
        "username string, followers int")


@pytest.fixture()
def posts(spark):
    return spark.createDataFrame(
        [("anna", '{"like_count": 10}'), ("anna", '{"like_count": "30"}'), ("anna", "oops"),
         ("annabel", '{"like_count": 5}'), ("bob", '{"like_count": 7}'), ("carl", '{"like_count": 9}'),
         ("dora", '{"like_count": 1}'), ("zed", '{"like_count": 99}')],
        "username string, value string")


def test_engagement_exact(influencers, posts):
    got = {r["username"]: r["engagement_rate"] for r in feat.engagement_rates(influencers, posts).collect()}
    assert got["anna"] == pytest.approx((10 + 30 + 0) / 3 / 100 * 100)
    assert got["annabel"] == pytest.approx(5 / 50 * 100)
    assert got["bob"] == 0.0 and got["carl"] == 0.0 and got["dora"] == 0.0
    assert got["eve"] is None            # no posts at all
    assert "zed" not in got              # posts of unknown users are ignored


def test_engagement_prefix_glob(influencers, posts):
    got = {r["username"]: r["engagement_rate"] for r in
           feat.engagement_rates(influencers, posts, match="prefix").collect()}
    # "anna*" also collects annabel's post
    assert got["anna"] == pytest.approx((10 + 30 + 0 + 5) / 4 / 100 * 100)
    assert got["annabel"] == pytest.approx(10.0)


def test_alignment_and_hashtag_scores(spark):
    texts = spark.createDataFrame([
        ("t1", "u1", "caption", "so good vibe #viral 🔥🔥"),
        ("t2", "u1", "comment", "not good at all"),
        ("t3", "u1", "comment", "bad bad"),
        ("t4", "u2", "caption", ""),
    ], "text_id string, username string, kind string, text string")
    lex = lexicon_frame(spark, {"good": 0.7, "bad": -0.7})
    scored = feat.scored_texts(texts, lex, keywords=["vibe", "so"], emojis=["🔥"], hashtags=["#viral", "#art"])
    by_id = {r["text_id"]: r for r in scored.collect()}
    assert by_id["t1"]["traits"] == 2 + 2 + 1
    assert by_id["t1"]["polarity"] == pytest.approx(0.7)
    assert by_id["t2"]["polarity"] == pytest.approx(-0.35)      # negated
    assert by_id["t3"]["polarity"] == pytest.approx(-0.7)
    assert by_id["t4"]["polarity"] == 0.0
    al = {r["username"]: r["alignment_genZ"] for r in feat.alignment_scores(scored).collect()}
    # u1: traits 5, 1 positive of 3 texts -> (5 + 100/3) / 3 = 12.78 (not above 30)
    assert al["u1"] == pytest.approx((5 + 100 / 3) / 3)
    assert al["u2"] == 0.0
    hs = {r["username"]: r["hashtag_score"] for r in feat.hashtag_scores(scored).collect()}
    assert hs["u1"] == pytest.approx((1 + 100.0) / 1)


def test_literal_mode_never_exceeds_intent(spark):
    df = spark.createDataFrame([("#viral 🔥 vibe",), ("vibe vibe",), ("",)], "t string")
    r = df.select(feat.trait_count(F.col("t"), keywords=["vibe"], emojis=["🔥"], hashtags=["#viral"], mode="literal").alias("l"),
                  feat.trait_count(F.col("t"), keywords=["vibe"], emojis=["🔥"], hashtags=["#viral"]).alias("i")).collect()
    assert all(x["l"] <= x["i"] for x in r)
    assert [x["i"] for x in r] == [3, 2, 0]


def test_score_texts_keeps_texts_without_tokens(spark):
    texts = spark.createDataFrame([("a", "!!!"), ("b", None)], "text_id string, text string")
    out = score_texts(texts, lexicon_frame(spark, {"x": 1.0}), id_col="text_id").collect()
    assert sorted((r["text_id"], r["polarity"]) for r in out) == [("a", 0.0), ("b", 0.0)]


def test_post_texts_caption_and_comments(spark):
    posts = spark.createDataFrame([
        ("u1", '{"caption": "Hi", "comments": ["a", "b"]}'), ("u1", '{"caption": null, "comments": []}'),
        ("u2", "bad json"), ("u2", '{"comments": ["only"]}')], "username string, value string")
    t = feat.post_texts(posts).collect()
    got = sorted((r["username"], r["kind"], r["text"]) for r in t)
    assert got == [("u1", "caption", "Hi"), ("u1", "comment", "a"), ("u1", "comment", "b"), ("u2", "comment", "only")]
    counts = {r["username"]: tuple(r[1:]) for r in feat.text_counts(feat.post_texts(posts)).collect()}
    assert counts == {"u1": (1, 2, 3), "u2": (0, 1, 1)}


def _brute_polarity(text, lex, negators=("not",)):
    words = tokens_of(text)
    hit = [lex[w] * (-0.5 if i and words[i - 1] in negators else 1.0) for i, w in enumerate(words) if w in lex]
    return sum(hit) / len(hit) if hit else 0.0


def tokens_of(text):
    return [w.strip("!,.").lower() for w in (text or "").split() if w.strip("!,.")]


@pytest.mark.parametrize("filler", [0, 62, 63, 500])
def test_sentiment_is_the_same_for_lexicons_of_any_size(spark, filler):
    """Texts that share an id or their words keep a row each; entries without word or polarity count for nothing."""
    rows = [("t1", "good good not bad"), ("t2", "not good"), ("t3", ""), ("t4", None), ("t5", "BAD news, good!"), ("t1", "bad"), ("t1", "bad"), (None, "good")]
    texts = spark.createDataFrame(rows, "text_id string, text string")
    own = {"good": 0.7, "bad": -0.7, **{f"w{i}": 1.0 for i in range(filler)}}
    entries = [*own.items(), ("Good", 0.5), (None, 1.0), ("news", None)]
    got = sorted([(r["text_id"] or "", round(r["polarity"], 9)) for r in score_texts(texts, lexicon_frame(spark, entries), id_col="text_id").collect()])
    lex = {**own, "good": 0.6}                             # duplicate lexicon words are averaged
    assert got == sorted([(i or "", round(_brute_polarity(t, lex), 9)) for i, t in rows])
