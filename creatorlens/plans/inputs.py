"""Adapters: the driver's tables viewed as the reference's inputs (FIXTURES.md §2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creatorlens.functions.json import json_double
from creatorlens.operators.features import collapse_above, engagement_rate_expr, engagement_rates
from creatorlens.session import literal_frame, materialize, scratch_path
from creatorlens.sources.sinks import write_parquet
from creatorlens.sources.readers import read_table

# test-data parameters (see FIXTURES.md §2)
LIKE_PATH = "$.k"
ALIGNMENT_COLLAPSE = 50.0
RANK_CATEGORY = "building"
BRAND_CATEGORY = "household"
ROUND = 6


def test_categories(spark: SparkSession | None = None) -> list[str]:
    """The category domain of the test data: ``lower(c_mktsegment)``."""
    return ["automobile", "building", "furniture", "household", "machinery"]


def influencers(spark: SparkSession, d: str) -> DataFrame:
    """customer as influencers: key c_custkey, followers = int(c_acctbal) (truncating)."""
    return read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("username"), F.col("c_name"),
        F.lower(F.col("c_mktsegment")).alias("category"),
        F.col("c_acctbal").try_cast("int").alias("followers"))


def posts(spark: SparkSession, d: str) -> DataFrame:
    """events as posts: one JSON line each; error events carry an unreadable line."""
    return read_table(spark, d, "events").select(
        F.col("user_id").alias("username"), F.col("event_id"), F.col("event_type"), F.col("value").alias("amount"),
        F.when(F.col("event_type") == "error", F.lit("oops")).otherwise(F.col("props")).alias("value"))


def engagement(spark: SparkSession, d: str) -> DataFrame:
    return engagement_rates(influencers(spark, d), posts(spark, d), like_path=LIKE_PATH)


def alignment_from_events(spark: SparkSession, d: str) -> DataFrame:
    """alignment_genZ = avg(events.value) per user, collapsed to 1 above 50."""
    return (read_table(spark, d, "events").groupBy(F.col("user_id").alias("username"))
            .agg(collapse_above(F.avg("value"), ALIGNMENT_COLLAPSE).alias("alignment_genZ")))


def hashtag_from_events(spark: SparkSession, d: str) -> DataFrame:
    """hashtag_score = percentage of click events per user."""
    return (read_table(spark, d, "events").groupBy(F.col("user_id").alias("username"))
            .agg((F.count_if(F.col("event_type") == "click") * 100.0 / F.count(F.lit(1))).alias("hashtag_score")))


def feature_table(spark: SparkSession, d: str) -> DataFrame:
    """The feature table written once as parquet partitioned by category in
    the shared folder (the ranking queries scan it more than once - maximum,
    then scores - and a category filter only reads that category's files)."""
    path = scratch_path(spark, "feature-table")
    write_parquet(features(spark, d), path, partition_by=["category"])
    return spark.read.parquet(path)


def features(spark: SparkSession, d: str) -> DataFrame:
    """The merged feature table: customers with events only, keyed by c_name.

    All three per-user features come out of ONE partial/final aggregate over
    events (one scan, one shuffle of one row per user per partition), then a
    single join with the customer table.
    """
    per_user = posts(spark, d).groupBy("username").agg(
        F.sum(json_double("value", LIKE_PATH)).alias("sum_likes"),
        F.count(F.lit(1)).alias("n_posts"),
        F.avg("amount").alias("avg_amount"),
        F.count_if(F.col("event_type") == "click").alias("n_click"))
    joined = per_user.join(influencers(spark, d), "username")
    return joined.select(
        F.col("c_name").alias("username"), "category",
        engagement_rate_expr(F.col("followers"), F.col("sum_likes"), F.col("n_posts")).alias("engagement_rate"),
        collapse_above(F.col("avg_amount"), ALIGNMENT_COLLAPSE).alias("alignment_genZ"),
        (F.col("n_click") * 100.0 / F.col("n_posts")).alias("hashtag_score"))


# ---------------------------------------------------------------- text inputs
# test lexicons: words and markers that occur in the generated texts
TEST_KEYWORDS = ["that", "with", "this", "from"]
TEST_MARKERS = ["***", "%%%"]                      # stand-ins for emoji sequences
TEST_HASHTAGS = ["###", "$$$", "@mail", ".com"]
TEST_SENTIMENT = {
    "the": 0.3, "and": 0.5, "of": -0.2, "de": -0.4, "der": 0.6, "is": 0.1,
    "la": -0.7, "die": -0.5, "que": 0.4, "und": 0.2, "good": 0.7, "bad": -0.7,
}
TEST_NEGATORS = ("not", "to", "in")


def documents(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents")


def conversation_texts(spark: SparkSession, d: str) -> DataFrame:
    """conversations as texts: conv_id = user, user turns = captions,
    all other turns = comments (U4)."""
    c = read_table(spark, d, "conversations")
    return c.select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("text_id"),
                    F.col("conv_id").alias("username"),
                    F.when(F.col("role") == "user", F.lit("caption")).otherwise(F.lit("comment")).alias("kind"),
                    F.col("text"))


def sentiment_lexicon(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, sorted(TEST_SENTIMENT.items()), "word string, polarity double")


# ---------------------------------------------------------------- catalogue inputs
TEST_RULES = [(1, "fitness", "ring"), (1, "fitness", "Gear"), (2, "beauty", "red"), (2, "beauty", "gizmo"),
              (2, "beauty", "PLATE")]
TEST_EXCLUSIONS = ["small ring", "red widget", "blue bolt", "hot gear"]


def category_trees(spark: SparkSession, d: str) -> DataFrame:
    """JSON tree documents ``(doc_id, json)``: one per region with its nations
    below it (a handful), and one per supplier, whose node lies below a node
    without a title.  Every name occurs once, and no document grows with the data."""
    def node(alias, title=None, children=None):
        fields = [alias.alias("alias")]
        if title is not None:
            fields.append(F.struct(title.alias("title")).alias("content"))
        if children is not None:
            fields.append(children.alias("children"))
        return F.struct(*fields)

    def document(prefix, key, root):
        return F.concat(F.lit(prefix), key.cast("string")).alias("doc_id"), F.to_json(F.struct(F.array(root).alias("navigation"))).alias("json")

    nations = read_table(spark, d, "nation").groupBy("n_regionkey").agg(
        F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("nations"))
    region = read_table(spark, d, "region")
    regions = region.join(nations, region.r_regionkey == nations.n_regionkey, "left")
    below = F.transform(F.coalesce("nations", F.array().cast("array<struct<n_nationkey:bigint,n_name:string>>")), lambda n: node(n["n_name"], n["n_name"]))
    top = regions.select(*document("r", F.col("r_regionkey"), node(F.col("r_name"), F.col("r_name"), below)))
    supplier = read_table(spark, d, "supplier")
    leaf = node(F.col("s_name"), F.col("s_name"))
    return top.unionByName(supplier.select(*document("s", F.col("s_suppkey"), node(F.lit("supplier"), None, F.array(leaf)))))


def part_titles(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part").select(F.col("p_partkey"), F.col("p_name").alias("title"))


# ---------------------------------------------------------------- lexicons with phrases and modifiers
#: (phrase, polarity, intensity, negates) over words of the generated texts
TEST_MODIFIED = [
    ("the", 0.3, None, False), ("and", 0.5, None, False), ("of", -0.2, None, False), ("of the", -0.6, None, False),
    ("que", 0.4, None, False), ("la", -0.7, None, False), ("de la", 0.9, None, False), ("der", 0.6, None, False),
    ("die", -0.5, None, False), ("und die", 0.8, None, False), ("is", 0.1, None, False),
    ("in", None, 1.3, False), ("to", None, 0.5, False), ("und", None, 1.5, False), ("et", None, 2.0, False),
    ("that", None, None, True), ("from", None, None, True), ("le", None, None, True), ("zu", None, None, True),
]


def modified_lexicon(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, TEST_MODIFIED, "phrase string, polarity double, intensity double, negates boolean")


def phrase_lexicon(spark: SparkSession, d: str) -> DataFrame:
    """(phrase, exact): the keyword lexicon, the first three words of every benchmark item in any case, and its first
    two as they are written."""
    from creatorlens import lexicons as L
    from creatorlens.operators.phrases import cased_tokens, keyword_entries
    words = read_table(spark, d, "benchmark").select(cased_tokens(F.col("text")).alias("w"))
    planted = words.select(F.explode(F.array(F.struct(F.array_join(F.slice("w", 1, 3), " ").alias("phrase"), F.lit(False).alias("exact")),
                                             F.struct(F.array_join(F.slice("w", 1, 2), " ").alias("phrase"), F.lit(True).alias("exact")))).alias("e")).select("e.*")
    return keyword_entries(spark, L.GENZ_KEYWORDS).unionByName(planted)


def term_table(spark: SparkSession, d: str) -> DataFrame:
    """A substring lexicon stored as a table: the blank-delimited words of the benchmark items, lower-cased."""
    words = F.split(F.lower("text"), r"[ \t-\r]+")
    return read_table(spark, d, "benchmark").select(F.explode(words).alias("term")).where("term <> ''").distinct()


def rule_table(spark: SparkSession, d: str) -> DataFrame:
    """Title rules stored as a table: the first word of every part's name, for its brand, at its least size."""
    part = read_table(spark, d, "part").select(F.substring_index("p_name", " ", 1).alias("keyword"), F.col("p_brand").alias("category"), "p_size")
    return part.groupBy("category", "keyword").agg(F.min("p_size").alias("priority")).select("priority", "category", "keyword")
