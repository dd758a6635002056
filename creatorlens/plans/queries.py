"""Registered queries over the driver's tables: ``QUERIES[name](spark, sf_dir)``.

Names carry the SURVEY §2 operator IDs they exercise.  Every query reads the
given tables in full; floating results are rounded to ``ROUND`` digits so the
DuckDB oracle (``plans/oracle.py``) can compare values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creatorlens.operators import features as feat
from creatorlens.operators import rank
from creatorlens.plans import inputs as I
from creatorlens.session import literal_frame, materialize
from creatorlens.sources.readers import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _r(c, digits: int = I.ROUND):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# ------------------------------------------------------------------ features
@register("a1_engagement_rate")
def a1_engagement_rate(spark, d):
    """A1/F10/P5/P6/S4-equivalent: mean engagement per influencer (all customers)."""
    return I.engagement(spark, d).select("username", _r("engagement_rate").alias("engagement_rate"))


@register("j1_merge_features")
def j1_merge_features(spark, d):
    """Three separately computed per-user features joined on one key."""
    out = feat.merge_features(I.engagement(spark, d), I.alignment_from_events(spark, d),
                              I.hashtag_from_events(spark, d))
    return out.select("username", _r("engagement_rate").alias("engagement_rate"),
                      _r("alignment_genZ").alias("alignment_genZ"), _r("hashtag_score").alias("hashtag_score"))


@register("j2_prefix_match")
def j2_prefix_match(spark, d):
    """J2 prefix mode: each source name collects the documents of every source
    it is a prefix of (src1 also takes src10..src19)."""
    docs = read_table(spark, d, "documents")
    per_key = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_posts"), F.sum("n_chars").alias("sum_chars"))
    users = docs.select(F.col("source").alias("username")).distinct()
    out = feat.match_to_influencers(per_key, users, key="source", sums=["n_posts", "sum_chars"],
                                    match="prefix", how="inner")
    return out.select("username", "n_posts", "sum_chars")


@register("j2_exact_match")
def j2_exact_match(spark, d):
    """J2 exact mode (default): documents per source by equality."""
    docs = read_table(spark, d, "documents")
    per_key = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_posts"), F.sum("n_chars").alias("sum_chars"))
    users = docs.select(F.col("source").alias("username")).distinct()
    out = feat.match_to_influencers(per_key, users, key="source", sums=["n_posts", "sum_chars"], how="inner")
    return out.select("username", "n_posts", "sum_chars")


# ------------------------------------------------------------------ ranking
@register("r1_rank_category")
def r1_rank_category(spark, d):
    """Top 15 of one category."""
    return rank.rank_in_category(I.feature_table(spark, d), I.RANK_CATEGORY, domain=I.test_categories(),
                                 digits=I.ROUND)


@register("r2_rank_all")
def r2_rank_all(spark, d):
    """R2: whole table against one brand, learned one-hot."""
    return rank.rank_all(I.feature_table(spark, d), I.BRAND_CATEGORY, digits=I.ROUND)


@register("r3_rank_baseline")
def r3_rank_baseline(spark, d):
    """(engagement, hashtag score) baseline."""
    return rank.rank_baseline(I.feature_table(spark, d), digits=I.ROUND)


@register("r4_brand_search")
def r4_brand_search(spark, d):
    """Search form - machinery, 40 % engagement, Gen-Z audience yes."""
    return rank.brand_search(I.feature_table(spark, d), "machinery", 40, "yes", domain=I.test_categories(),
                             digits=I.ROUND)


BRANDS = [(1, "building", 0.5, 1), (2, "furniture", 0.3, 0), (3, "automobile", 0.8, 1)]


@register("r4_many_brands")
def r4_many_brands(spark, d):
    """R1 for three brands at once: equi-join on category, top 15 per brand."""
    brands = literal_frame(spark, BRANDS, "brand_id int, category string, intended_engagement_rate double, "
                                          "target_audience_genZ int")
    return rank.rank_for_brands(I.feature_table(spark, d), brands, digits=I.ROUND).select(
        "brand_id", "username", "similarity_score", F.col("rank").cast("bigint").alias("rank"))


@register("j7_grid_pairs")
def j7_grid_pairs(spark, d):
    """Per category, the pairs of influencers and ten targets, and whether the best three were found with half of them."""
    rows = rank.normalize_category(I.feature_table(spark, d)).where("category is not null")
    targets = F.array(*[F.struct(F.lit(i / 10).alias("intended_engagement_rate"), F.lit(i % 2).alias("target_audience_genZ")) for i in range(10)])
    brands = rows.select("category").distinct().select("category", F.inline(targets))
    scored = rank.brand_candidates(rows, brands, k=3).groupBy("category").agg(F.count(F.lit(1)).alias("n_scored"))
    sizes = rows.groupBy("category").agg((F.count(F.lit(1)) * 10).alias("n_pairs"))
    return sizes.join(scored, "category").select("category", "n_pairs", (F.col("n_scored") * 2 < F.col("n_pairs")).alias("pruned"))


@register("k3_page")
def k3_page(spark, d):
    """K3: second page (rows 16-30) of the R2 ranking."""
    return rank.page(rank.rank_all(I.feature_table(spark, d), I.BRAND_CATEGORY, digits=I.ROUND), 1)


@register("p20_display")
def p20_display(spark, d):
    """Profile link and two-decimal score of the R1 rows."""
    r1 = rank.rank_in_category(I.feature_table(spark, d), I.RANK_CATEGORY, domain=I.test_categories(),
                               digits=I.ROUND)
    return rank.display_rows(r1)


# ------------------------------------------------------------------ text
from creatorlens.functions import text as T  # noqa: E402
from creatorlens.operators import lexicon as lex  # noqa: E402
from creatorlens.operators import sentiment as sent  # noqa: E402


@register("t1_clean_text")
def t1_clean_text(spark, d):
    """T1 (F1-F4): URLs, mentions and non-letters removed, lower-cased."""
    return I.documents(spark, d).select("doc_id", T.clean_text(F.col("text")).alias("clean"))


@register("t2_tokens")
def t2_tokens(spark, d):
    """White-space tokens of the cleaned text."""
    toks = T.tokens(T.clean_text(F.col("text")))
    return I.documents(spark, d).select("doc_id", F.size(toks).alias("n_tokens"),
                                         F.array_join(toks, " ").alias("token_text"))


@register("j4_keyword_tokens")
def j4_keyword_tokens(spark, d):
    """J4 (T3 literal mode): tokens that are lexicon keywords, per document."""
    return I.documents(spark, d).select(
        "doc_id", feat.trait_count(F.col("text"), keywords=I.TEST_KEYWORDS, mode="literal").alias("n_keywords"))


def _lowered_documents(spark, d):
    """documents with the lower-cased text computed once (shared by every term)."""
    return I.documents(spark, d).select("doc_id", "text", F.lower("text").alias("_low"))


@register("j5_hashtag_presence")
def j5_hashtag_presence(spark, d):
    """Distinct lexicon terms present in the lower-cased raw text."""
    return _lowered_documents(spark, d).select(
        "doc_id", feat.hashtag_count(F.col("text"), hashtags=I.TEST_HASHTAGS, lowered=F.col("_low")).alias("n_hashtags"))


@register("f15_sequence_occurrences")
def f15_sequence_occurrences(spark, d):
    """occurrences of whole multi-character sequences (emoji lexicon + markers)."""
    from creatorlens import lexicons as LX
    return _lowered_documents(spark, d).select(
        "doc_id", T.occurrence_total(F.col("text"), LX.GENZ_EMOJIS + I.TEST_MARKERS, case_insensitive=True,
                                     lowered=F.col("_low")).alias("n_sequences"))


@register("t3_trait_count")
def t3_trait_count(spark, d):
    """T3 intent mode: keyword tokens + sequence occurrences + distinct hashtags."""
    return _lowered_documents(spark, d).select(
        "doc_id", feat.trait_count(F.col("text"), keywords=I.TEST_KEYWORDS, emojis=I.TEST_MARKERS,
                                   hashtags=I.TEST_HASHTAGS, lowered=F.col("_low")).alias("traits"))


@register("a10_term_frequency")
def a10_term_frequency(spark, d):
    """Corpus frequency of the union lexicon, zero counts dropped."""
    terms = [t for _, t in lex.lexicon_union(I.TEST_KEYWORDS, I.TEST_MARKERS, I.TEST_HASHTAGS)]
    return lex.term_frequency(I.documents(spark, d), terms)


# ------------------------------------------------------------------ sentiment / alignment
def _scored_conversations(spark, d):
    return feat.scored_texts(I.conversation_texts(spark, d), I.sentiment_lexicon(spark),
                             keywords=I.TEST_KEYWORDS, emojis=I.TEST_MARKERS, hashtags=I.TEST_HASHTAGS,
                             negators=I.TEST_NEGATORS)


@register("t6_polarity")
def t6_polarity(spark, d):
    """Lexicon polarity per text (negator before a word flips it by -0.5)."""
    s = _scored_conversations(spark, d)
    return s.select("text_id", _r("polarity").alias("polarity"), sent.is_positive("polarity").alias("positive"))


@register("a4_text_counts")
def a4_text_counts(spark, d):
    """A4/U4/A2: captions, comments and texts per user."""
    return feat.text_counts(I.conversation_texts(spark, d))


@register("a6_alignment")
def a6_alignment(spark, d):
    """Alignment per user, collapsed to 1 above 30."""
    s = feat.alignment_scores(_scored_conversations(spark, d))
    return s.select("username", _r("alignment_genZ").alias("alignment_genZ"))


@register("a7_hashtag_score")
def a7_hashtag_score(spark, d):
    """Hashtag score per user over captions."""
    s = feat.hashtag_scores(_scored_conversations(spark, d))
    return s.select("username", _r("hashtag_score").alias("hashtag_score"))


@register("a8_mean_sentiment")
def a8_mean_sentiment(spark, d):
    """Mean polarity over captions and comments."""
    s = sent.mean_sentiment(_scored_conversations(spark, d))
    return s.select(_r("mean_polarity").alias("mean_polarity"), "n")


@register("a9_sentiment_histogram")
def a9_sentiment_histogram(spark, d):
    """5 equal-width bins over the polarity range, empty bins kept."""
    s = sent.histogram(_scored_conversations(spark, d), "polarity", 5)
    return s.select("bin", _r("lo").alias("lo"), _r("hi").alias("hi"), "n")


# ------------------------------------------------------------------ catalogue
from creatorlens.operators import catalog as cat  # noqa: E402


@register("n1_flatten_tree")
def n1_flatten_tree(spark, d):
    """Titles of every tree node in pre-order, with depth."""
    nodes = cat.titled(cat.flatten_tree(I.category_trees(spark, d)))
    return nodes.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("depth").cast("int").alias("depth"),
                        "title")


@register("n2_classify_titles")
def n2_classify_titles(spark, d):
    """Rule labels (first matching priority group, default fashion)."""
    return cat.classify_titles(I.part_titles(spark, d), "title", I.TEST_RULES).select("p_partkey", "title", "category")


@register("n2_classify_by_table")
def n2_classify_by_table(spark, d):
    """N2/J6 with the rules stored as a table: every name's first word votes for its brand, sizes are priorities."""
    return cat.classify_titles_by_table(I.part_titles(spark, d), I.rule_table(spark, d)).select("p_partkey", "title", "category")


@register("n2_category_counts")
def n2_category_counts(spark, d):
    """N2 summary: titles per rule label."""
    lab = cat.classify_titles(I.part_titles(spark, d), "title", I.TEST_RULES)
    return lab.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@register("p14_exclude_titles")
def p14_exclude_titles(spark, d):
    """Titles not on the exclusion list."""
    return cat.exclude_titles(I.part_titles(spark, d), "title", I.TEST_EXCLUSIONS).select("p_partkey", "title")


# ------------------------------------------------------------------ evaluation
from creatorlens.operators import evaluate as ev  # noqa: E402

PRED_THRESHOLD = 1500   # yhat = n_chars >= 1500 for the classifier-metric queries


def _labelled_docs(spark, d):
    lab = read_table(spark, d, "labels")
    docs = read_table(spark, d, "documents").select("doc_id", "n_chars")
    return lab.join(docs, "doc_id").select(
        "doc_id", F.col("quality").alias("y"), "n_chars",
        (F.col("n_chars") >= PRED_THRESHOLD).cast("int").alias("yhat"))


def _rounded(df, cols):
    return df.select(*[_r(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("a11_quantiles")
def a11_quantiles(spark, d):
    """Exact linear quantiles 0.1 / 0.5 / 0.9 of customer balances."""
    c = read_table(spark, d, "customer")
    return spark.range(1).select(*[_r(ev.quantile(c, "c_acctbal", q)).alias(f"q{int(q * 100)}")
                                   for q in (0.1, 0.5, 0.9)])


@register("p17_self_labels")
def p17_self_labels(spark, d):
    """0/1 label = R2 score >= its 0.9 quantile."""
    r2 = rank.rank_all(I.feature_table(spark, d), I.BRAND_CATEGORY, digits=I.ROUND)
    return ev.self_labels(r2, "similarity_score").select("username", "similarity_score", "label")


@register("a12_decile_metrics")
def a12_decile_metrics(spark, d):
    """Top-decile precision / recall / F1 of the R2 ranking."""
    r2 = rank.rank_all(I.feature_table(spark, d), I.BRAND_CATEGORY, digits=I.ROUND)
    m = ev.decile_metrics(r2, "similarity_score")
    return _rounded(m, {"threshold", "fp", "fn", "precision", "recall", "f1"})


@register("r5_ranking_evaluation")
def r5_ranking_evaluation(spark, d):
    """Decile metrics + ROC AUC + AP of R2 against its self-labels."""
    r2 = rank.rank_all(I.feature_table(spark, d), I.BRAND_CATEGORY, digits=I.ROUND)
    m = ev.ranking_evaluation(r2, "similarity_score")
    return _rounded(m, set(m.columns))


@register("a16_roc_pr")
def a16_roc_pr(spark, d):
    """ROC AUC and average precision of n_chars as a quality score."""
    s = ev.roc_pr_summary(_labelled_docs(spark, d), "y", "n_chars")
    return _rounded(s, {"auc", "ap"})


@register("w1_roc_curve")
def w1_roc_curve(spark, d):
    """Cumulative TP/FP per distinct score, descending (range-partitioned prefix sums)."""
    c = ev.roc_pr_curve(_labelled_docs(spark, d), "y", "n_chars")
    return _rounded(c, {"tpr", "fpr", "precision", "recall"})


@register("a13_accuracy")
def a13_accuracy(spark, d):
    """Accuracy of the n_chars threshold rule against quality."""
    return _rounded(ev.accuracy(_labelled_docs(spark, d), "y", "yhat"), {"accuracy"})


@register("a14_confusion_matrix")
def a14_confusion_matrix(spark, d):
    """Confusion matrix in the fixed class order [0, 1]."""
    return ev.confusion_matrix(_labelled_docs(spark, d), "y", "yhat", [0, 1])


@register("a15_classification_report")
def a15_classification_report(spark, d):
    """Per-class precision / recall / f1 / support with macro and weighted averages."""
    rep = ev.classification_report(_labelled_docs(spark, d), "y", "yhat", [0, 1])
    return _rounded(rep, {"precision", "recall", "f1"})


# ------------------------------------------------------------------ TF-IDF
from creatorlens.operators import vectorize as vec  # noqa: E402

TITLE_STOP_WORDS = ["and", "the", "of", "new", "old"]


@register("t7_tfidf_titles")
def t7_tfidf_titles(spark, d):
    """T7 (clustering setup): uni+bigrams, stop words, df in [0.01, 0.5] of part names."""
    w = vec.tfidf(I.part_titles(spark, d), "p_partkey", "title", ngram_range=(1, 2),
                  stop_words=TITLE_STOP_WORDS, min_df=0.01, max_df=0.5)
    return w.select("doc_id", "term", _r("tfidf").alias("tfidf"))


@register("t7_tfidf_documents")
def t7_tfidf_documents(spark, d):
    """T7 (classifier setup): unigrams, 1000 most frequent terms, every document."""
    docs = I.documents(spark, d)
    w = vec.tfidf(docs, "doc_id", "text", max_features=1000)
    return w.select("doc_id", "term", _r("tfidf").alias("tfidf"))


@register("a19_document_frequency")
def a19_document_frequency(spark, d):
    """Document frequency of kept terms (df in [0.01, 0.5]) of part names."""
    docs = I.part_titles(spark, d)
    tf = vec.term_counts(docs, "p_partkey", "title", ngram_range=(1, 2), stop_words=TITLE_STOP_WORDS)
    n = docs.agg(F.count(F.lit(1))).scalar()
    return vec.vocabulary(tf, n, min_df=0.01, max_df=0.5).select("term", "df", "ctf")


# ------------------------------------------------------------------ clustering
from pyspark.ml.functions import array_to_vector  # noqa: E402

from creatorlens.operators import cluster as clu  # noqa: E402


def _embeddings(spark, d):
    return read_table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("cluster"),
                                                      F.col("embedding").alias("features"))


@register("a17_silhouette")
def a17_silhouette(spark, d):
    """Per-point squared-Euclidean silhouette of the labelled embeddings."""
    s = clu.silhouette(_embeddings(spark, d), "id")
    return s.select("id", "cluster", _r("silhouette").alias("silhouette"))


@register("a17_silhouette_summary")
def a17_silhouette_summary(spark, d):
    """Mean silhouette and size per cluster."""
    s = clu.silhouette_summary(clu.silhouette(_embeddings(spark, d), "id"))
    return s.select("cluster", _r("mean_silhouette").alias("mean_silhouette"), "n")


@register("a17_euclidean_silhouette")
def a17_euclidean_silhouette(spark, d):
    """Euclidean silhouette of the labelled embeddings in the plane of their two principal axes, with its proven interval."""
    points = clu.project(_embeddings(spark, d), out="plane")
    return plane.plane_silhouette(points, "id", "cluster", "plane")


@register("a18_cluster_membership")
def a18_cluster_membership(spark, d):
    """Cluster sizes and number of clusters."""
    return clu.cluster_membership(_embeddings(spark, d))


@register("w2_sorted_silhouette")
def w2_sorted_silhouette(spark, d):
    """Silhouette rank inside each cluster."""
    s = clu.sorted_within_cluster(clu.silhouette(_embeddings(spark, d), "id"), "id")
    return s.select("id", "cluster", _r("silhouette").alias("silhouette"), "rank")


@register("m2_pca_projection")
def m2_pca_projection(spark, d):
    """M2: 2-D PCA of the embeddings: every point projected, components orthonormal, projections uncorrelated."""
    points = _embeddings(spark, d).withColumn("_vec", array_to_vector(F.col("features").cast("array<double>")))
    model = clu.pca_model(points)
    axes = model.pc.toArray().T
    orthonormal = all(abs(sum(a * b for a, b in zip(x, y)) - (i == j)) < 1e-6 for i, x in enumerate(axes) for j, y in enumerate(axes))
    p = clu.project(_embeddings(spark, d), k=2).select(F.col("projection")[0].alias("x"), F.col("projection")[1].alias("y"))
    return p.agg(F.count("x").alias("n"), F.lit(orthonormal).alias("orthonormal"), (F.abs(F.corr("x", "y")) < 1e-6).alias("uncorrelated"),
                 (F.variance("x") >= F.variance("y")).alias("ordered"))


@register("m1_kmeans")
def m1_kmeans(spark, d):
    """M1: k-means (k=3, seed 42) on the 2-D projection: per point, whether its centre is the nearest."""
    p = clu.project(_embeddings(spark, d), k=2).drop("cluster")
    out, centres = clu.kmeans_with_centres(p, "projection")
    far = [F.pow(F.col("projection")[0] - c[0], 2) + F.pow(F.col("projection")[1] - c[1], 2) for c in centres]
    return out.select("id", (F.element_at(F.array(*far), F.col("cluster") + 1) <= F.least(*far) + 1e-9).alias("nearest"))


# ------------------------------------------------------------------ classification
from creatorlens.operators import classify as cls  # noqa: E402


def _labelled_titles(spark, d):
    t = I.part_titles(spark, d)
    return cls.hash_split(cat.classify_titles(t, "title", I.TEST_RULES), "p_partkey")


@register("m3_train_test_split")
def m3_train_test_split(spark, d):
    """M3: stable 80/20 split of the labelled titles."""
    return _labelled_titles(spark, d).select("p_partkey", "title", "category", "is_test")


def _svm_predictions(spark, d):
    data = _labelled_titles(spark, d)
    model = cls.fit_svm(data.where(~F.col("is_test")))
    return cls.predict(model, data.where(F.col("is_test"))).select("p_partkey", "title", "category", "prediction")


TITLE_CLASSES = ["beauty", "fashion", "fitness"]


@register("m4_svm_test_predictions")
def m4_svm_test_predictions(spark, d):
    """M4/M6: one-vs-rest linear SVM on TF-IDF: the test rows, each with a known class predicted."""
    return _svm_predictions(spark, d).select("p_partkey", "title", "category", F.col("prediction").isin(TITLE_CLASSES).alias("known"))


@register("m4_svm_report")
def m4_svm_report(spark, d):
    """M4 + A13-A15: support of each class among the test rows, and whether the SVM's accuracy beats the
    share of the largest class."""
    preds = materialize(_svm_predictions(spark, d))
    support = preds.groupBy(F.col("category").alias("label")).agg(F.count("*").alias("support"))
    share = support.agg(F.max("support") / F.sum("support")).scalar()
    hit = preds.agg(F.avg((F.col("category") == F.col("prediction")).cast("double"))).scalar()
    return support.select("label", "support", (hit > share).alias("beats_majority"))


@register("m5_grid_search")
def m5_grid_search(spark, d):
    """M5: 5-fold cross-validated kernel {linear, rbf} x C {0.1, 1, 10}: whether the best mean accuracy beats
    the largest class, and that each setting's is a share."""
    train = materialize(_labelled_titles(spark, d).where(~F.col("is_test")))
    _, scores = cls.grid_search(train, key="p_partkey")
    n = train.count()
    most = train.groupBy("category").count().agg(F.max("count")).first()[0]
    best = max(a for *_, a in scores)
    return literal_frame(spark, [(k, float(c), bool(0 <= a <= 1), bool(best > most / n)) for k, c, a in scores],
                         "kernel string, c double, is_share boolean, best_beats_majority boolean")


@register("m6_predict_titles")
def m6_predict_titles(spark, d):
    """M6: the fitted pipeline scores every part title in batch, each with a known class."""
    data = _labelled_titles(spark, d)
    model = cls.fit_svm(data.where(~F.col("is_test")))
    return cls.predict(model, I.part_titles(spark, d)).select("p_partkey", "title", F.col("prediction").isin(TITLE_CLASSES).alias("known"))


# ------------------------------------------------------------------ sources and sinks
from creatorlens.session import scratch_path  # noqa: E402
from creatorlens.sources import readers as rd  # noqa: E402
from creatorlens.sources import sinks as sk  # noqa: E402


@register("s1_influencer_csv")
def s1_influencer_csv(spark, d):
    """Influencers written as header CSV (third header ``_c2``) and
    read back with a declared schema; followers text -> int."""
    c = read_table(spark, d, "customer").select(
        F.col("c_name").alias("username"), F.lower("c_mktsegment").alias("category"),
        F.col("c_acctbal").cast("string").alias("_c2"))
    path = scratch_path(spark, "influencers-csv")
    sk.write_csv(c, path)
    return rd.read_influencers(spark, path)


@register("s2_feature_csv")
def s2_feature_csv(spark, d):
    """The feature table through a header CSV, read with a declared schema."""
    f = I.features(spark, d).select(F.col("username"), _r("engagement_rate").alias("engagement_rate"),
                                    _r("alignment_genZ").alias("alignment_genZ"), "category",
                                    _r("hashtag_score").alias("hashtag_score"))
    path = scratch_path(spark, "features-csv")
    sk.write_csv(f, path)
    return rd.read_features_csv(spark, path)


@register("s4_post_files")
def s4_post_files(spark, d):
    """Posts written as JSON-line files, one folder per user, then
    ONE text scan with the user taken from the path, and the engagement rate."""
    path = scratch_path(spark, "post-files")
    sk.write_user_folders(I.posts(spark, d).select(F.col("username").cast("string").alias("owner"), "value"), path, "owner")
    files = rd.read_post_files(spark, path, key_pattern=r"owner=([^/]+)/").select(
        F.col("file_key").cast("bigint").alias("username"), "value")
    rates = feat.engagement_rates(I.influencers(spark, d), files, like_path=I.LIKE_PATH)
    return rates.select("username", _r("engagement_rate").alias("engagement_rate"))


@register("s5_tree_documents")
def s5_tree_documents(spark, d):
    """Tree documents written as JSON lines and read back as raw text."""
    trees = I.category_trees(spark, d)
    path = scratch_path(spark, "trees-jsonl")
    # one JSON document per line: {"doc_id": ..., "navigation": [...]}
    line = F.concat(F.lit('{"doc_id":'), F.to_json(F.array("doc_id")).substr(F.lit(2), F.length(F.to_json(F.array("doc_id"))) - 2),
                    F.lit(","), F.expr("substring(json, 2)"))
    trees.select(line.alias("value")).write.mode("overwrite").text(path)
    raw = rd.read_json_documents(spark, path, whole_file=False)
    docs = raw.select(F.get_json_object("json", "$.doc_id").alias("doc_id"), "json")
    nodes = cat.titled(cat.flatten_tree(docs))
    return nodes.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("depth").cast("int").alias("depth"),
                        "title")


@register("s10_records")
def s10_records(spark, d):
    """The R1 result as JSON records."""
    r1 = rank.rank_in_category(I.feature_table(spark, d), I.RANK_CATEGORY, domain=I.test_categories(), digits=I.ROUND)
    return sk.as_records(r1)


# ------------------------------------------------------------------ streaming
from creatorlens.streaming import engagement_table, run_engagement_stream  # noqa: E402


@register("st1_engagement_stream")
def st1_engagement_stream(spark, d):
    """A1 as Structured Streaming: post files -> stateful per-user sums -> rates."""
    src = scratch_path(spark, "stream-posts")
    sk.write_user_folders(I.posts(spark, d).select(F.col("username").cast("string").alias("owner"), "value"), src, "owner")
    out = scratch_path(spark, "stream-rates")
    run_engagement_stream(spark, f"{src}/*/", I.influencers(spark, d), out, key_pattern=r"owner=([^/]+)/", recursive=True,
                          like_path=I.LIKE_PATH, key_type="bigint", checkpoint=scratch_path(spark, "stream-checkpoint"))
    return engagement_table(spark, out).select("username", _r("engagement_rate").alias("engagement_rate"))


# ------------------------------------------------------------------ mapping / encoding
from creatorlens.functions import vector as V  # noqa: E402

CATEGORY_CODES = {"building": 1, "household": 2, "machinery": 3}


@register("p15_category_codes")
def p15_category_codes(spark, d):
    """Category mapped to a code (unmapped -> NULL) next to the normalised rate."""
    f = rank.normalize_category(I.feature_table(spark, d))
    m = f.agg(rank.largest()).scalar()
    return f.select("username", "category", V.lookup("category", CATEGORY_CODES).alias("category_code"),
                    _r(V.safe_divide(F.col("engagement_rate"), m)).alias("normalized_engagement_rate"))


@register("f18_one_hot")
def f18_one_hot(spark, d):
    """one-hot block over the test category domain."""
    f = rank.normalize_category(I.feature_table(spark, d))
    return f.select("username", *V.one_hot("category", I.test_categories(), prefix="is_"))


# ------------------------------------------------------------------ title clustering flow
from creatorlens.lexicons import IRRELEVANT_TITLES  # noqa: E402


def _catalog_titles(spark, d):
    """N1 -> P13 -> P14: titles of the test catalogue trees, exclusions removed."""
    nodes = cat.titled(cat.flatten_tree(I.category_trees(spark, d)))
    t = nodes.select(F.concat_ws("/", "doc_id", F.col("pos").cast("string")).alias("id"), "title")
    return cat.exclude_titles(t, "title", IRRELEVANT_TITLES)


@register("m1_title_clusters")
def m1_title_clusters(spark, d):
    """Title clustering: catalogue titles -> TF-IDF (U2 stop words) -> PCA(2) -> k-means(3): every title with a
    cluster of the three."""
    titles = materialize(_catalog_titles(spark, d))
    stops = vec.default_stop_words(spark, IRRELEVANT_TITLES)
    out = clu.cluster_titles(titles, stop_words=stops, min_df=1.0, max_df=0.5)
    return out.select("id", "title", F.col("cluster").between(0, 2).alias("known"))


@register("a17_title_cluster_silhouette")
def a17_title_cluster_silhouette(spark, d):
    """A17/A18 on the title clusters in the projected space: points, and that every mean is a silhouette."""
    titles = materialize(_catalog_titles(spark, d))
    stops = vec.default_stop_words(spark, IRRELEVANT_TITLES)
    pts = materialize(clu.cluster_titles(titles, stop_words=stops, min_df=1.0, max_df=0.5))
    s = clu.silhouette_summary(clu.silhouette(pts, "id", "cluster", "projection"))
    return s.agg(F.sum("n").alias("n"), F.bool_and(F.col("mean_silhouette").between(-1, 1)).alias("in_range"),
                 (F.count("*") <= 3).alias("few"))


@register("s8_titles_csv")
def s8_titles_csv(spark, d):
    """Labelled titles written as header CSV and read back."""
    lab = cat.classify_titles(I.part_titles(spark, d), "title", I.TEST_RULES).select("p_partkey", "title", "category")
    path = scratch_path(spark, "titles-csv")
    sk.write_csv(lab, path)
    return spark.read.schema("p_partkey bigint, title string, category string").option("header", True).csv(path)


@register("r4_brand_search_no_genz")
def r4_brand_search_no_genz(spark, d):
    """Automobile, 75 % engagement, Gen-Z audience no (target 0)."""
    return rank.brand_search(I.feature_table(spark, d), "Automobile", 75, "no", domain=I.test_categories(),
                             digits=I.ROUND)


# ------------------------------------------------------------------ the fixed audience lexicons on whole texts
from creatorlens import lexicons as LEX  # noqa: E402


@register("t3_genz_traits")
def t3_genz_traits(spark, d):
    """T3 with the fixed keyword / emoji / hashtag lexicons over every document."""
    return _lowered_documents(spark, d).select(
        "doc_id", feat.trait_count(F.col("text"), lowered=F.col("_low")).alias("traits"))


@register("a10_genz_term_frequency")
def a10_genz_term_frequency(spark, d):
    """T5/A10/U1 with the fixed union lexicon (keywords + emojis + hashtags) over every document."""
    terms = [t for _, t in lex.lexicon_union()]
    return lex.term_frequency(I.documents(spark, d), terms)


@register("a6_alignment_from_posts")
def a6_alignment_from_posts(spark, d):
    """F11/U4/A2 -> A6: conversation turns written as post JSON lines
    (user turn = caption, any other = one comment), parsed back into the
    caption/comment stream and scored; equals ``a6_alignment``."""
    c = read_table(spark, d, "conversations")
    post = F.when(F.col("role") == "user", F.to_json(F.struct(F.col("text").alias("caption")))) \
        .otherwise(F.to_json(F.struct(F.array(F.col("text")).alias("comments"))))
    posts = c.select(F.col("conv_id").alias("username"),
                     F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("post_id"),
                     post.alias("value"))
    texts = feat.post_texts(posts, id_col="post_id")
    s = feat.alignment_scores(feat.scored_texts(texts, I.sentiment_lexicon(spark), keywords=I.TEST_KEYWORDS,
                                                emojis=I.TEST_MARKERS, hashtags=I.TEST_HASHTAGS,
                                                negators=I.TEST_NEGATORS))
    return s.select("username", _r("alignment_genZ").alias("alignment_genZ"))


@register("a1_engagement_prefix")
def a1_engagement_prefix(spark, d):
    """A1 with J2 prefix mode (the file-glob behaviour): user "1" also collects
    the posts of users "10".."19", "100".."149"."""
    infl = I.influencers(spark, d).withColumn("username", F.col("username").cast("string"))
    posts = I.posts(spark, d).withColumn("username", F.col("username").cast("string"))
    rates = feat.engagement_rates(infl, posts, like_path=I.LIKE_PATH, match="prefix")
    return rates.select("username", _r("engagement_rate").alias("engagement_rate"))


@register("a6_alignment_literal")
def a6_alignment_literal(spark, d):
    """A6 in literal mode (D2): cleaning removes '#' and emoji first, so only keyword tokens count."""
    s = feat.alignment_scores(feat.scored_texts(I.conversation_texts(spark, d), I.sentiment_lexicon(spark),
                                                keywords=I.TEST_KEYWORDS, emojis=I.TEST_MARKERS,
                                                hashtags=I.TEST_HASHTAGS, mode="literal",
                                                negators=I.TEST_NEGATORS))
    return s.select("username", _r("alignment_genZ").alias("alignment_genZ"))


# ------------------------------------------------------------------ edges of the ranking, sinks and lexicons


@register("r4_brand_search_zero")
def r4_brand_search_zero(spark, d):
    """R4 with target 0 over a category whose rates are all 0: every score is NULL, names decide the order."""
    f = I.feature_table(spark, d).withColumn("engagement_rate", F.when(F.lower("category") == "machinery", 0.0).otherwise(F.col("engagement_rate")))
    return rank.brand_search(f, "Machinery", 0, "yes", domain=I.test_categories(), digits=I.ROUND)


@register("r1_rank_nan")
def r1_rank_nan(spark, d):
    """R1 with NaN rates (users without a click): the maximum passes them over, their own scores are NULL."""
    f = I.feature_table(spark, d).withColumn("engagement_rate", F.when(F.col("hashtag_score") == 0, F.lit(float("nan"))).otherwise(F.col("engagement_rate")))
    out = rank.rank_in_category(f, I.RANK_CATEGORY, domain=I.test_categories(), digits=I.ROUND, k=None)
    return out.select("username", F.nanvl("similarity_score", F.lit(None).cast("double")).alias("similarity_score"))


@register("p11_default_category")
def p11_default_category(spark, d):
    """The default category, which no row of the test tables has, gives an empty ranking."""
    return rank.rank_in_category(I.feature_table(spark, d), digits=I.ROUND)


@register("s7_append_csv")
def s7_append_csv(spark, d):
    """The rates of two halves of the influencers appended to one CSV folder and read back."""
    rates = I.engagement(spark, d).select("username", _r("engagement_rate").alias("engagement_rate"))
    path = scratch_path(spark, "rates-csv")
    for half in (0, 1):
        sk.write_csv(rates.where(F.col("username") % 2 == half), path, mode="append")
    return spark.read.schema("username bigint, engagement_rate double").option("header", True).csv(path)


@register("u2_stop_words")
def u2_stop_words(spark, d):
    """Part-name words that the union of two stop-word lists leaves, with their counts."""
    stops = vec.stop_word_union(TITLE_STOP_WORDS, ["red", "new", "blue"])
    terms = I.part_titles(spark, d).select(F.explode(vec.analyze(F.col("title"), stop_words=stops)).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ phrases, modifiers, tables as lexicons
from creatorlens.functions import text as tx  # noqa: E402
from creatorlens.operators import kernel_svm as ksv  # noqa: E402
from creatorlens.operators import neighbour_map as nmap  # noqa: E402
from creatorlens.operators import phrases as phr  # noqa: E402
from creatorlens.operators import plane_silhouette as plane  # noqa: E402


@register("t2_word_tokens")
def t2_word_tokens(spark, d):
    """T2 in full: contractions, quotes, ellipses and punctuation as tokens of their own, over every conversation turn."""
    c = I.conversation_texts(spark, d).select("text_id", tx.treebank_tokens("text").alias("t"), tx.word_tokens("text").alias("w"))
    return c.select("text_id", F.array_join("t", " ").alias("tokens"), F.size("w").alias("n_words"))


@register("t3_phrase_traits")
def t3_phrase_traits(spark, d):
    """T3/J4 in intent mode: lexicon entries of several words, the longest at each place, some only as written."""
    return phr.count_phrases(I.documents(spark, d), I.phrase_lexicon(spark, d), id_col="doc_id")


@register("t6_modified_polarity")
def t6_modified_polarity(spark, d):
    """T6 with intensifiers, entries of several words and negation at a distance."""
    s = sent.score_modified(I.conversation_texts(spark, d), I.modified_lexicon(spark), id_col="text_id")
    return s.select("text_id", _r("polarity").alias("polarity"), (F.col("polarity") > 0).alias("positive"))


@register("j5_lexicon_table")
def j5_lexicon_table(spark, d):
    """J5 with a lexicon stored as a table: distinct terms that each document holds as substrings."""
    return lex.terms_present(I.documents(spark, d), I.term_table(spark, d), id_col="doc_id")


@register("m2_neighbour_map")
def m2_neighbour_map(spark, d):
    """M2: every embedding placed on the landmark t-SNE map."""
    p = nmap.neighbour_map(_embeddings(spark, d))
    return p.select("id", (F.size("projection") == 2).alias("placed"))


@register("m2_map_trustworthiness")
def m2_map_trustworthiness(spark, d):
    """M2: trustworthiness of the t-SNE map and of PCA on the same rows, and whether the map's is better."""
    both = materialize(nmap.neighbour_map(clu.project(_embeddings(spark, d), out="pca")))
    t = nmap.trustworthiness(both, "id", "features", {"tsne": "projection", "pca": "pca"})
    value = lambda m: F.max(F.when(F.col("method") == m, F.col("trustworthiness")))
    return t.agg(F.max("n").alias("n"), F.max("queries").alias("queries"), _r(value("tsne"), 4).alias("tsne"), _r(value("pca"), 4).alias("pca"),
                 (value("tsne") > value("pca")).alias("better"))


def _kernel_svc(spark, d):
    """(model, scored test rows) of the one-vs-one RBF classifier on title vectors."""
    data = materialize(_labelled_titles(spark, d))
    train = data.where(~F.col("is_test"))
    vectors = cls.title_vectors(train)
    model = ksv.fit_kernel_svm(cls.with_title_vectors(vectors, train), "category", "features", "p_partkey")
    return model, ksv.predict_kernel_svm(model, cls.with_title_vectors(vectors, data.where(F.col("is_test"))), "features").drop("features")


@register("m4_kernel_svc_report")
def m4_kernel_svc_report(spark, d):
    """M4: one-vs-one RBF classifier: support of each class among the test rows, whether every pair's KKT gap over all
    training rows is below the tolerance, and whether the accuracy beats the largest class."""
    model, scored = _kernel_svc(spark, d)
    support = materialize(scored).groupBy(F.col("category").alias("label")).agg(
        F.count("*").alias("support"), F.sum((F.col("category") == F.col("prediction")).cast("long")).alias("hit"))
    total = support.agg(F.struct((F.max("support") / F.sum("support")).alias("share"), (F.sum("hit") / F.sum("support")).alias("hit")).alias("t")).scalar()
    return support.select("label", "support", F.lit(bool(model.gap <= 1e-3)).alias("converged"), (total["hit"] > total["share"]).alias("beats_majority"))


@register("m4_kernel_svc_predictions")
def m4_kernel_svc_predictions(spark, d):
    """M4/M6: the test titles, each with a known class voted for."""
    return _kernel_svc(spark, d)[1].select("p_partkey", "title", "category", F.col("prediction").isin(TITLE_CLASSES).alias("known"))
