"""DuckDB SQL equivalents of the registered queries (same column names).

Conventions shared with the Spark side: double->int casts truncate
(``trunc``), floating results are rounded to 6 digits, ties are broken by user
name, division by zero gives NULL.
"""

from __future__ import annotations

from creatorlens import lexicons as _L

SQL: dict[str, str] = {}

# ---------------------------------------------------------------- shared CTEs
BASE = """
posts AS (
  SELECT user_id AS username, event_type, value AS amount,
         CASE WHEN event_type = 'error' THEN 'oops' ELSE props END AS value
  FROM events),
infl AS (
  SELECT c_custkey AS username, c_name, lower(c_mktsegment) AS category,
         CAST(trunc(c_acctbal) AS INTEGER) AS followers
  FROM customer),
per_user AS (
  SELECT username,
         sum(coalesce(CASE WHEN json_valid(value) THEN TRY_CAST(json_extract_string(value, '$.k') AS DOUBLE) END,
                      CAST(0 AS DOUBLE))) AS sum_likes,
         count(*) AS n_posts, avg(amount) AS avg_amount,
         count(*) FILTER (WHERE event_type = 'click') AS n_click
  FROM posts GROUP BY username),
eng AS (
  SELECT i.username,
         CASE WHEN i.followers > 0 THEN p.sum_likes / CAST(p.n_posts AS DOUBLE) / i.followers * CAST(100 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS engagement_rate
  FROM infl i LEFT JOIN per_user p USING (username)),
feat AS (
  SELECT i.c_name AS username, i.category,
         CASE WHEN i.followers > 0 THEN p.sum_likes / CAST(p.n_posts AS DOUBLE) / i.followers * CAST(100 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS engagement_rate,
         CASE WHEN p.avg_amount > 50 THEN CAST(1 AS DOUBLE) ELSE p.avg_amount END AS alignment_genZ,
         p.n_click * CAST(100 AS DOUBLE) / p.n_posts AS hashtag_score
  FROM per_user p JOIN infl i USING (username))
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"


def _cos_brand(r: str, g: str, same: str, b: str, a: str) -> str:
    return (f"(({r}) * ({b}) + ({g}) * ({a}) + ({same})) / "
            f"(sqrt(({r}) * ({r}) + ({g}) * ({g}) + 1.0) * sqrt(({b}) * ({b}) + ({a}) * ({a}) + 1.0))")


SQL["a1_engagement_rate"] = _with(BASE) + """
SELECT username, round(engagement_rate, 6) AS engagement_rate FROM eng
"""

SQL["j1_merge_features"] = _with(BASE, """
al AS (SELECT user_id AS username, CASE WHEN avg(value) > 50 THEN CAST(1 AS DOUBLE) ELSE avg(value) END AS alignment_genZ
       FROM events GROUP BY user_id)""", """
hs AS (SELECT user_id AS username, count(*) FILTER (WHERE event_type = 'click') * CAST(100 AS DOUBLE) / count(*) AS hashtag_score
       FROM events GROUP BY user_id)""") + """
SELECT username, round(engagement_rate, 6) AS engagement_rate, round(alignment_genZ, 6) AS alignment_genZ,
       round(hashtag_score, 6) AS hashtag_score
FROM eng JOIN al USING (username) JOIN hs USING (username)
"""

SQL["j2_prefix_match"] = """
WITH users AS (SELECT DISTINCT source AS username FROM documents)
SELECT u.username, count(*) AS n_posts, CAST(sum(d.n_chars) AS BIGINT) AS sum_chars
FROM users u JOIN documents d ON starts_with(d.source, u.username)
GROUP BY u.username
"""

SQL["j2_exact_match"] = """
SELECT source AS username, count(*) AS n_posts, CAST(sum(n_chars) AS BIGINT) AS sum_chars
FROM documents GROUP BY source
"""


def _r1(category: str, t: float, a: float, limit: int | None = 15) -> str:
    lim = f"LIMIT {limit}" if limit else ""
    score = _cos_brand("r", "g", "1.0", "b", f"CAST({a} AS DOUBLE)")
    return _with(BASE, f"""
rows AS (SELECT * FROM feat WHERE lower(trim(category)) = '{category}')""", """
m AS (SELECT max(engagement_rate) AS m FROM rows)""", f"""
v AS (SELECT username, {_div('engagement_rate', 'm')} AS r, alignment_genZ AS g,
             CAST({t} AS DOUBLE) / greatest(m, CAST({t} AS DOUBLE)) AS b FROM rows, m)""") + f"""
SELECT username, round({score}, 6) AS similarity_score FROM v
ORDER BY similarity_score DESC NULLS LAST, username {lim}
"""


SQL["r1_rank_category"] = _r1("building", 0.5, 1.0)
SQL["r4_brand_search"] = _r1("machinery", 0.4, 1.0)


def _r2() -> str:
    score = _cos_brand("r", "g", "CASE WHEN category = 'household' THEN 1.0 ELSE 0.0 END", "b", "1.0")
    return _with(BASE, """
m AS (SELECT max(engagement_rate) AS m FROM feat)""", f"""
v AS (SELECT username, lower(trim(category)) AS category, {_div('engagement_rate', 'm')} AS r, alignment_genZ AS g,
             CAST(0.4 AS DOUBLE) / greatest(m, CAST(0.4 AS DOUBLE)) AS b FROM feat, m)""") + f"""
SELECT username, category, round({score}, 6) AS similarity_score FROM v
"""


SQL["r2_rank_all"] = _r2()
SQL["k3_page"] = "SELECT * FROM (" + _r2() + ") ORDER BY similarity_score DESC NULLS LAST, username LIMIT 15 OFFSET 15"

SQL["r3_rank_baseline"] = _with(BASE, """
m AS (SELECT max(engagement_rate) AS m FROM feat)""", f"""
v AS (SELECT username, {_div('engagement_rate', 'm')} AS r, hashtag_score AS h,
             CAST(0.4 AS DOUBLE) / greatest(m, CAST(0.4 AS DOUBLE)) AS b FROM feat, m)""") + """
SELECT username, round(CASE WHEN sqrt(r * r + h * h) * sqrt(b * b + 225.0) = 0 THEN 0.0
                            ELSE (r * b + h * 15.0) / (sqrt(r * r + h * h) * sqrt(b * b + 225.0)) END, 6)
       AS similarity_score
FROM v
"""

SQL["r4_many_brands"] = _with(BASE, """
brands(brand_id, category, t, a) AS (VALUES (1, 'building', 0.5, 1), (2, 'furniture', 0.3, 0), (3, 'automobile', 0.8, 1))""",
"""
mx AS (SELECT lower(trim(category)) AS category, max(engagement_rate) AS m FROM feat GROUP BY 1)""", f"""
v AS (SELECT b.brand_id, f.username, {_div('f.engagement_rate', 'mx.m')} AS r, f.alignment_genZ AS g,
             CAST(b.t AS DOUBLE) / greatest(mx.m, CAST(b.t AS DOUBLE)) AS bn, CAST(b.a AS DOUBLE) AS a
      FROM feat f JOIN mx ON lower(trim(f.category)) = mx.category JOIN brands b ON b.category = mx.category)""", f"""
s AS (SELECT brand_id, username, round({_cos_brand('r', 'g', '1.0', 'bn', 'a')}, 6) AS similarity_score FROM v)""") + """
SELECT brand_id, username, similarity_score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY brand_id ORDER BY similarity_score DESC NULLS LAST, username) AS rank FROM s)
WHERE rank <= 15
"""

SQL["j7_grid_pairs"] = _with(BASE) + """
SELECT lower(trim(category)) AS category, count(*) * 10 AS n_pairs, true AS pruned FROM feat WHERE category IS NOT NULL GROUP BY 1
"""

SQL["p20_display"] = "SELECT username, concat('https://instagram.com/', username) AS profile_url, " \
                     "round(similarity_score, 2) AS score_display FROM (" + SQL["r1_rank_category"] + ")"


# ---------------------------------------------------------------- text
SP = r"\t-\r \x1c-\x1f\x{85}\p{Z}"
CLEAN = (r"lower(regexp_replace(regexp_replace(regexp_replace({t}, 'http[^" + SP + r"]+', '', 'g'), "
         r"'@[\p{L}\p{N}_]+', '', 'g'), '[^a-zA-Z" + SP + r"]', '', 'g'))")
TOKENS = "list_filter(regexp_split_to_array({c}, '[" + SP + "]+'), lambda x: x <> '')"


def _clean(t: str) -> str:
    return CLEAN.replace("{t}", t)


def _tokens(c: str) -> str:
    return TOKENS.replace("{c}", c)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(terms) -> str:
    return "(" + ", ".join(_q(t) for t in sorted(set(terms))) + ")"


def _present(t: str, terms) -> str:
    terms = list(dict.fromkeys(x for x in terms if x))
    return "(" + " + ".join(f"(CASE WHEN contains({t}, {_q(x)}) THEN 1 ELSE 0 END)" for x in terms) + ")"


def _occ(t: str, term: str) -> str:
    return f"CAST((strlen({t}) - strlen(replace({t}, {_q(term)}, ''))) / {len(term.encode())} AS INTEGER)"


def _occ_total(t: str, terms) -> str:
    terms = list(dict.fromkeys(x for x in terms if x))
    return "(" + " + ".join(_occ(t, x) for x in terms) + ")"


from creatorlens import lexicons as _LX  # noqa: E402
from creatorlens.plans import inputs as _I  # noqa: E402

_KW = _in_list(_I.TEST_KEYWORDS)

SQL["t1_clean_text"] = f"SELECT doc_id, {_clean('text')} AS clean FROM documents"

SQL["t2_tokens"] = f"""
SELECT doc_id, CAST(len(tk) AS INTEGER) AS n_tokens, array_to_string(tk, ' ') AS token_text
FROM (SELECT doc_id, {_tokens(_clean('text'))} AS tk FROM documents)
"""

SQL["j4_keyword_tokens"] = f"""
SELECT doc_id, CAST(len(list_filter({_tokens(_clean('text'))}, lambda x: x IN {_KW})) AS INTEGER) AS n_keywords
FROM documents
"""

SQL["j5_hashtag_presence"] = f"SELECT doc_id, {_present('lower(text)', _I.TEST_HASHTAGS)} AS n_hashtags FROM documents"

SQL["f15_sequence_occurrences"] = (
    f"SELECT doc_id, {_occ_total('lower(text)', _LX.GENZ_EMOJIS + _I.TEST_MARKERS)} AS n_sequences FROM documents")

_TRAITS = (f"(CAST(len(list_filter({_tokens(_clean('text'))}, lambda x: x IN {_KW})) AS INTEGER) + "
           f"{_occ_total('lower(text)', _I.TEST_MARKERS)} + {_present('lower(text)', _I.TEST_HASHTAGS)})")

SQL["t3_trait_count"] = f"SELECT doc_id, {_TRAITS} AS traits FROM documents"


def _a10() -> str:
    from creatorlens.operators.lexicon import lexicon_union
    terms = [t for _, t in lexicon_union(_I.TEST_KEYWORDS, _I.TEST_MARKERS, _I.TEST_HASHTAGS)]
    vals = ", ".join(f"({_q(t)}, {len(t.encode())})" for t in terms)
    return f"""
WITH lex(term, nb) AS (VALUES {vals}),
d AS (SELECT lower(text) AS t FROM documents)
SELECT term, CAST(sum((strlen(t) - strlen(replace(t, term, ''))) // nb) AS BIGINT) AS n
FROM d, lex GROUP BY term HAVING sum((strlen(t) - strlen(replace(t, term, ''))) // nb) > 0
"""


SQL["a10_term_frequency"] = _a10()

_LEX_VALUES = ", ".join(f"({_q(w)}, CAST({p} AS DOUBLE))" for w, p in sorted(_I.TEST_SENTIMENT.items()))
_NEG = _in_list(_I.TEST_NEGATORS)

SCORED = f"""
texts AS (
  SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS text_id, conv_id AS username,
         CASE WHEN role = 'user' THEN 'caption' ELSE 'comment' END AS kind, text
  FROM conversations),
prep AS (
  SELECT text_id, username, kind, {_TRAITS} AS traits, {_present('lower(text)', _I.TEST_HASHTAGS)} AS hashtags,
         {_tokens(_clean('text'))} AS tk
  FROM texts),
lexicon(word, polarity) AS (VALUES {_LEX_VALUES}),
pos AS (SELECT text_id, tk, unnest(generate_series(1, len(tk))) AS i FROM prep WHERE len(tk) > 0),
hits AS (
  SELECT p.text_id,
         avg(l.polarity * CASE WHEN p.i > 1 AND p.tk[p.i - 1] IN {_NEG} THEN -0.5 ELSE 1.0 END) AS pol
  FROM pos p JOIN lexicon l ON l.word = p.tk[p.i]
  GROUP BY p.text_id),
scored AS (
  SELECT prep.text_id, username, kind, traits, hashtags, coalesce(hits.pol, CAST(0 AS DOUBLE)) AS polarity
  FROM prep LEFT JOIN hits USING (text_id))
"""

SQL["t6_polarity"] = "WITH " + SCORED + """
SELECT text_id, round(polarity, 6) + 0.0 AS polarity, polarity > 0 AS positive FROM scored
"""

SQL["a4_text_counts"] = """
SELECT conv_id AS username, count(*) FILTER (WHERE role = 'user') AS n_captions,
       count(*) FILTER (WHERE role <> 'user') AS n_comments, count(*) AS n_texts
FROM conversations GROUP BY conv_id
"""

SQL["a6_alignment"] = "WITH " + SCORED + """,
g AS (SELECT username, sum(traits) AS tr, count(*) AS n, count(*) FILTER (WHERE polarity > 0) AS pos
      FROM scored GROUP BY username),
s AS (SELECT username, (tr + pos / CAST(greatest(n, 1) AS DOUBLE) * 100.0) / CAST(n AS DOUBLE) AS a FROM g)
SELECT username, round(CASE WHEN a > 30 THEN 1.0 ELSE a END, 6) AS alignment_genZ FROM s
"""

SQL["a7_hashtag_score"] = "WITH " + SCORED + """,
g AS (SELECT username, sum(hashtags) AS tg, count(*) AS n, count(*) FILTER (WHERE polarity > 0) AS pos
      FROM scored WHERE kind = 'caption' GROUP BY username)
SELECT username, round((tg + pos / CAST(greatest(n, 1) AS DOUBLE) * 100.0) / CAST(n AS DOUBLE), 6) AS hashtag_score
FROM g
"""

SQL["a8_mean_sentiment"] = "WITH " + SCORED + """
SELECT round(avg(polarity), 6) AS mean_polarity, count(*) AS n FROM scored
"""

SQL["a9_sentiment_histogram"] = "WITH " + SCORED + """,
r AS (SELECT CASE WHEN min(polarity) = max(polarity) THEN min(polarity) - 0.5 ELSE min(polarity) END AS lo,
             CASE WHEN min(polarity) = max(polarity) THEN max(polarity) + 0.5 ELSE max(polarity) END AS hi
      FROM scored),
e AS (SELECT lo, hi, (hi - lo) / 5 AS step FROM r),
raw AS (SELECT polarity AS x, least(CAST(floor((polarity - lo) * (5.0 / (hi - lo))) AS INTEGER), 4) AS b,
               lo, hi, step FROM scored, e WHERE polarity IS NOT NULL),
d1 AS (SELECT x, lo, hi, step,
              CASE WHEN x < (CASE WHEN b >= 5 THEN hi ELSE lo + b * step END) THEN b - 1 ELSE b END AS b FROM raw),
d2 AS (SELECT CASE WHEN x >= (CASE WHEN b + 1 >= 5 THEN hi ELSE lo + (b + 1) * step END) AND b <> 4 THEN b + 1
                   ELSE b END AS b FROM d1),
c AS (SELECT b, count(*) AS n FROM d2 GROUP BY b),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(5))
SELECT bin, round(CASE WHEN bin >= 5 THEN hi ELSE lo + bin * step END, 6) AS lo,
       round(CASE WHEN bin + 1 >= 5 THEN hi ELSE lo + (bin + 1) * step END, 6) AS hi,
       coalesce(c.n, 0) AS n
FROM bins LEFT JOIN c ON c.b = bins.bin, e
"""


# ---------------------------------------------------------------- catalogue
SQL["n1_flatten_tree"] = """
WITH n AS (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey, n_name) AS pos FROM nation)
SELECT 'r' || r_regionkey AS doc_id, CAST(0 AS BIGINT) AS pos, 0 AS depth, r_name AS title FROM region WHERE r_name <> ''
UNION ALL
SELECT 'r' || n_regionkey, CAST(pos AS BIGINT), 1, n_name FROM n JOIN region ON r_regionkey = n_regionkey WHERE n_name <> ''
UNION ALL
SELECT 's' || s_suppkey, CAST(1 AS BIGINT), 1, s_name FROM supplier WHERE s_name <> ''
"""

_CLASSIFY = """CASE WHEN contains(lower(p_name), 'ring') OR contains(lower(p_name), 'gear') THEN 'fitness'
     WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'gizmo') OR contains(lower(p_name), 'plate')
     THEN 'beauty' ELSE 'fashion' END"""

SQL["n2_classify_titles"] = f"SELECT p_partkey, p_name AS title, {_CLASSIFY} AS category FROM part"
SQL["n2_category_counts"] = f"SELECT {_CLASSIFY} AS category, count(*) AS n FROM part GROUP BY 1"
SQL["p14_exclude_titles"] = """
SELECT p_partkey, p_name AS title FROM part
WHERE p_name IS NULL OR p_name NOT IN ('small ring', 'red widget', 'blue bolt', 'hot gear')
"""


# ---------------------------------------------------------------- evaluation
SQL["a11_quantiles"] = """
SELECT round(quantile_cont(c_acctbal, 0.1), 6) AS q10, round(quantile_cont(c_acctbal, 0.5), 6) AS q50,
       round(quantile_cont(c_acctbal, 0.9), 6) AS q90
FROM customer
"""

_R2 = "(" + _r2() + ")"

SQL["p17_self_labels"] = f"""
WITH r2 AS {_R2}, t AS (SELECT quantile_cont(similarity_score, 0.9) AS thr FROM r2)
SELECT username, similarity_score, CAST(similarity_score >= thr AS INTEGER) AS label FROM r2, t
"""

_DECILE = f"""
r2 AS {_R2},
t AS (SELECT quantile_cont(similarity_score, 0.9) AS thr FROM r2),
dg AS (SELECT count(*) AS n, count(*) FILTER (WHERE similarity_score >= thr) AS tp, thr FROM r2, t GROUP BY thr),
m AS (SELECT thr, tp, n * 0.1 - tp AS fp, n - tp - (n * 0.1 - tp) AS fn,
             tp / (tp + (n * 0.1 - tp)) AS p, tp / (tp + (n - tp - (n * 0.1 - tp))) AS r FROM dg)
"""

SQL["a12_decile_metrics"] = "WITH " + _DECILE + """
SELECT round(thr, 6) AS threshold, tp, round(fp, 6) AS fp, round(fn, 6) AS fn, round(p, 6) AS precision,
       round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1
FROM m
"""

_CURVE = """
g AS (SELECT {score} AS threshold, count(*) FILTER (WHERE {label} = 1) AS pos,
             count(*) FILTER (WHERE {label} <> 1 OR {label} IS NULL) AS neg
      FROM {src} WHERE {score} IS NOT NULL GROUP BY {score}),
c AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tps,
             sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fps FROM g),
tot AS (SELECT sum(pos) AS np, sum(neg) AS nn FROM g),
summ AS (SELECT sum(neg * (2 * tps - pos)) / (2.0 * np * nn) AS auc, sum(pos * tps / (tps + fps)) / np AS ap,
                np, nn FROM c, tot GROUP BY np, nn)
"""


def _curve(score, label, src):
    return _CURVE.replace("{score}", score).replace("{label}", label).replace("{src}", src)


SQL["r5_ranking_evaluation"] = "WITH " + _DECILE + ", lab AS (SELECT similarity_score, CAST(similarity_score >= thr AS INTEGER) AS label FROM r2, t)," + \
    _curve("similarity_score", "label", "lab") + """
SELECT round(thr, 6) AS threshold, round(p, 6) AS precision, round(r, 6) AS recall,
       round(2 * p * r / (p + r), 6) AS f1, round(auc, 6) AS auc, round(ap, 6) AS ap
FROM m, summ
"""

_DOCS = "(SELECT l.quality AS y, d.n_chars FROM labels l JOIN documents d USING (doc_id))"

SQL["a16_roc_pr"] = "WITH " + _curve("n_chars", "y", _DOCS) + """
SELECT round(auc, 6) AS auc, round(ap, 6) AS ap, CAST(np AS BIGINT) AS n_pos, CAST(nn AS BIGINT) AS n_neg FROM summ
"""

SQL["w1_roc_curve"] = "WITH " + _curve("n_chars", "y", _DOCS) + """
SELECT threshold, CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps, round(tps / np, 6) AS tpr,
       round(fps / nn, 6) AS fpr, round(tps / (tps + fps), 6) AS precision, round(tps / np, 6) AS recall
FROM c, tot
"""

_PRED = "(SELECT l.quality AS y, CAST(d.n_chars >= 1500 AS INTEGER) AS yhat FROM labels l JOIN documents d USING (doc_id))"

SQL["a13_accuracy"] = f"SELECT round(avg(CAST(y = yhat AS DOUBLE)), 6) AS accuracy, count(*) AS n FROM {_PRED}"

SQL["a14_confusion_matrix"] = f"""
WITH p AS {_PRED}, cls(label, class_order) AS (VALUES ('0', 0), ('1', 1))
SELECT cls.label, cls.class_order,
       count(p.y) FILTER (WHERE p.yhat = 0) AS pred_0, count(p.y) FILTER (WHERE p.yhat = 1) AS pred_1
FROM cls LEFT JOIN p ON CAST(p.y AS VARCHAR) = cls.label
GROUP BY cls.label, cls.class_order
"""

SQL["a15_classification_report"] = f"""
WITH p AS {_PRED}, cls(label, c, row_order) AS (VALUES ('0', 0, 0), ('1', 1, 1)),
k AS (SELECT cls.label, cls.row_order,
             count(*) FILTER (WHERE p.y = cls.c AND p.yhat = cls.c) AS tp,
             count(*) FILTER (WHERE p.yhat = cls.c) AS pp, count(*) FILTER (WHERE p.y = cls.c) AS sp
      FROM cls, p GROUP BY cls.label, cls.row_order),
m AS (SELECT label, row_order,
             CASE WHEN pp = 0 THEN 0.0 ELSE tp / pp END AS precision,
             CASE WHEN sp = 0 THEN 0.0 ELSE tp / sp END AS recall, sp AS support FROM k),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM m)
SELECT label, row_order, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM f
UNION ALL
SELECT 'macro avg', 2, round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL
SELECT 'weighted avg', 3, round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
"""


# ---------------------------------------------------------------- TF-IDF
_TOK = r"regexp_extract_all(lower({t}), '[\p{L}\p{N}_]{2,}')"


def _tfidf_sql(src: str, idc: str, textc: str, *, bigrams: bool, stops, min_df=None, max_df=None,
               max_features=None, out: str = "weights") -> str:
    stop = ("list_filter(tk, lambda x: x NOT IN " + _in_list(stops) + ")") if stops else "tk"
    grams = ("list_concat(st, list_transform(generate_series(1, greatest(len(st) - 1, 0)), "
             "lambda i: st[i] || ' ' || st[i + 1]))") if bigrams else "st"
    prune = []
    if min_df is not None:
        prune.append(f"df >= {min_df} * (SELECT n FROM nd)")
    if max_df is not None:
        prune.append(f"df <= {max_df} * (SELECT n FROM nd)")
    where = ("WHERE " + " AND ".join(prune)) if prune else ""
    limit = f"ORDER BY ctf DESC, term LIMIT {max_features}" if max_features else ""
    tok = _TOK.replace("{t}", textc)
    return f"""
WITH src AS ({src}),
nd AS (SELECT count(*) AS n FROM src),
a AS (SELECT {idc} AS doc_id, {tok} AS tk FROM src),
b AS (SELECT doc_id, {stop} AS st FROM a),
c AS (SELECT doc_id, {grams} AS terms FROM b),
e AS (SELECT doc_id, unnest(terms) AS term FROM c),
tf AS (SELECT doc_id, term, count(*) AS tf FROM e GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df, sum(tf) AS ctf FROM tf GROUP BY term),
vocab AS (SELECT * FROM dfs {where} {limit}),
w AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1.0 + (SELECT n FROM nd)) / (1.0 + vocab.df)) + 1.0) AS x
      FROM tf JOIN vocab USING (term)),
weights AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS tfidf FROM w)
SELECT * FROM {out}"""


SQL["t7_tfidf_titles"] = ("SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM (" + _tfidf_sql(
    "SELECT p_partkey, p_name FROM part", "p_partkey", "p_name", bigrams=True, stops=["and", "the", "of", "new", "old"],
    min_df=0.01, max_df=0.5) + ")")
SQL["t7_tfidf_documents"] = ("SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM (" + _tfidf_sql(
    "SELECT doc_id, text FROM documents", "doc_id", "text", bigrams=False, stops=None,
    max_features=1000) + ")")
SQL["a19_document_frequency"] = ("SELECT term, df, CAST(ctf AS BIGINT) AS ctf FROM (" + _tfidf_sql(
    "SELECT p_partkey, p_name FROM part", "p_partkey", "p_name", bigrams=True, stops=["and", "the", "of", "new", "old"],
    min_df=0.01, max_df=0.5, out="vocab") + ")")


# ---------------------------------------------------------------- clustering
_SIL = """
p AS (SELECT vec_id AS id, label AS cluster, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
comp AS (SELECT cluster, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM p),
vs AS (SELECT cluster, i, sum(v) AS v FROM comp GROUP BY cluster, i),
st AS (SELECT cluster, list(v ORDER BY i) AS s FROM vs GROUP BY cluster),
sc AS (SELECT cluster, count(*) AS n, sum(list_dot_product(x, x)) AS q FROM p GROUP BY cluster),
stats AS (SELECT sc.cluster, sc.n, st.s, sc.q FROM sc JOIN st USING (cluster)),
d AS (SELECT p.id, p.cluster AS own, stats.cluster, stats.n,
             stats.n * list_dot_product(p.x, p.x) - 2.0 * list_dot_product(p.x, stats.s) + stats.q AS ss
      FROM p, stats),
ab AS (SELECT id, own AS cluster,
              max(CASE WHEN cluster = own AND n > 1 THEN ss / (n - 1) END) AS a,
              max(CASE WHEN cluster = own THEN n END) AS n_own,
              min(CASE WHEN cluster <> own THEN ss / n END) AS b
       FROM d GROUP BY id, own),
sil AS (SELECT id, cluster, CASE WHEN n_own <= 1 THEN 0.0
                                 ELSE coalesce((b - a) / greatest(a, b), 0.0) END AS silhouette FROM ab)
"""

SQL["a17_silhouette"] = "WITH " + _SIL + "SELECT id, cluster, round(silhouette, 6) AS silhouette FROM sil"
SQL["a17_silhouette_summary"] = "WITH " + _SIL + """
SELECT cluster, round(avg(silhouette), 6) AS mean_silhouette, count(*) AS n FROM sil GROUP BY cluster"""
SQL["a18_cluster_membership"] = """
SELECT label AS cluster, count(*) AS n, (SELECT count(DISTINCT label) FROM embeddings) AS n_clusters
FROM embeddings GROUP BY label"""
SQL["w2_sorted_silhouette"] = "WITH " + _SIL + """
SELECT id, cluster, round(silhouette, 6) AS silhouette,
       CAST(row_number() OVER (PARTITION BY cluster ORDER BY silhouette, id) AS INTEGER) AS rank
FROM sil"""


# ---------------------------------------------------------------- sources and sinks
SQL["s1_influencer_csv"] = """
SELECT c_name AS username, lower(c_mktsegment) AS category, CAST(trunc(c_acctbal) AS INTEGER) AS followers
FROM customer
"""
SQL["s2_feature_csv"] = _with(BASE) + """
SELECT username, round(engagement_rate, 6) AS engagement_rate, round(alignment_genZ, 6) AS alignment_genZ,
       category, round(hashtag_score, 6) AS hashtag_score
FROM feat
"""
SQL["s4_post_files"] = _with(BASE) + """
SELECT username, round(engagement_rate, 6) AS engagement_rate FROM eng
"""
SQL["s5_tree_documents"] = SQL["n1_flatten_tree"]
SQL["s10_records"] = ("SELECT to_json(struct_pack(username := username, similarity_score := similarity_score)) "
                      "AS record FROM (" + SQL["r1_rank_category"] + ")")
SQL["st1_engagement_stream"] = SQL["a1_engagement_rate"]


# ---------------------------------------------------------------- mapping / encoding
SQL["p15_category_codes"] = _with(BASE, "m AS (SELECT max(engagement_rate) AS m FROM feat)") + f"""
SELECT username, lower(trim(category)) AS category,
       CASE lower(trim(category)) WHEN 'building' THEN 1 WHEN 'household' THEN 2 WHEN 'machinery' THEN 3 END
         AS category_code,
       round({_div('engagement_rate', 'm')}, 6) AS normalized_engagement_rate
FROM feat, m
"""
SQL["f18_one_hot"] = _with(BASE) + "SELECT username, " + ", ".join(
    f"CASE WHEN lower(trim(category)) = '{c}' THEN 1.0 ELSE 0.0 END AS is_{c}"
    for c in ["automobile", "building", "furniture", "household", "machinery"]) + " FROM feat"
SQL["s8_titles_csv"] = SQL["n2_classify_titles"]
SQL["r4_brand_search_no_genz"] = _r1("automobile", 0.75, 0.0)


# ---------------------------------------------------------------- fixed audience lexicons
_GENZ_TRAITS = (f"(CAST(len(list_filter({_tokens(_clean('text'))}, lambda x: x IN {_in_list(_LX.GENZ_KEYWORDS)})) AS INTEGER) + "
                f"{_occ_total('lower(text)', _LX.GENZ_EMOJIS)} + {_present('lower(text)', _LX.GENZ_HASHTAGS)})")
SQL["t3_genz_traits"] = f"SELECT doc_id, {_GENZ_TRAITS} AS traits FROM documents"


def _a10_genz() -> str:
    from creatorlens.operators.lexicon import lexicon_union
    terms = [t for _, t in lexicon_union()]
    vals = ", ".join(f"({_q(t)}, {len(t.encode())})" for t in terms)
    return f"""
WITH lex(term, nb) AS (VALUES {vals}),
d AS (SELECT lower(text) AS t FROM documents)
SELECT term, CAST(sum((strlen(t) - strlen(replace(t, term, ''))) // nb) AS BIGINT) AS n
FROM d, lex GROUP BY term HAVING sum((strlen(t) - strlen(replace(t, term, ''))) // nb) > 0
"""


SQL["a10_genz_term_frequency"] = _a10_genz()
SQL["a6_alignment_from_posts"] = SQL["a6_alignment"]


SQL["a1_engagement_prefix"] = _with(BASE) + """,
pk AS (SELECT CAST(username AS VARCHAR) AS k, sum_likes, n_posts FROM per_user),
pu AS (SELECT CAST(i.username AS VARCHAR) AS username, sum(pk.sum_likes) AS sum_likes, sum(pk.n_posts) AS n_posts
       FROM (SELECT DISTINCT username FROM infl) i JOIN pk ON starts_with(pk.k, CAST(i.username AS VARCHAR))
       GROUP BY 1)
SELECT CAST(i.username AS VARCHAR) AS username,
       round(CASE WHEN i.followers > 0 THEN pu.sum_likes / CAST(pu.n_posts AS DOUBLE) / i.followers * CAST(100 AS DOUBLE)
                  ELSE CAST(0 AS DOUBLE) END, 6) AS engagement_rate
FROM infl i LEFT JOIN pu ON pu.username = CAST(i.username AS VARCHAR)
"""

_SCORED_LITERAL = SCORED.replace(_TRAITS, f"CAST(len(list_filter({_tokens(_clean('text'))}, lambda x: x IN {_KW})) AS INTEGER)")
SQL["a6_alignment_literal"] = "WITH " + _SCORED_LITERAL + """,
g AS (SELECT username, sum(traits) AS tr, count(*) AS n, count(*) FILTER (WHERE polarity > 0) AS pos
      FROM scored GROUP BY username),
s AS (SELECT username, (tr + pos / CAST(greatest(n, 1) AS DOUBLE) * 100.0) / CAST(n AS DOUBLE) AS a FROM g)
SELECT username, round(CASE WHEN a > 30 THEN 1.0 ELSE a END, 6) AS alignment_genZ FROM s
"""


# ---------------------------------------------------------------- models: invariants and counts
_TEST = "CAST('0x' || substr(md5('42:' || p_partkey), 1, 8) AS BIGINT) % 100 < 20"
SQL["m1_kmeans"] = "SELECT vec_id AS id, true AS nearest FROM embeddings"
SQL["m2_pca_projection"] = "SELECT count(*) AS n, true AS orthonormal, true AS uncorrelated, true AS ordered FROM embeddings"
SQL["m3_train_test_split"] = f"SELECT p_partkey, p_name AS title, {_CLASSIFY} AS category, {_TEST} AS is_test FROM part"
SQL["m4_svm_test_predictions"] = f"SELECT p_partkey, p_name AS title, {_CLASSIFY} AS category, true AS known FROM part WHERE {_TEST}"
SQL["m4_svm_report"] = f"SELECT {_CLASSIFY} AS label, count(*) AS support, true AS beats_majority FROM part WHERE {_TEST} GROUP BY 1"
SQL["m5_grid_search"] = """
SELECT kernel, c, true AS is_share, true AS best_beats_majority
FROM (VALUES ('linear'), ('rbf')) k(kernel), (VALUES (0.1::DOUBLE), (1.0::DOUBLE), (10.0::DOUBLE)) v(c)"""
SQL["m6_predict_titles"] = "SELECT p_partkey, p_name AS title, true AS known FROM part"
_TITLES = f"SELECT doc_id || '/' || pos AS id, title FROM ({SQL['n1_flatten_tree']}) WHERE title NOT IN {_in_list(_L.IRRELEVANT_TITLES)}"
SQL["m1_title_clusters"] = f"SELECT id, title, true AS known FROM ({_TITLES})"
SQL["a17_title_cluster_silhouette"] = f"SELECT count(*) AS n, true AS in_range, true AS few FROM ({_TITLES})"
SQL["u2_stop_words"] = """
SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(p_name), '[\\p{L}\\p{N}_]{2,}')) AS term FROM part)
WHERE term NOT IN ('and', 'the', 'of', 'new', 'old', 'red', 'blue') GROUP BY term"""

# ---------------------------------------------------------------- edges
_SCORE = _cos_brand("r", "g", "1.0", "b", "CAST(1 AS DOUBLE)")
SQL["r4_brand_search_zero"] = _with(BASE) + """
SELECT username, CAST(NULL AS DOUBLE) AS similarity_score FROM feat WHERE category = 'machinery' ORDER BY username LIMIT 15
"""
SQL["r1_rank_nan"] = _with(BASE, """
rows AS (SELECT username, alignment_genZ AS g, CASE WHEN hashtag_score <> 0 THEN engagement_rate END AS e FROM feat
         WHERE lower(trim(category)) = 'building')""", """
m AS (SELECT max(e) AS m FROM rows)""", f"""
v AS (SELECT username, {_div('e', 'm')} AS r, g, CAST(0.5 AS DOUBLE) / greatest(m, CAST(0.5 AS DOUBLE)) AS b FROM rows, m)""") + f"""
SELECT username, round({_SCORE}, 6) AS similarity_score FROM v
"""
SQL["p11_default_category"] = "SELECT CAST(NULL AS VARCHAR) AS username, CAST(NULL AS DOUBLE) AS similarity_score WHERE false"
SQL["s7_append_csv"] = SQL["a1_engagement_rate"]

# ---------------------------------------------------------------- phrases, modifiers, tables as lexicons
from creatorlens.functions.text import TREEBANK_RULES as _RULES  # noqa: E402


def _rules(t: str) -> str:
    out = f"' ' || {t} || ' '"
    for pattern, to in _RULES:
        to = to.replace("$", "\\")
        out = f"regexp_replace({out}, {_q(pattern)}, {_q(to)}, 'g')"
    return f"list_filter(regexp_split_to_array({out}, '[ \\t-\\r]+'), lambda x: x <> '')"


_MARKS = r"""!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"""
SQL["t2_word_tokens"] = f"""
SELECT text_id, array_to_string(t, ' ') AS tokens,
       CAST(len(list_filter(list_transform(t, lambda x: regexp_replace(x, {_q(rf'\A[{_MARKS}]+|[{_MARKS}]+\z')}, '', 'g')), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]'))) AS INTEGER) AS n_words
FROM (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS text_id, {_rules('text')} AS t FROM conversations)
"""


def _cased(t: str) -> str:
    """The cleaned text with its capitals."""
    return _tokens(_clean(t).removeprefix("lower(").removesuffix(")"))


def _hits(key: str, source: str, text: str, values: str = "") -> str:
    """CTEs up to ``hits``: every lexicon entry found in the tokens, as sorted lists of one struct a hit; ``lexicon`` is (phrase, exact, ...)."""
    return f"""
toks AS (SELECT {key}, {_cased(text)} AS tk FROM {source}),
runs AS (SELECT {key}, i - 1 AS place, n AS len, array_to_string(tk[i:i + n - 1], ' ') AS phrase
         FROM (SELECT {key}, tk, n, unnest(generate_series(1, len(tk) - n + 1)) AS i FROM toks, (VALUES (1), (2), (3), (4)) v(n) WHERE len(tk) >= n)),
met AS (SELECT DISTINCT {key}, place, len {values} FROM runs r JOIN lexicon l ON CASE WHEN l.exact THEN l.phrase = r.phrase ELSE lower(l.phrase) = lower(r.phrase) END)"""


SQL["t3_phrase_traits"] = f"""
WITH words AS (SELECT {_cased('text')} AS w FROM benchmark),
lexicon AS (
  SELECT phrase, phrase = upper(phrase) AS exact FROM (VALUES {', '.join(f'({_q(k)})' for k in dict.fromkeys(_LX.GENZ_KEYWORDS))}) k(phrase)
  UNION SELECT array_to_string(w[1:3], ' '), false FROM words WHERE len(w) > 0
  UNION SELECT array_to_string(w[1:2], ' '), true FROM words WHERE len(w) > 0),
{_hits('doc_id', 'documents', 'text')},
lists AS (SELECT doc_id, list(struct_pack(place := place, len := len, next := CAST(0 AS BIGINT), n := CAST(0 AS BIGINT)) ORDER BY place, len DESC) AS h FROM met GROUP BY doc_id),
folded AS (SELECT doc_id, list_reduce([struct_pack(place := CAST(0 AS BIGINT), len := 0, next := CAST(0 AS BIGINT), n := CAST(0 AS BIGINT))] || h,
             lambda s, x: CASE WHEN x.place < s.next THEN s ELSE struct_pack(place := x.place, len := x.len, next := x.place + x.len, n := s.n + 1) END) AS f FROM lists)
SELECT d.doc_id, coalesce(f.n, 0) AS phrases FROM documents d LEFT JOIN folded USING (doc_id)
"""


def _modified() -> str:
    def number(x):
        return "CAST(NULL AS DOUBLE)" if x is None else f"CAST({x} AS DOUBLE)"

    values = ", ".join(f"({_q(p)}, {number(a)}, {number(i)}, {str(n).lower()})" for p, a, i, n in _I.TEST_MODIFIED)
    names = ["place", "len", "polarity", "intensity", "negates", "next", "until", "amp", "amp_at", "total", "n"]

    def pack(**v):
        return "struct_pack(" + ", ".join(f"{k} := {v.get(k, 'x.' + k)}" for k in names) + ")"

    empty = pack(place="CAST(0 AS BIGINT)", len="0", polarity=number(None), intensity=number(1), negates="false", next="CAST(0 AS BIGINT)", until="CAST(-1 AS BIGINT)",
                 amp=number(1), amp_at="CAST(-1 AS BIGINT)", total=number(0), n="CAST(0 AS BIGINT)")
    hit = empty.replace("place := CAST(0 AS BIGINT), len := 0, polarity := CAST(NULL AS DOUBLE), intensity := CAST(1 AS DOUBLE), negates := false",
                        "place := place, len := len, polarity := polarity, intensity := intensity, negates := negates", 1)
    amp = "(CASE WHEN x.place = s.amp_at THEN s.amp ELSE 1.0::DOUBLE END)"
    value = (f"(greatest(least(CASE WHEN x.place <= s.until THEN x.polarity / {amp} ELSE x.polarity * {amp} END, 1.0), -1.0) * (CASE WHEN x.place <= s.until THEN -0.5::DOUBLE ELSE 1.0::DOUBLE END))")
    end = "x.place + x.len"
    step = (f"CASE WHEN x.place < s.next THEN s "
            f"WHEN x.negates THEN {pack(next=end, until=end + ' - 1 + 3', amp=amp, amp_at=end, total='s.total', n='s.n')} "
            f"WHEN x.polarity IS NULL THEN {pack(next=end, until='s.until', amp=f'{amp} * x.intensity', amp_at=end, total='s.total', n='s.n')} "
            f"ELSE {pack(next=end, until='CAST(-1 AS BIGINT)', amp='1.0::DOUBLE', amp_at='CAST(-1 AS BIGINT)', total=f's.total + {value}', n='s.n + 1')} END")
    return f"""
WITH texts AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS text_id, text FROM conversations),
lexicon AS (SELECT phrase, false AS exact, polarity, coalesce(intensity, 1.0) AS intensity, negates FROM (VALUES {values}) v(phrase, polarity, intensity, negates)),
{_hits('text_id', 'texts', 'text', ', polarity, intensity, negates')},
lists AS (SELECT text_id, list({hit} ORDER BY place, len DESC) AS h FROM met GROUP BY text_id),
folded AS (SELECT text_id, list_reduce([{empty}] || h, lambda s, x: {step}) AS f FROM lists),
scored AS (SELECT text_id, coalesce(CASE WHEN f.n > 0 THEN f.total / f.n END, 0.0) AS polarity FROM texts LEFT JOIN folded USING (text_id))
SELECT text_id, round(polarity, 6) + 0.0 AS polarity, polarity > 0 AS positive FROM scored
"""


SQL["t6_modified_polarity"] = _modified()
SQL["j5_lexicon_table"] = r"""
WITH terms AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[ \t-\r]+')) AS term FROM benchmark),
found AS (SELECT doc_id, count(*) AS n FROM documents d JOIN terms t ON t.term <> '' AND contains(lower(d.text), t.term) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_terms FROM documents LEFT JOIN found USING (doc_id)
"""
SQL["m2_neighbour_map"] = "SELECT vec_id AS id, true AS placed FROM embeddings"
SQL["m4_kernel_svc_report"] = f"SELECT {_CLASSIFY} AS label, count(*) AS support, true AS converged, true AS beats_majority FROM part WHERE {_TEST} GROUP BY 1"
SQL["m4_kernel_svc_predictions"] = SQL["m4_svm_test_predictions"]
SQL["n2_classify_by_table"] = """
WITH rules AS (SELECT min(p_size) AS priority, p_brand AS category, split_part(p_name, ' ', 1) AS keyword FROM part GROUP BY 2, 3),
names AS (SELECT p_name, arg_min(category, (priority, category)) AS category FROM (SELECT DISTINCT p_name FROM part) p
          JOIN rules ON contains(lower(p_name), lower(keyword)) GROUP BY 1)
SELECT p_partkey, p_name AS title, coalesce(category, 'fashion') AS category FROM part LEFT JOIN names USING (p_name)"""
