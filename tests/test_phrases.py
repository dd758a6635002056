import random
import re

import pytest
from pyspark.sql import functions as F

from creatorlens.functions import text as tx
from creatorlens.operators import lexicon as lex
from creatorlens.operators import phrases, sentiment


def greedy(tokens, entries, longest=4):
    """[(place, words, entry)] from left to right, the longest entry at each place; ``entries``: {words: value}, a dict
    for each of (any case, as written)."""
    folded, exact = entries
    out, at = [], 0
    while at < len(tokens):
        for n in range(min(longest, len(tokens) - at), 0, -1):
            run = " ".join(tokens[at:at + n])
            hit = folded.get(run.lower(), exact.get(run))
            if hit is not None:
                out.append((at, n, hit))
                at += n
                break
        else:
            at += 1
    return out


def texts(seed, words, n=60):
    r = random.Random(seed)
    return [" ".join(r.choice([w, w, w.upper(), w.capitalize()]) for w in r.choices(words, k=r.randrange(0, 25))) for _ in range(n)]


def test_phrases_against_brute_force(spark):
    lexicon = [("no cap", False), ("glow up", False), ("hits different", False), ("L", True), ("OTP", True), ("cap", False),
               ("stan twitter", False), ("stan", False), ("and i oop", False), ("  Spill  the tea ", False), ("", False), (None, False), ("up", None)]
    rows = texts(1, ["no", "cap", "glow", "up", "hits", "different", "l", "otp", "stan", "twitter", "and", "i", "oop", "spill", "the", "tea"])
    rows += rows[:5] + ["", "spill the tea no cap glow up L l", "123 !!", "and i"]
    df = spark.createDataFrame([(i % 50, t) for i, t in enumerate(rows)] + [(1, None)], "id long, text string").repartition(3)
    entries = ({" ".join(p.lower().split()): 1 for p, e in lexicon if p and not e}, {p: 1 for p, e in lexicon if p and e})
    got = phrases.count_phrases(df, spark.createDataFrame(lexicon, "phrase string, exact boolean"), id_col="id").collect()
    clean = lambda t: re.sub("[^a-zA-Z\\s]", "", t).split()
    want = [(i % 50, len(greedy(clean(t), entries))) for i, t in enumerate(rows)] + [(1, 0)]
    assert sorted(tuple(r) for r in got) == sorted(want) and max(n for _, n in want) > 3
    assert phrases.count_phrases(df.limit(0), spark.createDataFrame(lexicon, "phrase string, exact boolean"), id_col="id").collect() == []


def test_only_runs_that_can_match_are_joined(spark):
    """The texts are cleaned once, and of their runs only those of the lexicon go on; copies of an entry are one."""
    r = random.Random(7)
    rows = [[f"{r.choice('xyz')}{r.randrange(1000)}" for _ in range(200)] for _ in range(40)]
    rows[3][10:12], rows[5][0:3], rows[5][199:] = ["Glow", "UP"], ["É", "glow", "up"], ["OTP"]
    rows += [["É"], [], None, ["otp"], ["w"] * 600_000 + ["no", "Cap"]]
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "k long, t array<string>").repartition(3)
    lexicon = spark.createDataFrame([("glow up", False, 1)] * 50 + [("Glow Up", False, 1), ("OTP", True, 2), ("é", None, 3), ("no Cap", True, 4), ("no cap", True, 5), ("a b c d e", False, 6)],
                                    "phrase string, exact boolean, v int")
    runs = phrases.marked_runs(texts, "k", "t", phrases.entry_marks(lexicon.where("v < 6")), 2)
    assert sorted((x.k, x.at, x.len, x.phrase) for x in runs.collect() if x.phrase.lower() in ("é", "glow up", "otp", "no cap")) == [
        (3, 10, 2, "Glow UP"), (5, 0, 1, "É"), (5, 1, 2, "glow up"), (5, 199, 1, "OTP"), (40, 0, 1, "É"), (43, 0, 1, "otp"), (44, 600_000, 2, "no Cap")]
    assert runs.where("k < 44").count() < 100
    got = {x.k: [tuple(h) for h in x.hits] for x in phrases.phrase_hits(texts, lexicon, key="k", token_col="t", values=["v"]).collect()}
    assert got == {3: [(10, -2, 1)], 5: [(0, -1, 3), (1, -2, 1), (199, -1, 2)], 40: [(0, -1, 3)], 44: [(600_000, -2, 4)]}
    assert phrases.phrase_hits(texts, lexicon.limit(0), key="k", token_col="t").collect() == []
    counted = phrases.count_phrases(spark.createDataFrame([(1, "no cap")], "id long, text string"), lexicon.drop("v"), id_col="id")
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("http[") == 1 and "explode(concat" not in plan and [tuple(x) for x in counted.collect()] == [(1, 1)]


def test_planted_slang_is_found(spark):
    from creatorlens import lexicons as L
    df = spark.createDataFrame([(1, "That fit hits different, no cap! glow up W"), (2, "w l otp"), (3, "OTP")], "id long, text string")
    got = {r.id: r.phrases for r in phrases.count_phrases(df, phrases.keyword_entries(spark, L.GENZ_KEYWORDS), id_col="id").collect()}
    assert got == {1: 4, 2: 0, 3: 1}


LEXICON = [("good", 0.7, None, False), ("bad", -0.7, None, None), ("very", None, 1.3, False), ("slightly", None, 0.5, False), ("not", None, None, True),
           ("never", None, None, True), ("hardly", None, 0.5, True), ("very good", 1.0, None, False), ("no good", -0.9, None, False), ("Great", 0.8, None, False), ("great", 0.6, None, False)]


def brute_polarity(text, window=3, factor=-0.5):
    folded = {}
    for p, pol, inten, neg in LEXICON:
        folded[p.lower()] = (0.7 if p.lower() == "great" else pol, 1.0 if inten is None else inten, bool(neg))
    amp, amp_at, until, found = 1.0, -1, -1, []
    for at, n, (pol, inten, neg) in greedy(re.sub("[^a-z\\s]", "", (text or "").lower()).split(), (folded, {})):
        amp = amp if at == amp_at else 1.0
        if neg:
            until, amp_at = at + n - 1 + window, at + n
        elif pol is None:
            amp, amp_at = amp * inten, at + n
        else:
            turned = at <= until
            v = max(-1.0, min(1.0, pol / amp if turned else pol * amp))
            found.append(v * factor if turned else v)
            amp, amp_at, until = 1.0, -1, -1
    return sum(found) / len(found) if found else 0.0


def test_modified_polarity_against_brute_force(spark):
    rows = texts(2, ["good", "bad", "very", "slightly", "not", "never", "hardly", "no", "great", "x", "y"], 200)
    rows += ["not very good at all", "very very bad", "not a b good", "not a b c good", "very x good", "", "!!", rows[0], "never not good"]
    df = spark.createDataFrame(list(enumerate(rows)) + [(900, None)], "id long, text string").repartition(4)
    lexicon = spark.createDataFrame(LEXICON, "phrase string, polarity double, intensity double, negates boolean")
    got = {r.id: r.polarity for r in sentiment.score_modified(df, lexicon, id_col="id").collect()}
    assert got == pytest.approx({**{i: brute_polarity(t) for i, t in enumerate(rows)}, 900: 0.0})


def test_modifiers_by_hand(spark):
    lexicon = spark.createDataFrame([e for e in LEXICON if e[0] != "very good"], "phrase string, polarity double, intensity double, negates boolean")
    rows = {"not very good": -0.5 * 0.7 / 1.3, "very good": 0.91, "very very good": 1.0, "not good": -0.35, "not one two good": -0.35, "not one two three good": 0.7,
            "very stranger good": 0.7, "not good bad": (-0.35 - 0.7) / 2}
    df = spark.createDataFrame(list(rows.items()), "text string, want double")
    for r in sentiment.score_modified(df, lexicon, id_col="text", carry=["want"]).collect():
        assert r.polarity == pytest.approx(r.want), r.text


def test_scores_do_not_meet_in_one_task(spark):
    """Texts without tokens, and one text that most rows repeat, are dealt over parts."""
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, "!!").otherwise("very good").alias("text"))
    lexicon = spark.createDataFrame(LEXICON, "phrase string, polarity double, intensity double, negates boolean")
    staged = phrases.keyed(df.select("id", tx.tokens(tx.clean_text(F.col("text"))).alias("t")), "t", "id")
    sizes = [r["count"] for r in staged.groupBy("_list", "_salt").count().collect()]
    assert max(sizes) < 4000 / phrases.SALTS
    assert sentiment.score_modified(df, lexicon, id_col="id").where("polarity = 1.0").count() == 2000


def test_treebank_tokens(spark):
    rows = {
        "I don't know, they'll say \"yes\".": ["I", "do", "n't", "know", ",", "they", "'ll", "say", "``", "yes", "''", "."],
        "Wait... (it's 3,000 dollars!)": ["Wait", "...", "(", "it", "'s", "3,000", "dollars", "!", ")"],
        "We cannot go--'tis late; I'm gonna rest": ["We", "can", "not", "go", "--", "'t", "is", "late", ";", "I", "'m", "gon", "na", "rest"],
        "a.b.c ends. Here": ["a.b.c", "ends.", "Here"],
        "": [], " \t ": [],
    }
    df = spark.createDataFrame([(t,) for t in rows] + [(None,)], "text string").select("text", tx.treebank_tokens("text").alias("t"), tx.word_tokens("text").alias("w"))
    got = {r.text: r for r in df.collect()}
    assert {k: r.t for k, r in got.items() if k is not None} == rows and got[None].t is None
    assert got["Wait... (it's 3,000 dollars!)"].w == ["Wait", "it", "'s", "3,000", "dollars"]


def test_terms_of_a_table(spark, monkeypatch):
    r = random.Random(3)
    alphabet = "abcé😂 "
    rows = ["".join(r.choices(alphabet, k=r.randrange(0, 40))) for _ in range(80)]
    terms = list({"".join(r.choices(alphabet, k=r.randrange(1, 6))) for _ in range(300)}) + ["", None, "a", "A", "ab"]
    df = spark.createDataFrame(list(enumerate(rows)) + [(3, "AbC"), (200, None), (201, "ab" * 20_000)], "id long, text string").repartition(3)
    lexicon = spark.createDataFrame([(t,) for t in terms], "term string")
    got = lex.terms_present(df, lexicon, id_col="id").collect()
    monkeypatch.setattr(lex, "AUTOMATON_TERMS", 3)
    assert sorted(tuple(r) for r in lex.terms_present(df, lexicon, id_col="id").collect()) == sorted(tuple(r) for r in got)
    assert {r.n_terms for r in lex.terms_present(df, lexicon.where("term is null"), id_col="id").collect()} == {0}
    known = {t for t in terms if t}
    want = [(i, sum(t in x.lower() for t in known)) for i, x in [*enumerate(rows), (3, "AbC"), (200, ""), (201, "ab" * 20_000)]]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_counts_are_left_to_right(spark):
    terms = ["aa", "aba", "#x", "😂", "😂😂", "é", "tea", "a"]
    rows = ["aaaaa", "ababa", "#x#x tea", "😂😂😂", "été É", None, "", "TEA"]
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    got = {r.term: r.n for r in lex.term_frequency(df, terms).collect()}
    assert got == {t: n for t in terms if (n := sum((x or "").lower().count(t) for x in rows))}
