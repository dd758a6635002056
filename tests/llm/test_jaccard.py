import random
import re

import numpy as np
import pytest

from creatorlens.llm import jaccard
from tests.llm import messy


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return set()
    return {tuple(words[i:i + 4]) for i in range(len(words) - 3)} or {tuple(words)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None and (find(k) not in least or i < least[find(k)]):
            least[find(k)] = i
    return sorted([(i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))], key=repr)


def corpus(seed, groups=14, size=14):
    """Groups of copies edited more and more, so that many pairs lie about the threshold, with shared passages."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [[r.choice(words) for _ in range(n)] for n in (30, 60)]
    rows = []
    for _ in range(groups):
        base = [r.choice(words) for _ in range(r.choice([5, 20, 60, 150]))]
        for _ in range(size):
            text = base[:]
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                k = r.randrange(len(text))
                text[k:k + 1] = r.choice([[], ["x"], [r.choice(words), text[k]]])
            if r.random() < 0.2:
                text += r.choice(shared)
            if r.random() < 0.3:
                base = text
            rows.append((len(rows), " ".join(text)))
    r.shuffle(rows)
    return rows + [(i, t) for i, t in enumerate(messy.texts(), 1000)]


def _run(spark, rows):
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, a long, n long, token long").repartition(5)
    return sorted([tuple(r) for r in jaccard.jaccard_join(df).collect()], key=repr)


def test_against_brute_force(spark):
    rows = corpus(1)
    assert _run(spark, rows) == brute(rows)


def test_many_blocks_and_no_star(spark, monkeypatch):
    """The tries alone, over blocks of a few sets, find every component."""
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(jaccard, "star_links", lambda nodes, entries: nodes.selectExpr("a", "b", "a AS c", "b AS d").limit(0))
    rows = corpus(2, groups=8)
    assert _run(spark, rows) == brute(rows)


def test_chain_of_links(spark):
    """Neighbours link, ends don't: one component."""
    text = [f"a{i}" for i in range(100)]
    rows = []
    for i in range(40):
        rows.append((40 - i, " ".join(text)))
        text = text[1:] + [f"b{i}"]
    rows.append((41, " ".join(f"z{i}" for i in range(100))))
    assert _run(spark, rows) == brute(rows)


def test_messy_and_empty_tables(spark):
    got = sorted([tuple(r) for r in jaccard.jaccard_join(messy.docs(spark)).collect()], key=repr)
    assert got == brute([(r[0], r[1]) for r in messy.rows()])
    assert jaccard.jaccard_join(messy.empty(spark)).collect() == []


def test_one_of_each(spark):
    rows = messy.rows()
    out = jaccard.one_of_each(messy.docs(spark))
    assert out.columns == messy.docs(spark).columns
    keep = {i for i, n, c in brute([(r[0], r[1]) for r in rows]) if i is not None and i == c}
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert {i for i, _ in got if i is not None} == keep and len([1 for i, _ in got if i is None]) == 2
    assert len(set(got)) == len(got)


@pytest.mark.parametrize("seed", range(4))
def test_trie_finds_every_link(seed):
    r = np.random.default_rng(seed)
    base = [r.choice(5000, n, replace=False) for n in (3, 17, 40, 200)]
    sets = []
    for one in base * 12:
        own = set(one.tolist())
        own ^= set(r.choice(5000, r.integers(0, max(2, len(one) // 8))).tolist())
        sets.append(np.array(sorted(own), np.uint64))
    trie = jaccard.Trie(sets, np.arange(len(sets)))
    for i, own in enumerate(sets):
        want = [j for j, o in enumerate(sets) if j != i and len(own) and len(o) and 100 * len(np.intersect1d(own, o)) >= 85 * len(np.union1d(own, o))]
        assert sorted(set(trie.links(own, i).tolist()) - {i}) == want


def test_prefix_and_threshold():
    for n in range(1, 300):
        least = min(i for i in range(1, n + 1) if 100 * i >= 85 * n)  # of a partner that holds the set's own share
        assert jaccard.prefix_sizes(np.array([n]))[0] == n - least + 1
        for m in (n, n + 1, n + 7):
            want = next((i for i in range(min(n, m) + 1) if 100 * i >= 85 * (n + m - i)), None)
            assert want is None or jaccard.least_overlap(n, m) == want


def _kept(rows, words, percent):
    """The ids whose component (of ``words``-word shingles, ``percent`` of the union) has none smaller."""
    sets = []
    for _, text in rows:
        own = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(({tuple(own[i:i + words]) for i in range(len(own) - words + 1)} or {tuple(own)}) if own else set())
    least = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * len(sets[i] | sets[j]) and least[i] != least[j]:
                    low = i if rows[least[i]][0] < rows[least[j]][0] else j
                    least[i] = least[j] = least[low]
                    changed = True
    return {rows[k][0] for k in range(len(rows)) if least[k] == k}


@pytest.mark.parametrize("words,percent", [(5, 80), (3, 60)])
def test_other_words_and_percentages(spark, words, percent):
    rows = corpus(5, groups=8)
    got = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), words=words, percent=percent)
    assert {r.doc_id for r in got.collect()} == _kept(rows, words, percent)


def test_pipeline_stage_takes_five_words_and_four_fifths(spark):
    import corpus_pipeline
    rows = corpus(6, groups=8)
    got = corpus_pipeline.jaccard_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in got.collect()} == _kept(rows, 5, 80) != _kept(rows, 4, 85)


def test_one_row_of_each_by_row(spark):
    """Rows with equal or null ids are documents of their own; of each component one row stays."""
    words = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    rows = [(3, words), (5, words), (5, other), (None, other), (None, "just alone here now"), (None, "just alone here now"), (8, None), (8, None), (9, " ")]
    got = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([tuple(r) for r in got], key=repr) == sorted([(3, words), (5, other), (None, "just alone here now"), (8, None), (9, " ")], key=repr)


def test_leaves_the_session_usable(spark):
    """Fitted linear models still score after a join in the same session."""
    from creatorlens.plans.queries import QUERIES
    assert jaccard.op8_jaccard(spark, "/root/testdata/sf0.001").count()
    for name in ("m4_svm_test_predictions", "m6_predict_titles"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").collect()
