import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from creatorlens.llm import lexical
from creatorlens.llm.common import written
from tests.llm import messy


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(items, docs, k=20):
    bags = [Counter(terms(t)) for _, t in docs]
    n, total = sum(bool(b) for b in bags), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for (doc, _), bag in zip(docs, bags):
            if not bag:
                continue
            m = 100 - 25 + (25 * sum(bag.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m)) for t in terms(text) if t in bag)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, n=400):
    r = random.Random(seed)
    words = [f"t{int(r.paretovariate(0.7))}" for _ in range(3000)]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 1, 5, 30, 200])))) for i in range(n)]
    docs += docs[:30] + [(None, docs[5][1]), (7, None), (9, " .,! ")]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 1, 3, 30])))) for i in range(40)]
    items += [(100, None), (101, "unknown words"), (102, "T1 t1 t1 T2 t2"), items[3], (None, "t2 t3")]
    return items, docs


def _run(spark, items, docs, **more):
    a = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score long")
    b = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, k long, rank long").repartition(5)
    return sorted([tuple(r) for r in lexical.ranked(a, b, **more).collect()], key=repr)


def test_against_brute_force(spark):
    items, docs = corpus(1)
    assert _run(spark, items, docs) == brute(list(dict.fromkeys(items)), docs)


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_DOCS", 25)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 100)
    items, docs = corpus(2)
    assert _run(spark, items, docs, k=7) == brute(list(dict.fromkeys(items)), docs, 7)


def test_messy_documents(spark):
    items = [(1, "the of and"), (2, "été NAÏVE über"), (3, "x1 42 don't"), (4, "")]
    a = spark.createDataFrame(items, "item_id long, text string")
    got = sorted([tuple(r) for r in lexical.ranked(a, messy.docs(spark)).collect()], key=repr)
    assert got == brute(items, [(r[0], r[1]) for r in messy.rows()])
    assert lexical.ranked(a, messy.empty(spark)).collect() == []
    assert lexical.ranked(a.limit(0), messy.docs(spark)).collect() == []


@pytest.fixture(scope="module")
def shard(spark):
    items, docs = corpus(4, 2000)
    a, b = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    rows = [(r.terms, r.times) for r in lexical.query_terms(a, "item_id", "text").collect()]
    terms_ = spark.createDataFrame([(t,) for t in {t for own, _ in rows for t in own}], "term long")
    index = written(lexical.shards(b, "doc_id", "text", lexical.mark_table(terms_)), "test-shards")
    n, total = index.agg({"filled": "sum", "total": "sum"}).select("sum(filled)", "sum(total)").first()
    df = {r.term: r.df for r in lexical.document_frequencies(index).collect()}
    block = lexical.Queries(rows, df, n)
    (row,) = lexical.impact_lists(index, block, n, total, "bigint").collect()
    kinds = (np.int32, np.int64, np.int32, np.int64, np.int64, np.int64, np.int32)
    return lexical.Shard(block, len(row[0]), *(np.frombuffer(bytes(x), t) for x, t in zip(row[1:], kinds)))


def test_pair_bounds_hold_and_tighten(shard):
    """No document scores above the bound of a prefix; pairs give smaller bounds than the terms' own maxima."""
    tighter = 0
    for q in range(len(shard.block.queries)):
        (terms_, paired), (same, single) = shard.bounds(q), shard.bounds(q, use_pairs=False)
        assert terms_ == same and all(a <= b for a, b in zip(paired, single)) and paired == sorted(paired)
        tighter += paired[-1:] < single[-1:]
        score = np.zeros(shard.size, np.int64)
        for (t, c), bound in zip(terms_, paired):
            score[shard.lists[t][0]] += shard.lists[t][1] * c
            assert score.max() <= bound
    assert tighter > 5


def test_skipping_loses_nothing(shard):
    """Results equal full scores, and pair bounds leave fewer documents to score than single ones."""
    counts = {}
    for pairs in (True, False):
        shard.evaluated = 0
        for q in range(len(shard.block.queries)):
            docs, scores = shard.search(q, 10, 1, pairs)
            full = np.zeros(shard.size, np.int64)
            for t, c in shard.bounds(q)[0]:
                full[shard.lists[t][0]] += shard.lists[t][1] * c
            want = [d for d in np.lexsort((np.arange(shard.size), -full))[:10] if full[d] > 0]
            assert docs.tolist() == want and scores.tolist() == full[want].tolist()
            if len(want) == 10:
                assert shard.search(q, 10, int(scores[-1]), pairs)[0].tolist() == want
        counts[pairs] = shard.evaluated
    assert counts[True] < counts[False]
