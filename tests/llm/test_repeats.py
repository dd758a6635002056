import hashlib
import random
import re

import numpy as np
import pytest

from creatorlens.llm import repeats
from tests.llm import messy


def brute(rows, window):
    words = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k:k + window])] < i:
                    gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), kept))
    return sorted(out, key=repr)


def corpus(seed, window):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["A", "a", "é"]
    passages = [[r.choice(words) for _ in range(n)] for n in (window - 1, window, window + 1, 3 * window)]
    rows = []
    for _ in range(60):
        text = [r.choice(words) for _ in range(r.randrange(0, 3 * window))]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(text) + 1)
            text[at:at] = r.choice(passages)
        if r.random() < 0.2:
            text = ["x", "y"] * r.randrange(5 * window)
        rows.append(r.choice([" ", "\n", " \t"]).join(text))
    rows += rows[:20]
    ids = list(range(len(rows)))
    r.shuffle(ids)
    return list(zip(ids, rows)) + [(3, passages[3] and " ".join(passages[3])), (None, " ".join(passages[3]))]


def _run(spark, rows, window, **more):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, k long, words long").repartition(4)
    return sorted([tuple(r) for r in repeats.without_repeats(df, window=window, **more).collect()], key=repr)


@pytest.mark.parametrize("window", [12, 50])
def test_against_brute_force(spark, window):
    rows = corpus(window, window)
    assert _run(spark, rows, window) == brute(rows, window)


def test_hot_buckets_and_copies(spark, monkeypatch):
    """Every bucket too large to sort, or every super-k-mer dealt over parts: the same result."""
    rows = corpus(5, 12)
    want = brute(rows, 12)
    monkeypatch.setattr(repeats, "BUCKET", 1)
    monkeypatch.setattr(repeats, "HOT", 1)
    assert _run(spark, rows, 12) == want
    monkeypatch.setattr(repeats, "BUCKET", 0)
    assert _run(spark, rows, 12) == want


def test_messy_documents_and_digest(spark):
    rows = [(r[0], r[1]) for r in messy.rows()]
    df = messy.docs(spark)
    got = sorted([tuple(r) for r in repeats.without_repeats(df, digest=True).collect()], key=repr)
    assert got == sorted([(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute(rows, 50)], key=repr)
    assert repeats.without_repeats(messy.empty(spark)).collect() == []


def test_string_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([("b", text), ("a", text), (None, text)], "name string, body string")
    got = {r.id: r.n_removed for r in repeats.without_repeats(df, "name", "body", 10).collect()}
    assert got == {"a": 0, "b": 20, None: 0}


def test_ranks_and_minimisers():
    r = np.random.default_rng(1)
    for window in (9, 16, 50):
        words = r.integers(0, 2, 400).astype(np.uint64)
        starts = np.arange(len(words) - window + 1)
        ranks = repeats.window_ranks(words, starts, window)
        keys = [words[s:s + window].tobytes() for s in starts]
        assert len(set(zip(keys, ranks.tolist()))) == len(set(keys)) == len(set(ranks.tolist()))
        least = repeats.minimisers(words, window)
        for x, y in zip(*np.unique(ranks, return_index=True)):
            assert len(set(least[ranks == x].tolist())) == 1
        m, at, n = repeats.stretches(words, None, window)
        assert n.sum() == len(starts) and (np.repeat(m, n) == least).all()


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 100)
    r = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    base = [r.choice(words) for _ in range(5000)]
    rows = [(0, " ".join(base)), (1, " ".join(base[37:3000] + ["z"] + base[2500:])), (2, "q " * 3000)]
    assert _run(spark, rows, 50) == brute(rows, 50)
