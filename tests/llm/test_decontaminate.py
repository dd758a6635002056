import random

import numpy as np

from creatorlens.llm import decontaminate as D
from tests.llm import messy


def brute_align(a, b):
    best, last = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, last[j] + (D.MATCH if x == y else D.MISMATCH), last[j + 1] + D.GAP, row[j] + D.GAP))
        best, last = max(best, *row), row
    return best


def test_alignment_against_brute_force():
    r = np.random.default_rng(1)
    pairs = [(r.integers(0, 6, r.integers(1, 30)).astype(np.uint64), r.integers(0, 6, r.integers(1, 60)).astype(np.uint64)) for _ in range(200)]
    got = D.align([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [brute_align(a.tolist(), b.tolist()) for a, b in pairs]


def _corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(3000)] + ["the", "of", "and"] * 300
    text = lambda n: [r.choice(words) for _ in range(n)]
    items = [(i, text(r.randint(15, 60))) for i in range(30)]
    docs, leaks = [], set()
    for i in range(200):
        body = text(r.choice([20, 100, 400]))
        if i % 4 == 0:
            k, item = r.choice(items)
            item = item[:]
            for _ in range(int(len(item) * r.choice([0, 0, 0.1, 0.2]))):
                at = r.randrange(len(item))
                item[at:at + 1] = r.choice([["odd"], [], ["odd", item[at]]])
            at = r.randrange(len(body))
            body[at:at] = item
            leaks.add((i, k))
        docs.append((i, r.choice([" ", "\n", ", "]).join(body).upper() if i % 8 == 0 else " ".join(body)))
    return docs, [(i, " ".join(t) + ".") for i, t in items], leaks


def _run(spark, docs, items):
    found = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return {(r.id, r.item_id) for r in found.collect()}


def test_edited_copies_are_found_and_nothing_else(spark):
    docs, items, leaks = _corpus(1)
    assert _run(spark, docs, items) == leaks


def test_a_much_copied_item(spark):
    """An item in most documents is found in all of them, however frequent that makes its sequences."""
    docs, items, leaks = _corpus(2)
    docs += [(1000 + i, items[0][1]) for i in range(300)] + [(1000, items[0][1])]
    assert _run(spark, docs, items) == leaks | {(1000 + i, 0) for i in range(300)}


def _edited(seed, copies):
    """Items of 50 to 100 words; each in documents with 20 to 30 % of its words replaced, alike in all ``copies``."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: [r.choice(words) for _ in range(n)]
    items = [(i, text(r.randint(50, 100))) for i in range(40)]
    docs, leaks = [(1000 + i, " ".join(text(200))) for i in range(50)], set()
    for k, item in items:
        own = item[:]
        for at in r.sample(range(len(own)), int(len(own) * r.uniform(0.2, 0.3))):
            own[at] = f"odd{r.randrange(1000)}"
        assert brute_align(item, own) >= D.SCORE_LEAST * D.MATCH * len(item)
        for _ in range(copies):
            leaks.add((len(leaks), k))
            docs.append((len(leaks) - 1, " ".join(text(30) + own + text(30))))
    return docs, [(i, " ".join(t)) for i, t in items], leaks


def test_much_edited_long_items_in_one_document(spark):
    docs, items, leaks = _edited(3, 1)
    assert _run(spark, docs, items) == leaks


def test_much_edited_long_items_in_many_documents(spark):
    docs, items, leaks = _edited(4, 20)
    assert _run(spark, docs, items) == leaks


def test_a_single_shared_sequence(spark):
    """One rare sequence is enough for an alignment."""
    items = [(1, "a b c d e f g h i")]
    docs = [(1, "a b c x e f x h i"), (2, "p q a b c r s t"), (3, "nothing of it")]
    assert _run(spark, docs, items) == {(1, 1)}


def test_messy_tables(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "just three words"), (4, "two words"), (None, "two, words"), (5, "w"), (6, messy.texts()[6]), (7, messy.texts()[6]),
                                   (8, "unrelated item of quite other words altogether")], "item_id long, text string")
    got = {(r.id, r.item_id) for r in D.leaks(messy.docs(spark), items).collect()}
    assert {(4, 4), (5, 3), (6, 6), (7, 6), (8, 6)} <= got and not any(i in (7, 8) for _, i in got)
    out = D.clean(messy.docs(spark), items)
    assert out.columns == messy.docs(spark).columns
    assert {r.doc_id for r in out.collect()} == {r[0] for r in messy.rows()} - {i for i, _ in got}
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(messy.docs(spark), none).collect() == [] and D.leaks(messy.empty(spark), items).collect() == []


def test_whole_copies_in_the_test_tables(spark):
    sf = "/root/testdata/sf0.01"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = {(r.doc_id, i) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for i, t in items if t in (r.text or "")}
    got = {(r.doc_id, r.item_id) for r in D.op4_decontaminate(spark, sf).collect()}
    assert want and want <= got
