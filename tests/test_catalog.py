"""N1 / N2 / P13 / P14 on golden trees and titles."""

import json

from pyspark.sql import functions as F

from creatorlens.operators import catalog as cat

TREE = {"navigation": [
    {"alias": "w", "content": {"title": "Women"}, "children": [
        {"alias": "x", "content": {"title": ""}, "children": [
            {"content": {"title": "Running Shoes"}, "children": [
                {"content": {"title": "Trail"}}]},
            {"children": [{"content": {"title": "Makeup Bags"}}]}]},
        {"alias": "y", "content": {"title": None}},
        {"alias": "z", "content": {"title": "Dresses"}, "children": []}]},
    {"content": {"title": "Sale"}}]}


def _py_titles(nodes):
    out = []
    for n in nodes:
        t = (n.get("content") or {}).get("title")
        if t:
            out.append(t)
        out.extend(_py_titles(n.get("children", [])))
    return out


def test_flatten_tree_preorder_matches_recursion(spark):
    docs = spark.createDataFrame([("d1", json.dumps(TREE)), ("d2", '{"navigation": []}'), ("d3", "not json")],
                                 "doc_id string, json string")
    nodes = cat.titled(cat.flatten_tree(docs)).orderBy("doc_id", "pos").collect()
    assert [r["title"] for r in nodes] == _py_titles(TREE["navigation"])
    assert [r["depth"] for r in nodes if r["title"] == "Trail"] == [3]
    all_nodes = cat.flatten_tree(docs).where(F.col("doc_id") == "d1").count()
    assert all_nodes == 9


def test_a_thousand_levels_and_session_settings(spark):
    """A chain of 1,500 nodes beside a wide tree; the caller's settings stay as they are."""
    tree = None
    for level in reversed(range(1500)):
        tree = {"content": {"title": f"t{level}"}, "children": [{"alias": "leaf"}, *([tree] if tree else [])]}
    wide = {"navigation": [{"content": {"title": str(i)}} for i in range(9000)]}
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    docs = spark.createDataFrame([(1, json.dumps({"navigation": [tree]})), (2, json.dumps(wide)), (3, None)], "doc_id long, json string")
    nodes = cat.flatten_tree(docs)
    deep = cat.titled(nodes.where("doc_id = 1")).orderBy("pos").collect()
    assert [(r["title"], r["depth"], r["pos"]) for r in deep] == [(f"t{i}", i, 2 * i) for i in range(1500)]
    assert [r["path"] for r in deep[:3]] == [[0], [0, 1], [0, 1, 1]]
    rows = nodes.where("doc_id = 2").orderBy("pos").collect()
    assert [(r["title"], r["pos"], r["path"]) for r in rows] == [(str(i), i, [i]) for i in range(9000)]
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) == before


def test_odd_trees(spark):
    """Values of other types, missing parts, invalid documents."""
    texts = ['{"navigation": [1, null, "x", [2], {"alias": 5, "content": {"title": true}}, {"content": "no", "children": {"a": 1}}]}',
             '{"navigation": {"a": {}}}', "[1]", '{"navigation": [NaN]}', "", '{"navigation": [{"alias": "é\\n", "children": [null]}]}']
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, json string")
    got = [tuple(r) for r in cat.flatten_tree(docs).select("doc_id", "path", "alias", "title").orderBy("doc_id", "pos").collect()]
    assert got == [(0, [0], None, None), (0, [1], None, None), (0, [2], None, None), (0, [3], None, None), (0, [4], "5", "true"), (0, [5], None, None),
                   (5, [0], "é\n", None), (5, [0, 0], None, None)]


def test_classify_titles_priority_and_default(spark):
    df = spark.createDataFrame([("SALE Activewear Makeup",), ("Makeup",), ("Jeans",), ("Jeans",), ("running",)],
                               "title string")
    got = [r["category"] for r in cat.classify_titles(df).collect()]
    assert got == ["fitness", "beauty", "fashion", "fashion", "fitness"]


def test_exclude_titles(spark):
    df = spark.createDataFrame([("Men",), ("men",), ("Dresses",), (None,)], "title string")
    got = sorted((r["title"] or "") for r in cat.exclude_titles(df).collect())
    assert got == ["", "Dresses", "men"]


def test_rules_from_table(spark):
    rules = spark.createDataFrame([(2, "beauty", "Makeup"), (1, "fitness", "Gym")], "priority int, category string, keyword string")
    compiled = cat.rules_from_table(rules)
    df = spark.createDataFrame([("Gym Makeup",), ("makeup bag",), ("hat",)], "title string")
    got = [r["category"] for r in cat.classify_titles(df, rules=compiled).collect()]
    assert got == ["fitness", "beauty", "fashion"]


def test_terms_from_table(spark):
    from creatorlens.operators.lexicon import lexicon_frame, lexicon_union, terms_from_table
    lex = lexicon_frame(spark, lexicon_union(["vibe", "lit"], ["🔥"], ["#lit", "#viral"]))
    assert terms_from_table(lex, ["hashtag"]) == ["#lit", "#viral"]
    assert len(terms_from_table(lex)) == 5


def test_rules_stored_as_a_table(spark, monkeypatch):
    """Every keyword of any number of rules, by automaton and by joins, against all rules on all titles."""
    import random

    from creatorlens.operators import lexicon as lex
    r = random.Random(4)
    word = lambda a, b: "".join(r.choices("abcdeÉ ", k=r.randrange(a, b)))
    titles = [word(0, 14) for _ in range(150)] + [None, "", "ABCDE abcde", "x"] + ["abc"] * 40
    rules = [(r.randrange(0, 9), f"cat{r.randrange(0, 6)}", word(1, 5)) for _ in range(60)]
    rules += [(None, "cat1", "a"), (0, None, "a"), (0, "never", None), (3, "cat9", "abc"), (3, "cat8", "ABC")]
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(titles)], "id long, title string, category string, term string, _low string")
    for extra in ([], [(7, "all", "")], None):
        own = [] if extra is None else rules + extra
        good = [x for x in own if None not in x]
        want = [(i, min(((p, c) for p, c, k in good if t is not None and k.lower() in t.lower()), default=(0, "other"))[1]) for i, t in enumerate(titles)]
        table = spark.createDataFrame(own, "priority int, category string, keyword string")
        for most in (100_000, 0 if own else -1):
            monkeypatch.setattr(lex, "AUTOMATON_TERMS", most)
            got = cat.classify_titles_by_table(df, table, default="other")
            assert got.columns == ["id", "title", "term", "_low", "category"]
            assert sorted((x.id, x.category) for x in got.collect()) == want
