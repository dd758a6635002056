import itertools
import math
import re

from creatorlens.llm import urls


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(rule), rule, verdict) for verdict, rule in urls.RULES
            if (host == rule.split("/", 1)[0] or host.endswith("." + rule.split("/", 1)[0])) and path.startswith("/" + rule.split("/", 1)[1])]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


URLS = [None, "", "no scheme", "http://", "http://com", "http://com/", "https://A.COM/x?y#z", "x://www.example.com/en/1", "x://www.example.com/EN/1",
        "x://example.com/en", "x://example.com/en/", "x://notexample.com/en/", "x://a.net/es/", "x://net/fr/9", "x://a.net/de/", "a://b.net://c/es/",
        "x://ÉTÉ.example.com/en/é", "x://h.org:80/p?://", "x://h#/en/", "x://example.com?/en/", "x://" + "the" * 2000 + ".org/" + "a" * 5000, "x://.com/", "x://..net/es/"]


def test_rules(spark, tmp_path):
    rows = [(i, u, "<p>the of and</p>" if i % 2 else None, "x") for i, u in enumerate([*URLS, *URLS])] + [(None, URLS[5], "", "y")]
    spark.createDataFrame(rows, "page_id long, url string, html string, verdict string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted([(r.page_id, r.host, r.path, r.rule) for r in urls.op1_urls(spark, str(tmp_path)).collect()], key=repr)
    assert got == sorted([(i, *brute_rule(u)[:3]) for i, u, *_ in rows], key=repr)
    for r in urls.op1_urls(spark, str(tmp_path)).collect():
        assert r.verdict in ("allow", "block") and (r.rule is None or r.verdict == dict((b, a) for a, b in urls.RULES)[r.rule])


def test_no_pages_and_one_class(spark):
    schema = "page_id long, url string, html string"
    assert urls.judge(spark.createDataFrame([], schema)).collect() == []
    rows = spark.createDataFrame([(1, "x://a.com/", ""), (2, "x://b.org/", "")], schema)
    assert [r.verdict for r in urls.judge(rows).orderBy("id").collect()] == ["allow", "allow"]


def least_cost(text, cost, total):
    """Cost of the likeliest split, over all splits."""
    unknown = math.log(total) + math.log(10)
    price = lambda w: cost.get(w, unknown + (len(w) - 1) * 2 * math.log(10))
    best = math.inf
    for cuts in itertools.product([0, 1], repeat=max(len(text) - 1, 0)):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
        best = min(best, sum(price(text[a:b]) for a, b in zip(at, at[1:]) if a < b))
    return best, price


def test_segmenter_finds_the_likeliest_split():
    counts = {"the": 50, "there": 10, "in": 30, "rein": 3, "her": 8, "e": 2, "he": 20, "i": 5, "xaq": 1}
    total = sum(counts.values())
    cost = {w: math.log(total / n) for w, n in counts.items()}
    own = urls.Segmenter({w: n for w, n in counts.items() if n > 3}, total)
    for text in ("therein", "inthere", "hethein", "xq", "thexin", "e", "", "qqqqqqqqqthe", "xaqxaqin"):
        found = own.split(text, [{"word": "rein", "n": 3}, {"word": "e", "n": 2}, {"word": "xaq", "n": 1}])
        least, price = least_cost(text, cost, total)
        assert math.isclose(sum(map(price, found)), least, abs_tol=1e-9) and "".join(found) == text


LONG = "pneumonoultramicroscopicsilicovolcanoconiosis"


def test_every_word_of_the_pages_is_looked_up(spark, monkeypatch):
    """More words than travel with the tasks, a word longer than a piece, and runs longer than a stretch."""
    names = ["".join(p) for p in itertools.product("bcdfg", "aeiou", "klmn", "aeiou", "prst")]
    html = [" ".join(["the"] * 50 + names[i::4] + [LONG, LONG + "x"]) for i in range(4)]
    far = names[0] + LONG + names[5] * 60 + LONG + "x"
    rows = [(i, f"http://{names[i]}{LONG}the.org/{far if i % 3 else LONG[:30]}", html[i % 4]) for i in range(40)]
    rows += [(i, "http://" + names[7] + names[9] + ".com/", None) for i in range(100, 160)] + [(None, "x://" + LONG + ".net/es/", "")] * 30
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {}
    for most in (30, 1_000_000):
        monkeypatch.setattr(urls, "LEXICON", most)
        got[most] = sorted((tuple(r) for r in urls.judge(pages).collect()), key=repr)
    assert got[30] == got[1_000_000] and len(got[30]) == len(rows)
    words = {r[0]: r[5] for r in got[30]}
    assert words[0] == ["t:org", f"h:{names[0]}", f"h:{LONG}", "h:the", *(f"p:{w}" for w in urls.Segmenter({LONG: 4, "the": 200}, 10_000).split(LONG[:30]))]
    assert words[1][4:] == [f"p:{w}" for w in [names[0], LONG, *[names[5]] * 60, LONG + "x"]]
    assert words[100] == ["t:com", f"h:{names[7]}", f"h:{names[9]}"]


def test_bayes_against_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = urls.judge(pages).collect()
    counts = {r.word: r.n for r in urls.word_counts(pages, "html").collect()}
    split = urls.Segmenter(counts, sum(counts.values())).split
    seen = {"allow": [], "block": []}
    for r in got:
        if r.rule:
            name, _, start = r.rule.partition("/")
            seen[r.verdict].append(urls.tokens(r.host[:max(len(r.host) - len(name) - 1, 0)], r.path[len(start) + 1:], split))
    share = {}
    for c, texts in seen.items():
        flat = [urls.bucket(t) for x in texts for t in x]
        share[c] = (flat, len(flat) + urls.BUCKETS)
    for r in (r for r in got if r.rule is None):
        odds = math.log(len(seen["block"]) / len(seen["allow"]))
        for t in map(urls.bucket, urls.tokens(r.host, r.path, split)):
            odds += math.log((share["block"][0].count(t) + 1) / share["block"][1]) - math.log((share["allow"][0].count(t) + 1) / share["allow"][1])
        assert math.isclose(odds, r.odds, abs_tol=1e-6) and r.verdict == ("block" if odds > 0 else "allow")
