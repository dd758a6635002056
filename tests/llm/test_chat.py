import hashlib
import json
import random

from creatorlens.llm import chat


def test_escapes_are_reversible():
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(["<", "|", "\\", "\n", "im_end", "n", "<|im_end|>", "<|im_start|>", ">"]) for _ in range(r.randint(0, 8)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)
        string, a, b = chat.turn_string(text, text)
        assert list(chat.parse(string + string))[1][:2] == (text, text) and chat.unescape(string[a:b]) == text


def test_layouts(spark):
    records = [
        ("m", {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}),
        ("s", {"system": "be kind", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}),
        ("i", {"instruction": "add", "input": "1 2", "output": "3"}), ("j", {"instruction": "add", "output": "?"}),
        ("p", {"prompt": "p", "response": "r"}), ("c", {"prompt": "p", "completion": 5}), ("e", {"messages": []}), ("u", {"odd": {"deep": [1]}}),
        ("l", [1, 2]),
    ]
    rows = [(i, json.dumps(r)) for i, r in records] + [("n", None), ("b", "{broken"), (None, json.dumps(records[0][1]))]
    got = {}
    for t in chat.canonical_turns(spark.createDataFrame(rows, "id string, record string"), "record", "id").collect():
        got.setdefault(t.conv, []).append((t.part, t.role, t.text, t.layout))
    turns = {k: [x[1:3] for x in sorted(v, key=lambda x: (x[0] is not None, x[0]))] for k, v in got.items()}
    assert turns["m"] == turns[None] == [("user", "hi"), ("assistant", "yo")]
    assert turns["s"] == [("system", "be kind"), ("user", "q"), ("assistant", "a")]
    assert turns["i"] == [("user", "add\n\n1 2"), ("assistant", "3")] and turns["j"] == [("user", "add"), ("assistant", "?")]
    assert turns["p"] == [("user", "p"), ("assistant", "r")] and turns["c"] == [("user", "p"), ("assistant", "5")]
    assert all(got[k][0][3] is None for k in ("e", "u", "l", "n", "b"))  # an empty array has no paths below it
    assert len({chat.fingerprint(frozenset(chat.field_paths(r))) for _, r in records[:7]}) == 7


def test_fields_that_no_mapping_names(spark):
    """They change the fingerprint, not the layout; values of unexpected kinds don't stop a job."""
    records = [
        ("x", {"id": 7, "meta": {"lang": ["en", {"a": 1}]}, "messages": [{"role": "user", "content": "hi", "name": "z"}, {"role": "assistant", "content": "yo"}]}),
        ("k", {"messages": [{"role": "user", "content": "hi"}, "bare", None, 3]}), ("t", {"conv_id": "t", "turn": "one", "role": "user", "text": "a", "when": 1}),
        ("o", {"prompt": "p", "response": "r", "score": 0.5}), ("two", {"prompt": "p", "messages": [{"role": "user", "content": "hi"}]}),
        ("odd", {"messages": "no list", "messages[]": {"role": "r", "content": "c"}}), ("half", {"prompt": "\ud800x", "response": "r", "\udfff": 1}), ("u", {"odd": 1}),
    ]
    rows = [(i, json.dumps(r)) for i, r in records] + [("deep", "[" * 100_000 + "]" * 100_000), ("big", json.dumps({"conv_id": "big", "turn": 1 << 70}))]
    made = chat.canonical_turns(spark.createDataFrame(rows, "id string, record string"), "record", "id")
    got = {}
    for t in sorted(made.collect(), key=lambda t: (t.conv, t.part or 0)):
        got.setdefault(t.conv, []).append((t.layout, t.turn, t.role, t.text))
    assert got["x"] == [("messages", 0, "user", "hi"), ("messages", 0, "assistant", "yo")]
    assert got["k"] == [("messages", 0, "user", "hi"), ("messages", 0, "", "bare"), ("messages", 0, "", ""), ("messages", 0, "", "3")]
    assert got["t"] == [("turn row", None, "user", "a")] and got["big"] == [("turn row", None, "", "")]
    assert got["o"] == [("prompt and response", 0, "user", "p"), ("prompt and response", 0, "assistant", "r")]
    assert got["half"][0] == ("prompt and response", 0, "user", "\ufffdx")
    assert all(got[c] == [(None, None, None, None)] for c in ("two", "u", "deep")) and "odd" not in got  # no turns
    assert sum(r.n for r in chat.unknown_layouts(made).collect()) == 3


def test_query_on_messy_rows(spark, tmp_path, monkeypatch):
    r = random.Random(2)
    parts = ["<|im_end|>", "<|im_start|>", "assistant", "\n", "é", "😂", "<\\|", "text ", ""]
    rows = [(r.choice([1, 2, 3, None]), r.choice([0, 1, 2, None]), r.choice(["user", "assistant", "system", None, "a\nb", "<|x"]),
             r.choice([None, "".join(r.choice(parts) for _ in range(6))]), 9) for _ in range(200)]
    rows += [(4, 0, "assistant", "x" * 3_000_000, 1), (4, 1, "user", "y" * 500_000, 1), (4, 1, "user", "y" * 500_000, 1)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss long").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {x.conv_id: tuple(x)[1:] for x in chat.op7_chat(spark, str(tmp_path)).collect()}
    rows += [(-1, 0, "user", chat.TRICK, 0), (-1, 1, "assistant", chat.TRICK, 0)]
    key = lambda v: (v is not None, v if isinstance(v, int) else (v or "").encode())
    assert set(got) == {x[0] for x in rows}
    for conv in got:
        own = sorted([(t, a or "", b or "") for c, t, a, b, _ in rows if c == conv], key=lambda x: (key(x[0]), x[1].encode(), x[2].encode()))
        loss = "".join(b for _, a, b in own if a == "assistant")
        assert got[conv] == (len(own), hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest(), len(loss),
                             hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat.turn_string(a, b)[0]) for _, a, b in own))


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r.conv_id for r in chat.op7_chat(spark, str(tmp_path)).collect()] == [-1]


def test_a_hot_conversation_of_ties(spark):
    """Rows of one conversation, turn and role over many ranges: the order, and so the digest, is that of the texts."""
    import hashlib
    import random
    from pyspark.sql import functions as F
    r = random.Random(4)
    texts = [f"{r.randrange(10**6)} {'x' * r.randrange(80)}" for _ in range(3000)] * 2
    turns = spark.createDataFrame([("c", 1, 0, "user", t, "turn row") for t in texts], "conv string, turn long, part int, role string, text string, layout string")
    want = hashlib.sha256("".join(f"user\n{t}\n" for t in sorted(texts)).encode()).hexdigest()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            (row,) = chat.read_turns(chat.format_turns(turns.repartition(5))).select("conv", F.col("turns_sha256").alias("sha")).collect()
            assert row.sha == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
