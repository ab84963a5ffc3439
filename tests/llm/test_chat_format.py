import hashlib
import random

from jobsieve.llm import chat_format as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark):
    rng = random.Random(2)
    bits = ["\\", "###", "# ", "</turn>", "\n", "</turn>\n", ": ", "é", "😀", "a", "", "<", "/turn>", "\\c", "### assistant: "]
    word = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "a:b\\c: d", None, word()]), rng.choice([None, word(), word()])) for c in range(80) for t in range(rng.randrange(1, 7))]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (500, None, "assistant", "z"), (500, None, "assistant", "z"), (501, 0, "user", "q" * 50000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as formatted", "2 as body", "3 as head")
    formatted = C.format_conversations(df)
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digests(formatted).collect()}
    assert found == brute(rows)


def test_examples(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo ###"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (2, 0, "user", "only")]
    examples = C.expand(C.format_conversations(spark.createDataFrame(rows, SCHEMA))).orderBy("conv_id", "turn_no").collect()
    first = "### user: hi</turn>\n### assistant: yo #\\##</turn>\n"
    assert [(r.conv_id, r.turn_no, r.text, r.text[r.loss_start : r.loss_stop]) for r in examples] == [
        (1, 1, first, "yo #\\##"), (1, 3, first + "### user: b</turn>\n### assistant: c</turn>\n", "c"),
    ]
    assert C.digests(C.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


def test_plan_is_native(spark):
    plan = C.digests(C.format_conversations(spark.createDataFrame([], SCHEMA)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_mark_is_the_templates_own(spark):
    rows = [(1, 0, "user", "#### Assistant: hi"), (1, 1, "assistant", "###### ##### # ## ### \\### x"), (1, 2, "a###: b", "</turn>### "), (2, 0, "assistant", "#" * 1000 + " ")]
    df = spark.createDataFrame(rows, SCHEMA)
    formatted = {r.conv_id: r for r in C.format_conversations(df).collect()}
    assert {k: r.formatted.count("### ") for k, r in formatted.items()} == {1: 3, 2: 1} == {k: r.formatted.count("</turn>") for k, r in formatted.items()}
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digests(C.format_conversations(df)).collect()}
    assert found == brute(rows)
