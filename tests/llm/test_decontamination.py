import random

import numpy as np

from jobsieve.llm import decontamination as D


def prose(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "ción", "ea", "ß"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(1, len(out) - 1)
        kind = rng.randrange(3)
        out[at : at + (kind != 1)] = [] if kind == 0 else [rng.choice("abc")]
    return "".join(out)


def cheapest(item, text):
    """Edits of the best place of the item in the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_against_full_alignment(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, rng.randrange(10, 25))) for i in range(12)] + [(50, "tiny é"), (51, None), (52, "  "), (0, "repeated id " + prose(rng, 9))]
    docs = []
    for i in range(90):
        text = prose(rng, 20)
        if i % 3:
            item = rng.choice(items[:12])[1]
            text += " " + edited(rng, item, rng.choice([0, 0, 1, len(item) // 12, len(item) // 10, len(item) // 8, len(item) // 5])).upper() + "\n\t" + prose(rng, 15)
        docs.append((i, text))
    docs += [(200, None), (201, ""), (None, "so " + items[3][1]), (3, items[4][1]), (202, prose(rng, 9000) + " Tiny  É")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as matches", "2 as row", "3 as item_id")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected, normal = set(), D.normal
    index = D.Index([(i, normal(t)) for i, t in items if normal(t)], 0.1)
    for i, text in docs:
        for k, (item_id, item) in enumerate(zip(index.ids, index.texts)):
            if len(text or "") < 5000:
                edits = cheapest(item, normal(text))
                if edits <= (0 if len(item) < D.Q else index.budget[k]):
                    expected.add((i, item_id, edits))
    expected.add((202, 50, 0))
    found = D.contaminated(df.repartition(3), bench).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in found} == expected
    text_of = {}
    for i, t in docs:
        text_of.setdefault(i, []).append(normal(t))
    for r in found:
        items_of = [t for i, t in zip(index.ids, index.texts) if i == r.item_id]
        assert any(cheapest(item, t[r.start : r.stop]) == r.edits for item in items_of for t in text_of[r.doc_id])


def test_blocks_of_items_and_empty_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three four five"), (2, "six seven eight nine ten"), (3, "nothing")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, "two three four"), (8, "seven eight nine")], "item_id bigint, text string")
    monkeypatch.setattr(D, "BLOCK_CHARS", 5)
    assert sorted((r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()) == [(1, 7), (2, 8)]
    assert D.contaminated(docs.limit(0), bench).collect() == [] == D.contaminated(docs, bench.limit(0)).collect()
    assert D.grams(np.arange(7, dtype=np.uint64)).size == 0
