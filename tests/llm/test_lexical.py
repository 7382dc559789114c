"""Ranked search against brute force: copies, ties, NULLs, repeated rows, item blocks."""

import math
import random
import re
from collections import Counter

from plumbline.llm import lexical

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def bag(t):
    return Counter(w.translate(FOLD) for w in WORD.findall(t or ""))


def brute(docs, items, k=10):
    bags = [(d, bag(t)) for d, t in docs]
    n_docs, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, t in items:
        q, scored = bag(t), []
        for d, b in bags:
            m = 100 - 75 + (75 * sum(b.values()) * n_docs) // total if total else 0
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * b[w]) // (1000 * b[w] + 8 * m)) for w, c in q.items() if w in b)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, rank int, score string").repartition(5)
    i = spark.createDataFrame([(*r, 9) for r in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in lexical.ranked(d, i, **more).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def fixture():
    r = random.Random(11)
    vocab = [f"w{i}" for i in range(60)] + ["The", "naïve", "日本", "x_y", "Ünder"]
    pick = lambda n: " ".join(r.choice(vocab[: r.choice([8, 65])]) for _ in range(n))
    docs = [(i, pick(r.randrange(0, 40))) for i in range(150)]
    hot = pick(25)
    docs += [(1000 + r.randrange(10_000), hot) for _ in range(120)]  # one text in a third of the rows
    docs += [(None, hot), (None, "w1 w2"), (500, None), (501, ""), (502, " .,! "), docs[3], docs[3], (503, "w3 " * 20_000), (-4, hot + " THE")]
    items = [(i, pick(r.randrange(1, 30))) for i in range(25)] + [(None, "w1 w1 the"), (77, None), (78, "..."), (79, "nowhere"), (3, "w5"), (3, "w5"), (80, hot)]
    return docs, items


def test_against_brute_force(spark):
    docs, items = fixture()
    assert run(spark, docs, items) == brute(docs, items)


def test_item_blocks_agree(spark):
    docs, items = fixture()
    assert run(spark, docs, items[:12], block_bytes=400, k=4) == brute(docs, items[:12], 4)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []


def test_classes_are_scored_once(spark):
    """A class of many copies is one row with the first ten ids; bags that differ only in m stay apart."""
    docs = [(i, "alpha beta") for i in range(500)] + [(900, "alpha beta other words")]
    plain = spark.createDataFrame(docs, "doc_id long, text string")
    terms = spark.sparkContext.broadcast({b"alpha": 0, b"beta": 1})
    bags = plain.selectExpr("doc_id", "cast(text as binary) text").mapInArrow(lexical._Bags(terms), "doc_id long, n long, ids array<int>, tfs array<int>")
    rows = lexical._classes(bags, 501, 1004, 10).collect()
    assert sorted([m.doc_id for m in r.members] for r in rows) == [list(range(10)), [900]]
