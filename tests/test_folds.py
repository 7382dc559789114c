"""Greedy folds: equal to the plain loop, linear in a long text, blocks and stretches chained without Python."""

import random
import time

import pytest
from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions import text as X
from plumbline.operators import segments as S


def packed(text):
    pieces = []
    for p in text.replace(".", ",").replace(";", ",").replace(":", ",").split(","):
        w = p.split()
        if w:
            size = int(K.SHOT_TARGET_MAX_S * K.WORDS_PER_SECOND)
            pieces += [" ".join(w[i:i + size]) for i in range(0, len(w), size)] if len(w) / K.WORDS_PER_SECOND > K.SHOT_TARGET_MAX_S else [" ".join(p.split())]
    spans = []
    for p in pieces:
        if spans and len(f"{spans[-1]}, {p}".split()) / K.WORDS_PER_SECOND <= K.SHOT_TARGET_MAX_S:
            spans[-1] += ", " + p
        else:
            spans.append(p)
    if len(spans) > 1 and len(spans[-1].split()) / K.WORDS_PER_SECOND < K.SHOT_TARGET_MIN_S / 2:
        spans[-2:] = [spans[-2] + ", " + spans[-1]]
    return spans


def test_pack_phrases_equals_the_loop(spark):
    r = random.Random(6)
    texts = ["", " , ;", "one", "a, b", "a b c d e, f"] + [" ".join(r.choice(["w", "w,", "x.", "yy;", "z:"]) for _ in range(n)) for n in (3, 9, 40, 400, 1500) for _ in range(4)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", X.pack_phrases(X.split_phrases("t")).alias("s")).collect()
    assert {x.id: x.s for x in rows} == {i: packed(t) for i, t in enumerate(texts)}


def test_a_hundred_thousand_phrases_pack_in_seconds(spark):
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda i: F.concat(F.lit("some words "), i.cast("string"))), ", ")
    t = time.time()
    row = spark.range(1).select(X.pack_phrases(X.split_phrases(text)).alias("s")).select(F.size("s").alias("n"), F.element_at("s", -1).alias("last")).head()
    assert tuple(row) == (100_000, "some words 100000") and time.time() - t < 60


@pytest.mark.parametrize("stretch", [1, 2, 7, 1024])
def test_entries_of_blocks(spark, stretch):
    r = random.Random(stretch)
    rows, want = [], set()
    for doc in range(4):
        at = 0
        for b in range((1, 5, 30, 200)[doc]):
            m = [r.randrange(3) for _ in range(3)]
            rows.append((doc, b, m))
            want.add((doc, b, at))
            at = m[at]
    maps = spark.createDataFrame(rows, "doc int, _b bigint, _map array<int>").repartition(3)
    assert {tuple(x) for x in S._entries(maps, "doc", 3, stretch).collect()} == want


def test_cues_need_no_python(spark):
    words = spark.range(5000).select(F.lit(1).alias("doc"), F.col("id").alias("idx"), F.lit("w").alias("word"), (F.col("id") * 0.4).alias("start_s"), (F.col("id") * 0.4 + 0.3).alias("end_s"))
    cues = S.group_cues(words)
    assert cues.count() == 1667 and "Python" not in cues._jdf.queryExecution().executedPlan().toString() and "Pandas" not in cues._jdf.queryExecution().executedPlan().toString()
