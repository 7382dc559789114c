"""Facts are mined once for counting and for choosing; sentence facts are those of a plain loop over ``unit_numerics``."""

import random

from pyspark.sql import functions as F

from plumbline.functions import text as X
from plumbline.operators import facts as O

F4 = "article_id bigint, value string, unit string, claim string"


def test_notes_are_mined_once(spark):
    notes = spark.range(40).select(F.col("id").alias("article_id"), F.concat(F.lit("It lost "), F.col("id").cast("string"), F.lit("% in 3 days. No more! 5 kg.")).alias("note"))
    mined = notes.select("article_id", F.inline_outer(X.sentence_facts("note"))).where("claim IS NOT NULL")
    articles = spark.range(41).selectExpr("id AS article_id", "'c' AS category")
    model = spark.range(0, 40, 2).selectExpr("id AS article_id", "'1' AS value", "'%' AS unit", "'5 kg.' AS claim")
    qual = spark.createDataFrame([(1, "q")], "article_id bigint, claim string")
    tpl = spark.createDataFrame([("c", "t")], "category string, claim string")
    facts = O.tiered_facts(articles, model, mined, qual, tpl)[0]
    got = facts.groupBy("article_id", "source").agg(F.count("*").alias("n"))
    rows = {(r.article_id, r.source): r.n for r in got.collect()}
    assert rows == {(i, 2): 3 - (i % 2 == 0) for i in range(40)} | {(i, 1): 1 for i in range(0, 40, 2)} | {(40, 4): 1}
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Generate inline") == 1


def test_an_article_given_twice_gets_its_facts_twice(spark):
    articles = spark.createDataFrame([(1, "c"), (1, "d"), (2, "c"), (None, "c")], "article_id bigint, category string")
    mined = spark.createDataFrame([(1, "1", "kg", x) for x in "abc"] + [(2, "1", "kg", "a"), (None, "1", "kg", "a")], F4)
    none = spark.createDataFrame([], F4)
    tpl = spark.createDataFrame([("c", "t"), ("c", "u")], "category string, claim string")
    facts, meta = O.tiered_facts(articles, none, mined, none.select("article_id", "claim"), tpl)
    got = sorted((-1 if r.article_id is None else r.article_id, r.source, r.claim) for r in facts.collect())
    assert got == [(-1, 4, "t"), (-1, 4, "u")] + sorted([(1, 2, x) for x in "abc"] * 2) + [(2, 2, "a"), (2, 4, "t"), (2, 4, "u")]
    assert meta.count() == 4


def test_sentence_facts_equal_the_loop(spark):
    r = random.Random(7)
    some = ["5 kg", "7%", " 3 days", "12,5 mg/L", "21°C", "2 degrees C", ". ", "! ", "?", "  ", "\n", chr(0x3000), "<b>", "<", "x", " Lot 5 kg. "]
    texts = [None, "", ".", "5 kg"] + ["".join(r.choice(some) for _ in range(n)) for n in (2, 6, 20, 60) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {x.id: [tuple(f) for f in x.f] for x in df.select("id", X.sentence_facts("t").alias("f")).collect()}
    sents = df.select("id", F.posexplode(F.transform(F.regexp_extract_all(X.strip_tags("t"), F.lit("[^.!?]*[.!?]"), F.lit(0)), X.strip)).alias("i", "s"))
    want = {i: {} for i in range(len(texts))}
    for x in sents.select("id", "i", "s", X.unit_numerics("s").alias("u")).orderBy("id", "i").collect():
        for u in x.u:
            want[x.id].setdefault((x.s, u.match), (u.value, u.unit, x.s))
    assert got == {i: list(v.values()) for i, v in want.items()} and sum(map(len, got.values())) > 300
