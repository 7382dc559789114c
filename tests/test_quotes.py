"""Verbatim search against brute force: parts of words, short and repeated quotes, common and absent anchors."""

import random

from plumbline.operators import facts as O


def run(spark, quotes, docs):
    q, d = spark.createDataFrame(quotes, "item_id int, text string"), spark.createDataFrame(docs, "doc_id int, text string")
    return sorted(tuple(r) for r in O.find_quotes(q, d).select("item_id", "copies", "doc_id", "char_offset").collect())


def brute(quotes, docs):
    fold = lambda t: " ".join((t or "").lower().split())
    texts = [fold(t) for _, t in quotes]
    return sorted((i, texts.count(q), d, fold(t).find(q)) for (i, _), q in zip(quotes, texts, strict=True) if q for d, t in docs if q in fold(t))


def test_quotes_of_all_lengths(spark):
    r = random.Random(8)
    words = ["the", "of", "pump", "naïve", "a", "x1", "water", "Ünit", "日本"]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.randrange(0, 60)))) for i in range(60)]
    docs += [(7, docs[3][1]), (100, None), (101, ""), (102, "x" * 3000 + " the pump " * 500)]
    quotes = []
    for i in range(80):  # pieces that begin and end anywhere
        t = r.choice(docs[:60])[1]
        a = r.randrange(max(1, len(t)))
        quotes.append((i, t[a:a + r.choice([1, 2, 3, 5, 9, 20, 60, 200])]))
    quotes += [(200, "the of the of the of never"), (201, ""), (202, None), (203, "the pump the pump the pump the pump the pump"), (204, "The  PUMP"), (205, quotes[0][1])]
    assert run(spark, quotes, docs) == brute(quotes, docs)


def test_nothing_to_search(spark):
    assert run(spark, [], [(1, "a b")]) == [] and run(spark, [(1, "a b c d e f g")], []) == [] and run(spark, [(1, " ")], [(1, "a")]) == []


def test_the_anchor_is_the_rare_shingle(spark, monkeypatch):
    """A quote of common words with one rare place is compared in the one document that has it, not in all."""
    docs = [(i, "one two three four five six seven eight nine ten") for i in range(400)] + [(400, "zero one two three four five rare seven eight nine")]
    seen = []
    keep = O.cut
    monkeypatch.setattr(O, "cut", lambda df, name="cut", **k: seen.append((name, out := keep(df, name, **k))) or out)
    assert run(spark, [(1, "one two three four five rare seven eight")], docs) == [(1, 1, 400, 5)]
    places = dict(seen)["places"]
    assert places.groupBy("_key").count().agg({"count": "min"}).head()[0] == 1  # what the anchor meets
