"""Rows without words count each in a mixture."""

from collections import Counter

from plumbline.llm import mixing


def test_repeated_empty_rows(spark):
    rows = [(1, "a", None)] * 3 + [(2, "a", "")] * 4 + [(None, "b", " ")] * 500 + [(3, "a", "one two three")] * 2 + [(4, "b", "four five")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix_counts(docs.repartition(3), block=2).collect()
    want = Counter((d, len((t or "").split())) for d, _, t in rows)
    assert Counter((x.doc_id, x["size"]) for x in got) == want
    assert {x.taken for x in got if x["size"] == 0} == {0}
