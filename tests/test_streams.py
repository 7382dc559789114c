"""Streams equal their batch counterparts; panes bound the state; held-back pages and repeated batches."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.operators import facts as FO
from plumbline.operators import pages as PO
from plumbline.sources import files as IO
from plumbline.streaming import jobs as J

URL = "https://site.example/{}"
POST = ('<div class="post-outer"><a href="https://site.example/{0}">self</a><h1>Post {0}</h1><p>Tank {0} holds 1,50{0} litres. It is blue.</p>'
        '<h2>Sources</h2><ol><li><a href="https://doi.org/{0}">P</a></li></ol></div><div class="post-outer">teaser 999 tons</div>')
BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Pages in three files and facts in two; page 4 holds no post."""
    base = tmp_path_factory.mktemp("x1")
    pages = spark.createDataFrame([(i, URL.format(i), "<p>Tank 4 holds 1,504 litres.</p>" if i == 4 else POST.format(i), BASE + dt.timedelta(minutes=i)) for i in range(9)],
                                  "page_id bigint, url string, html string, ts timestamp")
    facts = spark.createDataFrame([(i, k, *f, BASE + dt.timedelta(minutes=i + k)) for i in range(10) for k, f in enumerate(
        [(f"tank {i} holds 1,50{i} LITRES", f"1,50{i}"), ("teaser 999 tons", "999"), (f"Tank {i} holds", "77")])], "page_id bigint, fact_id bigint, quote string, value string, ts timestamp")
    for df, name, n in ((pages, "pages", 3), (facts, "facts", 2)):
        df.repartition(n).write.parquet(f"{base}/{name}")
    reader = lambda df, name: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/{name}")
    return pages, facts, reader(pages, "pages"), reader(facts, "facts")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_posts_on_a_stream(inputs):
    pages, facts, page_stream, fact_stream = inputs
    table = J.run_posts(page_stream)
    assert rows(J.run_to_table(J.post_errors(table), "e")) == [(4, URL.format(4), "no post container")]
    batch = PO.isolate_main(pages)
    assert rows(J.run_to_table(J.post_sentences(table), "s")) == rows(FO.mine_numeric_sentences(batch.where("strategy IS NOT NULL"), id="page_id", text="canonical_text"))
    assert rows(J.run_to_table(J.post_citations(table), "c")) == rows(J.post_citations(batch)) and J.post_citations(batch).count() == 8
    docs = batch.where("strategy IS NOT NULL").select("page_id", F.col("canonical_text").alias("text"))
    want = FO.gate_facts(facts.join(docs.select("page_id"), "page_id", "left_semi"), docs, on="page_id").select("page_id", "fact_id", "status", "reason", F.col("char_offset").cast("bigint"))
    got = rows(J.run_to_table(J.gated_facts(table, fact_stream), "g"))
    assert got == rows(want) and len(got) == 24 and Counter(r[2] for r in got) == {"kept": 8, "dropped": 16}
    assert not any(r[0] in (4, 9) for r in got)  # neither the held page's facts nor those of a page that never came


def test_a_page_is_parsed_once(inputs, monkeypatch):
    from plumbline.functions import markup as M

    calls = []
    keep = M.parse
    monkeypatch.setattr(M, "parse", lambda source: calls.append(1) or keep(source))
    found = PO._post(POST.format(1), URL.format(1), ["post-body-container", "post-outer"])
    assert found[0] == 1 and found[1] == "Post 1" and "999" not in found[3] and len(calls) == 1


def events(n=400):
    r = random.Random(3)
    return sorted(((BASE + dt.timedelta(minutes=r.randrange(60 * 24 * 40)), r.choice(["a", "b", None])) for _ in range(n)), key=str)


@pytest.mark.parametrize(("size", "slide", "pane"), [("30 days", "1 day", None), ("6 days", "4 days", "2 days"), ("1 day", None, None)])
def test_rolling_counts_equal_the_batch(spark, tmp_path, size, slide, pane):
    data = events()
    df = spark.createDataFrame(data, "ts timestamp, region string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    got = J.run_to_table(J.rolling_counts(stream, size=size, slide=slide, pane=pane), "r")
    closed = max(t for t, _ in data) - dt.timedelta(hours=1)
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    want = df.groupBy(w.alias("w"), "region").count().select("w.start", "w.end", "region", "count").where(F.col("end") <= F.lit(closed))
    assert rows(got) == rows(want)


def test_panes_hold_the_state(spark, tmp_path):
    """Each event touches one pane; only closed panes, a row for each group, are spread over thirty windows."""
    df = spark.createDataFrame(events(2000), "ts timestamp, region string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = J.rolling_counts(stream).writeStream.format("noop").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    steps = [p.stateOperators for p in q.recentProgress]
    assert len(steps[0]) == 2
    days = df.select(F.to_date("ts"), "region").distinct().count()
    touched = sorted(sum(p[k].numRowsUpdated for p in steps) for k in (0, 1))
    assert touched[0] <= days and touched[1] <= days * 30 and days * 30 < 2000 * 30 / 10


def test_two_streams_never_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "held")
    runs = lambda a, b: spark.range(a, b).withColumn("decision", F.lit("hold"))
    first, second = J.held_sink(path, "monday"), J.held_sink(path, "tuesday")
    for sink, a in ((first, 0), (first, 0), (second, 10)):  # a repeated batch, and batch 0 of a new checkpoint
        sink(runs(a, a + 3), 0)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 10, 11, 12]
    with pytest.raises(ValueError):
        J.held_sink(path, "../x")(runs(0, 1), 0)


def test_review_queue_has_both_tables_or_neither(spark, tmp_path):
    decisions = spark.createDataFrame([(1, "hold"), (2, "pass"), (3, "hold")], "run_id int, decision string")
    runs, scenes = decisions.select("run_id"), spark.createDataFrame([(r, s, 5.0) for r in (1, 2, 3) for s in (0, 1)], "run_id int, scene int, overall double")
    path = str(tmp_path / "review")
    for _ in range(2):
        IO.write_review_queue(decisions, runs, scenes, path, "2024-01-01", "r", 0)
    IO.append_batch(scenes.where("run_id = 2").select("run_id", "scene", "overall"), f"{path}/scenes", 1, "r")  # a batch that ended between its tables
    head, rows_ = IO.read_review_queue(spark, path)
    assert sorted(r.run_id for r in head.collect()) == [1, 3] and sorted((r.run_id, r.scene) for r in rows_.collect()) == [(1, 0), (1, 1), (3, 0), (3, 1)]
