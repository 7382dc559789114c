from pyspark.sql import functions as F

from plumbline.plans.content import build_stages
from test_gates_segments import RULES, SEG, change, clean
from test_pages_facts import PAGE, URL

FACTS = "page_id bigint, id string, quote string, value string, unit string, marker int"


def test_poisoned_page_and_invented_number_stop(spark, tmp_path):
    """Sibling text never becomes a fact; a run with an invented number yields no shots."""
    pages = spark.createDataFrame([(1, URL, PAGE), (2, URL, PAGE)], "page_id bigint, url string, html string")
    facts = spark.createDataFrame([r for p in (1, 2) for r in (
        (p, "f1", "dosage range of 1.5 to 3 kg per cubic meter", "1.5-3", "kg", 1), (p, "f2", "Sibling says 150,000 metric tons", "150000", "t", 2))], FACTS)
    good = change(clean(1), 3, fact_ids=["f1"])
    bad = change(change(clean(2), 3, fact_ids=["f2"]), 3, card_text="Some 150,000 tons")
    seg = spark.createDataFrame([tuple(r) for r in good + bad], SEG)
    beats = spark.createDataFrame([(r, i, b, s, d) for r in (1, 2) for i, (b, s, d) in enumerate(
        [("hook", 0.0, 3.0), ("stakes", 3.3, 6.0), ("mechanism", 9.6, 10.0), ("proof", 19.9, 8.0), ("cta", 28.2, 7.0)])],
        "run_id bigint, pos bigint, beat string, start_s double, duration_s double")
    voice = spark.createDataFrame([(1, 35.2), (2, 35.2)], "run_id bigint, voice_total_s double")
    out = build_stages(str(tmp_path), pages, facts, seg, RULES, beats, voice)
    assert {(r["page_id"], r["id"], r["status"]) for r in out["facts"].collect()} == {(p, f, s) for p in (1, 2) for f, s in (("f1", "kept"), ("f2", "dropped"))}
    assert {r["run_id"] for r in out["violations"].collect()} == {2}
    assert {r["run_id"] for r in out["shots"].collect()} == {1}
    timed = out["timed"]
    assert timed.where("error IS NOT NULL").count() == 0
    assert abs(timed.select(F.sum("new_s")).first()[0] - (35.2 + 1.5)) < 1e-6


def test_until_stops_early(spark, tmp_path):
    pages = spark.createDataFrame([(1, URL, PAGE)], "page_id bigint, url string, html string")
    out = build_stages(str(tmp_path), pages, spark.createDataFrame([], FACTS), spark.createDataFrame([], SEG), RULES, until="citations")
    assert list(out) == ["posts", "citations"] and out["citations"].count() == 2
