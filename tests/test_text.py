from pyspark.sql import functions as F

from plumbline.functions import structured as S
from plumbline.functions import text as X


def one(spark, col, **vals):
    df = spark.range(1)
    for k, v in vals.items():
        df = df.withColumn(k, F.lit(v))
    return df.select(col.alias("x")).first()["x"]


def test_normalize_folds_spaces_dashes_quotes_and_is_idempotent(spark):
    raw = " A –&nbsp;“B”\n\t‘c’ — −1 "
    got = one(spark, X.normalize_for_match("t"), t=raw)
    assert got == "a - \"b\" 'c' - -1"
    assert one(spark, X.normalize_for_match("t"), t=got) == got


def test_sentences_keep_decimals(spark):
    got = one(spark, X.sentence_array("t"), t="Use 3.5 kg per load. Then wait! (Two days) is enough? yes. “Fine.”")
    assert got == ["Use 3.5 kg per load.", "Then wait!", "(Two days) is enough? yes.", "“Fine.”"]


def test_numeric_sentences_are_distinct_in_order(spark):
    got = one(spark, X.numeric_sentence_array("t"), t="B 2. A 1. B 2. None. b 2.")
    assert got == ["B 2.", "A 1."] or got == ["B 2.", "A 1.", "None. b 2."]


def test_numeric_and_stat_tokens(spark):
    assert one(spark, X.numeric_tokens("t"), t="1,500 to 3.5 and 10,000.") == ["1500", "3.5", "10000"]
    assert one(spark, X.stat_tokens("t"), t="costs 1.4 of 90 in 2 years") == ["1.4", "90"]


def test_unit_numbers_with_offsets(spark):
    t = "We saw 90% less, dosing 50 mg/L over 24 hours and 5°C drop; 3 kg/t, 7 ppm, 2 degrees C."
    got = [(r["value"], r["unit"], r["start"]) for r in one(spark, X.unit_numerics("t"), t=t)]
    assert [g[:2] for g in got] == [("90", "%"), ("50", "mg/L"), ("24", "hours"), ("5", "C"), ("3", "kg/t"), ("7", "ppm"), ("2", "C")]
    assert all(t[s:].startswith(v) for v, _, s in got)


def test_sentence_facts_are_unique_per_claim_and_match(spark):
    got = one(spark, X.sentence_facts("t"), t="<p>We saw 90% and 90% and 5 ppm. No unit 7.</p>")
    assert [(r["value"], r["unit"]) for r in got] == [("90", "%"), ("5", "ppm")]


def test_is_grounded_reads_the_whole_article(spark):
    art = "x " * 3000 + "treatment with 42 units"
    assert one(spark, X.is_grounded("c", F.lit(""), "a"), c="Treatment saves 42", a=art) is True
    assert one(spark, X.is_grounded("c", F.lit(""), "a", 3000), c="Treatment saves 42", a=art) is False
    assert one(spark, X.is_grounded("c", F.lit(""), "a"), c="no number treatment", a=art) is False


def test_queries(spark):
    got = one(spark, X.build_queries("s", "m", "n", "c"), s="steel tank", m="", n="The tank (large) should hold brine.", c="mining")
    assert got == ["steel tank industrial", "tank large hold brine industrial", "mining operation industrial"]


def test_small_helpers(spark):
    assert one(spark, X.parse_runtime("t"), t="1:02:03.5") == 3723.5
    assert one(spark, X.parse_runtime("t"), t="x:02") is None
    assert one(spark, X.trim_quote("t"), t="word " * 40) == ("word " * 24).strip() + "…"
    assert one(spark, X.pick_accent("t"), t="a longest, words") == "longest"
    assert one(spark, X.overlay_text_clean("t"), t="[Visual: x] Tank, 5 [m]") == "x Tank 5 m"
    assert one(spark, X.overlay_text_flag("t", "n"), t="flow is steady", n="the flow is steady") == "text_duplicates_voice"
    assert one(spark, X.remove_phrases("t"), t="In This Video we UNLOCK it") == "we it"
    assert one(spark, X.srt_time(F.lit(3661.0005))) == "01:01:01,000"
    assert one(spark, X.ass_time(F.lit(3661.25))) == "1:01:01.25"
    assert one(spark, X.truncate_words("t", F.lit(1.0)), t=" ".join("abcdefghij")) == "a b c d e f g h"


def test_long_phrases_are_chunked_and_packed(spark):
    got = one(spark, X.pack_phrases(X.split_phrases("t")), t="one two three four five six seven eight, nine, ten. eleven twelve")
    assert got == ["one two three four five", "six seven eight, nine, ten", "eleven twelve"] or " ".join(got).replace(",", "").split() == (
        "one two three four five six seven eight nine ten eleven twelve".split())
    assert one(spark, X.pack_phrases(X.split_phrases("t")), t="a b c d e, f") == ["a b c d e, f"]


def test_contracts(spark):
    good = '{"score": 7, "reason": "r", "focal_hint": "left"}'
    assert one(spark, S.contract_problems("t", "match"), t=good) == []
    assert one(spark, S.contract_problems("t", "match"), t=good.replace("7", "11")) == ["score: out of range"]
    assert one(spark, S.contract_problems("t", "match"), t=good.replace("left", "up")) == ["focal_hint: not allowed"]
    assert one(spark, S.contract_problems("t", "match"), t='{"score": 7, "reason": "r"}') == ["focal_hint: required"]
    assert one(spark, S.contract_problems("t", "match"), t="[1]") == ["top level: not an object"]
    fact = '{"facts": [{"id": "f", "verbatim_quote": "q", "value": "1", "unit": "", "claim_summary": "", "tags": ["risk"], "procurement_significance": 6, "citation_marker": null}]}'
    assert one(spark, S.contract_problems("t", "facts"), t=fact) == ["facts/0/procurement_significance: out of range"]


def test_model_text(spark):
    rows = [("```json\n{\"a\": [1, 2,],}\n```",), ("noise [1, {\"x\": \"}\"}] tail",), (None,)]
    got = [r["json"] for r in S.clean_model_text(spark.createDataFrame(rows, "raw string")).collect()]
    assert got[0] == '{"a": [1, 2]}' and got[1] == '{"x": "}"}' and got[2] is None


def test_chart_series_falls_back(spark):
    got = one(spark, S.chart_series(F.lit("bar"), "t"), t='{"z_load": "5 kg", "a": "x", "b-c": 3}')
    assert (got["labels"], got["values"]) == (["Z Load", "B C"], ["5.0", "3.0"])
    assert one(spark, S.chart_series(F.lit("line"), "t"), t='{"x": [1]}') is None
