import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import gates as G
from plumbline.operators import ordered
from plumbline.operators import segments as S

RULES = G.Rules([("b1", "Quotes within 2 days"), ("b2", "Solar plant")], ["Guide on example.org", "Call 24 hours"], "example.org", ["certified"])
SEG = "run_id bigint, pos bigint, beat string, narration string, card_text string, broll_wish string, fact_ids array<string>, labels array<string>"
FACTS = "run_id bigint, id string, quote string, value string, unit string, marker int"


def words(n, tail=""):
    return " ".join(["flow"] * (n - len(tail.split()))) + (" " + tail if tail else "")


def clean(run=1):
    return [[run, 0, "hook", words(7), "Steady supply", "pump", [], None], [run, 1, "stakes", words(11), "Cost of stops", "", ["f1"], None],
            [run, 2, "mechanism", words(18, "needs 1.5 kg"), "How it works", "", ["f1"], ["in", "out"]],
            [run, 3, "proof", words(14), "Proof", "", ["f2"], None], [run, 4, "cta", words(13), "Call us", "", ["b1"], None]]


def gates(spark, cases):
    """Violations per named case; all cases are runs of one table, so one job checks them all."""
    names = list(cases)
    rows = [tuple([n, *r[1:]]) for n, name in enumerate(names) for r in cases[name]]
    facts = [(n, *f) for n in range(len(names)) for f in (("f1", "A load of 1.5 to 13 kg", "1.5", "kg", 1), ("f2", "paper says 1,500 units", "1500", "u", 2))]
    out = {name: [] for name in names}
    for r in G.run_gates(spark.createDataFrame(rows, SEG), spark.createDataFrame(facts, FACTS), RULES).collect():
        out[names[r["run_id"]]].append((r["gate"], r["message"]))
    return {k: sorted(v) for k, v in out.items()}


def change(rows, pos, **kw):
    names = ["run_id", "pos", "beat", "narration", "card_text", "broll_wish", "fact_ids", "labels"]
    rows = [list(r) for r in rows]
    for k, v in kw.items():
        rows[pos][names.index(k)] = v
    return rows


def test_gates_on_one_clean_run_and_its_mutations(spark):
    base = clean()
    got = gates(spark, {
        "clean": base,
        "untraced": change(base, 2, card_text="Save 150"),
        "inside a larger number": change(base, 2, card_text="Only 3"),
        "traced": change(base, 2, card_text="Up to 13"),
        "thousands": change(base, 3, card_text="At 1,500"),
        "label": change(base, 2, labels=["in 9", "out"]),
        "rule texts count": change(base, 4, card_text="In 24 or 2"),
        "banned": change(base, 1, card_text="Certified GAME-CHANGER"),
        "hook too long": change(base, 0, narration=words(9)),
        "no differentiator": change(base, 4, fact_ids=[]),
        "early differentiator": change(base, 1, fact_ids=["b2"]),
        "echo": change(base, 1, card_text="flow flow flow flow flow flow flow flow"),
        "too few beats": base[:4],
        "wrong order": change(change(base, 0, beat="stakes"), 1, beat="hook", card_text="certified"),
    })
    kinds = {k: [g for g, _ in v] for k, v in got.items()}
    assert kinds["clean"] == kinds["traced"] == kinds["thousands"] == kinds["rule texts count"] == []
    assert kinds["untraced"] == kinds["inside a larger number"] == kinds["label"] == ["numbers"]
    assert kinds["banned"] == ["banned"] * 3  # one phrase is on two lists
    assert kinds["hook too long"] == ["budget"]
    assert kinds["no differentiator"] == kinds["early differentiator"] == ["differentiator"]
    assert [m for _, m in got["echo"]] == ["card[stakes]: card_text duplicates narration", "card[stakes]: card_text longer than 7 words"]
    assert kinds["too few beats"] == kinds["wrong order"] == ["structure"]


def test_topup_reaches_the_floor(spark):
    rows = [[1, i, b, words(n), "x", "", ["b1"] if b == "cta" else [], None] for i, (b, n) in enumerate(zip(G.BEATS, (5, 8, 14, 12, 12)))]
    seg = spark.createDataFrame([tuple(r) for r in rows], SEG)
    v = G.run_gates(seg, spark.createDataFrame([], FACTS), RULES)
    assert [r["gate"] for r in v.collect()] == ["total_duration"]
    out = G.word_topup(seg, v)
    assert out.select(F.sum(F.size(F.split("narration", " ")))).first()[0] == 60
    assert G.run_gates(out.drop("added"), spark.createDataFrame([], FACTS), RULES).count() == 0


def test_expand(spark):
    cites = spark.createDataFrame([(1, 1, "https://doi.org/x"), (1, 2, "https://www.web.net/y")], "run_id bigint, marker int, url string")
    facts = spark.createDataFrame([(1, "f1", "A load of 1.5 kg", "1.5", "kg", 2), (1, "f2", "paper says 9 units", "9", "u", 1)], FACTS)
    rows = change(clean(), 0, narration="one two three four five, six seven eight nine")
    shots = S.number_segments(S.expand_segments(spark.createDataFrame([tuple(r) for r in rows], SEG), facts, cites, RULES))
    got = [(r["id"], r["type"]) for r in shots.orderBy("ord").collect()]
    assert [t for _, t in got[:4]] == ["BROLL", "HEADLINE_CARD", "STAT_CARD", "HEADLINE_CARD"]
    assert [t for _, t in got[-3:]] == ["PAPER_CARD", "STAT_CARD", "LOGO_CTA"]
    assert [i for i, _ in got] == [f"s{n:02d}" for n in range(len(got))]
    by = {r["type"]: r for r in shots.collect()}
    assert by["PAPER_CARD"]["fallback"]["payload"]["source"] == "Source [1] — doi.org"
    assert by["LOGO_CTA"]["payload"]["differentiator"] == "Quotes within 2 days"
    bad = shots.withColumn("payload", F.when(F.col("type") == "STAT_CARD", F.create_map(F.lit("fact_id"), F.lit("f1"), F.lit("value"), F.lit("77"))).otherwise(F.col("payload")))
    assert {r["rule"] for r in S.lint_segments(bad, facts).collect()} >= {"untraced value 77"}


def test_reflow_fits_the_measured_voice(spark):
    beats = [("hook", 0.0, 3.0), ("stakes", 3.3, 5.0), ("mechanism", 8.6, 10.0), ("proof", 18.9, 8.0), ("cta", 27.2, 7.0)]
    b = spark.createDataFrame([(1, i, *x) for i, x in enumerate(beats)], "run_id bigint, pos bigint, beat string, start_s double, duration_s double")
    spans = S.beat_spans(b, spark.createDataFrame([(1, 34.2)], "run_id bigint, voice_total_s double"))
    span = {r["beat"]: r["span_s"] for r in spans.collect()}
    assert abs(sum(span.values()) - 35.7) < 1e-9 and abs(span["hook"] - 3.3) < 1e-9 and abs(span["cta"] - 8.5) < 1e-9
    plan = [("hook", "HEADLINE_CARD", 3.0), ("stakes", "STAT_CARD", 2.5), ("stakes", "HEADLINE_CARD", 2.5), ("mechanism", "DIAGRAM", 3.3),
            ("mechanism", "DIAGRAM", 3.3), ("mechanism", "DIAGRAM", 3.3), ("proof", "STAT_CARD", 4.0), ("proof", "QUOTE_CARD", 4.0), ("cta", "LOGO_CTA", 7.0)]
    shots = spark.createDataFrame([(1, i, *p) for i, p in enumerate(plan)], "run_id bigint, ord bigint, beat string, type string, duration_s double")
    out = S.reflow(shots, spans).collect()
    for beat, s in span.items():
        assert abs(sum(r["new_s"] for r in out if r["beat"] == beat) - s) < 1e-6
    assert all(r["error"] is None for r in out)
    gone = S.reflow(shots.where("beat <> 'proof'"), spans).where("error IS NOT NULL").collect()
    assert [(r["beat"], r["error"]) for r in gone] == [("proof", "no shots for beat")]


def timed(lengths):
    """(word, start, end) of words w0, w1 … that follow one another without a gap."""
    at, out = 0.0, []
    for i, d in enumerate(lengths):
        out.append((f"w{i}", at, at + d))
        at += d
    return out


# lengths of the words -> first words of the cues, worked out by hand for three words and 1.5 s
CUES = [([0.5] * 9, [0, 3, 6]), ([1.0] * 5, [0, 1, 2, 3, 4]), ([0.75] * 6, [0, 2, 4]), ([0.25, 0.25, 1.25, 0.25, 2.0, 0.5, 0.5, 0.5, 0.5], [0, 2, 4, 5, 8]), ([2.0], [0]), ([0.5, 1.0, 0.25, 0.25], [0, 2])]


def expected(doc, lengths, firsts):
    w = timed(lengths)
    return {(doc, a, w[a][1], w[z - 1][2], " ".join(x[0].upper() for x in w[a:z])) for a, z in zip(firsts, [*firsts[1:], len(w)])}


@pytest.mark.parametrize("block", [2, 4, 1024])
def test_cues_across_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(S, "CUE_BLOCK", block)
    rows = [(d, i, *w) for d, (lengths, _) in enumerate(CUES) for i, w in enumerate(timed(lengths))]
    want = set().union(*(expected(d, *c) for d, c in enumerate(CUES)))
    got = {tuple(r) for r in S.group_cues(spark.createDataFrame(rows, "doc bigint, idx bigint, word string, start_s double, end_s double")).select("doc", "idx", "start_s", "end_s", "text").collect()}
    assert got == want


def test_streamed_cues_in_any_order(spark, tmp_path):
    from plumbline.streaming import jobs as J

    rows = [(d, i, *w, i + 1 == len(lengths)) for d, (lengths, _) in enumerate(CUES) for i, w in enumerate(timed(lengths))]
    schema = "doc bigint, idx bigint, word string, start_s double, end_s double, last boolean"
    for n in range(3):  # the last words come first, over three batches
        spark.createDataFrame(rows[::-1][n::3], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        got = {tuple(r) for r in J.run_to_table(J.stream_cues(stream), "t", rocksdb=True).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == set().union(*(expected(d, *c) for d, c in enumerate(CUES)))


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_scan_equals_a_plain_window_on_a_hot_key(spark, block):
    rows = [(0 if i % 3 else i % 5, i, i % 7) for i in range(200)]  # key 0 holds most rows
    df = spark.createDataFrame(rows, "k bigint, pos bigint, v bigint")
    got = {(r["k"], r["pos"]): (r["s"], r["p"], r["n"]) for r in ordered.scan(
        df, ["k"], ["pos"], sums={"s": F.col("v")}, previous={"p": F.when(F.col("v") > 2, F.col("v"))}, following={"n": F.col("v")}, block=F.floor(F.col("pos") / block)).collect()}
    for k in {r[0] for r in rows}:
        run = [r for r in rows if r[0] == k]
        for i, (_, pos, v) in enumerate(run):
            before = run[i - 1][2] if i else None
            want = (sum(r[2] for r in run[:i]), before if before is not None and before > 2 else None, run[i + 1][2] if i + 1 < len(run) else None)
            assert got[(k, pos)] == want


def test_running_smallest(spark):
    rnd = random.Random(1)
    rows = [(k, i, [rnd.choice("abcdefghij") for _ in range(2)]) for k in (1, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "k bigint, pos bigint, t array<string>")
    got = {(r["k"], r["pos"]): r["o"] for r in ordered.running_smallest(df, "k", "pos", "t", 3, "o", fan=3, levels=3).collect()}
    for k in (1, 2):
        seen = set()
        for kk, i, t in [r for r in rows if r[0] == k]:
            seen |= set(t)
            assert got[(k, i)] == sorted(seen)[:3]


def test_scan_shuffles_the_rows_once(spark):
    """The rows move once, by (key, block); the other exchanges carry one row per block."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "event_id", "value")
        out = ordered.scan(df, ["user_id"], ["event_id"], sums={"s": F.col("value")})
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 4


def test_missing_is_never_a_pass(spark):
    from plumbline.operators import verify as VO

    rows = [("r", i, b, None if i == 4 else []) for i, b in enumerate(G.BEATS)]
    seg = spark.createDataFrame(rows, "run_id string, pos bigint, beat string, fact_ids array<string>").withColumn("narration", F.lit("a b"))
    assert [r.gate for r in G.gate_differentiator(seg, RULES).collect()] == ["differentiator"]
    m = spark.createDataFrame([("r", "has_video", 1.0), ("r", "has_audio", 1.0), ("r", "duration_s", 40.0)], "run_id string, metric string, value double")
    assert {r.defect for r in VO.media_metrics_gate(m).collect()} == {"Filesize unknown", "Resolution mismatch", "Audio analysis failed"}
    d = spark.createDataFrame([], "run_id string, defect string")
    v = spark.createDataFrame([("r", "a", "BROLL", "acquired", None, True, None), ("r", "b", "STAT_CARD", "x", None, None, False), ("r", "c", "BROLL", "acquired", 2.0, True, False)],
                              "run_id string, id string, rendered_type string, resolved string, match_score double, legible boolean, ungradeable boolean")
    kinds = VO.classify_failures(d, v)
    assert {(r.id, r.kind) for r in kinds.collect()} == {("a", "error_ungradeable"), ("b", "error_ungradeable"), ("c", "broll_mismatch")}
    shots = spark.createDataFrame([("r", "c", "BROLL", {"text": "x"}, None, None)], "run_id string, id string, rendered_type string, payload map<string,string>, labels array<string>, fallback struct<type:string,payload:map<string,string>>")
    assert [r.fix for r in VO.apply_fixes(shots, kinds)[1].collect()] == ["no fallback declared"]


def test_redistribute_equals_the_loop(spark):
    """Three passes over a run's scenes, also of a run with most rows, nothing to scale, or nobody to take what is over."""
    import random

    r = random.Random(4)
    runs = {k: [r.choice([1.0, 5.0, 90.0, 0.0]) for _ in range(n)] for k, n in enumerate([1, 2, 5, 8, 400])} | {9: [0.0, 0.0], 10: [50.0, 50.0], 11: [None, 3.0]}
    audio = {k: 30.0 + 7 * k for k in runs}
    want = {}
    for k, ds in runs.items():
        d = [x or 0.0 for x in ds]
        total = sum(d)
        d = [audio[k] / len(d) for _ in d] if total <= 0.01 else [x * (audio[k] / total) for x in d]
        for _ in range(3):
            over, free = sum(max(0.0, x - 20.0) for x in d), sum(x < 20.0 for x in d)
            if over >= 0.01:
                d = [x + over / free if x < 20.0 else 20.0 for x in d]
        for i, x in enumerate(d):
            x += 1.2 if i == len(d) - 1 else 0.0
            want[k, i] = round(0.5 if x <= 0 else x, 6)
    scenes = spark.createDataFrame([(k, i, x) for k, ds in runs.items() for i, x in enumerate(ds)], "run_id int, pos int, duration_s double")
    out = S.redistribute(scenes, spark.createDataFrame(list(audio.items()), "run_id int, audio_s double"), cap=20.0, tail=1.2).collect()
    assert {(x.run_id, x.pos): round(x.new_s, 6) for x in out} == want


def test_claims_may_be_given(spark):
    seg = spark.createDataFrame([(1, 0, "opens with 7.5"), (1, 1, "again 1,5 here"), (1, 2, "7.5 there"), (2, 0, "x 4.5"), (2, 1, "4.5")], "run_id int, pos int, narration string")
    hero = spark.createDataFrame([(1, "costs 1,5 or 2")], "run_id int, stat string")
    got = {(x.run_id, x.pos): x.repeats for x in S.stat_repeat(seg, hero=hero).collect()}
    assert got == {(1, 1): True, (1, 2): False, (2, 1): None} or got == {(1, 1): True, (1, 2): False, (2, 1): False}
    assert {(x.run_id, x.pos): x.repeats for x in S.stat_repeat(seg).collect()} == {(1, 1): False, (1, 2): True, (2, 1): True}


def test_defects_carry_what_was_measured(spark):
    from plumbline.operators import verify as O

    rows = [(1, "duration_s", 12.5), (1, "filesize_mb", 3.0), (1, "has_video", 1.0), (1, "width", 720.0), (1, "height", 1280.0), (2, "has_video", 0.0), (2, "duration_s", 40.0)]
    got = {(x.run_id, x.defect): (x.measured, x.bound) for x in O.media_metrics_gate(spark.createDataFrame(rows, "run_id int, metric string, value double")).collect()}
    assert got[1, "Duration too short"] == ([12.5], [30.0]) and got[1, "Resolution mismatch"] == ([720.0, 1280.0], [1080.0, 1920.0])
    assert got[1, "No audio stream found"] == (None, None) and got[2, "Filesize unknown"] == (None, [100.0]) and (2, "Resolution mismatch") not in got
