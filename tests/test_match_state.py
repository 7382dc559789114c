import random

from pyspark.sql import functions as F

from plumbline.operators import dedup as D
from plumbline.operators import match as M
from plumbline.operators import state as P
from plumbline.operators import verify as O


def test_near_dup_equals_the_greedy_rule_with_many_copies(spark):
    rnd = random.Random(7)
    rows = []
    base = [rnd.getrandbits(63) for _ in range(6)]
    for run in (1, 2):
        for i in range(60):
            h = base[0] if i % 3 == 0 else base[rnd.randrange(6)]  # a third are copies of one hash
            for _ in range(rnd.choice([0, 4, 8, 9, 12])):
                h ^= 1 << rnd.randrange(63)
            rows.append((run, i, h))
    rows.append((1, 60, None))
    got = {(r["run_id"], r["ord"]): r["is_dup"] for r in D.near_dup(spark.createDataFrame(rows, "run_id bigint, ord bigint, h bigint")).collect()}
    for run in (1, 2):
        kept = []
        for r, i, h in rows:
            if r != run or h is None:
                continue
            dup = any(bin(h ^ k).count("1") <= 8 for k in kept)
            assert got[(run, i)] == dup
            if not dup:
                kept.append(h)
    assert got[(1, 60)] is False


C = "segment_id bigint, tier string, ord bigint, url string, gate_reason string, reject_reason string, score int"


def test_ladder(spark):
    seg = spark.createDataFrame([(1, "w"), (2, "w"), (3, "w"), (4, " "), (5, "w")], "segment_id bigint, wish string")
    rows = [(1, "own", 0, "o", None, None, 5), (1, "blog", 0, "b", None, None, 10),          # own accepted at 5
            (2, "own", 0, "o", None, None, 3), (2, "blog", 0, "x", "blacklisted", None, 10), (2, "blog", 1, "b", None, None, 8),
            (3, "api", 0, "a", None, None, 5), (3, "scrape", 0, "s", None, None, 6), (4, "own", 0, "o", None, None, 9)]
    rows += [(5, "own", i, f"n{i}", None, None, 0) for i in range(8)] + [(5, "own", 8, "late", None, None, 10)]  # the ninth is never judged
    choice, dec = M.acquire_ladder(seg, spark.createDataFrame(rows, C), per_tier=8)
    got = {r["segment_id"]: (r["url"], r["reason"]) for r in choice.collect()}
    assert got == {1: ("o", None), 2: ("b", None), 3: (None, "no_acceptance"), 4: (None, "no_wish"), 5: (None, "no_acceptance")}
    d = [(r["segment_id"], r["url"], r["reason"]) for r in dec.collect()]
    assert (2, "x", "blacklisted") in d and (3, "a", "score_5") in d and not any(u == "late" for _, u, _ in d) and (1, "b", None) not in d
    whole = {r["segment_id"]: r["url"] for r in M.acquire_ladder(seg, spark.createDataFrame(rows, C))[0].collect()}
    assert whole[5] == "late"  # no limit unless given
    assert {r["reason"] for r in M.acquire_ladder(seg, spark.createDataFrame(rows, C), bypass=True)[0].collect()} == {"torture_mode"}


def test_pre_gates_order_and_lookalike_hosts(spark):
    rows = [(1, "api", 0, "https://img.shutterstock.com/a", 2000, 10), (1, "api", 1, "https://notshutterstock.com/a", 2000, 10),
            (1, "api", 2, " https://NOTshutterstock.com/a", 100, 10), (1, "api", 3, "https://ok.org/small", 100, 100), (1, "scrape", 4, "https://notshutterstock.com/a", 2000, 1)]
    out = M.pre_gates(spark.createDataFrame(rows, "segment_id bigint, tier string, ord bigint, url string, width int, height int"))
    assert [r["reason"] for r in out.orderBy("ord").collect()] == ["blacklisted", None, "duplicate", "low_resolution", None]


def test_scores(spark):
    df = spark.createDataFrame([("pexels", "red steel tank", 1920, 1080, 200000), ("pexels", "x", 800, 600, 0), ("none", "x", 0, 0, 0)],
                               "source string, caption string, width int, height int, file_size int")
    df = df.withColumn("is_clip", F.lit(False)).withColumn("views", F.lit(0)).withColumn("duration_s", F.lit(0.0))
    assert [r[0] for r in df.select(M.quality_score(F.lit("steel tank"))).collect()] == [30 + 10 + 10 + 16 + 8 + 15, -100, 30]
    c = spark.createDataFrame([("water treatment plant", "the plant treats water"), ("breaking news water", "water"), ("fig 3 water", "water"), ("", "x"), ("a b", "water")], "c string, n string")
    got = [r[0] for r in c.select(M.context_score("c", "n", F.array(F.lit("plant")), F.lit(""))).collect()]
    assert got == [24 + 20 + 30 + 15, 0, 0, 0, 10]


def test_token_match_and_index(spark):
    w = spark.createDataFrame([(1, "wastewater treatment clarifier tanks"), (2, "ocean sunset beach")], "wish_id bigint, wish string")
    a = spark.createDataFrame([("tanks.png", "clarifier tanks at a wastewater plant"), ("b.png", "a beach")], "path string, description string")
    assert [(r["wish_id"], r["path"], r["overlap"]) for r in M.match_by_tokens(w, a).collect()] == [(1, "tanks.png", 3)]
    idx = spark.createDataFrame([("a", 1, False), ("b", 1, True)], "path string, mtime int, failed boolean")
    lst = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("a2", 1)], "path string, mtime int")
    assert sorted(r["path"] for r in P.incremental_index(idx, lst).collect()) == ["a2", "c"]
    assert sorted(r["path"] for r in P.incremental_index(idx, lst, force=True).collect()) == ["a2", "b", "c"]


def test_bands_and_routes(spark):
    s = spark.createDataFrame([(1, 8.0, False), (1, 7.0, False), (2, 9.0, False), (2, 4.9, False), (3, 6.0, False), (4, 0.0, True)], "run_id bigint, overall double, ungradeable boolean")
    got = {r["run_id"]: r["decision"] for r in O.decision_band(spark.range(1, 6).withColumnRenamed("id", "run_id"), s).collect()}
    assert got == {1: "pass", 2: "fail", 3: "hold", 4: "hold", 5: "hold"}
    d = spark.createDataFrame([(1, 0, "off_brand"), (1, 0, "low_quality"), (2, 1, "text_clipped"), (3, 1, "odd")], "run_id bigint, scene int, code string")
    assert sorted((r["run_id"], r["action"], r["scene"]) for r in O.route_defects(d).collect() if r["scene"] is not None) == [(1, "re_source", 0)]
    assert sorted(r["run_id"] for r in O.route_defects(d).where("action = 're_render'").collect()) == [1, 2]


def test_history_uses_utc_for_naive_times(spark):
    h = spark.createDataFrame([("2024-01-30", "eu"), ("2023-12-01T00:00:00", "eu"), ("junk", "eu"), ("2024-01-01T01:00:00+02:00", None)], "created_at string, region string")
    h = h.withColumn("publish_results", F.expr("map('yt', named_struct('success', true))"))
    before = spark.conf.get("spark.sql.session.timeZone")
    for tz in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        got = {(r["metric"], r["key"]): r["n"] for r in O.history_stats(h, "2024-01-31 00:00:00").collect()}
        assert got == {("count", ""): 1, ("region", "eu"): 1, ("platform", "yt"): 1}
    spark.conf.set("spark.sql.session.timeZone", before)


def test_state(spark):
    e = spark.createDataFrame([(1, 1, "ingested", {"a": "1"}, None), (1, 2, "facts", {"a": "2", "b": "3"}, None), (1, 3, "failed", {}, "boom"), (2, 1, "odd", {}, None)],
                              "run_id bigint, seq bigint, status string, artifacts map<string,string>, error string")
    st = P.current_state(e)
    r = {x["run_id"]: x for x in st.collect()}[1]
    assert (r["status"], r["last_ok"], r["error"], r["artifacts"]) == ("failed", "facts", "boom", {"a": "2", "b": "3"})
    todo = P.remaining_stages(st, until="audio")
    assert [x["stage"] for x in todo.where("run_id = 1").orderBy("ord").collect()] == ["scripted", "shotlisted", "audio"]
    assert todo.where("run_id = 2").count() == 6


def test_rank_all_splits_a_scene_of_equal_scores(spark):
    """A scene with a third of all rows and one score is ranked in more than one task; NULL is a scene of its own."""
    rows = spark.range(0, 6000, 1, 4).select(F.when(F.col("id") < 2000, 1).when(F.col("id") < 2005, None).otherwise(F.col("id") % 50 + 2).alias("scene"), F.lit(7).alias("score"), ((F.col("id") * 7919) % 6000).alias("cand"))
    got = M.rank_all(rows, ["scene"], ["score", "cand"])
    w = __import__("pyspark").sql.Window.partitionBy("scene").orderBy("score", "cand")
    assert got.select("scene", "cand", "rank").exceptAll(rows.select("scene", "cand", F.row_number().over(w).cast("bigint").alias("rank"))).count() == 0 and got.count() == 6000
    parts = rows.repartitionByRange(4, "scene", "score", "cand").where("scene = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_limits_are_arguments(spark):
    rows = [("q", p, f"{p}{i}", i) for p in "ab" for i in range(6)] + [(None, None, "n", 0)]
    d = spark.createDataFrame(rows, "query string, provider string, doc string, ord int")
    whole = [(r.doc, r.position) for r in M.round_robin(d).where("query = 'q'").orderBy("position").collect()]
    assert whole == [(f"{p}{i}", 2 * i + k + 1) for i in range(6) for k, p in enumerate("ab")] and M.round_robin(d).count() == 13
    assert [(r.doc, r.position) for r in M.round_robin(d, limit=5).where("query = 'q'").orderBy("position").collect()] == whole[:5]
    short = spark.createDataFrame([(1, i, f"u{i}", 5, False) for i in range(1, 31)], "scene_id int, rank int, url string, quality int, is_dup boolean")
    verdicts = spark.createDataFrame([(1, f"u{i}", 9 if i == 20 else 5 if i < 15 else None) for i in range(1, 31)], "scene_id int, url string, verdict int")
    choice, kept = M.select_best(short, verdicts)
    assert choice.head().url == "u20" and kept.count() == 15 and kept.where("place = 2").head().url == "u1"
    choice, kept = M.select_best(short, verdicts, first=12, keep=3)
    assert choice.head().degraded and kept.count() == 3
