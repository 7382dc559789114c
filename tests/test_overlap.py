"""Shared tokens and best partners against brute force; pairs grow with what can win, not with rows times rows."""

import random

from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.operators import match as M
from plumbline.operators import overlap as O


def test_shared_counts_equals_brute_force(spark, monkeypatch):
    r = random.Random(2)
    sets = lambda n, m: [(f"k{i}", [f"t{r.randrange(m)}" if r.random() < 0.7 else "hot" for _ in range(r.randrange(0, 12))]) for i in range(n)]
    left, right = sets(1500, 30) + [("none", None)], sets(60, 40) + [("many", [f"t{k}" for k in range(40)] * 3)]
    a, b = spark.createDataFrame(left, "l string, lt array<string>").repartition(3), spark.createDataFrame(right, "r string, rt array<string>").repartition(3)
    got = {(x.l, x.r): x.overlap for x in O.shared_counts(a, b, "l", "r", ("lt", "rt"), 2).collect()}
    want = {(i, j): n for i, s in left for j, t in right if (n := len(set(s or ()) & set(t))) >= 2}
    assert got == want
    assert O.shared_counts(a.limit(0), b, "l", "r", ("lt", "rt")).collect() == []


def test_joined_rows_stay_below_the_pairs(spark):
    """A right row meets posting lists, one for each token and 1,024 left rows, not each left row by each token."""
    left = spark.range(4000).select(F.col("id").alias("l"), F.array(*[F.lit(f"t{k}") for k in range(6)]).alias("lt"))
    right = spark.range(50).select(F.col("id").alias("r"), F.array(*[F.lit(f"t{k}") for k in range(6)]).alias("rt"))
    lists = O.postings(left.coalesce(1).withColumn("_l", F.monotonically_increasing_id()), "_l", "lt")
    joined = right.select("r", F.explode("rt").alias("_tok")).join(lists, "_tok").count()
    assert joined == 50 * 6 * 4 and O.shared_counts(left, right, "l", "r", ("lt", "rt"), 2).count() == 200_000


def test_match_by_tokens_has_no_limit_unless_given(spark):
    w = spark.createDataFrame([(1, "red steel tank"), (2, "blue")], "wish_id int, wish string")
    a = spark.createDataFrame([(f"p{i:02}", "red steel " + ("tank" if i == 7 else "pipe")) for i in range(20)], "path string, description string")
    rows = M.match_by_tokens(w, a).orderBy("rank").collect()
    assert [(x.path, x.overlap, x["rank"]) for x in rows][:3] == [("p07", 3, 1), ("p00", 2, 2), ("p01", 2, 3)] and len(rows) == 20
    assert M.match_by_tokens(w, a, limit=4).count() == 4


SCENES, CLIPS = "scene_id int, category string, visual_type string, text string", "id string, tags array<string>, categories array<string>, description string, good_for array<string>"


def brute(scenes, clips, least=2):
    def toks(t):
        out, w = set(), ""
        for c in (t or "") + " ":
            if c.isascii() and (c.isalpha() or w and c.isdigit()):
                w += c
            else:
                if len(w) > 2 and w.lower() not in K.STOP_FOOTAGE:
                    out.add(w.lower())
                w = ""
        return out

    out = set()
    for sid, cat, kind, text in scenes:
        best = None
        for cid, tags, cats, desc, good in clips:
            low = [{x.lower() for x in v or ()} for v in (tags, cats, good)]
            s = 5 * (cat is not None and cat.lower() in low[1]) + 2 * len(toks(text) & low[0]) + len(toks(text) & toks(desc))
            s += 3 * (kind == "own_edge" and ("factory" in low[0] or "establishing" in low[2])) + (kind == "stock" and "broll" in low[2])
            if s >= least and (best is None or (-s, cid) < best):
                best = (-s, cid)
        if best:
            out.add((sid, best[1], -best[0]))
    return out


def fixture(n_scenes, n_clips, seed=4):
    r = random.Random(seed)
    words = ["pump", "steel", "tank", "line", "valve", "gear"] + [f"word{k}" for k in range(40)]
    pick = lambda k: " ".join(r.choice(words[: r.choice([6, 46])]) for _ in range(k))
    scenes = [(i, r.choice(["A", "b", "C", None, "zz"]), r.choice(["own_edge", "stock", "footage", None]), pick(r.randrange(0, 6))) for i in range(n_scenes)]
    clips = [(f"c{i:04}", r.choice([None, [], ["Factory"], ["pump", "word3"], [f"tag{i}", "steel"]]), r.choice([["a"], ["a", "B"], ["c"], [], ["q"]]), pick(r.randrange(0, 7)),
              r.choice([None, ["broll"], ["establishing"], ["broll", "establishing"], []])) for i in range(n_clips)]
    return scenes, clips


def test_match_footage_equals_brute_force(spark):
    scenes, clips = fixture(120, 90)
    s, c = spark.createDataFrame(scenes, SCENES), spark.createDataFrame(clips, CLIPS)
    for common in (3, 1000):  # many frequent tokens, and none
        assert {tuple(x) for x in M.match_footage(s, c, common=common).collect()} == brute(scenes, clips)


def test_pairs_grow_with_what_can_win(spark, monkeypatch):
    """Four times the scenes and clips of the same kinds: candidates stay far below four times four."""
    counts = []
    keep = O.candidates
    monkeypatch.setattr(O, "candidates", lambda *a: counts.append({k: (out := keep(*a))[k].count() for k in ("rare", "floor", "near", "far")}) or out)
    for n in (1, 4):
        scenes = [(i, f"C{i % 3}", "stock", f"pump steel only{i % 50}") for i in range(200 * n)]
        clips = [(f"c{i:05}", ["steel" if i % 2 else "iron"], [f"c{i % 3}"], "a pump of it" if i % 3 else f"only{i % 70}", ["broll"]) for i in range(300 * n)]
        got = {tuple(x) for x in M.match_footage(spark.createDataFrame(scenes, SCENES), spark.createDataFrame(clips, CLIPS), common=8).collect()}
        if n == 1:
            assert got == brute(scenes, clips)
    one, four = (sum(c.values()) for c in counts)
    assert four <= 4 * one and four < 200 * 4 * 20, counts
