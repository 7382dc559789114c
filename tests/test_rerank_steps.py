"""Reranking: no task holds the sorts and sums of all steps at once."""

from plumbline.operators import match as M


def test_rerank_joins_once_in_the_last_step(spark):
    ranked = spark.createDataFrame([(s, r, 40 - r, r) for s in (1, 2, 3, 4) for r in (1, 2, 3, 4, 5)], "scene_id long, rank long, context long, quality long")
    text = {1: "995", 2: "090", 3: "55", 4: "000"}  # 3 has a score too few, of 4 nothing survives
    scores = spark.createDataFrame([(s, i + 1, c) for s, cs in text.items() for i, c in enumerate(cs)], "scene_id long, rank long, score string")
    out = M.rerank(ranked, scores, n_top=3)
    want = [(1, r, r) for r in (1, 2, 3, 4, 5)] + [(2, 2, 1), (2, 4, 2), (2, 5, 3)] + [(3, r, r) for r in (1, 2, 3, 4, 5)]
    assert sorted((x.scene_id, x["rank"], x.position) for x in out.collect()) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1, plan
