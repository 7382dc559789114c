"""Rows dealt out by a run are joined by run and more where they lie; the first row of a key reaches all its blocks."""

import pytest
from pyspark.sql import functions as F

from plumbline import session
from plumbline.operators import ordered
from plumbline.operators import segments as S
from plumbline.plans import catalog, segment_queries

KEY = "spark.sql.requireAllClusterKeysForCoPartition"
SMALL = "/root/testdata/sf0.001"


def test_render_flags_shuffles_fitted_shots_once(spark):
    out = catalog.QUERIES["render_flags"](spark, SMALL)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the rows; blocks by block, by run and beside the rows
    assert plan.count("Exchange hashpartitioning") <= 4


def test_the_setting_holds_for_the_cut_only(spark):
    a = session.dealt(spark.range(50).selectExpr("id % 7 AS k", "id AS v"), "k")
    b = session.dealt(spark.range(50).selectExpr("id % 7 AS k", "id AS v", "-id AS w"), "k")
    joined = a.join(session.large(b), ["k", "v"])
    before = spark.conf.get(KEY)
    assert {tuple(r) for r in session.cut_in_place(joined).collect()} == {(i % 7, i, -i) for i in range(50)}
    assert spark.conf.get(KEY) == before
    with pytest.raises(Exception, match="broken"):
        session.cut_in_place(joined.select(F.raise_error(F.lit("broken"))))
    assert spark.conf.get(KEY) == before
    spark.conf.set(KEY, "false")
    session.cut_in_place(joined)
    assert spark.conf.get(KEY) == "false"
    spark.conf.unset(KEY)


def test_a_long_run_has_one_first_beat(spark):
    n = 2 * ordered.BLOCK_ROWS + 5
    beats = ["hook" if i < 3 else "stakes" if i < ordered.BLOCK_ROWS else "hook" if i % 4000 < 2000 else "cta" for i in range(n)]
    rows = [("a", i, b, 0.04 + 0.02 * (i % 2)) for i, b in enumerate(beats)] + [("b", 9000, "cta", -0.06), ("b", 9001, "hook", None)]
    shots = spark.createDataFrame(rows, "run_id string, ord long, beat string, delta_s double")
    got = {(r.run_id, r.ord): (r.rerender, r.fade_s) for r in S.render_flags(shots).collect()}
    want = {("a", i): (i % 2 == 1, 0.25 if i and b != beats[i - 1] and b != "hook" else 0.0) for i, b in enumerate(beats)}
    assert got == want | {("b", 9000): (True, 0.0), ("b", 9001): (None, 0.25)}


def test_what_shots_are_made_of_is_dealt_out_by_run(spark):
    spark.conf.set(KEY, "false")
    try:
        plan = segment_queries._expand(lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(KEY)
    assert plan.count("REPARTITION_BY_NUM") == 4 and "ENSURE_REQUIREMENTS" not in plan
