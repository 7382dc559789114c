"""Tables that grow with the input are shuffled and merged, not gathered in the driver, however small Spark believes them."""

import pytest

from plumbline.operators import dedup, gates, segments, verify
from plumbline.plans import catalog
from plumbline.plans import standins as V
from plumbline.plans.gate_queries import RULES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def read(spark):
    return lambda table: spark.read.parquet(f"{SF}/{table}.parquet")


def no_broadcast(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("name", ["expand_segments", "lint_segments", "number_segments", "overlap_flag", "referenced_facts", "reflow",
                                  "review_sheet", "word_topup", "render_flags"])
def test_queries(spark, name):
    no_broadcast(catalog.QUERIES[name](spark, SF))


def test_operators(read):
    scripts, facts, cites = V.scripts(read), V.script_facts(read), V.script_citations(read)
    no_broadcast(segments.referenced_facts(scripts, facts, cites))
    no_broadcast(gates.gate_numbers(scripts, facts, RULES))
    shots = scripts.selectExpr("run_id", "pos", "concat('s', pos) as id")
    no_broadcast(verify.review_sheet(shots, shots.selectExpr("run_id", "id", "1 as match_score", "true as legible"), scripts, facts))


def test_near_dup(spark):
    rows = spark.createDataFrame([(1, i, i * 77) for i in range(40)], "run_id long, ord long, h long")
    no_broadcast(dedup.near_dup(rows, 6))
