"""Batch scoring: only failed rows are asked again, and a raising call costs the others nothing."""

import pytest

from plumbline.operators import scoring as SC


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(i, f"t{i}") for i in range(20)], "id int, text string").coalesce(1)


def test_only_failed_rows_are_asked_again(spark, frame, tmp_path):
    log = str(tmp_path / "calls")

    def make():
        def client(table, problems):
            with open(log, "a") as f:
                f.write(f"{table.num_rows}\n")
            return [ValueError("later") if i % 5 == 0 and p is None else {"score": i} for i, p in zip(table["id"].to_pylist(), problems)]
        return client

    got = {r.id: (r.answer, r.attempts, r.problem) for r in SC.score_batches(frame, make, inputs=["id"]).collect()}
    assert got[1] == ('{"score": 1}', 1, None) and got[5] == ('{"score": 5}', 2, None)
    assert open(log).read().split() == ["20", "4"]


def test_a_raising_call_is_halved(frame):
    def make():
        def client(table, problems):
            ids = table["id"].to_pylist()
            if 7 in ids:
                raise TimeoutError("seven")
            return [{"n": len(ids)}] * len(ids) if 3 not in ids or len(ids) > 1 else [object()]
        return client

    got = {r.id: (r.answer, r.attempts, r.problem) for r in SC.score_batches(frame, make, tries=2).collect()}
    assert got[7] == (None, 2, "TimeoutError: seven") and all(got[i][0] is not None and got[i][1] == 1 for i in got if i != 7)


def test_wrong_number_of_answers_and_contracts(frame):
    got = SC.score_batches(frame, lambda: lambda table, problems: [{}], tries=1).collect()
    assert all(r.answer == "{}" and r.problem is None for r in got)  # halved until one answer fits one row
    bad = SC.score_batches(frame, lambda: lambda table, problems: [{"score": 99, "reason": "", "focal_hint": "left"}] * table.num_rows, "match").collect()
    assert all(r.answer is None and r.problem == "score: out of range" for r in bad)
    with pytest.raises(ValueError):
        SC.score_batches(frame, lambda: None, "nothing")


def test_row_clients(frame):
    def make():
        def one(row, problem):
            if row["id"] == 2:
                raise KeyError("x")
            return row["text"]
        return one

    got = {r.id: (r.answer, r.attempts) for r in SC.score_with(frame, make, tries=3).collect()}
    assert got[1] == ('"t1"', 1) and got[2] == (None, 3)
