"""Scoring rows with a caller's function, in batches, inside Spark tasks."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.functions.structured import CONTRACTS, contract_problems


def score_batches(df: DataFrame, make: Callable[[], Callable[[pa.Table, list[str | None]], list]], contract: str | None = None,
                  tries: int = 3, inputs: list[str] | None = None) -> DataFrame:
    """Adds ``answer`` (JSON text or NULL), ``attempts`` and ``problem``; the client answers whole batches.

    ``make`` builds the client once per task. It gets an Arrow table of ``inputs`` and the previous problem of each
    row, and returns an answer for each; an exception in an answer's place, or one that is no JSON, fails that row, and
    only failed rows are asked again. A call that raises is repeated in halves, so a row that no call survives costs the
    others nothing. After ``tries`` the answer is NULL: no judgement is never a pass. With a contract, an answer that
    breaks it is NULL as well.
    """
    if contract is not None and contract not in CONTRACTS:
        raise ValueError(f"unknown contract {contract}")
    cols = inputs or df.columns
    schema = T.StructType([*df.schema.fields, T.StructField("answer", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("problem", T.StringType())])

    def ask(client, table, problems):
        try:
            got = list(client(table, problems))
            if len(got) != table.num_rows:
                raise ValueError(f"{len(got)} answers for {table.num_rows} rows")
            return got
        except Exception as e:  # noqa: BLE001 - becomes the rows' problem
            half = table.num_rows // 2
            if not half:
                return [e] * table.num_rows
            return ask(client, table.slice(0, half), problems[:half]) + ask(client, table.slice(half), problems[half:])

    def run(batches):
        client = make()
        for batch in batches:
            table = pa.Table.from_batches([batch]).select(cols)
            answers, problems = [None] * batch.num_rows, [None] * batch.num_rows
            counts, open_ = [0] * batch.num_rows, list(range(batch.num_rows))
            for _ in range(tries):
                if not open_:
                    break
                failed = []
                for i, got in zip(open_, ask(client, table.take(open_), [problems[i] for i in open_]), strict=True):
                    counts[i] += 1
                    try:
                        if isinstance(got, Exception):
                            raise got
                        answers[i], problems[i] = json.dumps(got, ensure_ascii=False), None
                    except Exception as e:  # noqa: BLE001
                        problems[i] = f"{type(e).__name__}: {e}"
                        failed.append(i)
                open_ = failed
            made = [pa.array(answers, pa.string()), pa.array(counts, pa.int32()), pa.array(problems, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "answer", "attempts", "problem"])

    out = df.mapInArrow(run, schema)
    if contract is None:
        return out
    bad = F.concat_ws("; ", contract_problems("answer", contract))
    out = out.withColumn("problem", F.when(F.col("answer").isNotNull() & (bad != ""), bad).otherwise(F.col("problem")))
    return out.withColumn("answer", F.when(F.col("problem").isNull(), F.col("answer")))


def score_with(df: DataFrame, make: Callable[[], Callable[[dict, str | None], object]], contract: str | None = None,
               tries: int = 3, inputs: list[str] | None = None) -> DataFrame:
    """``score_batches`` for a client that takes one row (a dict of ``inputs``) and its previous problem at a time."""
    def make_batch():
        client = make()

        def one(row, problem):
            try:
                return client(row, problem)
            except Exception as e:  # noqa: BLE001
                return e

        return lambda table, problems: [one(r, p) for r, p in zip(table.to_pylist(), problems, strict=True)]

    return score_batches(df, make_batch, contract, tries, inputs)


def clamp(df: DataFrame, column: str, lo: float, hi: float, default: float | None = None) -> DataFrame:
    """Numbers into [lo, hi]; what is no number becomes ``default``."""
    v = F.col(column).try_cast("double")
    return df.withColumn(column, F.coalesce(F.greatest(F.lit(lo), F.least(F.lit(hi), v)), F.lit(default).cast("double")) if default is not None
                         else F.when(v.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), v))))
