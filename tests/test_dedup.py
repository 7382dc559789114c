"""Greedy near duplicates: hot buckets are settled from their start, pairs are made once, rounds make progress."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import dedup as D

SCHEMA = "run_id bigint, ord bigint, h bigint"


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def greedy(rows, dist=8):
    kept, out = {}, {}
    for run, i, h in sorted(rows, key=lambda r: (r[0], r[1])):
        dup = h is not None and any(((h ^ k) & ((1 << 64) - 1)).bit_count() <= dist for k in kept.get(run, ()))
        if h is not None and not dup:
            kept.setdefault(run, []).append(h)
        out[run, i] = dup
    return out


def around(r, base, flips):
    for b in r.sample(range(64), flips):
        base ^= 1 << b
    return base


@pytest.mark.parametrize("bucket", [3, 40, 512])
def test_any_bucket_bound_gives_the_greedy_rule(spark, bucket):
    r = random.Random(bucket)
    base = [r.getrandbits(64) for _ in range(4)]
    rows = [(run, i, signed(around(r, r.choice(base), r.choice([0, 2, 4, 5, 8, 9, 14])))) for run in (1, 2) for i in range(70)] + [(1, 70, None), (3, 0, 5)]
    got = {(x.run_id, x.ord): x.is_dup for x in D.near_dup(spark.createDataFrame(rows, SCHEMA), bucket=bucket).collect()}
    assert got == greedy(rows)


def test_each_pair_is_made_once(spark):
    r = random.Random(9)
    base = r.getrandbits(64)
    hs = list({signed(around(r, base, r.randrange(0, 8))) for _ in range(120)})
    rows = [(1, i, h) for i, h in enumerate(hs)]
    got = [tuple(x) for x in D.near_pairs(spark.createDataFrame(rows, SCHEMA)).collect()]
    want = {(1, i, j) for j in range(len(hs)) for i in range(j) if ((hs[i] ^ hs[j]) & ((1 << 64) - 1)).bit_count() <= 8}
    assert len(got) == len(set(got)) and set(got) == want


def test_a_hundred_thousand_alike_hashes(spark):
    """All within four bits of one hash: the first drops the rest; no bucket is compared with itself as a whole."""
    bit = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(64)).cast("int")
    flip = lambda k: F.expr("shiftleft(1L, b%d)" % k)
    rows = spark.range(100_000, numPartitions=4).select("id", *[bit(k).alias(f"b{k}") for k in range(4)])
    h = F.lit(0x1234567812345678)
    for k in range(4):
        h = h.bitwiseXOR(flip(k))
    rows = rows.select(F.lit(1).cast("bigint").alias("run_id"), F.col("id").alias("ord"), F.when(F.col("id") == 0, F.lit(0x1234567812345678)).otherwise(h).alias("h"))
    assert D.near_dup(rows).where("NOT is_dup").select("ord").collect() == [(0,)]


def test_no_rows(spark):
    assert D.near_dup(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [x.is_dup for x in D.near_dup(spark.createDataFrame([(1, 0, None)], SCHEMA)).collect()] == [False]
