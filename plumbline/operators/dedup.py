"""Greedy near-duplicate removal over 64-bit perceptual hashes."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import constants as K
from plumbline.session import cut, large

#: Rows of one bucket that are compared with each other at a time; a larger bucket is settled from its start.
BUCKET = 512


def _bands(max_dist: int, agree: int) -> list[tuple[int, int]]:
    """(shift, mask) of the bands that the 64 bits are cut into."""
    n = max_dist + agree
    edges = [round(i * 64 / n) for i in range(n + 1)]
    return [(lo, (1 << (hi - lo)) - 1) for lo, hi in zip(edges, edges[1:])]


def keyed(hashes: DataFrame, max_dist: int, agree: int) -> DataFrame:
    """A row for each key: hashes within ``max_dist`` share one at least.

    So many flips leave at least ``agree`` of the bands untouched; every choice of ``agree`` bands is a key, with its
    bits as they are. ``_last`` is the key's last band.
    """
    bands = [F.shiftrightunsigned("h", lo).bitwiseAND(F.lit(mask)) for lo, mask in _bands(max_dist, agree)]
    keys = [F.struct(F.lit(i).alias("pick"), F.array(*[bands[b] for b in picks]).alias("bits"), F.lit(picks[-1]).alias("last"))
            for i, picks in enumerate(combinations(range(len(bands)), agree))]
    return hashes.select("run_id", "ord", "h", F.explode(F.array(*keys)).alias("_k")).select("run_id", "ord", "h", F.struct("_k.pick", "_k.bits").alias("_k"), F.col("_k.last").alias("_last"))


def _near(a: Column, b: Column, last: Column, max_dist: int, agree: int) -> Column:
    """Within the distance, and met at the first key that the two share: before its last band only its own agree."""
    x = a.bitwiseXOR(b)
    same = [F.when((F.shiftrightunsigned(x, lo).bitwiseAND(F.lit(mask)) == 0) & (F.lit(i) < last), 1).otherwise(0) for i, (lo, mask) in enumerate(_bands(max_dist, agree))]
    return (F.bit_count(x) <= max_dist) & (reduce(lambda p, q: p + q, same) == agree - 1)


def near_pairs(hashes: DataFrame, max_dist: int = K.NEAR_DUP_BITS, agree: int = 2) -> DataFrame:
    """(run_id, a, b): pairs of *distinct* hashes within ``max_dist``, a before b, each made once."""
    rows = keyed(hashes, max_dist, agree)
    a = rows.select("run_id", "_k", "_last", F.col("ord").alias("a"), F.col("h").alias("_ha"))
    b = rows.select("run_id", "_k", F.col("ord").alias("b"), F.col("h").alias("_hb"))
    return a.join(large(b), ["run_id", "_k"]).where((F.col("a") < F.col("b")) & _near(F.col("_ha"), F.col("_hb"), F.col("_last"), max_dist, agree)).select("run_id", "a", "b")


def _settle(edges: DataFrame) -> list[DataFrame]:
    """Which ends of ``edges`` the greedy rule drops, as one table for each round.

    Rows that are nobody's open later neighbour are kept and drop their later neighbours; only edges between open rows
    go on to the next round, so what is written shrinks, and a round that settles nothing is an error.
    """
    dropped = []
    edges = cut(edges, "near-edges")
    left = edges.count()
    while left:
        heads = edges.join(large(edges.select("run_id", F.col("b").alias("a")).distinct()), ["run_id", "a"], "left_anti")
        gone = cut(heads.select("run_id", F.col("b").alias("ord")).distinct(), "near-dropped")
        dropped.append(gone)
        edges = edges.join(large(gone.withColumnRenamed("ord", "b")), ["run_id", "b"], "left_anti").join(large(gone.withColumnRenamed("ord", "a")), ["run_id", "a"], "left_anti")
        edges = cut(edges.select("run_id", "a", "b"), "near-edges")
        before, left = left, edges.count()
        if left >= before:
            raise AssertionError("a round settled no pair")
    return dropped


def near_dup(hashes: DataFrame, max_dist: int = K.NEAR_DUP_BITS, agree: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(run_id, ord, is_dup): a row is a duplicate if it is near an *earlier kept* row of its run.

    Equal hashes need no pairs: only the first of them can be kept, so each distinct hash enters once and its copies
    are marked by a join. The distinct ones are settled from the start of each run, up to the point where some bucket
    has ``bucket`` rows; rows kept so far then drop what is near them in the rest, before that is compared with itself.
    So a hundred thousand alike hashes meet the few that are kept, not each other.
    """
    first = hashes.where("h IS NOT NULL").groupBy("run_id", "h").agg(F.min("ord").alias("ord"))
    open_ = cut(first.select("run_id", "ord", "h"), "near-open")
    dropped, waiting = [], True
    while waiting:
        rows = keyed(open_, max_dist, agree)
        hot = rows.groupBy("run_id", "_k").agg(F.count("*").alias("_n")).where(F.col("_n") > bucket).select("run_id", "_k")
        # the row after the first ``bucket`` of each hot bucket; every task drops the rows behind it before the shuffle
        nth = rows.join(large(hot), ["run_id", "_k"], "left_semi").withColumn("_r", F.row_number().over(Window.partitionBy("run_id", "_k").orderBy("ord"))).where(F.col("_r") <= bucket + 1)
        ends = cut(nth.where(F.col("_r") == bucket + 1).groupBy("run_id").agg(F.min("ord").alias("_end")), "near-ends")
        waiting = not ends.isEmpty()
        now = open_ if not waiting else cut(open_.join(large(ends), "run_id", "left").where(F.col("_end").isNull() | (F.col("ord") < F.col("_end"))).drop("_end"), "near-now")
        gone = _settle(near_pairs(now, max_dist, agree))
        dropped += gone
        if waiting:
            kept = now
            for g in gone:
                kept = kept.join(large(g), ["run_id", "ord"], "left_anti")
            rest = cut(open_.join(large(ends), "run_id").where(F.col("ord") >= F.col("_end")).drop("_end"), "near-rest")
            a = keyed(kept, max_dist, agree).select("run_id", "_k", "_last", F.col("h").alias("_ha"))
            met = keyed(rest, max_dist, agree).drop("_last").join(large(a), ["run_id", "_k"]).where(_near(F.col("_ha"), F.col("h"), F.col("_last"), max_dist, agree))
            dropped.append(cut(met.select("run_id", "ord").distinct(), "near-dropped"))
            open_ = cut(rest.join(large(dropped[-1]), ["run_id", "ord"], "left_anti"), "near-open")
    keep = first.select("run_id", "ord")
    if dropped:
        keep = keep.join(large(reduce(DataFrame.unionByName, dropped)), ["run_id", "ord"], "left_anti")
    out = hashes.join(large(keep.withColumn("_keep", F.lit(True))), ["run_id", "ord"], "left")
    return out.select(*hashes.columns, (F.col("h").isNotNull() & F.col("_keep").isNull()).alias("is_dup"))
