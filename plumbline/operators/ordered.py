"""Running values along an ordered key that survive a key holding most rows.

A plain window sorts a whole key in one task. Here each key is cut into blocks
by a monotone expression over its order; windows run inside (key, block), one
summary row per block carries totals and edge values across blocks, and the
join back is co-located with the block window, so rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.session import large

BLOCK_ROWS = 8192


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column] | None = None,
         previous: dict[str, Column] | None = None, following: dict[str, Column] | None = None,
         block: Column | None = None, first: dict[str, Column] | None = None) -> DataFrame:
    """Add exclusive running sums, values of the previous row and of the following row, and of the key's first row.

    Keys must not be NULL (that fails loudly). ``order`` must be unique within a
    key. ``block`` must not decrease along it; by default it is the first order
    column divided by ``BLOCK_ROWS``.
    """
    sums, previous, following, first = sums or {}, previous or {}, following or {}, first or {}
    block = F.floor(F.col(order[0]) / BLOCK_ROWS) if block is None else block
    empty = F.col(keys[0]).isNull()
    for k in keys[1:]:
        empty = empty | F.col(k).isNull()
    rows = df.withColumn("_blk", F.when(empty, F.raise_error(F.lit("scan: a key is NULL"))).otherwise(block))
    inside = Window.partitionBy(*keys, "_blk").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    at = F.struct(*order)

    parts: list[Column] = []
    carried: list[Column] = []
    for n, e in sums.items():
        parts.append(F.sum(e).alias(f"_t_{n}"))
    for n, e in previous.items():
        parts.append(F.max_by(F.struct(e.alias("v")), at).alias(f"_l_{n}"))
    for n, e in following.items():
        parts.append(F.min_by(F.struct(e.alias("v")), at).alias(f"_f_{n}"))
    for n, e in first.items():
        parts.append(F.min_by(F.struct(e.alias("v")), F.when(F.col(order[0]).isNotNull(), at)).alias(f"_h_{n}"))
    blocks = rows.groupBy(*keys, "_blk").agg(*parts)
    across = Window.partitionBy(*keys).orderBy("_blk")
    for n in sums:
        carried.append(F.coalesce(F.sum(f"_t_{n}").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_t_{n}"))
    for n in previous:
        carried.append(F.lag(f"_l_{n}").over(across).alias(f"_l_{n}"))
    for n in following:
        carried.append(F.lead(f"_f_{n}").over(across).alias(f"_f_{n}"))
    for n in first:
        carried.append(F.first(f"_h_{n}", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"_h_{n}"))
    blocks = blocks.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_blk").alias("_k_blk"), *carried)

    for n, e in sums.items():
        rows = rows.withColumn(f"_s_{n}", F.coalesce(F.sum(e).over(before), F.lit(0)))
    for n, e in previous.items():
        rows = rows.withColumn(f"_p_{n}", F.lag(F.struct(e.alias("v"))).over(inside))
    for n, e in following.items():
        rows = rows.withColumn(f"_n_{n}", F.lead(F.struct(e.alias("v"))).over(inside))
    # plain equality on the window's own keys: the big side is joined where it already lies, in its order
    on = [rows[k] == blocks[f"_k_{k}"] for k in keys] + [rows["_blk"] == blocks["_k_blk"]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    out = rows.join(large(blocks), cond)
    return out.select(
        *[c for c in df.columns if c not in {*sums, *previous, *following, *first}],
        *[(F.col(f"_s_{n}") + F.col(f"_t_{n}")).alias(n) for n in sums],
        *[F.coalesce(f"_p_{n}", f"_l_{n}")["v"].alias(n) for n in previous],
        *[F.coalesce(f"_n_{n}", f"_f_{n}")["v"].alias(n) for n in following],
        *[F.col(f"_h_{n}")["v"].alias(n) for n in first])


def running_smallest(df: DataFrame, key: str, order: str, tokens: str, k: int, out: str, fan: int = 256, levels: int = 3) -> DataFrame:
    """Per row, the ``k`` smallest distinct tokens of its key up to and including the row.

    Only ``k`` tokens per row or block can matter, so every level of the block
    tree carries lists of at most ``fan * k`` tokens. ``order`` is dense from 0.
    """
    def least(arrays):
        return F.slice(F.sort_array(F.array_distinct(F.flatten(arrays))), 1, k)

    b, upto = f"_b{levels}", f"_upto{levels}"  # own names per level: blocks of one level are rows of the next
    rows = df.withColumn("_mine", F.slice(F.sort_array(F.array_distinct(tokens)), 1, k)).withColumn(b, F.floor(F.col(order) / fan))
    w = Window.partitionBy(key, b).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_in", least(F.collect_list("_mine").over(w)))
    blocks = rows.groupBy(key, b).agg(least(F.collect_list("_mine")).alias(f"_all{levels}"))
    if levels > 1:
        done = running_smallest(blocks, key, b, f"_all{levels}", k, upto, fan, levels - 1)
    else:
        top = Window.partitionBy(key).orderBy(b).rowsBetween(Window.unboundedPreceding, 0)
        done = blocks.withColumn(upto, least(F.collect_list(f"_all{levels}").over(top)))
    # ``order`` is dense from 0, so the block before a row's block always exists, except for the first
    prior = done.select(F.col(key).alias("_k"), (F.col(b) + 1).alias("_kb"), upto)
    joined = rows.join(large(prior), (rows[key] == prior["_k"]) & (rows[b] == prior["_kb"]), "left")
    return joined.withColumn(out, F.when(F.col(upto).isNull(), F.col("_in")).otherwise(least(F.array("_in", upto)))).select(*df.columns, out)
