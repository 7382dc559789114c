"""Shared tokens between two tables: exact counts through posting lists, and the best partner by score bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.session import cut

#: Left rows in one posting list at most, a power of two; a right row's counters hold that many numbers.
CHUNK = 1024


class _Count:
    """Rows (right, chunk, numbers of left rows) in order -> pairs that share at least ``least`` tokens."""

    def __init__(self, least: int):
        self.least = least

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, counts = None, np.zeros(CHUNK, np.int64)

        def flush() -> pa.RecordBatch:
            at = np.flatnonzero(counts >= self.least)
            made = [np.full(len(at), key[0]), np.full(len(at), key[1]) * CHUNK + at, counts[at]]
            counts.fill(0)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in made], names=["_r", "_l", "overlap"])

        for b in batches:
            right, chunk, lists = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2)
            at, numbers = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
            starts = np.flatnonzero(np.r_[True, (right[1:] != right[:-1]) | (chunk[1:] != chunk[:-1])]) if len(right) else np.zeros(0, int)
            for s, e in zip(starts, np.r_[starts[1:], len(right)], strict=True):
                if key is not None and key != (right[s], chunk[s]):
                    yield flush()
                key = (right[s], chunk[s])
                np.add.at(counts, numbers[at[s]:at[e]], 1)
        if key is not None:
            yield flush()


def postings(rows: DataFrame, number: str, tokens: str) -> DataFrame:
    """(token, chunk, numbers): for each token and chunk of rows, which rows of the chunk hold it."""
    each = rows.select(F.shiftright(number, CHUNK.bit_length() - 1).alias("_chunk"), F.col(number).bitwiseAND(F.lit(CHUNK - 1).cast("long")).cast("int").alias("_n"), F.explode(F.array_distinct(tokens)).alias("_tok"))
    return each.groupBy("_tok", "_chunk").agg(F.collect_list("_n").alias("_list"))


def shared_counts(left: DataFrame, right: DataFrame, left_key: str, right_key: str, tokens: tuple[str, str], least: int = 1) -> DataFrame:
    """(left_key, right_key, overlap): every pair with at least ``least`` distinct tokens in common. Keys are unique.

    The left side becomes posting lists, so a right row is joined once for each of its tokens (and chunk of left rows)
    and not once for each pair; what it meets is counted side by side in one array, and only true pairs are made. The
    lists of a hot token are many short rows; its rows of the right side are an ordinary join that AQE splits.
    """
    l = cut(left.select(left_key, tokens[0], F.monotonically_increasing_id().alias("_l")), "overlap-left")
    r = cut(right.select(right_key, tokens[1], F.monotonically_increasing_id().alias("_r")), "overlap-right")
    lists = cut(postings(l, "_l", tokens[0]), "postings")  # its size is known then: small lists are broadcast, and no token is shuffled
    met = r.select("_r", F.explode(F.array_distinct(tokens[1])).alias("_tok")).join(lists, "_tok")
    counted = met.select("_r", "_chunk", "_list").repartition("_r", "_chunk").sortWithinPartitions("_r", "_chunk").mapInArrow(_Count(least), "_r long, _l long, overlap long")
    return counted.join(r.select("_r", right_key), "_r").join(l.select("_l", left_key), "_l").select(left_key, right_key, "overlap")


def best_partner(queries: DataFrame, items: DataFrame, near: int, bonus: Column, most_bonus: Column, least: int, common: int = 64) -> DataFrame:
    """(category, kind, tokens, id, score): the best item of each distinct query, lowest id on ties.

    ``queries``: category, kind, tokens. ``items``: id, categories, bag (array of token and weight), flags (a struct).
    Score: ``near`` if the query's category is among the item's, plus the weights of the shared tokens, plus ``bonus``
    (a column over kind and flags, ``most_bonus`` being the most that a kind can get). At least ``least``.

    Only what can win is paired, and no table is joined to another by category or by a frequent token alone:

    * equal queries, and equal items, are one row each;
    * items without a shared token: the lowest id for each category and flags stands for all of them;
    * items that share a token held by at most ``common`` items: through that token, scored on their whole bags;
    * all others share frequent tokens only, so items with the same frequent tokens, category and flags are one class
      whose lowest id wins. Classes of other categories must beat what the query already has; with ``near`` missing they
      need several tokens for that, so the query's most frequent ones need not be looked up.
    """
    found = candidates(queries, items, near, bonus, most_bonus, least, common)
    often = found["floor"].unionByName(found["near"]).unionByName(found["far"])
    classes, plain = found["classes"], found["plain"]
    best = _best(often, "cid").join(classes, "cid").select("category", "kind", "seeks", "id", "score")
    best = plain.join(best, (plain["kind"] == best["kind"]) & (plain["seeks"] == best["seeks"]) & plain["category"].eqNullSafe(best["category"])).select("qid", "id", "score")
    best = _best(best.unionByName(found["rare"]).where(F.col("score") >= least), "qid")
    return best.join(found["queries"], "qid").select("category", "kind", "tokens", "id", "score")


def candidates(queries: DataFrame, items: DataFrame, near: int, bonus: Column, most_bonus: Column, least: int, common: int) -> dict[str, DataFrame]:
    """The scored pairs of ``best_partner``: rare (qid, id), floor, near and far (cid, id), and whose classes they are."""
    q = cut(queries.select("category", "kind", "tokens").distinct().withColumn("qid", F.monotonically_increasing_id()), "best-queries")
    x = cut(items.groupBy(F.array_sort("categories").alias("categories"), F.array_sort("bag").alias("bag"), "flags").agg(F.min("id").alias("id")), "best-items")
    in_items = x.select("id", F.explode("bag").alias("b")).select("id", "b.token", "b.weight")
    in_queries = q.select("qid", F.explode("tokens").alias("token"))
    seen = in_items.groupBy("token").agg(F.count("*").alias("n"), F.max("weight").alias("most")).join(in_queries.select("token").distinct(), "token", "left_semi")
    seen = cut(seen, "best-tokens")
    in_items, in_queries = in_items.join(seen, "token"), in_queries.join(seen, "token")
    whole = lambda bag, tokens, more: F.aggregate(F.filter(bag, lambda b: F.array_contains(tokens, b["token"])), F.lit(0).cast("bigint"), lambda a, b: a + b["weight"]) + bonus + more

    rare = in_queries.where(F.col("n") <= common).select("qid", "token").join(in_items.where(F.col("n") <= common).select("id", "token"), "token").select("qid", "id").distinct()
    inside = F.when(F.array_contains("categories", F.col("category")), near).otherwise(0)
    rare = rare.join(q, "qid").join(x, "id").select("qid", "id", whole(F.col("bag"), F.col("tokens"), inside).alias("score"))

    none = lambda c: F.array().cast(f"array<struct<n:bigint,token:string,{c}:bigint>>")
    often = in_items.where(F.col("n") > common).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "token", "weight"))).alias("often"))  # rarest first
    bags = x.join(often, "id", "left").select("id", "flags", "categories", F.coalesce("often", none("weight")).alias("often"))
    seeks = in_queries.where(F.col("n") > common).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("n", "token", "most"))).alias("seeks"))
    plain = cut(q.join(seeks, "qid", "left").select("qid", "category", "kind", F.coalesce("seeks", none("most")).alias("seeks")), "best-plain")
    classes = plain.groupBy("category", "kind", "seeks").agg(F.min("qid").alias("cid"))

    here = bags.select("id", "flags", "often", F.explode("categories").alias("category"))
    first = here.groupBy("category", "flags").agg(F.min("id").alias("id"))
    anywhere = bags.groupBy("flags").agg(F.min("id").alias("id")).crossJoin(q.select("kind").distinct())  # kinds x flags: a few rows
    anywhere = anywhere.select("kind", "id", bonus.cast("bigint").alias("score")).where(F.col("score") >= least)
    floor = classes.join(first, "category").select("cid", "id", (F.lit(near) + bonus).cast("bigint").alias("score"))
    floor = cut(_best(floor.unionByName(classes.join(_best(anywhere, "kind"), "kind").select("cid", "id", "score")), "cid"), "best-floor")
    classes = cut(classes.join(floor.select("cid", F.col("score").alias("have")), "cid", "left"), "best-classes")

    word = lambda c: F.transform(c, lambda t: t["token"])
    same = here.where(F.size("often") > 0).groupBy("category", "flags", "often").agg(F.min("id").alias("id"))
    other = bags.where(F.size("often") > 0).groupBy("flags", "often").agg(F.min("id").alias("id"))
    by_token = lambda df, c: df.withColumn("token", F.explode(word(c)))
    # a pair is made by the rarest token that it shares, and by no other
    meet = F.get(F.filter(word("seeks"), lambda t: F.array_contains(word("often"), t)), F.lit(0)) == F.col("token")
    near_pairs = by_token(classes, "seeks").join(by_token(same, "often"), ["category", "token"]).where(meet)
    # tokens from the rarest on until what is left cannot reach the score that the query has
    rest = lambda i: F.aggregate(F.slice("seeks", i + 1, F.size("seeks")), F.lit(0).cast("bigint"), lambda a, s: a + s["most"])
    useful = F.filter("seeks", lambda t, i: rest(i) + most_bonus >= F.greatest(F.coalesce("have", F.lit(0)), F.lit(least)))
    far_pairs = by_token(classes.withColumn("useful", useful), "useful").join(by_token(other, "often"), "token").where(meet)
    scored = lambda p, more: p.select("cid", "id", whole(F.col("often"), word("seeks"), F.lit(more)).alias("score"))
    return {"queries": q, "plain": plain, "classes": classes, "rare": rare, "floor": floor, "near": scored(near_pairs, near), "far": scored(far_pairs, 0)}


def _best(scored: DataFrame, key: str) -> DataFrame:
    won = scored.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("neg"), "id")).alias("b"))
    return won.select(key, F.col("b")["id"].alias("id"), (-F.col("b")["neg"]).alias("score"))
