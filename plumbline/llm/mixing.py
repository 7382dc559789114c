"""Mixing sources to target weights: fixed-length blocks, drawn per output shard by permuted index. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.session import cut

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Above this many sources their table is joined, not broadcast.
BROADCAST_SOURCES = 1 << 16


def permuted(x: Column, n: Column, seed: Column, rounds: int = 16) -> Column:
    """A pseudorandom bijection on [0, n): per round a point swaps with its mirror image or stays, by one hashed bit of the pair."""
    def swap(y: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(seed, r), n) - y, n)
        return F.when(F.xxhash64(seed, r, F.greatest(y, mirror)).bitwiseAND(F.lit(1).cast("long")) == 1, mirror).otherwise(y)

    return F.aggregate(F.array(*(F.lit(r) for r in range(rounds))), x.cast("long"), swap)


def plan_sources(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, epochs: int = 2, block: int = 64) -> DataFrame:
    """Per source: sid (1 on), source_size, target, blocks, slots, first_slot, all_slots.

    Sources stand in code-point order, NULL last, and take ``weights`` in turn. A target ends at ``epochs`` times its
    source; what is above goes to the others by weight until none is above: with sources ordered by cap per weight
    that is one level, found with running sums.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("sid", F.row_number().over(order))
    s = s.withColumn("w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("sid") - 1) % len(weights) + 1)).withColumn("cap", F.col("source_size") * float(epochs))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    every = Window.partitionBy(F.lit(0))
    before = F.sum("cap").over(by_ratio) - F.col("cap")
    rest = F.sum("w").over(every) - (F.sum("w").over(by_ratio) - F.col("w"))
    s = s.withColumn("level", (share * F.sum("source_size").over(every) - before) / rest)
    s = s.withColumn("level", F.max(F.when(F.col("cap") / F.col("w") > F.col("level"), F.col("level"))).over(every))
    s = s.withColumn("target", F.coalesce(F.least("cap", F.col("w") * F.col("level")), "cap"))
    s = s.withColumn("blocks", F.ceil(F.col("source_size") / block))
    s = s.withColumn("slots", F.when(F.col("source_size") > 0, F.least(F.col("blocks") * epochs, F.round(F.col("blocks") * F.col("target") / F.col("source_size")).cast("long"))).otherwise(F.lit(0).cast("long")))
    return s.withColumn("first_slot", F.sum("slots").over(Window.orderBy("sid")) - F.col("slots")).withColumn("all_slots", F.sum("slots").over(every)).drop("w", "cap", "level")


def _each(df: DataFrame, n: str, name: str, step: int = 1 << 14) -> DataFrame:
    """One row for each number below column ``n``, dealt out in pieces of ``step``."""
    pieces = df.where(F.col(n) > 0).withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / step))))
    at = F.col("__piece") * step
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows here, many after: not to be coalesced
    return pieces.repartition(tasks, *df.columns, "__piece").withColumn(name, F.explode(F.sequence(at, F.least(at + step, F.col(n)) - 1))).drop("__piece")


def draw(sources: DataFrame, seed: int = 7, shard_slots: int = 1 << 13) -> DataFrame:
    """The mixture's slots: (sid, shard, block, epoch), one row for each block that an output shard takes.

    All slots are dealt to shards by one pseudorandom permutation, which gives each shard multinomial source counts
    under the condition that the totals are the targets. The slots of a source, counted over shards in order, run
    through the source's own permutation of block indexes once per epoch, so no block comes again before all came.
    """
    dealt = _each(sources.select("sid", "slots", "first_slot", "all_slots"), "slots", "k")
    shard = F.floor(permuted(F.col("first_slot") + F.col("k"), F.col("all_slots"), F.lit(seed)) / shard_slots)
    counts = dealt.select("sid", shard.alias("shard")).groupBy("sid", "shard").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("from", F.sum("n").over(Window.partitionBy("sid").orderBy("shard")) - F.col("n"))
    known = sources.select("sid", "blocks")
    slots = _each(_with(counts, known), "n", "j")
    k = F.col("from") + F.col("j")
    epoch = F.floor(k / F.col("blocks"))
    return slots.select("sid", "shard", epoch.alias("epoch"), permuted(F.pmod(k, F.col("blocks")), F.col("blocks"), F.xxhash64(F.lit(seed), "sid", epoch)).alias("block"))


def _with(df: DataFrame, sources: DataFrame, null_safe: bool = False) -> DataFrame:
    """Join the table of sources; broadcast below BROADCAST_SOURCES rows, by shuffle above."""
    few = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    small = F.broadcast(sources) if few else sources
    return df.join(small.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source") if null_safe else df.join(small, "sid")


def _placed(sized: DataFrame) -> DataFrame:
    """``sized`` with ``off``: the words before a row in its source.

    The order is by two hashed digits, then by row; running sums of three levels keep every window small, also in a
    source that holds a third of all rows.
    """
    h = F.xxhash64("doc_id", "tie")
    rows = sized.withColumns({"b1": F.pmod(h, F.lit(256)), "b2": F.pmod(F.shiftright(h, 8), F.lit(256))})
    low = rows.groupBy("sid", "b1", "b2").agg(F.sum("size").alias("n"))
    high = low.groupBy("sid", "b1").agg(F.sum("n").alias("n1"))
    high = high.select("sid", "b1", (F.sum("n1").over(Window.partitionBy("sid").orderBy("b1")) - F.col("n1")).alias("o1"))
    low = low.select("sid", "b1", "b2", (F.sum("n").over(Window.partitionBy("sid", "b1").orderBy("b2")) - F.col("n")).alias("o2")).join(high, ["sid", "b1"])
    own = F.sum("size").over(Window.partitionBy("sid", "b1", "b2").orderBy("doc_id", "tie", "rid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    return rows.withColumn("o3", own).join(low, ["sid", "b1", "b2"]).withColumn("off", F.col("o1") + F.col("o2") + F.col("o3")).drop("b1", "b2", "o1", "o2", "o3", "tie")


def _sizes(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, source, size, tie); rid only parts rows that are equal in all else."""
    return docs.select("rid", "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64("text").alias("tie"))


def _taken(docs: DataFrame, seed: int, block: int, **plan) -> tuple[DataFrame, DataFrame]:
    """(rows of the documents cut at block borders with the times each piece is drawn, the sources)."""
    sized = cut(_sizes(docs), "mix-sizes")
    sources = cut(plan_sources(sized, block=block, **plan), "mix-sources")
    placed = _placed(_with(sized, sources.select("source", "sid", "source_size", "target"), null_safe=True))
    last = F.greatest(F.col("off") + F.col("size") - 1, F.col("off"))
    pieces = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("off") / block), F.floor(last / block))))
    at = F.greatest(F.col("block") * block, "off")
    pieces = pieces.withColumns({"at": at - F.col("off"), "words": F.greatest(F.least((F.col("block") + 1) * block, F.col("off") + F.col("size")) - at, F.lit(0).cast("long"))})
    draws = draw(sources, seed).groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
    return pieces.join(draws, ["sid", "block"], "left").withColumn("times", F.coalesce("times", F.lit(0).cast("long"))), sources


def mix_counts(docs: DataFrame, seed: int = 7, block: int = 64, **plan) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken (words the mixture takes of it, repeats counted).

    NULL and empty texts have size 0 and give nothing; NULL sources are one source; repeated rows count each.
    """
    pieces, _ = _taken(docs.select("doc_id", "source", "text").withColumn("rid", F.lit(0)), seed, block, **plan)
    keys = ["doc_id", "sid", "off", "size", "source_size", "target", "own"]
    own = F.when(F.col("size") == 0, F.monotonically_increasing_id())  # empty rows are one piece each and do not move off
    return pieces.withColumn("own", own).groupBy(*keys).agg(F.sum(F.col("words") * F.col("times")).alias("taken")).select("doc_id", "size", "source_size", "target", "taken")


def mix(docs: DataFrame, seed: int = 7, block: int = 64, **plan) -> DataFrame:
    """The mixture as documents: a row per document and epoch with the words that its blocks bring, all columns kept.

    A text taken whole stays as it is; of a text taken in part the taken words stand in order, one space between;
    ``n_chars``, where it is a column, follows the text. Rows of which nothing is taken go. Names with ``__`` are reserved.
    """
    kept = cut(docs.withColumn("__rid", F.monotonically_increasing_id()), "mix-rows", "zstd")
    pieces, _ = _taken(kept.select("doc_id", "source", "text", F.col("__rid").alias("rid")), seed, block, **plan)
    pieces = pieces.where("times > 0 and words > 0").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("at", "words", "times"))).alias("__p"), F.max("times").alias("__n"), F.first("size").alias("__size"))
    rows = kept.join(pieces.withColumnRenamed("rid", "__rid").hint("merge"), "__rid").withColumn("__e", F.explode(F.sequence(F.lit(1).cast("long"), "__n")))
    mine = F.filter("__p", lambda p: p.times >= F.col("__e"))
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    part = F.concat_ws(" ", F.flatten(F.transform(mine, lambda p: F.slice(F.col("__w"), (p["at"] + 1).cast("int"), p.words.cast("int")))))
    whole = F.aggregate(mine, F.lit(0).cast("long"), lambda acc, p: acc + p.words) == F.col("__size")
    rows = rows.withColumn("__whole", whole).withColumn("__w", F.when(~F.col("__whole"), words))
    rows = rows.withColumn("text", F.when(F.col("__whole"), F.col("text")).otherwise(part))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))
