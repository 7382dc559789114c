"""The trie of conversation prefixes, by ROLLUP over positional turn columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.operators import ordered
from plumbline.session import cut

#: Turn columns of one row. A longer conversation has further rows, keyed by the node that the row before ends in.
WIDTH = 4
#: A node is named by its depth and four sums of 32-bit parts of SHA-256 over (position, turn): no sum leaves 64 bits.
LANES = ["l0", "l1", "l2", "l3"]
NODE = ["depth", *LANES]


def positions(convs: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), digest, words: the turns of each conversation by turn, NULL first, equal turns by digest.

    NULL role or text is the empty one; rows without conv_id are no conversation's and take no part. Rows are ordered
    by one range shuffle without their texts, so a conversation with a third of all rows lies in many tasks, and what
    precedes a task's rows is a running count over tasks.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = convs.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.size(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))).cast("long").alias("words"))
    order = ["conv_id", "turn", "digest"]
    rows = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "words", F.monotonically_increasing_id().alias("at")), "turns")
    return ordered.scan(rows, ["conv_id"], ["at"], sums={"pos": F.lit(1)}, block=F.shiftright("at", 33)).select("conv_id", F.col("pos").cast("long").alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """Each conversation c begins with the first h turns of c - c % ``group``, h = crc32(decimal c) % ``heads``; its own after its first h follow.

    Every conversation has a row, a turnless one a row with NULL digest. Only the first ``heads - 1`` turns of the
    base conversations are joined, at most ``group`` conversations to each.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("long")
    first = turns.where((F.col("conv_id") % group == 0) & (F.col("pos") < heads - 1)).groupBy(F.col("conv_id").alias("base"))
    first = first.agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
    own = turns.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group}).join(first, "base", "left")
    none = F.array().cast("array<struct<pos:bigint,digest:string,words:bigint>>")
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h").cast("int"))
    start = F.concat(head, F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("words"))))
    mine = F.array(F.struct((F.col("pos") - F.col("h") + F.size(head)).alias("pos"), "digest", "words"))
    made = F.concat(F.when(F.col("pos") == 0, start).otherwise(none), F.when(F.col("pos") >= F.col("h"), mine).otherwise(none))
    return own.select("conv_id", F.explode(made).alias("t")).select("conv_id", "t.*")


def blocks(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """conv_id, prior (the node that the block before ends in), t0 .. (turn ids), filled, more (whether a block follows)."""
    salted = F.sha2(F.concat_ws(":", F.col("pos").cast("string"), "digest"), 256)
    parts = [F.when(F.col("digest").isNotNull(), F.conv(F.substring(salted, 8 * k + 1, 8), 16, 10).cast("long")).alias(c) for k, c in enumerate(LANES)]
    ids = turns.select("conv_id", F.floor(F.col("pos") / width).alias("block"), (F.col("pos") % width).alias("j"), *parts, "words")
    at = lambda j, c: F.max(F.when((F.col("j") == j) & F.col("l0").isNotNull(), F.col(c)))
    wide = ids.groupBy("conv_id", "block").agg(*[at(j, c).alias(f"{c}_{j}") for j in range(width) for c in [*LANES, "words"]])
    ts = [F.when(F.col(f"l0_{j}").isNotNull(), F.struct(*[F.col(f"{c}_{j}").alias(c) for c in [*LANES, "words"]])).alias(f"t{j}") for j in range(width)]
    wide = wide.select("conv_id", "block", *ts)
    done = ordered.scan(wide, ["conv_id"], ["block"], sums={c: _sum(c, width) for c in [*LANES, "words"]}, following={"next": F.lit(1)})
    prior = F.struct("block", *LANES, "words").alias("prior")
    return done.select("conv_id", prior, *[f"t{j}" for j in range(width)], sum(F.col(f"t{j}").isNotNull().cast("int") for j in range(width)).alias("filled"), F.col("next").isNotNull().alias("more"))


def _sum(c: str, width: int) -> Column:
    """Lane ``c``, or the words, of all turn columns that are there."""
    return sum((F.coalesce(F.col(f"t{j}.{c}"), F.lit(0)) for j in range(width)), F.lit(0).cast("long"))


def _nodes(rows: DataFrame, aggregates: str, width: int) -> DataFrame:
    """One ROLLUP: every prefix of the turn columns below its prior node, with ``aggregates`` over its members.

    A row's grouping ids past its own end have a NULL in their last column: they name no node and go. Columns that are
    rolled up are NULL, so a node's sums run over all columns.
    """
    ts = [f"t{j}" for j in range(width)]
    sql = f"SELECT prior, {', '.join(ts)}, grouping_id() AS gid, {aggregates} FROM {{rows}} GROUP BY prior, ROLLUP ({', '.join(ts)})"
    made = rows.sparkSession.sql(sql, rows=rows)
    level = sum(F.when(F.col("gid") < (1 << j), 1).otherwise(0) for j in range(width))
    there = sum(F.col(t).isNotNull().cast("int") for t in ts)
    made = made.withColumn("level", level).where((there == F.col("level")) & ((F.col("level") > 0) | (F.col("prior.block") == 0)))
    last = F.coalesce(*[F.col(t) for t in reversed(ts)])
    upto = {c: F.col(f"prior.{c}") + _sum(c, width) for c in [*LANES, "words"]}
    before = {c: e - F.coalesce(last[c], F.lit(0)) for c, e in upto.items()}
    rest = [c for c in made.columns if c not in ("prior", *ts, "gid")]
    return made.select((F.col("prior.block") * width + F.col("level")).alias("depth"), *[upto[c].alias(c) for c in LANES], *[before[c].alias(f"p{c}") for c in LANES], before["words"].alias("before"), *rest)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) -> (node, first, piece): ids of one node joined by commas, about 64 KB a piece."""
    key, ids, size, out = None, [], 0, []
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        for *k, conv in zip(*cols, strict=True):
            if ids and (k != key or size > 1 << 16):
                out.append((*key, ids[0], ",".join(map(str, ids))))
                ids, size = [], 0
            key = k
            ids.append(conv)
            size += 8
        yield _batch(out, ["first", "piece"])
        out = []
    if ids:
        yield _batch([(*key, ids[0], ",".join(map(str, ids)))], ["first", "piece"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each node in order -> SHA-256 of all of them, comma-joined, without holding more than one."""
    key, state, out = None, None, []
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        for *k, _, piece in zip(*cols, strict=True):
            if k == key:
                state.update(b",")
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(piece.encode())
        yield _batch(out, ["ends_sha256"])
        out = []
    if key is not None:
        yield _batch([(*key, state.hexdigest())], ["ends_sha256"])


def _batch(rows: list[tuple], more: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] * len(NODE) + [pa.int64() if c == "first" else pa.string() for c in more]
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds, strict=True)], names=[*NODE, *more])


def end_digests(rows: DataFrame, width: int) -> DataFrame:
    """Per node where conversations end: SHA-256 of their ids, ascending. However many end in one node, no task holds them."""
    ends = rows.where("not more").select((F.col("prior.block") * width + F.col("filled")).alias("depth"), *[(F.col(f"prior.{c}") + _sum(c, width)).alias(c) for c in LANES], "conv_id")
    by_id = [*NODE, "conv_id"]
    schema = ", ".join(f"{c} long" for c in NODE)
    pieces = ends.repartitionByRange(*by_id).sortWithinPartitions(*by_id).mapInArrow(_pieces, f"{schema}, first long, piece string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_digests, f"{schema}, ends_sha256 string")


def prefix_trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """Every distinct prefix of ``turns`` (conv_id, pos from 0, digest, words) as a node, the textless root included.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. A
    conversation without turns is a row with NULL digest; without any row there is no node, not even a root.

    The first ROLLUP tells for each conversation whether it is some node's smallest member, from which depth on, and
    whether a leaf is its. Words that its prefix shares with a smaller member are then one number per conversation, so
    sums over subtrees are sums over members: the second ROLLUP has them, and no walk over levels is needed.
    """
    rows = cut(blocks(turns, width), "prefix-rows")
    chain = _nodes(rows, "min(conv_id) AS conv_id, max(filled + int(more)) AS reach", width)
    chain = chain.groupBy("conv_id").agg(F.min("before").alias("shared"), F.max((F.col("reach") == F.col("level")).cast("long")).alias("leaf"))
    total = rows.groupBy("conv_id").agg(F.sum(_sum("words", width)).alias("total"))
    stats = total.join(chain, "conv_id", "left").select("conv_id", F.coalesce("shared", "total").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    sums = "min(conv_id) AS conv_id, count(*) AS n_convs, sum(leaf) AS n_leaves, sum(shared) AS shared, min_by(shared, conv_id) AS own"
    nodes = cut(_nodes(rows.join(stats, "conv_id"), sums, width), "prefix-nodes")

    parent = [F.col(c) for c in ["up", *[f"p{c}" for c in LANES]]]
    below = nodes.where("depth > 0").withColumn("up", F.col("depth") - 1)
    counts = below.groupBy(*[c.alias(n) for c, n in zip(parent, NODE, strict=True)]).agg(F.count("*").alias("n_children"))
    inner = nodes.select(*NODE, "conv_id").join(counts, NODE)
    above = inner.select(*[F.col(c).alias(f"p{c}" if c != "depth" else "up") for c in NODE], F.col("conv_id").alias("parent_conv_id"))
    out = nodes.withColumn("up", F.col("depth") - 1).join(inner.drop("conv_id"), NODE, "left").join(above, ["up", *[f"p{c}" for c in LANES]], "left").join(end_digests(rows, width), NODE, "left")
    saved = F.col("shared") - F.col("own") - (F.col("n_convs") - 1) * F.col("before")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
                      saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def trie_digest(convs: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt conversations.

    ``convs`` (conv_id, turn, role, text; more columns are ignored): NULL conv_id takes no part, NULL turn comes
    first, NULL role or text is empty, equal turns follow in the order of their digests, repeated rows are turns each,
    an empty table gives no row.
    """
    return prefix_trie(rebuilt(positions(convs)))
