"""Ranked lexical search: documents with the same bag of item words are scored once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plumbline.llm.decontaminate import words
from plumbline.session import cut_to, drop, scratch

#: Cells (class, item) and postings that a task has in memory at a time, besides those of one class.
_CELLS = 1 << 21


class _Bags:
    """Whole texts -> number of terms, and those of the vocabulary with their counts, by term number."""

    def __init__(self, terms):
        self.terms = terms

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = self.terms.value
        for b in batches:
            n, ids, tfs = [], [], []
            for text in b.column(1):
                ws = words(text.as_py() or b"")
                bag = sorted((number[w], c) for w, c in Counter(ws).items() if w in number)
                n.append(len(ws))
                ids.append([k for k, _ in bag])
                tfs.append([c for _, c in bag])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], names=["doc_id", "n", "ids", "tfs"])


class _Best:
    """The best ``k`` members of each item among what was added so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.zeros(n_items, np.int64)
        self.item, self.score, self.none, self.doc = (np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))
        self.new: list[tuple] = []
        self.waiting = 0

    def add(self, item, score, none, doc) -> None:
        self.new.append((item, score, none, doc))
        self.waiting += len(item)
        if self.waiting > len(self.item) + (1 << 18):
            self.settle()

    def settle(self) -> None:
        item, score, none, doc = (np.concatenate([a, *x]) for a, x in zip((self.item, self.score, self.none, self.doc), zip(*self.new, strict=True) if self.new else ((),) * 4, strict=True))
        order = np.lexsort((doc, none, -score, item))
        item, score, none, doc = item[order], score[order], none[order], doc[order]
        first = np.searchsorted(item, item)
        keep = np.arange(len(item)) - first < self.k
        self.item, self.score, self.none, self.doc = item[keep], score[keep], none[keep], doc[keep]
        full = np.arange(len(item)) - first == self.k - 1
        self.least[item[full]] = score[full]
        self.new, self.waiting = [], 0


class _Score:
    """Classes (ids, tfs, m, members) -> the best documents of each item in this task.

    Terms hold their items as postings, so a class meets only items that share a term with it.
    """

    def __init__(self, tables, k: int):
        self.tables, self.k = tables, k

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, items, counts, weight, rids = self.tables.value
        length, best = np.diff(start), _Best(len(rids), self.k)
        for b in batches:
            at = b.column(0).offsets.to_numpy()
            ids, tfs = b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy().astype(np.int64)
            at = at - at[0]
            m = np.repeat(b.column(2).to_numpy(), np.diff(at))
            part = weight[ids] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m))
            meets = np.concatenate([[0], np.cumsum(length[ids])])[at]  # postings before each class
            who_at = b.column(3).offsets.to_numpy()
            who_at = who_at - who_at[0]
            who = b.column(3).flatten()
            doc, none = who.field(1).fill_null(0).to_numpy(), who.field(0).to_numpy(zero_copy_only=False)
            c = 0
            while c < b.num_rows:
                end = int(min(max(np.searchsorted(meets, meets[c] + _CELLS, "right") - 1, c + 1), c + max(1, _CELLS // len(rids)), b.num_rows))
                s = slice(at[c], at[end])
                n = length[ids[s]]
                over = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[ids[s]], n)
                row = np.repeat(np.repeat(np.arange(end - c), np.diff(at[c:end + 1])), n)
                scores = np.zeros((end - c) * len(rids), np.int64)
                np.add.at(scores, row * len(rids) + items[over], np.repeat(part[s], n) * counts[over])
                scores = scores.reshape(end - c, len(rids))
                row, item = np.nonzero((scores > 0) & (scores >= best.least))
                # the class stands for its members: each has its score
                n = np.diff(who_at)[c + row]
                over = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(who_at[c + row], n)
                best.add(np.repeat(item, n), np.repeat(scores[row, item], n), none[over], doc[over])
                c = end
        best.settle()
        rows = [pa.array(rids[best.item]), pa.array(best.score), pa.array(best.doc, mask=best.none)]
        yield pa.RecordBatch.from_arrays(rows, names=["rid", "score", "doc_id"])


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    ``docs`` (doc_id, text) and ``items`` (item_id, text): a NULL or empty text has no terms; such a document is no
    document of the statistics, such an item has no row. Each row of either table counts on its own, repeated or not,
    with or without an id; NULL doc_ids come last among equal scores. Other columns are ignored.

    Items go by in blocks of about ``block_bytes`` of text, so that what is collected and broadcast is bounded. Within
    a block only the words of its items matter: documents become short bags of term numbers. Documents with equal bags
    and equal length term m (the grouping compares the whole bag behind its hash) are one class, of which the first
    ``k`` doc_ids can be needed, never all: a class of a third of all documents is cut to these before the shuffle.
    Classes are scored once each. Every task gives the best ``k`` documents of each item, then one window ranks them.
    """
    spark = docs.sparkSession
    paths: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch(spark, name))
        return cut_to(df, paths[-1])

    items = keep(items.where("text is not null").select("item_id", F.col("text").cast("binary").alias("text"), F.monotonically_increasing_id().alias("rid")), "items")
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text") + 64)).head()[0] or 0) // block_bytes))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = None
    for part in range(blocks):
        mine = [(r.rid, Counter(words(bytes(r.text)))) for r in items.where(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == part).select("rid", "text").toLocalIterator()]
        mine = [(rid, bag) for rid, bag in mine if bag]
        terms = {w: i for i, w in enumerate(sorted({w for _, bag in mine for w in bag}))}
        bags = keep(plain.mapInArrow(_Bags(spark.sparkContext.broadcast(terms)), "doc_id long, n long, ids array<int>, tfs array<int>"), "bags")
        stats = bags.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).head()
        df = bags.select(F.explode("ids").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
        df = df.select("t", F.floor(1000 * F.ln(F.lit(2 * stats.docs + 2) / (2 * F.col("df") + 1))).alias("w"))
        weight = np.zeros(len(terms), np.int64)
        for t, w in df.toLocalIterator():  # at most one row for each term of the block
            weight[t] = w
        tables = spark.sparkContext.broadcast(_postings(mine, terms, weight))
        best = _classes(bags, stats.docs, stats.terms, k).mapInArrow(_Score(tables, k), "rid long, score long, doc_id long")
        top = Window.partitionBy("rid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)
        best = best if blocks == 1 else cut_to(best, scratch(spark, "ranked"))
        if blocks > 1:
            drop(spark, paths.pop())
        found = best if found is None else found.unionByName(best)
    return found.join(items.select("rid", "item_id"), "rid").select("item_id", "rank", "doc_id", "score")


def _classes(bags: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """ids, tfs, m and the first ``k`` members of each class of documents with some term of the items."""
    m = F.expr(f"25 + (cast(n as decimal(38, 0)) * 75 * {n_docs}) div {max(1, n_terms)}")
    rows = bags.where(F.size("ids") > 0).select("doc_id", "ids", "tfs", m.alias("m")).withColumn("h", F.xxhash64("ids", "tfs", "m"))
    own = ["h", "m", "ids", "tfs"]
    first = Window.partitionBy(*own).orderBy(F.asc_nulls_last("doc_id"))
    rows = rows.withColumn("k", F.row_number().over(first)).where(F.col("k") <= k)
    member = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    return rows.groupBy(*own).agg(F.array_sort(F.collect_list(member)).alias("members")).select("ids", "tfs", "m", "members")


def _postings(mine: list[tuple], terms: dict[bytes, int], weight: np.ndarray) -> tuple:
    """Per term the items that hold it and how often: starts, items, counts; and weights, and the items' row ids."""
    rows = np.array([(terms[w], i, c) for i, (_, bag) in enumerate(mine) for w, c in bag.items()], np.int64).reshape(-1, 3)
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    start = np.searchsorted(rows[:, 0], np.arange(len(terms) + 1))
    return start, rows[:, 1].copy(), rows[:, 2].copy(), weight, np.array([rid for rid, _ in mine], np.int64)
