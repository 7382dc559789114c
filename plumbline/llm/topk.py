"""Exact top-k inner products: buckets of similar length, pruned per query by length or by a coordinate, then verified."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plumbline.session import cut

BUCKET = 1024
#: A query whose local cosine threshold reaches this is pruned by coordinate, below by length.
BY_COORDINATE = 0.6
#: Larger scaled components would leave 64-bit sums; such vectors take no part.
LIMIT = float(1 << 31)


def scaled(vectors: DataFrame, factor: float = 256.0, id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, v: floor(factor * x) as longs, norm) of the vectors that take part."""
    x = F.col(column)
    fine = x.isNotNull() & F.col(id).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * factor) < LIMIT))
    whole = F.when(fine, F.transform(x, lambda c: F.floor(c.cast("double") * factor)))
    v = vectors.select(F.col(id).cast("long").alias("vec_id"), whole.alias("v")).where("v is not null")
    return v.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, c: acc + c.cast("double") * c.cast("double"))))


class Best:
    """The k best (score, smallest id) per query, over pieces."""

    def __init__(self, queries: int, k: int):
        self.k, self.n = k, queries
        self.q, self.s, self.c = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, q: np.ndarray, s: np.ndarray, c: np.ndarray) -> None:
        q, s, c = np.concatenate([self.q, q]), np.concatenate([self.s, s]), np.concatenate([self.c, c])
        order = np.lexsort((c, -s, q))
        q, s, c = q[order], s[order], c[order]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < self.k
        self.q, self.s, self.c = q[keep], s[keep], c[keep]

    def floor(self) -> np.ndarray:
        """Per query the k-th best score so far, or minus infinity."""
        out = np.full(self.n, -np.inf)
        full = np.bincount(self.q, minlength=self.n) >= self.k
        last = np.searchsorted(self.q, np.arange(self.n), side="right") - 1
        out[full] = self.s[last[full]]
        return out


class Queries:
    """One block of queries of one dimension."""

    def __init__(self, ids: list[int], rows: list[list[int]], k: int):
        self.ids, self.k = np.array(ids, np.int64), k
        self.q = np.array(rows, np.int64).reshape(len(ids), -1)
        unit = self.q.astype(float)
        self.norm = np.sqrt((unit * unit).sum(1))
        self.unit = unit / np.maximum(self.norm, 1e-300)[:, None]
        self.floor = np.full(len(ids), -np.inf)

    def products(self, at: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Exact integer products: doubles hold them below 2^53, else integers do."""
        q = self.q[at]
        most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
        return (q.astype(float) @ c.T.astype(float)).astype(np.int64) if most < 2.0 ** 53 else q @ c.T

    def bucket(self, ids: np.ndarray, c: np.ndarray, norm: np.ndarray, best: Best) -> None:
        """One bucket, longest vector first."""
        hits: list = []
        top = norm[0]
        reach = self.norm * top
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(reach > 0, self.floor / reach, np.where(self.floor > 0, np.inf, -np.inf))
        active = local <= 1 + 1e-9  # a product is at most the lengths' product
        near = active & (local >= BY_COORDINATE)
        wide = np.flatnonzero(active & ~near)
        if len(wide):
            self._length(wide, ids, c, norm, hits)
        if near.any():
            unit = c / np.maximum(norm, 1e-300)[:, None]
            for i in np.flatnonzero(near):
                # by Cauchy-Schwarz on the other coordinates, cos >= t bounds the candidate's coordinate f around the query's
                f = int(np.abs(self.unit[i]).argmax())
                a, b = self.unit[i, f], unit[:, f]
                t = self.floor[i] / np.maximum(self.norm[i] * norm, 1e-300)
                ok = np.flatnonzero((a * b + np.sqrt(np.maximum(0, 1 - a * a)) * np.sqrt(np.maximum(0, 1 - b * b)) >= t - 1e-9) | (norm == 0))
                if len(ok):
                    self._verify(np.array([i]), ids[ok], c[ok], hits)
        if hits:
            best.add(*(np.concatenate(x) for x in zip(*hits)))
            self.floor = np.maximum(self.floor, best.floor())

    def _length(self, at, ids, c, norm, hits):
        """Candidates long enough for a query are the first ones of the bucket."""
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(self.norm[at] > 0, self.floor[at] / self.norm[at], -np.inf) * (1 - 1e-9)
        n = np.searchsorted(-norm, -least, side="right")
        n[self.floor[at] == -np.inf] = len(norm)
        n[(self.floor[at] <= 0)] = len(norm)
        for group in np.array_split(at[np.argsort(n)], max(1, len(at) // 256)):
            rows = n[np.isin(at, group)].max()
            if rows:
                self._verify(group, ids[:rows], c[:rows], hits)

    def _verify(self, at, ids, c, hits):
        s = self.products(at, c)
        hit = (s >= self.floor[at][:, None]) & (self.ids[at][:, None] != ids[None, :])
        i, j = np.nonzero(hit)
        if len(i):
            hits.append((at[i], s[i, j], ids[j]))


class _Search:
    def __init__(self, blocks, k: int):
        self.blocks, self.k = blocks, k

    def __call__(self, batches):
        blocks = {d: Queries(ids, rows, self.k) for d, (ids, rows, _) in self.blocks.value.items()}
        for d, (_, _, floor) in self.blocks.value.items():
            blocks[d].floor = floor.copy()
        best = {d: Best(len(b.ids), self.k) for d, b in blocks.items()}
        for b in batches:
            ids, norm, size = np.asarray(b.column(0)), np.asarray(b.column(2)), np.asarray(pa.compute.list_value_length(b.column(1)))
            for d in blocks:
                mine = np.flatnonzero(size == d)
                if len(mine):
                    c = np.asarray(b.column(1).take(pa.array(mine)).flatten()).reshape(len(mine), d)
                    order = np.argsort(-norm[mine], kind="stable")
                    for lo in range(0, len(mine), BUCKET):
                        part = order[lo:lo + BUCKET]
                        blocks[d].bucket(ids[mine[part]], c[part], norm[mine[part]], best[d])
        for d, x in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(blocks[d].ids[x.q]), pa.array(x.c), pa.array(x.s)], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = 4096, seed: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query with all other rows, ties to smaller ids.

    ``vectors`` and ``queries`` are (vec_id, v, norm) of ``scaled``. Vectors are dealt by length, so that a task's
    buckets have similar lengths. Queries go by in blocks of about ``block``, each one pass: the ``seed`` longest
    vectors give every query a first floor, and a bucket is left out, cut by length, or cut by the query's largest
    coordinate, as the floor allows. What is left is multiplied exactly; a task returns at most k rows a query.

    Only vectors of a query's own dimension are compared. Rows with the query's vec_id are the query itself; repeated
    query rows count once; repeated candidates each count. Zero and empty vectors score 0. No query, no rows.
    """
    spark = vectors.sparkSession
    dealt = cut(vectors.repartitionByRange(F.col("norm").desc(), "vec_id").sortWithinPartitions(F.col("norm").desc()), "topk-vectors")
    asked = cut(queries.select("vec_id", "v").distinct(), "topk-queries")
    longest = [(r.vec_id, r.v) for r in dealt.orderBy(F.col("norm").desc(), "vec_id").limit(seed).collect()]
    blocks = max(1, -(-asked.count() // block))
    found = None
    for n in range(blocks):
        mine: dict[int, tuple[list, list]] = {}
        for r in asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == n).toLocalIterator():
            ids, rows = mine.setdefault(len(r.v), ([], []))
            ids.append(r.vec_id)
            rows.append(r.v)
        sent = {}
        for d, (ids, rows) in mine.items():
            q, best = Queries(ids, rows, k), Best(len(ids), k)
            first = [(i, v) for i, v in longest if len(v) == d]
            if first:
                c = np.array([v for _, v in first], np.int64).reshape(len(first), d)
                for lo in range(0, len(ids), 256):
                    hits: list = []
                    q._verify(np.arange(lo, min(lo + 256, len(ids))), np.array([i for i, _ in first]), c, hits)
                    best.add(*(np.concatenate(x) for x in zip(*hits))) if hits else None
            sent[d] = (ids, rows, best.floor())
        part = dealt.mapInArrow(_Search(spark.sparkContext.broadcast(sent), k), "query_id long, vec_id long, score long")
        part = cut(part, "topk-part") if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    best_first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def every_fiftieth(vectors: DataFrame, k: int = 5) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 50, candidates all rows."""
    v = cut(scaled(vectors), "topk-scaled")
    return top_k(v, v.where(F.col("vec_id") % 50 == 0), k)
