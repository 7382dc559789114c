"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, found through a block-max inverted index."""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm.common import fold_of
from plumbline.llm.decontaminate import words

BLOCK = 64


@dataclass
class Settings:
    """``examples``: most labelled rows to learn from (the first by hash of doc_id). ``terms``: most terms kept.
    A term counts if it marks label 1: its share among distinct texts of label 1 lies ``z`` deviations above the share among
    the others, and at least half of its texts have label 1. ``prior``: weight of the base rate in a vote."""

    examples: int = 20_000
    terms: int = 5_000
    z: float = 3.0
    neighbours: int = 15
    prior: float = 1.0
    reject: float = 0.7


class BlockMax:
    """Postings by term and block of examples, with the largest weight of each term in each block."""

    def __init__(self, terms: list[bytes], idf: np.ndarray, vectors: list[dict[int, float]], labels: list[int], ids: list, settings: Settings, base: float):
        self.terms, self.idf, self.labels, self.ids, self.settings, self.base = {t: i for i, t in enumerate(terms)}, idf, np.array(labels, float), ids, settings, base
        blocks = -(-len(vectors) // BLOCK)
        self.top = np.zeros((len(terms), blocks))
        post: dict[tuple[int, int], tuple[list[int], list[float]]] = defaultdict(lambda: ([], []))
        for e, v in enumerate(vectors):
            for t, w in v.items():
                k, ws = post[t, e // BLOCK]
                k.append(e % BLOCK)
                ws.append(w)
                self.top[t, e // BLOCK] = max(self.top[t, e // BLOCK], w)
        self.post = {key: (np.array(k), np.array(w)) for key, (k, w) in post.items()}

    def vector(self, ws: list[bytes]) -> dict[int, float]:
        """Unit TF-IDF vector over the terms."""
        tf = Counter(i for i in map(self.terms.get, ws) if i is not None)
        v = {i: (1 + np.log(n)) * self.idf[i] for i, n in tf.items()}
        size = sum(w * w for w in v.values()) ** 0.5
        return {i: w / size for i, w in v.items()}

    def nearest(self, v: dict[int, float]) -> list[tuple[float, int]]:
        """The most similar examples (cosine, place), ties to the smaller place; blocks that cannot reach the last of them are left out."""
        k, best = self.settings.neighbours, []
        if not v:
            return best
        at = sorted(v)
        q = np.array([v[t] for t in at])
        bound = q @ self.top[at]
        for b in np.lexsort((np.arange(len(bound)), -bound)):
            if bound[b] <= 0 or len(best) == k and bound[b] < best[-1][0] - 1e-9:
                break
            score = np.zeros(BLOCK)
            for t, w in zip(at, q):
                p = self.post.get((t, int(b)))
                if p:
                    score[p[0]] += w * p[1]
            best += [(float(score[e]), int(b) * BLOCK + int(e)) for e in np.flatnonzero(score)]
            best = sorted(best, key=lambda x: (-round(x[0], 12), x[1]))[:k]
        return best

    def score(self, near: list[tuple[float, int]]) -> float:
        """Share of label 1 among the neighbours by similarity, drawn to the base rate of texts without terms."""
        m = self.settings.prior
        return (sum(s * self.labels[e] for s, e in near) + m * self.base) / (sum(s for s, _ in near) + m)


class _Terms:
    """Distinct terms of each example with its label; a last column parts equal texts."""

    def __call__(self, batches):
        for b in batches:
            for d, toxic, text in zip(b.column(0), b.column(1), b.column(2)):
                raw = text.as_py() or b""
                found = sorted(set(words(raw)))
                yield pa.RecordBatch.from_arrays([pa.array([x.decode("utf-8", "replace") for x in found], pa.string()), pa.array([toxic.as_py()] * len(found), pa.int32())], names=["term", "toxic"])


class _Frequency:
    """Documents that hold each kept term, counted per task."""

    def __init__(self, terms: list[bytes]):
        self.terms = terms

    def __call__(self, batches):
        n, total, at = np.zeros(len(self.terms), np.int64), 0, {t: i for i, t in enumerate(self.terms)}
        for b in batches:
            for x in b.column(0):
                total += 1
                for i in at.keys() & set(words(x.as_py() or b"")):
                    n[at[i]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(n)), pa.int64()), pa.array([total, *n], pa.int64())], names=["term", "n"])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> BlockMax:
    """Learn from (doc_id, toxic) and the texts of these documents; every row of ``labels`` given here may be used.

    The examples are bounded by ``settings.examples``, so they are broadcast to the documents and their terms come
    back to the driver; document frequencies of the kept terms are counted over all documents.
    """
    s = settings or Settings()
    mine = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = mine.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.examples)
    examples = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
    unlike = examples.groupBy(F.sha2("text", 256).alias("k")).agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    counts = unlike.select("doc_id", "toxic", "text").mapInArrow(_Terms(), "term string, toxic int").groupBy("term").agg(F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("all"))
    sizes = unlike.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("pos"), F.count(F.lit(1)).alias("all")).head()
    pos, neg = max(sizes["pos"], 1), max(sizes["all"] - sizes["pos"], 1)
    p, q = F.col("pos") / pos, (F.col("all") - F.col("pos")) / neg
    z = (p - q) / F.sqrt(p * (1 - p) / pos + q * (1 - q) / neg + 1e-12)
    kept = counts.where((z >= s.z) & (F.col("pos") * 2 >= F.col("all"))).orderBy(z.desc(), "term").limit(s.terms).collect()
    terms = sorted(r.term.encode() for r in kept)
    frequency = docs.select(F.col("text").cast("binary")).mapInArrow(_Frequency(terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    n = {r.term: r.n for r in frequency}
    idf = np.array([np.log((1 + n.get(-1, 0)) / (1 + n.get(i, 0))) + 1 for i in range(len(terms))])
    index = BlockMax(terms, idf, [], [], [], s, 0.0)
    rows = unlike.select("doc_id", "toxic", "text").mapInArrow(_Vectors(index), "doc_id long, toxic int, terms array<int>, weights array<double>").orderBy("doc_id").collect()
    signal = [r for r in rows if len(r.terms)]
    bare = [r.toxic for r in rows if not len(r.terms)]
    base = (sum(bare) + 0.5) / (len(bare) + 10)
    return BlockMax(terms, idf, [dict(zip(r.terms, r.weights)) for r in signal], [r.toxic for r in signal], [r.doc_id for r in signal], s, min(base, 0.5))


class _Vectors:
    def __init__(self, index: BlockMax):
        self.index = index

    def __call__(self, batches):
        for b in batches:
            vs = [self.index.vector(words(x.as_py() or b"")) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1), pa.array([list(v) for v in vs], pa.list_(pa.int32())), pa.array([list(v.values()) for v in vs], pa.list_(pa.float64()))], names=["doc_id", "toxic", "terms", "weights"])


class _Score:
    def __init__(self, index):
        self.index = index

    def __call__(self, batches):
        index = self.index.value
        for b in batches:
            score, ids, sims = [], [], []
            for x in b.column(b.num_columns - 1):
                near = index.nearest(index.vector(words(x.as_py() or b"")))
                score.append(index.score(near))
                ids.append([index.ids[e] for _, e in near])
                sims.append([s for s, _ in near])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score, pa.float64()), pa.array(ids, pa.list_(pa.int64())), pa.array(sims, pa.list_(pa.float64()))], names=[*b.schema.names[:-1], "score", "evidence", "similarity"])


def score(docs: DataFrame, index: BlockMax, out: list[str] | None = None) -> DataFrame:
    """Documents (columns ``out``, all by default) with ``score``, ``evidence`` (doc_ids of the nearest examples) and ``similarity``.

    A text without any kept term, an empty or NULL one too, has no neighbours and gets the base rate of such examples.
    Input columns named like an output are replaced. Repeated rows are scored each; no row meets another.
    """
    out = [c for c in out or docs.columns if c not in ("score", "evidence", "similarity")]
    keep = docs.select(*(F.col(f"`{c}`") for c in out))
    schema = T.StructType([*keep.schema.fields, *T.StructType.fromDDL("score double, evidence array<long>, similarity array<double>").fields])
    sent = docs.sparkSession.sparkContext.broadcast(index)
    return docs.select(*(F.col(f"`{c}`") for c in out), F.col("text").cast("binary").alias("__text")).mapInArrow(_Score(sent), schema)


def learn(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, folds: int = 3, held: int = 1) -> BlockMax:
    """``fit`` on the labels outside the held-out fold."""
    return fit(docs, labels.where(fold_of(F.col("doc_id"), folds) != held), settings)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, folds: int = 3, held: int = 1) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and the evidence."""
    s = settings or Settings()
    scored = score(docs, learn(docs, labels, s, folds, held), out=["doc_id"])
    return scored.select("doc_id", (fold_of(F.col("doc_id"), folds) == held).alias("held_out"), "score", (F.col("score") >= s.reject).cast("int").alias("predicted"), "evidence", "similarity")


def keep_clean(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    s = settings or Settings()
    names = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c in ("score", "evidence", "similarity")}
    scored = score(docs.withColumnsRenamed(names), learn(docs, labels, s))
    return scored.where(F.col("score") < s.reject).drop("score", "evidence", "similarity").withColumnsRenamed({v: k for k, v in names.items()}).select(*(F.col(f"`{c}`") for c in docs.columns))
