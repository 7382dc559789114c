"""What several operators share: rows of text through Arrow, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.session import cut_to, drop, scratch


def per_text(docs: DataFrame, fn: Callable[[bytes], tuple], out: str, carry: list[str]) -> DataFrame:
    """``fn`` (UTF-8 bytes of one whole text, empty for NULL) -> the values of ``out``, beside the ``carry`` columns."""
    keep = [F.col(f"`{c}`") for c in carry]
    kept = docs.select(*keep).schema
    return docs.select(*keep, F.col("text").cast("binary").alias("__text")).mapInArrow(_Texts(fn, carry, out), T.StructType([*kept.fields, *T.StructType.fromDDL(out).fields]))


class _Texts:
    def __init__(self, fn, carry, out):
        self.fn, self.carry, self.out = fn, carry, [(c.split()[0], _arrow(c.split(None, 1)[1])) for c in out.split(", ")]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1)
            made = [self.fn(x.as_py() or b"") for x in texts]
            cols = list(b.columns[:-1])
            for k, (_, kind) in enumerate(self.out):
                cols.append(pa.array([m[k] for m in made], type=kind))
            yield pa.RecordBatch.from_arrays(cols, names=[*self.carry, *(n for n, _ in self.out)])


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    return {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}[kind]


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL ids fall in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): (node, comp), comp the smallest node reachable.

    Every round each node takes its smallest neighbour as parent, parents are followed to their end by doubling, and
    the edges between ends are what the next round has; at least half of the ends of each component go per round.
    Rounds and doublings end by themselves when nothing changes. All steps are joins and aggregates over tables in the
    shared folder; the driver sees only counts.
    """
    spark = edges.sparkSession
    paths: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        paths.append(scratch(spark, "components"))
        return cut_to(df, paths[-1])

    live = keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = live.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = keep(nodes.select("node", F.col("node").alias("comp")))
    while not (real := live.where("a < b")).isEmpty():
        up = real.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))  # ends of chains have no row
        up = keep(up)
        while True:
            over = up.select(F.col("node").alias("parent"), F.col("parent").alias("further"))
            jumped = keep(up.join(over, "parent", "left").select("node", F.coalesce("further", "parent").alias("parent"), F.col("further").isNotNull().alias("moved")))
            up = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        ends = up.withColumnRenamed("parent", "end")
        labels = keep(labels.join(ends, labels.comp == ends.node, "left").select(labels.node, F.coalesce("end", "comp").alias("comp")))
        there = real.join(ends.select(F.col("node").alias("a"), F.col("end").alias("ea")), "a", "left").join(ends.select(F.col("node").alias("b"), F.col("end").alias("eb")), "b", "left")
        ea, eb = F.coalesce("ea", "a"), F.coalesce("eb", "b")
        live = keep(there.select(F.least(ea, eb).alias("a"), F.greatest(ea, eb).alias("b")).where("a < b").distinct())
    for p in paths:
        if p not in labels.inputFiles()[0]:
            drop(spark, p)
    return labels
