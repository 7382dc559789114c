"""Near copies by exact Jaccard similarity of word shingles: found by SimHash and completed by prefixes, verified on the whole sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm import simhash
from plumbline.llm.common import components, per_text
from plumbline.session import cut, cut_to, dealt, drop, scratch

#: Sampled texts from which common shingles are learned, and the number of them that makes a shingle common. These
#: only decide in which order shingles are looked up: any order finds every pair.
SAMPLE, COMMON = 20_000, 4
#: Longs of 64 bits in a sketch, the nodes of a block that are compared with those of another at once, and up to how
#: many nodes of one key are paired by a plain join.
LONGS, BLOCK, FEW = 16, 256, 8


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than ``width`` are one shingle, no words none."""
    ws = text.lower().split()  # bytes: lowers A-Z and splits at \x20 and \x09-\x0D only
    if not ws:
        return np.zeros(0, np.uint64)
    line = b" ".join(ws)
    at = np.cumsum([0, *(len(w) + 1 for w in ws)]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a:b - 1], 42) for a, b in zip(at, at[width:])] or [digest(line, 42)], "<u8"))


def _brief(h: np.ndarray) -> np.ndarray:
    """31 bits of each hash: what the sample counts; shingles of equal bits have one place in the order, then their hash decides."""
    return (h.view(np.uint64) >> np.uint64(33)).astype(np.int32)


class _Brief:
    def __init__(self, width: int):
        self.width = width

    def __call__(self, text: bytes) -> tuple[np.ndarray]:
        return (np.unique(_brief(shingles(text, self.width))),)


class _Set:
    """The set, its size, and how many of it fall in each of a number of places that grows with the size, up to 255.

    Counts of two sets never differ in more, summed over the places, than the sets in shingles. That holds for long texts
    too, where a sketch of odd counts is full.
    """

    def __init__(self, width: int):
        self.width = width

    def __call__(self, text: bytes) -> tuple[np.ndarray, int, bytes]:
        h = shingles(text, self.width)
        places = 1 << (max(len(h) // 4, 1) - 1).bit_length()
        counts = np.bincount((h >> np.uint64(32)).astype(np.int64) % places, minlength=places)
        return h.view(np.int64), len(h), np.minimum(counts, 255).astype(np.uint8).tobytes()


class _Prefix:
    """Hash of the set, its size, its sketch, its SimHash, its rarest shingles and, of these, the common ones.

    Two sets at the similarity or above share one of these shingles. The sketch has one bit for each of 1,024 places, set
    where an odd number of shingles fall: sketches never differ in more bits than sets in shingles.
    """

    def __init__(self, width: int, num: int, den: int, common: list[int], counts: list[int]):
        order = np.argsort(np.array(common, np.int32))
        self.width, self.num, self.den, self.common, self.counts = width, num, den, np.array(common, np.int32)[order], np.array(counts, np.int64)[order]

    def __call__(self, text: bytes) -> tuple[int, int, np.ndarray, int, np.ndarray, np.ndarray]:
        found = shingles(text, self.width)
        h = found.view(np.int64)
        n = len(h)
        places = np.bincount((found % np.uint64(64 * LONGS)).astype(np.int64), minlength=64 * LONGS)
        sketch = np.packbits((places & 1).astype(np.uint8), bitorder="little").view("<i8")
        count = np.zeros(n, np.int64)
        if n and len(self.common):
            brief = _brief(found)
            at = np.minimum(np.searchsorted(self.common, brief), len(self.common) - 1)
            count = np.where(self.common[at] == brief, self.counts[at], 0)
        first = np.lexsort((h, count))[:n and n + (-n * self.num // self.den) + 1]
        key = xxhash.xxh64_intdigest(found.tobytes(), 42)
        rare = count[first] == 0
        return key - (1 << 64) if key >> 63 else key, n, sketch, simhash.majority(found), h[first[rare]], h[first[~rare]]


def _common(docs: DataFrame, width: int) -> tuple[list[int], list[int]]:
    share = min(1.0, SAMPLE / max(docs.count(), 1))
    texts = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000)).distinct()
    each = per_text(texts, _Brief(width), "s array<int>", []).select(F.explode("s").alias("s"))
    rows = each.groupBy("s").count().where(F.col("count") >= COMMON).collect()
    return [r.s for r in rows], [r["count"] for r in rows]


def _apart(a: str, b: str) -> Column:
    """Bits in which two sketches differ."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(LONGS)), F.lit(0)).cast("long")


def _beside(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (a, b) with the columns that ``of`` (rep) has for both, named with a or b at their end."""
    for x in "ab":
        pairs = pairs.join(of.select(F.col("rep").alias(x), *(F.col(c).alias(f"{c}{x}") for c in columns)), x)
    return pairs


def _screened(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches leave possible; sets at the similarity differ in at most (n + m) (den - num) / (den + num) shingles."""
    both = _beside(pairs, nodes, "n", "sketch")
    sizes = F.least("na", "nb") * den >= F.greatest("na", "nb") * num
    return both.where(sizes & (_apart("sketcha", "sketchb") * (den + num) <= (F.col("na") + F.col("nb")) * (den - num))).select("a", "b")


def _by_grid(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets whose fingerprints differ in at most two bits, found by the popcount grid: stars, never all pairs of a group."""
    heads = cut(nodes.groupBy("fp").agg(F.min("rep").alias("head")), "nearcopies-heads")
    same = nodes.join(heads, "fp").where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b"))
    near = simhash.linked(dealt(heads.select("fp"), "fp"))
    for x in "ab":
        near = near.join(heads.select(F.col("fp").alias(x), F.col("head").alias(f"head{x}")), x)
    return same.unionByName(near.select(F.least("heada", "headb").alias("a"), F.greatest("heada", "headb").alias("b"))).distinct()


class _Near:
    """Two blocks of nodes (comp, rep, n, sketch) -> the pairs (a, b) of unlike comp that sizes and sketches leave possible."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(*batch.columns):
                c, r, n, s = self._block(one)
                d, q, m, t = self._block(two)
                found = [np.zeros((2, 0), np.int64)]
                for i in range(len(r)):
                    differ = np.bitwise_count(t ^ s[i]).sum(1, dtype=np.int64)
                    near = (d != c[i]) & (np.minimum(m, n[i]) * self.den >= np.maximum(m, n[i]) * self.num) & (differ * (self.den + self.num) <= (m + n[i]) * (self.den - self.num))
                    found.append(np.stack([np.minimum(q[near], r[i]), np.maximum(q[near], r[i])]))
                a, b = np.unique(np.concatenate(found, 1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    @staticmethod
    def _block(nodes: pa.ListScalar) -> tuple[np.ndarray, ...]:
        of = nodes.values
        return *(of.field(k).to_numpy() for k in ("comp", "rep", "n")), of.field("sketch").flatten().to_numpy().view(np.uint64).reshape(-1, LONGS)


def _in_blocks(live: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of unlike ``comp`` under one key that sizes and sketches leave possible.

    Keys of few nodes are joined with themselves. The nodes of other keys are dealt to blocks, and every two blocks of a
    key are compared in some task: no task holds more than two blocks, however many nodes share a key, and no pair
    becomes a row that is not possible.
    """
    sizes = live.groupBy("key").agg(F.count("*").alias("size"))
    live = cut(live.join(sizes, "key"), "nearcopies-sizes")
    few = live.where(F.col("size") <= FEW).select("key", "rep", "comp")
    met = few.join(few.select("key", F.col("rep").alias("to"), F.col("comp").alias("comp2")), "key").where("comp < comp2")
    some = _screened(met.select(F.least("rep", "to").alias("a"), F.greatest("rep", "to").alias("b")).distinct(), nodes, num, den)
    dealt = live.where(F.col("size") > FEW).withColumn("block", F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / BLOCK)))
    held = dealt.join(nodes.select("rep", "n", "sketch"), "rep").groupBy("key", "block").agg(F.collect_list(F.struct("comp", "rep", "n", "sketch")).alias("one"))
    held = cut(held, "nearcopies-blocks")
    other = held.select("key", F.col("block").alias("block2"), F.col("one").alias("two"))
    both = held.join(other, "key").where("block <= block2").select("one", "two")
    return some.unionByName(both.mapInArrow(_Near(num, den), "a long, b long")).distinct()


class _Alike:
    """Pairs (a, b) with sizes and counts by place -> the pairs that the counts leave possible."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(*(batch.column(c).to_pylist() for c in ("na", "countsa", "nb", "countsb")))
            yield batch.select(["a", "b"]).filter(pa.array([self._apart(c, d) * (self.den + self.num) <= (n + m) * (self.den - self.num) for n, c, m, d in both], pa.bool_()))

    @staticmethod
    def _apart(c: bytes, d: bytes) -> int:
        places = min(len(c), len(d))  # both are powers of two: the counts of the finer one are added up
        x, y = (np.minimum(np.frombuffer(k, np.uint8).reshape(-1, places).sum(0, dtype=np.int64), 255) for k in (c, d))
        return int(np.abs(x - y).sum())


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets have Jaccard similarity ``num / den`` or more, in whole numbers.

    Sets are sent to those pairs only that the counts by place, a small part of a set's size, leave possible.
    """
    pairs = cut(_beside(pairs, sets, "n", "counts").mapInArrow(_Alike(num, den), "a long, b long"), "nearcopies-alike")
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    return _beside(pairs, sets, "s").where(shared * (num + den) >= (F.size("sa") + F.size("sb")) * num).select("a", "b")


def _linked(keys: DataFrame, nodes: DataFrame, rows: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(node, comp) of the graph of all pairs of sets at the similarity; ``keys`` (key, rep) holds shared keys only.

    First come the pairs of the popcount grid. Most sets just at the similarity differ in more than its two bits, so two
    steps complete it: all sets of a key are compared with one of them, which joins large groups by a star each, and then
    every pair under one key that is still in two components, so no pair is left out. Only the texts of pairs that sizes
    and sketches leave possible are read.
    """
    links = groups = None
    for step in ("grid", "star", "rest"):
        if step == "grid":
            near = _screened(_by_grid(nodes), nodes, num, den)
        else:
            live = keys.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
            of = live.groupBy("key").agg(F.min(F.struct("comp", "rep")).alias("h"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
            if step == "star":
                met = live.join(of, "key").where("comp <> h.comp").select("rep", F.col("h.rep").alias("to"))
                near = _screened(met.select(F.least("rep", "to").alias("a"), F.greatest("rep", "to").alias("b")).distinct(), nodes, num, den)
            else:
                near = _in_blocks(cut(live.join(of, "key", "left_semi"), "nearcopies-live"), nodes, num, den)
        pairs = cut(near, "nearcopies-pairs")
        wanted = nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "rep", "left_semi").select("__rid")
        wanted = cut(wanted, "nearcopies-wanted")  # few rows; Spark sees their size before it shuffles any text
        texts = rows.select("__rid", F.col("__rep").alias("rep"), "text").join(wanted, "__rid", "left_semi")
        path = scratch(keys.sparkSession, "nearcopies-sets")
        made = _verified(pairs, cut_to(per_text(texts, _Set(width), "s array<long>, n long, counts binary", ["rep"]), path), num, den)
        links = cut(made if links is None else links.unionByName(made), "nearcopies-links")
        drop(keys.sparkSession, path)
        groups = components(links)
    return groups


def keep_one(docs: DataFrame, width: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One document of each component, all columns: the row of the smallest doc_id (NULL only where there is no other).

    Documents are linked when the sets of their ``width``-word shingles have Jaccard similarity ``num / den`` or more.
    Words are parted by ASCII white space, A-Z lower-cased; fewer words than ``width`` are one shingle. Texts without
    words, or NULL, equal each other. Of repeated rows one stays. Names starting with ``__`` are reserved.

    Equal sets are one node. Sets whose SimHash fingerprints the popcount grid finds within two bits are verified first.
    What is farther apart in bits is found by shingles: they have one order, those that are common in a sample last, and
    sets at the similarity share one of their first n - ceil(n * num / den) + 1.
    Shingles are shuffled once: the common ones, which may stand in a large share of the documents, are not counted.
    """
    common, counts = _common(docs, width)
    marked = docs.withColumn("__rid", F.monotonically_increasing_id())
    made = "__rep long, __n long, __sketch array<long>, __fp long, __rare array<long>, __often array<long>"
    rows = cut(per_text(marked, _Prefix(width, num, den, common, counts), made, marked.columns), "nearcopies-rows", "zstd")
    ids = rows.select(F.col("__rep").alias("rep"), "__rid", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__rid").alias("first"), F.col("__n").alias("n"), F.col("__sketch").alias("sketch"), F.col("__fp").alias("fp"))
    nodes = ids.groupBy("rep").agg(F.min("first").alias("first"), F.min("n").alias("n"), F.min("sketch").alias("sketch"), F.min("fp").alias("fp"))
    nodes = cut(nodes.select("rep", "first", "first.__rid", "n", "sketch", "fp"), "nearcopies-nodes")
    copies = cut(ids.select("rep", "__rid").join(nodes.select("rep", F.col("__rid").alias("stays")), "rep").where("__rid <> stays").select("__rid"), "nearcopies-copies")
    one = rows.select("__rid", F.col("__rep").alias("rep"), "__rare", "__often").join(copies, "__rid", "left_anti")
    rare, here = one.select(F.explode("__rare").alias("key"), "rep"), Window.partitionBy("key")
    twice = rare.select("key", "rep", F.min("rep").over(here).alias("lo"), F.max("rep").over(here).alias("hi")).where("lo < hi").select("key", "rep")
    keys = cut(twice.unionByName(one.select(F.explode("__often").alias("key"), "rep")), "nearcopies-keys")
    groups = _linked(keys, nodes, rows, width, num, den).withColumnRenamed("node", "rep")
    best = groups.join(nodes.select("rep", "first"), "rep")
    stay = best.groupBy("comp").agg(F.min("first").alias("stay"))
    gone = best.join(stay, "comp").where("first.__rid <> stay.__rid").select("first.__rid")
    gone = cut(copies.unionByName(gone), "nearcopies-gone")
    return rows.join(gone, "__rid", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
