"""SimHash near-duplicates: fingerprints joined by segment bit counts, verified bit by bit."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import components, per_text
from plumbline.session import cut


def majority(hashes: np.ndarray) -> int:
    """The signed long whose bits are set in over half of the 64-bit ``hashes``; zero of none."""
    n, counts = len(hashes), np.zeros(64, np.int64)
    bits = np.ascontiguousarray(hashes, "<u8").view(np.uint8)
    for k in range(0, n * 8, 1 << 20):  # bounded memory for very long texts
        counts += np.unpackbits(bits[k:k + (1 << 20)], bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


class _Fingerprint:
    def __init__(self, width: int):
        self.width = width

    def __call__(self, text: bytes) -> tuple[int]:
        ws = text.lower().split()  # bytes: lowers A-Z and splits at \x20 and \x09-\x0D only
        if not ws:
            return (0,)
        line = b" ".join(ws)
        if len(ws) <= self.width:
            hashes = [xxhash.xxh64_intdigest(line, 42)]
        else:
            at = np.cumsum([0, *(len(w) + 1 for w in ws)]).tolist()
            digest = xxhash.xxh64_intdigest
            hashes = [digest(line[a:b - 1], 42) for a, b in zip(at, at[self.width:])]
        return (majority(np.array(hashes, dtype="<u8")),)


def fingerprints(docs: DataFrame, width: int = 3, out: list[str] | None = None) -> DataFrame:
    """Documents (columns ``out``, all by default) with ``fp``, the 64-bit SimHash of their word shingles as a signed long."""
    mine = docs.drop("fp")
    return per_text(mine, _Fingerprint(width), "fp long", [c for c in out or docs.columns if c in mine.columns])


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def _embed(fp: Column) -> Column:
    """Bits set in each of the 32 two-bit segments, two bits a segment in one long."""
    odd = _signed(0x5555555555555555)
    low, high = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))  # low + high in each segment


def _ball(cell: Column) -> Column:
    """The grid cell and its neighbours at Manhattan distance one: counts run from 0 to 2 in each segment."""
    at = lambda i: F.shiftrightunsigned(cell, i).bitwiseAND(F.lit(3).cast("long"))
    near = []
    for i in range(0, 64, 2):  # 0 and 1 differ by the pattern 01, 1 and 2 by 11
        near += [F.when(at(i) < 2, cell.bitwiseXOR(_signed(1 << i))), F.when(at(i) > 0, cell.bitwiseXOR(_signed(3 << i)))]
    return F.array_compact(F.array(cell, *near))


def _flips(fp: Column) -> Column:
    """The fingerprint itself and the 64 that differ in one bit."""
    return F.array(fp, *(fp.bitwiseXOR(_signed(1 << i)) for i in range(64)))


def linked(prints: DataFrame) -> DataFrame:
    """Edges (a, b: long) whose components are those of all pairs of distinct ``fp`` that differ in at most two bits.

    Fingerprints are embedded as counts of set bits per segment; the Manhattan distance of two embeddings is at most
    the number of differing bits. Two embeddings within distance two have a grid cell within distance one of both, so
    each fingerprint takes its cell and the cells around it, and stays only if a cell holds another fingerprint.
    What stays is verified on the bits in the same way: two fingerprints within two bits share a value within one bit
    of both, and all that share a value are linked to the smallest of them. That is a star per value, never the pairs
    of a group: thousands of near copies cost 65 rows each.
    """
    cells = prints.select("fp", _embed(F.col("fp")).alias("e")).select("fp", F.explode(_ball(F.col("e"))).alias("cell"))
    shared = cells.groupBy("cell").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("cell")
    close = cut(cells.join(shared, "cell", "left_semi").select("fp").distinct(), "simhash-close")
    flips = close.select("fp", F.explode(_flips(F.col("fp"))).alias("mid"))
    hubs = flips.groupBy("mid").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("mid", "lo")
    return flips.join(hubs, "mid").where("fp > lo").select(F.col("lo").alias("a"), F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, width: int = 3, out: list[str] | None = None) -> DataFrame:
    """Documents (columns ``out``, all by default) with ``fp`` and ``component_id``.

    Fingerprints at two or fewer differing bits are linked; ``component_id`` is the smallest doc_id reachable. Words
    are parted by ASCII white space, A-Z lower-cased; fewer words than ``width`` are one shingle; a text without words,
    or NULL, has fingerprint zero and is linked like any other. Repeated rows share their fingerprint's component;
    NULL doc_ids take part, and a component of them alone has component_id NULL. An input column named ``fp`` or
    ``component_id`` is replaced. Equal fingerprints are collapsed first, so copies are never paired.
    """
    keep = [c for c in out or docs.columns if c not in ("fp", "component_id")]
    marked = cut(fingerprints(docs, width, out=keep), "simhash-prints")
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    return marked.join(_members(first), "fp").select(*(f"`{c}`" for c in keep), "fp", "component_id")


def _members(first: DataFrame) -> DataFrame:
    """(fp, component_id) from (fp, first)."""
    both = _groups(first)
    least = both.groupBy("comp").agg(F.min("first").alias("component_id"))
    return both.join(least, "comp").select("fp", "component_id")


def _groups(first: DataFrame) -> DataFrame:
    """``first`` (one row for each fp) with ``comp``, the smallest fp of its component."""
    groups = components(linked(first.select("fp"))).withColumnRenamed("node", "fp")
    return cut(first.join(groups, "fp", "left").withColumn("comp", F.coalesce("comp", "fp")), "simhash-groups")


def keep_one(docs: DataFrame, width: int = 3) -> DataFrame:
    """One document of each component, all columns: the row of the smallest doc_id (NULL only where there is no other).

    Of repeated rows one stays. Names starting with ``__`` are reserved.
    """
    names = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c in ("fp", "component_id")}
    rows = cut(fingerprints(docs.withColumnsRenamed(names).withColumn("__rid", F.monotonically_increasing_id()), width), "simhash-rows", "zstd")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__rid"))
    first = rows.groupBy("fp").agg(best.alias("first"))
    stay = _groups(first).groupBy("comp").agg(F.min("first").alias("first")).select(F.col("first.__rid").alias("__rid"))
    kept = rows.join(stay, "__rid", "left_semi").drop("__rid", "fp")
    return kept.withColumnsRenamed({v: k for k, v in names.items()}).select(*(F.col(f"`{c}`") for c in docs.columns))


def simhash_digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    found = near_duplicates(docs.select("doc_id", "text"), out=["doc_id"])
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
