"""Which passages repeat: windows of a fixed width are brought together by an anchor that equal windows share.

A window's anchor is the smallest hash among its short grams (a minimiser), so equal windows have equal anchors wherever
they stand. Consecutive windows with one anchor position are one segment. Only anchors that occur twice can hold a
repeated window; only their segments travel with text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plumbline.session import cut

_LOW = np.uint64((1 << 24) - 1)
_HIGH = ~_LOW
_EVEN = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of segment text that a task holds before it passes them on.
HOLD = 32 << 20
#: Parts into which anchors are dealt, and anchors that a task packs at a time.
PARTS, PACK = 1 << 12, 1 << 20
_ZSTD = pa.Codec("zstd")


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` consecutive units, by doubling."""
    if len(units) < k:
        return np.zeros(0, np.uint64)
    parts, size, base = {1: units}, 1, _EVEN
    powers = {1: base}
    with np.errstate(over="ignore"):
        while size * 2 <= k:
            h = parts[size]
            parts[size * 2] = h[:-size] * powers[size] + h[size:]
            powers[size * 2] = powers[size] * powers[size]
            size *= 2
        out, have = parts[size], size
        while have < k:
            while size > k - have:
                size //= 2
            n = len(units) - have - size + 1
            out, have = out[:n] * powers[size] + parts[size][have:have + n], have + size
        return mix(out)


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Smallest of every ``w`` consecutive values, by running minima of blocks from both sides."""
    n = len(v) - w + 1
    full = np.full(-(-len(v) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    full[:len(v)] = v
    grid = full.reshape(-1, w)
    right = np.minimum.accumulate(grid, axis=1).reshape(-1)
    left = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(left[:n], right[w - 1:w - 1 + n])


def segments(grams: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, start, end) of the segments of a text with these gram hashes; ends exclusive, in units."""
    w = width - k + 1
    if len(grams) < w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.arange(len(grams), dtype=np.uint64)
    least = sliding_min((grams & _HIGH) | (place & _LOW), w)  # the first place among equal hashes
    i = place[:len(least)]
    at = i + (((least & _LOW) - i) & _LOW)
    new = np.flatnonzero(at[1:] != at[:-1]) + 1
    start, last = np.concatenate([[0], new]), np.concatenate([new, [len(at)]]) - 1
    return grams[at[start]].view(np.int64), start.astype(np.int64), (last + width).astype(np.int64)


class Kind:
    """What a unit is: ``split`` gives the units of a text, ``hashes`` one hash a unit, ``slice`` a stretch as bytes."""

    width: int
    gram: int

    def split(self, text: bytes):
        raise NotImplementedError

    def count(self, units) -> int:
        return len(units)

    def hashes(self, units) -> np.ndarray:
        raise NotImplementedError

    def slice(self, units, a: int, b: int) -> bytes:
        raise NotImplementedError

    def segments(self, units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return segments(gram_hashes(self.hashes(units), self.gram), self.width, self.gram)


class _Anchors:
    """The distinct anchors of each text and how often it has them, packed by part: one row for many texts.

    ``more`` is the compressed steps from text to text and the counts, as the anchors' own order has them.
    """

    def __init__(self, kind: Kind):
        self.kind = kind

    def __call__(self, batches):
        held, size = [], 0
        for b in batches:
            for no, x in zip(b.column(0).to_pylist(), b.column(1)):
                found, count = np.unique(self.kind.segments(self.kind.split(x.as_py() or b""))[0], return_counts=True)
                held.append((no, found, count))
                size += len(found)
                if size > PACK:
                    yield self.packed(held)
                    held, size = [], 0
        if size:
            yield self.packed(held)

    @staticmethod
    def packed(held):
        no = np.repeat(np.array([h[0] for h in held], np.int64), [len(h[1]) for h in held])
        anchor, count = (np.concatenate([h[j] for h in held]) for j in (1, 2))
        part = anchor & (PARTS - 1)  # the low bits have no say in which anchor is the smallest
        by = np.lexsort((no, part))
        no, anchor, count, part = no[by], anchor[by], count[by].astype(np.int32), part[by]
        cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
        more = [_ZSTD.compress(np.diff(no[a:z], prepend=0).tobytes() + count[a:z].tobytes(), asbytes=True) for a, z in zip(cuts, cuts[1:])]
        cols = [pa.array(part[cuts[:-1]].astype(np.int32)), pa.array([anchor[a:z].tobytes() for a, z in zip(cuts, cuts[1:])], pa.binary()), pa.array(more, pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["part", "anchors", "more"])


class _Live:
    """The anchors that occur twice or more, beside each text that has them; rows come sorted by part."""

    def __init__(self, hot: int):
        self.hot = hot

    def __call__(self, batches):
        held, last = [], None
        for b in batches:
            for part, anchors, more in zip(*(c.to_pylist() for c in b.columns)):
                if held and part != last:
                    yield self.found(held)
                    held = []
                held.append((anchors, more))
                last = part
        if held:
            yield self.found(held)

    def found(self, held):
        anchor = np.frombuffer(b"".join(h[0] for h in held), np.int64)
        no, count = [], []
        for anchors, more in held:
            n = len(anchors) // 8
            raw = _ZSTD.decompress(more, 12 * n, asbytes=True)
            no.append(np.cumsum(np.frombuffer(raw, np.int64, n)))
            count.append(np.frombuffer(raw, np.int32, n, 8 * n))
        by = np.argsort(anchor, kind="stable")
        anchor, no, count = anchor[by], np.concatenate(no)[by], np.concatenate(count)[by].astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        total = np.repeat(np.add.reduceat(count, first), np.diff(first, append=len(anchor)))
        live = total > 1
        return pa.RecordBatch.from_arrays([pa.array(no[live]), pa.array(anchor[live]), pa.array(total[live] > self.hot)], names=["no", "anchor", "hot"])


class _Extract:
    """Segments of live anchors with their bytes, each text once a task: of equal ones the later are repeats already.

    A segment of a frequent anchor goes window by window, each under its own hash, so that no anchor gathers a large
    share of all rows in one place.
    """

    def __init__(self, kind: Kind):
        self.kind = kind

    def __call__(self, batches):
        self.held, self.size, self.rows = {}, 0, []
        for b in batches:
            for no, text, live, hot in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                units = self.kind.split(text.as_py() or b"")
                found, starts, ends = self.kind.segments(units)
                at, hot = np.flatnonzero(np.isin(found, np.array(live + hot, np.int64))), set(hot)
                for anchor, a, z in zip(found[at].tolist(), starts[at].tolist(), ends[at].tolist()):
                    if anchor not in hot:
                        self.offer(anchor, (no, a), z, self.kind.slice(units, a, z))
                    else:
                        for i in range(a, z - self.kind.width + 1):
                            piece = self.kind.slice(units, i, i + self.kind.width)
                            self.offer(xxhash.xxh64_intdigest(piece) - (1 << 63), (no, i), i + self.kind.width, piece)
            if self.size > HOLD:
                self.release()
            if self.rows:
                yield self.batch()
        self.release()
        if self.rows:
            yield self.batch()

    def offer(self, anchor, key, end, piece):
        other = self.held.get((anchor, piece))
        if other is None:
            self.held[anchor, piece] = key, end
            self.size += len(piece) + 100
            return
        if key < other[0]:
            self.held[anchor, piece] = key, end
            key, end = other
        elif key == other[0]:
            return
        no, start = key
        last = self.rows[-1] if self.rows else None
        if last and last[4] is None and last[1] == no and last[2] <= start <= last[3]:
            self.rows[-1] = (*last[:3], max(end, last[3]), None)
        else:
            self.rows.append((xxhash.xxh64_intdigest(b"%d" % no) - (1 << 63), no, start, end, None))

    def release(self):
        self.rows += [(anchor, *key, end, piece) for (anchor, piece), (key, end) in self.held.items()]
        self.held, self.size = {}, 0

    def batch(self):
        cols = list(zip(*self.rows))
        self.rows = []
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["anchor", "no", "s", "e", "piece"])


Found = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def merge(starts: np.ndarray, width: int, base: int) -> list[tuple[int, int]]:
    """Union of [p, p + width) over sorted starts, moved by ``base``."""
    if not len(starts):
        return []
    gap = np.flatnonzero(starts[1:] > starts[:-1] + width)
    a, b = starts[np.concatenate([[0], gap + 1])], starts[np.concatenate([gap, [len(starts) - 1]])] + width
    return list(zip((a + base).tolist(), (b + base).tolist()))


class _Strip:
    """Whole result of each text from its repeated spans."""

    def __init__(self, kind: Kind, keep: Callable, texts: bool):
        self.kind, self.keep, self.texts = kind, keep, texts

    def __call__(self, batches):
        for b in batches:
            out = []
            for text, spans in zip(b.column(1), b.column(2).to_pylist()):
                raw = text.as_py() or b""
                joined: list[list[int]] = []
                for a, z in sorted((s["s"], s["e"]) for s in spans or []):
                    if joined and a <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], z)
                    else:
                        joined.append([a, z])
                units = self.kind.split(raw)
                kept = self.keep(units, joined)
                out.append((self.kind.count(units), sum(z - a for a, z in joined), len(joined), kept if self.texts else None, hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names=["no", "n", "n_removed", "n_spans", "kept", "kept_sha256"])


def strip_repeats(docs: DataFrame, kind: Kind, find: Found, keep: Callable, hot: int = 50_000, texts: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n (units), n_removed, n_spans, kept_sha256, and ``kept`` if ``texts``.

    Removed is every unit that a window of ``kind.width`` units covers whose content also starts earlier: in a smaller
    doc_id, or earlier in the document. Equal whole texts are worked on once: the copies of the smallest doc_id go whole
    if they hold a window. ``find`` gets the segments of whole anchors, sorted by anchor, and yields repeated spans.
    NULL texts are empty; NULL doc_ids count as smallest; repeated equal rows (same doc_id, same text) count as one
    document and each get its result; rows of one doc_id with other texts are told apart, and ordered, by the number that
    each distinct text gets in a written table.
    """
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    mine = mine.select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), "text")
    first = mine.groupBy("sha").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("first"))
    order = ["first", "sha"]
    first = first.repartitionByRange(*order).sortWithinPartitions(*order).select("sha", F.col("first.doc_id").alias("first_id"), F.monotonically_increasing_id().alias("no"))
    first = cut(first, "repeats-first")  # from here on a text is its number, which grows with the doc_id
    # texts are shuffled once, by doc_id and whole digest; what is found for numbers gets these keys back and comes to them
    keys = first.withColumnRenamed("sha", "first_sha")
    same = lambda left, right: left["doc_id"].eqNullSafe(right["first_id"]) & (left["sha"] == right["first_sha"])
    one = keys.hint("shuffle_hash")
    texts_once = mine.join(one, same(mine, one)).select("doc_id", "sha", "no", F.col("text").cast("binary").alias("text"))
    # each text sends an anchor once, so the most frequent one has a few bytes for each text in its part
    packed = texts_once.select("no", "text").mapInArrow(_Anchors(kind), "part int, anchors binary, more binary")
    hits = packed.repartition("part").sortWithinPartitions("part").mapInArrow(_Live(hot), "no long, anchor long, hot boolean")
    mine_of = lambda which: F.collect_list(F.when(which, F.col("anchor")))
    by_doc = hits.groupBy("no").agg(mine_of(~F.col("hot")).alias("live"), mine_of(F.col("hot")).alias("hot")).join(keys, "no").drop("no").hint("shuffle_hash")
    pieces = texts_once.join(by_doc, same(texts_once, by_doc)).select("no", "text", "live", "hot").mapInArrow(_Extract(kind), "anchor long, no long, s int, e int, piece binary")
    met = pieces.repartition("anchor").sortWithinPartitions("anchor", "no", "s")
    spans = met.mapInArrow(find, "no long, s int, e int")
    spans = spans.groupBy("no").agg(F.collect_set(F.struct("s", "e")).alias("spans")).join(keys, "no").drop("no").hint("shuffle_hash")
    results = texts_once.join(spans, same(texts_once, spans), "left").select("no", "text", "spans")
    results = results.mapInArrow(_Strip(kind, keep, texts), "no long, n long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    results = results.select("no", "n", "n_removed", "n_spans", "kept_sha256", *(["kept"] if texts else [])).dropDuplicates(["no"])
    return _all_rows(mine.select("doc_id", "sha"), first, results, kind.width, texts)


def _all_rows(rows: DataFrame, first: DataFrame, results: DataFrame, width: int, texts: bool) -> DataFrame:
    """Copies of an earlier document lose all if they hold a window."""
    every = rows.join(first.join(results, "no").drop("no"), "sha")
    copy = ~F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("n") >= width)
    cols = [F.col("doc_id"), F.col("n"), F.when(copy, F.col("n")).otherwise(F.col("n_removed")).alias("n_removed"), F.when(copy, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
            F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256")]
    return every.select(*cols, *([F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if texts else []))
