"""Suffix-array dedup over bytes: induced sorting per shard, permuted common prefixes, repeated spans."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plumbline.llm.repeats import Kind, mix, strip_repeats

#: Most buckets that one inducing pass walks over.
ALPHABET = 1 << 10
#: Bytes that one suffix array holds, beyond which it ends at the next anchor.
SHARD = 4 << 20


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``s`` (non-negative integers) in order, by induced sorting; a shorter prefix comes first.

    Suffixes are smaller (S) or larger (L) than their right neighbour; the leftmost S of each run are sorted first:
    their substrings by one inducing pass, their suffixes, where substrings repeat, by recursion on the string of
    their names. Two passes over the buckets then induce all L and all S suffixes.
    """
    n = len(s)
    if n < 2:
        return np.arange(n)
    small = _smaller(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) < 2:
        return _induce(s, small, lms)
    sa = _induce(s, small, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    names, count = _names(s, lms, order)
    if count < len(lms):
        order = lms[_reduced(names, count)]
    return _induce(s, small, order)


def _smaller(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last is larger than the empty one."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1])
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes from the leftmost-smaller ones in the given order: L forwards through the buckets, then S backwards.

    A bucket is worked on as a whole: what it induces is found for all its suffixes at once, and set at the next free
    places of the buckets concerned, in the order of the scan.
    """
    n = len(s)
    chars, s, count = np.unique(s, return_inverse=True, return_counts=True)
    end = np.cumsum(count)
    start = end - count
    sa = np.empty(n, np.int64)
    seeds = lms[np.argsort(s[lms], kind="stable")]
    seed_at = np.concatenate([[0], np.cumsum(np.bincount(s[lms], minlength=len(chars)))])

    def deal(found: np.ndarray, free: np.ndarray, way: int) -> None:
        """Set ``found`` at the free places of their buckets, upwards or downwards."""
        if len(found):
            c = s[found]
            by = np.argsort(c, kind="stable")
            c = c[by]
            first = np.concatenate([[0], np.flatnonzero(c[1:] != c[:-1]) + 1])
            size = np.diff(first, append=len(c))
            step = np.arange(len(c)) - np.repeat(first, size)
            sa[np.repeat(free[c[first]], size) + way * step] = found[by]
            free[c[first]] += way * size

    free = start.copy()
    deal(np.array([n - 1]), free, 1)
    for k in range(len(chars)):
        last = sa[start[k]:free[k]]
        while len(last):  # runs of one character induce within their bucket
            last = last[last > 0] - 1
            last = last[~small[last] & (s[last] == k)]
            sa[free[k]:free[k] + len(last)] = last
            free[k] += len(last)
        before = np.concatenate([sa[start[k]:free[k]], seeds[seed_at[k]:seed_at[k + 1]]]) - 1
        before = before[before >= 0]
        deal(before[~small[before] & (s[before] > k)], free, 1)
    top, free = free, end - 1
    for k in range(len(chars) - 1, -1, -1):
        last = sa[free[k] + 1:end[k]][::-1]
        while len(last):
            last = last[last > 0] - 1
            last = last[small[last] & (s[last] == k)]
            sa[free[k] - len(last) + 1:free[k] + 1] = last[::-1]
            free[k] -= len(last)
        before = np.concatenate([sa[start[k]:top[k]], sa[free[k] + 1:end[k]]])[::-1] - 1
        before = before[before >= 0]
        deal(before[small[before] & (s[before] < k)], free, -1)
    return sa


def _names(s: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks, in text order, of the leftmost-smaller substrings that ``order`` has sorted; equal ones share a rank."""
    end = np.concatenate([lms[1:], [len(s) - 1]])
    length = np.zeros(len(s), np.int64)
    length[lms] = end - lms + 1
    a, b = order[:-1], order[1:]
    same = (length[a] == length[b]) & (a != lms[-1]) & (b != lms[-1])
    at = np.flatnonzero(same)
    if len(at):
        size = length[a[at]]
        first = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(first, size)
        equal = s[np.repeat(a[at], size) + step] == s[np.repeat(b[at], size) + step]
        same[at] = np.logical_and.reduceat(equal, first)
    rank = np.concatenate([[0], np.cumsum(~same)])
    names = np.zeros(len(s), np.int64)
    names[order] = rank
    return names[lms], int(rank[-1]) + 1


def _reduced(names: np.ndarray, count: int) -> np.ndarray:
    """Suffix array of the string of names: by recursion; where there are too many names for a walk over buckets, by doubling ranks."""
    if count <= ALPHABET:
        return suffix_array(names)
    rank, reach = names, 1
    while True:
        key = rank * (len(rank) + 1)
        key[:-reach] += rank[reach:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if new[-1] == len(rank) - 1 or reach * 2 >= len(rank):
            return order
        rank = np.empty_like(new)
        rank[order] = new
        reach *= 2


def common_prefixes(s: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """In text order, how far each suffix agrees with its predecessor in ``sa``, up to ``most``; eight bytes a step."""
    n = len(s)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    padded = np.zeros(n + most + 16, np.uint8)
    padded[:n] = s
    eight = np.ndarray((n + most + 8,), "<u8", padded.data, strides=(1,))
    plcp = np.zeros(n, np.int64)
    live = np.flatnonzero(before >= 0)
    for k in range(0, most, 8):
        differ = eight[live + k] ^ eight[before[live] + k]
        agree = np.full(len(live), 8)
        odd = np.flatnonzero(differ)
        low = differ[odd] & (~differ[odd] + np.uint64(1))
        agree[odd] = np.log2(low.astype(float)).astype(np.int64) // 8
        plcp[live] += agree
        live = live[differ == 0]
    return np.minimum(np.minimum(plcp, most), n - np.maximum(np.arange(n), before))


class Bytes(Kind):
    """Units are the bytes of the UTF-8 text."""

    def __init__(self, width: int = 100, gram: int = 40):
        self.width, self.gram = width, gram

    def split(self, text: bytes) -> bytes:
        return text

    def hashes(self, units: bytes) -> np.ndarray:
        return mix(np.frombuffer(units, np.uint8).astype(np.uint64) + np.uint64(1))

    def slice(self, units: bytes, a: int, b: int) -> bytes:
        return units[a:b]


class _Shard:
    """Suffix arrays over runs of whole anchors; equal windows share their anchor, so they meet in one array."""

    def __init__(self, width: int):
        self.width = width

    def __call__(self, batches):
        held, size, last = [], 0, None
        for b in batches:
            out = []
            for anchor, no, s, e, piece in zip(*(c.to_pylist() for c in b.columns)):
                if piece is None:
                    out.append((no, s, e))
                    continue
                if size > SHARD and anchor != last:
                    out += self.repeats(held)
                    held, size = [], 0
                held.append((no, s, piece))
                size, last = size + len(piece), anchor
            yield self.batch(out)
        yield self.batch(self.repeats(held))

    @staticmethod
    def batch(rows):
        cols = list(zip(*rows)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int32()))], names=["no", "s", "e"])

    def repeats(self, rows: list[tuple]) -> list[tuple]:
        """Spans of the windows that also start earlier, among these segments."""
        if not rows:
            return []
        rows = sorted(rows, key=lambda r: r[:2])  # places in order
        unlike, out = {}, []
        for r in rows:
            if unlike.setdefault(r[2], r)[:2] != r[:2]:
                out.append((r[0], r[1], r[1] + len(r[2])))
        rows = list(unlike.values())
        length = np.array([len(r[2]) for r in rows])
        first = np.cumsum(length + 1) - (length + 1)
        text = np.frombuffer(b"\0".join(r[2] for r in rows), np.uint8).astype(np.uint16) + 1
        text[first[1:] - 1] = 0  # parts segments; no byte of a text is that
        row = np.repeat(np.arange(len(rows)), length + 1)[:len(text)]
        inside = np.arange(len(text)) - first[row]
        whole = inside + self.width <= length[row]  # a window ends in its own segment
        sa = suffix_array(text)
        reach = common_prefixes(text, sa, self.width) >= self.width
        linked = reach[sa] & whole[sa]
        linked[1:] &= whole[sa[:-1]]
        linked[0] = False
        group = np.cumsum(~linked) - 1
        # where in the order of places: document, then start; one start of one document may come in two segments' rows
        known, doc = {}, []
        for r in rows:
            doc.append(known.setdefault(r[0], len(known)))
        place = (np.array(doc, np.int64)[row] << 32) + np.array([r[1] for r in rows], np.int64)[row] + inside
        least = np.minimum.reduceat(place[sa], np.flatnonzero(~linked))
        late = np.zeros(len(text), bool)
        late[sa] = place[sa] > least[group]
        late &= whole
        at = np.flatnonzero(late)
        if len(at):
            new = np.flatnonzero((at[1:] > at[:-1] + self.width) | (row[at[1:]] != row[at[:-1]]))
            for a, z in zip(at[np.concatenate([[0], new + 1])].tolist(), at[np.concatenate([new, [len(at) - 1]])].tolist()):
                no, s, _ = rows[row[a]]
                out.append((no, s + int(inside[a]), s + int(inside[z]) + self.width))
        return out


def _kept_bytes(units: bytes, spans: list[list[int]]) -> bytes:
    out, at = [], 0
    for a, z in spans:
        out.append(units[at:a])
        at = z
    return b"".join([*out, units[at:]])


def drop_repeated_bytes(docs: DataFrame, width: int = 100, texts: bool = False) -> DataFrame:
    """``strip_repeats`` over UTF-8 bytes: see there for the rows; ``kept`` is what remains, as bytes."""
    return strip_repeats(docs, Bytes(width), _Shard(width), _kept_bytes, texts=texts)


def byte_digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return drop_repeated_bytes(docs).withColumnRenamed("n", "n_bytes").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
