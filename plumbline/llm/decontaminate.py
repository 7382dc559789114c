"""Benchmark decontamination by Wu-Manber search for word windows."""

from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import per_text
from plumbline.session import cut

#: Word bytes stay (A-Z in lower case), all other bytes part words.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_FOLD).split()


class WuManber:
    """All windows of the items, searched by words.

    Per window length: ``shift`` tells for the two words that end a position how far the search may move on; where it
    is zero, the suffix bucket of these two words, split by the window's first word, names the windows to compare.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int):
        owners: dict[tuple, list[str]] = defaultdict(list)
        for item, ws in items:
            for k in range(max(1, len(ws) - width + 1) if ws else 0):
                w = tuple(ws[k:k + width])
                if not owners[w] or owners[w][-1] != item:
                    owners[w].append(item)
        by_length: dict[int, list[tuple]] = defaultdict(list)
        for w in owners:
            by_length[len(w)].append(w)
        self.owners, self.tables = dict(owners), []
        for m, windows in sorted(by_length.items()):
            block = min(2, m)
            shift: dict[tuple, int] = {}
            buckets: dict[tuple, dict[bytes, list[tuple]]] = defaultdict(lambda: defaultdict(list))
            for w in windows:
                for j in range(block, m + 1):
                    b = w[j - block:j]
                    shift[b] = min(shift.get(b, m), m - j)
                buckets[w[m - block:]][w[0]].append(w)
            self.tables.append((m, block, m - block + 1, shift, {k: dict(v) for k, v in buckets.items()}))

    def search(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(start, end) of every occurrence, and the items whose windows occur."""
        found, hit = [], set()
        n = len(ws)
        for m, block, skip, shift, buckets in self.tables:
            i, get = m, shift.get
            while i <= n:
                step = get(tuple(ws[i - block:i]), skip)
                if step:
                    i += step
                    continue
                for w in buckets[tuple(ws[i - block:i])].get(ws[i - m], ()):
                    if tuple(ws[i - m:i]) == w:
                        found.append((i - m, i))
                        hit.update(self.owners[w])
                i += 1
        return found, hit


class _Search:
    """Built once per worker from the broadcast items."""

    _built: dict[str, WuManber] = {}

    def __init__(self, items, key: str, width: int):
        self.items, self.key, self.width = items, key, width

    def __call__(self, text: bytes) -> tuple:
        if self.key not in self._built:
            self._built.clear()
            self._built[self.key] = WuManber([(i, words(t)) for i, t in self.items.value], self.width)
        ws = words(text)
        spans, hit = self._built[self.key].search(ws)
        out, end = [], -1
        for a, b in sorted(spans):
            if a <= end:
                out[-1] = end = max(end, b)
            else:
                out += [a, b]
                end = b
        return len(ws), out, sorted(hit - {None})


def search_items(docs: DataFrame, items: DataFrame, width: int = 10, block_bytes: int = 64 << 20, out: list[str] | None = None) -> DataFrame:
    """Documents (columns ``out``, all by default) with ``n_words``, ``hit_spans`` (flat starts and ends, in words) and ``hit_items``.

    ``items`` (item_id, text) is searched for in blocks of about ``block_bytes`` of text each, so what is broadcast
    stays bounded however many items there are; each block is one pass over the documents without a shuffle.
    A NULL text has no words, an item without words no window; equal windows of several items count for each; an item
    with NULL item_id is searched for like any other, but names no item.
    Repeated rows are searched each on its own. Extra columns pass through; names starting with ``__`` are reserved.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).head()[0]
    blocks = max(1, -(-size // block_bytes))
    mine = docs.drop("n_words", "hit_spans", "hit_items")
    out = [c for c in out or docs.columns if c in mine.columns]
    state = mine.withColumns({"__spans": F.array().cast("array<array<int>>"), "__items": F.array().cast("array<array<string>>")})
    for k in range(blocks):
        part = [(r[0], bytes(r[1])) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).select("item_id", F.col("text").cast("binary")).toLocalIterator()]
        tables = spark.sparkContext.broadcast(part)
        key = hashlib.sha256(repr((width, part)).encode()).hexdigest()
        state = per_text(state, _Search(tables, key, width), "n_words long, __s array<int>, __i array<string>", [*(out if k + 1 == blocks else mine.columns), "__spans", "__items"])
        state = state.withColumns({"__spans": F.concat("__spans", F.array("__s")), "__items": F.concat("__items", F.array("__i"))}).drop("__s", "__i")
        if k + 1 < blocks:
            state = cut(state.drop("n_words"), "decontaminate")
    return state.withColumn("hit_items", F.array_sort(F.array_distinct(F.flatten("__items")))).withColumn("hit_spans", _union(F.col("__spans"), blocks)).drop("__spans", "__items")


def _union(spans, blocks: int):
    """Flat start, end, start, end ... of the union of several such lists."""
    if blocks == 1:
        return spans[0]
    pairs = F.array_sort(F.flatten(F.transform(spans, _pairs)))
    empty = F.array().cast("array<int>")
    return F.aggregate(pairs, empty, lambda acc, p: F.when((F.size(acc) > 0) & (p.a <= F.element_at(acc, -1)), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.greatest(F.element_at(acc, -1), p.b)))).otherwise(F.concat(acc, F.array(p.a, p.b))))


def _pairs(s):
    return F.transform(F.filter(s, lambda x, i: i % 2 == 0), lambda a, k: F.struct(a.alias("a"), F.get(s, 2 * k + 1).alias("b")))


def contaminated(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = search_items(docs.select("doc_id", "text"), items, width, out=["doc_id"])
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, x: x - acc)  # ends minus starts, by alternating signs
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The documents in which no window of any item occurs, with their own columns."""
    return search_items(docs, items, width).where(F.size("hit_spans") == 0).select(*docs.columns)
