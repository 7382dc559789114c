"""Substring dedup over words by relative Lempel-Ziv parsing against indexed reference blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from plumbline.llm.repeats import Kind, strip_repeats


class Words(Kind):
    """Units are the runs between ASCII white space, unchanged."""

    def __init__(self, width: int = 20, gram: int = 7):
        self.width, self.gram = width, gram

    def split(self, text: bytes) -> list[bytes]:
        return text.split()

    def hashes(self, units: list[bytes]) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(w) for w in units], np.uint64)

    def slice(self, units: list[bytes], a: int, b: int) -> bytes:
        return b" ".join(units[a:b])


class Reference:
    """A reference block: earlier segments, indexed by each run of ``width`` words."""

    def __init__(self, width: int):
        self.width, self.index, self.texts = width, {}, []

    def parse(self, ws: list[bytes]) -> list[tuple[int, int]]:
        """Greedy factors of at least ``width`` words that also start earlier in the block; then ``ws`` joins the block.

        A factor is extended as far as its reference goes. Words beyond it may still end a run that crosses the
        factor's border and stands elsewhere, so parsing goes on with the first run that is not inside the factor.
        A run enters the index once it is passed, so a text also repeats itself.
        """
        n, width, me, out, j = len(ws), self.width, len(self.texts), [], 0
        at = np.cumsum([0, *(len(w) + 1 for w in ws)]).tolist()
        line = b" ".join(ws)
        self.texts.append(ws)
        while j + width <= n:
            run = line[at[j]:at[j + width] - 1]
            known = self.index.get(run)
            if known is None:
                self.index[run] = me, j
                j += 1
                continue
            ref, o = self.texts[known[0]], known[1]
            length = width
            while j + length < n and o + length < len(ref) and ref[o + length] == ws[j + length]:
                length += 1
            out.append((j, j + length))
            j += length - width + 1
        return out


class _Factor:
    """One reference block per anchor: equal runs share their anchor, and rows come sorted by anchor and place."""

    def __init__(self, width: int):
        self.width = width

    def __call__(self, batches):
        anchor, block = None, Reference(self.width)
        for b in batches:
            rows = []
            for a, no, s, e, piece in zip(*(c.to_pylist() for c in b.columns)):
                if piece is None:
                    rows.append((no, s, e))
                    continue
                if a != anchor:
                    anchor, block = a, Reference(self.width)
                rows += [(no, s + x, s + z) for x, z in block.parse(piece.split())]
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int32()))], names=["no", "s", "e"])


def _kept_words(units: list[bytes], spans: list[list[int]]) -> bytes:
    out, at = [], 0
    for a, z in spans:
        out += units[at:a]
        at = z
    return b" ".join(out + units[at:])


def drop_repeated_words(docs: DataFrame, width: int = 20, texts: bool = False) -> DataFrame:
    """``strip_repeats`` over words: see there for the rows; kept words are joined by one space.

    Factors are found by greedy parsing; a text shorter than ``width`` words keeps all.
    """
    return strip_repeats(docs, Words(width), _Factor(width), _kept_words, texts=texts)


def word_digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    return drop_repeated_words(docs).withColumnRenamed("n", "n_words").select("doc_id", "n_words", "n_removed", "kept_sha256")
