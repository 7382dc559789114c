"""Anchors travel packed, once for each text that has them, and are counted as plain counting does."""

from collections import Counter

import numpy as np
import pyarrow as pa

from plumbline.llm.repeats import _Anchors, _Live
from plumbline.llm.suffixes import Bytes


def test_packed_anchors_are_counted_whole():
    rng, kind = np.random.default_rng(5), Bytes()
    words = [bytes(rng.integers(97, 123, 9).astype(np.uint8)) for _ in range(60)]
    line = b" ".join(words[:20]) + b"\n"
    texts = [b" ".join(words[i] for i in rng.integers(0, 60, 80)) + line * int(rng.integers(0, 4)) for _ in range(200)] + [b"", b"short", line * 500]
    nos = [i * (1 << 33) + 7 * i for i in range(len(texts))]
    batches = [pa.RecordBatch.from_arrays([pa.array(nos[i:i + 64]), pa.array(texts[i:i + 64], pa.binary())], names=["no", "text"]) for i in range(0, len(texts), 64)]
    packs = list(_Anchors(kind)(batches))
    every, of = Counter(), {}
    for no, t in zip(nos, texts):
        found = kind.segments(t)[0].tolist()
        every.update(found)
        of[no] = set(found)
    assert sum(len(x) for p in packs for x in p.column(1).to_pylist()) == 8 * sum(map(len, of.values())) < 8 * sum(every.values())
    rows = sorted(r for p in packs for r in zip(*(c.to_pylist() for c in p.columns)))
    cut = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["part", "anchors", "more"])
    got = sorted(r for b in _Live(100)([cut]) for r in zip(*(c.to_pylist() for c in b.columns)))
    assert got == sorted((no, a, every[a] > 100) for no, found in of.items() for a in found if every[a] > 1)
    assert any(hot for _, _, hot in got) and not all(hot for _, _, hot in got)
