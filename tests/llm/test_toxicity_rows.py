"""The whole result of the toxicity query against a plain computation of terms, idf, cosines and votes."""

import math
import random
import zlib
from collections import Counter

import pytest

from plumbline.llm import toxicity


def test_rows_by_brute_force(spark):
    r = random.Random(19)
    plain, bad = [f"w{i}" for i in range(80)], ["vile", "nasty", "awful", "grim"]
    rows = []
    for i in range(300):
        w = [r.choice(plain) for _ in range(r.randrange(4, 30))] + [r.choice(bad) for _ in range(r.randrange(1, 5) if i % 4 == 0 else 0)]
        rows.append((i, " ".join(r.sample(w, len(w)))))
    rows += [(400, None), (401, ""), (402, "grim"), (402, "grim"), (None, "vile nasty"), (403, "unseen words")]
    labels = {i: int(i % 4 == 0) for i in range(280)}
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in rows if i is not None}
    words = [toxicity.words((t or "").encode()) for _, t in rows]

    examples = {}  # text -> (smallest id, label); equal texts are one
    for (i, t), ws in zip(rows, words):
        if i in labels and not held[i]:
            at, toxic, _ = examples.get(t, (i, 0, ws))
            examples[t] = (min(at, i), max(toxic, labels[i]), ws)
    pos, neg = sum(x[1] for x in examples.values()), sum(not x[1] for x in examples.values())
    by = {k: Counter(t for _, toxic, ws in examples.values() if toxic == k for t in set(ws)) for k in (0, 1)}
    kept = set()
    for t in by[1]:
        p, q = by[1][t] / pos, by[0][t] / neg
        if by[1][t] >= by[0][t] and (p - q) / math.sqrt(p * (1 - p) / pos + q * (1 - q) / neg + 1e-12) >= 3:
            kept.add(t)
    assert len(kept) >= 4
    df = Counter(t for ws in words for t in set(ws))
    idf = {t: math.log((1 + len(rows)) / (1 + df[t])) + 1 for t in kept}

    def vector(ws):
        v = {t: (1 + math.log(n)) * idf[t] for t, n in Counter(w for w in ws if w in kept).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    vectors = sorted((at, toxic, vector(ws)) for at, toxic, ws in examples.values())
    bare = [toxic for _, toxic, v in vectors if not v]
    base = min((sum(bare) + 0.5) / (len(bare) + 10), 0.5)
    want = []
    for (i, _), ws in zip(rows, words):
        v = vector(ws)
        near = [(round(sum(x * u.get(t, 0) for t, x in v.items()), 12), at, toxic) for at, toxic, u in vectors]
        near = sorted([x for x in near if x[0] > 0], key=lambda x: (-x[0], x[1]))[:15]
        score = (sum(s * toxic for s, _, toxic in near) + base) / (sum(s for s, _, _ in near) + 1)
        want.append((str(i), held.get(i, False), [at for _, at, _ in near], score))

    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    got = [(str(x.doc_id), x.held_out, list(x.evidence), x.score, x.predicted) for x in toxicity.toxicity(frame, marks).collect()]
    assert [x[:3] for x in sorted(got)] == [x[:3] for x in sorted(want)]
    for g, w in zip(sorted(got), sorted(want)):
        assert g[3] == pytest.approx(w[3], abs=1e-9) and g[4] == int(g[3] >= 0.7)
