"""The whole result of the language query against plain piece counts and plain forward sums, word by word."""

import math
import random
import zlib
from collections import Counter

import pytest
import regex

from plumbline.llm import language, tokens


def test_rows_by_brute_force(spark):
    path = tokens.vocabulary_path("piece_bpe_32k.model")
    pieces = language.vocabulary(path)
    place = {p: i for i, p in enumerate(pieces)}
    assert len(place) == len(pieces)
    r = random.Random(23)
    parts = {"aa": ["tion", "ing", "é", "the"], "bb": ["ung", "sch", "the", "ing"], "cc": ["日", "本", "の", "ж"]}
    rows = [(i, " ".join("".join(r.choice(parts[k]) for _ in range(r.randrange(1, 5))) for _ in range(r.randrange(1, 5))).title(), k) for i, k in enumerate(["aa", "bb", "cc"] * 30)]
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 + 3", "cc"), (203, "theing", None), (203, "theing", None), (None, "Schung", "bb"), (204, "ქართული 12x", None)]
    held = [i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows]
    words = [regex.findall(r"\p{L}[\p{L}\p{M}]*", (t or "").lower()) for _, t, _ in rows]
    assert max(len(w) for ws in words for w in ws) < 24

    counts = {k: Counter() for k in ("aa", "bb", "cc")}
    for (_, text, lang), out, ws in zip(rows, held, words):
        if lang and not out:
            for w in ws:
                w = "▁" + w
                counts[lang].update(place[w[a:b]] for a in range(len(w)) for b in range(a + 1, len(w) + 1) if w[a:b] in place)
    total = {k: sum(c.values()) + 0.5 * (len(pieces) + 1) for k, c in counts.items()}

    def likelihood(w, k):
        forward = [1.0] + [0.0] * len(w)
        for a in range(len(w)):
            for b in range(a + 1, len(w) + 1):
                if w[a:b] in place:
                    forward[b] += forward[a] * (counts[k][place[w[a:b]]] + 0.5) / total[k]
                elif b == a + 1:
                    forward[b] += forward[a] * 0.5 / total[k]
        return math.log(forward[-1])

    want = []
    for (i, _, _), out, ws in zip(rows, held, words):
        logs = {k: sum(likelihood("▁" + w, k) for w in ws) for k in counts}
        best = max(sorted(logs), key=logs.get)
        want.append((str(i), out, best if ws else "und", 1 / sum(math.exp(x - logs[best]) for x in logs.values()) if ws else 0.0))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' as lang_pred")
    got = [(str(x.doc_id), x.held_out, x.lang_pred, x.score) for x in language.predictions(frame, path).collect()]
    assert [x[:3] for x in sorted(got)] == [x[:3] for x in sorted(want)]
    for g, w in zip(sorted(got), sorted(want)):
        assert g[3] == pytest.approx(w[3], abs=1e-9)
    assert language.predictions(frame.where("false"), path).count() == 0
