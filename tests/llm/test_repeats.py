"""Repeat removal against brute force, on planted and random repeats."""

import hashlib
import random

import numpy as np
import pytest

from plumbline.llm import factors, suffixes
from plumbline.llm.repeats import gram_hashes, segments


def brute(rows, width, units):
    """{(doc_id, text): (n, removed flags)}: a window is removed if it starts earlier in the order of places."""
    docs = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for d, t in docs:
        u = units(t)
        gone = [False] * len(u)
        for i in range(len(u) - width + 1):
            w = tuple(u[i:i + width])
            if w in seen:
                gone[i:i + width] = [True] * width
            seen.add(w)
        out[d, t] = (u, gone)
    return out


def texts(seed, width, alphabet, joiner):
    r = random.Random(seed)
    draw = lambda n: joiner.join(r.choice(alphabet) for _ in range(n))
    shared = [draw(width * 2), draw(width + 3), draw(width)]
    rows = []
    for i in range(60):
        t = joiner.join([draw(r.randrange(0, 2 * width)), r.choice(shared), draw(r.randrange(0, width)), r.choice([*shared, ""])])
        rows.append((i * 3 + 1, t))
    rows += [(1000 + i, rows[5][1]) for i in range(40)]  # a group of copies
    rows += [(2000, None), (2001, ""), (2002, joiner.join(["a"] * width * 4)), (2003, joiner.join(["a"] * (width - 1)))]
    rows += [rows[7], rows[7]]  # repeated rows
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [1000, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, monkeypatch, hot, seed):
    rows = texts(seed, 20, ["a", "b", "cc", "été", "d d"], " ")
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id")
    from plumbline.llm.repeats import strip_repeats
    got = strip_repeats(frame, factors.Words(), factors._Factor(20), factors._kept_words, hot=hot, texts=True).collect()
    want = brute(rows, 20, lambda t: t.encode().split())
    assert len(got) == len(rows)
    by_id = {d: v for (d, _), v in want.items()}
    for g in got:
        u, gone = by_id[g.doc_id]
        kept = b" ".join(x for x, z in zip(u, gone) if not z)
        assert (g.n, g.n_removed, bytes(g.kept)) == (len(u), sum(gone), kept), g.doc_id
        assert g.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [1000, 3])
def test_bytes(spark, hot):
    rows = texts(3, 100, ["ab", "é", "c", "x", "\n"], "")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    from plumbline.llm.repeats import strip_repeats
    got = strip_repeats(frame, suffixes.Bytes(), suffixes._Shard(100), suffixes._kept_bytes, hot=hot, texts=True).collect()
    by_id = {d: v for (d, _), v in brute(rows, 100, lambda t: list(t.encode())).items()}
    assert len(got) == len(rows)
    for g in got:
        u, gone = by_id[g.doc_id]
        kept = bytes(x for x, z in zip(u, gone) if not z)
        runs = sum(z and not p for z, p in zip(gone, [False, *gone]))
        assert (g.n, g.n_removed, g.n_spans, bytes(g.kept)) == (len(u), sum(gone), runs, kept), g.doc_id


def test_ties_and_empty(spark):
    t = " ".join(f"w{i}" for i in range(30))
    frame = spark.createDataFrame([(None, t), (5, t), (5, t + " more"), (6, None)], "doc_id long, text string").selectExpr("doc_id", "text", "1 as n", "'x' as sha", "2 as tie")
    got = {(r.doc_id, r.n_words): r.n_removed for r in factors.word_digest(frame).collect()}
    assert got == {(None, 30): 0, (5, 30): 30, (5, 31): 30, (6, 0): 0}
    assert factors.word_digest(frame.where("false")).count() == 0
    assert suffixes.byte_digest(frame.where("false")).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(1)
    for t in range(400):
        s = rng.integers(0, rng.integers(1, 5), rng.integers(0, 50)).astype(np.uint8)
        want = sorted(range(len(s)), key=lambda i: tuple(s[i:]))
        assert suffixes.suffix_array(s).tolist() == want
        if len(s) > 1:
            got = suffixes.common_prefixes(s, np.array(want), 16)
            for a, b in zip(want, want[1:]):
                n = next((k for k in range(16) if max(a, b) + k >= len(s) or s[a + k] != s[b + k]), 16)
                assert got[b] == n


def test_equal_windows_share_an_anchor():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 9, 150).astype(np.uint64)
    found = []
    for n in (0, 7, 300):
        u = np.concatenate([rng.integers(0, 9, n).astype(np.uint64), passage, rng.integers(0, 9, 50).astype(np.uint64)])
        a, s, e = segments(gram_hashes(u, 24), 100, 24)
        assert s[0] == 0 and e[-1] == len(u) and (s[1:] == e[:-1] - 99).all()
        window = {int(i): int(x) for x, lo, hi in zip(a, s, e) for i in range(lo, hi - 99)}
        found.append([window[n + i] for i in range(51)])
    assert found[0] == found[1] == found[2]


def test_rows_without_ids_keep_their_own_results(spark):
    """Many different texts of one (NULL) doc_id, and of one known doc_id: none gets another's result."""
    rows = [(d, " ".join(f"{d}w{k}x{i}" for i in range(25))) for d in (None, 7) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.kept_sha256 for r in factors.word_digest(frame).collect())
    assert got == sorted(hashlib.sha256(t.encode()).hexdigest() for _, t in rows)


def test_texts_may_hold_any_byte():
    """Segments with NUL bytes, against brute force: what parts segments is no byte of theirs."""
    r = random.Random(2)
    for _ in range(300):
        rows = [(d, 0, bytes(r.choice([0, 0, 0, 1, 255]) for _ in range(r.randrange(5, 14)))) for d in range(r.randrange(1, 8))]
        covered = {d: set() for d, *_ in rows}
        for d, a, z in suffixes._Shard(5).repeats(rows):
            covered[d] |= set(range(a, z))
        seen = set()
        for d, _, piece in rows:
            want = set()
            for i in range(len(piece) - 4):
                if piece[i:i + 5] in seen:
                    want |= set(range(i, i + 5))
                seen.add(piece[i:i + 5])
            assert covered[d] == want, rows
