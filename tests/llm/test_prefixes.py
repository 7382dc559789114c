"""The conversation trie against brute force; long, turnless, repeated and hot conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

from plumbline.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, depth int"


def brute(rows, width=None):
    own = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            r, x = r or "", x or ""
            d = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, d, (r, x)))
    own = {c: [y[3] for y in sorted(x)] for c, x in own.items()}
    full = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c / 20) * 20  # as SQL's remainder, with the sign of c
        full[c] = tuple(own.get(c - base, [])[:h] + x[h:])
    members = defaultdict(list)
    for c, x in full.items():
        for d in range(len(x) + 1):
            members[x[:d]].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, cs in members.items():
        words = len([w for w in p[-1][1].replace("\x0b", " ").replace("\x0c", " ").split() if w]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(cs) - 1) * words
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(full[c]) == len(p)))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def run(spark, rows):
    return sorted((tuple(r[c] for c in COLS) for r in prefixes.trie_digest(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def fixture():
    r = random.Random(3)
    rows = []
    for c in range(-25, 120):
        if c % 20 == 0 and c > 60:
            continue  # absent bases
        for t in range(r.choice([1, 2, 3, 3, 5, 9, 14])):
            rows.append((c, t, r.choice(["user", "assistant", None]), r.choice(["hi", "hello  there", "a b\tc", "", None]), 1))
    rows += [(200 + k, 0, "user", "same words here", 1) for k in range(60)]  # exact copies
    rows += [(300, t // 3, "user", f"long {t % 5}", 1) for t in range(400)]  # long, with ties
    rows += [(301, t // 3, "user", f"long {t % 5}", 1) for t in range(390)]
    rows += [(None, 1, "user", "nobody", 1), (400, None, "user", "null turn", 1), (400, 0, "user", "zero", 1), (400, 0, "user", "zero", 1), (7, 1, "user", "x", 1)]
    r.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = fixture()
    assert run(spark, rows) == brute(rows)


def test_width_does_not_matter(spark):
    rows = [x for x in fixture() if x[0] is not None and x[0] < 40]
    turns = prefixes.rebuilt(prefixes.positions(spark.createDataFrame(rows, SCHEMA)))
    one, seven = ({tuple(r) for r in prefixes.prefix_trie(turns, w).select(*COLS).collect()} for w in (1, 7))
    assert one == seven == set(brute(rows))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_turnless_conversations_make_a_root(spark):
    absent = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 1)
    rows = [(absent, 0, "user", "gone", 1)]
    assert run(spark, rows) == brute(rows) == [(absent, 0, None, 1, 0, 1, 0, hashlib.sha256(str(absent).encode()).hexdigest())]


def test_pieces_of_one_node_chain(spark, monkeypatch):
    """A node whose ends fill many pieces over many tasks has the hash of all of them."""
    rows = [(1000 + k, 0, "user", None, 1) for k in range(30_000)]
    want = brute(rows)
    got = run(spark, rows)
    assert got == want
