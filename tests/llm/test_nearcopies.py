"""Near copies on five-word shingles against all pairs by brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import nearcopies


def jaccard(a, b):
    s, t = ({" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if (w := (x or "").lower().split()) else set() for x in (a, b))
    return 1.0 if s == t else len(s & t) / len(s | t)


def test_short_near_copies(spark, tmp_path):
    r = random.Random(5)
    text = lambda n: [f"w{r.randrange(4000)}" for _ in range(n)]
    line = text(12)  # one line that many documents hold
    rows = []
    for g in range(60):
        base = text(r.randrange(30, 120)) + (line if g % 2 else [])
        for _ in range(r.randrange(1, 5)):
            w = list(base)
            for _ in range(r.randrange(0, 3)):
                w[r.randrange(len(w))] = "changed" + str(r.randrange(99))
            rows.append(" ".join(w))
    drift = text(60)  # a chain: neighbours are near, its ends are not
    for i in range(12):
        rows.append(" ".join(drift[2 * i:] + drift[:2 * i]))
    rows += ["", None, "One two", "one  TWO", "one three", rows[3]]
    sims = [(i, j, s) for i in range(len(rows)) for j in range(i) if (s := jaccard(rows[i], rows[j])) >= 0.8]
    assert sum(0.8 <= s < 0.95 for *_, s in sims) > 30  # what two bits of 64 do not find
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j, _ in sims:
        a, b = top(i), top(j)
        up[max(a, b)] = min(a, b)
    want = sorted(i for i in range(len(rows)) if top(i) == i)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.one_of_each_group(spark, docs.repartition(4), str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(x.doc_id for x in kept.select("doc_id").collect()) == want
    assert nearcopies.keep_one(docs.where("false")).count() == 0


def brute(rows):
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(rows[i], rows[j]) >= 0.8:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [i for i in range(len(rows)) if top(i) == i]


def test_large_group_makes_no_rows_of_all_pairs(spark, monkeypatch):
    """One text of which each document changes much: most share keys, many are in no link; blocks smaller than the group."""
    r = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for _ in range(150):
        w = list(base)
        for _ in range(r.randrange(0, 6)):
            w[r.randrange(len(w))] = f"own{r.randrange(10**6)}"
        rows.append(" ".join(w))
    rows += rows[:40] + [" ".join(base[:60] + [f"x{i}" for i in range(20)])]
    monkeypatch.setattr(nearcopies, "BLOCK", 16)
    made, verified = [], nearcopies._verified
    monkeypatch.setattr(nearcopies, "_verified", lambda pairs, *a: made.append(pairs.count()) or verified(pairs, *a))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert sorted(x.doc_id for x in nearcopies.keep_one(docs.repartition(3)).select("doc_id").collect()) == brute(rows)
    assert sum(made) < 1500  # of 150 * 149 / 2 pairs


def test_sketch_never_differs_more_than_the_sets():
    r, sets = random.Random(3), []
    find = nearcopies._Prefix(5, 4, 5, [], [])
    for n in (0, 3, 40, 400, 3000):
        w = [f"w{r.randrange(9**6)}" for _ in range(n)]
        for k in range(3):
            text = " ".join(w[:n - k * n // 12]).encode()
            sets.append((set(nearcopies.shingles(text, 5).tolist()), find(text)[2].view(np.uint64)))
    for s, a in sets:
        assert len(a) == nearcopies.LONGS
        for t, b in sets:
            assert int(np.bitwise_count(a ^ b).sum()) <= len(s ^ t)


def test_blocks_leave_the_same_pairs_as_a_join(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "BLOCK", 8)
    r, prefix, rows = random.Random(4), nearcopies._Prefix(5, 4, 5, [], []), []
    base = [f"b{i}" for i in range(90)]
    for i in range(60):
        w = list(base)
        for _ in range(r.randrange(0, 5)):
            w[r.randrange(len(w))] = f"own{r.randrange(10**6)}"
        rep, n, sketch, *_ = prefix(" ".join(w[:r.randrange(70, 90)]).encode())
        rows.append((rep, n, sketch.tolist(), i % 50))
    nodes = spark.createDataFrame(rows, "rep long, n long, sketch array<long>, comp long").dropDuplicates(["rep"])
    live = nodes.select(F.lit(1).cast("long").alias("key"), "rep", "comp")
    a, b = live.select(F.col("rep").alias("a"), F.col("comp").alias("c")), live.select(F.col("rep").alias("b"), F.col("comp").alias("d"))
    want = nearcopies._screened(a.crossJoin(b).where("a < b AND c <> d").select("a", "b"), nodes, 4, 5)
    found = nearcopies._in_blocks(live, nodes, 4, 5).collect()
    assert 0 < len(found) < 60 * 59 / 2 and sorted(found) == sorted(want.collect())


def test_counts_never_differ_more_than_the_sets():
    r, sets = random.Random(6), []
    find = nearcopies._Set(5)
    for n in (0, 3, 40, 400, 3000, 9000):
        w = [f"w{r.randrange(9**6)}" for _ in range(n)]
        for k in range(4):
            s, m, counts = find(" ".join(w[:n - k * n // 12]).encode())
            assert m == len(s)
            sets.append((set(s.tolist()), counts))
    far = 0
    for s, a in sets:
        for t, b in sets:
            apart = nearcopies._Alike._apart(a, b)
            assert apart == nearcopies._Alike._apart(b, a) <= len(s ^ t)
            far += apart > (len(s) + len(t)) / 9
    assert far > 200  # and they tell most apart
    same = np.full(2000, 1 << 40, np.uint64)  # places above 255 count as 255
    wide = [np.minimum(np.bincount((same >> np.uint64(32)).astype(np.int64) % p, minlength=p), 255).astype(np.uint8).tobytes() for p in (256, 512)]
    assert nearcopies._Alike._apart(*wide) == 0


def test_sets_of_long_texts_go_to_possible_pairs_only(spark, monkeypatch):
    """Long texts, half alike: sketches of odd counts are full, so only counts by place keep their sets from being sent to every pair."""
    r, rows = random.Random(8), []
    for i in range(18):
        half, own = [f"h{i // 3}x{k}" for k in range(3000)], [f"o{i}x{k}" for k in range(3000)]  # three share a half: not common in the sample
        rows.append(" ".join(half + own))
    rows += [" ".join(f"o{k}" for k in range(5000 - d)) for d in (0, 200)]
    r.shuffle(rows)
    asked, sent, paths, verified, cut, scratch = [], [], [], nearcopies._verified, nearcopies.cut, nearcopies.scratch
    monkeypatch.setattr(nearcopies, "_verified", lambda pairs, *a: asked.append(pairs.count()) or verified(pairs, *a))

    def counted(df, name="cut", *a):
        out = cut(df, name, *a)
        if name == "nearcopies-alike":
            sent.append(out.count())
        return out

    monkeypatch.setattr(nearcopies, "cut", counted)
    monkeypatch.setattr(nearcopies, "scratch", lambda *a: paths.append(scratch(*a)) or paths[-1])
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert sorted(x.doc_id for x in nearcopies.keep_one(docs.repartition(3)).select("doc_id").collect()) == brute(rows)
    assert sum(asked) >= 18 and 1 <= sum(sent) <= 3
    assert paths and not any(spark._jvm.java.io.File(p.removeprefix("file:")).exists() for p in paths)  # sets go when they are read


def test_grid_gives_the_first_pairs(spark, monkeypatch):
    """The first pairs that are verified are those of fingerprints within two bits, and join all of them; the rows are those of all pairs."""
    r, rows = random.Random(12), []
    for _ in range(5):
        base = [f"w{r.randrange(9**6)}" for _ in range(600)]
        for k in range(8):
            w = list(base)
            for _ in range(k):
                w[r.randrange(len(w))] = f"own{r.randrange(10**6)}"
            rows.append(" ".join(w))
    made, asked, verified = {}, [], nearcopies._verified
    for t in rows:
        rep, _, _, fp, *_ = nearcopies._Prefix(5, 4, 5, [], [])(t.encode())
        made[rep] = fp
    monkeypatch.setattr(nearcopies, "_verified", lambda pairs, *a: asked.append([tuple(p) for p in pairs.collect()]) or verified(pairs, *a))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert sorted(x.doc_id for x in nearcopies.keep_one(docs.repartition(3)).select("doc_id").collect()) == brute(rows)
    apart = lambda a, b: ((made[a] ^ made[b]) % (1 << 64)).bit_count()
    want = {(a, b) for a in made for b in made if a < b and apart(a, b) <= 2}
    assert asked[0] and set(asked[0]) <= want

    def groups(pairs):
        top = {a: a for a in made}
        for _ in made:
            for a, b in pairs:
                top[a] = top[b] = min(top[a], top[b])
        return top

    assert groups(asked[0]) == groups(want)
