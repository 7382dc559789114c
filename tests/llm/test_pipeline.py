"""The pipeline stage by stage on planted documents, and the registered queries on the smallest tables."""

import random
import zlib

import numpy as np

import corpus_pipeline
from plumbline.llm import queries, tokens


def planted(spark, folder):
    r = random.Random(11)
    words = [a + b for a in ["ba", "ke", "li", "mo", "nu", "ra", "so", "ti"] for b in ["n", "ld", "rt", "s", "m", "ck", "x", "z"]]
    text = lambda n: " ".join(r.choice(words) + str(r.randrange(30)) for _ in range(n))
    item = text(25)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        t = text(r.randrange(30, 90)) + (" vile nasty awful vile" if toxic else "")
        rows.append((i, t, "en", f"s{i % 4}" if i % 9 else None, len(t)))
        labels.append((i, 1, int(toxic)))
    near = text(600).split()
    for i in range(6):
        w = list(near)
        w[100 * i] = "other"
        rows.append((500 + i, " ".join(w), "en", "s1", 0))
    rows += [(600 + i, rows[7][1], "en", "s2", 0) for i in range(3)]
    rows += [(700 + i, text(20) + " " + item[10:] + " " + text(20), "en", "s3", 0) for i in range(4)]
    rows += [(800, None, None, None, None), (801, "", "en", "s0", 0), rows[8], rows[8]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_stages(spark, tmp_path):
    rows = planted(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out-{name}")
        docs = out[name] = spark.read.parquet(f"{tmp_path}/out-{name}")
        assert name == "tokens" or docs.columns == columns
    ids = {name: sorted(x[0] for x in df.select("doc_id").collect()) for name, df in out.items()}
    clean = sorted(x[0] for x in rows if not (x[0] < 400 and x[0] % 5 == 0))
    assert ids["toxicity"] == clean
    gone = {501, 502, 503, 504, 505, 600, 601, 602, 801}  # 800 and 801 have fingerprint zero, 600 on copy a clean document
    assert ids["near_duplicates"] == sorted(set(clean) - gone)
    assert ids["decontaminate"] == [i for i in ids["near_duplicates"] if not 700 <= i < 704]
    of = {x[0]: x[1] for x in rows}
    size = {}
    for d, _, _, s, _ in [x for x in rows if x[0] in set(ids["decontaminate"])][:]:
        size.setdefault(s, {})[d] = len((of[d] or "").split())
    taken = {}
    for x in out["mixing"].collect():
        rest = iter((of[x.doc_id] or "").split())
        assert all(w in rest for w in x.text.split()) and x.n_chars == len(x.text)  # taken words stand in order
        taken[x.source] = taken.get(x.source, 0) + len(x.text.split())
    total = sum(sum(v.values()) for v in size.values())
    assert abs(sum(taken.values()) - 1.5 * total) <= 64 * len(size)
    assert all(taken[s] <= 2 * sum(v.values()) for s, v in size.items() if s in taken)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_path())
    want = sorted((x.doc_id, zlib.crc32(np.array([*t.encode(x.text, add_special_tokens=False).ids, 0], "<u4").tobytes())) for x in out["mixing"].collect())
    assert sorted((x.doc_id, x.ids_crc32) for x in out["tokens"].collect()) == want
    assert sorted((x.doc_id, x.ids_crc32) for x in corpus_pipeline.run(spark, str(tmp_path)).collect()) == want


def test_names():
    assert {"pipeline", *(n.split("_")[0] for n in queries.QUERIES if n != "pipeline")} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
