"""Token ids laid out by runs: against the library, over small tables of known words and odd white space."""

import random

import numpy as np
import pyarrow as pa

from plumbline.llm import tokens


def _texts():
    rng = random.Random(5)
    words = ["the", "thes", "hend,", "on.\nBy", "don't", "é́tat", "12", "日本語", "a\tb", "\x00", "x\x1cy", "\n", "", " ", "end\n", "\rz", "...", "🙂", "ÿ", "."]
    return ["", " ", "  the", "the ", ",", "a" * 500] + [" ".join(rng.choice(words) for _ in range(rng.randrange(12))) for _ in range(400)]


def test_runs_of_words():
    with open(tokens.vocabulary_path()) as f:
        t = tokens._loaded(f.read())[0]
    texts = _texts()
    for most in (0, 3, 1000):  # the table of words is thrown away and kept
        known = tokens._Words(t, "<u2", most)
        got = []
        for lo in range(0, len(texts), 37):
            got += known.texts(pa.array(texts[lo:lo + 37]), b"\0\0")
        for text, ids in zip(texts, got):
            assert np.frombuffer(ids, "<u2").tolist() == [*t.encode(text, add_special_tokens=False).ids, 0], repr(text)


def test_batches_with_marks_and_nulls():
    with open(tokens.vocabulary_path()) as f:
        spec = f.read()
    t = tokens._loaded(spec)[0]
    texts = [None, "it<|endoftext|> is", "plain words", "  ", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = pa.Table.from_batches(tokens._Tokenize(spec, 7)([batch.slice(0, 0), batch, batch.slice(2, 2)]))
    want = [[*t.encode(x or "", add_special_tokens=False).ids, 7] for x in texts]
    assert [np.frombuffer(x, "<u2").tolist() for x in out.column("ids").to_pylist()] == want + want[2:4]


def test_rows_packed_together():
    rng = np.random.default_rng(3)
    for top in (1 << 8, 1 << 16, 1 << 32):
        n = np.array([0, 1, 4, 0, 5, 1000, 3, 0])
        v = rng.integers(0, top, n.sum(), dtype=np.uint32)
        control, c, data, d = tokens.pack_rows(v, n)
        assert (tokens.unpack_rows(control, data, n) == v).all()
        at = 0
        for k in range(len(n)):
            alone = tokens.pack(v[at:at + n[k]])
            assert alone == (control[c[:k].sum():c[:k + 1].sum()].tobytes(), data[d[:k].sum():d[:k + 1].sum()].tobytes())
            at += n[k]


def test_runs_cover_all_rows():
    assert list(tokens._runs(np.array([], np.int64), 5)) == []
    assert list(tokens._runs(np.array([9, 0, 2, 3, 1, 7]), 5)) == [(0, 1), (1, 4), (4, 5), (5, 6)]
