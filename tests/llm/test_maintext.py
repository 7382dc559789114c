"""Main text: held-out accuracy, the field against brute force over all paths, broken pages, edges."""

import itertools
import math
import random

import numpy as np
import pytest

from plumbline.llm import crf, maintext
from plumbline.llm.leafblocks import leaf_blocks

HEAD = "<html><head><title>T &amp; t</title><style>p{}</style><script>var t='</p>';</script></head><body>"


def page(title, paragraphs, more=""):
    return (f"{HEAD}<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><!-- ad --><div class='ad'>Buy this. Really now.</div><article><h1>{title}</h1>"
            + "".join(f"<p>{p}</p>" for p in paragraphs) + f"{more}</article><footer>&copy; us &middot; All rights.</footer></body></html>")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"u{i}", page(f"Title {i}", [f"Some words of page {i}, and more of them.", "A second &lt;one&gt; here."]), 7) for i in range(40)]
    rows += [(100, None, None, 1), (101, "e", "", 1), (102, "t", "plain", 1), (None, None, None, None), rows[3], rows[3]]
    return spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int").selectExpr("*", "page_id as text")


@pytest.fixture(scope="module")
def extractor(pages):
    return maintext.train(pages, made=300)


def test_query_rows(spark, pages, extractor):
    got = maintext.main_text(pages, extractor).collect()
    assert got[0].__fields__ == ["page_id", "url", "text", "n_chars"] and len(got) == 46
    for r in got:
        if r.page_id is not None and r.page_id < 100:
            assert r.text == f"Title {r.page_id}\nSome words of page {r.page_id}, and more of them.\nA second <one> here."
            assert r.n_chars == len(r.text)
        elif r.page_id != 102:
            assert (r.text, r.n_chars) == ("", 0)


def test_empty_table_trains_and_runs(spark, pages):
    assert maintext.main_text(pages.limit(0)).collect() == []


def test_held_out_layouts(extractor):
    """Pages of other draws; a field trained without them labels nearly every block."""
    pages = maintext.made_pages(200, seed=12345)
    wrong = total = 0
    for steps, labels in pages:
        got = extractor.chain.decode([extractor.chain.odds(fs) for fs, _ in steps], [k for _, k in steps])
        wrong += sum(a != b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert wrong / total < 0.01


def test_article_without_its_notices_and_comments(extractor):
    more = '<div class="cookie-notice"><p>We use cookies.</p></div><p>Last words of it, written in full.</p><ol class="comments"><li><p>First! I agree with this, really.</p></ol>'
    got = extractor.text(page("A Title", ["One sentence, then another one. And more."] * 3, more))
    assert got == "A Title\n" + "One sentence, then another one. And more.\n" * 3 + "Last words of it, written in full."
    plain = f"{HEAD}<div id='top-menu'><ul><li><a href=/>Home</a></ul></div><div class='post-body'><h1>Words</h1><p>{'A long sentence, with a comma. ' * 9}</p><p>More, and more of it.</p></div><div class='sidebar'><h3>Tags</h3></div>"
    assert extractor.text(plain) == "Words\n" + ("A long sentence, with a comma. " * 9).strip() + "\nMore, and more of it."


def test_field_against_all_paths():
    """Viterbi is the best of all paths, and the fit's gradient vanishes: expected label and move counts equal the seen ones."""
    r = random.Random(1)
    chains = [([([f"f{r.randrange(6)}", f"g{r.randrange(3)}"], r.randrange(2)) for _ in range(n)], [r.randrange(2) for _ in range(n)]) for n in (1, 2, 5, 6, 6, 7)]
    fitted = crf.fit(chains, rounds=1500, rate=0.05)

    def score(steps, path):
        s = sum(fitted.odds(fs) for (fs, _), y in zip(steps, path, strict=True) if y)
        return s + sum(fitted.moves[steps[t][1], path[t - 1], path[t]] for t in range(1, len(path)))

    expected, seen = {}, {}
    for steps, labels in chains:
        paths = list(itertools.product((0, 1), repeat=len(steps)))
        scores = [score(steps, p) for p in paths]
        best = fitted.decode([fitted.odds(fs) for fs, _ in steps], [k for _, k in steps])
        assert math.isclose(score(steps, best), max(scores), abs_tol=1e-9)
        share = np.exp(np.array(scores) - np.logaddexp.reduce(scores))
        for p, w in zip([*paths, tuple(labels)], [*share, None], strict=True):
            into, w = (seen, 1) if w is None else (expected, w)
            for t, (fs, k) in enumerate(steps):
                for f in fs if p[t] else ():
                    into[f] = into.get(f, 0) + w
                if t:
                    into[k, p[t - 1], p[t]] = into.get((k, p[t - 1], p[t]), 0) + w
    for f in expected:
        x = fitted.weight[f] if isinstance(f, str) else fitted.moves[f]
        assert abs(expected[f] - seen.get(f, 0) + 0.02 * x) < 0.02, f


def test_leaf_blocks_of_broken_pages():
    texts = lambda h: [b.text for b in leaf_blocks(h)]
    assert texts("a<p>b<p><b>c<br>d<p>e</div>f") == ["a", "b", "c d", "e", "f"]
    assert texts("<p title='x>y'>one</p><p title=\"never closed") == ["one"]
    assert texts("x <!-- c > <p>no</p> --> y <!-- open") == ["x y"]
    assert texts("<script>if (a<b) '</p>'</script >z<style>q") == ["z"]
    assert texts("1 < 2 &amp;&lt;b&gt; &nosuch; &#233;") == ["1 < 2 &<b> &nosuch; é"]
    assert texts("<li>a<li>b<table><tr><td>c<td>d<tr><td>e</table>") == ["a", "b", "c", "d", "e"]
    assert texts("") == texts("<!doctype html>") == []
    assert [b.linked for b in leaf_blocks("<p><a href=x>abc</a>de<p>f")] == [3, 0]


def test_long_and_deep_pages_are_linear(extractor):
    assert extractor.text("<div>" * 100_000 + "deep") in ("", "deep")
    many = "".join(f"<p>Paragraph {i} of a long article, with words enough to be one.</p>" for i in range(20_000))
    assert extractor.text(f"<article><h1>Long</h1>{many}</article>").count("\n") == 20_000
    assert extractor.text("<a '" * 50_000) == "" and leaf_blocks("<a =\"" * 50_000) == []
