import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import facts as FO
from plumbline.operators import pages as P
from plumbline.plans.gate_queries import RULES  # noqa: F401  (imports must work without data)

URL = "https://site.example/blog/target"
PAGE = f"""<html><head><title>T</title><meta property="og:image" content="http://i/x.jpg"></head><body>
<div class="post-outer"><h3 class="post-title entry-title"><a href="/other">Sibling</a></h3>Sibling says 150,000 metric tons.</div>
<div class="post-body-container"><a href="{URL}">self</a><div class="post-title-container"><h3 class="post-title entry-title">Target &amp; more</h3></div>
<div class="post-body entry-content"><style>x</style><p>A dosage range of 1.5 to 3 kg per  cubic meter<br>
works.</p><div class="comment-form">reply</div><h2>References</h2><ol><li><a href="https://doi.org/1">P</a></li><li>none</li><li><a href="https://www.epa.gov/a.pdf">E</a></li></ol>
<img src="/a.png" alt="Chart one"><img src="/logo.png"></div></div></body></html>"""


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame([(1, URL, PAGE), (2, URL, "<p>nothing</p>")], "page_id bigint, url string, html string")


def test_isolation_keeps_the_sibling_out(posts):
    rows = {r["page_id"]: r for r in P.isolate_main(posts).collect()}
    r = rows[1]
    assert (r["strategy"], r["title"]) == (1, "Target & more")
    assert "1.5 to 3 kg per cubic meter works." in r["canonical_text"]
    assert "150,000" not in r["canonical_text"] and "reply" not in r["canonical_text"]
    assert [q["page_id"] for q in P.quarantine(P.isolate_main(posts)).collect()] == [2]


def test_elements(posts):
    ex = P.html_extract(posts)
    cites = [(c["marker"], c["kind"]) for c in P.extract_citations(ex).orderBy("marker").collect()]
    assert cites == [(1, "paper"), (2, "standard")]
    assert [i["alt"] for i in P.content_images(ex).collect()] == ["Chart one"]
    assert [(f["url"], f["caption"]) for f in P.page_figures(ex).collect()] == [("https://site.example/a.png", "Chart one")]
    assert [(s["image"], s["title"]) for s in P.social_preview(ex).collect()] == [("http://i/x.jpg", "T")]
    assert P.authority_links(ex).count() == 2


def test_strict_link_kinds(spark):
    from plumbline.functions import links as L
    df = spark.createDataFrame([("https://not-nature.com/x",)], "u string")
    assert tuple(df.select(L.classify_link("u"), L.classify_link("u", strict=True)).first()) == ("paper", "web")


TEXT = "A dosage range of 1.5 to 3 kg per cubic meter is common. It’s safe. No number here."


def test_fact_gate(spark):
    facts = spark.createDataFrame([
        (1, "f1", "dosage range of 1.5 to 3 kg  per cubic meter", "1.5-3"), (1, "f2", "reduces nitrate by 150 mg/L", "150"),
        (1, "f3", "It's safe", "0"), (1, "f4", "it's SAFE", "high"), (1, "f5", " ", "1")], "doc_id bigint, id string, quote string, value string")
    docs = spark.createDataFrame([(1, TEXT)], "doc_id bigint, text string")
    got = {r["id"]: (r["status"], r["reason"], r["char_offset"]) for r in FO.gate_facts(facts, docs).collect()}
    assert got["f1"] == ("kept", None, 2)
    assert got["f2"][:2] == ("dropped", "not located in canonical text")
    assert got["f3"][:2] == ("dropped", "value digits not inside the quote")
    assert got["f4"][0] == "kept" and got["f5"][1] == "not located in canonical text"


def test_find_quotes_equals_brute_force_for_any_length(spark):
    rnd = random.Random(3)
    words = ["alpha", "be", "c", "delta", "eps"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 30)))) for i in range(60)]
    docs += [(100 + i, docs[0][1]) for i in range(20)]  # copies
    quotes = [(i, docs[rnd.randrange(60)][1][rnd.randint(0, 5):][:rnd.randint(1, 60)]) for i in range(60)] + [(900, "zz"), (901, quotes_blank := " ")]
    got = {(r["item_id"], r["doc_id"], r["char_offset"]) for r in FO.find_quotes(
        spark.createDataFrame(quotes, "item_id bigint, text string"), spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    norm = lambda s: " ".join(s.lower().split())
    want = {(i, d, norm(t).find(norm(q))) for i, q in quotes if norm(q) for d, t in docs if norm(q) in norm(t)}
    assert got == want and quotes_blank.strip() == ""


def test_tiers(spark):
    art = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, "x"), (5, "none")], "article_id bigint, category string")
    F4 = "article_id bigint, value string, unit string, claim string"
    model = spark.createDataFrame([(1, "1", "%", c) for c in "abc"] + [(2, "1", "%", "a")], F4)
    mined = spark.createDataFrame([(2, "1", "%", c) for c in "abc"] + [(3, "2", "%", "m")], F4)
    qual = spark.createDataFrame([(3, "p"), (3, "q")], "article_id bigint, claim string")
    tpl = spark.createDataFrame([("x", "t1"), ("x", "t2")], "category string, claim string")
    facts, meta = FO.tiered_facts(art, model, mined, qual, tpl)
    got = {r["article_id"]: (r["tier_used"], r["numeric_count"], r["fell_back"], r["error"] is not None) for r in meta.collect()}
    assert got == {1: (1, 3, False, False), 2: (1, 3, False, False), 3: (3, 0, False, False), 4: (4, 0, True, False), 5: (None, 0, False, True)}
    n = {r["article_id"]: r["n"] for r in facts.groupBy("article_id").agg(F.count("*").alias("n")).collect()}
    assert n == {1: 3, 2: 3, 3: 3, 4: 2}
