"""Character references that a cut text leaves open, and pages in small parts."""

from plumbline.functions import markup as M
from plumbline.operators import pages as P
from plumbline.streaming import jobs as J


def test_closed_only():
    html = '<p title="a&amp b&lt;">x &amp;&amp <b>&quo</b> &notit; &#65; &#66 &copy;</p>﷐'
    node = M.parse_closed(html).first("p")
    assert node.text() == "x &&amp &quo &notit; A &#66 ©" and node.get("title") == "a&amp b<"
    assert html[node.inner:node.close] == "x &amp;&amp <b>&quo</b> &notit; &#65; &#66 &copy;"
    assert M.parse(html).first("p").text() == "x && &quo ¬it; A B ©"


def test_same_text_by_both_paths(spark):
    body = "<h1>Cut &amp;&amp</h1><p>Tank 3 &amp; 4&amp</p>"
    rows = [(i, f"https://a.org/{i}", f'<title>T{i} &amp</title><meta name="og:image" content="i"><div class="post-outer">{body}</div>') for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    want = pages.select(P.canonical_text(P.F.lit(body)).alias("t")).first().t
    got = P.isolate_main(pages, closed_only=True)
    assert want == "Cut &&ampTank 3 & 4&amp" and [tuple(r) for r in got.select("page_id", "canonical_text").orderBy("page_id").collect()] == [(i, want) for i in range(100)]
    assert J.posts(pages.withColumn("ts", P.F.current_timestamp()), closed_only=True).where(P.F.col("canonical_text") == want).count() == 100
    previews = P.social_preview(P.html_extract(pages, closed_only=True))
    assert {r.title for r in previews.collect()} == {f"T{i} &amp" for i in range(100)}


def test_results_leave_in_parts():
    import pyarrow as pa

    held = {}

    class Pages:
        def select(self, *_):
            return self

        schema = P.T.StructType.fromDDL("page_id long, url string, _html string, _url string")

        def mapInArrow(self, run, schema):
            batch = pa.table({"page_id": list(range(500)), "url": ["u"] * 500, "_html": ["<div class='post-outer'>x</div>"] * 500, "_url": ["u"] * 500}).to_batches()[0]
            held["sizes"] = [b.num_rows for b in run(iter([batch]))]
            return self

        def __getattr__(self, _):
            return self

    P._by_page(Pages(), ["page_id", "url"], "html", "url", lambda h, u: (h,), [("x", pa.string())], "x string")
    assert sum(held["sizes"]) == 500 and max(held["sizes"]) <= P.PAGES
