"""Facts: locating, gating, tiers and yields."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import text as X
from plumbline.operators import facts as O
from plumbline.plans import standins as V
from plumbline.plans.registry import query
from plumbline.plans.sqlkit import lit, norm, strip, words
from plumbline.plans.text_queries import MINED_SQL

# Every mined sentence becomes a fact; by (doc + pos) % 5 it is restyled, moved, or given a wrong value.
FACTS_SQL = MINED_SQL + r""",
facts AS (SELECT doc_id, pos, CASE (doc_id + pos) % 5 WHEN 1 THEN '  ' || replace(sentence, ' ', '  ') || ' ' WHEN 2 THEN sentence || ' zzz' WHEN 4 THEN '' ELSE sentence END AS quote,
  CASE (doc_id + pos) % 5 WHEN 0 THEN 'about ' || regexp_extract(sentence, '[0-9]+') || ' units' WHEN 3 THEN regexp_extract(sentence, '[0-9]+') || '7391' ELSE 'n/a' END AS value FROM mined)"""


def mined_facts(read):
    m = O.mine_numeric_sentences(read("documents"))
    k = (F.col("doc_id") + F.col("pos")) % 5
    num = F.regexp_extract("sentence", "[0-9]+", 0)
    return m.select(
        "doc_id", "pos",
        F.when(k == 1, F.concat(F.lit("  "), F.replace("sentence", F.lit(" "), F.lit("\u00a0 ")), F.lit(" "))).when(k == 2, F.concat("sentence", F.lit(" zzz")))
        .when(k == 4, "").otherwise(F.col("sentence")).alias("quote"),
        F.when(k == 0, F.concat(F.lit("about "), num, F.lit(" units"))).when(k == 3, F.concat(num, F.lit("7391"))).otherwise("n/a").alias("value"))


@query("F2", FACTS_SQL + f"""
SELECT f.doc_id, f.pos, CASE WHEN {norm('quote')} <> '' AND contains({norm('text')}, {norm('quote')}) THEN strpos({norm('text')}, {norm('quote')}) - 1 END AS char_offset
FROM facts f JOIN documents d USING (doc_id)""")
def locate_verbatim(read):
    out = O.locate_verbatim(mined_facts(read), read("documents").select("doc_id", "text"))
    return out.select("doc_id", "pos", F.col("char_offset").cast("bigint").alias("char_offset"))


@query("F2", f"""
WITH q AS (SELECT item_id, count(*) OVER (PARTITION BY n) AS copies, n AS q FROM (SELECT item_id, {norm('text')} AS n FROM benchmark UNION ALL SELECT item_id + 1000000, {norm('text')} FROM benchmark WHERE item_id % 5 = 0) t WHERE n <> ''),
d AS (SELECT doc_id, {norm('text')} AS t FROM documents)
SELECT item_id, copies, doc_id, strpos(t, q) - 1 AS char_offset FROM q JOIN d ON contains(t, q)""")
def find_quotes(read):
    """Substring search as a shingle equi join plus verification."""
    items = read("benchmark").select("item_id", "text")
    twice = items.unionByName(items.where("item_id % 5 = 0").withColumn("item_id", F.col("item_id") + 1000000))  # equal quotes keep their ids
    return O.find_quotes(twice, read("documents").select("doc_id", "text"))


@query("F7", FACTS_SQL + rf"""
, g AS (SELECT f.*, CASE WHEN {norm('quote')} <> '' AND contains({norm('text')}, {norm('quote')}) THEN strpos({norm('text')}, {norm('quote')}) - 1 END AS found_at,
   len(list_filter({words("regexp_replace(value, '[^0-9.]', ' ', 'g')")}, lambda g: NOT contains({norm('quote')}, g))) AS missing FROM facts f JOIN documents d USING (doc_id))
SELECT doc_id, pos, CASE WHEN found_at IS NULL THEN 'not located in canonical text' WHEN missing > 0 THEN 'value digits not inside the quote' END AS reason,
       CASE WHEN found_at IS NULL OR missing > 0 THEN 'dropped' ELSE 'kept' END AS status, CASE WHEN missing = 0 THEN found_at END AS char_offset FROM g""")
def gate_facts(read):
    out = O.gate_facts(mined_facts(read), read("documents").select("doc_id", "text"))
    return out.select("doc_id", "pos", "reason", "status", F.col("char_offset").cast("bigint").alias("char_offset"))


@query("A14", FACTS_SQL + rf"""
, g AS (SELECT f.doc_id, {norm('quote')} <> '' AND contains({norm('text')}, {norm('quote')}) AND
   len(list_filter({words("regexp_replace(value, '[^0-9.]', ' ', 'g')")}, lambda g: NOT contains({norm('quote')}, g))) = 0 AS kept FROM facts f JOIN documents d USING (doc_id)),
m AS (SELECT doc_id, count(*) AS mined FROM mined GROUP BY 1), k AS (SELECT doc_id, count_if(kept) AS kept, count_if(NOT kept) AS dropped FROM g GROUP BY 1)
SELECT doc_id, coalesce(mined, 0) AS mined, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(dropped, 0) AS BIGINT) AS dropped,
       CASE WHEN coalesce(mined, 0) = 0 THEN 'no numeric sentences' WHEN coalesce(kept, 0) = 0 THEN 'no fact kept' END AS failure
FROM documents LEFT JOIN m USING (doc_id) LEFT JOIN k USING (doc_id)""")
def fact_yield(read):
    docs = read("documents").select("doc_id", "text")
    return O.fact_yield(docs, O.gate_facts(mined_facts(read), docs))


_R = lit(X.UNIT_NUMBER.replace("(?U)", ""))
TIER_SQL = rf"""WITH {V.NOTES_SQL},
articles AS (SELECT o_orderkey AS article_id, o_orderpriority AS category FROM orders),
model AS (SELECT l_orderkey AS article_id, CAST(l_quantity AS VARCHAR) AS value, 'kg' AS unit, 'Part ' || l_partkey || ' shipped.' AS claim FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O'),
mined AS (SELECT article_id, claim, value FROM (SELECT n.article_id, s AS claim, unnest(regexp_extract_all(s, {_R})) AS value
  FROM (SELECT article_id, {strip('x')} AS s FROM (SELECT article_id, unnest(regexp_extract_all(note, '[^.!?]*[.!?]')) AS x FROM notes) z) n) y
  WHERE (article_id, claim) NOT IN (SELECT article_id, claim FROM model)),
qual AS (SELECT l_orderkey AS article_id FROM lineitem WHERE l_returnflag = 'A' AND l_discount > 0.05),
tpl AS (SELECT ['1-URGENT', '2-HIGH', '3-MEDIUM'][1 + r_regionkey % 3] AS category, r_name AS claim FROM region),
n AS (SELECT article_id, category, (SELECT count(*) FROM tpl WHERE tpl.category = a.category) AS t,
  coalesce(m, 0) AS m, coalesce(r, 0) AS r, coalesce(q, 0) AS q
  FROM articles a LEFT JOIN (SELECT article_id, count(*) AS m FROM model GROUP BY 1) USING (article_id)
  LEFT JOIN (SELECT article_id, count(*) AS r FROM mined GROUP BY 1) USING (article_id) LEFT JOIN (SELECT article_id, count(*) AS q FROM qual GROUP BY 1) USING (article_id)),
x AS (SELECT *, CASE WHEN m >= 3 THEN 1 WHEN m + r >= 3 THEN 2 WHEN m + r + q >= 3 THEN 3 WHEN t > 0 THEN 4 END AS upto FROM n)"""


def _tiers(read):
    notes = V.notes(read)
    li = read("lineitem")
    articles = read("orders").select(F.col("o_orderkey").alias("article_id"), F.col("o_orderpriority").alias("category"))
    model = li.where("l_returnflag = 'N' AND l_linestatus = 'O'").select(
        F.col("l_orderkey").alias("article_id"), F.col("l_quantity").cast("string").alias("value"), F.lit("kg").alias("unit"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string"), F.lit(" shipped.")).alias("claim"))
    # outer: before an inner one Spark puts a filter that finds all facts again; every fact has a claim
    mined = notes.select("article_id", F.inline_outer(X.sentence_facts("note"))).where("claim IS NOT NULL").select("article_id", "value", "unit", "claim")
    qual = li.where("l_returnflag = 'A' AND l_discount > 0.05").select(F.col("l_orderkey").alias("article_id"),
                                                                        F.concat(F.lit("Lot of "), F.col("l_suppkey").cast("string")).alias("claim"))
    tpl = read("region").select(F.get(X.strings(["1-URGENT", "2-HIGH", "3-MEDIUM"]), F.col("r_regionkey") % 3).alias("category"),
                                F.col("r_name").alias("claim"))
    return O.tiered_facts(articles, model, mined, qual, tpl)


@query("F10", TIER_SQL + """
SELECT article_id, category, CAST(CASE WHEN upto = 2 AND m > 0 THEN 1 ELSE upto END AS BIGINT) AS tier_used,
       CASE WHEN m < 3 AND m + r >= 3 THEN m + r ELSE m END AS numeric_count,
       CASE WHEN m + r < 3 AND upto IS NOT NULL THEN q ELSE 0 END AS punch_points_count, coalesce(upto = 4, false) AS fell_back,
       CASE WHEN upto IS NULL THEN 'no tier produced facts' END AS error FROM x""")
def tiered_facts(read):
    return _tiers(read)[1].withColumn("tier_used", F.col("tier_used").cast("bigint"))


@query("F10", TIER_SQL + """
, s AS (SELECT article_id, unnest([{'s': 1, 'n': m}, {'s': 2, 'n': CASE WHEN upto >= 2 THEN r ELSE 0 END}, {'s': 3, 'n': CASE WHEN upto >= 3 THEN q ELSE 0 END},
                                   {'s': 4, 'n': CASE WHEN upto = 4 THEN t ELSE 0 END}]) AS e FROM x WHERE upto IS NOT NULL)
SELECT article_id, CAST(e.s AS BIGINT) AS source, e.n AS n_facts FROM s WHERE e.n > 0""")
def tiered_fact_counts(read):
    return _tiers(read)[0].groupBy("article_id", F.col("source").cast("bigint").alias("source")).agg(F.count("*").alias("n_facts"))


@query("F11", """SELECT 'b' || s_suppkey AS id, s_name AS text, 'differentiator' AS kind FROM supplier
UNION ALL SELECT 'cta' || (c_custkey + 1), c_name, 'cta' FROM customer""")
def rule_fact_rows(read):
    diffs = read("supplier").select(F.concat(F.lit("b"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("text"))
    ctas = read("customer").select(F.col("c_custkey").alias("ord"), F.col("c_name").alias("text"))
    return O.rule_fact_rows(diffs, ctas)
