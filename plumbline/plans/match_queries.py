"""Matching, ranking and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions import text as X
from plumbline.operators import dedup as D
from plumbline.operators import match as M
from plumbline.plans import standins as V
from plumbline.session import cut
from plumbline.plans.registry import query
from plumbline.plans.sqlkit import in_list, lit, lits, strip, tokens_alpha, words
from plumbline.plans.text_queries import junk_caption_sql

_WS = f"list_distinct(list_filter({words('lower(text)')}, lambda w: length(w) > 2 AND w NOT IN {in_list(K.STOP_LIBRARY)}))"


@query("M1", f"""WITH w AS (SELECT item_id, unnest({_WS}) AS tok FROM benchmark), a AS (SELECT doc_id, unnest({_WS}) AS tok FROM documents),
p AS (SELECT item_id, doc_id, count(*) AS overlap FROM w JOIN a USING (tok) GROUP BY 1, 2 HAVING count(*) >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY overlap DESC, doc_id) AS rank FROM p)
SELECT * FROM r""")
def match_by_tokens(read):
    return M.match_by_tokens(read("benchmark").select("item_id", F.col("text").alias("wish")),
                             read("documents").select("doc_id", F.col("text").alias("description")), "item_id", "doc_id").withColumn("rank", F.col("rank").cast("bigint"))


_FOOT = f"""scenes AS (SELECT p_partkey AS scene_id, 'C' || (p_size % 12) AS category, CASE p_size % 3 WHEN 0 THEN 'own_edge' WHEN 1 THEN 'stock' ELSE 'footage' END AS visual_type,
   p_name || ' ' || lower(p_type) || ' on the pump line' AS text FROM part WHERE p_retailprice > 0),
footage AS (SELECT 'clip' || s_suppkey AS id, [CASE s_suppkey % 4 WHEN 0 THEN 'Factory' WHEN 1 THEN 'Widget' ELSE 'ring' END, 'tag' || s_suppkey] AS tags, ['c' || (s_suppkey % 40)] AS categories,
   CASE s_suppkey % 3 WHEN 0 THEN 'economy pump of steel' WHEN 1 THEN 'a red gear' ELSE 'standard line' END AS description, [CASE s_suppkey % 5 WHEN 0 THEN 'establishing' WHEN 1 THEN 'broll' ELSE 'none' END] AS good_for FROM supplier)"""


def _scenes(read):
    s = F.col("p_size") % 3
    return read("part").select(F.col("p_partkey").alias("scene_id"), F.concat(F.lit("C"), (F.col("p_size") % 12).cast("string")).alias("category"),
                               F.when(s == 0, "own_edge").when(s == 1, "stock").otherwise("footage").alias("visual_type"),
                               F.concat("p_name", F.lit(" "), F.lower("p_type"), F.lit(" on the pump line")).alias("text"))


def _footage(read):
    k = F.col("s_suppkey")
    one = lambda m, a, b, c: F.when(k % m == 0, a).when(k % m == 1, b).otherwise(c)
    return read("supplier").select(
        F.concat(F.lit("clip"), k.cast("string")).alias("id"), F.array(one(4, "Factory", "Widget", "ring"), F.concat(F.lit("tag"), k.cast("string"))).alias("tags"),
        F.array(F.concat(F.lit("c"), (k % 40).cast("string"))).alias("categories"), one(3, "economy pump of steel", "a red gear", "standard line").alias("description"),
        F.array(one(5, "establishing", "broll", "none")).alias("good_for"))


@query("M2", f"""WITH {_FOOT},
s AS (SELECT scene_id, category, visual_type, {tokens_alpha('text', K.STOP_FOOTAGE)} AS tok FROM scenes),
f AS (SELECT id, list_transform(tags, lambda t: lower(t)) AS tags, categories, {tokens_alpha('description', K.STOP_FOOTAGE)} AS dt, good_for FROM footage),
p AS (SELECT scene_id, id, CASE WHEN list_contains(categories, lower(category)) THEN 5 ELSE 0 END + 2 * len(list_intersect(tok, tags)) + len(list_intersect(tok, dt))
   + CASE WHEN visual_type = 'own_edge' AND (list_contains(tags, 'factory') OR list_contains(good_for, 'establishing')) THEN 3 ELSE 0 END
   + CASE WHEN visual_type = 'stock' AND list_contains(good_for, 'broll') THEN 1 ELSE 0 END AS score FROM s, f),
r AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY score DESC, id) AS n FROM p WHERE score >= 2)
SELECT scene_id, id, score FROM r WHERE n = 1""")
def match_footage(read):
    return M.match_footage(_scenes(read), _footage(read))


_SRC = f"""src AS (SELECT l_orderkey AS run_id, (l_linenumber * 10000 + l_suppkey) * 100000 + l_partkey AS ord, p_name || ' ' || lower(p_type) AS caption, l_returnflag = 'R' AS is_authority FROM lineitem JOIN part ON p_partkey = l_partkey),
sc AS (SELECT o_orderkey AS run_id, o_custkey AS scene_id, 'the ' || CASE o_custkey % 3 WHEN 0 THEN 'red economy' WHEN 1 THEN 'widget' ELSE 'unmatched' END || ' view' AS text FROM orders)"""


@query("M3", f"""WITH {_SRC}, p AS (SELECT sc.run_id, scene_id, ord, len(list_intersect({tokens_alpha('text', K.STOP_SOURCE)}, {tokens_alpha('caption', K.STOP_SOURCE)})) + CASE WHEN is_authority THEN 1 ELSE 0 END AS score
  FROM sc JOIN src USING (run_id)), r AS (SELECT *, row_number() OVER (PARTITION BY run_id, scene_id ORDER BY score DESC, ord) AS n FROM p WHERE score >= 1)
SELECT run_id, scene_id, ord, score FROM r WHERE n = 1""")
def match_source(read):
    li = read("lineitem").join(read("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type"), "l_partkey")
    src = li.select(F.col("l_orderkey").alias("run_id"), ((F.col("l_linenumber") * 10000 + F.col("l_suppkey")) * 100000 + F.col("l_partkey")).alias("ord"),
                    X.tokens_alpha(F.concat("p_name", F.lit(" "), F.lower("p_type")), K.STOP_SOURCE).alias("tokens"), (F.col("l_returnflag") == "R").alias("is_authority"))
    k = F.col("o_custkey") % 3
    sc = read("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("scene_id"), F.concat(
        F.lit("the "), F.when(k == 0, "red economy").when(k == 1, "widget").otherwise("unmatched"), F.lit(" view")).alias("text"))
    return M.match_source(sc, src)


_CTX = """x AS (SELECT conv_id, turn, CASE (conv_id + turn) % 7 WHEN 0 THEN 'Water treatment plant ' WHEN 1 THEN 'tank Fig 2 ' WHEN 2 THEN 'Breaking news ' WHEN 3 THEN '' ELSE 'Pump ' END || CASE WHEN turn = 5 THEN '' ELSE d.text END AS caption,
  CASE turn % 3 WHEN 0 THEN 'The water pump ' WHEN 1 THEN '' ELSE 'On ' END || c.text AS narration, ['pump station', role] AS thread, CASE WHEN turn % 2 = 0 THEN 'Water grows' ELSE '' END AS hero
  FROM conversations c JOIN documents d ON d.doc_id = conv_id)"""


@query("M4", f"""WITH {_CTX}, t AS (SELECT *, {tokens_alpha('caption', K.STOP_SCORING)} AS c, {tokens_alpha('narration', K.STOP_SCORING)} AS n, {tokens_alpha("array_to_string(thread, ' ')", K.STOP_SCORING)} AS th,
   {tokens_alpha('hero', K.STOP_SCORING)} AS h FROM x)
SELECT conv_id, turn, CAST(CASE WHEN caption = '' OR narration = '' OR {junk_caption_sql('caption')} THEN 0 WHEN len(c) = 0 OR len(n) = 0 THEN 10 ELSE
  least(100, least(50, len(list_intersect(n, c)) * 12) + CASE WHEN list_has_any(c, {lits(K.DOMAIN_ANCHORS)}) THEN 20 ELSE 0 END
   + CASE WHEN list_has_any(list_intersect(n, c), {lits(K.DOMAIN_ANCHORS)}) THEN 30 ELSE 0 END + CASE WHEN list_has_any(c, th) THEN 15 ELSE 0 END + CASE WHEN list_has_any(c, h) THEN 10 ELSE 0 END) END AS BIGINT) AS score FROM t""")
def context_score(read):
    docs = read("documents").select(F.col("doc_id").alias("conv_id"), F.col("text").alias("dtext"))
    k, t = (F.col("conv_id") + F.col("turn")) % 7, F.col("turn")
    x = read("conversations").join(docs, "conv_id").select(
        "conv_id", "turn", F.concat(F.when(k == 0, "Water treatment plant ").when(k == 1, "tank Fig 2 ").when(k == 2, "Breaking news ").when(k == 3, "").otherwise("Pump "),
                                    F.when(t == 5, "").otherwise(F.col("dtext"))).alias("caption"),
        F.concat(F.when(t % 3 == 0, "The water pump ").when(t % 3 == 1, "").otherwise("On "), "text").alias("narration"),
        F.array(F.lit("pump station"), "role").alias("thread"), F.when(t % 2 == 0, "Water grows").otherwise("").alias("hero"))
    return x.select("conv_id", "turn", M.context_score("caption", "narration", "thread", "hero").cast("bigint").alias("score"))


_SOURCES = ["wikimedia", "unsplash", "pexels", "bing", "duckduckgo", "google_images", "youtube", "pixabay", "openverse"]
_CAND = f"""cand AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {lits(_SOURCES)}[1 + l_suppkey % 9] AS source, p_name || ' Steel' AS caption, CAST(l_quantity AS BIGINT) * 60 AS width,
   CASE WHEN l_linenumber = 7 THEN 0 ELSE 300 + (l_partkey * 13) % 2000 END AS height, CAST(floor(l_extendedprice * 3) AS BIGINT) AS file_size, l_linenumber % 2 = 0 AS is_clip,
   l_partkey * 20 AS views, l_quantity AS duration_s, 'red steel widget of 9' AS q FROM lineitem JOIN part ON p_partkey = l_partkey)"""


def candidates(read):
    li = read("lineitem").join(read("part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.get(X.strings(_SOURCES), (F.col("l_suppkey") % 9).cast("int")).alias("source"),
                     F.concat("p_name", F.lit(" Steel")).alias("caption"), (F.col("l_quantity").cast("bigint") * 60).alias("width"),
                     F.when(F.col("l_linenumber") == 7, 0).otherwise(300 + (F.col("l_partkey") * 13) % 2000).alias("height"),
                     F.floor(F.col("l_extendedprice") * 3).alias("file_size"), (F.col("l_linenumber") % 2 == 0).alias("is_clip"), (F.col("l_partkey") * 20).alias("views"),
                     F.col("l_quantity").alias("duration_s"), F.lit("red steel widget of 9").alias("q"))


_AUTH = "CASE source " + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in K.AUTHORITY_WEIGHT.items()) + " ELSE 0 END"
QUALITY_SQL = f"""CASE WHEN width > 0 AND height > 0 AND greatest(width, height) < 1280 THEN -100 ELSE 30 + CASE WHEN width > 0 AND height > 0 THEN
   CASE WHEN greatest(width, height) >= 1920 THEN 10 ELSE 0 END - CASE WHEN width / height BETWEEN CAST(0.9 AS DOUBLE) AND CAST(1.1 AS DOUBLE) THEN 15 ELSE 0 END
   + CASE WHEN width / height >= CAST(1.6 AS DOUBLE) THEN 10 ELSE 0 END + CASE WHEN width / height <= CAST(0.65 AS DOUBLE) THEN 8 ELSE 0 END ELSE 0 END
   + least(25, 8 * len(list_intersect({tokens_alpha('caption', K.STOP_SCORING)}, {tokens_alpha('q', K.STOP_SCORING)}))) + {_AUTH} + CASE WHEN file_size > 100000 THEN 15 ELSE 0 END
   + CASE WHEN is_clip AND views > 10000 AND duration_s > 30 THEN 10 ELSE 0 END END"""


@query("M5", f"WITH {_CAND} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST({QUALITY_SQL} AS BIGINT) AS quality FROM cand")
def quality_score(read):
    return candidates(read).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", M.quality_score("q").cast("bigint").alias("quality"))


_HOSTS = ["www.shutterstock.com", "notshutterstock.com", "cdn.alamy.com:443", "img.example.org", "IMG.example.org", "stock.adobe.com.evil.net"]
_GATE = f"""gc AS (SELECT l_orderkey % 800 AS segment_id, {lits(M.TIERS)}[1 + l_linenumber % 4] AS tier, (l_orderkey * 8 + l_linenumber) * 100000 + l_partkey AS ord,
  CASE WHEN l_linenumber = 2 THEN ' ' ELSE '' END || 'https://' || {lits(_HOSTS)}[1 + l_suppkey % 6] || '/' || (l_partkey % 7) || '.jpg' AS url, CAST(l_quantity AS BIGINT) * 60 AS width, 300 AS height FROM lineitem),
gk AS (SELECT *, regexp_replace(lower(regexp_extract({strip('url')}, '^[a-z]+://([^/?#]*)', 1)), ':.*$', '') AS host, lower({strip('url')}) AS k FROM gc),
gb AS (SELECT *, {' OR '.join(f"host = {lit(d)} OR suffix(host, {lit('.' + d)})" for d in K.STOCK_DOMAINS)} AS bad FROM gk),
gf AS (SELECT segment_id, tier, k, min(ord) AS f FROM gb WHERE NOT bad GROUP BY 1, 2, 3),
gated AS (SELECT segment_id, tier, ord, url, CASE WHEN bad THEN 'blacklisted' WHEN ord > f THEN 'duplicate' WHEN greatest(width, height) < 1280 THEN 'low_resolution' END AS reason FROM gb LEFT JOIN gf USING (segment_id, tier, k))"""


def gate_input(read):
    li = read("lineitem")
    return li.select((F.col("l_orderkey") % 800).alias("segment_id"), F.get(X.strings(M.TIERS), F.col("l_linenumber") % 4).alias("tier"),
                     ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")).alias("ord"),
                     F.concat(F.when(F.col("l_linenumber") == 2, " ").otherwise(""), F.lit("https://"), F.get(X.strings(_HOSTS), (F.col("l_suppkey") % 6).cast("int")),
                              F.lit("/"), (F.col("l_partkey") % 7).cast("string"), F.lit(".jpg")).alias("url"),
                     (F.col("l_quantity").cast("bigint") * 60).alias("width"), F.lit(300).alias("height"))


@query("M6", f"WITH {_GATE} SELECT * FROM gated")
def pre_gates(read):
    return M.pre_gates(gate_input(read).withColumn("url", F.col("url"))).select("segment_id", "tier", "ord", "url", "reason")


_THR = "CASE tier " + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in K.TIER_THRESHOLDS.items()) + " END"
_LADDER = f"""{_GATE},
lc AS (SELECT segment_id, tier, ord, url, CASE WHEN tier <> 'own' THEN reason END AS gate_reason, CASE WHEN ord % 9 = 0 THEN 'refusal_phrase' END AS reject_reason, (ord * 7 + segment_id) % 8 AS score,
   list_position({lits(M.TIERS)}, tier) AS t FROM gated WHERE segment_id % 10 <> 3),
ls AS (SELECT *, gate_reason IS NULL AND reject_reason IS NULL AND score >= {_THR} AS accepted FROM lc),
lw AS (SELECT segment_id, arg_min(ord, t * 1000000000000000 + ord) AS word, min(t * 1000000000000000 + ord) AS wkey FROM ls WHERE accepted GROUP BY 1),
ld AS (SELECT ls.*, wkey FROM ls LEFT JOIN lw USING (segment_id) WHERE wkey IS NULL OR t * 1000000000000000 + ord <= wkey)"""


def _ladder(read):
    seg = read("lineitem").select((F.col("l_orderkey") % 800).alias("segment_id")).distinct().withColumn(
        "wish", F.when(F.col("segment_id") % 10 == 3, " ").otherwise("pump"))
    c = M.pre_gates(gate_input(read)).select(
        "segment_id", "tier", "ord", "url", F.when(F.col("tier") != "own", F.col("reason")).alias("gate_reason"),
        F.when(F.col("ord") % 9 == 0, "refusal_phrase").alias("reject_reason"), ((F.col("ord") * 7 + F.col("segment_id")) % 8).alias("score"))
    return M.acquire_ladder(seg, c)


@query("M7", f"""WITH {_LADDER} SELECT s.segment_id, d.url, d.tier, d.score, CASE WHEN s.segment_id % 10 = 3 THEN 'no_wish' WHEN d.url IS NULL THEN 'no_acceptance' END AS reason
FROM (SELECT DISTINCT segment_id FROM gated) s LEFT JOIN (SELECT * FROM ld WHERE accepted AND t * 1000000000000000 + ord = wkey) d USING (segment_id)""")
def acquire_ladder(read):
    return _ladder(read)[0]


@query("M7", f"""WITH {_LADDER} SELECT segment_id, tier, ord, url, score, accepted, CASE WHEN NOT accepted THEN coalesce(gate_reason, reject_reason, 'score_' || score) END AS reason FROM ld""")
def ladder_decisions(read):
    return _ladder(read)[1]


@query("A13", f"""WITH {_LADDER} SELECT segment_id, tier, CASE WHEN NOT accepted THEN coalesce(gate_reason, reject_reason, 'score_' || score) END AS reason, count(*) AS rows FROM ld GROUP BY ALL""")
def provenance_summary(read):
    return M.provenance_summary(_ladder(read)[1])


@query("M8", """WITH r AS (SELECT lang AS query, source AS provider, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS r FROM documents),
p AS (SELECT query, provider, doc_id, row_number() OVER (PARTITION BY query ORDER BY r, provider) AS position FROM r)
SELECT * FROM p""")
def round_robin(read):
    d = read("documents").select(F.col("lang").alias("query"), F.col("source").alias("provider"), "doc_id")
    return M.round_robin(d, ord="doc_id").withColumn("position", F.col("position").cast("bigint"))


_CASC = """cc AS (SELECT l_suppkey AS scene_id, l_linenumber % 3 AS query_no, l_orderkey * 100000 + l_partkey AS ord, CAST(l_quantity AS BIGINT) + l_suppkey % 9 AS quality, CAST(l_quantity AS BIGINT) AS quality_first, CASE WHEN l_suppkey % 11 = 5 THEN least(l_partkey % 40, 14) ELSE l_partkey % 40 END AS context
  FROM lineitem),
sn AS (SELECT s_suppkey AS scene_id FROM supplier UNION ALL SELECT s_suppkey + 1000000 FROM supplier),
cs AS (SELECT scene_id, min(query_no) AS stop FROM (SELECT scene_id, query_no FROM cc GROUP BY 1, 2 HAVING count_if(quality >= 40) >= 3) z GROUP BY 1),
ck AS (SELECT cc.* FROM cc LEFT JOIN cs USING (scene_id) WHERE (stop IS NULL OR query_no <= stop) AND context >= 15)"""


def _cascade(read):
    q = F.col("l_quantity").cast("bigint")
    li, fit = read("lineitem"), F.col("l_partkey") % 40
    own = read("supplier").select(F.col("s_suppkey").alias("scene_id"))
    scenes = own.unionByName(own.select((F.col("scene_id") + 1000000).alias("scene_id")))  # the latter have no candidate
    return M.candidate_cascade(li.select(F.col("l_suppkey").alias("scene_id"), (F.col("l_linenumber") % 3).alias("query_no"), (F.col("l_orderkey") * 100000 + F.col("l_partkey")).alias("ord"),
                                         (q + F.col("l_suppkey") % 9).alias("quality"), q.alias("quality_first"), F.when(F.col("l_suppkey") % 11 == 5, F.least(fit, F.lit(14))).otherwise(fit).alias("context")), scenes)


@query("M9", f"WITH {_CASC} SELECT scene_id, query_no, ord, quality, context, row_number() OVER (PARTITION BY scene_id ORDER BY context DESC, quality_first DESC, query_no, ord) AS position FROM ck")
def candidate_cascade(read):
    return _cascade(read)[0].select("scene_id", "query_no", "ord", "quality", "context", "position")


@query("M9", f"WITH {_CASC} SELECT DISTINCT scene_id FROM sn WHERE scene_id NOT IN (SELECT scene_id FROM ck)")
def cascade_degraded(read):
    return _cascade(read)[1]


_RANKED = """rk AS (SELECT l_orderkey AS scene_id, (l_linenumber * 10000 + l_suppkey) * 100000 + l_partkey AS cand, l_partkey % 40 AS context, CAST(l_quantity AS BIGINT) AS quality FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY context DESC, quality DESC, cand) AS rank FROM rk),
scores AS (SELECT scene_id, rank, CASE WHEN cand % 5 = 0 THEN 'x' ELSE CAST((cand * 3 + scene_id) % 14 AS VARCHAR) END AS score FROM ranked WHERE rank <= 3 AND NOT (scene_id % 6 = 0 AND rank = 1))"""


def _ranked(read):
    li = read("lineitem").select(F.col("l_orderkey").alias("scene_id"), ((F.col("l_linenumber") * 10000 + F.col("l_suppkey")) * 100000 + F.col("l_partkey")).alias("cand"),
                                 (F.col("l_partkey") % 40).alias("context"), F.col("l_quantity").cast("bigint").alias("quality"))
    return li


def _reranked(read):
    li = _ranked(read).withColumn("_c", -F.col("context")).withColumn("_q", -F.col("quality"))
    ranked = M.rank_all(li, ["scene_id"], ["_c", "_q", "cand"]).drop("_c", "_q")
    ranked = cut(ranked, "ranked")
    scores = ranked.where((F.col("rank") <= 3) & ~((F.col("scene_id") % 6 == 0) & (F.col("rank") == 1))).select(
        "scene_id", "rank", F.when(F.col("cand") % 5 == 0, "x").otherwise(((F.col("cand") * 3 + F.col("scene_id")) % 14).cast("string")).alias("score"))
    return ranked, scores


@query("M10", f"""WITH {_RANKED},
v AS (SELECT scene_id, count_if(rank <= 3) = (SELECT count(*) FROM scores s WHERE s.scene_id = ranked.scene_id) AS valid FROM ranked GROUP BY 1),
g AS (SELECT r.*, valid, greatest(0, least(10, coalesce(try_cast(score AS INT), 0))) AS m FROM ranked r JOIN v USING (scene_id) LEFT JOIN scores USING (scene_id, rank) WHERE rank <= 3),
mv AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY m DESC, context DESC, quality DESC, rank) AS position FROM g WHERE valid AND m >= 4),
al AS (SELECT scene_id, count(*) AS k FROM mv GROUP BY 1)
SELECT scene_id, cand, rank AS position FROM g WHERE NOT valid UNION ALL SELECT scene_id, cand, position FROM mv
UNION ALL SELECT r.scene_id, r.cand, CASE WHEN valid THEN rank - 3 + k ELSE rank END FROM ranked r JOIN v USING (scene_id) LEFT JOIN al USING (scene_id) WHERE rank > 3 AND (NOT valid OR k IS NOT NULL)""")
def rerank(read):
    ranked, scores = _reranked(read)
    return M.rerank(ranked, scores, n_top=3).select("scene_id", "cand", "position")


@query("M11", f"""WITH {_RANKED},
sl AS (SELECT scene_id, rank, 'u' || cand AS url, quality, CASE WHEN cand % 7 = 0 THEN NULL ELSE cand % 11 END AS verdict FROM ranked WHERE cand % 13 <> 0 AND cand % 10 <> 1),
kp AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY verdict DESC, quality DESC, rank) AS place FROM sl WHERE verdict IS NOT NULL),
ch AS (SELECT scene_id, arg_min(url, place) AS url FROM kp WHERE verdict >= 6 GROUP BY 1)
SELECT scene_id, url, url IS NULL AS degraded FROM (SELECT DISTINCT scene_id FROM ranked) s LEFT JOIN ch USING (scene_id)""")
def select_best(read):
    rows = _ranked(read).withColumns({"_c": -F.col("context"), "_q": -F.col("quality")})
    ranked = cut(M.rank_all(rows, ["scene_id"], ["_c", "_q", "cand"]).drop("_c", "_q"), "shortlist")
    url = F.concat(F.lit("u"), F.col("cand").cast("string"))
    sl = ranked.select("scene_id", "rank", url.alias("url"), "quality", (F.col("cand") % 13 == 0).alias("is_dup"))
    verdicts = ranked.select("scene_id", url.alias("url"), F.when(F.col("cand") % 7 == 0, None).otherwise(F.col("cand") % 11).alias("verdict"))
    excluded = ranked.where("cand % 10 = 1").select("scene_id", url.alias("url"))
    return M.select_best(sl, verdicts, excluded)[0]


@query("M12", """WITH own AS (SELECT l_orderkey AS scene_id, 'own' || l_partkey AS asset, l_linenumber * 100000 + l_partkey AS ord, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_suppkey % 8 END AS score FROM lineitem WHERE l_returnflag = 'R'),
b AS (SELECT scene_id, asset, score, row_number() OVER (PARTITION BY scene_id ORDER BY score DESC, ord) AS n FROM own WHERE score IS NOT NULL)
SELECT o_orderkey AS scene_id, coalesce(b.asset, 'web' || o_custkey) AS asset, b.asset IS NOT NULL AS is_own FROM orders LEFT JOIN b ON b.scene_id = o_orderkey AND n = 1 AND score >= 5""")
def prefer_own(read):
    own = read("lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("scene_id"), F.concat(F.lit("own"), F.col("l_partkey").cast("string")).alias("asset"),
        (F.col("l_linenumber") * 100000 + F.col("l_partkey")).alias("ord"), F.when(F.col("l_partkey") % 5 == 0, None).otherwise(F.col("l_suppkey") % 8).alias("score"))
    ext = read("orders").select(F.col("o_orderkey").alias("scene_id"), F.concat(F.lit("web"), F.col("o_custkey").cast("string")).alias("asset"))
    own = own.join(ext.select("scene_id"), "scene_id", "left_semi")
    return M.prefer_own(own, ext)


# ── hashes: sign bits of the embeddings, plus a lightly flipped copy of each ─
_HALF = "list_reduce(list_transform(range({a}, {b}), lambda i: CASE WHEN embedding[i] > 0 THEN CAST(1 AS BIGINT) << (i - {a}) ELSE CAST(0 AS BIGINT) END), lambda x, y: x + y)"
HASH_SQL = f"""hh AS (SELECT vec_id, label, {_HALF.format(a=1, b=33)} AS lo, {_HALF.format(a=33, b=65)} AS hi FROM embeddings),
hs AS (SELECT label AS run_id, vec_id * 2 AS ord, lo, hi FROM hh UNION ALL SELECT label, vec_id * 2 + 1, xor(lo, (CAST(1 AS BIGINT) << CAST(vec_id % 12 AS INT)) - 1), hi FROM hh)"""


def hashes(read):
    bits = F.transform("embedding", lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    h = F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
    v = read("embeddings").select("vec_id", F.col("label").alias("run_id"), h.alias("h"))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("vec_id") % 12).cast("int")) - 1
    return v.select("run_id", (F.col("vec_id") * 2).alias("ord"), "h").unionByName(
        v.select("run_id", (F.col("vec_id") * 2 + 1).alias("ord"), F.col("h").bitwiseXOR(mask).alias("h")))


@query("M13", f"""WITH RECURSIVE {HASH_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ord) AS n FROM hs),
g AS (SELECT run_id, ord, n, [{{'lo': lo, 'hi': hi}}] AS kept, false AS is_dup FROM o WHERE n = 1
  UNION ALL SELECT o.run_id, o.ord, o.n, CASE WHEN len(list_filter(kept, lambda k: bit_count(xor(k.lo, o.lo)) + bit_count(xor(k.hi, o.hi)) <= 8)) > 0 THEN kept ELSE list_append(kept, {{'lo': o.lo, 'hi': o.hi}}) END,
    len(list_filter(kept, lambda k: bit_count(xor(k.lo, o.lo)) + bit_count(xor(k.hi, o.hi)) <= 8)) > 0 FROM g JOIN o ON o.run_id = g.run_id AND o.n = g.n + 1)
SELECT run_id, ord, is_dup FROM g""")
def near_dup(read):
    return D.near_dup(hashes(read)).select("run_id", "ord", "is_dup")


@query("M14", f"""WITH {HASH_SQL}, j AS (SELECT run_id, ord, ord % 10 = 4 AS is_clip, lo, hi, lag(lo) OVER w AS plo, lag(hi) OVER w AS phi, lag(ord % 10 = 4) OVER w AS pclip FROM hs WINDOW w AS (PARTITION BY run_id ORDER BY ord))
SELECT run_id, ord, coalesce(NOT is_clip AND NOT pclip AND bit_count(xor(lo, plo)) + bit_count(xor(hi, phi)) > 30, false) AS visual_jump FROM j""")
def visual_jump(read):
    return M.visual_jump(hashes(read).withColumn("is_clip", F.col("ord") % 10 == 4)).select("run_id", "ord", "visual_jump")


@query("M15", f"""WITH {_RANKED}, n AS (SELECT scene_id AS segment_id, arg_min('u' || cand, rank) AS nx FROM ranked WHERE cand % 3 <> 0 GROUP BY 1)
SELECT o_orderkey AS segment_id, coalesce(nx, 'current') AS url, nx IS NOT NULL AS replaced FROM orders LEFT JOIN n ON segment_id = o_orderkey""")
def exclude_and_retry(read):
    r = _ranked(read).select(F.col("scene_id").alias("segment_id"), F.concat(F.lit("u"), F.col("cand").cast("string")).alias("url"), "cand", "context", "quality")
    used = r.where("cand % 3 = 0").select("segment_id", "url")
    current = read("orders").select(F.col("o_orderkey").alias("segment_id"), F.lit("current").alias("url"))
    return M.exclude_and_retry(current, r, used, [-F.col("context"), -F.col("quality"), F.col("cand")])


_TOK = tokens_alpha('text', K.STOP_SCORING)


@query("M16", f"""WITH t AS (SELECT conv_id, turn, {_TOK} AS tok FROM conversations), f AS (SELECT conv_id, tok, min(turn) AS first FROM (SELECT conv_id, turn, unnest(tok) AS tok FROM t) z GROUP BY 1, 2)
SELECT t.conv_id AS run_id, t.turn AS pos, array_to_string((list_sort(coalesce((SELECT list(f.tok) FROM f WHERE f.conv_id = t.conv_id AND f.first <= t.turn), [])))[1:6], ' ') AS keywords FROM t""")
def cumulative_keywords(read):
    seg = read("conversations").select(F.col("conv_id").alias("run_id"), F.col("turn").alias("pos"), F.col("text").alias("narration"))
    return M.cumulative_keywords(seg).withColumn("keywords", F.array_join("keywords", " "))


@query("M17", """WITH s AS (SELECT l_orderkey AS run_id, (l_linenumber * 10000 + l_suppkey) * 100000 + l_partkey AS id, CASE WHEN l_partkey % 2 = 0 THEN 'BROLL' ELSE 'PAPER_CARD' END AS type, CASE WHEN l_suppkey % 5 > 0 THEN 'STAT_CARD' END AS fallback_type,
   CASE WHEN l_returnflag = 'R' THEN 'a' || l_suppkey END AS asset, CASE WHEN l_returnflag = 'A' THEN 'no_wish' END AS why FROM lineitem)
SELECT run_id, id, type, fallback_type, asset, CASE WHEN asset IS NOT NULL THEN 'acquired' WHEN fallback_type IS NOT NULL THEN 'fallback' END AS resolved, CASE WHEN asset IS NOT NULL THEN type ELSE fallback_type END AS rendered_type,
  CASE WHEN asset IS NULL THEN coalesce(why, 'no_acceptance') END AS reason, CASE WHEN asset IS NULL AND fallback_type IS NULL THEN 'no renderable fallback' END AS error FROM s""")
def resolve_fallback(read):
    li = read("lineitem").select(F.col("l_orderkey").alias("run_id"), ((F.col("l_linenumber") * 10000 + F.col("l_suppkey")) * 100000 + F.col("l_partkey")).alias("id"), "l_partkey", "l_suppkey", "l_returnflag")
    shots = li.select("run_id", "id", F.when(F.col("l_partkey") % 2 == 0, "BROLL").otherwise("PAPER_CARD").alias("type"), F.when(F.col("l_suppkey") % 5 > 0, "STAT_CARD").alias("fallback_type"))
    acc = li.select("run_id", "id", F.when(F.col("l_returnflag") == "R", F.concat(F.lit("a"), F.col("l_suppkey").cast("string"))).alias("asset"), F.when(F.col("l_returnflag") == "A", "no_wish").alias("reason"))
    return M.resolve_fallback(shots, acc)


_HEX = "list_reduce(list_prepend(0, list_transform(string_split(sha1(key), ''), lambda d: strpos('0123456789abcdef', d) - 1)), lambda a, d: (a * 16 + d) % n)"


@query("M18", f"WITH k AS (SELECT user_id, event_id, event_type || '|' || user_id AS key, 3 + event_id % 14 AS n FROM events) SELECT event_id, {_HEX} AS bucket FROM k")
def hash_bucket(read):
    return read("events").select("event_id", M.hash_bucket(F.concat("event_type", F.lit("|"), F.col("user_id").cast("string")), 3 + F.col("event_id") % 14).alias("bucket"))


@query("M20", f"""WITH {V.SCRIPTS_SQL}, r AS (SELECT run_id, id, 'claim ' || value || ' by ' || id AS claim, row_number() OVER (PARTITION BY run_id ORDER BY significance DESC, id) AS n FROM sfacts),
b AS (SELECT run_id, string_agg('- ' || claim, chr(10) ORDER BY n) AS b FROM r WHERE n <= 3 GROUP BY 1)
SELECT run_id, o_orderpriority || chr(10) || chr(10) || b || chr(10) || chr(10) || 'Full technical guide: http://x.org/' || run_id AS caption_text FROM b JOIN orders ON o_orderkey = run_id""")
def top_facts(read):
    f = V.script_facts(read).select("run_id", F.col("id").alias("ord"), "significance", F.concat(F.lit("claim "), "value", F.lit(" by "), "id").alias("claim"))
    hooks = read("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("hook"), F.concat(F.lit("http://x.org/"), F.col("o_orderkey").cast("string")).alias("url"))
    return M.top_facts(f, hooks)


_TYPES = ["text_card", "infographic", "stock", "own_edge", "footage", "odd"]


@query("M21", f"""WITH s AS (SELECT p_partkey, {lits(_TYPES)}[1 + p_size % 6] AS vt, CASE p_partkey % 4 WHEN 0 THEN 'hook' WHEN 1 THEN 'cta' WHEN 2 THEN 'body' END AS layout, p_size % 4 = 0 AS src, p_partkey % 3 > 0 AS series FROM part)
SELECT p_partkey, CASE WHEN src AND coalesce(layout, '') NOT IN ('hook', 'cta') THEN 'source_card' WHEN vt = 'infographic' AND series THEN 'infographic' ELSE 'text_card' END AS generator FROM s""")
def resolve_visual_type(read):
    k = F.col("p_partkey")
    s = read("part").select("p_partkey", F.get(X.strings(_TYPES), F.col("p_size") % 6).alias("vt"),
                            F.when(k % 4 == 0, "hook").when(k % 4 == 1, "cta").when(k % 4 == 2, "body").alias("layout"), (F.col("p_size") % 4 == 0).alias("src"), (k % 3 > 0).alias("series"))
    return s.select("p_partkey", M.resolve_visual_type("vt", "layout", "src", "series").alias("generator"))
