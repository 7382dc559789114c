"""Metric gates, grades, routing, reports, state and caches."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions import text as X
from plumbline.operators import state as P
from plumbline.operators import verify as O
from plumbline.plans import standins as V
from plumbline.plans.registry import query
from plumbline.plans.segment_queries import PARTS_SQL, parts
from plumbline.plans.sqlkit import in_list, lit, lits, strip, words
from plumbline.session import dealt

B = "bigint"


@query("G11", f"""WITH {V.SCRIPTS_SQL}, p AS (SELECT run_id, pos, len({words('narration')}) AS w, len({words('narration')}) / CAST(1.7 AS DOUBLE) * (0.3 + (run_id % 17) * 0.1) AS d, (run_id * 37 + pos * 211) % 9000 + 500 AS b FROM scripts),
t AS (SELECT run_id, sum(w) / CAST(1.7 AS DOUBLE) AS est, sum(d) + (count(*) - 1) * 0.3 AS actual FROM p GROUP BY 1)
SELECT run_id, pos, 'voice file too small' AS defect FROM p WHERE b < 1024 UNION ALL SELECT run_id, NULL, 'voice length off the estimate' FROM t WHERE est > 0 AND abs(actual - est) / est > 0.65""")
def audio_metrics_gate(read):
    s = V.scripts(read)
    n = X.word_count("narration")
    p = s.select("run_id", "pos", n.alias("words"), (n / F.lit(1.7) * (0.3 + (F.col("run_id") % 17) * 0.1)).alias("duration_s"), ((F.col("run_id") * 37 + F.col("pos") * 211) % 9000 + 500).alias("bytes"))
    return O.audio_metrics_gate(p)


@query("G12", """WITH v AS (SELECT event_id, value AS voice, value + 1.1 + (event_id % 9) * 0.1 AS video FROM events)
SELECT event_id, CASE WHEN video < voice + 1.4 THEN 'clipped' WHEN abs(video - (voice + 1.5)) > 0.35 THEN 'off_law' END AS broken, video - 1.2 + 0.25 >= voice AS covered FROM v""")
def duration_law(read):
    v = read("events").select("event_id", F.col("value").alias("voice"), (F.col("value") + 1.1 + (F.col("event_id") % 9) * 0.1).alias("video"))
    return v.select("event_id", O.duration_law("video", "voice").alias("broken"), O.muxed_covers_voice(F.col("video") - 1.2, "voice").alias("covered"))


_MEDIA = ["duration_s", "filesize_mb", "has_video", "has_audio", "width", "height", "audio_rms", "audio_peak"]
_MEDIA_VAL = """CASE m WHEN 1 THEN 25 + o_orderkey % 45 WHEN 2 THEN o_totalprice / 4000 WHEN 3 THEN CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE 1 END WHEN 4 THEN CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1 END
  WHEN 5 THEN CASE WHEN o_orderkey % 6 = 0 THEN 720 ELSE 1080 END WHEN 6 THEN 1920 WHEN 7 THEN o_custkey % 900 ELSE 30000 + o_custkey % 3000 END"""


@query("G13", f"""WITH m AS (SELECT o_orderkey AS run_id, 25 + o_orderkey % 45 AS d, CASE WHEN o_orderkey % 19 > 0 THEN o_totalprice / 4000 END AS mb, o_orderkey % 10 > 0 AS v, o_orderkey % 7 > 0 AS a, CASE WHEN o_orderkey % 13 > 0 THEN o_orderkey % 6 > 0 END AS r, CASE WHEN o_orderkey % 17 > 0 THEN o_custkey % 900 END AS rms, 30000 + o_custkey % 3000 AS pk FROM orders),
h AS (SELECT run_id, unnest(list_filter([CASE WHEN d < 30 THEN {{'x': 'Duration too short', 'm': [d], 'b': [30]}} WHEN d > 65 THEN {{'x': 'Duration too long', 'm': [d], 'b': [65]}} END,
  CASE WHEN mb IS NULL THEN {{'x': 'Filesize unknown', 'm': NULL, 'b': [100]}} WHEN mb > 100 THEN {{'x': 'Filesize exceeds limit', 'm': [mb], 'b': [100]}} END, CASE WHEN NOT v THEN {{'x': 'No video stream found', 'm': NULL, 'b': NULL}} END,
  CASE WHEN v AND NOT a THEN {{'x': 'No audio stream found', 'm': NULL, 'b': NULL}} END, CASE WHEN v AND NOT coalesce(r, false) THEN {{'x': 'Resolution mismatch', 'm': [CASE WHEN r IS NOT NULL THEN 720 END, 1920], 'b': [1080, 1920]}} END,
  CASE WHEN v AND a AND rms IS NULL THEN {{'x': 'Audio analysis failed', 'm': NULL, 'b': NULL}} END, CASE WHEN v AND a AND rms < 250 THEN {{'x': 'Audio RMS too low', 'm': [rms], 'b': [250]}} END, CASE WHEN v AND a AND pk > 32500 THEN {{'x': 'Audio peak too high', 'm': [pk], 'b': [32500]}} END], lambda x: x IS NOT NULL)) AS h FROM m)
SELECT run_id, h.x AS defect, CAST(h.m[1] AS DOUBLE) AS measured, CAST(h.b[1] AS DOUBLE) AS bound, CAST(h.m[2] AS DOUBLE) AS measured_height, CAST(h.b[2] AS DOUBLE) AS bound_height FROM h""")
def media_metrics_gate(read):
    m = read("orders").select("o_orderkey", "o_custkey", "o_totalprice", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("m"))
    m = m.select(F.col("o_orderkey").alias("run_id"), F.get(X.strings(_MEDIA), F.col("m") - 1).alias("metric"), F.expr(_MEDIA_VAL).cast("double").alias("value"))
    missing = "metric = 'width' AND run_id % 13 = 0 OR metric = 'audio_rms' AND run_id % 17 = 0 OR metric = 'filesize_mb' AND run_id % 19 = 0"
    d = O.media_metrics_gate(m.where(f"NOT ({missing})"))
    return d.select("run_id", "defect", *[F.get(c, F.lit(i)).alias(c + n) for c in ("measured", "bound") for i, n in ((0, ""), (1, "_height"))])


@query("G14", """WITH f AS (SELECT user_id * 1000 + event_id // 300 AS run_id, CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN NULL ELSE value END AS luma FROM events)
SELECT run_id, count(*) FILTER (luma < 24) AS dark, count(*) AS sampled, count(*) FILTER (luma < 24) > 0 AND count(*) FILTER (luma < 24) = count(*) AS defect FROM f GROUP BY 1""")
def persistent_dark_band(read):
    run = F.col("user_id") * 1000 + F.floor(F.col("event_id") / 300)
    luma = F.when((F.col("event_type") == "error") & (F.col("user_id") % 2 == 0), None).otherwise(F.col("value"))
    return O.persistent_dark_band(read("events").select(run.alias("run_id"), luma.alias("luma")))


_BOX = "l_orderkey AS run_id, l_linenumber AS frame, l_partkey % 100 AS conf, (l_suppkey * 37) % 1000 AS x, 60 + (l_partkey * 29) % 1700 AS y, CAST(l_quantity AS BIGINT) * 3 AS w, 40 AS h"


def _boxes(read):
    return read("lineitem").selectExpr("l_orderkey AS run_id", "cast(l_linenumber as bigint) AS frame", "l_partkey", "l_suppkey", "l_partkey % 100 AS conf", "(l_suppkey * 37) % 1000 AS x",
                                       "60 + (l_partkey * 29) % 1700 AS y", "cast(l_quantity as bigint) * 3 AS w", "40 AS h")


@query("G15", f"WITH b AS (SELECT {_BOX} FROM lineitem) SELECT DISTINCT run_id, frame FROM b WHERE conf >= 50 AND (x < 64 OR y < 115 OR x + w > 1080 - 64 OR y + h > 1920 - 115)")
def safe_zone_frames(read):
    return O.safe_zone_frames(_boxes(read))


@query("G15", f"WITH b AS (SELECT l_partkey, l_suppkey, {_BOX} FROM lineitem) SELECT run_id, frame, l_partkey, l_suppkey, x >= 60 AND y >= 120 AND x + w <= 1020 AND y + h <= 1680 AS fits FROM b")
def fits_safe_rect(read):
    return _boxes(read).select("run_id", "frame", "l_partkey", "l_suppkey", O.fits_safe_rect("x", "y", "w", "h").alias("fits"))


@query("G16", "SELECT event_id, CAST(floor(value * 20) AS BIGINT) >= 500 AS has_content FROM events")
def content_gate(read):
    return read("events").select("event_id", O.content_gate(F.floor(F.col("value") * 20)).alias("has_content"))


_OCR = "CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN ' ab ' WHEN 2 THEN 'x Stock  Photo y' WHEN 3 THEN text || ' ©' ELSE text END"


@query("G17", f"""WITH t AS (SELECT doc_id, {strip(_OCR)} AS t FROM documents), h AS (SELECT *, lower(regexp_extract(t, {lit('(?i)' + K.WATERMARK_BLOCKLIST)}, 1)) AS hit FROM t)
SELECT doc_id, CASE WHEN hit <> '' THEN 'blocklist_match:' || hit WHEN length(t) >= 8 THEN 'text_density:' || length(t) || 'chars' END AS reason FROM h""")
def watermark_text_gate(read):
    return read("documents").select("doc_id", O.watermark_reason(F.expr(_OCR)).alias("reason"))


@query("G18", """WITH n AS (SELECT event_id, event_id % 23 AS n FROM events)
SELECT event_id, i AS ordinal, CASE WHEN n <= 5 THEN i ELSE CAST(floor(i * (n / CAST(5 AS DOUBLE))) AS BIGINT) END AS frame FROM n, range(CASE WHEN n <= 5 THEN n ELSE 5 END) r(i)""")
def sample_positions(read):
    return read("events").select("event_id", F.posexplode(O.sample_positions(F.col("event_id") % 23)).alias("o", "f")).select(
        "event_id", F.col("o").cast(B).alias("ordinal"), F.col("f").cast(B).alias("frame"))


# ── grades from events: user = run, hour = scene, type = criterion ─────────
_KEYS = ["visual_match", "readability", "framing", "brand_safety", "extra"]
GRADES_SQL = f"""g0 AS (SELECT user_id AS run_id, event_id // 500 AS scene, list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS c, value FROM events),
g1 AS (SELECT run_id, scene, {lits(_KEYS)}[c] AS criterion, least(10, round(max(value), 1)) AS score FROM g0 GROUP BY ALL),
go AS (SELECT run_id, scene, round_even(sum(CASE WHEN criterion IN {in_list(K.RUBRIC_KEYS)} THEN score ELSE 0 END) / 5, 2) AS overall FROM g1 GROUP BY 1, 2)"""


def grades(read):
    c = F.array_position(X.strings(["click", "error", "purchase", "signup", "view"]), F.col("event_type")).cast("int") - 1
    e = read("events").select(F.col("user_id").alias("run_id"), F.floor(F.col("event_id") / 500).alias("scene"), F.get(X.strings(_KEYS), c).alias("criterion"), "value")
    return e.groupBy("run_id", "scene", "criterion").agg(F.least(F.lit(10.0), F.round(F.max("value"), 1)).alias("score"))


@query("A3", f"WITH {GRADES_SQL} SELECT * FROM go")
def grade_overall(read):
    return O.grade_overall(grades(read))


@query("A4", f"""WITH {GRADES_SQL}, s AS (SELECT run_id, overall + 3 AS overall, run_id % 10 = 3 AS u FROM go WHERE run_id % 12 <> 5 AND (run_id % 3 > 0 OR overall > 4)),
a AS (SELECT run_id, bool_or(u) AS u, min(overall) AS lo FROM s GROUP BY 1)
SELECT DISTINCT e.user_id AS run_id, CASE WHEN lo IS NULL OR a.u THEN 'hold' WHEN lo >= 7 THEN 'pass' WHEN lo < 5 THEN 'fail' ELSE 'hold' END AS decision FROM events e LEFT JOIN a ON a.run_id = e.user_id""")
def decision_band(read):
    s = O.grade_overall(grades(read)).where("run_id % 12 <> 5 AND (run_id % 3 > 0 OR overall > 4)")
    s = s.select("run_id", (F.col("overall") + 3).alias("overall"), (F.col("run_id") % 10 == 3).alias("ungradeable"))
    return O.decision_band(read("events").select(F.col("user_id").alias("run_id")).distinct(), s)


_CODES = ["visual_mismatch", "text_clipped", "off_brand", "unknown", "text_unreadable", "low_quality", "other"]
_DEF = f"d AS (SELECT o_custkey AS run_id, o_orderkey % 9 AS scene, {lits(_CODES)}[1 + o_orderkey % 7] AS code FROM orders)"


@query("A5", f"""WITH {_DEF} SELECT DISTINCT run_id, 're_source' AS action, scene FROM d WHERE code IN {in_list(K.RE_SOURCE_CODES)}
UNION ALL SELECT DISTINCT run_id, 're_render', NULL FROM d WHERE code IN {in_list([*K.RE_SOURCE_CODES, *K.RE_RENDER_CODES])}""")
def route_defects(read):
    d = read("orders").select(F.col("o_custkey").alias("run_id"), (F.col("o_orderkey") % 9).alias("scene"), F.get(X.strings(_CODES), (F.col("o_orderkey") % 7).cast("int")).alias("code"))
    return O.route_defects(d)


_TXT = ["No AUDIO stream", "Dark Ribbon all frames", "Captions exceed"]
_FAIL = f"""d AS (SELECT o_custkey AS run_id, {lits(_TXT)}[1 + (o_orderkey + o_custkey) % 3] AS defect FROM orders),
v AS (SELECT *, u0 OR leg IS NULL OR (t = 'BROLL' AND res = 'acquired' AND m IS NULL) AS u FROM (SELECT l_orderkey AS run_id, 's' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS id, CASE WHEN l_partkey % 2 = 0 THEN 'BROLL' ELSE 'STAT_CARD' END AS t, CASE WHEN l_returnflag = 'R' THEN 'acquired' ELSE 'fallback' END AS res, CASE WHEN l_partkey % 50 = 8 THEN NULL ELSE l_suppkey % 11 END AS m, CASE WHEN l_partkey % 50 = 9 THEN NULL ELSE l_linenumber % 3 > 0 END AS leg, l_partkey % 50 = 7 AS u0 FROM lineitem) z0)"""


def _failures(read):
    d = read("orders").select(F.col("o_custkey").alias("run_id"), F.get(X.strings(_TXT), ((F.col("o_orderkey") + F.col("o_custkey")) % 3).cast("int")).alias("defect"))
    return O.classify_failures(d, _verdicts(read))


def _verdicts(read):
    return dealt(read("lineitem"), "l_orderkey").select(
        F.col("l_orderkey").alias("run_id"), F.concat_ws("_", F.concat(F.lit("s"), F.col("l_linenumber").cast("string")), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id"),
        F.when(F.col("l_partkey") % 2 == 0, "BROLL").otherwise("STAT_CARD").alias("rendered_type"), F.when(F.col("l_returnflag") == "R", "acquired").otherwise("fallback").alias("resolved"),
        F.when(F.col("l_partkey") % 50 != 8, F.col("l_suppkey") % 11).alias("match_score"), F.when(F.col("l_partkey") % 50 != 9, F.col("l_linenumber") % 3 > 0).alias("legible"), (F.col("l_partkey") % 50 == 7).alias("ungradeable"), "l_linenumber", "l_partkey")


_FAIL_ROWS = """SELECT run_id, '_global' AS id, CASE WHEN bool_or(contains(lower(defect), 'audio')) THEN 'heuristic_audio' WHEN bool_or(contains(lower(defect), 'dark ribbon')) THEN 'heuristic_dark_ribbon' ELSE 'heuristic_safezone' END AS kind FROM d GROUP BY 1
UNION ALL SELECT run_id, id, 'error_ungradeable' FROM v WHERE u UNION ALL SELECT run_id, id, 'broll_mismatch' FROM v WHERE NOT u AND t = 'BROLL' AND res = 'acquired' AND m < 5
UNION ALL SELECT run_id, id, 'legibility' FROM v WHERE NOT u AND NOT leg"""


@query("A6", f"WITH {_FAIL} {_FAIL_ROWS}")
def classify_failures(read):
    return _failures(read)


def _fix_shots(read):
    v = _verdicts(read)
    text = F.concat(F.lit("one two three four five six seven "), F.col("l_partkey").cast("string"))
    payload = F.when(F.col("l_partkey") % 5 == 0, F.create_map(F.lit("template"), F.lit("flow"))).when(
        F.col("l_partkey") % 5 == 1, F.create_map(F.lit("url"), F.lit("u"))).otherwise(F.create_map(F.lit("text"), F.lit(" "), F.lit("quote"), text))
    fb = F.struct(F.lit("HEADLINE_CARD").alias("type"), F.create_map(F.lit("text"), F.lit("a b c d e f")).alias("payload"))
    return v.select("run_id", "id", "rendered_type", payload.alias("payload"), F.when(F.col("l_partkey") % 5 == 0, X.strings(["x y z", "p"])).alias("labels"), F.when(F.col("l_partkey") % 9 != 4, fb).alias("fallback"))


_FIXED = f"""f AS (SELECT run_id, id, bool_or(kind = 'broll_mismatch') AS sw, bool_or(kind = 'legibility') AS lg FROM ({_FAIL_ROWS}) z WHERE id <> '_global' GROUP BY 1, 2),
x AS (SELECT *, sw0 AND pk % 9 <> 4 AS sw FROM (SELECT v.run_id, v.id, coalesce(sw, false) AS sw0, coalesce(lg, false) AS lg, CAST(split_part(v.id, '_', 2) AS BIGINT) AS pk, t FROM v LEFT JOIN f USING (run_id, id)) y0)"""


@query("A7", f"""WITH {_FAIL}, {_FIXED} SELECT run_id, id, CASE WHEN sw THEN 'HEADLINE_CARD' ELSE t END AS rendered_type,
  CASE WHEN sw THEN CASE WHEN lg THEN 'a b c d' ELSE 'a b c d e f' END WHEN pk % 5 < 2 THEN '' WHEN lg THEN 'one two three four five' ELSE 'one two three four five six seven ' || pk END AS shown,
  CASE WHEN NOT sw AND pk % 5 = 0 THEN CASE WHEN lg THEN 'x y|p' ELSE 'x y z|p' END END AS labels FROM x""")
def apply_fixes(read):
    fixed, _ = O.apply_fixes(_fix_shots(read), _failures(read))
    shown = F.concat_ws("", F.trim(F.try_element_at("payload", F.lit("text"))), F.try_element_at("payload", F.lit("quote")))
    return fixed.select("run_id", "id", "rendered_type", shown.alias("shown"), F.array_join("labels", "|").alias("labels"))


@query("A7", f"""WITH {_FAIL}, {_FIXED}, l AS (SELECT 'swapped to fallback HEADLINE_CARD' AS fix FROM x WHERE sw UNION ALL SELECT 'no fallback declared' FROM x WHERE sw0 AND NOT sw UNION ALL SELECT CASE WHEN sw THEN 'shortened text for legibility' WHEN pk % 5 = 0 THEN 'shortened labels for legibility'
  WHEN pk % 5 = 1 THEN 'no deterministic legibility fix available' ELSE 'shortened quote for legibility' END FROM x WHERE lg
  UNION ALL SELECT CASE kind WHEN 'heuristic_audio' THEN 'audio stage re-run' WHEN 'heuristic_safezone' THEN 'caption margin bumped +40px' ELSE 'dark-ribbon accent band added' END FROM ({_FAIL_ROWS}) z WHERE id = '_global')
SELECT fix, count(*) AS n FROM l GROUP BY 1""")
def fix_log(read):
    _, log = O.apply_fixes(_fix_shots(read), _failures(read))
    return log.groupBy("fix").agg(F.count("*").alias("n"))


@query("A8", f"""WITH {_FAIL}, x AS (SELECT run_id, id, CAST(split_part(id, '_', 2) AS BIGINT) AS pk FROM v) SELECT run_id, id, 'legibility' AS kind FROM x WHERE pk % 5 > 1 AND pk % 7 = 0""")
def revise_loop(read):
    """Shots whose text stays too long after two shortenings have failed: 8 words -> 5 -> 3 against a limit of 2."""
    def gate(shots):
        text = F.coalesce(F.try_element_at("payload", F.lit("quote")), F.lit(""))
        limit = F.when(F.split_part("id", F.lit("_"), F.lit(2)).cast("bigint") % 7 == 0, 2).otherwise(3)
        return shots.where(X.word_count(text) > limit).select("run_id", "id", F.lit("legibility").alias("kind"))
    _, left, _ = O.revise_loop(_fix_shots(read).dropDuplicates(["run_id", "id"]), gate)
    return left


_FLAGS = ["text_unrelated", "weak_transition", "off_hero_claim", "visual_mismatch", "none"]
_CRIT = f"c AS (SELECT event_id, [{lits(_FLAGS)}[1 + event_id % 5]] AS flags, 3 + event_id % 8 AS alignment, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(value) AS BIGINT) % 11 END AS verdict FROM events)"


def _crit(read):
    return read("events").select("event_id", F.array(F.get(X.strings(_FLAGS), (F.col("event_id") % 5).cast("int"))).alias("flags"), (3 + F.col("event_id") % 8).alias("alignment"),
                                 F.when(F.col("event_type") == "error", None).otherwise(F.floor("value") % 11).alias("verdict"))


@query("A9", f"""WITH {_CRIT} SELECT event_id, CASE WHEN verdict < 6 AND flags[1] <> 'visual_mismatch' THEN flags[1] || '|visual_mismatch' ELSE flags[1] END AS flags, CASE WHEN verdict < 6 THEN least(alignment, 4) ELSE alignment END AS alignment FROM c""")
def critic_override(read):
    return O.critic_override(_crit(read)).select("event_id", F.array_join("flags", "|").alias("flags"), "alignment")


@query("A10", f"""WITH {_CRIT} SELECT event_id, flags[1] IN ('off_hero_claim', 'visual_mismatch') AS re_source, coalesce(nullif(array_to_string(list_filter([CASE WHEN flags[1] = 'text_unrelated' THEN 'on_screen_text' END,
  CASE WHEN flags[1] = 'weak_transition' OR alignment < 4 THEN 'narration' END, CASE WHEN flags[1] = 'off_hero_claim' THEN 'visual_concept' END], lambda x: x IS NOT NULL), '|'), ''), 'on_screen_text') AS fields FROM c WHERE alignment < 7""")
def revise_request(read):
    return O.revise_request(_crit(read)).select("event_id", "re_source", F.array_join("fields", "|").alias("fields"))


_QR = """sc AS (SELECT o_custkey AS run_id, o_orderkey AS scene, o_totalprice / 1000 AS duration_s, o_orderkey % 9 = 4 AS re_sourced FROM orders),
ast AS (SELECT o_custkey AS run_id, o_orderkey AS scene, CASE WHEN o_orderkey % 3 = 0 THEN 'own_footage' ELSE 'web' END AS source, o_orderkey % 100 AS score, 1920 AS width, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 11 END AS vision_score FROM orders WHERE o_orderkey % 4 > 0),
fl AS (SELECT o_custkey AS run_id, l_orderkey AS scene, 'flag' || l_linenumber AS flag FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R')"""


@query("A11", f"""WITH {_QR}, f AS (SELECT run_id, scene, count(*) AS n, string_agg(flag, ',' ORDER BY flag) AS flags FROM fl GROUP BY 1, 2), tt AS (SELECT run_id, count(*) AS run_scenes, round(sum(duration_s), 2) AS run_duration_s, count_if(re_sourced) AS run_re_sourced FROM sc GROUP BY 1)
SELECT run_id, scene, round(duration_s, 2) AS duration_s, source, score, coalesce(width, 0) AS width, CASE WHEN width IS NULL THEN 0 ELSE 1080 END AS height, vision_score, re_sourced, coalesce(n, 0) AS n_flags, flags, run_scenes, run_duration_s, run_re_sourced, source IS NULL AS degraded, coalesce(source = 'own_footage', false) AS is_own_footage
FROM sc LEFT JOIN ast USING (run_id, scene) LEFT JOIN f USING (run_id, scene) JOIN tt USING (run_id)""")
def quality_report(read):
    o = read("orders")
    base = [F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("scene")]
    sc = o.select(*base, (F.col("o_totalprice") / 1000).alias("duration_s"), (F.col("o_orderkey") % 9 == 4).alias("re_sourced"))
    ast = o.where("o_orderkey % 4 > 0").select(*base, F.when(F.col("o_orderkey") % 3 == 0, "own_footage").otherwise("web").alias("source"), (F.col("o_orderkey") % 100).alias("score"), F.lit(1920).alias("width"), F.lit(1080).alias("height"),
                                              F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey") % 11).alias("vision_score"))
    fl = read("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("scene"), F.concat(F.lit("flag"), F.col("l_linenumber").cast("string")).alias("flag")).join(o.select(*base), "scene")
    return O.quality_report(sc, ast, fl)


@query("A12", f"""WITH {V.SCRIPTS_SQL}, sh AS (SELECT l_orderkey AS run_id, l_linenumber - 1 AS pos, 's' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS id, l_returnflag AS resolved FROM lineitem),
v AS (SELECT l_orderkey AS run_id, 's' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS id, CASE WHEN l_partkey % 50 = 8 THEN NULL ELSE l_suppkey % 11 END AS match_score, CASE WHEN l_partkey % 50 = 9 THEN NULL ELSE l_linenumber % 3 > 0 END AS legible, true AS judged FROM lineitem WHERE l_linenumber <> 4),
fc AS (SELECT run_id, pos, string_agg(f.id || ': ' || f.quote, ' | ' ORDER BY i) AS facts FROM (SELECT run_id, pos, i, fact_ids[i] AS id FROM scripts, range(1, len(fact_ids) + 1) t(i)) r JOIN sfacts f USING (run_id, id) GROUP BY 1, 2)
SELECT sh.run_id, sh.pos, sh.id, resolved, match_score, legible, narration, card_text, coalesce(facts, '') AS facts,
  array_to_string(list_filter([CASE WHEN judged IS NULL OR legible IS NULL THEN 'not judged' END, CASE WHEN NOT legible THEN 'not legible' END, CASE WHEN match_score < 5 THEN 'weak match' END], lambda x: x IS NOT NULL), '; ') AS issues FROM sh LEFT JOIN v USING (run_id, id) LEFT JOIN scripts s ON s.run_id = sh.run_id AND s.pos = sh.pos LEFT JOIN fc ON fc.run_id = sh.run_id AND fc.pos = sh.pos""")
def review_sheet(read):
    v = _verdicts(read)
    shots = read("lineitem").select(F.col("l_orderkey").alias("run_id"), (F.col("l_linenumber") - 1).cast(B).alias("pos"),
                                    F.concat_ws("_", F.concat(F.lit("s"), F.col("l_linenumber").cast("string")), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id"), F.col("l_returnflag").alias("resolved"))
    return O.review_sheet(shots, v.where("l_linenumber <> 4"), V.scripts(read), V.script_facts(read)).select("run_id", "pos", "id", "resolved", "match_score", "legible", "narration", "card_text", "facts", "issues")


@query("A15", f"""WITH {_FAIL} SELECT run_id, id, CASE WHEN CAST(split_part(id, '_', 2) AS BIGINT) % 5 = 0 THEN 'x y z | p' WHEN CAST(split_part(id, '_', 2) AS BIGINT) % 5 = 1 THEN '' ELSE '  | one two three four five six seven ' || split_part(id, '_', 2) END AS expected FROM v""")
def expected_text(read):
    return _fix_shots(read).select("run_id", "id", O.expected_text().alias("expected"))


# ── history ────────────────────────────────────────────────────────────────
NOW = "2024-01-31 00:00:00"


def _history(read):
    k = F.col("event_id") % 6
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    made = (F.when(k == 0, F.concat(iso, F.lit("+00:00"))).when(k == 1, "soon").when(k == 2, F.date_format("ts", "yyyy-MM-dd")).when(k == 3, F.concat(F.date_format(F.col("ts") + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
            .otherwise(iso))
    ok = lambda c: F.struct(c.alias("success"))
    res = F.create_map(F.lit("alpha"), ok(F.col("value") > 5), F.lit("beta"), ok(F.when(F.col("event_type") == "view", F.lit(True))))
    return read("events").select("event_id", F.col("user_id").alias("page_key"), made.alias("created_at"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("region"), res.alias("publish_results"))


@query("A1", f"""WITH h AS (SELECT *, CASE event_id % 6 WHEN 1 THEN NULL WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('second', ts) ELSE ts END AS t FROM events), r AS (SELECT * FROM h WHERE t >= TIMESTAMP '{NOW}' - INTERVAL 20 DAYS)
SELECT 'count' AS metric, '' AS key, count(*) AS n FROM r UNION ALL SELECT 'region', CASE event_type WHEN 'error' THEN 'unknown' ELSE event_type END, count(*) FROM r GROUP BY 2
UNION ALL SELECT 'platform', 'alpha', count(*) FROM r WHERE value > 5 UNION ALL SELECT 'platform', 'beta', count(*) FROM r WHERE event_type = 'view'""")
def history_stats(read):
    return O.history_stats(_history(read), NOW, days=20)


@query("A2", "SELECT user_id AS page_key, min(event_id) AS event_id, CASE arg_min(event_type, event_id) WHEN 'error' THEN NULL ELSE arg_min(event_type, event_id) END AS region FROM events GROUP BY 1")
def find_by_key(read):
    return O.find_by_key(_history(read), "page_key", "event_id").select("page_key", "event_id", "region")


# ── run state ──────────────────────────────────────────────────────────────
ORDER = ["signup", "view", "click", "purchase"]


def run_events(read):
    art = F.when(F.col("event_type") == "error", F.expr("cast(map() as map<string,string>)")).otherwise(F.create_map(F.col("event_type"), F.concat(F.lit("p"), F.col("event_id").cast("string"))))
    return read("events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("status"), art.alias("artifacts"),
                                 F.when(F.col("event_type") == "error", F.concat(F.lit("e"), F.col("event_id").cast("string"))).alias("error"))


STATE_SQL = """st AS (SELECT user_id AS run_id, arg_max(event_type, event_id) AS status, arg_max(event_type, event_id) FILTER (event_type <> 'error') AS last_ok, 'e' || max(event_id) FILTER (event_type = 'error') AS error FROM events GROUP BY 1)"""


@query("P1", f"""WITH {STATE_SQL}, a AS (SELECT user_id AS run_id, string_agg(k || '=p' || v, ',' ORDER BY k) AS artifacts FROM (SELECT user_id, event_type AS k, max(event_id) AS v FROM events WHERE event_type <> 'error' GROUP BY 1, 2) z GROUP BY 1)
SELECT st.*, artifacts FROM st LEFT JOIN a USING (run_id)""")
def current_state(read):
    s = P.current_state(run_events(read), failed="error")
    arts = F.array_join(F.transform(F.map_entries("artifacts"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return s.withColumn("artifacts", arts)


@query("P2", f"""WITH {STATE_SQL}, x AS (SELECT run_id, coalesce(list_position({lits(ORDER)}, last_ok), 0) - 1 AS last FROM st)
SELECT run_id, {lits(ORDER)}[i + 1] AS stage, i AS ord FROM x, range(4) r(i) WHERE i > last AND (i <= 2 OR last >= 2)""")
def remaining_stages(read):
    return P.remaining_stages(P.current_state(run_events(read), failed="error"), ORDER, until="click")


@query("P3", f"""WITH p AS (SELECT user_id AS run_id, event_id AS seq, event_type AS status, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events)
SELECT *, coalesce(list_position({lits(ORDER)}, nullif(status, 'error')) > list_position({lits(ORDER)}, nullif(previous, 'error')), true) AS forward FROM p""")
def status_transitions(read):
    return P.status_transitions(run_events(read).select("run_id", "seq", "status"), ORDER)


_IDX = "idx AS (SELECT url AS path, page_id % 5 AS mtime, page_id % 4 = 0 AS failed FROM pages WHERE page_id % 3 > 0), lst AS (SELECT url AS path, page_id % 5 + CASE WHEN page_id % 7 = 0 THEN 1 ELSE 0 END AS mtime FROM pages)"


def _idx(read):
    p = read("pages").select("page_id", F.col("url").alias("path"))
    idx = p.where("page_id % 3 > 0").selectExpr("path", "page_id % 5 AS mtime", "page_id % 4 = 0 AS failed")
    return idx, p.selectExpr("path", "page_id % 5 + CASE WHEN page_id % 7 = 0 THEN 1 ELSE 0 END AS mtime")


@query("P4", f"WITH {_IDX} SELECT lst.path, lst.mtime, false AS forced FROM lst ANTI JOIN idx USING (path, mtime) UNION ALL SELECT lst.path, lst.mtime, true FROM lst ANTI JOIN (SELECT * FROM idx WHERE NOT failed) i USING (path, mtime)")
def incremental_index(read):
    idx, lst = _idx(read)
    return P.incremental_index(idx, lst).withColumn("forced", F.lit(False)).unionByName(P.incremental_index(idx, lst, force=True).withColumn("forced", F.lit(True)))


@query("P4", f"WITH {_IDX}, d AS (SELECT lst.path, lst.mtime FROM lst ANTI JOIN idx USING (path, mtime)) SELECT path, mtime, failed FROM idx WHERE path NOT IN (SELECT path FROM d) UNION ALL SELECT path, mtime, false FROM d")
def merged_index(read):
    idx, lst = _idx(read)
    return P.merge_index(idx, P.incremental_index(idx, lst).withColumn("failed", F.lit(False)))


_QK = "sha1(source || '|' || lower(trim(q)))"
_CACHE = f"""rq AS (SELECT doc_id, {_QK} AS key FROM (SELECT doc_id, source, CASE WHEN doc_id % 2 = 0 THEN '  Pump ' ELSE 'pump' END || CASE WHEN doc_id % 3 = 0 THEN '' ELSE ' tank' END AS q FROM documents) z),
ch AS (SELECT DISTINCT {_QK} AS key, 'cached ' || source AS payload FROM (SELECT source, 'pump' AS q FROM documents) y)"""


def _cache(read):
    d = read("documents").select("doc_id", "source")
    q = F.concat(F.when(F.col("doc_id") % 2 == 0, "  Pump ").otherwise("pump"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(" tank"))
    rq = d.select("doc_id", P.query_key("source", q).alias("key"))
    return rq, d.select(P.query_key("source", F.lit("pump")).alias("key"), F.concat(F.lit("cached "), "source").alias("payload")).distinct()


@query("P5", f"WITH {_CACHE} SELECT doc_id, key, payload FROM rq JOIN ch USING (key)")
def query_cache_hits(read):
    return P.split_by_cache(*_cache(read))[0].select("doc_id", "key", "payload")


@query("P5", f"WITH {_CACHE} SELECT key, min(doc_id) AS doc_id FROM rq WHERE key NOT IN (SELECT key FROM ch) GROUP BY 1")
def query_cache_misses(read):
    return P.split_by_cache(*_cache(read))[1]


@query("P6", "SELECT sha1(text) AS key, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def content_cache_keys(read):
    return read("documents").select("doc_id", P.content_key("text").alias("key")).groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("P6", "SELECT page_id, sha256(url) AS key FROM pages")
def page_cache_keys(read):
    return read("pages").select("page_id", P.page_key("url").alias("key"))


@query("P7", """WITH a AS (SELECT user_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS attempt, CASE WHEN value < 2 THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS errors FROM events WHERE event_id < 1000),
l AS (SELECT * FROM a WHERE attempt <= 3), f AS (SELECT id, min(attempt) FILTER (errors = 0) AS ok, max(attempt) AS last, arg_max(errors, attempt) AS err FROM l GROUP BY 1)
SELECT id, coalesce(ok, last) AS attempt, CASE WHEN ok IS NOT NULL THEN 'ok' ELSE 'failed' END AS status, CASE WHEN ok IS NOT NULL THEN 0 ELSE err END AS errors FROM f""".replace(" WHERE event_id < 1000", ""))
def attempts_log(read):
    from plumbline.operators.ordered import scan
    e = read("events").select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.when(F.col("value") < 2, 0).otherwise(F.floor("value")).alias("errors"))
    return P.attempts_log(scan(e, ["id"], ["seq"], sums={"attempt": F.lit(1)}).withColumn("attempt", (F.col("attempt") + 1).cast(B)), 3)
