"""Contracts, model text, loose maps, dimensions and publishing text."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions import structured as S
from plumbline.functions import text as X
from plumbline.operators.scoring import clamp, score_with
from plumbline.plans.registry import query
from plumbline.plans.sqlkit import in_list, lit, lits, strip, words

_K = "CAST(json_extract(props, '$.k') AS BIGINT)"
# Answers derived from the events: by type complete, short of a key, with a key too many, of a wrong type, or cut off.
_RAW = """CASE event_type WHEN 'signup' THEN '{"actionable_score": ' || k || ', "coherence_score": 5, "reason_score": 7, "revise_notes": "n"}'
  WHEN 'view' THEN '{"actionable_score": ' || k || ', "coherence_score": 5, "revise_notes": "n", "zz": 1}'
  WHEN 'click' THEN '{"actionable_score": "' || k || '", "coherence_score": 5, "reason_score": 7, "revise_notes": "n"}'
  WHEN 'purchase' THEN '[' || k || ']' ELSE '{"actionable_score": ' || k END"""


def _events(read):
    return read("events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


@query("F6", f"""WITH e AS (SELECT event_id, event_type, {_K} AS k FROM events)
SELECT event_id, CASE event_type WHEN 'signup' THEN CASE WHEN k > 10 THEN 'actionable_score: out of range' ELSE '' END
  WHEN 'view' THEN CASE WHEN k > 10 THEN 'actionable_score: out of range; ' ELSE '' END || 'reason_score: required; zz: unexpected'
  WHEN 'click' THEN 'actionable_score: wrong type' ELSE 'top level: not an object' END AS problems,
  event_type = 'signup' AND k <= 10 AS valid FROM e""")
def validate_structured(read):
    out = S.validate_structured(_events(read).withColumn("raw", F.expr(_RAW)), "critique")
    return out.select("event_id", F.array_join("problems", "; ").alias("problems"), "valid")


@query("F6", f"""WITH e AS (SELECT event_id, {_K} AS k FROM events)
SELECT event_id, array_to_string(list_filter(['facts/0/tags: not allowed', CASE WHEN NOT (k BETWEEN 1 AND 5) THEN 'facts/0/procurement_significance: out of range' END], lambda x: x IS NOT NULL), '; ') AS problems FROM e WHERE k % 2 = 0
UNION ALL SELECT event_id, CASE WHEN NOT (k BETWEEN 1 AND 5) THEN 'facts/0/procurement_significance: out of range' ELSE '' END FROM e WHERE k % 2 = 1""")
def validate_fact_list(read):
    raw = F.concat(F.lit('{"facts": [{"id": "f1", "verbatim_quote": "q", "value": "1", "unit": "", "claim_summary": "c", "tags": ["metric", "'),
                   F.when(F.col("k") % 2 == 0, "odd").otherwise("risk"), F.lit('"], "procurement_significance": '), F.col("k").cast("string"), F.lit(', "citation_marker": null}]}'))
    out = S.validate_structured(_events(read).withColumn("raw", raw), "facts")
    return out.select("event_id", F.array_join("problems", "; ").alias("problems"))


@query("F20", """SELECT conv_id, turn, '{"a": ' || turn || ', "t": "x}",' || chr(10) || ' "b": [{"c": 1},' || chr(10) || ' {"d": 2}]}' AS json FROM conversations WHERE conv_id % 2 = 0
UNION ALL SELECT conv_id, turn, 'no answer at ' || turn FROM conversations WHERE conv_id % 2 = 1""")
def clean_model_text(read):
    fine = F.concat(F.lit('\x1b[1mSure:\x1b[0m <|channel>thought\nhm {"x": 1}<channel|>\n```json\n{"a": '), F.col("turn").cast("string"),
                    F.lit(', "t": "x}",\n "b": [{"c": 1}\n {"d": 2},]}\n```'))
    raw = F.when(F.col("conv_id") % 2 == 0, fine).otherwise(F.concat(F.lit("no answer at "), F.col("turn").cast("string")))
    return S.clean_model_text(read("conversations").select("conv_id", "turn", raw.alias("raw"))).select("conv_id", "turn", "json")


@query("F20", """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '{"score": ' || turn || ', "why": "line  two"}' END AS json FROM conversations""")
def last_model_object(read):
    raw = F.when(F.col("turn") % 2 == 0, F.concat(F.lit('maybe {"score": 99} ...done thinking.\nI say {"score": '), F.col("turn").cast("string"),
                                                  F.lit(', "why": "line \ntwo"} ok'))).otherwise("{broken ...done thinking. nothing }")
    return S.clean_model_text(read("conversations").select("conv_id", "turn", raw.alias("raw")), mode="last").select("conv_id", "turn", "json")


_MAP = """'{"dose_rate": "' || value || ' kg", "k": ' || k || ', "name": "none", "in": {"a": 1}, "neg-temp": "about -3,5"}'"""


@query("F26", f"""WITH e AS (SELECT event_id, value, {_K} AS k FROM events)
SELECT event_id, 0 AS pos, 'Dose Rate' AS label, value AS num, value || ' kg' AS raw FROM e UNION ALL SELECT event_id, 1, 'K', k, '' || k FROM e UNION ALL SELECT event_id, 2, 'Neg Temp', -3.5, 'about -3,5' FROM e""")
def numeric_pairs(read):
    e = _events(read).withColumn("m", F.expr(_MAP))
    return e.select("event_id", F.posexplode(S.numeric_pairs("m")).alias("p", "e")).select("event_id", F.col("p").cast("bigint").alias("pos"), "e.*")


_CHART = """CASE event_type WHEN 'click' THEN '{"label2": "b", "value2": "' || k || ' kg", "label1": "a", "value1": 3}'
  WHEN 'view' THEN '{"name": "x", "peak_load": "' || k || '%"}' WHEN 'signup' THEN '{"before": ' || k || ', "after": "2,5"}'
  WHEN 'purchase' THEN '{"steps": ["in", "s' || k || '"]}' ELSE '{"x": [1]}' END"""


@query("F26", f"""WITH e AS (SELECT event_id, event_type, {_K} AS k FROM events)
SELECT event_id, CASE event_type WHEN 'click' THEN 'a|b' WHEN 'view' THEN 'Peak Load' WHEN 'signup' THEN 'Before|After' WHEN 'purchase' THEN 'in|s' || k END AS labels,
  CASE event_type WHEN 'click' THEN '3.0|' || k || '.0' WHEN 'view' THEN k || '%' WHEN 'signup' THEN k || '|2,5' WHEN 'purchase' THEN '' END AS vals FROM e""")
def chart_series(read):
    kind = S.lookup("event_type", {"click": "bar", "view": "callout_stat", "signup": "comparison", "purchase": "flow"}, "line")
    e = _events(read).withColumn("s", S.chart_series(kind, F.expr(_CHART)))
    return e.select("event_id", F.array_join(F.col("s")["labels"], "|").alias("labels"), F.array_join(F.col("s")["values"], "|").alias("vals"))


@query("F26", r"""SELECT doc_id, try_cast(replace(nullif(regexp_extract(text, '-?\p{Nd}+(?:[.,]\p{Nd}+)?'), ''), ',', '.') AS DOUBLE) AS num FROM documents""")
def coerce_number(read):
    return read("documents").select("doc_id", S.coerce_number("text").alias("num"))


_REGIONS = ["australia", "usa", "eu", "germany", "east_asia", "gulf", "Germany", "mars"]


def _case(col, table, default):
    return f"CASE {col} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items()) + f" ELSE {lit(default)} END"


@query("F30", f"""WITH e AS (SELECT event_id, {lits(_REGIONS)}[1 + user_id % 8] AS region, {lits([*K.PROSODY_BY_BEAT, 'other'])}[1 + event_id % 6] AS beat FROM events)
SELECT event_id, {_case('region', K.REGION_LANGUAGE, 'en')} AS language, {_case('region', K.REGION_TIMEZONE, 'UTC')} AS timezone, {_case('region', K.REGION_VOICE, K.REGION_VOICE['default'])} AS voice,
  {_case('lower(region)', K.CAPTION_LANGUAGE, 'en')} AS caption_language, {_case('beat', K.PROSODY_BY_BEAT, 'conversational')} AS prosody FROM e""")
def region_dims(read):
    region = F.get(X.strings(_REGIONS), (F.col("user_id") % 8).cast("int"))
    beat = F.get(X.strings([*K.PROSODY_BY_BEAT, "other"]), (F.col("event_id") % 6).cast("int"))
    return read("events").select("event_id", *S.region_dims(region), S.prosody(beat).alias("prosody"))


@query("F31", f"""SELECT conv_id AS run_id, turn AS pos, CASE WHEN turn % 3 = 0 THEN 'cold_blue' ELSE 'neutral_doc' END AS color_grade, 'fade' AS transition_in,
  CASE WHEN conv_id % 2 = 0 AND turn < 4 THEN 'drift' ELSE 'slow_push' END AS motion, 'conversational' AS voice_prosody, turn % 3 = 0 OR (conv_id % 2 = 0 AND turn < 4) AS applied FROM conversations""")
def enum_or_default(read):
    scenes = read("conversations").select(F.col("conv_id").alias("run_id"), F.col("turn").alias("pos"), F.lit("neutral_doc").alias("color_grade"),
                                          F.lit("fade").alias("transition_in"), F.lit("slow_push").alias("motion"), F.lit("conversational").alias("voice_prosody"))
    choices = scenes.select("run_id", "pos", F.when(F.col("pos") % 3 == 0, "cold_blue").otherwise("pink").alias("color_grade"), F.lit("wipe").alias("transition_in"),
                            F.when((F.col("run_id") % 2 == 0) & (F.col("pos") < 4), "drift").alias("motion"), F.lit("").alias("voice_prosody"))
    return S.enum_or_default(scenes, choices)


def _banned_sql(c: str) -> str:
    for p in K.SCRIPT_BANNED_PHRASES:
        c = f"regexp_replace({c}, {lit('(?i)' + p.replace('-', '[-]'))}, ' ', 'g')"
    return strip(f"regexp_replace({c}, {lit(K.WS + '+')}, ' ', 'g')")


_PUB = f"""p0 AS (SELECT conv_id, turn, ['australia', '', 'east_asia'][1 + conv_id % 3] AS region, ['water_treatment', ''][1 + turn % 2] AS category,
   CASE WHEN turn = 6 THEN '' ELSE text END AS claim, role AS sub FROM conversations),
p1 AS (SELECT *, CASE region WHEN '' THEN '' ELSE upper(region[1:1]) || region[2:] END AS r, CASE category WHEN '' THEN '' ELSE 'Water Treatment' END AS cat,
   regexp_replace(array_to_string(({words('claim')})[1:10], ' '), '^[.,!?]+|[.,!?]+$', '', 'g') AS hook FROM p0),
p2 AS (SELECT *, CASE WHEN r <> '' AND cat <> '' AND hook <> '' THEN r || ' ' || cat || ': ' || hook WHEN cat <> '' AND hook <> '' THEN cat || ': ' || hook WHEN hook <> '' THEN hook ELSE 'Technical Deep Dive' END AS t FROM p1)"""


@query("F29", f"""WITH {_PUB}, d AS (SELECT *, 'Key insight: ' || turn || '%' || chr(10) || CASE WHEN claim <> '' THEN {strip('claim[1:80]')} || chr(10) ELSE '' END || chr(10) || 'Learn more: https://example.org/' || chr(10)
   || '#Shorts #ChemicalEngineering #' || replace(lower(region), '_', '') || ' #' || replace(lower(category), '_', '') AS d FROM p2)
SELECT conv_id, turn, coalesce(nullif({_banned_sql('t[1:100]')}, ''), 'Technical Deep Dive') AS title, {_banned_sql('d[1:4900]')} AS description,
  array_to_string(list_filter([nullif(region, ''), nullif(replace(category, '_', ' '), ''), CASE WHEN sub <> category THEN lower(sub) END, 'calcium nitrate', 'chemistry'], lambda x: x IS NOT NULL)[1:5], '|') AS tags FROM d""")
def publish_text(read):
    c = read("conversations").select(
        "conv_id", "turn", F.get(X.strings(["australia", "", "east_asia"]), (F.col("conv_id") % 3).cast("int")).alias("region"),
        F.get(X.strings(["water_treatment", ""]), (F.col("turn") % 2).cast("int")).alias("category"), F.when(F.col("turn") == 6, "").otherwise(F.col("text")).alias("claim"), F.col("role").alias("sub"))
    return c.select("conv_id", "turn", S.publish_title("region", "category", "claim").alias("title"),
                    S.publish_description(F.concat(F.col("turn").cast("string"), F.lit("%")), "claim", "region", "category", "https://example.org").alias("description"),
                    F.array_join(S.publish_tags("region", "category", "sub"), "|").alias("tags"))


def overlap_scorer():
    """Deterministic stand-in for a model: score by shared words; fails on some rows."""
    def score(row, problem):
        if row["turn"] % 5 == 4 and problem is None:
            raise ValueError("warming up")
        if row["turn"] == 3:
            raise TimeoutError("no answer")
        return {"score": min(12, len(set(row["text"].lower().split()) & {"the", "of", "and", "de", "la", "en"}) * 3), "reason": "overlap", "focal_hint": "center"}
    return score


_SHARED = f"len(list_intersect(list_distinct({words('lower(text)')}), ['the', 'of', 'and', 'de', 'la', 'en'])) * 3"


@query("U1", f"""WITH s AS (SELECT conv_id, turn, least(12, {_SHARED}) AS s FROM conversations)
SELECT conv_id, turn, CASE WHEN turn <> 3 AND s <= 10 THEN s END AS score, CASE WHEN turn = 3 THEN 3 WHEN turn % 5 = 4 THEN 2 ELSE 1 END AS attempts,
  CASE WHEN turn = 3 THEN 'TimeoutError: no answer' WHEN s > 10 THEN 'score: out of range' END AS problem FROM s""")
def score_with_callable(read):
    out = score_with(read("conversations").select("conv_id", "turn", "text"), overlap_scorer, "match", inputs=["turn", "text"])
    return out.select("conv_id", "turn", F.get_json_object("answer", "$.score").cast("bigint").alias("score"), F.col("attempts").cast("bigint").alias("attempts"), "problem")
