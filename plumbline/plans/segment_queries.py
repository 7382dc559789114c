"""Segment expansion, timing and cues."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions import links as L
from plumbline.functions import text as X
from plumbline.operators import segments as S
from plumbline.plans import standins as V
from plumbline.plans.gate_queries import RULES
from plumbline.plans.registry import query
from plumbline.session import cut, cut_in_place, dealt
from plumbline.plans.sqlkit import lit, lits, numbers, strip, words

W = "CAST(1.7 AS DOUBLE)"
PHRASES = f"list_filter(list_transform(string_split_regex(narration, '[,.;:]+'), lambda p: {strip('p')}), lambda p: p <> '')"


def long_sql(phrases: str) -> str:
    return (f"flatten(list_transform({phrases}, lambda p: CASE WHEN len({words('p')}) / {W} > 3.5 THEN list_transform(range(0, len({words('p')}), 5), "
            f"lambda i: array_to_string(({words('p')})[i + 1:i + 5], ' ')) ELSE [p] END))")


_TEXTS = "texts AS (SELECT conv_id AS id, turn AS pos, text AS narration FROM conversations UNION ALL SELECT run_id, pos + 100, narration FROM scripts)"


def _texts(read):
    conv = read("conversations").select(F.col("conv_id").alias("id"), F.col("turn").alias("pos"), F.col("text").alias("narration"))
    return conv.unionByName(V.scripts(read).select(F.col("run_id").alias("id"), (F.col("pos") + 100).alias("pos"), "narration"))


@query("T1", f"WITH t AS (SELECT doc_id, text AS narration FROM documents) SELECT doc_id, len({PHRASES}) AS n_phrases, md5(array_to_string({PHRASES}, '|')) AS phrases_md5, round(len({words('narration')}) / {W}, 6) AS est_s FROM t")
def split_phrases(read):
    return read("documents").select("doc_id", X.split_phrases("text").alias("p"), F.round(X.estimate_s("text"), 6).alias("est_s")).select(
        "doc_id", F.size("p").cast("bigint").alias("n_phrases"), F.md5(F.array_join("p", "|")).alias("phrases_md5"), "est_s")


@query("T2", f"WITH t AS (SELECT doc_id, text AS narration FROM documents) SELECT doc_id, md5(array_to_string({long_sql(PHRASES)}, '|')) AS pieces_md5 FROM t")
def chunk_long(read):
    return read("documents").select("doc_id", F.md5(F.array_join(X.chunk_long(X.split_phrases("text")), "|")).alias("pieces_md5"))


_CUR, _DONE = "split_part(a, chr(2), 2)", "split_part(a, chr(2), 1)"
PACK = f"""packed AS (SELECT id, pos, list_reduce(list_prepend(chr(2), {long_sql(PHRASES)}), lambda a, p: CASE WHEN {_CUR} = '' THEN {_DONE} || chr(2) || p
   WHEN len({words(f"{_CUR} || ', ' || p")}) / {W} <= 3.5 THEN {_DONE} || chr(2) || {_CUR} || ', ' || p ELSE {_DONE} || {_CUR} || chr(1) || chr(2) || p END) AS a FROM texts),
spans AS (SELECT id, pos, CASE WHEN {_CUR} = '' THEN rtrim({_DONE}, chr(1)) WHEN {_DONE} <> '' AND len({words(_CUR)}) / {W} < 1.0 THEN rtrim({_DONE}, chr(1)) || ', ' || {_CUR}
   ELSE {_DONE} || {_CUR} END AS joined FROM packed)"""


@query("T3", f"WITH {V.SCRIPTS_SQL}, {_TEXTS}, {PACK} SELECT id, pos, replace(joined, chr(1), '|') AS spans FROM spans")
def pack_phrases(read):
    return _texts(read).select("id", "pos", F.array_join(X.pack_phrases(X.split_phrases("narration")), "|").alias("spans"))


def shots(read):
    """Planned shots; a stage boundary, so the expansion runs once for all that follows.

    Scripts, facts and citations are dealt out by run, so none of the joins in it shuffles them again.
    """
    return cut_in_place(_expand(read), "shots")


def _expand(read):
    return S.expand_segments(V.scripts(read), V.script_facts(read), V.script_citations(read), RULES)


def _stat_sql(f: str) -> str:
    return f"'value=' || {f}.value || '|unit=units|label=' || card_text || '|citation=' || {_chip_sql(f)} || '|fact_id=' || {f}.id"


def _chip_sql(f: str) -> str:
    return (f"CASE WHEN {f}.url IS NULL THEN 'Source — blog' ELSE 'Source [' || {f}.marker || '] — ' || "
            f"regexp_replace(regexp_extract({f}.url, '^[a-zA-Z]+://([^/?#]*)', 1), '^www\\.', '') END")


def _shot_sql(kind: str, span: str, payload: str, labels: str = "NULL", fallback: str = "NULL") -> str:
    return f"{{'type': '{kind}', 'span': {span}, 'labels': {labels}, 'payload': {payload}, 'fallback': {fallback}}}"


_HEAD, _HEADLINE, _BROLL = "'text=' || card_text", "'text=' || card_text || '|wish=' || broll_wish", "'wish=' || broll_wish || '|layout=auto'"
_QUOTE = f"'quote=' || fact.quote || '|source=' || {_chip_sql('fact')}"
_HAS = "regexp_matches(coalesce({}.value, ''), '[0-9]')"
_RULE_TREE = f"""CASE beat
  WHEN 'hook' THEN CASE WHEN broll_wish <> '' AND n >= 2 THEN [{_shot_sql('BROLL', 'head', _BROLL, fallback=f"'HEADLINE_CARD:' || {_HEADLINE}")}, {_shot_sql('HEADLINE_CARD', 'rest', _HEADLINE)}]
    ELSE [{_shot_sql('HEADLINE_CARD', 'narration', _HEADLINE)}] END
  WHEN 'stakes' THEN list_concat(CASE WHEN num IS NOT NULL THEN [{_shot_sql('STAT_CARD', 'head', _stat_sql('num'))}] ELSE [{_shot_sql('HEADLINE_CARD', 'head', _HEAD)}] END,
    CASE WHEN n > 1 THEN [{_shot_sql('HEADLINE_CARD', 'rest', _HEAD)}] ELSE [] END)
  WHEN 'mechanism' THEN list_transform(range(1, k + 1), lambda i: {_shot_sql('DIAGRAM', "CASE WHEN k <= 1 THEN narration WHEN i < k THEN sp[i] ELSE array_to_string(sp[k:], ', ') END", "'template=flow|reveal_stage=' || i || '|reveal_total=' || k", labels="array_to_string(shown, '|')")})
  WHEN 'proof' THEN CASE
    WHEN paper IS NOT NULL THEN [{_shot_sql('PAPER_CARD', 'head', "'marker=' || coalesce(CAST(paper.marker AS VARCHAR), '') || '|url=' || paper.url || '|highlight=' || card_text || '|wish=' || broll_wish", fallback="'QUOTE_CARD:quote=' || paper.quote || '|source=' || " + _chip_sql('paper'))}, {_shot_sql('STAT_CARD', 'roa', _stat_sql('pstat'))}]
    WHEN broll_wish <> '' AND n >= 2 AND fact IS NOT NULL THEN [{_shot_sql('BROLL', 'head', _BROLL, fallback=f"'STAT_CARD:' || {_stat_sql('fact')}")}, {_shot_sql('QUOTE_CARD', 'roa', _QUOTE)}]
    WHEN fact IS NOT NULL THEN [{_shot_sql('STAT_CARD', 'head', _stat_sql('fact'))}, {_shot_sql('QUOTE_CARD', 'roa', _QUOTE)}] ELSE [{_shot_sql('HEADLINE_CARD', 'narration', _HEAD)}] END
  WHEN 'cta' THEN [{_shot_sql('LOGO_CTA', 'narration', f"'differentiator=' || own || '|cta_line=' || {lit(RULES.cta_lines[0])} || '|domain=' || {lit(RULES.domain)}")}]
  ELSE [{_shot_sql('HEADLINE_CARD', 'narration', _HEAD)}] END"""
_OWN_TEXT = "CASE list_filter(coalesce(fact_ids, []), lambda f: f IN ('b0', 'b1', 'b2'))[-1] " + " ".join(f"WHEN {lit(i)} THEN {lit(t)}" for i, t in V.DIFFERENTIATORS) + " ELSE '' END"
T4_SQL = f"""WITH {V.SCRIPTS_SQL}, texts AS (SELECT run_id AS id, pos, narration FROM scripts), {PACK},
k AS (SELECT r.run_id, r.pos, r.i, {{'id': f.id, 'value': f.value, 'quote': f.quote, 'marker': f.marker, 'url': c.url}} AS f FROM (SELECT run_id, pos, fact_ids[i] AS id, i FROM scripts, range(1, len(fact_ids) + 1) t(i)) r
  JOIN sfacts f USING (run_id, id) LEFT JOIN cites c ON c.run_id = r.run_id AND c.marker = f.marker),
a AS (SELECT run_id, pos, arg_min(f, i) FILTER (regexp_matches(f.value, '[0-9]')) AS num, arg_min(f, i) AS anyf, arg_min(f, i) FILTER (contains(f.url, 'doi.org')) AS paper FROM k GROUP BY 1, 2),
e0 AS (SELECT s.*, num, paper, coalesce(num, anyf) AS fact, CASE WHEN joined = '' THEN [narration] ELSE string_split(joined, chr(1)) END AS sp, list_transform(({PHRASES})[1:3], lambda p: array_to_string(({words('p')})[1:4], ' ')) AS heads
  FROM scripts s JOIN spans p ON p.id = s.run_id AND p.pos = s.pos LEFT JOIN a ON a.run_id = s.run_id AND a.pos = s.pos),
e AS (SELECT *, len(sp) AS n, sp[1] AS head, array_to_string(sp[2:], ', ') AS rest, CASE WHEN len(sp) > 1 THEN array_to_string(sp[2:], ', ') ELSE narration END AS roa, least(3, len(sp)) AS k,
  CASE WHEN {_HAS.format('paper')} THEN paper ELSE coalesce(fact, paper) END AS pstat, {_OWN_TEXT} AS own,
  CASE WHEN len(coalesce(labels, [])) > 0 THEN labels WHEN len(heads) >= 2 THEN heads ELSE (list_concat(heads, ['Result']))[1:2] END AS shown FROM e0),
x AS (SELECT run_id, pos, beat, narration, {_RULE_TREE} AS shots FROM e),
y AS (SELECT *, greatest(len({words('narration')}) / {W}, {K.SHOT_MIN_S}) / len(shots) AS per FROM x)
SELECT run_id, pos, CAST(j - 1 AS BIGINT) AS sub, beat, shots[j].type AS type, round_even(least(greatest(per, {K.SHOT_MIN_S}), CASE WHEN beat = 'cta' THEN {K.END_CARD_MAX_S} ELSE {K.SHOT_MAX_S} END), 2) AS duration_s,
  shots[j].span AS narration_span, shots[j].labels AS labels, shots[j].payload AS payload, shots[j].fallback AS fallback FROM y, range(1, len(shots) + 1) t(j)"""


@query("T4", T4_SQL)
def expand_segments(read):
    """Beat rule tree over all beats, with papers, missing facts and several cited differentiators."""
    out = _expand(read)
    line = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return out.select("run_id", "pos", "sub", "beat", "type", "duration_s", "narration_span", F.array_join("labels", "|").alias("labels"), line(F.col("payload")).alias("payload"),
                      F.when(F.col("fallback").isNotNull(), F.concat(F.col("fallback")["type"], F.lit(":"), line(F.col("fallback")["payload"]))).alias("fallback"))


@query("T5", f"""WITH {V.SCRIPTS_SQL}, texts AS (SELECT run_id AS id, pos, narration FROM scripts), {PACK},
n AS (SELECT s.run_id, s.pos, s.beat, CASE WHEN s.beat = 'mechanism' THEN least(3, len(string_split(joined, chr(1)))) WHEN s.beat = 'cta' THEN 1 WHEN s.beat = 'proof' THEN 2
   WHEN s.beat = 'stakes' THEN CASE WHEN len(string_split(joined, chr(1))) > 1 THEN 2 ELSE 1 END
   ELSE CASE WHEN s.broll_wish <> '' AND len(string_split(joined, chr(1))) >= 2 THEN 2 ELSE 1 END END AS k FROM scripts s JOIN spans p ON p.id = s.run_id AND p.pos = s.pos),
x AS (SELECT run_id, pos, j AS sub FROM n, range(k) r(j))
SELECT run_id, pos, sub, row_number() OVER (PARTITION BY run_id ORDER BY pos, sub) - 1 AS ord FROM x""")
def number_segments(read):
    """Counts shots per run without sorting a whole run in one task."""
    return S.number_segments(shots(read)).select("run_id", "pos", "sub", F.col("ord").cast("bigint").alias("ord"))


@query("G10", f"""WITH {V.SCRIPTS_SQL}, sh AS ({T4_SQL}),
o AS (SELECT *, 's' || CASE WHEN ord < 10 THEN '0' ELSE '' END || ord AS id FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY pos, sub) - 1 AS ord FROM sh) z),
q AS (SELECT o.*, regexp_extract(payload, '^value=([^|]*)', 1) AS value, f.quote FROM o LEFT JOIN sfacts f ON o.type = 'STAT_CARD' AND f.run_id = o.run_id AND f.id = regexp_extract(payload, 'fact_id=(.*)$', 1))
SELECT run_id, id, 'duration out of range' AS rule FROM q WHERE duration_s < {K.SHOT_MIN_S} OR duration_s > CASE WHEN type = 'LOGO_CTA' THEN {K.END_CARD_MAX_S} ELSE {K.SHOT_MAX_S} END
UNION ALL SELECT run_id, id, 'missing fallback' FROM q WHERE type IN ('PAPER_CARD', 'BROLL') AND fallback IS NULL
UNION ALL SELECT run_id, id, 'flow label count' FROM q WHERE type = 'DIAGRAM' AND contains(payload, 'template=flow') AND NOT coalesce(len(string_split(labels, '|')), 0) BETWEEN 2 AND 4
UNION ALL SELECT run_id, id, 'untraced value ' || t FROM (SELECT run_id, id, unnest({numbers('value')}) AS t, quote FROM q WHERE type = 'STAT_CARD') z WHERE NOT list_contains({numbers("coalesce(quote, '')")}, t)
UNION ALL SELECT run_id, NULL, 'total duration' FROM q GROUP BY run_id HAVING sum(duration_s) < {K.TOTAL_MIN_S - K.LINT_EPSILON_S} OR sum(duration_s) > {K.TOTAL_MAX_S + K.LINT_EPSILON_S}""")
def lint_segments(read):
    return S.lint_segments(S.number_segments(shots(read)), V.script_facts(read))


CH = f"""'Source [' || marker || '] — ' || regexp_replace(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1), '^www\\.', '')"""


@query("M19", f"""WITH {V.SCRIPTS_SQL},
r AS (SELECT run_id, pos, fact_ids[i] AS id, i FROM scripts, range(1, len(fact_ids) + 1) t(i)),
k AS (SELECT r.run_id, r.pos, r.i, f.id, f.value, f.marker, c.url FROM r JOIN sfacts f USING (run_id, id) LEFT JOIN cites c ON c.run_id = r.run_id AND c.marker = f.marker),
a AS (SELECT run_id, pos, arg_min(id, i) FILTER (regexp_matches(value, '[0-9]')) AS numeric_id, arg_min(CASE WHEN url IS NOT NULL THEN {CH} ELSE 'Source' END, i) FILTER (regexp_matches(value, '[0-9]')) AS chip,
      arg_min(id, i) FILTER (contains(url, 'doi.org')) AS paper_id FROM k GROUP BY 1, 2)
SELECT * FROM a""")
def referenced_facts(read):
    out = S.referenced_facts(V.scripts(read), V.script_facts(read), V.script_citations(read))
    n = F.col("numeric_fact")
    return out.select("run_id", "pos", n["id"].alias("numeric_id"), F.when(n.isNotNull(), L.citation_chip(n["marker"], n["url"], n["url"].isNotNull())).alias("chip"),
                      F.col("paper_fact")["id"].alias("paper_id"))


# ── timing: measured part lengths derived from the scripts' word counts ────
_DUR = f"round(len({words('narration')}) / {W} * (0.9 + (run_id % 5) * 0.05), 3)"
PARTS_SQL = f"""{V.SCRIPTS_SQL}, parts AS (SELECT run_id, pos, beat, {_DUR} AS duration_s FROM scripts),
starts AS (SELECT *, coalesce(sum(duration_s + 0.3) OVER (PARTITION BY run_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_s FROM parts),
totals AS (SELECT run_id, max(start_s + duration_s) AS voice_total_s FROM starts GROUP BY 1),
bspans AS (SELECT s.*, coalesce(lead(start_s) OVER (PARTITION BY run_id ORDER BY pos), voice_total_s + 1.5) - start_s AS span_s FROM starts s JOIN totals USING (run_id))"""


def parts(read):
    d = F.round(X.estimate_s("narration") * (0.9 + (F.col("run_id") % 5) * 0.05), 3)
    return V.scripts(read).select("run_id", "pos", "beat", d.alias("duration_s"))


def starts(read):
    """Measured parts are a stage table: written once, read by every timing step."""
    return S.voice_starts(cut(parts(read), "parts"))


def spans(read):
    return _spans(starts(read))


def _spans(s):
    totals = s.groupBy("run_id").agg(F.max(F.col("start_s") + F.col("duration_s")).alias("voice_total_s"))
    return S.beat_spans(s, totals)


@query("T10", f"WITH {PARTS_SQL} SELECT run_id, pos, round(start_s, 3) AS start_s FROM starts")
def voice_starts(read):
    return starts(read).select("run_id", "pos", F.round("start_s", 3).alias("start_s"))


@query("T6", f"WITH {PARTS_SQL} SELECT run_id, pos, round(span_s, 3) AS span_s FROM bspans")
def beat_spans(read):
    return spans(read).select("run_id", "pos", F.round("span_s", 3).alias("span_s"))


@query("T9", f"""WITH {PARTS_SQL}, p2 AS (SELECT run_id, pos, floor(duration_s * 100) / 100 AS duration_s FROM parts), t AS (SELECT run_id, pos, duration_s, coalesce(sum(duration_s) OVER (PARTITION BY run_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS t0 FROM p2)
SELECT run_id, pos, round(t0, 3) AS start_s, round(t0 + duration_s / 2, 3) AS mid_s FROM t""")
def timeline(read):
    out = S.timeline(parts(read).withColumn("duration_s", F.floor(F.col("duration_s") * 100) / 100), order=("pos",))
    return out.select("run_id", "pos", "start_s", "mid_s")


SHOT_SQL = f"""{PARTS_SQL}, shots AS (SELECT run_id, beat, pos * 3 + j AS ord, CASE WHEN beat = 'cta' THEN 'LOGO_CTA' ELSE 'DIAGRAM' END AS type,
   2.0 + (run_id + pos + j) % 3 AS duration_s FROM parts, range(1 + (run_id + pos) % 3) r(j) WHERE NOT (run_id % 97 = 0 AND pos = 2)),
g AS (SELECT run_id, beat, sum(duration_s) AS planned, max(ord) AS last FROM shots GROUP BY 1, 2),
sc AS (SELECT b.run_id, b.beat, b.span_s, s.ord, s.type, s.duration_s, s.ord = g.last AS is_last,
   CASE WHEN s.ord < g.last THEN least(greatest(s.duration_s * (span_s / planned), 1.8), CASE WHEN type = 'LOGO_CTA' THEN 10.0 ELSE 4.5 END) END AS scaled
   FROM bspans b LEFT JOIN g USING (run_id, beat) LEFT JOIN shots s USING (run_id, beat)),
u AS (SELECT *, coalesce(sum(scaled) OVER (PARTITION BY run_id, beat), 0) AS used FROM sc),
flow AS (SELECT run_id, beat, ord, type, duration_s, CASE WHEN is_last THEN span_s - used ELSE scaled END AS new_s FROM u)"""


def _plan(p):
    """Planned shots of measured parts."""
    p = p.where("NOT (run_id % 97 = 0 AND pos = 2)")
    p = p.select("run_id", "beat", "pos", F.explode(F.sequence(F.lit(0), ((F.col("run_id") + F.col("pos")) % 3).cast("int"))).alias("j"))
    return p.select("run_id", "beat", (F.col("pos") * 3 + F.col("j")).alias("ord"), F.when(F.col("beat") == "cta", "LOGO_CTA").otherwise("DIAGRAM").alias("type"),
                    (2.0 + (F.col("run_id") + F.col("pos") + F.col("j")) % 3).alias("duration_s"))


@query("T7", f"""WITH {SHOT_SQL} SELECT run_id, beat, ord, round(new_s, 4) AS new_s, round(new_s - duration_s, 4) AS delta_s,
  CASE WHEN ord IS NULL THEN 'no shots for beat' WHEN new_s < 0.9 THEN 'audio and shots do not fit' END AS error FROM flow""")
def reflow(read):
    out = S.reflow(_plan(parts(read)), spans(read))
    return out.select("run_id", "beat", "ord", F.round("new_s", 4).alias("new_s"), F.round(F.col("new_s") - F.col("duration_s"), 4).alias("delta_s"), "error")


@query("T8", f"""WITH {SHOT_SQL}, o AS (SELECT *, lag(beat) OVER w AS before, first_value(beat) OVER w AS first_beat FROM flow WHERE ord IS NOT NULL WINDOW w AS (PARTITION BY run_id ORDER BY ord))
SELECT run_id, ord, abs(round(new_s - duration_s, 3)) > 0.05 AS rerender, CASE WHEN beat IS DISTINCT FROM before AND beat <> first_beat THEN CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS fade_s FROM o""")
def render_flags(read):
    """All that precedes is joined by run and beat or block: parts are dealt out by run once, and what they become is not shuffled again."""
    p = dealt(cut(parts(read), "parts"), "run_id")
    fitted = S.reflow(_plan(p), _spans(S.voice_starts(p))).where("ord IS NOT NULL")
    fitted = cut_in_place(fitted.select("run_id", "ord", "beat", "delta_s"), "fitted")  # read twice
    return S.render_flags(fitted).select("run_id", "ord", "rerender", "fade_s")


WORDS_SQL = """w0 AS (SELECT conv_id, turn, string_split_regex(text, '[ \\n]+') AS w FROM conversations),
wt AS (SELECT conv_id * 100 + turn AS doc, i - 1 AS idx, w[i] AS word, CAST((i - 1) * 0.5 AS DOUBLE) AS start_s, CAST((i - 1) * 0.5 + 0.25 + (length(w[i]) % 5) * 0.25 AS DOUBLE) AS end_s FROM w0, range(1, len(w) + 1) r(i))"""


def cue_words(read):
    w = read("conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("doc"), F.posexplode(F.split("text", "[ \n]+")).alias("idx", "word"))
    return w.select("doc", F.col("idx").cast("bigint").alias("idx"), "word", (F.col("idx") * 0.5).alias("start_s"),
                    (F.col("idx") * 0.5 + 0.25 + (F.length("word") % 5) * 0.25).alias("end_s"))


CUES_SQL = WORDS_SQL + f""",
j AS (SELECT *, 1 + CASE WHEN e1 - start_s <= 1.5 THEN 1 + CASE WHEN e2 - start_s <= 1.5 THEN 1 ELSE 0 END ELSE 0 END AS n FROM (
   SELECT *, lead(end_s) OVER w AS e1, lead(end_s, 2) OVER w AS e2, lead(word) OVER w AS w1, lead(word, 2) OVER w AS w2 FROM wt WINDOW w AS (PARTITION BY doc ORDER BY idx)) z),
walk AS (SELECT doc, idx, n AS step FROM j WHERE idx = 0 UNION ALL SELECT j.doc, j.idx, j.n FROM walk JOIN j ON j.doc = walk.doc AND j.idx = walk.idx + walk.step),
cues AS (SELECT doc, idx, start_s, CASE n WHEN 1 THEN end_s WHEN 2 THEN e1 ELSE e2 END AS end_s,
   upper(CASE n WHEN 1 THEN {strip('word')} WHEN 2 THEN {strip('word')} || ' ' || {strip('w1')} ELSE {strip('word')} || ' ' || {strip('w1')} || ' ' || {strip('w2')} END) AS text FROM j JOIN walk USING (doc, idx))"""


@query("T11", f"WITH RECURSIVE {CUES_SQL} SELECT doc, idx, start_s, end_s, md5(replace(replace(text, 'ß', 'SS'), 'ẞ', 'SS')) AS text_md5 FROM cues")
def group_cues(read):
    cues = S.group_cues(cue_words(read))
    return cues.select("doc", "idx", "start_s", "end_s", F.md5("text").alias("text_md5"))


_MS = "CAST(round_even(s * 1000, 0) AS BIGINT)"
_MT = "CAST(floor(round_even(s * 1000000, 0) / 1000) AS BIGINT)"


def _srt(ms: str) -> str:
    return f"printf('%02d:%02d:%02d,%03d', {ms} // 3600000, {ms} % 3600000 // 60000, {ms} % 60000 // 1000, {ms} % 1000)"


@query("T12", f"""WITH t AS (SELECT event_id, value * 97 AS s FROM events)
SELECT event_id, {_srt(_MS)} AS srt, {_srt(_MT)} AS srt_cut, (CAST(floor(s / 3600) AS BIGINT) || ':' || printf('%02d', CAST(floor(s % 3600 / 60) AS BIGINT)) || ':' || printf('%05.2f', s % 60)) AS ass FROM t""")
def format_time(read):
    s = F.col("value") * 97
    return read("events").select("event_id", X.srt_time(s).alias("srt"), X.srt_time(s, rounded=False).alias("srt_cut"), X.ass_time(s).alias("ass"))


def _redis_sql() -> str:
    steps = ["""r0 AS (SELECT p.run_id, p.pos, CASE WHEN (run_id + pos) % 4 = 0 THEN duration_s * 6 ELSE duration_s END AS d0 FROM parts p),
r1 AS (SELECT *, CASE WHEN run_id % 13 = 0 THEN 0 ELSE d0 END AS d1 FROM r0),
s0 AS (SELECT run_id, pos, d1, sum(d1) OVER (PARTITION BY run_id) AS tot, count(*) OVER (PARTITION BY run_id) AS n, max(pos) OVER (PARTITION BY run_id) AS last FROM r1),
x0 AS (SELECT run_id, pos, last, CASE WHEN tot <= 0.01 THEN (40.0 + run_id % 30) / n ELSE d1 * ((40.0 + run_id % 30) / tot) END AS d FROM s0)"""]
    for i in range(3):
        steps.append(f"""y{i} AS (SELECT *, sum(greatest(0, d - 20)) OVER (PARTITION BY run_id) AS ex, count_if(d < 20) OVER (PARTITION BY run_id) AS fr FROM x{i}),
x{i + 1} AS (SELECT run_id, pos, last, CASE WHEN ex < 0.01 THEN d WHEN d < 20 THEN d + ex / fr ELSE 20 END AS d FROM y{i})""")
    return ", ".join(steps)


@query("T13", f"WITH {PARTS_SQL}, {_redis_sql()} SELECT run_id, pos, round(CASE WHEN d + CASE WHEN pos = last THEN 1.2 ELSE 0 END <= 0 THEN 0.5 ELSE d + CASE WHEN pos = last THEN 1.2 ELSE 0 END END, 4) AS new_s FROM x3")
def redistribute(read):
    p = parts(read)
    d = F.when((F.col("run_id") + F.col("pos")) % 4 == 0, F.col("duration_s") * 6).otherwise(F.col("duration_s"))
    scenes = p.select("run_id", "pos", F.when(F.col("run_id") % 13 == 0, 0.0).otherwise(d).alias("duration_s"))
    totals = read("orders").select(F.col("o_orderkey").alias("run_id"), (40.0 + F.col("o_orderkey") % 30).alias("audio_s"))
    return S.redistribute(scenes, totals).select("run_id", "pos", F.round("new_s", 4).alias("new_s"))


@query("T14", f"""WITH {PARTS_SQL}, c AS (SELECT run_id, pos, beat, duration_s, CASE (run_id + pos) % 5 WHEN 0 THEN 'slide_left' WHEN 1 THEN 'hard_cut' WHEN 2 THEN 'slow_fade' ELSE '' END AS tr,
   lag(beat) OVER (PARTITION BY run_id ORDER BY pos) AS b FROM parts),
k AS (SELECT *, CASE WHEN tr <> '' THEN tr WHEN b = beat THEN 'cut' WHEN b = 'hook' AND beat = 'stakes' THEN 'slow_fade' WHEN b = 'proof' AND beat IN ('brand', 'cta') THEN 'dissolve_flash' ELSE 'fade' END AS kind FROM c),
e AS (SELECT *, CASE WHEN kind IN ('slide_left', 'dissolve_flash') THEN 0.4 WHEN kind IN ('cut', 'hard_cut') THEN 0.0 WHEN kind = 'slow_fade' THEN 0.5 ELSE 0.25 END AS secs FROM k),
o AS (SELECT *, CASE WHEN secs > 0 THEN secs ELSE CAST(2 AS DOUBLE) / 30 END AS lost FROM e),
f AS (SELECT *, sum(duration_s - CASE WHEN b IS NULL THEN 0 ELSE lost END) OVER (PARTITION BY run_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - lost AS off FROM o)
SELECT run_id, pos, CASE WHEN kind IN ('slide_left', 'dissolve_flash') THEN 'smoothleft' ELSE 'fade' END AS effect, CAST(secs AS DOUBLE) AS effect_s, round(off, 4) AS offset_s FROM f WHERE b IS NOT NULL""")
def transition_plan(read):
    m = (F.col("run_id") + F.col("pos")) % 5
    clips = parts(read).withColumnRenamed("duration_s", "clip_s").withColumn(
        "transition_in", F.when(m == 0, "slide_left").when(m == 1, "hard_cut").when(m == 2, "slow_fade").otherwise(""))
    return S.transition_plan(clips).select("run_id", "pos", "effect", "effect_s", F.round("offset_s", 4).alias("offset_s"))


_BAG = f"list_distinct({words('lower(narration)')})"


@query("T15", f"""WITH {V.SCRIPTS_SQL}, b AS (SELECT run_id, pos, {_BAG} AS w, lag({_BAG}) OVER (PARTITION BY run_id ORDER BY pos) AS p FROM scripts)
SELECT run_id, pos, coalesce(len(p) > 0 AND len(w) > 0 AND len(list_intersect(w, p)) / len(w) > 0.7, false) AS narration_duplicate FROM b""")
def overlap_flag(read):
    return S.overlap_flag(V.scripts(read))


@query("T16", f"""SELECT conv_id, turn, array_to_string(({words('text')})[1:greatest(8, CAST(round_even((3 + turn) * 2.5, 0) AS BIGINT))], ' ') AS kept
FROM conversations WHERE len({words('text')}) > greatest(8, CAST(round_even((3 + turn) * 2.5, 0) AS BIGINT))""")
def truncate_words(read):
    limit = F.greatest(F.lit(8), F.bround((3 + F.col("turn")) * 2.5).cast("int"))
    return read("conversations").where(X.word_count("text") > limit).select("conv_id", "turn", X.truncate_words("text", 3 + F.col("turn")).alias("kept"))


@query("T17", """SELECT l_orderkey, l_partkey, l_linenumber, CAST(ceil(CAST(l_quantity AS BIGINT) * greatest(1, least(l_linenumber, 4)) / 4.0) AS BIGINT) AS visible FROM lineitem""")
def reveal_count(read):
    return read("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", X.reveal_count(F.col("l_quantity").cast("bigint"), "l_linenumber", F.lit(4)).alias("visible"))


@query("T18", f"""SELECT run_id, CAST(p AS BIGINT) AS pos, {lits(V.BEATS)}[p + 1] AS beat, coalesce(text, '') AS narration, CASE WHEN p = 0 THEN 'cut' ELSE 'fade' END AS transition_in
FROM (SELECT DISTINCT conv_id AS run_id FROM conversations) r, range(5) t(p) LEFT JOIN conversations c ON c.conv_id = run_id AND c.turn = p""")
def align_to_template(read):
    scenes = read("conversations").select(F.col("conv_id").alias("run_id"), F.col("turn").alias("pos"), F.col("role").alias("beat"), F.col("text").alias("narration"))
    return S.align_to_template(scenes, V.BEATS)
