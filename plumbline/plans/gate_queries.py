"""Rule gates over scripts derived from orders (five beats per order)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions import text as X
from plumbline.operators import gates as G
from plumbline.plans import standins as V
from plumbline.plans.registry import query
from plumbline.plans.sqlkit import lit, lits, norm, numbers, strip, words
from plumbline.session import large

RULES = G.Rules(V.DIFFERENTIATORS, V.CTA_LINES, V.DOMAIN, V.BANNED_CLAIMS)


def _nums(items) -> str:
    return "[" + ", ".join(repr(i) for i in items) + "]"


def _tok_sql(src: str, where: str) -> str:
    return (f"list_transform(list_filter({numbers(src)}, lambda t: NOT regexp_matches(pool, '(^|[^0-9.])' || replace(t, '.', '[.]') || '([^0-9]|$)')), "
            f"lambda t: 'numbers[' || beat || ']: ''' || t || ''' in {where} does not trace to any referenced fact')")


_OWN = ", ".join(f"CASE WHEN list_contains(fact_ids, {lit(i)}) THEN {lit(t)} END" for i, t in V.DIFFERENTIATORS)
_TAIL = ", ".join(lit(c) for c in [*V.CTA_LINES, V.DOMAIN])
NUMBERS_SQL = f"""q AS (SELECT run_id, pos, string_agg(quote, ' | ') AS quotes FROM (SELECT DISTINCT run_id, pos, unnest(fact_ids) AS id FROM scripts) r JOIN sfacts USING (run_id, id) GROUP BY 1, 2),
pooled AS (SELECT s.*, replace({norm(f"concat_ws(' | ', quotes, {_OWN}, {_TAIL})")}, ',', '') AS pool FROM scripts s LEFT JOIN q USING (run_id, pos)),
v_numbers AS (SELECT run_id, pos, 'numbers' AS gate, unnest(list_concat({_tok_sql('narration', 'narration')}, {_tok_sql('card_text', 'card_text')},
   flatten(list_transform(coalesce(labels, []), lambda c: {_tok_sql('c', 'diagram label').replace('lambda t:', 'lambda u:').replace('replace(t,', 'replace(u,').replace("|| t ||", "|| u ||").replace('lambda u: replace(u', 'lambda t: replace(t')})))) AS message FROM pooled)"""
BANNED_SQL = f"""v_banned AS (SELECT run_id, pos, 'banned' AS gate, 'banned[' || beat || ']: contains ''' || p || '''' AS message
  FROM (SELECT *, unnest({lits(RULES.banned)}) AS p FROM scripts) t WHERE contains(lower(narration || ' ' || card_text), p))"""
_N = f"len({words('narration')})"
BUDGET_SQL = f"""v_budget AS (SELECT run_id, pos, 'budget' AS gate, 'budget[' || {lits(G.BEATS)}[pos + 1] || ']: ' || {_N} || ' words outside [' ||
   {_nums([math.ceil(x) for x in G.LOW])}[pos + 1] || ', ' || {_nums([math.floor(x) for x in G.HIGH])}[pos + 1] || ']' AS message
  FROM scripts WHERE {_N} < CAST({_nums(G.LOW)}[pos + 1] AS DOUBLE) OR {_N} > CAST({_nums(G.HIGH)}[pos + 1] AS DOUBLE))"""
_CW = f"list_filter(string_split({norm('card_text')}, ' '), lambda w: w <> '')"
CARD_SQL = f"""c0 AS (SELECT run_id, pos, beat, {_CW} AS w, {norm('narration')} AS told FROM scripts),
v_card AS (SELECT run_id, pos, 'card' AS gate, 'card[' || beat || ']: card_text duplicates narration' AS message FROM c0
   WHERE len(w) >= 5 AND len(list_filter(range(1, len(w) - 3), lambda i: contains(told, array_to_string(w[i:i + 4], ' ')))) > 0
  UNION ALL SELECT run_id, pos, 'card', 'card[' || beat || ']: card_text longer than 7 words' FROM c0 WHERE len(w) > 7)"""


def _quoted(a: str) -> str:
    return f"'[' || array_to_string(list_transform({a}, lambda x: '''' || x || ''''), ', ') || ']'"


_DIFF = f"list_filter(coalesce(fact_ids, []), lambda f: f IN ('b0', 'b1', 'b2'))"
DIFF_SQL = f"""l0 AS (SELECT run_id, max(pos) AS last FROM scripts GROUP BY 1), d0 AS (SELECT run_id, pos, beat, {_DIFF} AS d, last FROM scripts JOIN l0 USING (run_id)),
v_diff AS (SELECT run_id, CAST(NULL AS BIGINT) AS pos, 'differentiator' AS gate, 'differentiator[cta]: expected exactly one of {str(RULES.ids).replace("'", "''")}, got ' || {_quoted('d')} AS message
   FROM d0 WHERE pos = last AND len(d) <> 1
  UNION ALL SELECT run_id, pos, 'differentiator', 'differentiator[' || beat || ']: brand differentiators belong in the CTA beat only, found ' || {_quoted('d')} FROM d0 WHERE pos < last AND len(d) > 0)"""
_HI = _nums([int(h) for h in G.HIGH])
TOTAL_SQL = f"""t0 AS (SELECT run_id, CAST(sum({_N}) AS BIGINT) AS total, list_sort(list({{'room': {_HI}[pos + 1] - {_N}, 'beat': {lits(G.BEATS)}[pos + 1], 'n': {_N}, 'hi': {_HI}[pos + 1]}})
     FILTER ({_HI}[pos + 1] > {_N}), 'DESC')[1:3] AS rooms FROM scripts GROUP BY 1),
v_total AS (SELECT run_id, CAST(NULL AS BIGINT) AS pos, 'total_duration' AS gate, CASE WHEN total < {G.MIN_WORDS} THEN
   'total_duration: ' || printf('%.1f', total / CAST(1.7 AS DOUBLE)) || 's (' || total || ' words) is short of the 35s floor (60 words). Add AT LEAST ' || (60 - total + 3) ||
   ' more words total, distributed across the beats with the most room: ' || array_to_string(list_transform(coalesce(rooms, []), lambda r: r.beat || ' (currently ' || r.n || ' words, can go up to ' || r.hi || ')'), '; ') || '.'
   ELSE 'total_duration: ' || printf('%.1f', total / CAST(1.7 AS DOUBLE)) || 's (' || total || ' words) is over the 50s ceiling (85 words). Cut AT LEAST ' || (total - 85 + 3) || ' words total across the beats.' END AS message
  FROM t0 WHERE total / CAST(1.7 AS DOUBLE) < 35 OR total / CAST(1.7 AS DOUBLE) > 50)"""
STRUCT_SQL = f"""s0 AS (SELECT run_id, count(*) AS n, count_if(beat = {lits(G.BEATS)}[pos + 1]) AS ok FROM scripts GROUP BY 1),
v_struct AS (SELECT run_id, CAST(NULL AS BIGINT) AS pos, 'structure' AS gate, CASE WHEN n <> 5 THEN 'structure: expected 5 beats, got ' || n
   ELSE 'structure: beat order must be {str(G.BEATS).replace("'", "''")}' END AS message FROM s0 WHERE n <> 5 OR ok <> 5)"""
ALL_SQL = f"WITH {V.SCRIPTS_SQL}, {NUMBERS_SQL}, {BANNED_SQL}, {BUDGET_SQL}, {CARD_SQL}, {DIFF_SQL}, {TOTAL_SQL}, {STRUCT_SQL}"
UNION_SQL = ", all_v AS (" + " UNION ALL ".join(f"SELECT * FROM {v} WHERE run_id NOT IN (SELECT run_id FROM v_struct)" for v in
                                               ("v_numbers", "v_banned", "v_budget", "v_card", "v_diff", "v_total")) + " UNION ALL SELECT * FROM v_struct)"


@query("G1", f"WITH {V.SCRIPTS_SQL}, {NUMBERS_SQL} SELECT * FROM v_numbers")
def gate_numbers(read):
    return G.gate_numbers(V.scripts(read), V.script_facts(read), RULES)


@query("G2", f"WITH {V.SCRIPTS_SQL}, {BANNED_SQL} SELECT * FROM v_banned")
def gate_banned(read):
    return G.gate_banned(V.scripts(read), RULES)


@query("G3", f"WITH {V.SCRIPTS_SQL}, {BUDGET_SQL} SELECT * FROM v_budget")
def gate_word_budget(read):
    return G.gate_word_budget(V.scripts(read))


@query("G4", f"WITH {V.SCRIPTS_SQL}, {TOTAL_SQL} SELECT * FROM v_total")
def gate_total_duration(read):
    return G.gate_total_duration(V.scripts(read))


@query("G5", f"WITH {V.SCRIPTS_SQL}, {CARD_SQL} SELECT * FROM v_card")
def gate_card_echo(read):
    return G.gate_card_echo(V.scripts(read))


@query("G6", f"WITH {V.SCRIPTS_SQL}, {DIFF_SQL} SELECT * FROM v_diff")
def gate_differentiator(read):
    return G.gate_differentiator(V.scripts(read), RULES)


@query("G7", f"WITH {V.SCRIPTS_SQL}, {STRUCT_SQL} SELECT * FROM v_struct")
def gate_structure(read):
    return G.gate_structure(V.scripts(read))


@query("G7", ALL_SQL + UNION_SQL + " SELECT * FROM all_v")
def run_gates(read):
    return G.run_gates(V.scripts(read), V.script_facts(read), RULES)


@query("U3", ALL_SQL + UNION_SQL + """, e AS (SELECT run_id, pos, 'no_wish' AS gate, 'no wish at ' || beat AS message FROM scripts WHERE broll_wish = '' AND run_id NOT IN (SELECT run_id FROM v_struct))
SELECT gate, count(*) AS n FROM (SELECT * FROM all_v UNION ALL SELECT * FROM e) z GROUP BY gate""")
def registered_gate(read):
    """A gate added by the caller takes part in run_gates."""
    G.register_gate("no_wish", lambda seg: seg.where("broll_wish = ''").select(
        "run_id", "pos", F.lit("no_wish").alias("gate"), F.concat(F.lit("no wish at "), "beat").alias("message")))
    try:
        return G.run_gates(V.scripts(read), V.script_facts(read), RULES).groupBy("gate").agg(F.count("*").alias("n"))
    finally:
        G.unregister_gate("no_wish")


_FREE = "[" + ", ".join(repr(h) for h in G.HIGH) + "]"
_POOLS = "[" + ", ".join(lits(K.TOPUP_WORDS[b]) for b in G.BEATS) + "]"


@query("G8", f"""WITH {V.SCRIPTS_SQL}, {BUDGET_SQL}, {TOTAL_SQL}, {STRUCT_SQL},
v AS (SELECT * FROM v_budget WHERE run_id NOT IN (SELECT run_id FROM v_struct) UNION ALL SELECT * FROM v_total WHERE run_id NOT IN (SELECT run_id FROM v_struct) UNION ALL SELECT * FROM v_struct),
f AS (SELECT run_id FROM v GROUP BY 1 HAVING bool_and(gate = 'total_duration' AND contains(message, 'short of'))),
r AS (SELECT s.run_id, s.pos, s.narration, {_N} AS n, CAST({_FREE}[pos + 1] AS DOUBLE) - {_N} AS free, {_POOLS}[pos + 1] AS pool, {_HI}[pos + 1] - {_N} AS room,
     60 - sum({_N}) OVER (PARTITION BY s.run_id) AS need FROM scripts s JOIN f USING (run_id)),
c AS (SELECT *, greatest(0, least(room, len(pool))) AS cap FROM r),
t AS (SELECT *, least(cap, greatest(0, need - coalesce(sum(cap) OVER (PARTITION BY run_id ORDER BY free DESC, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS take FROM c),
p AS (SELECT run_id, pos, CAST(take AS BIGINT) AS added, CASE WHEN take > 0 THEN {strip(f"(CASE WHEN regexp_matches(narration, '[.!?]$') THEN narration ELSE narration || '.' END) || ' ' || array_to_string(pool[1:take], ' ')")} || '.' ELSE narration END AS narration FROM t)
SELECT run_id, pos, coalesce(p.added, 0) AS added, coalesce(p.narration, s.narration) AS narration FROM scripts s LEFT JOIN p USING (run_id, pos)""")
def word_topup(read):
    seg = V.scripts(read)
    v = G.gate_structure(seg)
    sound = seg.join(large(v), "run_id", "left_anti")
    v = v.unionByName(G.gate_word_budget(sound)).unionByName(G.gate_total_duration(sound))
    return G.word_topup(seg, v).select("run_id", "pos", F.col("added").cast("bigint").alias("added"), "narration")


@query("G9", """WITH l AS (SELECT doc_id, quality, toxic, CASE WHEN quality = 1 THEN 9 ELSE 6 END AS a, 10 - 4 * toxic AS b, 5 + doc_id % 5 AS c FROM labels)
SELECT doc_id, CASE WHEN least(a, b, c) < 7 THEN 'rewrite' ELSE 'accept' END AS route FROM l""")
def critique_route(read):
    a = F.when(F.col("quality") == 1, 9).otherwise(6)
    return read("labels").select("doc_id", G.critique_route(a, 10 - 4 * F.col("toxic"), 5 + F.col("doc_id") % 5).alias("route"))
