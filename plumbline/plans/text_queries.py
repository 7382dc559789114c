"""Text normalisation, tokenising and numeric mining."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions import text as X
from plumbline.plans import standins as V
from plumbline.plans.registry import query
from plumbline.plans.sqlkit import in_list, lit, lits, norm, numbers, sentences, strip, tokens_alpha, words

LOOSE_NUMBER = r"\p{Nd}+(?:[.,]\p{Nd}+)?"


@query("F1", f"SELECT doc_id, {norm('text')} AS norm_text FROM documents")
def normalize_for_match(read):
    return read("documents").select("doc_id", X.normalize_for_match("text").alias("norm_text"))


@query("F3", f"""
SELECT doc_id, pos - 1 AS pos, sents[pos] AS sentence
FROM (SELECT doc_id, {sentences('text')} AS sents FROM documents) t, range(1, len(sents) + 1) r(pos)""")
def split_sentences(read):
    return read("documents").select("doc_id", F.posexplode(X.sentence_array("text")).alias("p", "sentence")).select(
        "doc_id", F.col("p").cast("bigint").alias("pos"), "sentence")


MINED_SQL = f"""
WITH s AS (SELECT doc_id, sents[pos] AS sentence, min(pos) AS first_pos
           FROM (SELECT doc_id, {sentences('text')} AS sents FROM documents) t, range(1, len(sents) + 1) r(pos)
           WHERE regexp_matches(sents[pos], '[0-9]') GROUP BY ALL),
mined AS (SELECT doc_id, sentence, row_number() OVER (PARTITION BY doc_id ORDER BY first_pos) - 1 AS pos FROM s)"""


@query("F4", MINED_SQL + " SELECT doc_id, pos, sentence FROM mined")
def mine_numeric_sentences(read):
    """The flagship: every distinct numeric sentence, found inside its own row, so nothing is shuffled."""
    from plumbline.operators.facts import mine_numeric_sentences as mine
    return mine(read("documents"))


@query("F5", MINED_SQL + " SELECT doc_id, pos, sentence, pos < 40 AS offered FROM mined")
def cap_candidates(read):
    from plumbline.operators.facts import mine_numeric_sentences as mine
    return mine(read("documents")).withColumn("offered", F.col("pos") < 40)  # no sentence is dropped; a consumer filters


@query("F8", rf"""
WITH {V.NOTES_SQL},
u AS (SELECT article_id, line_no, note, regexp_extract_all(note, {lit(X.UNIT_NUMBER.replace('(?U)', ''))}) AS m,
             string_split_regex(note, {lit(X.UNIT_NUMBER.replace('(?U)', ''))}) AS gaps FROM notes),
x AS (SELECT article_id, line_no, i, m[i] AS match,
             CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                  + coalesce(list_sum(list_transform(m[1:i - 1], lambda g: length(g))), 0) AS BIGINT) AS start
      FROM u, range(1, len(m) + 1) r(i))
SELECT article_id, line_no, start, match, regexp_extract(match, '^[0-9]+(?:[.,][0-9]+)?') AS value,
       CASE WHEN match LIKE '%C' THEN 'C' ELSE regexp_replace(match, '^[0-9]+(?:[.,][0-9]+)?\s*', '') END AS unit
FROM x""")
def unit_numerics(read):
    return V.notes(read).select("article_id", "line_no", F.inline(X.unit_numerics("note"))).select(
        "article_id", "line_no", F.col("start").cast("bigint").alias("start"), "match", "value", "unit")


@query("F9", rf"""
WITH {V.NOTES_SQL},
s AS (SELECT article_id, line_no, list_transform(regexp_extract_all(regexp_replace(note, '<[^>]+>', '', 'g'), '[^.!?]*[.!?]'), lambda s: {strip('s')}) AS sents FROM notes),
m AS (SELECT article_id, line_no, unnest(list_distinct(flatten(list_transform(sents, lambda s: list_transform(
        regexp_extract_all(s, {lit(X.UNIT_NUMBER.replace('(?U)', ''))}), lambda m: {{'claim': s[1:], 'match': m}}))))) AS f FROM s)
SELECT article_id, line_no, f.claim AS claim, regexp_extract(f.match, '^[0-9]+(?:[.,][0-9]+)?') AS value,
       CASE WHEN f.match LIKE '%C' THEN 'C' ELSE regexp_replace(f.match, '^[0-9]+(?:[.,][0-9]+)?\s*', '') END AS unit
FROM m""")
def sentence_facts(read):
    return V.notes(read).select("article_id", "line_no", F.inline(X.sentence_facts("note")))


@query("F12", f"""SELECT doc_id, len(n) AS n_tokens, array_to_string(n, '|') AS tokens
FROM (SELECT doc_id, {numbers('text')} AS n FROM documents) t""")
def numeric_tokens(read):
    n = X.numeric_tokens("text")
    return read("documents").select("doc_id", F.size(n).cast("bigint").alias("n_tokens"), F.array_join(n, "|").alias("tokens"))


@query("F13", f"""
WITH {V.SEGMENTS_SQL},
c AS (SELECT run_id, pos, narration, lower('rate ' || (pos + 1) || ' days ' || d.text) AS ctx,
             regexp_extract_all(narration, {lit(LOOSE_NUMBER)}) AS nums,
             list_transform(list_filter({words('narration')}, lambda w: length(w) > 5),
                            lambda w: regexp_replace(lower(w), '^[.,;:%()\\[\\]]+|[.,;:%()\\[\\]]+$', '', 'g')) AS lw
      FROM segments JOIN documents d ON d.doc_id = run_id)
SELECT run_id, pos, len(nums) > 0 AND len(list_filter(nums, lambda n: contains(ctx, n))) > 0
       AND (len(lw) = 0 OR len(list_filter(lw, lambda w: contains(ctx, w))) > 0) AS grounded FROM c""")
def is_grounded(read):
    seg = V.segments(read)
    docs = read("documents").select(F.col("doc_id").alias("run_id"), "text")
    facts = F.concat(F.lit("rate "), (F.col("pos") + 1).cast("string"), F.lit(" days"))
    return seg.join(docs, "run_id").select("run_id", "pos", X.is_grounded("narration", facts, "text").alias("grounded"))


@query("F14", f"""
WITH {V.SEGMENTS_SQL},
h AS (SELECT run_id, list_filter(regexp_extract_all(arg_min(narration, pos), {lit(LOOSE_NUMBER)}),
             lambda n: regexp_matches(n, '[.,]') OR CAST(replace(n, ',', '.') AS DOUBLE) >= 3) AS stat
      FROM segments GROUP BY run_id)
SELECT s.run_id, s.pos, array_to_string(stat, '|') AS stat,
       list_has_any(regexp_extract_all(narration, {lit(LOOSE_NUMBER)}), stat) AS repeats
FROM segments s JOIN h USING (run_id) WHERE s.pos > 0""")
def stat_repeat(read):
    """The opening row per run comes from a two-step minimum, so a hot run is pre-aggregated."""
    from plumbline.operators.segments import stat_repeat as op
    out = op(V.segments(read))
    return out.select("run_id", "pos", F.array_join("stat", "|").alias("stat"), "repeats")


@query("F14", f"""
WITH {V.SEGMENTS_SQL},
h AS (SELECT run_id, list_filter(regexp_extract_all(CASE WHEN run_id % 4 > 0 THEN 'It costs 1,5 or ' || (run_id % 5) || '.5 percent, 2 times' END, {lit(LOOSE_NUMBER)}),
             lambda n: regexp_matches(n, '[.,]') OR CAST(replace(n, ',', '.') AS DOUBLE) >= 3) AS stat
      FROM segments GROUP BY run_id)
SELECT s.run_id, s.pos, coalesce(array_to_string(stat, '|'), '') AS stat,
       coalesce(list_has_any(regexp_extract_all(narration, {lit(LOOSE_NUMBER)}), stat), false) AS repeats
FROM segments s JOIN h USING (run_id) WHERE s.pos > 0""")
def stat_repeat_of_claim(read):
    """The claim a run was built on is given; every fourth run has none."""
    from plumbline.operators.segments import stat_repeat as op
    seg = V.segments(read)
    claim = F.concat(F.lit("It costs 1,5 or "), (F.col("run_id") % 5).cast("string"), F.lit(".5 percent, 2 times"))
    hero = seg.where("run_id % 4 > 0").select("run_id", claim.alias("stat")).distinct()
    return op(seg, hero=hero).select("run_id", "pos", F.array_join("stat", "|").alias("stat"), "repeats")



def _speech_sql(c: str) -> str:
    rules = [*K.SPEECH_BEFORE_DOMAIN, ("(?i)example\\.org", "example dot org"), *K.SPEECH_AFTER_DOMAIN]
    for pattern, repl in rules:
        c = f"regexp_replace({c}, {lit(pattern)}, {lit(repl)}, 'g')"
    return strip(f"regexp_replace({c}, {lit(K.WS + '+')}, ' ', 'g')")


@query("F15", f"WITH {V.NOTES_SQL} SELECT article_id, line_no, {_speech_sql('note')} AS spoken FROM notes")
def normalize_speech(read):
    return V.notes(read).select("article_id", "line_no",
                                X.normalize_speech("note", "example.org", "example dot org").alias("spoken"))


@query("F16", " UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS list, array_to_string(list_sort({tokens_alpha('text', s)}), ' ') AS tokens FROM documents"
    for n, s in (("scoring", K.STOP_SCORING), ("source", K.STOP_SOURCE), ("footage", K.STOP_FOOTAGE))))
def tokens_alpha_sets(read):
    lists = {"scoring": K.STOP_SCORING, "source": K.STOP_SOURCE, "footage": K.STOP_FOOTAGE}
    rows = F.array(*[F.struct(F.lit(n).alias("list"), F.array_join(F.sort_array(X.tokens_alpha("text", s)), " ").alias("tokens"))
                     for n, s in lists.items()])
    return read("documents").select("doc_id", F.inline(rows))


@query("F17", f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter({words('lower(text)')},
lambda w: length(w) > 2 AND w NOT IN {in_list(K.STOP_LIBRARY)}))), ' ') AS tokens FROM documents""")
def tokens_ws(read):
    return read("documents").select("doc_id", F.array_join(F.sort_array(X.tokens_ws("text")), " ").alias("tokens"))


def _bare(c: str, chars: str) -> str:
    return f"regexp_replace({c}, {lit(f'^[{chars}]+|[{chars}]+$')}, '', 'g')"


def keyword_sql(c: str) -> str:
    return (f"array_to_string(list_filter(list_transform({words(c)}, lambda w: {_bare('w', X.QUERY_EDGE)}), "
            f"lambda w: length(w) > 2 AND lower(w) NOT IN {in_list(K.STOP_QUERY)})[1:4], ' ')")


@query("F18", f"SELECT conv_id, turn, {keyword_sql('text')} AS q FROM conversations")
def keyword_query(read):
    return read("conversations").select("conv_id", "turn", X.keyword_query("text").alias("q"))


_SUBJECT = "p_name"
_PART_SQL = """p AS (SELECT p_partkey, p_name AS subject,
  CASE p_size % 4 WHEN 0 THEN 'factory' WHEN 1 THEN '' ELSE lower(p_type) END AS modifier,
  'The ' || p_name || ' (' || lower(p_type) || ') should be made over ' || p_size || ' steps.' AS narration,
  CASE p_size % 5 WHEN 0 THEN 'mining' WHEN 1 THEN 'oil_gas' WHEN 2 THEN 'agriculture' ELSE 'other' END AS category FROM part)"""


def _parts(read):
    size = F.col("p_size")
    return read("part").select(
        "p_partkey", F.col("p_name").alias("subject"),
        F.when(size % 4 == 0, "factory").when(size % 4 == 1, "").otherwise(F.lower("p_type")).alias("modifier"),
        F.concat(F.lit("The "), "p_name", F.lit(" ("), F.lower("p_type"), F.lit(") should be made over "),
                 size.cast("string"), F.lit(" steps.")).alias("narration"),
        F.when(size % 5 == 0, "mining").when(size % 5 == 1, "oil_gas").when(size % 5 == 2, "agriculture")
        .otherwise("other").alias("category"))


@query("F19", f"""
WITH {_PART_SQL},
q AS (SELECT p_partkey, [{strip("subject || ' ' || modifier")}, {keyword_sql('narration')}, subject,
  CASE category {' '.join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in K.TOPIC_DEFAULTS.items())} ELSE {lit(K.TOPIC_FALLBACK)} END] AS a FROM p),
e AS (SELECT p_partkey, a[i] AS q, i FROM q, range(1, 5) r(i) WHERE a[i] <> '' AND NOT list_contains(a[1:i - 1], a[i]))
SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey ORDER BY i) - 1 AS ordinal,
       CASE WHEN regexp_matches(lower(q), {lit('|'.join(K.INDUSTRIAL_TOKENS))}) THEN q ELSE q || ' industrial' END AS q FROM e""")
def build_queries(read):
    return _parts(read).select("p_partkey", F.posexplode(
        X.build_queries("subject", "modifier", "narration", "category")).alias("o", "q")).select(
        "p_partkey", F.col("o").cast("bigint").alias("ordinal"), "q")


PROMPT = "Say in plain words what the picture shows, where it was taken and which lettering can be read in it."


def _any_sql(c: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({c}, {lit(p)})" for p in phrases) + ")"


@query("F21", f"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 11 = 0 THEN text || ' {PROMPT}'
                  WHEN doc_id % 7 = 0 THEN text || ' I''m sorry, no image here.' ELSE text END AS description,
                  CASE WHEN doc_id % 9 = 0 THEN 'Getty ' || source ELSE source END AS visible FROM documents)
SELECT doc_id, CASE WHEN description IS NULL OR description = '' THEN 'describe_failed'
  WHEN length(description) < {K.DESCRIPTION_MIN_CHARS} THEN 'description_too_short'
  WHEN {_any_sql('lower(description)', K.REFUSAL_PHRASES)} THEN 'refusal_phrase'
  WHEN {_any_sql('lower(description)', X.prompt_windows(PROMPT))} THEN 'prompt_echo'
  WHEN {_any_sql('lower(visible)', K.WATERMARK_TERMS)} THEN 'watermark_text' END AS reason FROM d""")
def description_gate(read):
    i = F.col("doc_id")
    d = read("documents").select(
        "doc_id", F.when(i % 13 == 0, "").when(i % 11 == 0, F.concat("text", F.lit(" " + PROMPT)))
        .when(i % 7 == 0, F.concat("text", F.lit(" I'm sorry, no image here."))).otherwise(F.col("text")).alias("description"),
        F.when(i % 9 == 0, F.concat(F.lit("Getty "), "source")).otherwise(F.col("source")).alias("visible"))
    return d.select("doc_id", X.description_gate("description", "visible", PROMPT).alias("reason"))


def clean_overlay_sql(c: str) -> str:
    c = strip(f"regexp_replace({c}, '^\\[.*?[\\]:]', '')")
    c = f"translate(replace(replace({c}, '[', ''), ']', ''), ',', ' ')"
    return strip(f"regexp_replace({c}, {lit(K.WS + '+')}, ' ', 'g')") + "[1:60]"


def _bag_sql(c: str) -> str:
    return f"list_distinct(list_transform({words(c)}, lambda w: {_bare('lower(w)', '.,;:!?')}))"


@query("F22", f"""
WITH {V.SEGMENTS_SQL},
o AS (SELECT run_id, pos, spoken, {clean_overlay_sql("CASE WHEN pos % 3 = 1 THEN '[Visual: pipe] ' ELSE '' END || card_text")} AS t FROM segments),
b AS (SELECT *, {_bag_sql('t')} AS tb, {_bag_sql('spoken')} AS nb FROM o)
SELECT run_id, pos, t AS overlay, CASE WHEN len({words('t')}) > 6 THEN 'text_too_long'
  WHEN len(tb) > 0 AND list_has_any(tb, nb) AND len(list_filter(tb, lambda w: NOT list_contains(nb, w))) <= 1 THEN 'text_duplicates_voice'
  WHEN NOT (regexp_matches(t, '[0-9]') OR list_has_any(tb, {lits(K.OVERLAY_TERMS)}) OR contains(lower(t), 'vs')
            OR contains(t, '→') OR contains(t, '->')) THEN 'text_unrelated' END AS flag
FROM b""")
def overlay_text(read):
    raw = F.concat(F.when(F.col("pos") % 3 == 1, "[Visual: pipe] ").otherwise(""), F.col("card_text"))
    seg = V.segments(read).select("run_id", "pos", "spoken", X.overlay_text_clean(raw).alias("overlay"))
    return seg.select("run_id", "pos", "overlay", X.overlay_text_flag("overlay", "spoken").alias("flag"))


def non_latin_sql(c: str) -> str:
    n = f"length(regexp_replace({c}, {lit(K.INDIC_LETTER.replace('[', '[^'))}, '', 'g'))"
    a = f"length(regexp_replace({c}, '[^A-Za-z]', '', 'g'))"
    return f"({n} > 0 AND {n} > {a} * {K.NON_LATIN_SHARE})"


def junk_caption_sql(c: str) -> str:
    return (f"(regexp_matches({c}, {lit('(?i)' + K.CAPTION_REJECT)}) OR regexp_matches({c}, {lit('(?i)' + K.DIAGRAM_REJECT)}) "
            f"OR {non_latin_sql(c)})")


_TITLE_SQL = """CASE doc_id % 10 WHEN 0 THEN 'Breaking News: ' WHEN 1 THEN 'How  to ' WHEN 2 THEN 'कमल नगर कमल '
  WHEN 3 THEN 'Flow chart ' ELSE '' END || text"""


@query("F23", f"""
WITH d AS (SELECT doc_id, {_TITLE_SQL} AS title FROM documents),
m AS (SELECT *, lower(regexp_extract(title, {lit('(?i)' + K.TITLE_REJECT)}, 1)) AS hit FROM d)
SELECT doc_id, CASE WHEN hit <> '' THEN 'junk_keyword:' || hit WHEN {non_latin_sql('title')} THEN 'non_latin_script' END AS title_reason,
       {junk_caption_sql('title')} AS caption_junk FROM m""")
def junk_caption(read):
    i = F.col("doc_id") % 10
    title = F.concat(F.when(i == 0, "Breaking News: ").when(i == 1, "How  to ").when(i == 2, "कमल नगर कमल ")
                     .when(i == 3, "Flow chart ").otherwise(""), F.col("text"))
    d = read("documents").select("doc_id", title.alias("title"))
    return d.select("doc_id", X.junk_title("title").alias("title_reason"), X.junk_caption("title").alias("caption_junk"))


_DIAG_SQL = """p_name || CASE p_size % 6 WHEN 0 THEN ' Fig 3' WHEN 1 THEN ' flow  chart' WHEN 2 THEN ' reaction scheme'
 WHEN 3 THEN ' figures' WHEN 4 THEN ' Equation2' ELSE '' END"""


@query("F24", f"SELECT p_partkey, {_DIAG_SQL} AS caption, regexp_matches({_DIAG_SQL}, {lit('(?i)' + K.DIAGRAM_REJECT)}) AS is_diagram FROM part")
def diagram_caption(read):
    s = F.col("p_size") % 6
    cap = F.concat("p_name", F.when(s == 0, " Fig 3").when(s == 1, " flow  chart").when(s == 2, " reaction scheme")
                   .when(s == 3, " figures").when(s == 4, " Equation2").otherwise(""))
    return read("part").select("p_partkey", cap.alias("caption")).withColumn("is_diagram", X.diagram_caption("caption"))


_RUN_SQL = """CASE l_linenumber % 4 WHEN 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ':' || (l_partkey % 60)
 WHEN 1 THEN (l_linenumber || ':' || CAST(l_quantity AS BIGINT) || ':' || (l_partkey % 60) || '.5')
 WHEN 2 THEN 'about ' || l_partkey ELSE l_partkey || ':x' END"""


@query("F25", f"""
WITH r AS (SELECT l_orderkey, l_partkey, l_linenumber, {_RUN_SQL} AS runtime FROM lineitem), p AS (SELECT *, string_split(runtime, ':') AS a FROM r)
SELECT l_orderkey, l_partkey, l_linenumber, runtime, CASE len(a) WHEN 2 THEN try_cast(a[1] AS INT) * 60 + try_cast(a[2] AS DOUBLE)
  WHEN 3 THEN try_cast(a[1] AS INT) * 3600 + try_cast(a[2] AS INT) * 60 + try_cast(a[3] AS DOUBLE) END AS seconds FROM p""")
def parse_runtime(read):
    q, p = F.col("l_quantity").cast("bigint").cast("string"), (F.col("l_partkey") % 60).cast("string")
    k = F.col("l_linenumber") % 4
    run = (F.when(k == 0, F.concat_ws(":", q, p)).when(k == 1, F.concat(F.col("l_linenumber").cast("string"), F.lit(":"), q, F.lit(":"), p, F.lit(".5")))
           .when(k == 2, F.concat(F.lit("about "), F.col("l_partkey").cast("string"))).otherwise(F.concat(F.col("l_partkey").cast("string"), F.lit(":x"))))
    return read("lineitem").select("l_orderkey", "l_partkey", F.col("l_linenumber"), run.alias("runtime")).withColumn(
        "seconds", X.parse_runtime("runtime"))


@query("F27", rf"""
WITH q AS (SELECT doc_id, text, {strip(f"regexp_replace(text, {lit(K.WS + '+')}, ' ', 'g')")} AS q FROM documents),
w AS (SELECT *, regexp_extract(text, '\p{{Nd}}[\p{{Nd}},]*(?:\.\p{{Nd}}+)?') AS num,
             list_transform({words('text')}, lambda w: {_bare('w', '.,;:!?')}) AS ws FROM q)
SELECT doc_id, CASE WHEN length(q) <= 120 THEN q ELSE regexp_replace(regexp_replace(q[1:120], ' [^ ]*$', ''), '[.,;: ]+$', '') || '…' END AS quote,
       CASE WHEN num <> '' THEN num ELSE list_reduce(list_prepend('', ws), lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END) END AS accent
FROM w""")
def trim_quote_and_accent(read):
    return read("documents").select("doc_id", X.trim_quote("text").alias("quote"), X.pick_accent("text").alias("accent"))


def _remove_sql(c: str) -> str:
    for p in K.SCRIPT_BANNED_PHRASES:
        c = f"regexp_replace({c}, {lit('(?i)' + p.replace('-', '[-]'))}, ' ', 'g')"
    return strip(f"regexp_replace({c}, {lit(K.WS + '+')}, ' ', 'g')")


_BANNED_TEXT_SQL = "CASE doc_id % 3 WHEN 0 THEN 'In this VIDEO we unlock it. ' ELSE '' END || text || CASE doc_id % 4 WHEN 1 THEN ' A Game-Changer!' ELSE '' END"


@query("F28", f"SELECT doc_id, {_remove_sql(_BANNED_TEXT_SQL)} AS clean FROM documents")
def remove_phrases(read):
    i = F.col("doc_id")
    t = F.concat(F.when(i % 3 == 0, "In this VIDEO we unlock it. ").otherwise(""), F.col("text"),
                 F.when(i % 4 == 1, " A Game-Changer!").otherwise(""))
    return read("documents").select("doc_id", X.remove_phrases(t).alias("clean"))
