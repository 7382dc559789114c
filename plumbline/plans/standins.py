"""Operator inputs derived from the given tables, in Spark and in SQL.

The given tables hold no segments, facts, candidates or grades, so the queries
derive them row by row from the tables, and grow with them. Each ``*_SQL``
string is the same derivation for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline import constants as K
from plumbline.functions import text as X
from plumbline.plans.sqlkit import lits, words
from plumbline.session import dealt

BEATS = [b for b, _, _ in K.BEAT_TEMPLATE]

# ── segments: a conversation is a run, a turn is a segment ─────────────────
SEGMENTS_SQL = f"""segments AS (
  SELECT conv_id AS run_id, turn AS pos,
         CASE WHEN turn < 5 THEN {lits(BEATS)}[turn + 1] ELSE role END AS beat,
         text || ' Output grew ' || ((conv_id % 5) + (turn % 3)) || '.5 percent in ' || (turn + 1) || ' days.' AS narration,
         text AS spoken,
         CASE WHEN turn % 4 = 3 THEN 'Tank ' || (turn + 2) || ' vs ' || conv_id
              ELSE array_to_string(({words('text')})[1:2 + ((conv_id + turn) % 8)], ' ') END AS card_text,
         CASE WHEN (conv_id + turn) % 3 = 0 THEN '' ELSE role || ' pump station' END AS broll_wish,
         role
  FROM conversations)"""


def segments(read) -> DataFrame:
    c = read("conversations")
    card = X.first_words("text", (F.lit(2) + (F.col("conv_id") + F.col("turn")) % 8).cast("int"))
    return c.select(
        F.col("conv_id").alias("run_id"), F.col("turn").alias("pos"),
        F.when(F.col("turn") < 5, F.get(X.strings(BEATS), F.col("turn").cast("int"))).otherwise(F.col("role")).alias("beat"),
        F.concat("text", F.lit(" Output grew "), (F.col("conv_id") % 5 + F.col("turn") % 3).cast("string"),
                 F.lit(".5 percent in "), (F.col("turn") + 1).cast("string"), F.lit(" days.")).alias("narration"),
        F.col("text").alias("spoken"),
        F.when(F.col("turn") % 4 == 3, F.concat(F.lit("Tank "), (F.col("turn") + 2).cast("string"), F.lit(" vs "),
                                               F.col("conv_id").cast("string"))).otherwise(card).alias("card_text"),
        F.when((F.col("conv_id") + F.col("turn")) % 3 == 0, F.lit("")).otherwise(
            F.concat("role", F.lit(" pump station"))).alias("broll_wish"),
        "role")


# ── shipping notes: numbers with units, one note per line item ─────────────
NOTES_SQL = """notes AS (
  SELECT l_orderkey AS article_id, l_linenumber AS line_no, l_partkey, l_suppkey, l_shipdate,
         'Lot [' || l_linenumber || '] moved ' || CAST(l_quantity AS BIGINT) || ' kg of salt! It lost ' ||
         CAST(round(l_discount * 100) AS BIGINT) || '% in ' || (l_linenumber + 2) || ' days; dosing was **' ||
         CAST(l_quantity AS BIGINT) || ',5** mg/L at 2' || l_linenumber || '°C. CO2 and H2S stayed below ' ||
         CAST(round(l_tax * 100) AS BIGINT) || ' ppm' ||
         CASE WHEN l_returnflag = 'R' THEN ' near example.org.' ELSE '.' END AS note
  FROM lineitem)"""


def notes(read) -> DataFrame:
    qty = F.col("l_quantity").cast("bigint").cast("string")
    def pct(c):
        return F.round(F.col(c) * 100).cast("bigint").cast("string")
    return dealt(read("lineitem"), "l_orderkey").select(
        F.col("l_orderkey").alias("article_id"), F.col("l_linenumber").alias("line_no"), "l_partkey", "l_suppkey", "l_shipdate",
        F.concat(F.lit("Lot ["), F.col("l_linenumber").cast("string"), F.lit("] moved "), qty, F.lit(" kg of salt! It lost "),
                 pct("l_discount"), F.lit("% in "), (F.col("l_linenumber") + 2).cast("string"),
                 F.lit(" days; dosing was **"), qty, F.lit(",5** mg/L at 2"), F.col("l_linenumber").cast("string"),
                 F.lit("°C. CO2 and H2S stayed below "), pct("l_tax"), F.lit(" ppm"),
                 F.when(F.col("l_returnflag") == "R", F.lit(" near example.org.")).otherwise(F.lit("."))).alias("note"))


# ── scripts: every order is a run of (mostly) five beats ───────────────────
WORDS = ["the", "dosing", "pump,", "holds", "a", "steady", "flow;", "operators", "check", "level."]
LO = [3, 6, 11, 9, 9]
HI = [8, 12, 24, 20, 16]
DIFFERENTIATORS = [("b0", "Batch-level checks"), ("b1", "Quotes in 2 days"), ("b2", "Solar plant")]
CTA_LINES = ["Full guide on example.org", "Call us 24 hours a day"]
DOMAIN = "example.org"
BANNED_CLAIMS = ["certified", "ISO 9001"]


def _nums(items) -> str:
    return "[" + ", ".join(str(i) for i in items) + "]"


SCRIPTS_SQL = f"""scripts0 AS (
  SELECT o_orderkey AS run_id, CAST(p AS BIGINT) AS pos,
         {lits(BEATS)}[CASE WHEN o_orderkey % 10 = 8 THEN 5 - p ELSE p + 1 END] AS beat,
         {_nums(LO)}[p + 1] + (o_orderkey * 7 + p * 5) % ({_nums([h - l + 3 for l, h in zip(LO, HI)])}[p + 1]) AS n
  FROM orders, range(CASE WHEN o_orderkey % 10 = 9 THEN 4 ELSE 5 END) r(p)),
scripts1 AS (SELECT *, array_to_string(list_transform(range(n - 2), lambda i: {lits(WORDS)}[1 + (i + run_id) % 10]), ' ') || ' rate ' ||
         CASE WHEN run_id % 3 = 0 THEN 'high' ELSE '' || (run_id % 50) END || CASE WHEN run_id % 11 = 0 THEN ' game-changer' ELSE '' END AS narration FROM scripts0),
scripts AS (SELECT run_id, pos, beat, narration,
         CASE (run_id + pos) % 4 WHEN 0 THEN array_to_string(string_split(narration, ' ')[1:5], ' ') WHEN 1 THEN 'Rate ' || (run_id % 50) || ' units'
              WHEN 2 THEN 'one two three four five six seven eight' ELSE 'Certified flow' END AS card_text,
         CASE WHEN (run_id + pos) % 3 = 0 THEN '' ELSE 'pump station' END AS broll_wish,
         CASE WHEN pos = 4 AND run_id % 23 = 0 THEN NULL ELSE list_concat(['f' || pos, 'f' || ((pos + 1) % 5)], CASE WHEN pos = 4 AND run_id % 29 = 0 THEN ['b2', 'b1'] WHEN pos = 4 AND run_id % 4 > 0 THEN ['b' || (run_id % 3)]
              WHEN pos = 2 AND run_id % 7 = 0 THEN ['b1'] ELSE [] END) END AS fact_ids,
         CASE WHEN pos = 2 AND run_id % 5 > 0 THEN ['in ' || (run_id % 50), 'mix', 'out'] END AS labels
  FROM scripts1),
sfacts AS (SELECT o_orderkey AS run_id, 'f' || i AS id, CASE WHEN i = 3 THEN 'high' ELSE '' || (o_orderkey % 50 + CASE WHEN (o_orderkey + i) % 4 = 0 THEN 1 ELSE 0 END) END AS value,
         'Measured rate ' || (o_orderkey % 50 + CASE WHEN (o_orderkey + i) % 4 = 0 THEN 1 ELSE 0 END) || ' units' AS quote,
         CASE WHEN i % 2 = 0 THEN i + 1 END AS marker, 1 + (o_orderkey * 3 + i) % 5 AS significance
  FROM orders, range(5) r(i)),
cites AS (SELECT o_orderkey AS run_id, 1 + 2 * i AS marker, CASE WHEN (o_orderkey + i) % 3 = 0 THEN 'https://www.doi.org/' ELSE 'https://www.example.net/' END || o_orderkey AS url
  FROM orders, range(3) r(i))"""


def scripts(read) -> DataFrame:
    k, p = F.col("run_id"), F.col("pos")

    def pick(items):
        return F.get(F.array(*[F.lit(i) for i in items]), p.cast("int"))

    o = dealt(read("orders"), "o_orderkey").select(F.col("o_orderkey").alias("run_id"),
                              F.explode(F.sequence(F.lit(0), F.when(F.col("o_orderkey") % 10 == 9, 3).otherwise(4))).alias("p"))
    o = o.select("run_id", F.col("p").cast("bigint").alias("pos"))
    beat = F.get(X.strings(BEATS), F.when(k % 10 == 8, 4 - p).otherwise(p).cast("int"))
    n = pick(LO) + (k * 7 + p * 5) % pick([h - l + 3 for l, h in zip(LO, HI)])
    o = o.withColumn("beat", beat).withColumn("n", n.cast("int"))
    body = F.transform(F.sequence(F.lit(0), F.col("n") - 3), lambda i: F.get(X.strings(WORDS), ((i + k) % 10).cast("int")))
    narration = F.concat(F.array_join(body, " "), F.lit(" rate "), F.when(k % 3 == 0, "high").otherwise((k % 50).cast("string")),
                         F.when(k % 11 == 0, " game-changer").otherwise(""))
    o = o.withColumn("narration", narration)
    c = (k + p) % 4
    return o.select(
        "run_id", "pos", "beat", "narration",
        F.when(c == 0, F.array_join(F.slice(F.split("narration", " "), 1, 5), " ")).when(c == 1, F.concat(F.lit("Rate "), (k % 50).cast("string"), F.lit(" units")))
        .when(c == 2, "one two three four five six seven eight").otherwise("Certified flow").alias("card_text"),
        F.when((k + p) % 3 == 0, "").otherwise("pump station").alias("broll_wish"),
        F.when(~((p == 4) & (k % 23 == 0)), F.concat(F.array(F.concat(F.lit("f"), p.cast("string")), F.concat(F.lit("f"), ((p + 1) % 5).cast("string"))),
                 F.when((p == 4) & (k % 29 == 0), X.strings(["b2", "b1"])).when((p == 4) & (k % 4 > 0), F.array(F.concat(F.lit("b"), (k % 3).cast("string"))))
                 .when((p == 2) & (k % 7 == 0), X.strings(["b1"])).otherwise(X.strings([])))).alias("fact_ids"),
        F.when((p == 2) & (k % 5 > 0), F.array(F.concat(F.lit("in "), (k % 50).cast("string")), F.lit("mix"), F.lit("out"))).alias("labels"))


def script_facts(read) -> DataFrame:
    o = dealt(read("orders"), "o_orderkey").select(F.col("o_orderkey").alias("run_id"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i"))
    k, i = F.col("run_id"), F.col("i")
    v = (k % 50 + F.when((k + i) % 4 == 0, 1).otherwise(0)).cast("string")
    return o.select("run_id", F.concat(F.lit("f"), i.cast("string")).alias("id"), F.when(i == 3, "high").otherwise(v).alias("value"),
                    F.concat(F.lit("Measured rate "), v, F.lit(" units")).alias("quote"), F.lit("units").alias("unit"),
                    F.when(i % 2 == 0, i + 1).alias("marker"), (1 + (k * 3 + i) % 5).alias("significance"))


def script_citations(read) -> DataFrame:
    o = dealt(read("orders"), "o_orderkey").select(F.col("o_orderkey").alias("run_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i"))
    return o.select("run_id", (1 + 2 * F.col("i")).alias("marker"), F.concat(
        F.when((F.col("run_id") + F.col("i")) % 3 == 0, "https://www.doi.org/").otherwise("https://www.example.net/"),
        F.col("run_id").cast("string")).alias("url"))
