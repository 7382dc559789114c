"""The shots of a segment are worked out once for each row, whatever Spark puts around them; phrases and spans are those of plain loops."""

import random
import re

from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions import text as X
from plumbline.operators import segments as S
from plumbline.plans import standins as V
from plumbline.plans.gate_queries import RULES

SMALL = "/root/testdata/sf0.001"
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def test_no_filter_holds_the_tree(spark):
    read = lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")
    out = S.expand_segments(V.scripts(read), V.script_facts(read), V.script_citations(read), RULES)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("Generate posexplode" in line for line in plan)
    assert not [line[:200] for line in plan if re.match(r"[ :+|-]*Filter", line) and ("transform(" in line or "aggregate(" in line)]


def test_a_segment_without_text_keeps_its_shot(spark):
    seg = spark.createDataFrame([(1, 0, "hook", None), (1, 1, "mechanism", None), (1, 2, "stakes", ""), (1, 3, None, " ,; ")], "run_id long, pos long, beat string, narration string")
    for c in ("card_text", "broll_wish"):
        seg = seg.withColumn(c, F.lit("x"))
    seg = seg.withColumn("fact_ids", X.strings([])).withColumn("labels", X.strings([]))
    facts = spark.createDataFrame([], "run_id long, id string, quote string, value string, unit string, marker int")
    cites = spark.createDataFrame([], "run_id long, marker int, url string")
    got = {(r.pos, r.sub, r.type, r.narration_span) for r in S.expand_segments(seg, facts, cites, RULES).collect()}
    assert got == {(0, 0, "HEADLINE_CARD", None), (1, 0, "DIAGRAM", None), (2, 0, "HEADLINE_CARD", ""), (3, 0, "HEADLINE_CARD", " ,; ")}


def test_every_character_is_space_or_not(spark):
    chars = spark.createDataFrame([(chr(i),) for i in [*range(0x3100), 0xD7FF, 0xFEFF, 0x10FFFF]], "c string")
    both = (F.rlike("c", F.lit(f"^[{K.NOT_WS}]$")) == F.rlike("c", F.lit(f"^{K.WS}$"))) | (
        F.rlike("c", F.lit(f"^[{K.NOT_WS_OR_MARK}]$")) == F.rlike("c", F.lit(f"^(?:{K.WS}|[,.;:])$")))
    assert chars.where(both).count() == 0


def phrases(text):
    return [p for p in (p.strip(SPACES) for p in re.split("[,.;:]+", text)) if p]


def pieces(text):
    out = []
    for p in phrases(text):
        w = [x for x in re.split(f"[{SPACES}]+", p) if x]
        out += [" ".join(w[i:i + 5]) for i in range(0, len(w), 5)] if len(w) > 5 else [p]
    return out


def spans(text):
    out, n = [], 0
    for p in pieces(text):
        k = len(re.split(f"[{SPACES}]+", p))
        if out and (n + k) / K.WORDS_PER_SECOND <= K.SHOT_TARGET_MAX_S:
            out[-1], n = f"{out[-1]}, {p}", n + k
        else:
            out, n = [*out, p], k
    if len(out) > 1 and n / K.WORDS_PER_SECOND < K.SHOT_TARGET_MIN_S / 2:
        out[-2:] = [f"{out[-2]}, {out[-1]}"]
    return out


def test_phrases_pieces_and_spans_equal_the_loops(spark):
    r = random.Random(4)
    some = ["a", "bc", chr(0xE9), "x-y", chr(0x1F600), chr(0x200B), " ", " ", " ", "  ", ",", ". ", ";", ":", *SPACES]
    texts = ["", " ", ",", " ,;", "a  b", "a b c d e", "a  b c d e f"] + ["".join(r.choice(some) for _ in range(n)) for n in (2, 5, 20, 60, 200) for _ in range(60)]
    texts += [" ".join(r.choice(["w", "w", "w,", "x.", "yy  z"]) for _ in range(n)) for n in (X.FEW_PIECES - 2, X.FEW_PIECES, 3 * X.FEW_PIECES) for _ in range(20)]
    texts += [", ".join(["three word phrase"] * n) for n in range(X.FEW_PIECES - 1, X.FEW_PIECES + 2)]
    p = X.split_phrases("t")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", p.alias("p"), X.chunk_long(p).alias("c"), X.pack_phrases(p).alias("s"), X.word_count("t").alias("n")).collect()
    for x in rows:
        assert (x.p, x.c, x.s, x.n) == (phrases(x.t), pieces(x.t), spans(x.t), len([w for w in re.split(f"[{SPACES}]+", x.t) if w])), repr(x.t)
    assert spark.sql("SELECT CAST(NULL AS STRING) t").select(p.alias("p")).head().p is None
