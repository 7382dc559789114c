"""Rule gates: segments in, violations out. No violation row means the run passes.

A segment table has (run_id, pos, beat, narration, card_text, fact_ids, labels)
with ``pos`` the dense 0-based position in the run. Row gates are expressions
giving an array of (gate, message), so ``run_gates`` evaluates all of them in
one pass; run gates come from one aggregation per run.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import constants as K
from plumbline.functions import text as X
from plumbline.session import cut, large

VIOLATIONS = "array<struct<gate:string,message:string>>"
WPS = K.WORDS_PER_SECOND
LOW = [lo * WPS * (1 - K.WORD_BUDGET_TOLERANCE) for _, lo, _ in K.BEAT_TEMPLATE]
HIGH = [hi * WPS * (1 + K.WORD_BUDGET_TOLERANCE) for _, _, hi in K.BEAT_TEMPLATE]
BEATS = [b for b, _, _ in K.BEAT_TEMPLATE]
MIN_WORDS = round(K.TOTAL_MIN_S * WPS)
MAX_WORDS = round(K.TOTAL_MAX_S * WPS)


@dataclass
class Rules:
    """Rule texts of one publisher; small by nature and given by the caller."""

    differentiators: list[tuple[str, str]] = field(default_factory=list)
    cta_lines: list[str] = field(default_factory=list)
    domain: str = ""
    banned_claims: list[str] = field(default_factory=list)

    @property
    def ids(self) -> list[str]:
        return sorted(i for i, _ in self.differentiators)

    @property
    def banned(self) -> list[str]:
        return [p.lower() for p in [*K.SCRIPT_BANNED_PHRASES, *K.HYPE_PHRASES, *self.banned_claims]]


def quoted(arr: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def _hit(gate: str, *parts) -> Column:
    return F.struct(F.lit(gate).alias("gate"), F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("message"))


def _when(cond: Column, hit: Column) -> Column:
    return F.when(cond, F.array(hit)).otherwise(F.expr(f"cast(array() as {VIOLATIONS})"))


def at_beat(values, pos="pos") -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.col(pos).cast("int"))


def number_runs(c) -> Column:
    """Runs of digits and dots in a normalised text, thousands commas out."""
    return F.regexp_extract_all(F.replace(X.normalize_for_match(c), F.lit(","), F.lit("")), F.lit(r"([\p{Nd}.]+)"), F.lit(1))


def has_number(*cols) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.rlike(F.coalesce(F.col(c), F.lit("")), F.lit(r"\p{Nd}"))
    return out


def number_pool(segments: DataFrame, facts: DataFrame, rules: Rules) -> DataFrame:
    """Segments with ``_pool``: the number runs its own numbers may come from.

    Quotes are normalised once per fact, rule texts once per plan (they are
    literals), and a segment gathers no more quotes than it has fact_ids.
    """
    none = X.strings([])
    refs = segments.select("run_id", "pos", F.explode(F.array_distinct("fact_ids")).alias("id"))
    runs = facts.select("run_id", "id", number_runs("quote").alias("_runs"))
    quotes = refs.join(large(runs), ["run_id", "id"]).groupBy("run_id", "pos").agg(F.flatten(F.collect_list("_runs")).alias("_quoted"))
    out = segments.join(large(quotes), ["run_id", "pos"], "left")
    own = [F.when(F.array_contains("fact_ids", i), number_runs(F.lit(t))).otherwise(none) for i, t in rules.differentiators]
    always = [number_runs(F.lit(t)) for t in [*rules.cta_lines, rules.domain]]
    return out.withColumn("_pool", F.concat(F.coalesce("_quoted", none), *own, *always)).drop("_quoted")


def numbers_gate(pool: str = "_pool") -> Column:
    """Each number must stand in the pool as a whole number.

    A number is traced if a run of digits and dots in the pool is that number,
    or goes on after it with a dot: no regex is built per number.
    """
    def bad(source: Column, where: str):
        missing = F.filter(X.numeric_tokens(source), lambda t: ~F.exists(
            F.col(pool), lambda r: (r == t) | F.startswith(r, F.concat(t, F.lit(".")))))
        return F.transform(missing, lambda t: _hit("numbers", "numbers[", F.col("beat"), "]: '", t,
                                                   f"' in {where} does not trace to any referenced fact"))

    labels = F.flatten(F.transform(F.coalesce("labels", X.strings([])), lambda c: bad(c, "diagram label")))
    return F.concat(bad(F.col("narration"), "narration"), bad(F.col("card_text"), "card_text"), labels)


def banned_gate(phrases: list[str]) -> Column:
    return X.let(F.lower(F.concat_ws(" ", F.coalesce("narration", F.lit("")), F.coalesce("card_text", F.lit("")))), lambda t: F.transform(
        F.filter(X.strings(phrases), lambda p: F.contains(t, p)),
        lambda p: _hit("banned", "banned[", F.col("beat"), "]: contains '", p, "'")))


def budget_gate() -> Column:
    n = X.word_count("narration")
    low, high = at_beat(LOW), at_beat(HIGH)
    return _when((n < low) | (n > high), _hit(
        "budget", "budget[", at_beat(BEATS), "]: ", n.cast("string"), " words outside [",
        at_beat([math.ceil(v) for v in LOW]).cast("string"), ", ", at_beat([math.floor(v) for v in HIGH]).cast("string"), "]"))


def card_gate() -> Column:
    card, told = X.normalize_for_match(F.coalesce("card_text", F.lit(""))), X.normalize_for_match(F.coalesce("narration", F.lit("")))
    w = F.filter(F.split(card, " "), lambda x: x != "")
    echo = X.let(told, lambda t: X.let(w, lambda a: F.exists(
        F.when(F.size(a) >= 5, F.sequence(F.lit(1), F.size(a) - 4)).otherwise(F.expr("cast(array() as array<int>)")),
        lambda i: F.contains(t, F.array_join(F.slice(a, i, F.lit(5)), " ")))))
    return F.concat(_when(echo, _hit("card", "card[", F.col("beat"), "]: card_text duplicates narration")),
                    _when(F.size(w) > 7, _hit("card", "card[", F.col("beat"), "]: card_text longer than 7 words")))


def early_differentiator_gate(ids: list[str], last: Column) -> Column:
    found = F.filter("fact_ids", lambda f: f.isin(*ids)) if ids else X.strings([])
    return _when((F.col("pos") < last) & (F.size(found) > 0), _hit(
        "differentiator", "differentiator[", F.col("beat"), "]: brand differentiators belong in the CTA beat only, found ", quoted(found)))


def _explode(segments: DataFrame, hits: Column) -> DataFrame:
    return segments.select("run_id", "pos", F.explode(hits).alias("_v")).select("run_id", "pos", "_v.gate", "_v.message")


def gate_numbers(segments: DataFrame, facts: DataFrame, rules: Rules) -> DataFrame:
    some = segments.where(has_number("narration", "card_text") | (F.size(F.coalesce("labels", X.strings([]))) > 0))
    return _explode(number_pool(some, facts, rules), numbers_gate())


def gate_banned(segments: DataFrame, rules: Rules) -> DataFrame:
    return _explode(segments, banned_gate(rules.banned))


def gate_word_budget(segments: DataFrame) -> DataFrame:
    return _explode(segments.where(F.col("pos") < len(BEATS)), budget_gate())


def gate_card_echo(segments: DataFrame) -> DataFrame:
    return _explode(segments, card_gate())


def _run_stats(segments: DataFrame) -> DataFrame:
    n = X.word_count("narration")
    room = at_beat([int(h) for h in HIGH]) - n
    inside = F.col("pos") < len(BEATS)
    cited = F.coalesce("fact_ids", X.strings([])) if "fact_ids" in segments.columns else X.strings([])
    return segments.select("run_id", "pos", "beat", cited.alias("fact_ids"),
                           n.alias("_n"), F.when(inside & (room > 0), F.struct(
                               room.alias("room"), at_beat(BEATS).alias("beat"), n.alias("n"), at_beat([int(h) for h in HIGH]).alias("hi"))).alias("_room")).groupBy("run_id").agg(
        F.count("*").alias("beats"), F.count_if(inside & (F.col("beat") == at_beat(BEATS))).alias("in_order"),
        F.sum("_n").alias("total"), F.max("pos").alias("last"), F.max_by("fact_ids", "pos").alias("last_ids"),
        # at most one entry per template position, whatever the length of the run
        F.slice(F.sort_array(F.collect_list("_room"), asc=False), 1, 3).alias("rooms"))


def _structure_hit() -> Column:
    n = len(BEATS)
    return F.when(F.col("beats") != n, _hit("structure", f"structure: expected {n} beats, got ", F.col("beats").cast("string"))).when(
        F.col("in_order") != n, _hit("structure", f"structure: beat order must be {BEATS}"))


def _total_hit() -> Column:
    total, secs = F.col("total"), F.format_string("%.1f", F.col("total") / F.lit(WPS))
    tips = F.array_join(F.transform("rooms", lambda r: F.concat(
        r["beat"], F.lit(" (currently "), r["n"].cast("string"), F.lit(" words, can go up to "), r["hi"].cast("string"), F.lit(")"))), "; ")
    short = _hit("total_duration", "total_duration: ", secs, "s (", total.cast("string"), f" words) is short of the {K.TOTAL_MIN_S:.0f}s floor ({MIN_WORDS} words). Add AT LEAST ",
                 (MIN_WORDS - total + 3).cast("string"), " more words total, distributed across the beats with the most room: ", tips, ".")
    over = _hit("total_duration", "total_duration: ", secs, "s (", total.cast("string"), f" words) is over the {K.TOTAL_MAX_S:.0f}s ceiling ({MAX_WORDS} words). Cut AT LEAST ",
                (total - MAX_WORDS + 3).cast("string"), " words total across the beats.")
    s = total / F.lit(WPS)
    return F.when((s < K.TOTAL_MIN_S) | (s > K.TOTAL_MAX_S), F.when(total < MIN_WORDS, short).otherwise(over))


def _cta_hit(ids: list[str]) -> Column:
    found = F.filter(F.coalesce("last_ids", X.strings([])), lambda f: f.isin(*ids)) if ids else X.strings([])
    return F.when(F.size(found) != 1, _hit("differentiator", f"differentiator[cta]: expected exactly one of {ids}, got ", quoted(found)))


def _run_violations(stats: DataFrame, *hits: Column) -> DataFrame:
    return stats.select("run_id", F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("_v")).select(
        "run_id", F.lit(None).cast("bigint").alias("pos"), "_v.gate", "_v.message")


def gate_total_duration(segments: DataFrame) -> DataFrame:
    return _run_violations(_run_stats(segments), _total_hit())


def gate_differentiator(segments: DataFrame, rules: Rules) -> DataFrame:
    stats = _run_stats(segments)
    cited = segments.where(F.arrays_overlap("fact_ids", X.strings(rules.ids)))
    early = _explode(cited.join(large(stats.select("run_id", "last")), "run_id"), early_differentiator_gate(rules.ids, F.col("last")))
    return _run_violations(stats, _cta_hit(rules.ids)).unionByName(early)


def gate_structure(segments: DataFrame) -> DataFrame:
    return _run_violations(_run_stats(segments), _structure_hit())


_EXTRA: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_gate(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Add a gate: segments -> violations(run_id, pos, gate, message)."""
    if name in _EXTRA:
        raise ValueError(f"gate {name} is registered already")
    _EXTRA[name] = fn


def unregister_gate(name: str) -> None:
    _EXTRA.pop(name, None)


def run_gates(segments: DataFrame, facts: DataFrame, rules: Rules) -> DataFrame:
    """All gates. A run with the wrong structure reports only that."""
    shape = _structure_hit()
    found = F.when(shape.isNull(), F.array(_total_hit(), _cta_hit(rules.ids))).otherwise(F.array(shape, F.lit(None)))
    runs = cut(_run_stats(segments).select("run_id", shape.isNull().alias("sound"), F.filter(found, lambda h: h.isNotNull()).alias("_v")), "run-gates")  # a row for each run
    run_level = runs.select("run_id", F.explode("_v").alias("_v")).select("run_id", F.lit(None).cast("bigint").alias("pos"), "_v.gate", "_v.message")
    ok = segments.join(large(runs.where("sound").select("run_id")), "run_id", "left_semi")
    hits = F.concat(numbers_gate(), banned_gate(rules.banned), budget_gate(), card_gate(),
                    early_differentiator_gate(rules.ids, F.lit(len(BEATS) - 1)))
    out = run_level.unionByName(_explode(number_pool(ok, facts, rules), hits))
    for fn in _EXTRA.values():
        out = out.unionByName(fn(ok))
    return out


def word_topup(segments: DataFrame, violations: DataFrame) -> DataFrame:
    """Pad runs whose only fault is being too short; all other runs are left as they are.

    The structure gate has passed, so a run here has exactly the template's rows
    and a window per run is bounded.
    """
    short = F.col("message").contains("short of") & (F.col("gate") == "total_duration")
    fixable = violations.groupBy("run_id").agg(F.bool_and(short).alias("_fix")).where("_fix").select("run_id")
    seg = segments.join(large(fixable.withColumn("_fix", F.lit(True))), "run_id", "left")
    rows = seg.where("_fix").withColumn("_n", X.word_count("narration"))
    total = F.sum("_n").over(Window.partitionBy("run_id"))
    pools = F.array(*[X.strings(K.TOPUP_WORDS[b]) for b in BEATS])
    by_beat = F.array_position(X.strings(BEATS), F.col("beat")).cast("int") - 1
    pool = F.get(pools, by_beat)
    high = F.get(F.array(*[F.lit(h) for h in HIGH]), by_beat)
    room = F.floor(high) - F.col("_n")
    rows = rows.withColumn("_pool", pool).withColumn("_need", MIN_WORDS - total).withColumn("_free", high - F.col("_n"))
    rows = rows.withColumn("_cap", F.greatest(F.lit(0), F.least(room, F.size("_pool"))))
    order = Window.partitionBy("run_id").orderBy(F.desc("_free"), F.asc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.least(F.col("_cap"), F.greatest(F.lit(0), F.col("_need") - F.coalesce(F.sum("_cap").over(order), F.lit(0))))
    rows = rows.withColumn("_take", taken.cast("int"))
    text = F.regexp_replace("narration", f"{K.WS}+$", "")
    text = F.when((text != "") & ~F.rlike(text, F.lit("[.!?]$")), F.concat(text, F.lit("."))).otherwise(text)
    padded = F.concat(X.strip(F.concat(text, F.lit(" "), F.array_join(F.slice("_pool", F.lit(1), F.greatest(F.col("_take"), F.lit(1))), " "))), F.lit("."))
    rows = rows.withColumn("narration", F.when(F.col("_take") > 0, padded).otherwise(F.col("narration"))).withColumn("added", F.col("_take"))
    keep = seg.where("_fix IS NULL").withColumn("added", F.lit(0))
    return keep.select(*segments.columns, "added").unionByName(rows.select(*segments.columns, "added"))


def critique_route(*scores) -> Column:
    """'rewrite' when the lowest of several scores is under 7, else 'accept'."""
    return F.when(F.least(*[X._col(s) for s in scores]) < 7, "rewrite").otherwise("accept")
