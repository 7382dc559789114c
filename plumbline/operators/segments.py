"""Ordered segments: expansion into shots, timing, cues and per-run order checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import constants as K
from plumbline.functions import links as L
from plumbline.functions import text as X
from plumbline.operators.gates import Rules
from plumbline.operators.ordered import scan
from plumbline.session import cut, large

SHOT = ("array<struct<type:string,narration_span:string,payload:map<string,string>,labels:array<string>,"
        "fallback:struct<type:string,payload:map<string,string>>>>")


def stat_repeat(segments: DataFrame, run: str = "run_id", pos: str = "pos", narration: str = "narration", hero: DataFrame | None = None) -> DataFrame:
    """Flag segments after the first that repeat a number of the run's claim.

    ``hero`` (run, stat text) is the claim a run was built on; without it the opening segment is. A run whose claim
    has no number of its own to repeat repeats nothing.
    """
    first = segments.groupBy(run).agg(F.min_by(narration, pos).alias("_opening"), F.min(pos).alias("_first"))
    if hero is not None:
        first = first.drop("_opening").join(large(hero.select(run, F.col("stat").alias("_opening"))), run, "left")
    first = first.select(run, "_first", X.stat_tokens("_opening").alias("stat"))
    return (segments.join(large(first), run).where(F.col(pos) > F.col("_first")).drop("_first")
            .withColumn("repeats", F.arrays_overlap(X.stat_numbers(narration), F.col("stat"))))


def referenced_facts(segments: DataFrame, facts: DataFrame, citations: DataFrame) -> DataFrame:
    """(run_id, pos, numeric_fact, any_fact, paper_fact): the first of each kind a segment refers to."""
    cites = citations.select("run_id", "marker", "url").withColumn("kind", L.classify_link("url"))
    known = facts.join(large(cites), ["run_id", "marker"], "left")
    refs = segments.select("run_id", "pos", F.posexplode("fact_ids").alias("_i", "id")).join(large(known), ["run_id", "id"])
    row = F.struct("id", "value", "unit", "quote", "marker", "url")
    numeric = F.when(F.size(X.numeric_tokens("value")) > 0, F.col("_i"))
    return refs.groupBy("run_id", "pos").agg(
        F.min_by(row, numeric).alias("numeric_fact"), F.min_by(row, "_i").alias("any_fact"),
        F.min_by(row, F.when(F.col("kind") == "paper", F.col("_i"))).alias("paper_fact"))


def _map(**kv) -> Column:
    parts = []
    for k, v in kv.items():
        parts += [F.lit(k), F.coalesce(v, F.lit(""))]
    return F.create_map(*parts)


def _shot(type_: str, span, payload, labels=None, fallback=None) -> Column:
    none_l, none_f = F.lit(None).cast("array<string>"), F.lit(None).cast("struct<type:string,payload:map<string,string>>")
    return F.struct(F.lit(type_).alias("type"), span.alias("narration_span"), payload.alias("payload"),
                    (none_l if labels is None else labels).alias("labels"), (none_f if fallback is None else fallback).alias("fallback"))


def _declared(type_: str, payload) -> Column:
    return F.struct(F.lit(type_).alias("type"), payload.alias("payload"))


def expand_segments(segments: DataFrame, facts: DataFrame, citations: DataFrame, rules: Rules,
                    default_source: str = "Source — blog") -> DataFrame:
    """Beats to shots: (run_id, pos, sub, beat, type, duration_s, narration_span, payload, labels, fallback)."""
    seg = segments.join(large(referenced_facts(segments, facts, citations)), ["run_id", "pos"], "left")
    def tree(sp):
        """The shots of a segment, given its spans."""
        n, first = F.size(sp), F.get(sp, F.lit(0))
        rest = F.array_join(F.slice(sp, F.lit(2), F.greatest(n - 1, F.lit(1))), ", ")
        rest_or_all = F.when(n > 1, rest).otherwise(F.col("narration"))
        told, card, wish = F.col("narration"), F.col("card_text"), X.strip(F.coalesce("broll_wish", F.lit("")))
        raw_wish = F.coalesce("broll_wish", F.lit(""))

        def chip(f):
            return L.citation_chip(f["marker"], f["url"], f["url"].isNotNull(), default_source)

        def stat(f):
            return _map(value=f["value"], unit=f["unit"], label=card, citation=chip(f), fact_id=f["id"])

        num, anyf, paper = F.col("numeric_fact"), F.col("any_fact"), F.col("paper_fact")
        fact = F.coalesce(num, anyf)
        head = _map(text=card)
        headline = _map(text=card, wish=raw_wish)
        broll = _map(wish=wish, layout=F.lit("auto"))

        hook = F.when((wish != "") & (n >= 2), F.array(
            _shot("BROLL", first, broll, fallback=_declared("HEADLINE_CARD", headline)), _shot("HEADLINE_CARD", rest, headline))
        ).otherwise(F.array(_shot("HEADLINE_CARD", told, headline)))
        none = F.expr(f"cast(array() as {SHOT})")
        stakes = F.concat(F.when(num.isNotNull(), F.array(_shot("STAT_CARD", first, stat(num)))).otherwise(F.array(_shot("HEADLINE_CARD", first, head))),
                          F.when(n > 1, F.array(_shot("HEADLINE_CARD", rest, head))).otherwise(none))
        heads = F.transform(F.slice("_phrases", 1, 3), lambda p: X.first_words(p, 4))
        labels = F.when(F.size(F.coalesce("labels", X.strings([]))) > 0, F.col("labels")).when(F.size(heads) >= 2, heads).otherwise(
            F.slice(F.concat(heads, X.strings(["Result"])), 1, 2))
        k = F.least(F.lit(3), n)
        groups = F.when(k > 1, F.concat(F.slice(sp, F.lit(1), F.greatest(k - 1, F.lit(1))),
                                        F.array(F.array_join(F.slice(sp, k, n), ", ")))).otherwise(F.array(told))
        mechanism = F.transform(groups, lambda span, i: _shot(
            "DIAGRAM", span, _map(template=F.lit("flow"), reveal_stage=(i + 1).cast("string"), reveal_total=k.cast("string")), labels=labels))
        quote = _map(quote=fact["quote"], source=chip(fact))
        p_stat = F.when(F.size(X.numeric_tokens(paper["value"])) > 0, paper).otherwise(F.coalesce(fact, paper))
        proof = (F.when(paper.isNotNull(), F.array(
            _shot("PAPER_CARD", first, _map(marker=paper["marker"].cast("string"), url=paper["url"], highlight=card, wish=raw_wish),
                  fallback=_declared("QUOTE_CARD", _map(quote=paper["quote"], source=chip(paper)))),
            _shot("STAT_CARD", rest_or_all, stat(p_stat))))
            .when((wish != "") & (n >= 2) & fact.isNotNull(), F.array(
                _shot("BROLL", first, broll, fallback=_declared("STAT_CARD", stat(fact))), _shot("QUOTE_CARD", rest_or_all, quote)))
            .when(fact.isNotNull(), F.array(_shot("STAT_CARD", first, stat(fact)), _shot("QUOTE_CARD", rest_or_all, quote)))
            .otherwise(F.array(_shot("HEADLINE_CARD", told, head))))
        known = F.create_map(*(F.lit(x) for pair in rules.differentiators for x in pair)) if rules.differentiators else F.create_map().cast("map<string,string>")
        cited = F.filter(F.coalesce("fact_ids", X.strings([])), lambda f: F.array_contains(F.map_keys(known), f))
        diff = F.coalesce(F.try_element_at(known, F.try_element_at(cited, F.lit(-1))), F.lit(""))  # the last one cited
        cta = F.array(_shot("LOGO_CTA", told, _map(differentiator=diff, cta_line=F.lit(rules.cta_lines[0] if rules.cta_lines else ""), domain=F.lit(rules.domain))))
        shots = (F.when(F.col("beat") == "hook", hook).when(F.col("beat") == "stakes", stakes).when(F.col("beat") == "mechanism", mechanism)
                 .when(F.col("beat") == "proof", proof).when(F.col("beat") == "cta", cta).otherwise(F.array(_shot("HEADLINE_CARD", told, head))))
        return shots

    # columns of their own, so that the tree holds them by name and not by their whole expressions
    seg = seg.withColumn("_phrases", X.split_phrases("narration"))
    seg = seg.withColumn("_packed", X.pack_phrases("_phrases"))
    seg = seg.withColumn("_spans", F.when(F.size("_packed") > 0, F.col("_packed")).otherwise(F.array("narration")))
    seg = seg.withColumn("_shots", tree(F.col("_spans")))
    per = F.greatest(X.estimate_s("narration"), F.lit(K.SHOT_MIN_S)) / F.size("_shots")
    cap = F.when(F.col("beat") == "cta", K.END_CARD_MAX_S).otherwise(K.SHOT_MAX_S)
    seg = seg.withColumn("duration_s", F.bround(F.least(F.greatest(per, F.lit(K.SHOT_MIN_S)), cap), 2))
    # outer: before an inner explode Spark puts a filter that computes the whole tree again, twice (no segment is without shots)
    out = seg.select("run_id", "pos", "beat", "duration_s", F.posexplode_outer("_shots").alias("sub", "_s")).where("_s IS NOT NULL")
    return out.select("run_id", "pos", F.col("sub").cast("bigint").alias("sub"), "beat", "duration_s", "_s.*")


def number_segments(shots: DataFrame, run: str = "run_id", order=("pos", "sub")) -> DataFrame:
    """Global ordinal in the run, as ``ord`` and as an id like s00.

    Only rows per segment are counted along the run; inside a segment the
    ordinal follows from ``sub``, which is dense from 0.
    """
    pos, sub = order
    sizes = shots.groupBy(run, pos).agg(F.count("*").alias("_k"))
    offsets = scan(sizes, [run], [pos], sums={"_off": F.col("_k")}).select(run, pos, "_off")
    out = shots.join(large(offsets), [run, pos]).withColumn("ord", F.col("_off") + F.col(sub))
    two = F.when(F.col("ord") < 10, F.concat(F.lit("0"), F.col("ord").cast("string"))).otherwise(F.col("ord").cast("string"))
    return out.withColumn("id", F.concat(F.lit("s"), two)).drop("_off")


def lint_segments(shots: DataFrame, facts: DataFrame) -> DataFrame:
    """(run_id, id, rule): every defect of a planned shot list. ``shots`` is read twice; cut its lineage if it is costly."""
    cap = F.when(F.col("type") == "LOGO_CTA", K.END_CARD_MAX_S).otherwise(K.SHOT_MAX_S)
    d = F.col("duration_s")
    n_labels = F.size(F.coalesce("labels", X.strings([])))
    local = F.array(
        F.when(~F.col("type").isin(*K.SHOT_TYPES), "unknown shot type"),
        F.when((d < K.SHOT_MIN_S) | (d > cap), "duration out of range"),
        F.when(F.col("type").isin("PAPER_CARD", "BROLL") & F.col("fallback").isNull(), "missing fallback"),
        F.when((F.col("type") == "DIAGRAM") & (F.col("payload")["template"] == "flow") & ~n_labels.between(2, 4), "flow label count"))
    is_stat = F.col("type") == "STAT_CARD"
    looked = shots.withColumn("_fid", F.when(is_stat, F.col("payload")["fact_id"])).join(large(
        facts.select("run_id", F.col("id").alias("_fid"), "quote")), ["run_id", "_fid"], "left")
    loose = F.when(is_stat, X.let(F.coalesce(X.numeric_tokens("quote"), X.strings([])), lambda q: F.filter(X.numeric_tokens(F.col("payload")["value"]), lambda t: ~F.array_contains(q, t)))).otherwise(X.strings([]))
    rules = F.concat(F.filter(local, lambda x: x.isNotNull()), F.transform(loose, lambda t: F.concat(F.lit("untraced value "), t)))
    total = shots.groupBy("run_id").agg(F.sum("duration_s").alias("_t")).where(
        (F.col("_t") < K.TOTAL_MIN_S - K.LINT_EPSILON_S) | (F.col("_t") > K.TOTAL_MAX_S + K.LINT_EPSILON_S))
    return looked.select("run_id", "id", F.explode(rules).alias("rule")).unionByName(
        total.select("run_id", F.lit(None).cast("string").alias("id"), F.lit("total duration").alias("rule")))


# ── timing ─────────────────────────────────────────────────────────────────
def voice_starts(parts: DataFrame, gap: float = K.BEAT_GAP_S) -> DataFrame:
    """``start_s``: durations before a part plus one gap each."""
    return scan(parts, ["run_id"], ["pos"], sums={"start_s": F.col("duration_s") + F.lit(gap)})


def timeline(shots: DataFrame, order=("ord",)) -> DataFrame:
    """Rounded start and middle of each shot."""
    out = scan(shots, ["run_id"], list(order), sums={"_at": F.col("duration_s")})
    return out.withColumn("mid_s", F.bround(F.col("_at") + F.col("duration_s") / 2, 3)).withColumn(
        "start_s", F.bround("_at", 3)).drop("_at")


def beat_spans(beats: DataFrame, totals: DataFrame, hold: float = K.END_HOLD_S) -> DataFrame:
    """``span_s``: time to the next beat; the last one runs to the voice total plus the end hold."""
    out = scan(beats, ["run_id"], ["pos"], following={"_next": F.col("start_s")}).join(large(totals), "run_id")
    return out.withColumn("span_s", F.coalesce("_next", F.col("voice_total_s") + F.lit(hold)) - F.col("start_s")).drop("_next")


def reflow(shots: DataFrame, spans: DataFrame) -> DataFrame:
    """Fit the shots of each beat into its measured span; the last shot takes the remainder.

    Adds ``new_s``, ``delta_s`` and ``error``. One join and no shuffle besides it.
    """
    # a beat has the few shots of its segment: everything happens where the join has put them
    beat = Window.partitionBy("run_id", "beat")
    s = spans.select("run_id", "beat", "span_s")
    rows = s.join(large(shots), ["run_id", "beat"], "left").withColumns({"_planned": F.sum("duration_s").over(beat), "_is_last": F.col("ord") == F.max("ord").over(beat)})
    scale = F.col("span_s") / F.when(F.col("_planned") == 0, 1.0).otherwise(F.col("_planned"))
    cap = F.when(F.col("type") == "LOGO_CTA", K.END_CARD_MAX_S).otherwise(K.SHOT_MAX_S)
    scaled = F.least(F.greatest(F.col("duration_s") * scale, F.lit(K.SHOT_MIN_S)), cap)
    rows = rows.withColumn("_scaled", F.when(~F.col("_is_last"), scaled))
    used = F.coalesce(F.sum("_scaled").over(beat), F.lit(0.0))
    rows = rows.withColumn("new_s", F.when(F.col("_is_last"), F.col("span_s") - used).otherwise(F.col("_scaled")))
    return rows.select("run_id", "beat", "ord", "type", "duration_s", "new_s", F.bround(F.col("new_s") - F.col("duration_s"), 3).alias("delta_s"),
                       F.when(F.col("ord").isNull(), "no shots for beat").when(F.col("_is_last") & (F.col("new_s") < K.SHOT_MIN_S / 2), "audio and shots do not fit").alias("error"))


def render_flags(shots: DataFrame) -> DataFrame:
    """``rerender`` when a shot moved noticeably; ``fade_s`` at the start of each later beat."""
    out = scan(shots, ["run_id"], ["ord"], previous={"_before": F.col("beat")}, first={"_first": F.col("beat")})
    fades = ~F.col("beat").eqNullSafe(F.col("_before")) & (F.col("beat") != F.col("_first"))
    return out.withColumn("rerender", F.abs("delta_s") > K.RERENDER_EPSILON_S).withColumn(
        "fade_s", F.when(fades, K.FADE_S).otherwise(0.0)).drop("_before", "_first")


def redistribute(scenes: DataFrame, totals: DataFrame, cap: float = K.SCENE_CAP_S, tail: float = K.CTA_TAIL_S) -> DataFrame:
    """Scale scenes to the audio length, spread what exceeds ``cap`` over the others, hold the last scene longer.

    A scene's length is a function of what it was and of a few sums of its run.
    So scenes are never rewritten: each of the three passes reads them beside
    the sums found so far and adds two more to that small table, which is cut.
    """
    rows = cut(scenes.withColumn("_d", F.coalesce("duration_s", F.lit(0.0))), "scenes")
    none = F.expr("cast(array() as array<struct<over:double,free:bigint>>)")
    runs = rows.groupBy("run_id").agg(F.sum("_d").alias("_sum"), F.count("*").alias("_n"), F.max("pos").alias("_last"))
    runs = cut(runs.join(large(totals.select("run_id", "audio_s")), "run_id").withColumn("_steps", none), "run-sums")
    first = F.when(F.col("_sum") <= 0.01, F.col("audio_s") / F.col("_n")).otherwise(F.col("_d") * (F.col("audio_s") / F.col("_sum")))
    moved = lambda d, s: F.when(s["over"] < 0.01, d).when(d < cap, d + s["over"] / s["free"]).otherwise(F.lit(cap))
    now = F.aggregate("_steps", first, moved)
    for _ in range(3):
        over = rows.join(large(runs), "run_id").select("run_id", now.alias("d")).groupBy("run_id").agg(
            F.struct(F.sum(F.greatest(F.lit(0.0), F.col("d") - cap)).alias("over"), F.count_if(F.col("d") < cap).alias("free")).alias("_step"))
        runs = cut(runs.join(large(over), "run_id").withColumn("_steps", F.array_append("_steps", F.col("_step"))).drop("_step"), "run-sums")
    d = now + F.when(F.col("pos") == F.col("_last"), tail).otherwise(0.0)
    return rows.join(large(runs), "run_id").select(*scenes.columns, F.when(d <= 0, 0.5).otherwise(d).alias("new_s"))


def transition_plan(clips: DataFrame) -> DataFrame:
    """Effect, its length and the offset of every clip after the first."""
    prev = scan(clips, ["run_id"], ["pos"], previous={"_before": F.col("beat"), "_has": F.lit(True)})
    a, b = F.col("_before"), F.col("beat")
    by_beat = (F.when(a == b, "cut").when((a == "hook") & (b == "stakes"), "slow_fade")
               .when((a == "proof") & b.isin("brand", "cta"), "dissolve_flash").otherwise("fade"))
    kind = F.when(F.coalesce("transition_in", F.lit("")) != "", F.col("transition_in")).otherwise(by_beat)
    effect = F.when(kind.isin("slide_left", "dissolve_flash"), "smoothleft").otherwise("fade")
    secs = (F.when(kind.isin("slide_left", "dissolve_flash"), 0.4).when(kind.isin("cut", "hard_cut"), 0.0).when(kind == "slow_fade", 0.5).otherwise(0.25))
    rows = prev.withColumn("effect", effect).withColumn("effect_s", secs)
    lost = F.when(F.col("_has").isNull(), 0.0).otherwise(F.when(F.col("effect_s") > 0, F.col("effect_s")).otherwise(F.lit(2 / 30)))
    rows = scan(rows, ["run_id"], ["pos"], sums={"_at": F.col("clip_s") - lost})
    return rows.where("_has").withColumn("offset_s", F.col("_at") - F.when(F.col("effect_s") > 0, F.col("effect_s")).otherwise(F.lit(2 / 30))).drop("_at", "_has", "_before")


def overlap_flag(segments: DataFrame, share: float = 0.7) -> DataFrame:
    """Flag a segment most of whose words the previous one already had."""
    seg = segments.select("run_id", "pos", F.array_distinct(X.words(F.lower("narration"))).alias("_w"))
    out = scan(seg, ["run_id"], ["pos"], previous={"_before": F.col("_w")})
    both = F.size(F.array_intersect("_w", "_before")) / F.size("_w")
    return out.select("run_id", "pos", F.coalesce((F.size("_before") > 0) & (F.size("_w") > 0) & (both > share), F.lit(False)).alias("narration_duplicate"))


def align_to_template(scenes: DataFrame, template: Sequence[str], run: str = "run_id") -> DataFrame:
    """Each run gets exactly the template's rows: padded with blanks or cut, in template order."""
    runs = scenes.select(run).distinct()
    slots = runs.select(
        run, F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("pos"), F.lit(b).alias("beat")) for i, b in enumerate(template)])).alias("_t")).select(run, "_t.*")
    out = slots.join(large(scenes.drop("beat")), [run, "pos"], "left")
    return out.select(run, "pos", "beat", *[F.coalesce(c, F.lit("")).alias(c) for c in scenes.columns if c not in (run, "pos", "beat")],
                      F.when(F.col("pos") == 0, "cut").otherwise("fade").alias("transition_in"))


# ── cues ───────────────────────────────────────────────────────────────────
#: Words of a block, and blocks of a stretch.
CUE_BLOCK = 1024


def group_cues(words: DataFrame, doc: str = "doc", max_words: int = 3, max_s: float = 1.5) -> DataFrame:
    """Consecutive words as cues of at most ``max_words`` words and ``max_s`` seconds: (doc, idx, start_s, end_s, text).

    ``words`` is (doc, idx, word, start_s, end_s) with idx dense from 0. Where a
    cue begins depends on the one before it, but a cue spans so few words that a
    block of words is a small map from entry offset to exit offset, found by one
    fold from the block's end. Maps of neighbouring blocks compose to maps of
    stretches, those chain per document (a row for a million words), and entries
    go back down to the blocks, which then emit the cues that begin in them.
    """
    row = F.struct(F.col("idx").cast("bigint").alias("idx"), "word", "start_s", "end_s")
    blocks = words.withColumn("_b", F.floor(F.col("idx") / CUE_BLOCK)).groupBy(doc, "_b").agg(F.array_sort(F.collect_list(row)).alias("_w"))
    following = blocks.select(doc, (F.col("_b") - 1).alias("_b"), F.slice("_w", 1, max_words - 1).alias("_next"))
    blocks = blocks.join(large(following), [doc, "_b"], "left")
    blocks = blocks.withColumn("_n", F.size("_w")).withColumn("_ext", F.concat("_w", F.coalesce("_next", F.expr("slice(_w, 1, 0)")))).drop("_next")

    def jump(i):
        """Words in the cue that begins at position i (0-based) of the block."""
        begin = F.get("_ext", i)["start_s"]
        n = F.lit(1)
        fits = F.lit(True)
        for k in range(1, max_words):
            fits = fits & F.coalesce(F.get("_ext", i + k)["end_s"] - begin <= max_s, F.lit(False))
            n = n + F.when(fits, 1).otherwise(0)
        return n

    blocks = blocks.withColumn("_j", F.transform("_w", lambda w, i: jump(i))).drop("_w")
    # from the last word on: where a walk from here leaves the block, as words into the next; only the last few matter
    ahead = F.array(*[F.lit(k) for k in range(max_words)])  # a walk that has already left
    leave = F.aggregate(F.reverse("_j"), ahead, lambda a, j: F.slice(F.concat(F.array(F.get(a, j - 1)), a), 1, max_words))
    maps = blocks.select(doc, "_b", leave.alias("_map"))
    entries = _entries(maps, doc, max_words)

    walk = X.marked("_j", F.col("_entry"), lambda at, j, i: (i == at, F.when(i == at, i + j).otherwise(at)))
    solved = blocks.join(large(entries), [doc, "_b"]).withColumn("_at", walk)
    cues = F.transform("_at", lambda i: F.struct(
        F.get("_ext", i)["idx"].alias("idx"), F.get("_ext", i)["start_s"].alias("start_s"),
        F.get("_ext", i + F.get("_j", i) - 1)["end_s"].alias("end_s"),
        F.array_join(F.transform(F.slice("_ext", i + 1, F.get("_j", i)), lambda w: F.upper(X.strip(w["word"]))), " ").alias("text")))
    return solved.select(doc, F.inline(cues))


def _entries(maps: DataFrame, doc: str, width: int, stretch: int = CUE_BLOCK) -> DataFrame:
    """(doc, _b, _entry): where each block is entered, from (doc, _b, _map) and an entry at 0 into the first."""
    def along(steps, entry):
        """Entries of consecutive maps, and the last exit behind them."""
        return F.aggregate(steps, F.array(entry), lambda a, m: F.array_append(a, F.get(m["_map"], F.element_at(a, -1))))

    laid = maps.withColumn("_s", F.floor(F.col("_b") / stretch)).groupBy(doc, "_s").agg(F.array_sort(F.collect_list(F.struct("_b", "_map"))).alias("_steps"))
    through = laid.select(doc, "_s", F.array(*[F.aggregate("_steps", F.lit(e), lambda a, m: F.get(m["_map"], a)) for e in range(width)]).alias("_map"))
    tops = through.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("_s", "_map"))).alias("_top"))
    tops = tops.select(doc, F.posexplode(F.slice(along(F.col("_top"), F.lit(0)), F.lit(1), F.size("_top"))).alias("_s", "_in"))
    inner = laid.join(large(tops.select(doc, F.col("_s").cast("bigint").alias("_s"), "_in")), [doc, "_s"])
    inner = inner.select(doc, F.explode(F.arrays_zip(F.transform("_steps", lambda m: m["_b"]).alias("b"), F.slice(along(F.col("_steps"), F.col("_in")), F.lit(1), F.size("_steps")).alias("e"))).alias("z"))
    return inner.select(doc, F.col("z.b").alias("_b"), F.col("z.e").alias("_entry"))
