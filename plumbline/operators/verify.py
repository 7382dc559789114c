"""Metric gates, grading, routing, fixes and reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import constants as K
from plumbline.functions import text as X
from plumbline.session import cut, large


# ── metric gates ───────────────────────────────────────────────────────────
def audio_metrics_gate(parts: DataFrame) -> DataFrame:
    """(run_id, pos, defect): tiny voice files, and totals far from the estimate."""
    tiny = parts.where(F.col("bytes") < K.MIN_SEGMENT_BYTES).select("run_id", "pos", F.lit("voice file too small").alias("defect"))
    t = parts.groupBy("run_id").agg(F.sum("words").alias("w"), F.sum("duration_s").alias("d"), F.count("*").alias("n"))
    est, actual = F.col("w") / F.lit(K.WORDS_PER_SECOND), F.col("d") + (F.col("n") - 1) * K.BEAT_GAP_S
    off = t.where((est > 0) & (F.abs(actual - est) / est > K.AUDIO_TOLERANCE))
    return tiny.unionByName(off.select("run_id", F.lit(None).cast(parts.schema["pos"].dataType).alias("pos"), F.lit("voice length off the estimate").alias("defect")))


def duration_law(video, voice) -> Column:
    """NULL if video = voice + hold within tolerance, else the broken law."""
    v, s = X._col(video), X._col(voice)
    return F.when(v < s + K.AUDIO_MARGIN_S, "clipped").when(F.abs(v - (s + K.END_HOLD_S)) > K.DURATION_LAW_S, "off_law")


def muxed_covers_voice(video, voice, slack: float = 0.25) -> Column:
    return X._col(video) + slack >= X._col(voice)


def media_metrics_gate(metrics: DataFrame) -> DataFrame:
    """(run_id, defect, measured, bound) from (run_id, metric, value); without a video stream nothing further is checked.

    ``measured`` and ``bound`` are lists of numbers (a resolution has two), NULL where there is nothing to measure or
    to keep to. What was not measured does not pass: no size is a defect, no resolution is a mismatch, no level a failed analysis.
    """
    m = lambda n: F.max(F.when(F.col("metric") == n, F.col("value")))
    names = ["duration_s", "filesize_mb", "has_video", "has_audio", "width", "height", "audio_rms", "audio_peak"]
    w = metrics.groupBy("run_id").agg(*[m(n).alias(n) for n in names])
    video, audio = F.coalesce(F.col("has_video") > 0, F.lit(False)), F.coalesce(F.col("has_audio") > 0, F.lit(False))
    d = F.coalesce("duration_s", F.lit(0.0))
    none = F.lit(None).cast("array<double>")
    numbers = lambda v: none if v is None else F.array(*[(x if isinstance(x, Column) else F.lit(float(x))).cast("double") for x in v])
    hit = lambda text, measured=None, bound=None: F.struct(F.lit(text).alias("defect"), numbers(measured).alias("measured"), numbers(bound).alias("bound"))
    size, rms, peak, shape = F.col("filesize_mb"), F.col("audio_rms"), F.col("audio_peak"), [F.col("width"), F.col("height")]
    hits = F.array(
        F.when(d < K.VIDEO_MIN_S, hit("Duration too short", [d], [K.VIDEO_MIN_S])).when(d > K.VIDEO_MAX_S, hit("Duration too long", [d], [K.VIDEO_MAX_S])),
        F.when(size.isNull(), hit("Filesize unknown", None, [K.VIDEO_MAX_MB])).when(size > K.VIDEO_MAX_MB, hit("Filesize exceeds limit", [size], [K.VIDEO_MAX_MB])),
        F.when(~video, hit("No video stream found")),
        F.when(video & ~audio, hit("No audio stream found")),
        F.when(video & ~F.coalesce((shape[0] == K.FRAME_W) & (shape[1] == K.FRAME_H), F.lit(False)), hit("Resolution mismatch", shape, [K.FRAME_W, K.FRAME_H])),
        F.when(video & audio & (rms.isNull() | peak.isNull()), hit("Audio analysis failed")),
        F.when(video & audio & (rms < K.AUDIO_RMS_FLOOR), hit("Audio RMS too low", [rms], [K.AUDIO_RMS_FLOOR])),
        F.when(video & audio & (peak > K.AUDIO_PEAK_CEIL), hit("Audio peak too high", [peak], [K.AUDIO_PEAK_CEIL])))
    return w.select("run_id", F.inline(F.filter(hits, lambda h: h.isNotNull())))


def persistent_dark_band(frames: DataFrame) -> DataFrame:
    """(run_id, dark, sampled, defect): a band is a defect only if every sampled frame is dark; unreadable frames count as sampled."""
    return frames.groupBy("run_id").agg(F.count_if(F.col("luma") < K.DARK_LUMA).alias("dark"), F.count("*").alias("sampled")).withColumn(
        "defect", (F.col("dark") > 0) & (F.col("dark") == F.col("sampled")))


def safe_zone_frames(boxes: DataFrame, width: int = K.FRAME_W, height: int = K.FRAME_H) -> DataFrame:
    """(run_id, frame) with confident text outside the margins, each frame once."""
    mw, mh = int(width * K.SAFE_MARGIN), int(height * K.SAFE_MARGIN)
    x, y, x2, y2 = F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h")
    out = (x < mw) | (y < mh) | (x2 > width - mw) | (y2 > height - mh)
    return boxes.where((F.col("conf") >= K.OCR_MIN_CONF) & out).select("run_id", "frame").distinct()


def fits_safe_rect(x, y, w, h) -> Column:
    x0, y0, x1, y1 = K.SAFE_RECT
    return (X._col(x) >= x0) & (X._col(y) >= y0) & (X._col(x) + X._col(w) <= x1) & (X._col(y) + X._col(h) <= y1)


def content_gate(bright_pixels) -> Column:
    return X._col(bright_pixels) >= K.MIN_CONTENT_PIXELS


def watermark_reason(ocr_text) -> Column:
    """Why a picture counts as watermarked, NULL if it does not."""
    t = X.strip(ocr_text)
    hit = F.lower(F.regexp_extract(t, "(?iU)" + K.WATERMARK_BLOCKLIST, 1))
    return (F.when(hit != "", F.concat(F.lit("blocklist_match:"), hit))
            .when(F.length(t) >= K.WATERMARK_MIN_CHARS, F.concat(F.lit("text_density:"), F.length(t).cast("string"), F.lit("chars"))))


def sample_positions(n) -> Column:
    """Evenly spread frame numbers, at most a handful."""
    n, k = X._col(n).cast("int"), K.FRAME_SAMPLES
    few = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.when(n <= k, few).otherwise(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (n / F.lit(k))).cast("int")))


# ── grades ─────────────────────────────────────────────────────────────────
def grade_overall(grades: DataFrame, rubric: Sequence[str] = K.RUBRIC_KEYS) -> DataFrame:
    """(run_id, scene, overall): mean over the rubric, missing criteria count as 0."""
    inside = F.when(F.col("criterion").isin(*rubric), F.col("score")).otherwise(0.0)
    return grades.groupBy("run_id", "scene").agg(F.bround(F.sum(inside) / len(rubric), 2).alias("overall"))


def decision_band(runs: DataFrame, scenes: DataFrame) -> DataFrame:
    """(run_id, decision): pass, fail (actionable) or hold. ``scenes``: run_id, overall, ungradeable."""
    s = scenes.groupBy("run_id").agg(F.bool_or("ungradeable").alias("u"), F.min("overall").alias("lowest"))
    d = (F.when(F.col("lowest").isNull() | F.col("u"), "hold").when(F.col("lowest") >= K.GRADE_PASS_MIN, "pass")
         .when(F.col("lowest") < K.GRADE_FAIL_BELOW, "fail").otherwise("hold"))
    return runs.join(large(s), "run_id", "left").select("run_id", d.alias("decision"))


def route_defects(defects: DataFrame) -> DataFrame:
    """(run_id, action, scene): one re_source per scene, one re_render per run; unknown codes do nothing."""
    known = defects.where(F.col("code").isin(*K.RE_SOURCE_CODES, *K.RE_RENDER_CODES))
    source = known.where(F.col("code").isin(*K.RE_SOURCE_CODES)).select("run_id", F.lit("re_source").alias("action"), "scene").distinct()
    render = known.select("run_id").distinct().select("run_id", F.lit("re_render").alias("action"),
                                                      F.lit(None).cast(defects.schema["scene"].dataType).alias("scene"))
    return source.unionByName(render)


def classify_failures(defects: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(run_id, id, kind). ``defects``: run_id, defect. ``verdicts``: run_id, id, rendered_type, resolved, match_score, legible, ungradeable."""
    low = F.lower("defect")
    g = defects.groupBy("run_id").agg(F.bool_or(low.contains("audio")).alias("a"), F.bool_or(low.contains("dark ribbon")).alias("r"))
    run_kind = F.when(F.col("a"), "heuristic_audio").when(F.col("r"), "heuristic_dark_ribbon").otherwise("heuristic_safezone")
    top = g.select("run_id", F.lit("_global").alias("id"), run_kind.alias("kind"))
    shown = (F.col("rendered_type") == "BROLL") & (F.col("resolved") == "acquired")
    u = F.coalesce("ungradeable", F.lit(False)) | F.col("legible").isNull() | F.coalesce(shown & F.col("match_score").isNull(), F.lit(False))  # not judged is not passed
    kinds = F.array(F.when(u, "error_ungradeable"),
                    F.when(~u & shown & (F.col("match_score") < 5), "broll_mismatch"),
                    F.when(~u & ~F.col("legible"), "legibility"))
    return top.unionByName(verdicts.select("run_id", "id", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("kind")))


def apply_fixes(shots: DataFrame, failures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shots, log). A mismatch swaps in the declared fallback; illegible text is shortened, or reported as unfixable.

    ``shots``: run_id, id, rendered_type, payload map, labels array, fallback struct<type,payload>.
    """
    f = failures.groupBy("run_id", "id").agg(F.bool_or(F.col("kind") == "broll_mismatch").alias("_m"), F.bool_or(F.col("kind") == "legibility").alias("_l"))
    s = shots.join(large(f), ["run_id", "id"], "left").fillna(False, ["_m", "_l"])
    swap = F.col("_m") & F.col("fallback").isNotNull()
    s = s.withColumn("_swap", swap).withColumn("rendered_type", F.when(swap, F.col("fallback")["type"]).otherwise(F.col("rendered_type"))).withColumn(
        "payload", F.when(swap, F.col("fallback")["payload"]).otherwise(F.col("payload"))).withColumn(
        "labels", F.when(swap, None).otherwise(F.col("labels")))
    filled = F.filter(X.strings(K.SHRINK_FIELDS), lambda k: F.size(X.words(F.coalesce(F.try_element_at("payload", k), F.lit("")))) > 0)
    s = s.withColumn("_field", F.when(F.col("_l"), F.get(filled, F.lit(0))))
    text = F.try_element_at("payload", F.col("_field"))
    keep = F.greatest(F.lit(3), F.floor(X.word_count(text) * K.SHRINK_FACTOR).cast("int"))
    short = F.map_concat(F.map_filter("payload", lambda k, v: k != F.col("_field")), F.create_map(F.col("_field"), X.first_words(text, keep)))
    by_label = F.col("_l") & F.col("_field").isNull() & (F.size(F.coalesce("labels", X.strings([]))) > 0)
    n_label = max(1, int(3 * K.SHRINK_FACTOR))
    s = s.withColumn("_by_label", by_label).withColumn("payload", F.when(F.col("_field").isNotNull(), short).otherwise(F.col("payload"))).withColumn(
        "labels", F.when(F.col("_by_label"), F.transform("labels", lambda x: X.first_words(x, n_label))).otherwise(F.col("labels")))
    logs = F.array(
        F.when(F.col("_swap"), F.concat(F.lit("swapped to fallback "), F.col("fallback")["type"])).when(F.col("_m"), "no fallback declared"),
        F.when(F.col("_l") & F.col("_field").isNotNull(), F.concat(F.lit("shortened "), "_field", F.lit(" for legibility"))),
        F.when(F.col("_by_label"), "shortened labels for legibility"),
        F.when(F.col("_l") & F.col("_field").isNull() & ~F.col("_by_label"), "no deterministic legibility fix available"))
    log = s.select("run_id", "id", F.explode(F.filter(logs, lambda x: x.isNotNull())).alias("fix"))
    run_fix = (F.when(F.col("kind") == "heuristic_safezone", "caption margin bumped +40px").when(F.col("kind") == "heuristic_dark_ribbon", "dark-ribbon accent band added")
               .when(F.col("kind") == "heuristic_audio", "audio stage re-run"))
    log = log.unionByName(failures.where("id = '_global'").select("run_id", "id", run_fix.alias("fix")).where("fix IS NOT NULL"))
    return s.select(*shots.columns), log


def revise_loop(shots: DataFrame, gate: Callable[[DataFrame], DataFrame], max_cycles: int = K.MAX_REVISE_CYCLES) -> tuple[DataFrame, DataFrame, int]:
    """(shots, remaining failures, cycles): gate, fix, gate again; what is left after the last cycle has failed.

    A bounded driver loop over whole tables; each pass ends in files, so lineage
    stays short and a lost executor costs one pass at most.
    """
    for cycle in range(1, max_cycles + 2):
        failures = cut(gate(shots), "failures")
        if cycle > max_cycles or failures.isEmpty():
            return shots, failures, cycle
        shots = cut(apply_fixes(shots, failures)[0], "shots")
    raise AssertionError("unreachable")


def critic_override(scenes: DataFrame, least: int = K.SELECT_MIN) -> DataFrame:
    """A judged score under the minimum adds visual_mismatch and caps the alignment at 4."""
    low = F.coalesce((F.col("verdict") >= 0) & (F.col("verdict") < least), F.lit(False))
    return scenes.withColumn("flags", F.when(low, F.array_union("flags", X.strings(["visual_mismatch"]))).otherwise(F.col("flags"))).withColumn(
        "alignment", F.when(low, F.least("alignment", F.lit(4))).otherwise(F.col("alignment")))


def revise_request(scenes: DataFrame) -> DataFrame:
    """(…, re_source, fields) for scenes with an alignment under 7."""
    has = lambda *f: F.arrays_overlap("flags", X.strings(list(f)))
    fields = F.array(F.when(has("text_duplicates_voice", "text_unrelated"), "on_screen_text"),
                     F.when(has("weak_transition") | (F.col("alignment") < 4), "narration"),
                     F.when(has("voice_visual_mismatch", "off_hero_claim"), "visual_concept"))
    fields = F.filter(fields, lambda f: f.isNotNull())
    return scenes.where(F.col("alignment") < 7).withColumn("re_source", has("voice_visual_mismatch", "off_hero_claim", "visual_mismatch", "degraded_visual")).withColumn(
        "fields", F.when(F.size(fields) > 0, fields).otherwise(X.strings(["on_screen_text"])))


def expected_text(payload: str = "payload", labels: str = "labels") -> Column:
    """Every text a rendered shot should show, joined by ' | '."""
    flat = [F.nullif(F.try_element_at(F.col(payload), F.lit(k)), F.lit("")) for k in K.EXPECTED_FIELDS]
    return F.concat_ws(" | ", *flat, F.filter(F.coalesce(F.col(labels), X.strings([])), lambda x: x != ""))


# ── reports ────────────────────────────────────────────────────────────────
def quality_report(scenes: DataFrame, assets: DataFrame, flags: DataFrame) -> DataFrame:
    """One row per scene with its asset, how it was come by and seen, all its critic flags (sorted), and the totals of its run.

    ``scenes``: run_id, scene, duration_s, re_sourced (whether a first asset was thrown out). ``assets``: run_id, scene,
    source, score, width, height, vision_score (NULL: nobody looked at it).
    """
    f = flags.groupBy("run_id", "scene").agg(F.count("*").alias("n_flags"), F.array_join(F.array_sort(F.collect_list("flag")), ",").alias("flags"))
    t = scenes.groupBy("run_id").agg(F.count("*").alias("run_scenes"), F.round(F.sum("duration_s"), 2).alias("run_duration_s"), F.count_if(F.col("re_sourced")).alias("run_re_sourced"))
    out = scenes.join(large(assets), ["run_id", "scene"], "left").join(large(f), ["run_id", "scene"], "left").join(large(t), "run_id")
    return out.select("run_id", "scene", F.round("duration_s", 2).alias("duration_s"), "source", "score", F.coalesce("width", F.lit(0)).alias("width"), F.coalesce("height", F.lit(0)).alias("height"),
                      "vision_score", F.coalesce("re_sourced", F.lit(False)).alias("re_sourced"), F.coalesce("n_flags", F.lit(0)).alias("n_flags"), "flags", "run_scenes", "run_duration_s", "run_re_sourced",
                      F.col("source").isNull().alias("degraded"), F.coalesce(F.col("source") == "own_footage", F.lit(False)).alias("is_own_footage"))


def review_sheet(shots: DataFrame, verdicts: DataFrame, scripts: DataFrame, facts: DataFrame) -> DataFrame:
    """Per shot: what was shown, how it was resolved and why, how it was judged, its issues, what was said, and the facts cited.

    ``issues`` names what a reviewer must look at; a shot without a verdict has the issue of being unjudged.
    """
    v = verdicts.select("run_id", "id", "match_score", "legible", F.lit(True).alias("_judged"))
    cited = scripts.select("run_id", "pos", F.posexplode("fact_ids").alias("_i", "id")).join(large(facts.select("run_id", "id", "quote")), ["run_id", "id"])
    cited = cited.groupBy("run_id", "pos").agg(F.array_sort(F.collect_list(F.struct("_i", F.concat("id", F.lit(": "), "quote").alias("t")))).alias("_f"))
    s = scripts.select("run_id", "pos", "narration", "card_text").join(large(cited), ["run_id", "pos"], "left")
    out = shots.join(large(v), ["run_id", "id"], "left").join(large(s), ["run_id", "pos"], "left")
    issues = F.array_compact(F.array(F.when(F.col("_judged").isNull() | F.col("legible").isNull(), "not judged"), F.when(~F.col("legible"), "not legible"), F.when(F.col("match_score") < 5, "weak match")))
    return out.withColumn("issues", F.array_join(issues, "; ")).withColumn("facts", F.array_join(F.transform(F.coalesce("_f", F.expr("cast(array() as array<struct<_i:int,t:string>>)")), lambda f: f["t"]), " | ")).drop("_judged", "_f")


def _utc(created) -> Column:
    """Instant of an ISO text; naive texts are UTC whatever the session zone is."""
    c = X._col(created)
    zoned = F.rlike(c, F.lit(r"[T ].*(Z|[+-]\d{2}:?\d{2})$"))
    dated = F.rlike(c, F.lit(r"^\d{4}-\d{2}-\d{2}$"))
    return F.when(zoned, c).when(dated, F.concat(c, F.lit("T00:00:00Z"))).when(F.rlike(c, F.lit(r"^\d{4}-\d{2}-\d{2}[T ]\d")), F.concat(c, F.lit("Z"))).try_cast("timestamp")


def history_stats(history: DataFrame, now: str, days: int = 30) -> DataFrame:
    """(metric, key, n) of the last ``days`` before ``now``: total, per region, per platform published to.

    Naive times are UTC, unreadable ones are skipped. One pass, pre-aggregated
    per task.
    """
    recent = history.where(_utc("created_at") >= _utc(F.lit(now)) - F.expr(f"interval {int(days)} days"))
    ok = F.map_keys(F.map_filter(F.coalesce("publish_results", F.expr("cast(map() as map<string,struct<success:boolean>>)")), lambda k, v: F.coalesce(v["success"], F.lit(False))))
    row = lambda m, k: F.struct(F.lit(m).alias("metric"), k.alias("key"))
    rows = F.concat(F.array(row("count", F.lit("")), row("region", F.coalesce("region", F.lit("unknown")))), F.transform(ok, lambda p: row("platform", p)))
    return recent.select(F.inline(rows)).groupBy("metric", "key").agg(F.count("*").alias("n"))


def find_by_key(history: DataFrame, key: str, order: str) -> DataFrame:
    """First row per key; every task keeps one row per key before the shuffle."""
    rest = [c for c in history.columns if c != key]
    return history.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")
