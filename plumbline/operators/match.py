"""Matching segments with candidate assets: overlap, scores, gates, tiers, selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import constants as K
from plumbline.functions import links as L
from plumbline.functions import text as X
from plumbline.operators.ordered import running_smallest, scan
from plumbline.operators.overlap import best_partner, shared_counts
from plumbline.session import cut

TIERS = list(K.TIER_THRESHOLDS)


# ── overlap ────────────────────────────────────────────────────────────────
def overlap_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], tokens: tuple[str, str] = ("wish_tokens", "tokens"),
                   on: Sequence[str] = ()) -> DataFrame:
    """(keys…, overlap): shared tokens per pair, through an equi join on the token.

    ``right`` is spread by its own key first. When the other side is small
    enough for Spark to broadcast it, all tokens of one right row then meet in
    one task, so pairs are counted where they arise and are never shuffled.
    """
    lk = [k for k in keys if k in left.columns and k not in on]
    rk = [k for k in keys if k in right.columns and k not in on]
    a = left.select(*on, *lk, F.explode(F.array_distinct(tokens[0])).alias("_tok"))
    b = right.repartition(*on, *rk).select(*on, *rk, F.explode(F.array_distinct(tokens[1])).alias("_tok"))
    return b.join(a, [*on, "_tok"]).groupBy(*on, *lk, *rk).agg(F.count("*").alias("overlap"))


def top(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group; every task drops the rest before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def rank_all(df: DataFrame, by: Sequence[str], order: Sequence[str], rank: str = "rank") -> DataFrame:
    """Rank of every row per group, by ascending ``order``, also of groups or ties too large for one task.

    Rows are dealt by splitters that Spark samples from (group, order), so equal scores part where their keys do; a
    row's rank is its place in its task's stretch of the group plus the lengths of the stretches before. NULL is a group.
    """
    at = [*by, *order]
    rows = df.repartitionByRange(*at).sortWithinPartitions(*at).withColumns({"_at": F.monotonically_increasing_id(), "_key": F.struct(*by)})
    out = scan(cut(rows, "ranked"), ["_key"], ["_at"], sums={rank: F.lit(1)}, block=F.shiftright("_at", 33))
    return out.withColumn(rank, (F.col(rank) + 1).cast("bigint")).drop("_at", "_key")


def match_by_tokens(wishes: DataFrame, assets: DataFrame, wish_id: str = "wish_id", asset_id: str = "path",
                    least: int = 2, limit: int | None = None) -> DataFrame:
    """(wish, asset, overlap, rank): assets by shared words, ties by asset key; the first ``limit`` if given."""
    w = wishes.select(wish_id, X.tokens_ws("wish").alias("wish_tokens"))
    a = assets.select(asset_id, X.tokens_ws("description").alias("tokens"))
    pairs = shared_counts(w, a, wish_id, asset_id, ("wish_tokens", "tokens"), least)
    if limit is not None:
        return top(pairs, [wish_id], [F.desc("overlap"), F.asc(asset_id)], limit)
    return rank_all(pairs.withColumn("_o", -F.col("overlap")), [wish_id], ["_o", asset_id]).drop("_o")


def match_footage(scenes: DataFrame, footage: DataFrame, own_type: str = "own_edge", own_tags: Sequence[str] = ("factory",),
                  least: int = 2, common: int = 64) -> DataFrame:
    """(scene_id, id, score): the best clip per scene, lowest id on ties.

    5 for the scene's category, 2 for each shared tag, 1 for each shared word of the description, 3 for own clips in
    own scenes, 1 for broll in stock scenes. ``best_partner`` pairs only what can win.
    """
    kind = F.when(F.col("visual_type") == own_type, "own").when(F.col("visual_type") == "stock", "stock").otherwise("")
    sc = scenes.select("scene_id", F.lower("category").alias("category"), kind.alias("kind"), F.array_sort(X.tokens_alpha("text", K.STOP_FOOTAGE)).alias("tokens"))
    low = lambda c: F.array_distinct(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), F.lower))
    ft = footage.select("id", low("tags").alias("tags"), low("categories").alias("categories"), low("good_for").alias("good_for"),
                        X.tokens_alpha("description", K.STOP_FOOTAGE).alias("said"))
    weight = lambda t: F.array_contains("tags", t).cast("bigint") * 2 + F.array_contains("said", t).cast("bigint")
    items = ft.select("id", "categories", F.transform(F.array_union("tags", "said"), lambda t: F.struct(t.alias("token"), weight(t).alias("weight"))).alias("bag"),
                      F.struct((F.arrays_overlap("tags", X.strings(list(own_tags))) | F.array_contains("good_for", "establishing")).alias("own"),
                               F.array_contains("good_for", "broll").alias("broll")).alias("flags"))
    bonus = F.when((F.col("kind") == "own") & F.col("flags.own"), 3).when((F.col("kind") == "stock") & F.col("flags.broll"), 1).otherwise(0)
    most = F.when(F.col("kind") == "own", 3).when(F.col("kind") == "stock", 1).otherwise(0)
    best = best_partner(sc, items, 5, bonus, most, least, common)
    on = sc["category"].eqNullSafe(best["category"]) & (sc["kind"] == best["kind"]) & (sc["tokens"] == best["tokens"])
    return sc.join(best, on).select("scene_id", "id", F.col("score").cast("bigint").alias("score"))


def match_source(scenes: DataFrame, sources: DataFrame) -> DataFrame:
    """(run_id, scene_id, ord, score): the best source of the scene's own page, first one on ties.

    An authority scores 1 without any overlap; of those the first of the page is enough.
    """
    sc = scenes.select("run_id", "scene_id", X.tokens_alpha("text", K.STOP_SOURCE).alias("wish_tokens"))
    pairs = overlap_counts(sc, sources, ["scene_id", "ord"], on=["run_id"])
    pairs = pairs.join(sources.select("run_id", "ord", "is_authority"), ["run_id", "ord"])
    scored = pairs.select("run_id", "scene_id", "ord", (F.col("overlap") + F.when(F.col("is_authority"), 1).otherwise(0)).alias("score"))
    first = sources.where("is_authority").groupBy("run_id").agg(F.min("ord").alias("ord"))
    alone = sc.select("run_id", "scene_id").join(first, "run_id").select("run_id", "scene_id", "ord", F.lit(1).cast("bigint").alias("score"))
    best = scored.unionByName(alone).groupBy("run_id", "scene_id").agg(F.min(F.struct((-F.col("score")).alias("neg"), "ord")).alias("b"))
    return best.select("run_id", "scene_id", F.col("b")["ord"].alias("ord"), (-F.col("b")["neg"]).alias("score"))


# ── scores ─────────────────────────────────────────────────────────────────
def context_score(caption, narration, thread, hero) -> Column:
    """0-100: how well a caption fits the narration, its neighbours and the main claim; 0 is a hard reject.

    ``thread`` is an array of keyword strings.
    """
    cap, nar, hero = X._col(caption), X._col(narration), F.coalesce(X._col(hero), F.lit(""))
    thread_text = F.array_join(F.coalesce(X._col(thread), X.strings([])), " ")
    blank = cap.isNull() | (cap == "") | nar.isNull() | (nar == "")
    anchors = X.strings(K.DOMAIN_ANCHORS)

    def score(t):
        c, n, th, h = t["c"], t["n"], t["t"], t["h"]
        base = F.least(F.lit(50), F.size(F.array_intersect(n, c)) * 12)
        plus = (F.when(F.arrays_overlap(c, anchors), 20).otherwise(0)
                + F.when(F.arrays_overlap(F.array_intersect(n, c), anchors), 30).otherwise(0)
                + F.when(F.arrays_overlap(c, th), 15).otherwise(0) + F.when(F.arrays_overlap(c, h), 10).otherwise(0))
        return F.when((F.size(c) == 0) | (F.size(n) == 0), 10).otherwise(F.least(F.lit(100), base + plus))

    toks = F.struct(X.tokens_alpha(cap).alias("c"), X.tokens_alpha(nar).alias("n"), X.tokens_alpha(thread_text).alias("t"), X.tokens_alpha(hero).alias("h"))
    return F.when(blank | X.junk_caption(cap), 0).otherwise(X.let(toks, score))


def authority_weight(source) -> Column:
    out = F.lit(0)
    for name, weight in K.AUTHORITY_WEIGHT.items():
        out = F.when(X._col(source) == name, weight).otherwise(out)
    return out


def quality_score(query, source="source", caption="caption", width="width", height="height", file_size="file_size",
                  is_clip="is_clip", views="views", duration="duration_s") -> Column:
    """Quality of a candidate for a query; -100 when it is too small."""
    w, h = F.coalesce(X._col(width), F.lit(0)), F.coalesce(X._col(height), F.lit(0))
    known, edge = (w > 0) & (h > 0), F.greatest(w, h)
    aspect = w / F.when(h > 0, h)
    shape = F.when(known, F.when(edge >= K.IDEAL_LONG_EDGE, 10).otherwise(0) - F.when(aspect.between(0.9, 1.1), 15).otherwise(0)
                   + F.when(aspect >= 1.6, 10).otherwise(0) + F.when(aspect <= 0.65, 8).otherwise(0)).otherwise(0)
    overlap = F.size(F.array_intersect(X.tokens_alpha(caption), X.tokens_alpha(query)))
    clip = X._col(is_clip) & (F.coalesce(X._col(views), F.lit(0)) > 10000) & (F.coalesce(X._col(duration), F.lit(0)) > 30)
    total = (30 + shape + F.least(F.lit(25), overlap * 8) + authority_weight(source)
             + F.when(F.coalesce(X._col(file_size), F.lit(0)) > 100000, 15).otherwise(0) + F.when(clip, 10).otherwise(0))
    return F.when(known & (edge < K.MIN_LONG_EDGE), -100).otherwise(total)


# ── gates and tiers ────────────────────────────────────────────────────────
def pre_gates(cands: DataFrame, keys: Sequence[str] = ("segment_id", "tier"), ord: str = "ord") -> DataFrame:
    """Candidates with ``reason``: blacklisted, duplicate (within a tier, by first sight) or low_resolution.

    First sight is a partial minimum per URL key, so a URL that fills a third of
    the table is reduced before it is shuffled; the join back is left to AQE's
    skew handling.
    """
    c = cands.withColumn("_bad", L.blacklisted("url")).withColumn("_key", F.sha2(F.lower(X.strip("url")), 256))
    first = c.where("NOT _bad").groupBy(*keys, "_key").agg(F.min(ord).alias("_first"))
    edge = F.greatest(F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0)))
    out = c.join(first, [*keys, "_key"], "left")
    reason = (F.when(F.col("_bad"), "blacklisted").when(F.col(ord) > F.col("_first"), "duplicate")
              .when(edge < K.MIN_LONG_EDGE, "low_resolution"))
    return out.withColumn("reason", reason).drop("_bad", "_key", "_first")


def acquire_ladder(segments: DataFrame, cands: DataFrame, bypass: bool = False, per_tier: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(choice, decisions) over the tiers own, blog, api, scrape.

    ``cands``: segment_id, tier, ord, url, gate_reason (a hard reject, never
    judged), reject_reason and score of the judge. The first accepted row ends
    the search of its segment; with ``per_tier``, a tier ends after so many
    judged rows.
    """
    wish = F.coalesce(X.strip("wish"), F.lit(""))
    if bypass:
        choice = segments.select("segment_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("tier"),
                                 F.lit(None).cast("bigint").alias("score"), F.lit("torture_mode").alias("reason"))
        return choice, cands.where("false").select("segment_id", "tier", "ord", "url", F.lit("").alias("reason"))
    live = segments.where(wish != "").select("segment_id")
    tier_no = F.array_position(X.strings(TIERS), F.col("tier")).cast("int")
    need = F.create_map(*[F.lit(x) for kv in K.TIER_THRESHOLDS.items() for x in kv])
    c = cands.join(live, "segment_id", "left_semi").withColumn("_t", tier_no)
    seen = c
    if per_tier is not None:
        judged = c.where("gate_reason IS NULL")
        last = top(judged, ["segment_id", "_t"], [F.asc("ord")], per_tier, "_r").groupBy("segment_id", "_t").agg(
            F.count("*").alias("_n"), F.max("ord").alias("_cut")).where(F.col("_n") == per_tier).drop("_n")
        seen = c.join(last, ["segment_id", "_t"], "left").where(F.col("_cut").isNull() | (F.col("ord") <= F.col("_cut")))
    ok = F.col("gate_reason").isNull() & F.col("reject_reason").isNull() & (F.col("score") >= need[F.col("tier")])
    seen = seen.withColumn("accepted", F.coalesce(ok, F.lit(False)))
    won = seen.where("accepted").groupBy("segment_id").agg(F.min_by(F.struct("_t", "ord", "tier", "url", "score"), F.struct("_t", "ord")).alias("_w"))
    looks = seen.join(won, "segment_id", "left").where(F.col("_w").isNull() | (F.struct("_t", "ord") <= F.struct(F.col("_w")["_t"].alias("_t"), F.col("_w")["ord"].alias("ord"))))
    why = F.when(~F.col("accepted"), F.coalesce("gate_reason", "reject_reason", F.concat(F.lit("score_"), F.col("score").cast("string"))))
    decisions = looks.select("segment_id", "tier", "ord", "url", "score", "accepted", why.alias("reason"))
    choice = segments.join(won, "segment_id", "left").select(
        "segment_id", F.col("_w")["url"].alias("url"), F.col("_w")["tier"].alias("tier"), F.col("_w")["score"].cast("bigint").alias("score"),
        F.when(wish == "", "no_wish").when(F.col("_w").isNull(), "no_acceptance").alias("reason"))
    return choice, decisions


def provenance_summary(decisions: DataFrame) -> DataFrame:
    """(segment_id, tier, reason, rows): what was seen per tier; reason NULL is the accepted row."""
    return decisions.groupBy("segment_id", "tier", "reason").agg(F.count("*").alias("rows"))


def round_robin(results: DataFrame, query: str = "query", provider: str = "provider", ord: str = "ord", limit: int | None = None) -> DataFrame:
    """Interleave providers by their own rank: ``position`` of every row of a query, or of the first ``limit`` rows."""
    if limit is None:
        return rank_all(rank_all(results, [query, provider], [ord], "_r"), [query], ["_r", provider], "position").drop("_r")
    per = top(results, [query, provider], [F.asc(ord)], limit, "_r")  # no more rows of a provider can matter
    return top(per, [query], [F.asc("_r"), F.asc(provider)], limit, "position").drop("_r")


def candidate_cascade(cands: DataFrame, scenes: DataFrame, scene: str = "scene_id") -> tuple[DataFrame, DataFrame]:
    """(kept, degraded): queries in order until one brings enough quality; then the context filter.

    ``cands``: scene, query_no, ord, quality (for its own query), quality_first (for the first query), context.
    ``kept`` has the survivors' ``position``: best context, then best quality for the first query, then order of
    arrival. ``degraded`` are the ``scenes`` without a survivor, those without any candidate among them.
    """
    enough = cands.groupBy(scene, "query_no").agg(F.count_if(F.col("quality") >= K.MIN_QUALITY).alias("_n"))
    stop = enough.where(F.col("_n") >= K.ENOUGH_QUALITY_ROWS).groupBy(scene).agg(F.min("query_no").alias("_stop"))
    asked = cands.join(stop, scene, "left").where(F.col("_stop").isNull() | (F.col("query_no") <= F.col("_stop"))).drop("_stop")
    kept = asked.where(F.col("context") >= K.MIN_CONTEXT)
    best = kept.withColumn("_c", -F.col("context")).withColumn("_q", -F.col("quality_first"))
    ranked = rank_all(best, [scene], ["_c", "_q", "query_no", "ord"], "position").drop("_c", "_q")
    degraded = scenes.select(scene).distinct().join(kept.select(scene), scene, "left_anti")
    return ranked, degraded


def rerank(ranked: DataFrame, scores: DataFrame, scene: str = "scene_id", rank: str = "rank", n_top: int = K.RERANK_TOP) -> DataFrame:
    """New ``position`` after model scores for the first rows; NULL scores table rows count as 0.

    ``scores``: scene, rank, score as text. A scene whose number of scores differs
    from its shortlist is malformed and stays as it was. If no row of the
    shortlist survives, the whole scene is empty.
    """
    ranked = cut(ranked, "rerank")  # read by every branch
    head = ranked.where(F.col(rank) <= n_top)
    sizes = head.groupBy(scene).agg(F.count("*").alias("_n"))
    given = scores.groupBy(scene).agg(F.count("*").alias("_g"))
    valid = sizes.join(given, scene, "left").select(scene, (F.col("_n") == F.coalesce("_g", F.lit(0))).alias("_valid"))
    model = F.greatest(F.lit(0), F.least(F.lit(10), F.coalesce(F.col("score").try_cast("int"), F.lit(0))))
    # cut, so that no task holds the sorts and sums of all steps at once
    graded = cut(head.join(scores, [scene, rank], "left").join(cut(valid, "rerank-valid"), scene).withColumn("_m", model), "rerank-graded")
    keep = graded.where("NOT _valid").withColumn("position", F.col(rank).cast("bigint"))
    # at most n_top rows per scene reach this window
    w = Window.partitionBy(scene).orderBy(F.desc("_m"), F.desc("context"), F.desc("quality"), F.asc(rank))
    moved = graded.where("_valid").where(F.col("_m") >= K.RERANK_MIN).withColumn("position", F.row_number().over(w).cast("bigint"))
    alive = cut(graded.groupBy(scene, "_valid").agg(F.count_if(F.col("_m") >= K.RERANK_MIN).alias("_k")), "rerank-alive")
    rest = ranked.where(F.col(rank) > n_top).join(alive, scene)
    rest = rest.where(~F.col("_valid") | (F.col("_k") > 0)).withColumn(
        "position", F.when(F.col("_valid"), F.col(rank) - n_top + F.col("_k")).otherwise(F.col(rank)).cast("bigint"))
    cols = [*ranked.columns, "position"]
    return keep.select(*cols).unionByName(moved.select(*cols)).unionByName(rest.select(*cols))


def select_best(shortlist: DataFrame, verdicts: DataFrame, exclude: DataFrame | None = None, scene: str = "scene_id",
                first: int | None = None, keep: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(choice, kept). Excluded, duplicate and unjudged rows out, best verdicts first; the best one chosen if good enough.

    ``shortlist``: scene, rank, url, quality, is_dup. ``verdicts``: scene, url, verdict (NULL: no judgement). Every row
    can be chosen and is kept with its ``place``, unless only the ``first`` ranks count, or ``keep`` places are wanted.
    """
    rows = shortlist.where(~F.col("is_dup"))
    if first is not None:
        rows = rows.where(F.col("rank") <= first)
    if exclude is not None:
        rows = rows.join(exclude, [scene, "url"], "left_anti")
    judged = rows.join(verdicts.where("verdict IS NOT NULL"), [scene, "url"]).withColumns({"_v": -F.col("verdict"), "_q": -F.col("quality")})
    by = ["_v", "_q", "rank"]
    kept = rank_all(judged, [scene], by, "place") if keep is None else top(judged, [scene], [F.asc(c) for c in by], keep, "place")
    good = judged.where(F.col("verdict") >= K.SELECT_MIN).groupBy(scene).agg(F.min_by("url", F.struct(*by)).alias("url"))
    choice = shortlist.select(scene).distinct().join(good, scene, "left").withColumn("degraded", F.col("url").isNull())
    return choice, kept.drop("_v", "_q")


def prefer_own(own: DataFrame, external: DataFrame, scene: str = "scene_id", least: int = K.OWN_PREFER_MIN) -> DataFrame:
    """Own asset if its best score (earliest on ties) reaches ``least``, else the external choice."""
    best = own.where("score IS NOT NULL").groupBy(scene).agg(F.max_by(F.struct("asset", "score"), F.struct("score", (-F.col("ord")).alias("o"))).alias("_b"))
    taken = best.where(F.col("_b")["score"] >= least).select(scene, F.col("_b")["asset"].alias("_own"))
    out = external.join(taken, scene, "full_outer")
    return out.select(scene, F.coalesce("_own", "asset").alias("asset"), F.col("_own").isNotNull().alias("is_own"))


def exclude_and_retry(current: DataFrame, candidates: DataFrame, used: DataFrame, order: Sequence[Column], segment: str = "segment_id") -> DataFrame:
    """Next best URL not used before, by ascending ``order``; the current one stays when nothing is left.

    One minimum per segment, so nothing is ranked.
    """
    first = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    fresh = candidates.join(used, [segment, "url"], "left_anti").groupBy(segment).agg(F.min_by("url", first).alias("_next"))
    return current.join(fresh, segment, "left").select(segment, F.coalesce("_next", "url").alias("url"), F.col("_next").isNotNull().alias("replaced"))


def cumulative_keywords(segments: DataFrame, k: int = 6) -> DataFrame:
    """(run_id, pos, keywords): the first ``k`` in sorted order of all tokens so far."""
    seg = segments.select("run_id", "pos", X.tokens_alpha("narration").alias("_tok"))
    return running_smallest(seg, "run_id", "pos", "_tok", k, "keywords").select("run_id", "pos", "keywords")


def resolve_fallback(shots: DataFrame, accepted: DataFrame, on: Sequence[str] = ("run_id", "id")) -> DataFrame:
    """Every shot resolves to something: an accepted asset, its declared fallback, or an error row.

    ``shots`` carries fallback_type; ``accepted`` carries asset, reason.
    """
    out = shots.join(accepted, list(on), "left")
    got = F.col("asset").isNotNull()
    fb = F.col("fallback_type").isNotNull()
    return out.select(*shots.columns, "asset", F.when(got, "acquired").when(fb, "fallback").alias("resolved"),
                      F.when(got, F.col("type")).otherwise(F.col("fallback_type")).alias("rendered_type"),
                      F.when(~got, F.coalesce("reason", F.lit("no_acceptance"))).alias("reason"),
                      F.when(~got & ~fb, "no renderable fallback").alias("error"))


def hash_bucket(key, n) -> Column:
    """Whole SHA-1 of the key modulo ``n``, folded digit by digit."""
    digits = F.split(F.sha1(X._col(key)), "")
    n = F.lit(n).cast("bigint") if isinstance(n, int) else n.cast("bigint")
    value = lambda d: F.call_function("locate", d, F.lit("0123456789abcdef")) - 1
    return F.aggregate(F.filter(digits, lambda d: d != ""), F.lit(0).cast("bigint"), lambda a, d: (a * 16 + value(d)) % n)


def top_facts(facts: DataFrame, hooks: DataFrame, run: str = "run_id", k: int = 3) -> DataFrame:
    """(run, caption_text): hook, the ``k`` most significant claims and the link, as one text."""
    best = top(facts, [run], [F.desc("significance"), F.asc("ord")], k, "_r").groupBy(run).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "claim"))), lambda f: F.concat(F.lit("- "), f["claim"])), "\n").alias("_b"))
    out = hooks.join(best, run, "left")
    return out.select(run, F.concat_ws("\n", "hook", F.lit(""), F.col("_b"), F.lit(""), F.concat(F.lit("Full technical guide: "), "url")).alias("caption_text"))


def resolve_visual_type(visual_type, layout, has_source, has_series) -> Column:
    """Which generator draws a scene."""
    own = X._col(has_source) & ~F.coalesce(X._col(layout).isin("hook", "cta"), F.lit(False))
    return (F.when(own, "source_card").when((X._col(visual_type) == "infographic") & X._col(has_series), "infographic").otherwise("text_card"))


def visual_jump(items: DataFrame, bits: int = K.VISUAL_JUMP_BITS) -> DataFrame:
    """Flag an image that looks very unlike the one before; clips and unreadable rows reset."""
    h = F.when(~F.col("is_clip"), F.col("h"))
    out = scan(items, ["run_id"], ["ord"], previous={"_before": h})
    return out.withColumn("visual_jump", F.coalesce(F.bit_count(h.bitwiseXOR(F.col("_before"))) > bits, F.lit(False))).drop("_before")
