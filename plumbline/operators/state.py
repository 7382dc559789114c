"""Run state, incremental work and caches as views over append-only tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import constants as K
from plumbline.functions import text as X
from plumbline.operators.ordered import scan


def current_state(events: DataFrame, run: str = "run_id", seq: str = "seq", failed: str = "failed") -> DataFrame:
    """(run, status, last_ok, error, artifacts): latest status, latest good status, artifacts with later values winning."""
    ok = F.when(F.col("status") != failed, F.col(seq))
    base = events.groupBy(run).agg(F.max_by("status", seq).alias("status"), F.max_by("status", ok).alias("last_ok"),
                                   F.max_by("error", F.when(F.col("error").isNotNull(), F.col(seq))).alias("error"))
    latest = events.select(run, seq, F.explode("artifacts").alias("k", "v")).groupBy(run, "k").agg(F.max_by("v", seq).alias("v"))
    # an artifact name is one of a fixed set of stage outputs, so a run has few
    merged = latest.groupBy(run).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("artifacts"))
    return base.join(merged, run, "left")


def remaining_stages(state: DataFrame, order: Sequence[str] = K.STATUS_ORDER, until: str | None = None, run: str = "run_id") -> DataFrame:
    """(run, stage, ord): stages after the last good one; an unknown status repeats everything.

    ``until`` ends the list unless that stage is already done.
    """
    names = X.strings(list(order))
    last = F.coalesce(F.nullif(F.array_position(names, F.col("last_ok")), F.lit(0).cast("bigint")), F.lit(0)) - 1
    out = state.select(run, last.alias("_last"), F.posexplode(names).alias("ord", "stage")).where(F.col("ord") > F.col("_last"))
    if until is not None:
        stop = list(order).index(until)
        out = out.where((F.col("ord") <= stop) | (F.col("_last") >= stop))
    return out.select(run, "stage", F.col("ord").cast("bigint").alias("ord"))


def status_transitions(events: DataFrame, order: Sequence[str] = K.STATUS_ORDER, run: str = "run_id", seq: str = "seq") -> DataFrame:
    """Events with the previous status and whether the step goes forward in the declared order."""
    names = X.strings(list(order))
    out = scan(events, [run], [seq], previous={"previous": F.col("status")})
    pos = lambda c: F.nullif(F.array_position(names, F.col(c)), F.lit(0).cast("bigint"))
    return out.withColumn("forward", F.coalesce(pos("status") > pos("previous"), F.lit(True)))


def incremental_index(index: DataFrame, listing: DataFrame, force: bool = False) -> DataFrame:
    """Listing rows to (re)process: new or changed ones; failed ones again only when forced."""
    done = index.where("NOT failed") if force else index
    return listing.join(done.select("path", "mtime"), ["path", "mtime"], "left_anti")


def merge_index(index: DataFrame, processed: DataFrame) -> DataFrame:
    """Index after processing: fresh rows replace old ones of the same path."""
    return index.join(processed.select("path"), "path", "left_anti").unionByName(processed)


def query_key(source, query) -> Column:
    return F.sha1(F.concat(X._col(source), F.lit("|"), F.lower(X.strip(query))))


def content_key(content) -> Column:
    return F.sha1(X._col(content))


def page_key(url) -> Column:
    return F.sha2(X.strip(url), 256)


def split_by_cache(requests: DataFrame, cache: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(hits with the cached columns, misses with one row per key to fetch)."""
    hits = requests.join(cache, key)
    misses = requests.join(cache.select(key), key, "left_anti").groupBy(key).agg(F.min(F.struct(*[c for c in requests.columns if c != key])).alias("_r")).select(key, "_r.*")
    return hits, misses


def attempts_log(attempts: DataFrame, most: int, id: str = "id") -> DataFrame:
    """(id, attempt, status, errors): the first clean attempt within ``most``, else the last one as failed."""
    rows = attempts.where(F.col("attempt") <= most)
    clean = F.when(F.col("errors") == 0, F.col("attempt"))
    out = rows.groupBy(id).agg(F.min(clean).alias("_ok"), F.max("attempt").alias("_last"), F.max_by("errors", "attempt").alias("_err"))
    return out.select(id, F.coalesce("_ok", "_last").alias("attempt"), F.when(F.col("_ok").isNotNull(), "ok").otherwise("failed").alias("status"),
                      F.when(F.col("_ok").isNotNull(), 0).otherwise(F.col("_err")).alias("errors"))
