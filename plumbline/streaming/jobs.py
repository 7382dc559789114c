"""The batch operators' semantics on Structured Streaming."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.functions import text as X
from plumbline.operators import facts as FO
from plumbline.operators import pages as PO
from plumbline.session import shared_dir
from plumbline.sources.files import append_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# ── X1: pages to numeric sentences, stateless ──────────────────────────────
def page_facts(pages: DataFrame, main: str = "(?s)<article>(.*?)</article>") -> DataFrame:
    """(page_id, pos, sentence) for a batch or a stream of pages."""
    articles = F.array_join(F.regexp_extract_all("html", F.lit(main), F.lit(1)), " ")
    text = pages.select("page_id", PO.canonical_text(articles).alias("text"))
    return FO.mine_numeric_sentences(text, id="page_id")


# ── X1: pages to gated facts, through a table of posts ─────────────────────
def posts(pages: DataFrame, closed_only: bool = False) -> DataFrame:
    """The post of each page (page_id, url, html, ts); strategy NULL where a page holds none. Pages are parsed here and nowhere after."""
    return PO.isolate_main(pages, carry=["ts"], closed_only=closed_only)


def post_errors(found: DataFrame) -> DataFrame:
    """(page_id, url, reason): pages held back, for the error stream."""
    return PO.quarantine(found)


def post_sentences(found: DataFrame) -> DataFrame:
    """(page_id, pos, sentence): numeric sentences of the posts."""
    return FO.mine_numeric_sentences(found.where("strategy IS NOT NULL"), id="page_id", text="canonical_text")


def post_citations(found: DataFrame) -> DataFrame:
    """(page_id, marker, url, kind): what the posts cite."""
    bodies = found.where("strategy IS NOT NULL").select("page_id", "url", F.col("body_html").alias("html"))
    return PO.extract_citations(PO.html_extract(bodies))


def gated_facts(found: DataFrame, facts: DataFrame, late: str = "1 hour", wait: str = "1 day") -> DataFrame:
    """(page_id, fact_id, status, reason, char_offset): a model's facts held against their posts, stream against stream.

    ``facts``: page_id, fact_id, quote, value, ts. A fact meets its post if their times are at most ``wait`` apart; both
    sides' state goes when the watermark (``late`` behind) has passed that, so it is bounded by what arrives in ``wait``.
    Facts of pages without a post never come out: their page is on the error stream.
    """
    p = found.where("strategy IS NOT NULL").select(F.col("page_id").alias("_page"), F.col("ts").alias("_seen"), "canonical_text").withWatermark("_seen", late)
    f = facts.withWatermark("ts", late)
    near = F.expr(f"ts BETWEEN _seen - interval {wait} AND _seen + interval {wait}")
    met = f.join(p, (F.col("page_id") == F.col("_page")) & near)
    located = met.withColumn("char_offset", X.locate_in(X.normalize_for_match("quote"), X.normalize_for_match("canonical_text")))
    return FO.judge_facts(located).select("page_id", "fact_id", "status", "reason", F.col("char_offset").cast("bigint").alias("char_offset"))


def run_posts(pages: DataFrame, name: str = "posts", closed_only: bool = False) -> DataFrame:
    """Run ``posts`` to a file table, each page once, and read that as a stream: what follows reads files, not pages."""
    found = posts(pages, closed_only)
    return pages.sparkSession.readStream.schema(found.schema).parquet(run_to_path(found, name))


# ── X2: first sight of a key ───────────────────────────────────────────────
def first_seen(events: DataFrame, key: str, ts: str = "ts", horizon: str = "1 day") -> DataFrame:
    """Rows whose key was not seen within ``horizon``; state is dropped after it."""
    return events.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


# ── X3: publish counts per window ──────────────────────────────────────────
def rolling_counts(events: DataFrame, ts: str = "ts", group: str = "region", size: str = "30 days", slide: str | None = "1 day", late: str = "1 hour",
                   pane: str | None = None) -> DataFrame:
    """(start, end, group, n) of closed windows; later rows than ``late`` are dropped.

    Sliding windows are made of panes (``slide`` long unless ``pane`` says otherwise; it must divide both): a row is
    counted in its one pane, and closed panes, a row for each group, go into the windows that hold them. So the first
    state has a row for each open pane, and no event is ever copied into all of its windows.
    """
    events = events.withWatermark(ts, late)
    if slide is None:
        out = events.groupBy(F.window(ts, size).alias("w"), group).agg(F.count("*").alias("n"))
    else:
        panes = events.groupBy(F.window(ts, pane or slide).alias("p"), group).agg(F.count("*").alias("n"))
        out = panes.groupBy(F.window(F.window_time("p"), size, slide).alias("w"), group).agg(F.sum("n").alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), group, "n")


# ── X4: run state ──────────────────────────────────────────────────────────
TRACK_SCHEMA = "run_id bigint, seq bigint, status string, last_ok string, kind string"


def track_runs(events: DataFrame, stuck_after_ms: int, late: str = "1 hour", failed: str = "failed", final: tuple[str, ...] = ("published",), forget_after_ms: int = 30 * 86_400_000) -> DataFrame:
    """One row per run and batch with its state, and a 'stuck' row for a run silent that long in event time.

    A run's state goes with a ``final`` status, or ``forget_after_ms`` after it was reported stuck.

    Needs the RocksDB state store. ``events``: run_id, seq, status, ts. Silence
    is measured by the watermark, so a replay gives the same rows.
    """
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class Tracker(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("state", "seq bigint, status string, ok_seq bigint, last_ok string, seen_ms bigint, stuck boolean")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            seq, status, ok_seq, last_ok, seen, _ = self.state.get() if self.state.exists() else (-1, None, -1, None, 0, False)
            for pdf in rows:
                top = pdf.loc[pdf["seq"].idxmax()]
                seen = max(seen, int(pdf["ms"].max()))
                if top["seq"] > seq:
                    seq, status = int(top["seq"]), top["status"]
                good = pdf[pdf["status"] != failed]
                if len(good) and good["seq"].max() > ok_seq:
                    best = good.loc[good["seq"].idxmax()]
                    ok_seq, last_ok = int(best["seq"]), best["status"]
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if status in final:
                self.state.clear()
            else:
                self.state.update((seq, status, ok_seq, last_ok, seen, False))
                self.handle.registerTimer(seen + stuck_after_ms)
            yield pd.DataFrame({"run_id": [key[0]], "seq": [seq], "status": [status], "last_ok": [last_ok], "kind": ["state"]})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            seq, status, ok_seq, last_ok, seen, stuck = self.state.get()
            if stuck:
                self.state.clear()
                return
            self.state.update((seq, status, ok_seq, last_ok, seen, True))
            self.handle.registerTimer(seen + stuck_after_ms + forget_after_ms)
            yield pd.DataFrame({"run_id": [key[0]], "seq": [seq], "status": [status], "last_ok": [last_ok], "kind": ["stuck"]})

        def close(self) -> None:
            pass

    rows = events.withWatermark("ts", late).select("run_id", "seq", "status", "ts", F.unix_millis("ts").alias("ms"))
    return rows.groupBy("run_id").transformWithStateInPandas(Tracker(), TRACK_SCHEMA, "Append", "EventTime")


# ── X5: sessions and cues ──────────────────────────────────────────────────
def sessions(events: DataFrame, key: str, gap: str, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """(key, start, end, n): rows of a key without a gap of at least ``gap``."""
    out = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


CUE_SCHEMA = "doc bigint, idx bigint, start_s double, end_s double, text string"


def stream_cues(words: DataFrame, max_words: int = 3, max_s: float = 1.5) -> DataFrame:
    """Cues as ``group_cues`` makes them, from words that may arrive in any order; idx is dense from 0 in a document.

    Words wait in state by idx until all before them have come. A cue goes out once the word after it is known, it is
    full, or the document is closed by a word with ``last`` set, after which its state goes. Needs the RocksDB state store.
    """
    return words.select("doc", "idx", "word", "start_s", "end_s", "last").groupBy("doc").transformWithStateInPandas(cue_processor(max_words, max_s), CUE_SCHEMA, "Append", "None")


def cue_processor(max_words: int, max_s: float):
    """The processor of ``stream_cues``. Only words that must wait are written to state; a document that comes whole asks it once."""
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class Cues(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.waiting = handle.getMapState("waiting", "idx bigint", "word string, start_s double, end_s double, last boolean")
            self.next = handle.getValueState("next", "idx bigint, upto bigint")  # words wait in [idx, upto)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            come = {}
            for pdf in rows:
                come.update(zip(pdf["idx"].tolist(), zip(pdf["word"].tolist(), pdf["start_s"].tolist(), pdf["end_s"].tolist(), pdf["last"].tolist())))
            known = self.next.get()
            first, upto = known or (0, 0)
            there, at = [], first
            while at in come or (at < upto and self.waiting.containsKey((at,))):
                there.append(come[at] if at in come else self.waiting.getValue((at,)))
                at += 1
            closed = any(w[3] for w in there)
            cues, used = cue_steps([w[1] for w in there], [w[2] for w in there], closed, max_words, max_s)
            if not closed:
                for i in range(first, min(first + used, upto)):
                    self.waiting.removeKey((i,))
                for i, w in come.items():
                    if i >= first + used:
                        self.waiting.updateValue((i,), w)
                        upto = max(upto, i + 1)
                self.next.update((first + used, upto))
            elif known:
                self.waiting.clear()
                self.next.clear()
            if cues:
                out = [(key[0], first + a, there[a][1], there[z - 1][2], " ".join(w[0].strip().upper() for w in there[a:z])) for a, z in cues]
                yield pd.DataFrame(out, columns=["doc", "idx", "start_s", "end_s", "text"])

        def close(self) -> None:
            pass

    return Cues()


def cue_steps(start_s: list[float], end_s: list[float], closed: bool, max_words: int, max_s: float) -> tuple[list[tuple[int, int]], int]:
    """(first, end) of the cues that are certain, and the words they use: each word's own reach is looked up, then followed."""
    n = len(start_s)
    reach = [next((j for j in range(i + 1, min(i + max_words, n)) if end_s[j] - start_s[i] > max_s), min(i + max_words, n)) for i in range(n)]
    cues, at = [], 0
    while at < n and (closed or reach[at] < n or reach[at] == at + max_words):
        cues.append((at, reach[at]))
        at = reach[at]
    return cues, at


# ── X6: runs on hold ───────────────────────────────────────────────────────
def held_sink(path: str, stream: str = "held") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: append runs on hold; a repeated batch does not repeat rows.

    ``stream`` names the checkpoint that counts the batches: another stream, or the same one begun anew under another
    name, has folders of its own and replaces nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch.where("decision = 'hold'"), path, batch_id, stream)
    return write


# ── running a stream to its end ────────────────────────────────────────────
def run_to_path(stream: DataFrame, name: str, mode: str = "append", rocksdb: bool = False) -> str:
    """Run over everything available, with checkpoint and output in the shared folder; the folder of the result."""
    spark: SparkSession = stream.sparkSession
    base = f"{shared_dir(spark)}/plumbline/stream-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    if rocksdb:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        q = (stream.writeStream.format("parquet").outputMode(mode).option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return f"{base}/out"


def run_to_table(stream: DataFrame, name: str, mode: str = "append", rocksdb: bool = False) -> DataFrame:
    """``run_to_path``, and read the result."""
    return stream.sparkSession.read.schema(stream.schema).parquet(run_to_path(stream, name, mode, rocksdb))


def run_batches(stream: DataFrame, name: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    base = f"{shared_dir(stream.sparkSession)}/plumbline/stream-{name}-{uuid.uuid4().hex}"
    stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
