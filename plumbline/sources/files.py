"""Stage tables, rule files, asset manifests, captions, history and the review queue."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.functions import text as X
from plumbline.operators.gates import Rules
from plumbline.operators.ordered import scan

# Fixed values
RULE_KEYS = ["company", "domain", "tagline", "differentiators", "cta_lines", "banned_claims"]
VIDEO_EXTENSIONS = ["mp4", "mov", "webm", "mkv"]
ASSET_SCHEMA = "id string, filename string, tags array<string>, categories array<string>, description string, duration_s double, good_for array<string>"


# ── stage tables ───────────────────────────────────────────────────────────
def write_stage(df: DataFrame, base: str, stage: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace one stage's table; the commit protocol keeps a half-written one invisible."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{base}/{stage}")


def read_stage(spark: SparkSession, base: str, stage: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{base}/{stage}")


# ── rules ──────────────────────────────────────────────────────────────────
def read_rules(path: str) -> Rules:
    """One publisher's rule file (YAML or JSON), loud on anything missing."""
    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(f"rule file not found: {path}")
    text = file.read_text(encoding="utf-8")
    try:
        data = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as e:
            raise ImportError("reading YAML rules needs the yaml package; JSON works without it") from e
        try:
            data = yaml.safe_load(text)
        except yaml.YAMLError as e:
            raise ValueError(f"rule file is not valid YAML: {path}: {e}") from e
    if not isinstance(data, dict):
        raise ValueError(f"rule file must hold a mapping, not {type(data).__name__}")
    missing = sorted(set(RULE_KEYS) - set(data))
    if missing:
        raise ValueError(f"rule file lacks: {', '.join(missing)}")
    return Rules([(d["id"], d["text"]) for d in data["differentiators"]], list(data["cta_lines"]), str(data["domain"]), list(data["banned_claims"]))


def rule_tables(spark: SparkSession, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(rule_text(id, text, kind), banned(phrase, kind)) for joins."""
    rows = [(i, t, "differentiator") for i, t in rules.differentiators] + [(f"cta{n}", t, "cta") for n, t in enumerate(rules.cta_lines, 1)]
    return (spark.createDataFrame(rows, "id string, text string, kind string"),
            spark.createDataFrame([(p, "rule") for p in rules.banned], "phrase string, kind string"))


# ── asset manifest ─────────────────────────────────────────────────────────
def parse_manifest(raw: DataFrame, files: DataFrame, column: str = "value", extensions=tuple(VIDEO_EXTENSIONS)) -> DataFrame:
    """Entries of JSON lists; what is no object, has no known file or another extension is left out."""
    items = F.explode(F.try_variant_get(F.try_parse_json(column), "$", "array<variant>")).alias("v")
    rows = raw.select(items).where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    # to_json of an object is what from_json needs to apply the defaults per field
    e = rows.select(F.from_json(F.to_json("v"), ASSET_SCHEMA).alias("e")).select("e.*")
    e = e.where(F.coalesce("filename", F.lit("")) != "")
    e = e.where(F.lower(F.regexp_extract("filename", r"\.([^.]*)$", 1)).isin(*extensions))
    e = e.join(files.select("filename"), "filename", "left_semi")
    stem = F.regexp_replace(F.regexp_extract("filename", "([^/]*)$", 1), r"\.[^.]*$", "")
    empty = X.strings([])
    return e.select(F.coalesce("id", stem).alias("id"), "filename", F.coalesce("tags", empty).alias("tags"), F.coalesce("categories", empty).alias("categories"),
                    F.coalesce("description", F.lit("")).alias("description"), "duration_s", F.coalesce("good_for", empty).alias("good_for"))


def read_asset_manifest(spark: SparkSession, path: str, files: DataFrame, **kw) -> DataFrame:
    return parse_manifest(spark.read.text(path, wholetext=True), files, **kw)


# ── captions ───────────────────────────────────────────────────────────────
def caption_blocks(cues: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, n, block): numbered SRT blocks."""
    numbered = scan(cues, [doc], ["idx"], sums={"n": F.lit(1)})
    n = F.col("n") + 1
    return numbered.select(doc, n.cast("bigint").alias("n"), F.concat(
        n.cast("string"), F.lit("\n"), X.srt_time("start_s"), F.lit(" --> "), X.srt_time("end_s"), F.lit("\n"), F.col("text"), F.lit("\n")).alias("block"))


def event_lines(cues: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, idx, line): dialogue lines of a burned-in caption file."""
    return cues.select(doc, "idx", F.concat(F.lit("Dialogue: 0,"), X.ass_time("start_s"), F.lit(","), X.ass_time("end_s"), F.lit(",Cap,,0,0,0,,"), F.col("text")).alias("line"))


def _bucket(doc: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(doc.cast("string")), F.lit(buckets))


def write_captions(cues: DataFrame, path: str, doc: str = "doc", buckets: int = 64) -> None:
    """Blocks as JSON lines (doc, n, block), in order, in a fixed number of folders whatever the number of documents.

    Ranges of (bucket, doc, n) are the tasks, so neither a document nor a bucket is one task's alone.
    """
    rows = caption_blocks(cues, doc).select(_bucket(F.col(doc), buckets).alias("bucket"), F.col(doc).alias("doc"), "n", "block")
    order = ["bucket", "doc", "n"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").json(path)


def read_written_captions(spark: SparkSession, path: str, docs: list | None = None, buckets: int = 64) -> DataFrame:
    """(doc, n, block) of what ``write_captions`` wrote; for given ``docs`` only their buckets are read."""
    rows = spark.read.schema("doc string, n bigint, block string, bucket bigint").json(path)
    if docs is not None:
        wanted = spark.createDataFrame([(str(d),) for d in docs], "d string").select(_bucket(F.col("d"), buckets)).distinct().collect()
        rows = rows.where(F.col("bucket").isin([r[0] for r in wanted]) & F.col("doc").isin([str(d) for d in docs]))
    return rows.drop("bucket")


def parse_captions(files: DataFrame, value: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys…, idx, start, end, text) of SRT texts; blocks without time code or text are skipped."""
    text = F.regexp_replace(F.col(value), r"\r\n?", "\n")
    blocks = F.filter(F.transform(F.split(text, r"\n{2,}"), X.strip), lambda b: b != "")
    lines = F.transform(blocks, lambda b: F.split(b, "\n"))
    lines = F.transform(lines, lambda a: F.when(F.rlike(F.get(a, F.lit(0)), F.lit(r"^\s*\d+\s*$")), F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(1)))).otherwise(a))
    time = r"^([\d:,.]+)\s+-->\s+([\d:,.]+)"

    def stamp(t):
        p = F.split(F.replace(t, F.lit(","), F.lit(".")), ":")
        sec = F.get(p, F.lit(2))
        cs = F.floor(F.coalesce(F.nullif(F.regexp_extract(sec, r"\.(\d+)", 1), F.lit("")), F.lit("0")).cast("int") / 10)
        return F.concat(F.get(p, F.lit(0)).cast("int").cast("string"), F.lit(":"), F.lpad(F.get(p, F.lit(1)).cast("int").cast("string"), 2, "0"), F.lit(":"),
                        F.lpad(F.regexp_extract(sec, r"^(\d+)", 1).cast("int").cast("string"), 2, "0"), F.lit("."), F.lpad(cs.cast("string"), 2, "0"))

    rows = F.transform(lines, lambda a: F.struct(
        F.regexp_extract(F.get(a, F.lit(0)), time, 1).alias("s"), F.regexp_extract(F.get(a, F.lit(0)), time, 2).alias("e"),
        F.array_join(F.filter(F.transform(F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(1))), X.strip), lambda x: x != ""), r"\N").alias("text")))
    good = F.filter(rows, lambda r: (r["s"] != "") & (r["text"] != ""))
    return files.select(*keys, F.posexplode(good).alias("idx", "_c")).select(
        *keys, F.col("idx").cast("bigint").alias("idx"), stamp(F.col("_c")["s"]).alias("start"), stamp(F.col("_c")["e"]).alias("end"), F.col("_c")["text"].alias("text"))


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    return parse_captions(spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path")), keys=("path",))


# ── history and review queue ───────────────────────────────────────────────
def with_created_at(rows: DataFrame, now: str) -> DataFrame:
    """``created_at`` defaults to the given time."""
    given = F.col("created_at") if "created_at" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("created_at", F.coalesce(given, F.lit(now)))


def append_history(rows: DataFrame, path: str, now: str) -> None:
    """Append publish records; a failed job leaves the earlier content as it was."""
    with_created_at(rows, now).write.mode("append").parquet(path)


def append_batch(rows: DataFrame, path: str, batch_id: int, run: str = "batches") -> None:
    """Idempotent append of one batch of one run: repeated, it replaces its own folder only."""
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"a run's name becomes a folder: {run!r}")
    rows.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={int(batch_id)}")


def review_queue(decisions: DataFrame, runs: DataFrame, scenes: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """(queue, queue_scenes) of runs on hold: one head row per run, one row per scene with its overall grade."""
    held = decisions.where("decision = 'hold'").select("run_id")
    head = runs.join(held, "run_id", "left_semi").withColumn("held_at", F.lit(now))
    return head, scenes.join(held, "run_id", "left_semi").select("run_id", "scene", "overall")


def write_review_queue(decisions: DataFrame, runs: DataFrame, scenes: DataFrame, path: str, now: str, run: str = "batches", batch_id: int = 0) -> None:
    """Both tables of one batch, under one key.

    Scenes go first, so a head never stands without its scenes; a batch that failed between the two is repeated with
    the same key and replaces both of its folders.
    """
    head, rows = review_queue(decisions, runs, scenes, now)
    append_batch(rows, f"{path}/scenes", batch_id, run)
    append_batch(head, f"{path}/queue", batch_id, run)


def read_review_queue(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(queue, queue_scenes): every head, and the scenes of heads that are there; scenes of an unfinished batch wait."""
    head = spark.read.parquet(f"{path}/queue")
    rows = spark.read.parquet(f"{path}/scenes")
    done = head.select("run", "batch_id", "run_id")
    return head, rows.join(done, ["run", "batch_id", "run_id"], "left_semi")
