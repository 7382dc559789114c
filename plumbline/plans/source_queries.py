"""Sources and sinks: written and read back, or parsed from texts derived from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plumbline.functions import text as X
from plumbline.plans.registry import query
from plumbline.plans.segment_queries import CUES_SQL, cue_words
from plumbline.plans.sqlkit import lit, lits
from plumbline.plans.verify_queries import GRADES_SQL, NOW, _history, grades
from plumbline.operators import segments as S
from plumbline.operators import verify as O
from plumbline.session import shared_dir
from plumbline.sources import files as IO
from plumbline.sources.providers import normalize_candidates as normalize


def _place(read, name: str) -> str:
    return f"{shared_dir(read.spark)}/plumbline/{name}-{uuid.uuid4().hex}"


@query("S2", "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents")
def stage_round_trip(read):
    """Write a stage partitioned by language, read it back with its schema."""
    base = _place(read, "stages")
    docs = read("documents").select("doc_id", "text", "lang")
    IO.write_stage(docs, base, "canonical", ("lang",))
    back = IO.read_stage(read.spark, base, "canonical", docs.schema)
    return back.select("doc_id", "lang", F.md5("text").alias("text_md5"))


# Every part is an entry of some manifest; one manifest text per brand.
_ENTRY = """CASE WHEN p_partkey % 11 = 0 THEN '7' ELSE '{' || CASE WHEN p_partkey % 3 = 0 THEN '"id": "p' || p_partkey || '", ' ELSE '' END ||
  CASE WHEN p_partkey % 13 = 0 THEN '' ELSE '"filename": "' || replace(p_name, ' ', '_') || p_partkey || CASE WHEN p_partkey % 7 = 0 THEN '.txt' ELSE '.MP4' END || '", ' END ||
  CASE WHEN p_partkey % 2 = 0 THEN '"tags": ["a", "b' || p_size || '"], ' ELSE '' END || '"x": 1}' END"""


@query("S4", f"""SELECT CASE WHEN p_partkey % 3 = 0 THEN 'p' || p_partkey ELSE replace(p_name, ' ', '_') || p_partkey END AS id, replace(p_name, ' ', '_') || p_partkey || '.MP4' AS filename,
  CASE WHEN p_partkey % 2 = 0 THEN 'a|b' || p_size ELSE '' END AS tags, '' AS description FROM part WHERE p_partkey % 11 > 0 AND p_partkey % 13 > 0 AND p_partkey % 7 > 0 AND p_partkey % 5 < 4""")
def asset_manifest(read):
    p = read("part")
    # a manifest is one JSON text, so entries are grouped into many small ones of bounded size
    block = F.floor(F.col("p_partkey") / 100)
    raw = p.select(block.alias("b"), F.expr(_ENTRY).alias("e")).groupBy("b").agg(F.concat(F.lit("["), F.array_join(F.collect_list("e"), ","), F.lit("]")).alias("value"))
    files = p.where("p_partkey % 5 < 4").select(F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.col("p_partkey").cast("string"), F.lit(".MP4")).alias("filename"))
    return IO.parse_manifest(raw, files).select("id", "filename", F.array_join("tags", "|").alias("tags"), "description")


_SAMPLE = ["openverse", "pexels", "pixabay_video", "unsplash", "bing", "wikimedia", "archive_org", "youtube", "google_images", "pixabay", "duckduckgo"]
_PAY = {
    "openverse": """'{"results": [{"url": "http://o/' || p_partkey || '", "title": null, "width": 640, "height": 480, "license": "by"}, {"title": "no url"}]}'""",
    "pexels": """'{"photos": [{"src": {"large2x": "", "original": "http://p/' || p_partkey || '"}, "alt": "", "photographer": "' || p_name || '", "width": 1, "height": 2}]}'""",
    "pixabay_video": """'{"hits": [{"videos": {"medium": {"url": "http://v/' || p_partkey || '"}}, "tags": "' || p_name || '", "duration": ' || p_size || '}]}'""",
    "unsplash": """'{"results": [{"urls": {"raw": "http://u/' || p_partkey || '"}, "alt_description": null, "width": 10, "height": 20, "user": {"name": "n"}}, {"urls": {}}]}'""",
    "bing": """'{"value": [{"contentUrl": "http://b/' || p_partkey || '", "name": "' || p_name || '"}]}'""",
    "wikimedia": """'{"query": {"pages": {"1": {"title": "File:' || p_name || '.PNG", "imageinfo": [{"url": "http://w/' || p_partkey || '", "width": 5, "height": 6}]}, "2": {"title": "x.ogv", "imageinfo": [{"url": "z"}]}}}}'""",
    "archive_org": """'{"response": {"docs": [{"title": "none"}, {"identifier": "a' || p_partkey || '", "title": "' || p_name || '", "description": ["d", "e"], "runtime": "1:' || (10 + p_size % 50) || '"}]}}'""",
    "youtube": """'{"entries": [{"id": "y' || p_partkey || '", "title": "' || p_name || CASE WHEN p_partkey % 2 = 0 THEN ' song' ELSE '' END || '", "description": "", "duration": ' || p_size || ', "view_count": 20000}]}'""",
    "google_images": """'{"items": [{"src": "http://gstatic.com/t", "w": 400, "h": 300}, {"original": "http://g/' || p_partkey || '", "alt": "' || p_name || '", "w": 0, "h": 0}, {"original": "http://g/' || p_partkey || '"}, {"src": "http://g/small", "w": 100}]}'""",
    "pixabay": """'{"hits": [{"webformatURL": "http://x/' || p_partkey || '", "tags": "t", "imageWidth": 3, "imageHeight": 4}]}'""",
    "duckduckgo": """'{"items": [{"image": "http://d/' || p_partkey || '", "title": "' || p_name || '"}, {"image": ""}]}'""",
}


@query("S5", f"""WITH p AS (SELECT *, {lits(_SAMPLE)}[1 + p_partkey % 11] AS prov FROM part)
SELECT p_partkey AS query, CASE prov WHEN 'pixabay_video' THEN 'pixabay' ELSE prov END AS source, 0 AS ord,
  CASE prov WHEN 'openverse' THEN 'http://o/' WHEN 'pexels' THEN 'http://p/' WHEN 'pixabay_video' THEN 'http://v/' WHEN 'unsplash' THEN 'http://u/' WHEN 'bing' THEN 'http://b/' WHEN 'wikimedia' THEN 'http://w/'
    WHEN 'archive_org' THEN 'https://archive.org/details/a' WHEN 'youtube' THEN 'https://www.youtube.com/watch?v=y' WHEN 'google_images' THEN 'http://g/' WHEN 'pixabay' THEN 'http://x/' ELSE 'http://d/' END || p_partkey AS url,
  CASE prov WHEN 'openverse' THEN '' WHEN 'unsplash' THEN '' WHEN 'pixabay' THEN 't' WHEN 'wikimedia' THEN 'File:' || p_name || '.PNG' WHEN 'archive_org' THEN p_name || ': d e' ELSE p_name END AS caption,
  CASE prov WHEN 'openverse' THEN 640 WHEN 'pexels' THEN 1 WHEN 'unsplash' THEN 10 WHEN 'wikimedia' THEN 5 WHEN 'youtube' THEN 1920 WHEN 'pixabay' THEN 3 ELSE 0 END AS width,
  prov IN ('pixabay_video', 'archive_org', 'youtube') AS is_clip, CASE prov WHEN 'pixabay_video' THEN CAST(p_size AS DOUBLE) WHEN 'youtube' THEN CAST(p_size AS DOUBLE) WHEN 'archive_org' THEN 70.0 + p_size % 50 END::DOUBLE AS duration_s
FROM p WHERE prov <> 'youtube' OR (p_size >= 30 AND p_partkey % 2 = 1)""")
def normalize_candidates(read):
    p = read("part").withColumn("provider", F.get(X.strings(_SAMPLE), (F.col("p_partkey") % 11).cast("int")))
    payload = F.lit(None).cast("string")
    for name, e in _PAY.items():
        payload = F.when(F.col("provider") == name, F.expr(e)).otherwise(payload)
    out = normalize(p.select("provider", F.col("p_partkey").alias("query"), payload.alias("payload")))
    return out.select("query", "source", "ord", "url", "caption", "width", "is_clip", "duration_s")


@query("S6", f"SELECT count(*) AS rows, count_if(event_id % 2 = 1) AS stamped FROM events")
def append_history(read):
    """Two appends; rows without a time get the given one."""
    path = _place(read, "history")
    h = _history(read)
    IO.append_history(h.where("event_id % 2 = 0"), path, NOW)
    IO.append_history(h.where("event_id % 2 = 1").drop("created_at"), path, "2030-01-01T00:00:00Z")
    return read.spark.read.parquet(path).agg(F.count("*").alias("rows"), F.count_if(F.col("created_at") == "2030-01-01T00:00:00Z").alias("stamped"))


@query("S7", f"""WITH {GRADES_SQL}, h AS (SELECT run_id FROM go GROUP BY 1 HAVING min(overall + 3) >= 5 AND min(overall + 3) < 7)
SELECT run_id, scene, overall FROM (SELECT run_id, scene, overall + 3 AS overall FROM go) g WHERE run_id IN (SELECT run_id FROM h)""")
def review_queue(read):
    s = O.grade_overall(grades(read)).select("run_id", "scene", (F.col("overall") + 3).alias("overall"), F.lit(False).alias("ungradeable"))
    runs = s.select("run_id").distinct()
    return IO.review_queue(O.decision_band(runs, s), runs, s, NOW)[1]


_MSF = "CAST(round_even({c} * 1000, 0) AS BIGINT)"


def _srt(c: str) -> str:
    ms = _MSF.format(c=c)
    return f"printf('%02d:%02d:%02d,%03d', {ms} // 3600000, {ms} % 3600000 // 60000, {ms} % 60000 // 1000, {ms} % 1000)"


@query("S8", f"""WITH RECURSIVE {CUES_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY idx) AS n FROM cues)
SELECT doc, n, md5(n || chr(10) || {_srt('start_s')} || ' --> ' || {_srt('end_s')} || chr(10) || replace(replace(text, 'ß', 'SS'), 'ẞ', 'SS') || chr(10)) AS block_md5 FROM n""")
def caption_blocks(read):
    return IO.caption_blocks(S.group_cues(cue_words(read))).select("doc", "n", F.md5("block").alias("block_md5"))


@query("S9", """SELECT conv_id, turn, 0 AS idx, '0:00:0' || turn || '.50' AS start, '1:02:03.12' AS "end", role || '\\N' || 'more' AS text FROM conversations""")
def parse_captions(read):
    srt = F.expr("""concat('1\n00:00:0', turn, ',509 --> 01:02:03,129\n ', role, ' \nmore\n\n2\nno time\ntext\n\n\n3\n00:00:01,000 --> 00:00:02,000\n')""")
    return IO.parse_captions(read("conversations").select("conv_id", "turn", srt.alias("value")), keys=("conv_id", "turn"))
