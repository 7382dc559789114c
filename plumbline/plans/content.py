"""The stage tables from pages to timed shots, each one a pure function of earlier ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.operators import facts as FO
from plumbline.operators import gates as G
from plumbline.operators import pages as P
from plumbline.operators import segments as S
from plumbline.sources.files import read_stage, write_stage

STAGES = ["posts", "citations", "facts", "violations", "shots", "lint", "timed"]


def build_stages(base: str, pages: DataFrame, model_facts: DataFrame, segments: DataFrame, rules: G.Rules,
                 beats: DataFrame | None = None, voice: DataFrame | None = None, until: str = "timed") -> dict[str, DataFrame]:
    """Write the stage tables under ``base`` up to ``until`` and return them.

    ``run_id`` of the segments is the page's id. Never unverified: facts that are
    not in their page, and runs with any violation, go no further. ``beats``
    (run_id, pos, beat, start_s, duration_s) and ``voice`` (run_id,
    voice_total_s) are the measured narration, needed for the last stage.
    """
    if until not in STAGES:
        raise ValueError(f"unknown stage {until}")
    spark, done = pages.sparkSession, {}

    def stage(name: str, df: DataFrame) -> bool:
        """Write one stage; True when it was the last one wanted."""
        write_stage(df, base, name)
        done[name] = read_stage(spark, base, name, df.schema)
        return name == until

    if stage("posts", P.isolate_main(pages)):
        return done
    bodies = done["posts"].where("strategy IS NOT NULL")
    if stage("citations", P.extract_citations(P.html_extract(bodies.select("page_id", "url", F.col("body_html").alias("html"))))):
        return done
    gated = FO.gate_facts(model_facts, bodies.select("page_id", F.col("canonical_text").alias("text")), on="page_id")
    if stage("facts", gated):
        return done
    kept = done["facts"].where("status = 'kept'").withColumnRenamed("page_id", "run_id")
    if stage("violations", G.run_gates(segments, kept, rules)):
        return done
    clean = segments.join(done["violations"].select("run_id"), "run_id", "left_anti")
    cites = done["citations"].withColumnRenamed("page_id", "run_id")
    if stage("shots", S.number_segments(S.expand_segments(clean, kept, cites, rules))):
        return done
    if stage("lint", S.lint_segments(done["shots"], kept)):
        return done
    if beats is None or voice is None:
        raise ValueError("the timed stage needs beats and voice")
    ready = beats.join(done["shots"].select("run_id").distinct(), "run_id", "left_semi")
    stage("timed", S.reflow(done["shots"], S.beat_spans(ready, voice)))
    return done
