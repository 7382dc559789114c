"""Costly row expressions run on rows dealt out, not in one task for each row group."""

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text as X
from plumbline.plans import standins as V
from plumbline.plans import verify_queries as Q

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", [V.notes, V.scripts, V.script_facts, Q._verdicts], ids=lambda f: f.__name__)
def test_rows_of_one_row_group_are_dealt_out(spark, rows):
    df = rows(lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet"))
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_speech_and_units_at_word_borders(spark):
    texts = ["xH2S H2S, CO2x CO2 5 mg/L 3kg/t 4 kg/t 7% at 2°C", "x5 kg 5 kg 15kg a.5 % é5 kg 5 kgs", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    spoken = [r[0] for r in df.select(X.normalize_speech("t")).collect()]
    assert spoken[0] == "xH2S H 2 S, CO2x C O 2 5 milligrams per liter 3kg/t 4 kilograms per tonne 7 percent at 2 degrees Celsius"
    assert spoken[3] is None
    found = [[(n["match"], n["start"]) for n in r[0]] for r in df.select(X.unit_numerics("t")).collect()]
    assert found[1] == [("5 kg", 6), ("15kg", 11), ("5 %", 18)] and found[2] == found[3] == []
