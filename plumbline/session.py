"""Session helpers: the folder the cluster shares, and where lineage may be cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; an error where none is named.

    Intermediate tables written to one machine's own disk would be incomplete when other
    machines read them, so nothing falls back to a temporary folder here.
    """
    named = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
             or spark.sparkContext.getCheckpointDir())
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return named.rstrip("/")


def use_local_shared_dir(spark: SparkSession) -> None:
    """For tests and single-machine runs: name a temporary folder where none is named and there is only one machine."""
    local = spark.sparkContext.master.split("[")[0] == "local"
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if local and not named:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-plumbline-"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/plumbline/{name}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table written by ``cut`` that no plan reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame, name: str = "cut", codec: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a costly table used by several branches: later stages read columns from
    files that outlive any executor, instead of repeating the work per branch.
    """
    return cut_to(df, scratch(df.sparkSession, name), codec)


def cut_to(df: DataFrame, path: str, codec: str = "snappy") -> DataFrame:
    """``cut`` at a path that the caller owns, and may ``drop`` when nothing reads it any more."""
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_in_place(df: DataFrame, name: str = "cut") -> DataFrame:
    """``cut`` for a table whose inputs are all dealt out by one key: joins by that key and more leave rows where they lie.

    Spark shuffles both sides of such a join again, though equal keys are together already, unless a setting tells it not
    to. The setting holds while the table is written, not for what the caller plans later.
    """
    conf, key = df.sparkSession.conf, "spark.sql.requireAllClusterKeysForCoPartition"
    before = conf.get(key, None)
    conf.set(key, "false")
    try:
        return cut(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` before costly expressions: a file is read by one task for each row group, however many cores wait.

    Rows that later steps group or join by the same keys are already where those steps need them. The number of parts is
    given, since Spark would gather narrow rows in one task again, however much is made of each.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def large(df: DataFrame) -> DataFrame:
    """``df`` as one side of a join that is shuffled and merged, whatever Spark believes its size to be.

    Spark takes a table that explodes its rows, or that is packed well in its files, for as small as what it is read
    from, and keeps a join it has planned as a broadcast while the other plan has more exchanges. So tables that grow
    with the input would be gathered in the driver and held whole by every executor.
    """
    return df.hint("merge")
