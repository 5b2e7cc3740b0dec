"""Tables in the folder that all executors share, for steps that are read several times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_made: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. A local one only where none is set and all tasks run in this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tidings-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def kept(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder as Parquet and read them again: cuts the lineage, survives a lost executor.

    The folder goes with discard(), or when the session's file system closes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidings-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> int:
    """Delete all tables kept so far, once the results that read them have been consumed. Returns how many."""
    n = len(_made)
    while _made:
        where = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return n


def if_small(df: DataFrame, most: int = 20_000) -> DataFrame:
    """The rows as a kept table, marked for broadcast if they are at most `most`; else the join is left to the planner."""
    df = kept(df)
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
