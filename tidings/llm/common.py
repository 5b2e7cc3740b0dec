"""What every operator of this subpackage needs: tables, tables kept between steps, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import if_small, kept, table  # noqa: F401


def blank_trim(c: Column | str) -> Column:
    """Without outer white space of any kind, carriage returns included."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(r"(?U)^\s|\s$"), F.regexp_replace(c, r"(?U)^\s+|\s+$", "")).otherwise(c)


def usable_source(df: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds `source`: the trimmed source_name if it is a name of `sources`, else null. `sources` has one row per source."""
    names = sources.select(F.col("name").alias("source")).where(F.col("name").isNotNull()).distinct()
    return df.withColumn("_name", blank_trim("source_name")).join(names, F.col("_name") == names["source"], "left").drop("_name")
