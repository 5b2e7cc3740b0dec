"""Idempotent writes to Parquet tables: upserts that rewrite the touched partitions, then put a manifest in place."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import EXCERPT_CHARS
from ..operators.duplicates import unseen
from .shared import kept


def merged(table: DataFrame, updates: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """The table with the updates by key: per key the row with the greatest `newest`, updates winning ties.

    One aggregation of structs, which combines before the shuffle. Rows with a null in a key are kept as they are.
    """
    columns = [c for c in table.columns]
    both = table.select(*columns, F.lit(0).alias("_u")).unionByName(updates.select(*columns, F.lit(1).alias("_u")))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    rest = [c for c in columns if c not in keys]
    best = both.where(~no_key).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(newest), F.col("_u"))).alias("r"))
    return best.select(*keys, "r.*").select(*columns).unionByName(both.where(no_key).select(*columns))


def inserted(table: DataFrame, items: DataFrame) -> DataFrame:
    """The items whose (source_id, external_id) the table does not have: what an insert adds. The event happened when it was
    published, as far as is known then."""
    fresh = unseen(items, table)
    return fresh.withColumn("occurred_at", F.col("published_at")) if "published_at" in fresh.columns else fresh


def first_sources(reports: DataFrame) -> DataFrame:
    """The bridge rows of newly inserted reports: their own message is their first source."""
    excerpt = F.substring(F.coalesce("content", F.lit("")), 1, EXCERPT_CHARS)
    return reports.select(F.col("id").alias("report_id"), "source_id", "source_name", "source_url", F.coalesce("external_id", F.lit("")).alias("external_id"), "published_at", excerpt.alias("excerpt"))


def without_children(children: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Rows whose parent was not deleted (cascade)."""
    return children.join(deleted.select(key).distinct(), key, "left_anti")


class Table:
    """A Parquet table in one folder, as hash partitions of its keys; each batch writes the partitions that it touches.

    A batch's rows go to a folder of its own. The table is what its last manifest lists: a small file that says for each
    partition which batch wrote it last, put in place by a rename, so readers never see half a batch. The same batch again
    starts from the manifest before it and leaves the same table. Of older batches `keep` manifests and what they list stay, the
    rest is deleted.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], newest: str, partitions: int = 16, keep: int = 3):
        self.spark, self.path, self.schema, self.keys, self.newest, self.partitions, self.keep = spark, path, schema, keys, newest, partitions, keep
        self._jpath = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        """The batches that have a manifest."""
        folder = self._jpath(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def _manifest(self, before: int | None) -> dict[str, int]:
        done = [b for b in self.batches() if before is None or b < before]
        if not done:
            return {}
        stream = self._fs.open(self._jpath(f"{self.path}/manifests/{done[-1]}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _rows(self, manifest: dict[str, int]) -> DataFrame:
        folders = [f"{self.path}/data/{batch}/_part={part}" for part, batch in sorted(manifest.items())]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self, before: int | None = None) -> DataFrame:
        """The table as its last batch left it, or the last one before `before`."""
        return self._rows(self._manifest(before))

    def upsert(self, updates: DataFrame, batch: int) -> None:
        """Per key the row with the greatest `newest`, updates winning ties; rows with a null in a key are added as they are."""
        part = F.pmod(F.xxhash64(*self.keys), F.lit(self.partitions)).cast("int")
        columns = self.spark.createDataFrame([], self.schema).columns
        updates = kept(updates.select(*columns).withColumn("_part", part))
        touched = [r[0] for r in updates.select("_part").distinct().collect()]  # at most `partitions`
        manifest = self._manifest(batch)
        if touched:
            old = self._rows({p: b for p, b in manifest.items() if int(p) in touched})
            new = merged(old, updates.drop("_part"), self.keys, self.newest).withColumn("_part", part)
            new.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/data/{batch}")
        self._put(batch, manifest | {str(p): batch for p in touched})
        self._prune()

    def _put(self, batch: int, manifest: dict[str, int]) -> None:
        self._fs.mkdirs(self._jpath(f"{self.path}/manifests"))
        part, goal = self._jpath(f"{self.path}/manifests/.{batch}"), self._jpath(f"{self.path}/manifests/{batch}")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        self._fs.delete(goal, False)
        self._fs.rename(part, goal)

    def _prune(self) -> None:
        done = self.batches()
        used = {f"{batch}/_part={part}" for b in done[-self.keep :] for part, batch in self._manifest(b + 1).items()}
        for b in done[: -self.keep]:
            self._fs.delete(self._jpath(f"{self.path}/manifests/{b}"), False)
        data = self._jpath(f"{self.path}/data")
        for folder in self._fs.listStatus(data) if self._fs.exists(data) else []:
            name = folder.getPath().getName()
            own = [p.getPath() for p in self._fs.listStatus(folder.getPath()) if p.getPath().getName().startswith("_part=")]
            live = [p for p in own if f"{name}/{p.getName()}" in used]
            for p in own if live else ():
                if p not in live:
                    self._fs.delete(p, True)
            if not live and int(name) <= done[-1]:
                self._fs.delete(folder.getPath(), True)


class Log:
    """An append-only table: one folder per batch, written again if the batch is."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def append(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def read(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.path)
