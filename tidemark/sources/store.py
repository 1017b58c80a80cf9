"""A store of series by source and ticker, in versions: a merge writes only the partitions that it touches, and readers follow its log.

Layout: `data/v=<version>/source=<source>/ticker=<ticker>/` holds Parquet files, `parts/v=<version>` a table that says in which version
each partition stands, and `log/<version>.json` names the schema. The log entry comes last, by a rename that never replaces a file, so
a version is there as a whole or not at all, a reader keeps the version that it began with, and of two writers at once the second fails.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.readers import merged

PARTITION = ["source", "ticker"]
MOST_BROADCAST = 1_000_000


class Store:
    """A folder of any file system that Spark writes to; columns source, ticker and date, others as they come."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def log(self) -> list[int]:
        """All versions, oldest first."""
        found = self._files().globStatus(self._path("log/*.json")) or []
        return sorted(int(x.getPath().getName().removesuffix(".json")) for x in found)

    def entry(self, version: int) -> dict:
        stream = self._files().open(self._path(f"log/{version:010d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, version: int, entry: dict) -> None:
        draft, place = self._path(f"drafts/{version}-{id(entry)}.json"), self._path(f"log/{version:010d}.json")
        self._files().mkdirs(place.getParent())
        stream = self._files().create(draft, True)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        rename = getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename")
        never = self.spark.sparkContext._gateway.new_array(rename, 1)
        never[0] = rename.NONE
        self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, place, never)

    def _parts(self, version: int) -> DataFrame:
        """source, ticker and v: the version that holds each partition."""
        return self.spark.read.schema("source string, ticker string, v long").parquet(f"{self.folder}/parts/v={version}").select(*PARTITION, "v")

    def _few(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= MOST_BROADCAST else df

    def read(self, start: str | None = None, end: str | None = None, version: int | None = None) -> DataFrame | None:
        """The rows of a version, by default of the newest, in a range of dates; None if there is no version."""
        versions = self.log()
        if not versions:
            return None
        version = versions[-1] if version is None else version
        schema = StructType.fromJson(self.entry(version)["schema"])
        rows = self.spark.read.schema(schema.add("v", "long")).parquet(f"{self.folder}/data")
        # partitions are pruned by the join, as its other side is a filter on partition columns
        rows = rows.join(self._few(self._parts(version)), [*PARTITION, "v"]).select([F.col(f"`{c}`") for c in schema.names if c != "v"])
        if start is not None:
            rows = rows.where(F.col("date") >= F.lit(start).cast("date"))
        return rows if end is None else rows.where(F.col("date") <= F.lit(end).cast("date"))

    def merge(self, new: DataFrame, keys: list[str] = [*PARTITION, "date"], origin: str | None = None) -> int:
        """Rows of `new` over those of the store, one for each key; the new version's number.

        Only partitions with rows in `new` are read and written; others stay where they are. Columns of either side are kept. An
        `origin` that the log has already is not merged again."""
        versions = self.log()
        last = versions[-1] if versions else 0
        done = self.entry(last)["origins"] if versions else {}
        name, _, number = (origin or "").rpartition(":")
        if origin and done.get(name, -1) >= int(number):
            return last
        if new.isEmpty():
            return last
        version, old = last + 1, self.read()
        touched = new.select(*PARTITION).distinct()
        both = merged(new.limit(0) if old is None else old.join(self._few(touched), PARTITION, "left_semi"), new, keys)
        both.repartition(*PARTITION).write.mode("overwrite").partitionBy(*PARTITION).parquet(f"{self.folder}/data/v={version}")
        parts = touched.withColumn("v", F.lit(version).cast("long"))
        if old is not None:
            parts = self._parts(last).join(touched, PARTITION, "left_anti").unionByName(parts)
        parts.write.mode("overwrite").parquet(f"{self.folder}/parts/v={version}")
        schema = StructType([f for f in both.schema if f.name not in PARTITION]).add("source", "string").add("ticker", "string")
        self._commit(version, {"schema": schema.jsonValue(), "origins": done | ({name: int(number)} if origin else {})})
        return version

    def vacuum(self, keep: int = 1) -> list[int]:
        """Deletes the versions before the newest `keep`, with the data of none that is kept; the deleted versions. Readers of those fail."""
        versions = self.log()
        gone, kept = versions[:-keep], versions[-keep:]
        used = {r.v for version in kept for r in self._parts(version).select("v").distinct().collect()}
        for version in gone:
            self._files().delete(self._path(f"log/{version:010d}.json"), False)
            self._files().delete(self._path(f"parts/v={version}"), True)
            if version not in used:
                self._files().delete(self._path(f"data/v={version}"), True)
        return gone


def land(spark: SparkSession, incoming: str, store: Store, progress: str, schema: str, parse: Callable[[DataFrame], DataFrame], form: str = "csv", most_files: int = 1000, **options) -> int:
    """Merges all files of `incoming` that were not landed before into the store, each once; the number of batches.

    `parse` makes rows of the store (source, ticker, date, ...) from a batch of file rows with the given schema. Which files have been
    read is kept in the folder `progress`, so a landing that broke off goes on where it stopped; a batch that had reached the
    store just before is known there by its number and not merged twice."""
    name = progress.rstrip("/").rpartition("/")[2]
    batches = []

    def merge(rows: DataFrame, number: int) -> None:
        batches.append(store.merge(parse(rows), origin=f"{name}:{number}"))

    stream = spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", most_files).options(**options).load(incoming)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    return len(batches)
