"""Index of a table's keys: a narrow bucketed table (key, partition).

An upsert asks it which partitions hold the keys of its batch.  The index is
written bucketed by key, so the join shuffles the batch's keys only, into the
index's buckets; neither the table nor the index is shuffled.

Entries are only ever added, and before the version that needs them is
published.  So the index lists every partition that a key is in, and may list
some that it has left or that a failed run was about to write: these are
rewritten once more than needed, with the same rows.  ``compacted`` merges the
small files of many runs into new ones.

Long text keys are listed by a 64-bit hash.  Keys that share one are listed as
being in each other's partitions, which are then rewritten once more than needed.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import shuffles_released
from tidemart.sinks import fs
from tidemart.sinks.stored import CODEC, stored

#: Keys in a bucket, on average.
BUCKET_KEYS = 5_000_000
#: Runs whose entries are added as files of their own before the index is written anew.
MAX_APPENDS = 16


#: Text keys beyond this length are listed by their hash, in hex of this length at most.
KEY_LENGTH = 16
#: Form of the entries; an index in another one is not used.
FORM = "hash"


def buckets_for(rows: int) -> int:
    """A power of two that leaves about BUCKET_KEYS keys in a bucket, 8 at least."""
    return max(8, 1 << max(rows // BUCKET_KEYS, 1).bit_length())


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, key: str, partition_col: str, buckets: int, appends: int = 0):
        self.spark, self.path, self.key, self.partition_col = spark, path, key, partition_col
        self.buckets, self.appends = buckets, appends

    def facts(self) -> dict:
        """What the table's manifest keeps of the index."""
        return {"path": self.path, "key": self.key, "buckets": self.buckets, "appends": self.appends, "form": FORM}

    def _listed(self, rows: DataFrame) -> Column:
        """The key of ``rows`` as the index has it; a listed one stays as it is."""
        key = F.col(self.key)
        if rows.schema[self.key].dataType.simpleString() != "string":
            return key
        return F.when(F.length(key) <= KEY_LENGTH, key).otherwise(F.hex(F.xxhash64(key))).alias(self.key)

    def add(self, rows: DataFrame) -> None:
        """Add the keys and partitions of ``rows``; a null key is in no index."""
        entries = rows.filter(F.col(self.key).isNotNull()).select(self._listed(rows), self.partition_col)
        entries = entries.repartition(self.buckets, self.key).distinct()  # one shuffle serves both, and the buckets
        with self._table(entries if not fs.exists(self.spark, self.path) else None) as name, shuffles_released(self.spark):
            (entries.write.mode("append").format("parquet").option("path", self.path).option("compression", CODEC)
             .bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(name))

    @contextmanager
    def _table(self, first: DataFrame | None = None):
        """Name under which the session knows the index while it is used.  The
        files stay when the name goes.  ``first`` rows are written to a new index."""
        name = f"key_index_{uuid.uuid4().hex}"
        try:
            if first is None:
                schema = self.spark.read.parquet(self.path).schema
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
                self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                               f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
            yield name
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    @contextmanager
    def entries(self):
        """The index as a DataFrame that Spark knows to be bucketed by key."""
        with self._table() as name:
            yield self.spark.table(name)

    def matches(self, entries: DataFrame, source: DataFrame) -> DataFrame:
        """Entries whose key is in ``source``."""
        return entries.join(source.select(self._listed(source)), self.key, "left_semi")

    def upsert(self, source: DataFrame) -> list:
        """Partitions that an upsert of ``source`` rewrites: those of its keys
        and its own.  The source's new entries are added to the index."""
        with shuffles_released(self.spark), self.entries() as entries:
            own = source.select(self._listed(source), self.partition_col)
            parts = self.matches(entries, source).select(self.partition_col).union(own.select(self.partition_col)).distinct()
            touched = [r[0] for r in parts.collect()]  # bounded by the calendar
            e, s = entries.alias("e"), own.alias("s")
            known = (F.col(f"e.{self.key}") == F.col(f"s.{self.key}")) & F.col(f"e.{self.partition_col}").eqNullSafe(F.col(f"s.{self.partition_col}"))
            with stored(s.join(e, known, "left_anti"), "fresh-keys") as fresh:  # reads the index: done before files are added to it
                if fresh.limit(1).count():
                    self.add(fresh)
                    self.appends += 1
        return touched

    def compacted(self, path: str) -> KeyIndex:
        """The same entries in new files, each once."""
        out = KeyIndex(self.spark, path, self.key, self.partition_col, self.buckets)
        with self.entries() as entries:
            out.add(entries)
        return out
