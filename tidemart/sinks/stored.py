"""Rows that several jobs read, kept in the shared folder while they do."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from tidemart.functions.derived import with_digests, without_digests
from tidemart.session import scratch_path, shuffles_released
from tidemart.sinks import fs

#: Compression of intermediate tables and published versions.
CODEC = "zstd"


def store(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back: computed once, its lineage cut."""
    narrow = without_digests(df)
    with shuffles_released(df.sparkSession):
        narrow.write.option("compression", CODEC).parquet(path)
    return with_digests(df.sparkSession.read.schema(narrow.schema).parquet(path), df.schema)


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``store`` for the length of the block; then the files go."""
    path = scratch_path(df.sparkSession, name)
    try:
        yield store(df, path)
    finally:
        fs.delete(df.sparkSession, path)
