"""Versioned parquet tables with partition-level rewrites.

Plain parquet has no MERGE, and overwriting a path that the same plan reads
destroys the input.  A table is therefore laid out as

    <root>/version=<n>/<partition_col>=<value>/part-*.parquet
    <root>/_manifests/<n>.json      # live partition directories of version n

An upsert writes only the partitions it touches under a new version, then
publishes a manifest that points untouched partitions at their old
directories and touched ones at the new directories (partitions that became
empty are dropped).  The manifest write is the commit: until it lands,
readers and a retried job see the previous version.  Single writer assumed.
Old version directories no longer listed by the current manifest can be
removed with ``vacuum``.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack, contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.derived import with_digests, without_digests
from tidemart.session import shuffles_released
from tidemart.sinks import fs
from tidemart.sinks.key_index import FORM, MAX_APPENDS, KeyIndex, buckets_for
from tidemart.sinks.layout import clustered, with_comments, with_partition_column
from tidemart.sinks.observe import write_observed
from tidemart.sinks.stored import CODEC, stored


# Directory name Spark gives the partition of NULL values.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Rows of a slice, about, and slices at most: a version is written in slices of its partitions,
#: one after another, so that the shuffles of one lie on disk at a time.
SLICE_ROWS, MOST_SLICES = 1_000_000, 4


def in_partitions(column: str, values: Sequence) -> Column:
    """Rows of the given partition values; NULL is a partition like any other."""
    real = [v for v in values if v is not None]
    found = F.col(column).isin(*real) if real else F.lit(False)
    return found | F.col(column).isNull() if len(real) < len(values) else found


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: str | None = None,
                 grain: str = "day", cluster_by: Sequence[str] = (), comments: dict[str, str] | None = None,
                 counts: dict[str, Column] | None = None, maxima: Sequence[str] = (), description: str | None = None,
                 index_key: str | None = None):
        """``counts`` are sums over rows (such as failing rows of a test) and
        ``maxima`` columns whose greatest value every published version
        carries in its manifest, besides its number of rows; ``description``
        says what the table holds.  With an ``index_key`` a partitioned table
        keeps an index of that key's partitions for its upserts."""
        self.spark = spark
        self.comments = dict(comments or {})
        self.counts = {**(counts or {}), "rows": F.count(F.lit(1))}
        self.maxima = tuple(maxima)
        self.description = description
        self.index_key = index_key if partition_by else None
        self.root = root.rstrip("/")
        self.partition_by = partition_by
        self.grain = grain
        self.cluster_by = tuple(cluster_by)
        self.partition_col = None
        if partition_by:
            self.partition_col = partition_by if grain == "day" else f"{partition_by}_{grain}"

    # -- metadata ----------------------------------------------------------------
    def _manifest_dir(self) -> str:
        return f"{self.root}/_manifests"

    def versions(self) -> list[int]:
        names = fs.list_files(self.spark, self._manifest_dir())
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def exists(self) -> bool:
        return self.current_version() is not None

    def manifest(self, version: int | None = None) -> dict:
        version = self.current_version() if version is None else version
        if version is None:
            return {"version": None, "paths": {}}
        return json.loads(fs.read_text(self.spark, f"{self._manifest_dir()}/{version}.json"))

    def observed(self) -> dict[str, int]:
        """Values of ``counts`` over the current version, from its manifest; {} if it was published with others."""
        found = self.manifest().get("counts", {})
        return found if set(found) == set(self.counts) else {}

    def maximum(self, column: str) -> dt.datetime | dt.date | None:
        """Greatest value of a date or timestamp column of the current version,
        from its manifest if it has it (no row is read), else from the rows."""
        m = self.manifest()
        if column not in m.get("maxima", {}):
            return self.read().agg(F.max(column)).first()[0]
        text = m["maxima"][column]
        fields = {f["name"]: f["type"] for f in json.loads(m["schema"])["fields"]}
        kind = dt.date if fields[column] == "date" else dt.datetime
        return None if text is None else kind.fromisoformat(text)

    def _publish(self, version: int, paths: dict[str, str], schema_json: str, facts: dict) -> None:
        body = json.dumps({"version": version, "paths": paths, "schema": schema_json, **facts,
                           "description": self.description}, sort_keys=True)
        fs.write_text(self.spark, f"{self._manifest_dir()}/{version}.json", body)

    # -- read ----------------------------------------------------------------------
    def read(self) -> DataFrame:
        """Current version as one DataFrame (partition filters still prune:
        the live directories are listed with ``basePath`` = table root)."""
        m = self.manifest()
        if m["version"] is None:
            raise FileNotFoundError(f"no published version under {self.root}")
        paths = sorted(set(m["paths"].values()))
        from pyspark.sql.types import IntegerType, StructType

        schema = StructType.fromJson(json.loads(m["schema"]))
        if not paths:
            return self.spark.createDataFrame([], schema)
        plain = StructType([f for f in schema.fields if f.name != self.partition_col])
        plain = plain.add("version", IntegerType())
        if self.partition_col:
            plain = plain.add(self.partition_col, schema[self.partition_col].dataType)
        df = self.spark.read.schema(plain).option("basePath", self.root).parquet(*paths)
        cols = [c for c in df.columns if c != "version"]
        df = df.select(*cols)
        if self.partition_col and self.partition_col in df.columns:
            # partition discovery infers the type from the directory name;
            # restore the type the table was written with
            ptype = schema[self.partition_col].dataType
            df = df.withColumn(self.partition_col, F.col(self.partition_col).cast(ptype))
        return df.select(*[f.name for f in schema.fields])

    # -- write ---------------------------------------------------------------------
    def _prepare(self, df: DataFrame) -> DataFrame:
        if self.partition_by and self.partition_col not in df.columns:
            df, _ = with_partition_column(df, self.partition_by, self.grain)
        if self.comments:
            df = with_comments(df, self.comments)
        return df

    def _facts(self) -> dict[str, Column]:
        """All aggregates of a version; maxima as text, whose order is that of the dates."""
        return {**self.counts, **{f"max {c}": F.max(c).cast("string") for c in self.maxima}}

    def _sorted(self, found: dict) -> dict:
        return {"counts": {k: int(found[k] or 0) for k in self.counts}, "maxima": {c: found[f"max {c}"] for c in self.maxima}}

    def _measured(self, df: DataFrame) -> dict:
        row = df.agg(*[c.alias(f"v{i}") for i, c in enumerate(self._facts().values())]).first()
        return self._sorted(dict(zip(self._facts(), row)))

    def slices(self, rows: DataFrame) -> list[list]:
        """The partition values of ``rows`` in order, NULL first, in groups of
        about as many rows each; one group if the rows are few."""
        found = rows.groupBy(self.partition_col).count().collect()  # bounded by the calendar
        n = min(MOST_SLICES, -(-sum(r[1] for r in found) // SLICE_ROWS))
        out, filled, most = [[]], 0, sum(r[1] for r in found) / max(n, 1)
        for value, count in sorted(map(tuple, found), key=lambda r: (r[0] is not None, r[0])):
            if out[-1] and filled + count / 2 > most * len(out) and len(out) < n:
                out.append([])
            out[-1].append(value)
            filled += count
        return out

    def _clustered(self, df: DataFrame) -> DataFrame:
        """Surrogate keys that a row's ids give are left out of the shuffle."""
        keys = [*([self.partition_col] if self.partition_col else []), *self.cluster_by]
        if not keys:
            return df
        return with_digests(clustered(without_digests(df, keep=keys), self.partition_col, self.cluster_by), df.schema)

    def _write_version(self, parts: Sequence[DataFrame], version: int) -> tuple[dict[str, str], dict]:
        """Directories of the written partitions, and the facts of the written
        rows.  The rows are those of all ``parts``, written one after another."""
        vdir = f"{self.root}/version={version}"
        by = [self.partition_col] if self.partition_col else []
        facts: dict = {}
        for i, df in enumerate(parts):
            def write(out: DataFrame, mode: str = "append" if i else "overwrite") -> None:
                out.write.mode(mode).option("compression", CODEC).partitionBy(*by).parquet(vdir)

            with shuffles_released(self.spark):
                found = self._sorted(write_observed(self._clustered(df), write, self._facts()))
            facts = self._added(facts, found) if i else found
        if not by:
            return {"": vdir}, facts
        return {
            unquote(name.split("=", 1)[1]): f"{vdir}/{name}"
            for name in fs.list_dirs(self.spark, vdir)
            if name.startswith(f"{self.partition_col}=")
        }, facts

    @staticmethod
    def _added(a: dict, b: dict) -> dict:
        """Facts of the rows of both; the order of maxima as text is that of the dates."""
        return {"counts": {k: n + b["counts"][k] for k, n in a["counts"].items()},
                "maxima": {c: max(filter(None, (v, b["maxima"][c])), default=None) for c, v in a["maxima"].items()}}

    def overwrite(self, df: DataFrame, unique_key: str | None = None, stored: bool = False,
                  written: Callable[[], None] = lambda: None) -> int:
        """Full rewrite as a new version (first run or full refresh).  With a
        ``unique_key`` the written rows are checked before they are published.
        Rows that are ``stored``, so that it is cheap to read them more than
        once, are written in slices of partitions.  ``written`` is called when
        ``df`` is read no more."""
        from tidemart.operators.upsert import assert_unique_keys

        df = self._prepare(df)
        version = (self.current_version() or 0) + 1
        slices = self.slices(df) if stored and self.partition_col else []
        parts = [df.filter(in_partitions(self.partition_col, values)) for values in slices] if len(slices) > 1 else [df]
        paths, facts = self._write_version(parts, version)
        written()
        if unique_key:
            rows = self.spark.read.schema(df.schema).parquet(f"{self.root}/version={version}")
            with shuffles_released(self.spark):
                assert_unique_keys(rows, unique_key)
        if self.index_key:
            rows = self.spark.read.schema(df.schema).parquet(f"{self.root}/version={version}")
            index = self._new_index(self.index_key, version, facts["counts"]["rows"])
            index.add(rows)
            facts["keys"] = index.facts()
        self._publish(version, paths, df.schema.json(), facts)
        return version

    def _new_index(self, key: str, version: int, rows: int) -> KeyIndex:
        """An empty index of a version; what a failed run left in its place is removed."""
        path = f"{self.root}/keys/{version}"
        fs.delete(self.spark, path)
        return KeyIndex(self.spark, path, key, self.partition_col, buckets_for(rows))

    def key_index(self, key: str) -> KeyIndex | None:
        """The current version's index of ``key``; a table that should have one
        and was published without gets it now, from its key and partition columns."""
        if key != self.index_key:
            return None
        current = self.manifest()
        found = current.get("keys")
        version = current["version"] + 1
        if found and found["key"] == key and found.get("form") == FORM and fs.exists(self.spark, found["path"]):
            index = KeyIndex(self.spark, found["path"], key, self.partition_col, found["buckets"], found["appends"])
            if index.appends < MAX_APPENDS:
                return index
            fs.delete(self.spark, f"{self.root}/keys/{version}")
            return index.compacted(f"{self.root}/keys/{version}")
        index = self._new_index(key, version, current.get("counts", {}).get("rows", 0))
        index.add(self.read())
        return index

    def replace_partitions(self, df: DataFrame | Sequence[DataFrame], touched: Sequence, index: KeyIndex | None = None) -> int:
        """Publish a new version where every partition value in ``touched``
        is replaced by the rows of ``df`` (which must hold the complete new
        content of exactly those partitions; several are written in turn).  The version's counts are those
        before, less those of the replaced partitions, plus those of the rows
        written: only the replaced partitions are read for them.  ``index``
        holds the keys of ``df`` already; without it the version has none."""
        if not self.partition_col:
            return self.overwrite(df)
        parts = [self._prepare(part) for part in ([df] if isinstance(df, DataFrame) else df)]
        df = parts[0]
        current = self.manifest()
        version = (current["version"] or 0) + 1
        text = [r[0] for r in self.spark.createDataFrame([(v,) for v in touched], df.select(self.partition_col).schema)
                .select(F.col(self.partition_col).cast("string")).collect()] if touched else []
        touched_keys = {NULL_PARTITION if v is None else v for v in text}
        if not touched_keys:
            self._publish(version, current["paths"], df.schema.json(),
                          {k: current[k] for k in ("counts", "maxima", "keys") if k in current})
            return version
        old = self.read()
        gone = in_partitions(self.partition_col, touched)
        new_paths, written = self._write_version(parts, version)
        facts = self._replaced(old, gone, current, written)
        paths = {k: v for k, v in current["paths"].items() if k not in touched_keys}
        stray = set(new_paths) - touched_keys
        if stray:
            raise ValueError(f"rows for partitions that are not replaced: {sorted(stray)[:5]}")
        paths.update(new_paths)
        if index:
            facts["keys"] = index.facts()
        self._publish(version, paths, df.schema.json(), facts)
        return version

    def _replaced(self, old: DataFrame, gone: Column, current: dict, written: dict) -> dict:
        """Facts of the next version.  A maximum that may have left with the
        replaced partitions is looked up in those that stay."""
        counts, maxima = current.get("counts", {}), current.get("maxima", {})
        if set(counts) != set(self.counts) or set(maxima) != set(self.maxima):  # published by an earlier definition
            return self._added(self._measured(old.filter(~F.coalesce(gone, F.lit(False)))), written)
        left = self._measured(old.filter(gone))
        out = {"counts": {k: n - left["counts"][k] + written["counts"][k] for k, n in counts.items()}, "maxima": {}}
        for c, before in maxima.items():
            new, lost = written["maxima"][c], left["maxima"][c]
            if before is None or (new is not None and new >= before):
                out["maxima"][c] = new
            elif lost is None or lost < before:
                out["maxima"][c] = before
            else:
                rest = old.filter(~F.coalesce(gone, F.lit(False))).agg(F.max(c).cast("string")).first()[0]
                out["maxima"][c] = max(filter(None, (rest, new)), default=None)
        return out

    def vacuum(self, keep_versions: int = 2, keep_hours: float = 0) -> list[str]:
        """Remove the directories that no kept manifest lists: whole versions,
        and single partitions of a version that is still in use.  The last
        ``keep_versions`` manifests are kept, and so is every version that was
        current within the last ``keep_hours`` (a reader may still be on it).
        Listing and deletes only; no data is read."""
        versions = self.versions()
        published = fs.modified(self.spark, self._manifest_dir())
        horizon = (time.time() - keep_hours * 3600) * 1000
        keep = set(versions[-max(keep_versions, 1):])
        for v, successor in zip(versions, versions[1:]):
            if published[f"{successor}.json"] >= horizon and keep_hours > 0:
                keep.add(v)
        live = {p.rsplit("/version=", 1)[1] for v in keep for p in self.manifest(v)["paths"].values()}
        in_use = {p.split("/", 1)[0] for p in live}
        removed = []
        for name in fs.list_dirs(self.spark, self.root):
            if not name.startswith("version="):
                continue
            n = name.split("=", 1)[1]
            if n.isdigit() and versions and int(n) > versions[-1]:
                continue  # being written
            if n not in in_use:
                removed.append(name)
            elif self.partition_col and n not in live:
                removed += [f"{name}/{part}" for part in fs.list_dirs(self.spark, f"{self.root}/{name}")
                            if part.startswith(f"{self.partition_col}=") and f"{n}/{part}" not in live]
        for v in versions:  # manifests first: a manifest never lists what is gone
            if v not in keep:
                fs.delete(self.spark, f"{self._manifest_dir()}/{v}.json")
        kept = {m["keys"]["path"].rsplit("/", 1)[1] for m in map(self.manifest, sorted(keep)) if "keys" in m}
        removed += [f"keys/{n}" for n in fs.list_dirs(self.spark, f"{self.root}/keys")
                    if n not in kept and versions and int(n) <= versions[-1]]
        for name in removed:
            fs.delete(self.spark, f"{self.root}/{name}")
        return removed


def upsert_partitions(
    table: VersionedTable,
    source: DataFrame,
    key: str,
    update_columns: Sequence[str] | None = None,
    touched_out: list | None = None,
) -> int:
    """MERGE ``source`` into a partitioned versioned table, rewriting only
    the partitions the source touches (their values are appended to
    ``touched_out`` when given, for downstream incremental work).

    The touched partition values are found in the table's key index, or else
    from the target's key and partition columns; the merge then reads just
    those partitions (partition pruning) and the new version replaces them.
    """
    from tidemart.operators.upsert import assert_unique_keys, merge_frames, touched_partitions

    if not table.exists():
        return table.overwrite(source)
    if not table.partition_col:
        src = table._prepare(source)
        assert_unique_keys(src, key)
        return table.overwrite(merge_frames(table.read(), src, key, update_columns))
    # The batch is used three times (duplicate check, touched partitions,
    # merge): it is stored once in the shared folder, which also cuts its
    # lineage back to the raw tables.
    with stored(table._prepare(source), "batch") as src, shuffles_released(table.spark):
        assert_unique_keys(src, key)
        target = table.read()
        part = table.partition_col
        index = table.key_index(key)
        touched = index.upsert(src) if index else touched_partitions(target, src, key, part)
        if touched_out is not None:
            touched_out.extend(touched)
        if not touched:
            return table.current_version()
        affected = target.filter(in_partitions(part, touched))
        batch = src.select(*target.columns)
        with _merged(table, affected, batch, key, update_columns) as merged:
            return table.replace_partitions(merged, touched, index)


@contextmanager
def _merged(table: VersionedTable, affected: DataFrame, batch: DataFrame, key: str,
            update_columns: Sequence[str] | None) -> Iterator[list[DataFrame]]:
    """The rows of ``affected`` with ``batch`` merged into them.  Many are merged
    in slices of their partitions: each has its rows, changed or not, and what
    no slice has a key for comes last."""
    from tidemart.operators.upsert import merge_frames

    part = table.partition_col
    # the partition column of a row follows its merged partition source value
    placed = ((lambda df: df.withColumn(part, F.trunc(F.col(table.partition_by), table.grain)))
              if table.partition_by and table.grain != "day" else lambda df: df)
    slices = table.slices(affected)
    if len(slices) == 1:
        yield [placed(merge_frames(affected, batch, key, update_columns))]
        return
    with ExitStack() as stack:
        parts, new = [], batch
        for values in slices:
            own = affected.filter(in_partitions(part, values))
            parts.append(placed(merge_frames(own, batch, key, update_columns, insert=False)))
            new = stack.enter_context(stored(new.join(own.select(key), key, "left_anti").select(*batch.columns), "new-rows"))
        yield [*parts, placed(new)]
