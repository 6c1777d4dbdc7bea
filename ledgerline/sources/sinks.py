"""Versioned table sinks.

A ``Warehouse`` is a folder of versions. ``publish`` writes every table of a
run into a fresh version folder and only then writes an append-only marker
for that version; readers take the newest marked version. So a table is never
overwritten while it is read, a failed run publishes nothing, and a rerun
after an executor or driver loss simply writes another version.

Append-only tables (the insert-only dimensions) are not rewritten per run:
each run writes only its new rows as one partition, and a reader unions the
partitions of published versions up to the one it reads. Rows of a failed,
unmarked run are never seen.

A version has one parent, the version that the run was built on, and a parent has
one marker: a file named after it, which the file system creates only if it is absent. It
names the successor and its tables. So of two publishers that start from one version the
first to create the marker wins, whatever happens between their checks; the other is told
that it lost (``Superseded``), and its tables are never read. Readers follow the markers.

Parted tables are stored in hash parts of a key. A run writes only the parts it touches; its
marker names them, and a reader takes each part from the newest version that wrote it. So the
files of other parts are neither read nor written by a change.

    <root>/versions/<version>/<table>/          snapshot tables, parquet
    <root>/appends/<table>/v=<version>/         append-only tables, one delta per run
    <root>/parts/<table>/v=<version>/_part=<k>/ parted tables, the parts a run has touched
    <root>/_published/after-<parent>            marker (one line: version, tables, parent)

A publisher that dies between creating a marker and filling it leaves an empty one. Readers
stop before it and later publishers are refused; remove it by hand.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


def new_version() -> str:
    """Sortable, unique version id."""
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ") + "-" + uuid.uuid4().hex[:6]


class Superseded(RuntimeError):
    """Another run published on the same parent first; publish again on the newest version."""


class Warehouse:
    def __init__(self, spark: SparkSession, root: str,
                 schemas: Mapping[str, StructType] | None = None,
                 append_only: Sequence[str] = (),
                 views: Mapping[str, Sequence[str]] | None = None,
                 parted: Mapping[str, tuple[str, int]] | None = None):
        """``schemas``: declared table schemas, used when reading (no inference).
        ``append_only``: tables stored as per-run deltas instead of snapshots.
        ``views``: logical tables read as the union of physical ones.
        ``parted``: table -> (key, number of hash parts); both stay as they are for the
        life of the table, which needs a declared schema."""
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas = dict(schemas or {})
        self.append_only = set(append_only)
        self.views = {k: list(v) for k, v in (views or {}).items()}
        self.parted = dict(parted or {})
        if not set(self.parted) <= set(self.schemas):
            raise ValueError("parted tables need a declared schema")

    # --- reading ---------------------------------------------------------------
    def _store(self, path: str):
        """(file system, path) of a path in the store."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def _exists(self, path: str) -> bool:
        """Whether the store has the path; any other trouble is raised."""
        fs, hadoop = self._store(path)
        return fs.exists(hadoop)

    def _markers(self) -> dict[str | None, dict]:
        """parent -> the marker of its successor; one small row per run."""
        if not self._exists(f"{self.root}/_published"):
            return {}
        rows = self.spark.read.schema("version string, tables array<string>, parent string").option(
            "mode", "FAILFAST").json(f"{self.root}/_published/after-*").collect() \
            if self._any_marker() else []
        return {r["parent"]: r.asDict() for r in rows if r["version"]}

    def _any_marker(self) -> bool:
        fs, path = self._store(f"{self.root}/_published")
        return bool(fs.listStatus(path))

    def _chain(self, upto: str | None = None) -> list[dict]:
        after, out = self._markers(), []
        at = after.get(None)
        while at is not None:
            out.append(at)
            if at["version"] == upto:
                return out
            at = after.get(at["version"])
        if upto is not None:
            raise FileNotFoundError(f"version {upto} is not published under {self.root}")
        return out

    def chain(self, upto: str | None = None) -> list[str]:
        """Published versions, oldest first, each built on the one before.

        One row per run is read; ``upto`` ends the chain at that version."""
        return [m["version"] for m in self._chain(upto)]

    def current_version(self) -> str | None:
        chain = self.chain()
        return chain[-1] if chain else None

    def table(self, name: str, version: str | None = None) -> DataFrame:
        return self._table(name, self._chain(version))

    def _table(self, name: str, chain: list[dict]) -> DataFrame:
        if name in self.views:
            parts = [self._table(p, chain) for p in self.views[name]]
            out = parts[0]
            for part in parts[1:]:
                out = out.unionByName(part)
            return out
        if name in self.append_only:
            return self._appended(name, chain)
        if name in self.parted:
            return self.read_parts(name, self.part_versions(name, chain))
        if not chain:
            raise FileNotFoundError(f"nothing published under {self.root}")
        return self.read_staged(name, chain[-1]["version"])

    def read_staged(self, name: str, version: str) -> DataFrame:
        """A snapshot table of a version that need not be published yet."""
        reader = self.spark.read
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        return reader.parquet(f"{self.root}/versions/{version}/{name}")

    def delta_path(self, name: str, version: str) -> str:
        return f"{self.root}/appends/{name}/v={version}"

    def read_delta(self, name: str, version: str) -> DataFrame:
        reader = self.spark.read
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        return reader.parquet(self.delta_path(name, version))

    def _appended(self, name: str, chain: list[dict]) -> DataFrame:
        """Union of the deltas of a chain of versions, as their markers tell."""
        schema = self.schemas.get(name)
        versions = [m["version"] for m in chain if name in (m["tables"] or [])]
        if not versions:
            if schema is None:
                raise FileNotFoundError(f"no {name} published under {self.root}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(*[self.delta_path(name, v) for v in versions])

    # --- parted tables -----------------------------------------------------------
    def part_of(self, name: str) -> Column:
        """Number of the part that a row of a parted table lies in."""
        key, parts = self.parted[name]
        return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")

    def part_versions(self, name: str, chain: list[dict]) -> dict[int, str]:
        """part -> the version that holds its rows; parts without rows are left out."""
        held: dict[int, str] = {}
        for marker in chain:
            for entry in marker["tables"] or []:
                table, _, part = entry.partition("/")
                if table != name or not part:
                    continue
                if part.endswith("/empty"):
                    held.pop(int(part.split("/")[0]), None)
                else:
                    held[int(part)] = marker["version"]
        return held

    def read_parts(self, name: str, held: Mapping[int, str]) -> DataFrame:
        schema = self.schemas[name]
        if not held:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/parts/{name}"
        full = StructType([*schema.fields, StructField("v", StringType()),
                           StructField("_part", IntegerType())])
        return self.spark.read.schema(full).option("basePath", base).parquet(
            *[f"{base}/v={v}/_part={k}" for k, v in sorted(held.items())]).select(
            *schema.fieldNames())

    def parts(self, name: str, numbers: Sequence[int], version: str | None) -> DataFrame:
        """The rows of some parts, as a version (None: before the first) holds them."""
        held = self.part_versions(name, self._chain(version)) if version else {}
        return self.read_parts(name, {k: v for k, v in held.items() if k in set(numbers)})

    def touched(self, name: str, keys: DataFrame) -> list[int]:
        """Parts that the rows of ``keys`` lie in: at most as many numbers as there are parts."""
        part = self.part_of(name).alias("p")
        return sorted(r["p"] for r in keys.select(part).distinct().collect())

    def stage_parts(self, name: str, rows: DataFrame, touched: Sequence[int] | None,
                    version: str) -> list[str]:
        """Write the parts that ``rows`` hold, which take the place of ``touched`` (None: of
        all). Returns the marker's entries.

        Rebalanced by part: small parts share a task, a part that a hot key fills is split."""
        key, parts = self.parted[name]
        path = f"{self.root}/parts/{name}/v={version}"
        (rows.select(*self.schemas[name].fieldNames()).withColumn("_part", self.part_of(name))
         .hint("rebalance", "_part").write.mode("errorifexists").partitionBy("_part")
         .parquet(path))
        fs, folder = self._store(path)
        folders = [s.getPath().getName() for s in fs.listStatus(folder)]
        full = {int(f.split("=")[1]) for f in folders if f.startswith("_part=")}
        numbers = range(parts) if touched is None else touched
        if not full <= set(numbers):
            raise ValueError(f"{name}: rows of parts that are not being replaced: "
                             f"{sorted(full - set(numbers))[:5]}")
        return [f"{name}/{k}" if k in full else f"{name}/{k}/empty" for k in numbers]

    def tables(self, names: Sequence[str], version: str | None = None) -> dict[str, DataFrame]:
        chain = self._chain(version)
        return {n: self._table(n, chain) for n in names}

    # --- writing ---------------------------------------------------------------
    def stage(self, version: str, tables: Mapping[str, DataFrame],
              partition_by: Mapping[str, Sequence[str]] | None = None,
              concurrency: int = 4) -> None:
        """Write tables into an unpublished version. For append-only tables the
        DataFrame is the delta (new rows only) and lands in its own partition.

        Independent tables are written as concurrent Spark jobs (one driver
        thread each), so small dimension writes share the cluster instead of
        running one after another. Any failure propagates; nothing is marked.
        """
        parts = partition_by or {}

        def write(item: tuple[str, DataFrame]) -> None:
            name, df = item
            if name in self.append_only:
                df.write.mode("errorifexists").parquet(self.delta_path(name, version))
                return
            w = df.write.mode("errorifexists")
            if parts.get(name):
                w = w.partitionBy(*parts[name])
            w.parquet(f"{self.root}/versions/{version}/{name}")

        items = list(tables.items())
        if concurrency <= 1 or len(items) <= 1:
            for item in items:
                write(item)
            return
        with ThreadPoolExecutor(max_workers=min(concurrency, len(items))) as pool:
            for future in [pool.submit(write, item) for item in items]:
                future.result()

    def mark(self, version: str, tables: Sequence[str], parent: str | None) -> None:
        """Make a staged version of ``tables`` visible, as the successor of ``parent``.

        The marker file is created only if ``parent`` has none yet: the file system decides,
        so there is no moment between a check and the write."""
        if self.current_version() != parent:
            raise Superseded(f"{self.root}: {parent} is not the newest version any more")
        self._create_marker(version, tables, parent)

    def _create_marker(self, version: str, tables: Sequence[str], parent: str | None) -> None:
        from py4j.protocol import Py4JJavaError

        line = json.dumps({"version": version, "tables": sorted(tables), "parent": parent})
        fs, path = self._store(f"{self.root}/_published/after-{parent or 'none'}")
        try:
            out = fs.create(path, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName() \
                    or "already exists" in str(error.java_exception.getMessage()):
                raise Superseded(f"{self.root}: another run was published on {parent} first") \
                    from error
            raise
        try:
            out.write(bytearray(line.encode()))
        finally:
            out.close()

    def publish(self, tables: Mapping[str, DataFrame],
                partition_by: Mapping[str, Sequence[str]] | None = None,
                version: str | None = None, parent: str | None = None,
                parent_known: bool = False) -> str:
        """Write all tables into a new version, then mark it published.

        A run that has read the warehouse passes the version it read as ``parent``
        (with ``parent_known``, as None is one); otherwise the newest one counts."""
        v = version or new_version()
        built_on = parent if parent_known else self.current_version()
        self.stage(v, tables, partition_by)
        self.mark(v, list(tables), built_on)
        return v

    def publish_empty(self, schemas: Mapping[str, StructType]) -> str:
        """A version holding empty tables with the declared schemas."""
        return self.publish({n: self.spark.createDataFrame([], s) for n, s in schemas.items()})


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Whole-table CSV with header, written to a new path. Quotes inside a text are
    doubled; read texts with line breaks back with ``multi_line``."""
    (df.write.mode("errorifexists").option("header", True).option("sep", sep)
     .option("escape", '"').csv(path))
