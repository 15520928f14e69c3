"""Versioned Parquet tables with a pointer log, so a set of tables is published at once.

Layout under ``root``::

    _tables/                 pointer log (table, version, path, published_at)
    <table>/v000000-<id>/    one directory per version

A table may be published part by part (``publish(parts=...)``, as the fact is by
month): each part has a pointer of its own, so a batch replaces the parts it
touches and leaves the files of the others alone. A column named ``layout_...``
only lays a table out in folders; ``read`` hides it.

Append-only tables (raw, rejects, run events, staging between transforms)
append into their current version. Replacing tables are written to a fresh
version directory first; one append of their pointer rows then publishes
them together, so readers never see half of a transform. A version that was
written but not registered is ignored. Single writer per table root.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import list_folder, path_exists, shuffles_freed

POINTER_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("published_at", T.TimestampType(), False),
        T.StructField("part", T.StringType(), True),  # null: the whole table
    ]
)
LAYOUT = "layout_"
PART = f"{LAYOUT}part"
CODEC = "zstd"  # of every table, whatever the session's default


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._published: dict[str, dict[str | None, tuple[int, str]]] | None = None

    # -- pointers -----------------------------------------------------------------
    def _pointers(self) -> DataFrame | None:
        path = f"{self.root}/_tables"
        return self.spark.read.schema(POINTER_SCHEMA).parquet(path) if path_exists(self.spark, path) else None

    def _load_published(self) -> dict[str, dict[str | None, tuple[int, str]]]:
        """Latest (version, path) per table and part: aggregated in Spark, one row per pointer in force."""
        pointers = self._pointers()
        if pointers is None:
            return {}
        latest = pointers.groupBy("table", "part").agg(F.max_by(F.struct("version", "path"), "version").alias("p"))
        out: dict[str, dict[str | None, tuple[int, str]]] = {}
        for r in latest.collect():
            out.setdefault(r["table"], {})[r["part"]] = (r["p"]["version"], r["p"]["path"])
        return out

    def refresh(self) -> None:
        """Forget the cached pointers (another writer may have published)."""
        self._published = None

    def pointers(self, table: str) -> dict[str | None, tuple[int, str]]:
        """(version, path) per part; the key None is the whole table. The pointer log is read once per
        Store and kept in step with this (single) writer's own publishes."""
        if self._published is None:
            self._published = self._load_published()
        return self._published.get(table, {})

    def current(self, table: str) -> tuple[int, str] | None:
        """(version, path) of the published version of a table that is published whole."""
        return self.pointers(table).get(None)

    def _register(self, entries: list[tuple[str, int, str]], parts: Sequence[tuple[str, int, str, str]] = ()) -> None:
        now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        all_entries = [*[(t, v, p, None) for t, v, p in entries], *parts]
        rows = [(t, v, p, now, part) for t, v, p, part in all_entries]
        self.spark.createDataFrame(rows, POINTER_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.root}/_tables"
        )
        if self._published is not None:
            for t, v, p, part in all_entries:
                self._published.setdefault(t, {})[part] = (v, p)

    def version_path(self, table: str, version: int) -> str:
        """A folder of its own for every attempt: what a crashed write left behind is never part of a table."""
        return f"{self.root}/{table}/v{version:06d}-{uuid.uuid4().hex[:12]}"

    # -- reads --------------------------------------------------------------------
    def exists(self, table: str) -> bool:
        return bool(self.pointers(table))

    def layout(self, table: str) -> list[str]:
        """``name=value`` folders of a table's current version: how its rows are laid out (none: plainly)."""
        cur = self.current(table)
        names = [path.rstrip("/").rpartition("/")[2] for path, _ in list_folder(self.spark, cur[1])] if cur else []
        return sorted(n for n in names if "=" in n)

    def read(
        self, table: str, schema: T.StructType | None = None, parts: list[str] | None = None, with_layout: bool = False
    ) -> DataFrame | None:
        """The published rows, or None when the table does not exist or was created and never written
        (or an empty frame with ``schema`` when one is given).

        ``parts`` reads those parts of a table published part by part, and no file of the others.
        """
        pointers = self.pointers(table)
        paths = [p for part, (_, p) in sorted(pointers.items(), key=str) if part is not None and (parts is None or part in parts)]
        if None in pointers and path_exists(self.spark, pointers[None][1]):
            paths = [pointers[None][1]]
        if not paths:
            return None if schema is None else self.spark.createDataFrame([], schema)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.parquet(*paths)
        return df if with_layout else df.drop(*[c for c in df.columns if c.startswith(LAYOUT)])

    # -- writes -------------------------------------------------------------------
    def append(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        """Append rows to the current version (creating version 0 on first use).

        ``partition_by`` lays rows out in ``col=value`` directories, so readers
        filtering on those columns only list and read matching directories. The
        first append counts once its pointer is registered, a later one once its
        job commits; before that, readers see nothing of it.
        """
        cur = self.current(table)
        path = self.version_path(table, 0) if cur is None else cur[1]
        writer = df.write.mode("append").option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with shuffles_freed(df.sparkSession):
            writer.parquet(path)
        if cur is None:
            self._register([(table, 0, path)])

    def create(self, table: str, schema: T.StructType, partitioned: bool = False, layout: str | None = None) -> None:
        """Idempotent creation of an empty table (no-op when it exists).

        Of a table that will be appended to in partitions only the pointer is
        written (a file without partitions would not fit beside them), or, with
        a ``layout`` column, an empty file in a folder of its own.
        """
        if self.exists(table):
            return
        path = self.version_path(table, 0)
        if layout:
            self.spark.createDataFrame([], schema).write.parquet(f"{path}/{layout}=none")
        if layout or partitioned:
            self._register([(table, 0, path)])
        else:
            self.append(table, self.spark.createDataFrame([], schema))

    def _write_version(self, table: str, df: DataFrame, by: list[str]) -> tuple[int, str]:
        version = 1 + max((v for v, _ in self.pointers(table).values()), default=-1)
        path = self.version_path(table, version)
        writer = df.write.option("compression", CODEC)
        with shuffles_freed(df.sparkSession):
            (writer.partitionBy(*by) if by else writer).parquet(path)
        return version, path

    def publish(self, frames: dict[str, DataFrame], parts: dict[str, tuple[DataFrame, Column]] | None = None) -> dict[str, str]:
        """Write each frame to a new version, then register all of them in one append.

        ``parts`` holds frames with the text column that deals their rows to
        parts: only the parts that a frame has rows of are replaced. A table laid
        out in folders stays so.
        """
        entries: list[tuple[str, int, str]] = []
        written: list[tuple[str, int, str, str]] = []
        for table, df in frames.items():
            by = list(dict.fromkeys(n.partition("=")[0] for n in self.layout(table)))
            version, path = self._write_version(table, df, [c for c in by if c in df.columns])
            entries.append((table, version, path))
        for table, (df, part) in (parts or {}).items():
            if self.current(table):
                raise ValueError(f"{table} is published whole; it cannot be published part by part")
            # rows of a part go together, and adaptive execution splits a part that is large
            dealt = df.withColumn(PART, F.coalesce(part, F.lit("none"))).hint("rebalance", PART)
            version, path = self._write_version(table, dealt, [PART])
            folders = [p.rstrip("/") for p, _ in list_folder(self.spark, path) if f"/{PART}=" in p]
            written += [(table, version, p, p.rpartition("=")[2]) for p in folders]
        if entries or written:
            self._register(entries, written)
        return {t: p for t, _, p in entries}

    def compact(self, table: str, partitions: int | None = None) -> str | None:
        """Rewrite an append-only table's many small files into a new version.

        Appends (ledger events, per-run staging and reject batches) add files every
        run; this folds them into ``partitions`` files (default: Spark's choice
        after AQE coalescing) and publishes the result like any other version. A
        table published part by part has the files of its last writes only.
        """
        df = self.read(table, with_layout=True)
        if df is None or not self.current(table):
            return None
        out = df.repartition(partitions) if partitions else df
        return self.publish({table: out})[table]
