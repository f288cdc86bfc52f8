"""K1/K2 sinks and K6 write metrics.

A merge reads the current table and writes the merged result; writing
over the folder being read is unsafe, so every write goes to a new
version folder and only then is the table's pointer moved.  A crash
between the two leaves the previous version current.  The row count of
a write is observed during the write itself (no second scan).

A stream does not rewrite its table per batch: :class:`Batches` appends
each batch's rows under ``batch=<id>`` (a replayed batch overwrites its
own folder), readers combine them with the table's current version, and a
separate compaction folds them into a new version.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefeed.operators.merge import INSERTED, UNCHANGED, UPDATED, check_table_name

POINTER = "_current"


def stored(df: DataFrame) -> DataFrame:
    """Materialize ``df`` once as a table in the shared checkpoint folder.

    Used where one plan reads the same intermediate table several times
    (as the source system re-reads its stored tables): later readers scan
    the stored copy instead of recomputing it, and lineage is cut, so an
    executor loss never reruns the upstream pipeline.
    """
    from linefeed.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def count_rows(df: DataFrame, table: str) -> DataFrame:
    """A1: ``(table_name, rows)`` of a frame, as a one-row aggregate (partial per task)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(check_table_name(table)).alias("table_name"), "rows")


def write_observed(df: DataFrame, path: str, table: str, mode: str = "errorifexists",
                   fmt: str = "parquet", options: Mapping[str, str] | None = None) -> DataFrame:
    """Write ``df`` and return K6's one-row result ``(table_name, rows)``."""
    check_table_name(table)
    obs = Observation(f"write_{table}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).options(**(options or {})).mode(mode).save(path)
    rows = obs.get.get("rows", 0)
    return df.sparkSession.createDataFrame([(table, int(rows))], "table_name string, rows bigint")


def counted_source(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """``rows`` with K6's source row count observed while they are read."""
    obs = Observation("source_rows")
    return rows.observe(obs, F.count(F.lit(1)).alias("rows")), obs


DID = "__did"


def counted_merge(merged: DataFrame, did: str = DID) -> tuple[DataFrame, Observation]:
    """A flagged merge result without its flag; the rows of each kind are observed while it is written."""
    obs = Observation("merged_rows")
    kinds = [F.count(F.when(F.col(did) == kind, 1)).alias(kind) for kind in (INSERTED, UPDATED, UNCHANGED)]
    return merged.observe(obs, *kinds).drop(did), obs


class VersionedTable:
    """A parquet table whose versions live in ``<root>/v=<n>`` behind a pointer file.

    Small files (the pointer, notes) are read and written with Hadoop's file
    system of the session: a temporary file is renamed into place, so a
    reader sees the old or the new content.  One writer at a time per table
    (a job or a stream); readers may run at any time and always see a
    complete version.  A commit keeps the version before it for readers that
    still use it and removes older ones.
    """

    KEPT_VERSIONS = 2

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name = spark, root.rstrip("/"), check_table_name(name)

    def _hadoop(self, name: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path, jvm

    def read_note(self, name: str) -> str | None:
        """A one-line note stored next to the versions (None if absent)."""
        fs, path, jvm = self._hadoop(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return str(jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream).decode())
        finally:
            stream.close()

    def write_note(self, name: str, text: str) -> None:
        """Write a note: a temporary file first, then renamed over the old one."""
        fs, path, jvm = self._hadoop(name)
        tmp = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}.tmp")
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            path.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(context.makeQualified(tmp), context.makeQualified(path), options)

    def version(self) -> int | None:
        """The committed version from the one-line pointer file (None before the first)."""
        text = self.read_note(POINTER)
        return None if text is None else int(text.strip())

    def current(self) -> DataFrame | None:
        v = self.version()
        return None if v is None else self.spark.read.parquet(f"{self.root}/v={v}")

    def commit(self, df: DataFrame, version: int | None = None,
               source: Observation | None = None, folded: int | None = None,
               options: Mapping[str, str] | None = None) -> DataFrame:
        """Write ``df`` as the next version (or ``version``), then move the pointer.

        Returns K6's ``(table_name, rows)``: the rows of ``source``, if given
        (what the merge was asked to write), else those of the whole table.
        ``folded`` notes the last appended batch that ``df`` includes,
        ``options`` are the Parquet writer's.
        """
        current = self.version()
        new = version if version is not None else (current + 1 if current is not None else 0)
        if current is not None and new <= current:
            # replaying an already committed batch: nothing to do (idempotent)
            return self.spark.createDataFrame([(self.name, 0)], "table_name string, rows bigint")
        before = self.folded()
        metrics = write_observed(df, f"{self.root}/v={new}", self.name, mode="overwrite", options=options)
        self.write_note(f"{FOLDED}{new}", str(before if folded is None else folded))
        self.write_note(POINTER, str(new))
        self._expire(new)
        if source is None:
            return metrics
        return self.spark.createDataFrame([(self.name, int(source.get.get("rows", 0)))],
                                          "table_name string, rows bigint")

    def folded(self) -> int:
        """The last appended batch included in the current version (-1: none)."""
        v = self.version()
        note = self.read_note(f"{FOLDED}{v}") if v is not None else None
        return int(note) if note else -1

    def _expire(self, newest: int) -> None:
        fs, path, jvm = self._hadoop("")
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            for prefix in ("v=", FOLDED):
                number = name.removeprefix(prefix)
                if name.startswith(prefix) and number.isdigit() and int(number) <= newest - self.KEPT_VERSIONS:
                    fs.delete(status.getPath(), True)


FOLDED = "_folded_"


class Batches:
    """Rows that a stream appends beside a table, one folder per micro-batch."""

    def __init__(self, table: VersionedTable, name: str):
        self.table, self.name, self.path = table, name, f"{table.root}/{name}"

    def append(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Write a batch; written again, it replaces itself.  Returns the rows written."""
        path = f"{self.path}/batch={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        return self.table.spark.read.schema(rows.schema).parquet(path)

    def read(self, schema: T.StructType, after: int = -1, before: int | None = None) -> DataFrame:
        """All batches after one and before another, with their number in ``batch``."""
        spark = self.table.spark
        full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        try:
            rows = spark.read.schema(full).option("basePath", self.path).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = spark.createDataFrame([], full)
        rows = rows.filter(F.col("batch") > after)
        return rows if before is None else rows.filter(F.col("batch") < before)

    def expire(self, upto: int) -> None:
        """Remove the batches up to this one; they are folded into a version that no reader goes behind."""
        fs, path, _ = self.table._hadoop(self.name)
        for status in fs.listStatus(path) if fs.exists(path) else []:
            number = status.getPath().getName().removeprefix("batch=")
            if number.isdigit() and int(number) <= upto:
                fs.delete(status.getPath(), True)

    def last(self) -> int:
        """The largest batch number present (-1: none)."""
        fs, path, _ = self.table._hadoop(self.name)
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return max((int(n.removeprefix("batch=")) for n in names if n.removeprefix("batch=").isdigit()), default=-1)
