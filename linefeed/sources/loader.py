"""File sources dispatched by suffix, path templates, SQL."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Suffixes the source system accepts, per reader.
EXCEL_SUFFIXES = (".xlsx", ".xlsm")
LEGACY_SUFFIX = ".xls"
PARQUET_SUFFIXES = (".parquet",)
CSV_SUFFIXES = (".csv", ".txt")


SPREAD_MAX = 64
SPREAD_MIN_BYTES = 1 << 20


def _input_bytes(df: DataFrame) -> int | None:
    """Total size of the files behind a scan (None when unknown or many files)."""
    files = df.inputFiles()
    if not files or len(files) > SPREAD_MAX:
        return None
    try:
        import pyarrow.fs as pafs
        total = 0
        for uri in files:
            path = "/" + uri[len("file:"):].lstrip("/") if uri.startswith("file:") else uri
            fs, p = pafs.FileSystem.from_uri(path)
            total += fs.get_file_info(p).size or 0
        return total
    except Exception:  # file system without a pyarrow client: size unknown
        return None


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give a scan with too few splits one partition per core (at most 64).

    A file written as a single row group (or an unsplittable file) is read
    by one task however many cores exist; a round-robin repartition spreads
    it.  Such an input is at most one split (~128 MB), so 64 parts are
    plenty even on a large cluster.  Scans that already have enough splits
    (every large input) and inputs under 1 MiB (a shuffle would cost more
    than it saves) are returned unchanged.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # Spark Connect exposes no RDDs: leave the scan as planned
        return df
    target = min_partitions or min(cores, SPREAD_MAX)
    if splits >= target:
        return df
    size = _input_bytes(df)
    if size is not None and size < SPREAD_MIN_BYTES:
        return df
    return df.repartition(target)


def resolve_path(template: str, values: Mapping[str, str]) -> str:
    """Fill ``{name}`` placeholders from ``values``; a missing name is an error."""
    names = {f[1] for f in string.Formatter().parse(template) if f[1]}
    missing = sorted(names - set(values))
    if missing:
        raise KeyError(f"no value for path placeholders {missing}")
    return template.format(**values)


def suffix_of(path: str) -> str:
    base = path.rstrip("/").rsplit("/", 1)[-1]
    return "." + base.rsplit(".", 1)[-1].lower() if "." in base else ""


def is_workbook(path: str) -> bool:
    """Whether a path names a workbook; a legacy binary one cannot be decoded here and raises."""
    ext = suffix_of(path)
    if ext == LEGACY_SUFFIX:
        raise ValueError(f"legacy .xls workbooks cannot be read, save as .xlsx: {path}")
    return ext in EXCEL_SUFFIXES


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             ragged_col: str | None = None) -> DataFrame:
    """Header line, comma separated, ragged lines cut or null-filled, bad UTF-8 replaced.

    Without a schema every column is read as string (no inference pass).
    ``ragged_col`` names a column to add that holds the whole text of a line
    whose number of fields is not the header's, NULL for all others.
    """
    reader = (spark.read.option("header", True).option("sep", ",")
                   .option("mode", "PERMISSIVE").option("encoding", "UTF-8"))
    if ragged_col:
        columns = schema or reader.option("inferSchema", False).csv(path).schema
        # all fields are split, also of columns nobody reads, or no line would be seen to be ragged
        return (reader.option("columnNameOfCorruptRecord", ragged_col).option("columnPruning", False)
                      .schema(T.StructType([*columns.fields, T.StructField(ragged_col, T.StringType())])).csv(path))
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", False).csv(path)


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Choose the reader by file suffix (case-insensitive).

    ``.xlsx/.xlsm`` -> Excel (first sheet), ``.parquet`` -> parquet
    (filters and projections reach the scan), ``.csv/.txt`` -> CSV.
    Any other suffix raises ``ValueError``, also the legacy ``.xls``.
    """
    ext = suffix_of(path)
    if is_workbook(path):
        from linefeed.sources.excel import read_excel
        return read_excel(spark, path, schema)
    if ext in PARQUET_SUFFIXES:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    if ext in CSV_SUFFIXES:
        return read_csv(spark, path, schema)
    raise ValueError(f"unsupported file type {ext!r} for {path}")


def load_from_template(spark: SparkSession, template: str, values: Mapping[str, str],
                       schema: T.StructType | None = None) -> DataFrame:
    """S5 + S1: resolve a path template, then load by suffix."""
    return load_table(spark, resolve_path(template, values), schema)


def select_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """A SQL query over registered tables or the given DataFrames (``{name}``)."""
    return spark.sql(query, **frames) if frames else spark.sql(query)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower_bound: int, upper_bound: int, num_partitions: int,
              properties: Mapping[str, str] | None = None) -> DataFrame:
    """S7 for an external database: a range-partitioned parallel read.

    The source system fetches a whole query result into one process; here the
    table is split into ``num_partitions`` ranges of ``partition_column``,
    each read by its own task.
    """
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=dict(properties or {}))
