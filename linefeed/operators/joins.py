"""Joins against dimension tables whose size is checked before broadcasting.

A dimension (supply areas, control cycles, cars on the line) that the
optimizer does not already place far above the bounds is written once as
Parquet into the shared folder, in parallel, and its rows and bytes are
counted during the write.  Only if both stay within the bounds is the copy
broadcast; beyond them it is joined by a shuffle (sort-merge), where AQE
coalesces partitions and splits skewed ones, so a hot key on the fact side
never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefeed.session import staging_path

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
# session settings that override the bounds (e.g. 0 forces every shuffle path)
ROWS_CONF = "spark.linefeed.broadcast.maxRows"
BYTES_CONF = "spark.linefeed.broadcast.maxBytes"


def _bounds(spark, max_rows: int | None, max_bytes: int | None) -> tuple[int, int]:
    """Explicit bounds win; otherwise the session's overrides, else the defaults."""
    if max_rows is None:
        max_rows = int(spark.conf.get(ROWS_CONF, str(MAX_BROADCAST_ROWS)))
    if max_bytes is None:
        max_bytes = int(spark.conf.get(BYTES_CONF, str(MAX_BROADCAST_BYTES)))
    return max_rows, max_bytes


_FIXED_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4,
                T.FloatType: 4, T.DateType: 4, T.LongType: 8, T.DoubleType: 8,
                T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16}


def _row_bytes(schema: T.StructType) -> F.Column:
    """Bytes of one row: exact for strings/binary, fixed widths otherwise."""
    total = F.lit(0).cast(T.LongType())
    for f in schema.fields:
        c = F.col("`" + f.name + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
        elif type(f.dataType) in _FIXED_WIDTH:
            total = total + F.lit(_FIXED_WIDTH[type(f.dataType)])
        else:  # nested values: measure their JSON text
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return total


def fits_broadcast(df: DataFrame, max_rows: int | None = None,
                   max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes."""
    return measured_copy(df, max_rows, max_bytes)[1]


# A plan the optimizer takes for this many times the byte bound is joined by
# shuffle as it is: copying it first would cost a full write and read.
FAR_ABOVE = 16


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's estimate of a plan's size; None where the session cannot tell (Connect)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def measured_copy(dim: DataFrame, max_rows: int | None = None,
                  max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``dim``, or a copy of it, and whether it is small enough to broadcast.

    A side the optimizer estimates far above the byte bound is returned as
    it is, without running anything.  Any other is written once as Parquet
    into the shared folder, every task its part; rows and bytes are counted
    during the write, and the caller joins the copy, so the dimension's
    upstream plan runs once and later scans read only the columns they
    need.  With ``max_rows <= 0`` (broadcasts disabled) the dimension is
    returned as it is.
    """
    spark = dim.sparkSession
    max_rows, max_bytes = _bounds(spark, max_rows, max_bytes)
    if max_rows <= 0:
        return dim, False
    estimate = estimated_bytes(dim)
    if estimate is not None and estimate > FAR_ABOVE * max_bytes:
        return dim, False
    obs = Observation()
    path = staging_path(spark, "dimension")
    (dim.observe(obs, F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(dim.schema)).alias("b"))
        .write.parquet(path))
    probe = obs.get
    copy = spark.read.schema(dim.schema).parquet(path)
    return copy, probe["n"] <= max_rows and (probe["b"] or 0) <= max_bytes


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | Sequence[str],
                   how: str = "inner", max_rows: int | None = None,
                   max_bytes: int | None = None,
                   range_prune: Sequence[str] = ()) -> DataFrame:
    """Equi-join ``fact`` with ``dim``; broadcast ``dim`` only if it is proven small.

    ``range_prune`` names join keys whose values on the small side (their
    list, or their range if there are many) are applied to ``fact`` as a
    filter before an inner or semi join: other rows cannot match.  On a
    stored table with that key's layout and bloom filters, parquet skips
    the row groups without them.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        # the build side of a broadcast join must be the non-preserved side
        return fact.join(dim, on, how)
    copy, small = measured_copy(dim, max_rows, max_bytes)
    if not small:
        return fact.join(copy, on, how)
    if range_prune and how in ("inner", "left_semi"):
        fact = fact.filter(key_range(copy, range_prune))
    return fact.join(F.broadcast(copy), on, how)


#: So many keys of a small side are looked for one by one in a stored table; more only by their range.
PROBED_KEYS = 1000


def key_range(small: DataFrame, cols: Sequence[str], probed: int = PROBED_KEYS) -> F.Column:
    """What the keys of a small frame say about matching rows: ``col IN (...)``, or ``lo <= col <= hi`` if there are many.

    At most ``probed`` + 1 keys per column reach the driver.  A Parquet
    reader skips the row groups whose column bloom filter holds none of the
    listed keys, so keys that are scattered over a table cost the groups
    they are in; a range skips what lies outside it.  An empty frame gives
    a predicate that is always false.
    """
    cond = F.lit(True)
    for c in cols:
        keys = [r[0] for r in small.select(c).where(F.col(c).isNotNull()).distinct().limit(probed + 1).collect()]
        if not keys:
            return F.lit(False)
        if len(keys) <= probed:
            cond = cond & F.col(c).isin(keys)
        else:
            lo, hi = small.agg(F.min(c), F.max(c)).first()
            cond = cond & F.col(c).between(F.lit(lo), F.lit(hi))
    return cond


def prepare_keys(df: DataFrame, keys: Sequence[str], normalize=None,
                 collation: str | None = None) -> DataFrame:
    """Rewrite join keys in place: an optional normalizer (e.g. F2), then a collation.

    ``collation="UTF8_LCASE"`` makes key equality case-insensitive, the
    way a case-insensitive database collation compares; the join then
    hashes on the collation key, so it still shuffles or broadcasts as usual.
    """
    out = df
    for k in keys:
        c = F.col(k)
        if normalize is not None:
            c = normalize(c)
        if collation:
            c = F.collate(c, collation)
        if normalize is not None or collation:
            out = out.withColumn(k, c)
    return out
