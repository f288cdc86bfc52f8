"""Dense 0-based row index without a single-partition window.

A global ``row_number()`` moves every row into one task.  Instead the
rows are range-partitioned and sorted on a total order, the sorted frame
is checkpointed (so every later pass sees identical partitions, also
after an executor loss), and each row's id is

    id = rows in all earlier partitions + position inside its partition.

Only the per-partition row counts (one number per partition) travel to
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefeed.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id(): partition id << 33 | row position


def _order_columns(df: DataFrame, order_by: Sequence[str | Column] | None) -> list[Column]:
    given = [F.col(c) if isinstance(c, str) else c for c in (order_by or [])]
    named = {c for c in (order_by or []) if isinstance(c, str)}
    # append every remaining column so ties are broken deterministically
    rest = [F.col(f"`{c}`") for c in df.columns if c not in named]
    return [c.asc_nulls_first() for c in given + rest]


def with_dense_index(df: DataFrame, order_by: Sequence[str | Column] | None = None,
                     name: str = "id", num_partitions: int | None = None) -> DataFrame:
    """Prepend ``name`` = 0..n-1 following ``order_by`` (then all columns)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = _order_columns(df, order_by)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # identical rows share one sort key; a per-row tie-breaker lets the range
    # partitioner split even a run of duplicates holding a third of the rows
    tie = F.col("__tie").asc()
    ranged = (df.withColumn("__tie", F.monotonically_increasing_id())
                .repartitionByRange(n, *order, tie).sortWithinPartitions(*order, tie)
                .drop("__tie"))
    tagged = ranged.withColumn("__mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    part = F.shiftright(F.col("__mid"), _POS_BITS)
    counts = sorted((r["p"], r["n"]) for r in
                    tagged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts = [0, *accumulate(c for _, c in counts)]
    offsets = [(p, start) for (p, _), start in zip(counts, starts)]
    numbered = number_rows(tagged, offsets, name)
    return numbered.select(F.col(f"`{name}`"), *[F.col(f"`{c}`") for c in df.columns])


def number_rows(tagged: DataFrame, offsets: Sequence[tuple[int, int]], name: str) -> DataFrame:
    """Add ``name``: the offset of the row's partition plus its position (``__mid``).

    The offsets are a table of one row per range partition, whose number the
    session's shuffle partitions bound, so it is broadcast; a row's offset is
    one hash lookup, however many partitions there are.
    """
    part = F.shiftright(F.col("__mid"), _POS_BITS)
    # an Arrow table becomes a local relation: no Python rows, and nothing to run before it is broadcast
    numbers = list(zip(*offsets)) or [(), ()]
    starts = tagged.sparkSession.createDataFrame(pa.table(
        {n: pa.array(v, pa.int64()) for n, v in zip(("__part", "__start"), numbers)}))
    pos = F.col("__mid") - F.shiftleft(part, _POS_BITS)
    # an empty frame has no partitions and no offsets: nothing to join
    return (tagged.join(F.broadcast(starts), part == F.col("__part"), "left")
                  .withColumn(name, F.coalesce(F.col("__start"), F.lit(0).cast(T.LongType())) + pos))
