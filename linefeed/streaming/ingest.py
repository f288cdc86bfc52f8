"""Snapshot ingest as Structured Streaming.

* T1 ``stream_snapshots`` (sources) -> car positions per micro-batch.
* T2 ``upsert_stream``: every micro-batch appends its last row per key;
  the table is its current version with these rows applied, and
  ``compact`` folds them in.  What a batch writes follows the batch, not
  the table, and the newest snapshot of a key wins across batches.  On a
  ``BucketedTable`` the fold rewrites only the buckets of the changed keys.
* T3 ``consume_once_stream``: the engine keeps the (car, station) pairs
  already seen in a RocksDB state store (``dropDuplicates`` without a
  watermark), so a pair is consumed once, however often, however late and
  in whatever batches it arrives, and a batch reads its own rows only.
  A batch appends what its new pairs consume to a ledger; balances are
  the stored table minus the ledger.

Batches that are folded in are removed a fold later, so folders beside a
table do not pile up.

A batch the engine replays after a failure starts from the state before it
and overwrites its own folders, so replays have no effect.

All runs use ``trigger(availableNow=True)`` and a checkpoint folder under
the shared checkpoint location; they stop when the landed files are done.

A table and its stream checkpoint belong together: batch ids restart at 0
on a new checkpoint, and those batches would overwrite the ones already
beside the table.  The table therefore records the checkpoint
that feeds it, and a stream started on another checkpoint is refused.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefeed.operators.merge import one_per_key
from linefeed.plans.assembly import assembly_records
from linefeed.plans.buckets import BucketedTable
from linefeed.plans.consumption import fed_usage, station_usage, subtract
from linefeed.plans.sinks import Batches, VersionedTable
from linefeed.sources.snapshots import judged, placed

#: How long a stream may go without a running task or a finished batch; how long it runs is up to its input.
DEFAULT_TIMEOUT_S = 600


FED_BY = "_fed_by_checkpoint"


def _bind(table: VersionedTable, checkpoint: str) -> None:
    """Pair ``table`` with the stream checkpoint that versions it (refuse another one)."""
    bound = table.read_note(FED_BY)
    if bound is None:
        table.write_note(FED_BY, checkpoint)
    elif bound != checkpoint:
        raise ValueError(f"table {table.name} is fed by the stream checkpoint {bound}; "
                         f"a stream on {checkpoint} would skip its first batches")


#: State of keyed streaming operators: on local disk, its changes written to the checkpoint per batch.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _with_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """The settings while a stream starts and runs; the session's own come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _run(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
         timeout_s: float) -> None:
    """Run a stream over all that has landed; one that stands still for ``timeout_s`` is stopped with an error.

    Running tasks of the session are work, however long they take: a large
    landing is not cut off half way.
    """
    query = (stream.writeStream.foreachBatch(handler)
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True).start())
    last, since = None, time.monotonic()
    while not query.awaitTermination(min(1.0, timeout_s)):
        batch = (query.lastProgress or {}).get("batchId")
        if batch != last or _working(stream.sparkSession, query):
            last, since = batch, time.monotonic()
        elif time.monotonic() - since >= timeout_s:
            query.stop()
            raise TimeoutError(f"stream stood still for {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _working(spark: SparkSession, query) -> bool:
    """Whether any task of the session runs now; on Spark Connect, whether the stream is in a batch."""
    try:
        tracker = spark.sparkContext.statusTracker()
    except Exception:
        return bool(query.status.get("isTriggerActive"))
    return any(info.numActiveTasks for info in map(tracker.getStageInfo, tracker.getActiveStageIds()) if info)


def car_positions(snapshots: DataFrame) -> DataFrame:
    """Car positions of streamed snapshot documents, with their snapshot's time and place."""
    return assembly_records(snapshots, "value", keep=["snapshot_ts", "snapshot_pos"])


def upsert_stream(positions: DataFrame, table: VersionedTable, keys: Sequence[str],
                  order_by: Sequence[str], empty: DataFrame, checkpoint: str,
                  timeout_s: int = DEFAULT_TIMEOUT_S) -> DataFrame:
    """K1 of every micro-batch into ``table``; returns the table with all of them applied.

    ``empty`` has the table's schema, which must hold the order columns, so
    that a late, older row never replaces a newer one.
    """
    missing = [c for c in order_by if c not in empty.columns]
    if missing:
        raise ValueError(f"the table must store its order columns: {missing}")
    log = Batches(table, CHANGES)

    def append(batch: DataFrame, batch_id: int) -> None:
        rows = placed(batch) if "snapshot_pos" in batch.columns else batch
        log.append(one_per_key(rows.select(*empty.columns), list(keys), order_by), batch_id)

    _bind(table, checkpoint)
    _run(positions, append, checkpoint, timeout_s)
    return with_changes(table, keys, order_by, empty)


def upsert_snapshots(snapshots: DataFrame, table: VersionedTable, keys: Sequence[str], order_by: Sequence[str],
                     empty: DataFrame, checkpoint: str, timeout_s: int = DEFAULT_TIMEOUT_S) -> DataFrame:
    """T1 + T2 of streamed snapshot documents, with a quarantine; returns the table with all batches applied.

    A batch's documents that are no JSON object are appended to
    ``quarantine`` beside the table, with the reason and where they came
    from; :func:`quarantined` reads them.
    """
    log, bad = Batches(table, CHANGES), Batches(table, QUARANTINE)

    def append(batch: DataFrame, batch_id: int) -> None:
        docs = judged(placed(batch))
        rejected = docs.where("reason IS NOT NULL")
        bad.append(rejected.select(*QUARANTINED.fieldNames()), batch_id)
        rows = car_positions(docs.where("reason IS NULL"))
        log.append(one_per_key(rows.select(*empty.columns), list(keys), order_by), batch_id)

    _bind(table, checkpoint)
    _run(snapshots, append, checkpoint, timeout_s)
    return with_changes(table, keys, order_by, empty)


def quarantined(table: VersionedTable) -> DataFrame:
    """Documents that were no snapshots: ``value, reason, source_file, snapshot_ts, batch``."""
    return Batches(table, QUARANTINE).read(QUARANTINED)


QUARANTINE = "quarantine"
QUARANTINED = T.StructType([T.StructField("value", T.StringType()), T.StructField("reason", T.StringType()),
                            T.StructField("source_file", T.StringType()),
                            T.StructField("snapshot_ts", T.TimestampType())])


def with_changes(table: VersionedTable, keys: Sequence[str], order_by: Sequence[str],
                 empty: DataFrame) -> DataFrame:
    """The table's current version with the appended batches applied."""
    current = table.current()
    base = empty if current is None else current.select(*empty.columns)
    if Batches(table, CHANGES).last() <= table.folded():  # all folded in: the table is as it should be
        return base
    changes = Batches(table, CHANGES).read(empty.schema, after=table.folded())
    return one_per_key(base.unionByName(changes.drop("batch")), list(keys), order_by)


def compact(table: VersionedTable, keys: Sequence[str], order_by: Sequence[str],
            empty: DataFrame) -> DataFrame:
    """Fold the appended batches into the table (run when no stream writes).

    A versioned table gets a new version; the batches its kept older version
    still needs stay until the next fold.  A bucketed table rewrites the
    buckets of the changed keys.
    """
    log, before = Batches(table, CHANGES), table.folded()
    last = max(log.last(), before)
    if isinstance(table, BucketedTable):
        changes = log.read(empty.schema, after=before).drop("batch")
        result = table.merge(changes, order_by, null_keys="insert", folded=last, stored=True)
        log.expire(last)
        return result
    result = table.commit(with_changes(table, keys, order_by, empty), folded=last)
    log.expire(before)
    return result


CHANGES, SIGHTINGS, LEDGER = "changes", "sightings", "ledger"
SEEN = T.StructType([T.StructField("knr_fx4pd", T.StringType()), T.StructField("takt", T.StringType())])
ENTRY = T.StructType([*SEEN.fields, T.StructField("partnumber", T.StringType()),
                      T.StructField("usage", T.DoubleType())])


def consume_once_stream(positions: DataFrame, forecast: DataFrame, fx4pd: DataFrame,
                        table: VersionedTable, checkpoint: str,
                        timeout_s: int = DEFAULT_TIMEOUT_S) -> DataFrame:
    """Decrement ``lb_balance`` once per (car, station, part); returns the table with that applied.

    Per batch: the (car, station) pairs not seen before select the forecast
    rows of parts fed at that station; each (car, station, part) enters the
    ledger with the car's summed demand from ``fx4pd``.  The result does not
    depend on how files fall into batches.  ``forecast`` is the stored
    forecast or, without its ``knr_fx4pd``, the parts fed at each station
    (``forecast.fed_parts``), which needs no forecast to be stored.
    """
    spark = positions.sparkSession
    usage = station_usage if "knr_fx4pd" in forecast.columns else fed_usage
    sightings, ledger = Batches(table, SIGHTINGS), Batches(table, LEDGER)

    def consume_batch(new: DataFrame, batch_id: int) -> None:
        # the stateful plan runs once: what follows reads the pairs it let through
        pairs = sightings.append(new, batch_id)
        ledger.append(usage(forecast, pairs, fx4pd), batch_id)
        sightings.expire(batch_id)

    _bind(table, checkpoint)
    pairs = positions.select(*SEEN.fieldNames()).dropna().dropDuplicates(SEEN.fieldNames())
    with _with_conf(spark, STATE_CONF):
        _run(pairs, consume_batch, checkpoint, timeout_s)
    return with_ledger(table)


def with_ledger(table: VersionedTable) -> DataFrame:
    """The table's current version minus what the ledger holds since."""
    entries = Batches(table, LEDGER).read(ENTRY, after=table.folded())
    consumed = entries.groupBy("partnumber").agg(F.sum("usage").alias("consumed"))
    return subtract(table.current(), consumed)


def settle(table: VersionedTable) -> DataFrame:
    """Fold the ledger into a new version of the table (run when no stream writes).

    Entries that the kept older version still needs stay until the next fold.
    """
    ledger, before = Batches(table, LEDGER), table.folded()
    result = table.commit(with_ledger(table), folded=max(ledger.last(), before))
    ledger.expire(before)
    return result
