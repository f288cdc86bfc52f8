"""Row generators: repeat a row N times (E2) and flatten nested snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefeed.functions.columns import LANE_PREFIX, RECEPTION

STRING_MAP = T.MapType(T.StringType(), T.StringType())

# Keys of a station slot and of the car object inside it, and the
# output column each car field lands in.
CAR_FIELDS = {"KNR": "knr", "MODELL": "model", "LFDNR": "lfdnr_sequence", "WERK": "werk",
              "SPJ": "spj"}
SLOT_CAR, SLOT_LANE, SLOT_TACT = "CAR", "LANE", "TACT"


# Repetitions one array holds at most; a row with more is expanded chunk by chunk.
CHUNK = 100_000


def deal_out(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over all tasks, one by one, before a step that makes many rows of each.

    Without the shuffle the columns of a row would be computed in the step's
    own loop, once for every row made of it, and by the tasks of a scan that
    may be few.  What is shuffled are the rows before the step.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def repeat_rows(df: DataFrame, count: str | Column, index_name: str = "call_no",
                chunk: int = CHUNK, spread: bool = False) -> DataFrame:
    """Emit each row ``count`` times, numbered 1..count; count < 1 or NULL -> no row.

    ``sequence(1, 0)`` would count down to ``[1, 0]``, so rows with fewer
    than one repetition are filtered before the explode.  The expansion has
    two levels, the starts of the chunks and the numbers within a chunk, so
    no array is longer than ``chunk`` however large one count is.  With
    ``spread`` the chunks are dealt over all tasks between the two levels
    (one shuffle of the unexpanded rows), for inputs with a few huge counts.
    """
    one = F.lit(1).cast(T.LongType())
    step = F.lit(chunk).cast(T.LongType())
    n = (F.col(count) if isinstance(count, str) else count).cast(T.LongType())
    starts = (df.withColumn("__n", n).filter(F.col("__n") >= 1)
                .withColumn("__start", F.explode(F.sequence(one, F.col("__n"), step))))
    if spread:
        starts = deal_out(starts)
    last = F.least(F.col("__start") + step - 1, F.col("__n"))
    return (starts.withColumn(index_name, F.explode(F.sequence(F.col("__start"), last)))
                  .drop("__n", "__start"))


def _entries(json_text: Column) -> Column:
    """Entries (key, value) of a JSON object in document order; NULL if not an object."""
    return F.map_entries(F.from_json(json_text, STRING_MAP))


def _last_wins(entries: Column) -> Column:
    """Drop every entry whose key appears again later in the same object.

    JSON parsers of the source system keep the last value of a repeated
    key; a parsed map keeps every copy.  ``entries`` must be a column
    reference (computed in an earlier projection), so nothing is parsed
    twice.  Objects without repeated keys (the norm) pass through after one
    hashing pass; the others are sorted by key and position once, and an
    entry stays if its neighbour has another key.
    """
    n = F.size(entries)
    unique = F.size(F.array_distinct(entries["key"])) == n
    placed = F.array_sort(F.transform(entries, lambda e, i: F.struct(
        e["key"].alias("key"), i.alias("at"), e["value"].alias("value"))))
    # the sorted array is bound by a one-element transform, so it is sorted once
    kept = F.flatten(F.transform(F.array(placed), lambda p: F.filter(
        p, lambda e, i: (i == F.size(p) - 1) | (F.get(p, i + 1)["key"] != e["key"]))))
    in_order = F.array_sort(F.transform(kept, lambda e: F.struct(
        e["at"].alias("at"), e["key"].alias("key"), e["value"].alias("value"))))
    scanned = F.transform(in_order, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    return F.when(unique, entries).otherwise(scanned)


def _last_value(entries: Column, key: str) -> Column:
    """Value of the last entry named ``key`` (NULL when absent or not an object)."""
    return F.try_element_at(F.filter(entries, lambda x: x["key"] == F.lit(key)),
                            F.lit(-1))["value"]


def _has_key(entries: Column, key: str) -> Column:
    return F.exists(entries, lambda x: x["key"] == F.lit(key))


def flatten_snapshots(docs: DataFrame, text_col: str = "value",
                      keep: list[str] | None = None) -> DataFrame:
    """E1 (+P15, P16): one row per car found in assembly-line snapshot documents.

    A document is ``{lane_key: {fb_key: {slot_key: {"CAR": {...}, "LANE", "TACT"}}}}``.
    Only lane keys starting with ``lane_`` or ``reception`` are read, and only
    slots that are objects with a non-empty ``CAR`` object.  ``lane`` is the
    slot's ``LANE`` when that key is present (even if null), else the lane key.
    Each level is parsed as ``map<string,string>``, so a non-object value at
    one place drops that branch only, never the whole document; a key
    repeated within one object keeps its last value.
    """
    keep = list(keep or [])
    e = F.col("__entries")

    def level(df: DataFrame, carried: list[str], text: str, key: str, value: str) -> DataFrame:
        parsed = df.select(*carried, _entries(F.col(text)).alias("__entries"))
        return parsed.select(*carried, F.inline(_last_wins(e)).alias(key, value))

    lanes = (level(docs, keep, text_col, "lane_key", "lane_json")
             .filter(F.col("lane_key").startswith(LANE_PREFIX)
                     | F.col("lane_key").startswith(RECEPTION)))
    fbs = level(lanes, keep + ["lane_key"], "lane_json", "fb_key", "fb_json")
    slots = level(fbs, keep + ["lane_key", "fb_key"], "fb_json", "slot_key", "slot_json")
    # slot and car objects are only read field by field: the last value of a
    # key is a linear scan of the entries, no de-duplicated map is needed
    slot = F.col("__slot")
    car = F.col("__car")
    parsed = slots.select(*keep, "lane_key", _entries(F.col("slot_json")).alias("__slot"))
    # empty cars are left out while they are listed: a filter on the parsed car would be
    # pushed below the parsing and parse slot and car a second time
    cars = parsed.select(*keep, "lane_key", "__slot", F.explode(F.filter(
        F.array(_entries(_last_value(slot, SLOT_CAR))), lambda c: F.size(c) > 0)).alias("__car"))
    lane = F.when(_has_key(slot, SLOT_LANE), _last_value(slot, SLOT_LANE)) \
        .otherwise(F.col("lane_key"))
    return cars.select(*keep,
                       *[_last_value(car, k).alias(v) for k, v in CAR_FIELDS.items()],
                       lane.alias("lane"),
                       _last_value(slot, SLOT_TACT).alias("takt"))
