"""PL4: vehicle positions from assembly-line snapshot documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefeed.functions import columns as C
from linefeed.operators.expand import flatten_snapshots
from linefeed.schemas import ASSEMBLY_LINE


def transform_positions(cars: DataFrame) -> DataFrame:
    """F9 (first ``lane_`` removed) and F10 (sequence number as text)."""
    return cars.withColumns({"lane": C.remove_first("lane", C.LANE_PREFIX),
                             "lfdnr_sequence": C.as_text("lfdnr_sequence")})


def attach_car_key(cars: DataFrame) -> DataFrame:
    """``knr_fx4pd = werk || spj || knr`` (NULL if any part is NULL)."""
    return cars.withColumn("knr_fx4pd", C.car_key("werk", "spj", "knr"))


def assembly_records(docs: DataFrame, text_col: str = "value",
                     keep: list[str] | None = None) -> DataFrame:
    """PL4: flatten (E1) -> transform (F9, F10) -> car key.

    ``docs`` holds one snapshot document per row; documents are spread
    over tasks like any other rows, so many snapshots parse in parallel.
    The result always has the fixed ``assembly_line`` columns, also when
    no document holds a car.
    """
    keep = list(keep or [])
    cars = flatten_snapshots(docs, text_col, keep)
    out = cars.transform(transform_positions).transform(attach_car_key)
    return out.select(*keep, *[F.col(f.name).cast(f.dataType) for f in ASSEMBLY_LINE.fields])
