"""Open transfer orders of one warehouse / storage type in a date window.

Re-aimed from the transfer-order list selection screen (warehouse,
storage type, open items only, creation date from..to); the dates are
arguments, never the wall clock, so a rerun gives the same answer.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefeed.functions import columns as C

# The selection the source system types into its screen.
DEFAULT_WAREHOUSE = "ANC"
DEFAULT_STORAGE_TYPE = "B01"


def pending_orders(orders: DataFrame, on_date: dt.date | str, date_to: dt.date | str | None = None,
                   warehouse: str = DEFAULT_WAREHOUSE,
                   storage_type: str = DEFAULT_STORAGE_TYPE) -> DataFrame:
    """Four ANDed predicates; all reach the parquet scan as pushed filters."""
    start = F.lit(on_date).cast("date")
    end = F.lit(date_to if date_to is not None else on_date).cast("date")
    return (orders.filter((F.col("warehouse") == warehouse)
                          & (F.col("storage_type") == storage_type)
                          & F.col("is_open")
                          & F.col("created").between(start, end))
                  .withColumn("created_text", C.day_text("created")))
