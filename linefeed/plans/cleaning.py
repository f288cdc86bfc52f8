"""PL1-PL3: cleaning of the control-cycle, supply-area and demand exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefeed.functions import columns as C
from linefeed.operators.index import with_dense_index
from linefeed.operators.projection import select_positions, select_renamed
from linefeed.schemas import FX4PD_POSITIONS, PK05_HEADERS, PKMC_HEADERS

PKMC_BOX_DEPOSIT = "B01"
PK05_LINE_DEPOSIT = "LB01"
TAKT_PREFIX = "T"


def rename_pkmc(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """P1a (``keep``: extra columns carried along, e.g. source file and row)."""
    return select_renamed(df, PKMC_HEADERS, keep)


def filter_pkmc(df: DataFrame) -> DataFrame:
    """Box deposits only (a NULL deposit type is dropped)."""
    return df.filter(F.col("deposit_type") == PKMC_BOX_DEPOSIT)


def clean_pkmc_columns(df: DataFrame) -> DataFrame:
    """F1 on ``qty_max_box``, F2 on ``partnumber`` (both replaced in place).

    A ``qty_max_box`` that already arrives numeric is cast, not digit-scanned:
    the digits of ``12.0`` would read as 120.
    """
    numeric = isinstance(df.schema["qty_max_box"].dataType, T.NumericType)
    max_box = (F.coalesce(F.col("qty_max_box").try_cast(T.LongType()), F.lit(0).cast(T.LongType()))
               if numeric else C.box_count("qty_max_box"))
    return df.withColumns({"qty_max_box": max_box, "partnumber": C.part_number("partnumber")})


def derive_pkmc_columns(df: DataFrame) -> DataFrame:
    """P7, P8, F3 then P6 (rows without a rack are dropped).

    A product beyond 64 bits gives NULL for that row instead of failing the
    whole load under ANSI arithmetic.
    """
    per_box, max_box = F.col("qty_per_box"), F.col("qty_max_box")
    return (df.withColumns({"total_theoretical_qty": F.try_multiply(per_box, max_box),
                            "qty_for_restock": F.try_multiply(per_box, max_box - F.lit(1)),
                            "rack": C.rack("supply_area")})
              .na.drop(subset=["rack"]))


def clean_pkmc(workbook: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """PL1 without the index: rename, keep B01, clean, derive, drop rack-less rows."""
    return (rename_pkmc(workbook, keep)
                    .transform(filter_pkmc)
                    .transform(clean_pkmc_columns)
                    .transform(derive_pkmc_columns))


def index_pkmc(clean: DataFrame, order_by: Sequence[str] = ("partnumber", "supply_area")) -> DataFrame:
    """W1 after all filtering: ids are dense.

    By default ids follow the business key (stable when the export is
    re-sorted); ``order_by=("_file", "_row")`` on a workbook read with
    ``path_col="_file", row_col="_row"`` numbers the rows in file order, as
    a positional row index does.
    """
    return with_dense_index(clean, order_by)


def rename_pk05(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """P1b (``keep``: extra columns carried along, e.g. source file and row)."""
    return select_renamed(df, PK05_HEADERS, keep)


def derive_pk05_columns(df: DataFrame) -> DataFrame:
    """station code from the description."""
    return df.withColumn("takt", C.takt("description"))


def filter_pk05(df: DataFrame) -> DataFrame:
    """Line deposit and a station code starting with T."""
    return df.filter((F.col("deposit") == PK05_LINE_DEPOSIT)
                     & F.col("takt").isNotNull()
                     & F.col("takt").startswith(TAKT_PREFIX))


def clean_pk05(workbook: DataFrame) -> DataFrame:
    """PL2 without the index: rename, derive takt, filter."""
    return (workbook.transform(rename_pk05)
                    .transform(derive_pk05_columns)
                    .transform(filter_pk05))


def index_pk05(workbook: DataFrame, order_by: Sequence[str] | None = None,
               keep: Sequence[str] = (), drop_kept: bool = True) -> DataFrame:
    """PL2 with W1 *before* the filter, so ids keep the gaps of dropped rows.

    ``keep=("_file", "_row")`` with ``order_by=("_file", "_row")`` numbers
    the lines in file order (the columns are dropped afterwards unless
    ``drop_kept`` is false).  The default order is the supply area.
    """
    derived = rename_pk05(workbook, keep).transform(derive_pk05_columns)
    indexed = with_dense_index(derived, order_by or ("supply_area",)).transform(filter_pk05)
    return indexed.drop(*keep) if drop_kept else indexed


def select_fx4pd(df: DataFrame) -> DataFrame:
    """Columns 0, 1, 5, 6 by position."""
    return select_positions(df, FX4PD_POSITIONS)


#: Why a demand line is not loaded.
CUT_SHORT, NO_USAGE, NOT_A_NUMBER = "line cut short", "no usage", "usage is no number"


def judged_fx4pd(raw: DataFrame, ragged_col: str | None = None) -> DataFrame:
    """P2 and F5 with ``reason``: why a line is not loaded (P5, F6), NULL for those that are.

    ``ragged_col`` is the column of ``raw`` that holds ragged lines; a line
    with too many fields is cut and loaded like any other.
    """
    stripped = C.strip_string_columns(select_positions(raw, FX4PD_POSITIONS, [ragged_col] if ragged_col else []))
    usage = F.col("qty_usage")
    missing = usage.isNull() | (usage == "")
    cut = F.col(ragged_col).isNotNull() if ragged_col else F.lit(False)
    return stripped.withColumn("reason", F.when(missing, F.when(cut, CUT_SHORT).otherwise(NO_USAGE))
                               .when(C.lenient_double("qty_usage").isNull(), NOT_A_NUMBER))


def clean_fx4pd(raw: DataFrame) -> DataFrame:
    """PL3: positional select, strip spaces (F5), keep parsable usage (P5), cast."""
    return loaded_fx4pd(C.strip_string_columns(select_fx4pd(raw)))


def loaded_fx4pd(stripped: DataFrame) -> DataFrame:
    """P5, F6 and F7 of stripped lines: those with a parsable usage, cast."""
    # a float literal is looked for once, by the filter: what passes is cast
    usage = F.col("qty_usage").try_cast(T.DoubleType())
    return (stripped.filter(C.lenient_double("qty_usage").isNotNull())
                    .withColumns({"qty_usage": usage,
                                  "qty_unit": C.lenient_int("qty_unit")}))
