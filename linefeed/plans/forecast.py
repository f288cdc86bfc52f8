"""PL5 forecast join (J1), the stored control-cycle table, PL8 buffer, PL9 preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefeed.functions.columns import RECEPTION
from linefeed.functions import columns as C
from linefeed.operators.expand import deal_out, repeat_rows
from linefeed.operators.joins import join_dimension, prepare_keys
from linefeed.operators.ordered import preview
from linefeed.plans.sinks import stored
from linefeed.schemas import FORECAST_COLUMNS


def with_stock(pkmc: DataFrame, stock: DataFrame) -> DataFrame:
    """The stored control-cycle table: cleaned rows plus their current ``lb_balance``.

    ``lb_balance`` lives only in the stored table (no export carries it), so
    it is attached by control cycle (part, supply area); a cycle without a
    stock row has a NULL balance.
    """
    return join_dimension(pkmc, stock.select("partnumber", "supply_area", "lb_balance"),
                          ["partnumber", "supply_area"], "left")


def forecast(fx4pd: DataFrame, pkmc: DataFrame, pk05: DataFrame, normalize_keys: bool = False,
             key_collation: str | None = None) -> DataFrame:
    """Demand per car x control cycle x station.

    ``fx4pd ⋈ pkmc ON partnumber ⋈ pk05 ON supply_area`` with bag
    semantics (a part stored in two areas, or an area listed twice,
    repeats the demand row).  Part numbers are joined as stored by default;
    ``normalize_keys`` applies the control-cycle normalization (F2) to the
    demand side too, ``key_collation`` (e.g. ``UTF8_LCASE``) compares keys
    under a collation.

    Join order: demand meets the control cycles first (the one join that
    may have to shuffle when the cycles outgrow the broadcast bound; AQE
    then splits a hot part), and the supply areas join last as a broadcast,
    so the fan-out to stations happens after any shuffle, never before it.
    """
    fx4pd, pkmc, pk05 = with_keys(fx4pd, pkmc, pk05, normalize_keys, key_collation)
    return fan_out(of_areas(fx4pd, pkmc), pk05)


def with_keys(fx4pd: DataFrame, pkmc: DataFrame, pk05: DataFrame, normalize_keys: bool = False,
              key_collation: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """J1's three inputs with their keys as they are compared (options of :func:`forecast`)."""
    if normalize_keys:
        fx4pd = prepare_keys(fx4pd, ["partnumber"], C.part_number)
        pkmc = prepare_keys(pkmc, ["partnumber"], C.part_number)
    if key_collation:
        fx4pd = prepare_keys(fx4pd, ["partnumber"], collation=key_collation)
        pkmc = prepare_keys(pkmc, ["partnumber", "supply_area"], collation=key_collation)
        pk05 = prepare_keys(pk05, ["supply_area"], collation=key_collation)
    return fx4pd, pkmc, pk05


def of_areas(fx4pd: DataFrame, pkmc: DataFrame) -> DataFrame:
    """J1's first join, demand per car x control cycle with its supply area: the forecast before its fan-out to stations."""
    cycles = pkmc.select("partnumber", "supply_area", "num_reg_circ", "rack", "lb_balance",
                         "total_theoretical_qty", "qty_for_restock", "qty_per_box", "qty_max_box")
    return join_dimension(fx4pd, cycles, "partnumber")


def fan_out(rows: DataFrame, pk05: DataFrame) -> DataFrame:
    """J1's second join, the forecast of :func:`of_areas`: a row per station its area lists.

    Each row makes as many as its area has lines, so rows are finished and
    dealt out before they meet the stations of their area, an area at a time.
    """
    return unfolded(join_dimension(deal_out(rows), area_stations(pk05), "supply_area").select(*FOLDED_COLUMNS))


#: How many rows of the forecast a row stands for, where equal ones are put together.
COPIES = "__copies"


def listed_stations(pk05: DataFrame) -> DataFrame:
    """``(supply_area, takt, __copies)``: each station of an area once, with how often the area lists it."""
    return pk05.groupBy("supply_area", "takt").agg(F.count(F.lit(1)).alias(COPIES))


def fed_parts(pkmc: DataFrame, pk05: DataFrame) -> DataFrame:
    """``(partnumber, takt, __copies)``: the stations a part is fed at, and the forecast rows a demand row of it has there.

    What J1 adds to the demand before it meets a station.  The forecast
    itself grows with the demand times the lines of its areas; this has at
    most a row per part and station.
    """
    cycles = (pkmc.groupBy("partnumber", "supply_area").agg(F.count(F.lit(1)).alias("__cycles")))
    return (join_dimension(cycles, listed_stations(pk05), "supply_area")
            .groupBy("partnumber", "takt").agg(F.sum(F.col("__cycles") * F.col(COPIES)).alias(COPIES)))


#: The stations of a row's area, ``(takt, __copies)`` each, where the forecast is stored before its fan-out.
STATIONS = "__stations"


#: Columns of the forecast as it is stored.
FOLDED_COLUMNS = [*(c for c in FORECAST_COLUMNS if c != "takt"), STATIONS]


def area_stations(pk05: DataFrame) -> DataFrame:
    """``(supply_area, __stations)``: an area's stations in one row."""
    return (listed_stations(pk05).groupBy("supply_area")
            .agg(F.array_sort(F.collect_list(F.struct("takt", COPIES))).alias(STATIONS)))


def fed_cycles(pkmc: DataFrame, pk05: DataFrame) -> DataFrame:
    """Control cycles with the stations of their area in ``__stations``; cycles of areas without any feed nothing."""
    return join_dimension(pkmc, area_stations(pk05), "supply_area").drop("supply_area")


def folded(fx4pd: DataFrame, pkmc: DataFrame, pk05: DataFrame, laid_out: bool = True) -> DataFrame:
    """J1 as it is stored: a row per demand row and control cycle, by car, with the stations of its area in ``__stations``.

    It grows with the demand; :func:`unfolded` gives J1's rows.  Rows are
    laid out by car before they get their stations, unless whoever stores
    them deals them out anew (not ``laid_out``).
    """
    rows = of_areas(fx4pd, pkmc)
    rows = join_dimension(by_car(rows) if laid_out else rows, area_stations(pk05), "supply_area")
    return rows.select(*FOLDED_COLUMNS)


def unfolded(rows: DataFrame, columns: Sequence[str] = tuple(FORECAST_COLUMNS)) -> DataFrame:
    """The forecast of a folded one: a row per station, as often as the area lists it; any other frame as it is."""
    if STATIONS not in rows.columns:
        return rows
    each = rows.select("*", F.inline(STATIONS)).drop(STATIONS)
    return repeat_rows(each, COPIES, "__copy").select(*columns)


def copies_in(rows: DataFrame) -> F.Column:
    """How many forecast rows each row of a frame stands for."""
    if STATIONS in rows.columns:
        return F.aggregate(STATIONS, F.lit(0).cast("long"), lambda n, s: n + s[COPIES])
    return F.col(COPIES) if COPIES in rows.columns else F.lit(1)


def copies_of(rows: DataFrame) -> F.Column:
    """How many forecast rows a frame's rows stand for, as an aggregate."""
    return F.coalesce(F.sum(copies_in(rows)), F.lit(0))


#: Writer options of per-car tables: a bloom filter of the car key per row group.
CAR_FILTER = {"parquet.bloom.filter.enabled#knr_fx4pd": "true"}


def by_car(df: DataFrame, files: int | None = None) -> DataFrame:
    """Range-partitioned and sorted by the car key, the layout in which per-car tables are stored."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, "knr_fx4pd").sortWithinPartitions("knr_fx4pd")


def store_by_car(df: DataFrame, path: str, files: int | None = None) -> str:
    """Write a per-car table (forecast, demand) laid out by ``knr_fx4pd``.

    Rows are range-partitioned and sorted by the car key, so every file and
    row group covers a narrow key range and a filter on a band of cars
    (the cars now on the line) skips the rest from parquet statistics; cars
    scattered over the sequence are looked up in the row groups' bloom
    filters.
    """
    by_car(df, files).write.options(**CAR_FILTER).parquet(path)
    return path


def reception_buffer(assembly_line: DataFrame) -> DataFrame:
    """Cars waiting in reception."""
    return (assembly_line.filter(F.col("lane") == RECEPTION)
                         .select("knr", "model", "lfdnr_sequence"))


def preview_sorted(df: DataFrame, order_by: list[str], limit: int = 5000) -> DataFrame:
    """PL9: first ``limit`` rows in a given order (limit planned before the action)."""
    return preview(df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]), limit)


def preview_forecast(fx4pd: DataFrame, pkmc: DataFrame, pk05: DataFrame, limit: int = 5000) -> DataFrame:
    """PL9 of J1: its first ``limit`` rows in the order of its columns, without the rest of it.

    The order begins with the demand's columns, and a demand row fed
    anywhere has at least one forecast row.  So the first rows come from the
    first ``limit`` fed demand rows; rows equal in all these columns are
    interchangeable.
    """
    first = fx4pd.columns
    if first != FORECAST_COLUMNS[:len(first)]:
        raise ValueError(f"the demand's columns must lead the forecast's: {first}")
    areas = pk05.select("supply_area").distinct()
    parts = join_dimension(pkmc.select("partnumber", "supply_area"), areas, "supply_area", "left_semi").select(
        "partnumber").distinct()
    top = preview_sorted(join_dimension(fx4pd, parts, "partnumber", "left_semi"), first, limit)
    rows = forecast(stored(top), pkmc, pk05)
    return preview_sorted(rows, FORECAST_COLUMNS, limit)
