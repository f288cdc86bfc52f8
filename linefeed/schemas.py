"""Declared schemas and fixed column lists of the tables the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


# Workbook headers of the control-cycle (PKMC) export and the
# column names they map to, in the order the cleaned table lists them.
PKMC_HEADERS = {
    "Material": "partnumber",
    "Área abastec.prod.": "supply_area",
    "Nº circ.regul.": "num_reg_circ",
    "Tipo de depósito": "deposit_type",
    "Posição no depósito": "deposit_position",
    "Container": "container",
    "Texto breve de material": "description",
    "Norma de embalagem": "pack_standard",
    "Quantidade Kanban": "qty_per_box",
    "Posição de armazenamento": "qty_max_box",
}

# Workbook headers of the supply-area (PK05) export.
PK05_HEADERS = {
    "Área abastec.prod.": "supply_area",
    "Depósito": "deposit",
    "Responsável": "responsible",
    "Ponto de descarga": "discharge_point",
    "Denominação SupM": "description",
}

# FX4PD columns are taken by position, not by header.
FX4PD_POSITIONS = {0: "knr_fx4pd", 1: "partnumber", 5: "qty_usage", 6: "qty_unit"}

PKMC_RAW = T.StructType(
    _strings("partnumber", "supply_area", "num_reg_circ", "deposit_type", "deposit_position",
             "container", "description", "pack_standard")
    + [T.StructField("qty_per_box", T.LongType(), True),
       T.StructField("qty_max_box", T.StringType(), True)])

ASSEMBLY_LINE = T.StructType(_strings("knr", "model", "lfdnr_sequence", "werk", "spj", "lane",
                                      "takt", "knr_fx4pd"))

# The columns of the two results that leave the system.
FORECAST_COLUMNS = ["knr_fx4pd", "partnumber", "qty_usage", "qty_unit", "num_reg_circ", "takt",
                    "rack", "lb_balance", "total_theoretical_qty", "qty_for_restock",
                    "qty_per_box", "qty_max_box"]

RESTOCK_COLUMNS = ["partnumber", "num_reg_circ", "takt", "rack", "lb_balance",
                   "total_theoretical_qty", "qty_for_restock", "qty_per_box", "qty_max_box"]
