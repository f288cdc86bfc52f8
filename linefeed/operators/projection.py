"""Projection operators: rename-by-map (P1) and positional select."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> F.Column:
    """Column by exact name; headers may contain dots, spaces and accents."""
    return F.col("`" + name.replace("`", "``") + "`")


def select_renamed(df: DataFrame, mapping: Mapping[str, str],
                   keep: Sequence[str] = ()) -> DataFrame:
    """Keep only the mapped columns, renamed, in mapping order.

    ``keep`` names columns carried along unchanged after them (e.g. the
    source file and row of a workbook line).
    """
    missing = [k for k in list(mapping) + list(keep) if k not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.select([quoted(src).alias(dst) for src, dst in mapping.items()]
                     + [quoted(k) for k in keep])


def select_positions(df: DataFrame, positions: Mapping[int, str], keep: Sequence[str] = ()) -> DataFrame:
    """Keep columns by 0-based position, renamed, in position order.

    ``keep`` names columns that count for no position and are carried along
    after them.
    """
    cols = [c for c in df.columns if c not in keep]
    if len(cols) <= max(positions):
        raise ValueError(f"need at least {max(positions) + 1} columns, got {len(cols)}")
    if len(set(cols)) != len(cols):
        raise ValueError("duplicate column headers make positional selection ambiguous")
    return df.select([quoted(cols[i]).alias(name) for i, name in sorted(positions.items())]
                     + [quoted(k) for k in keep])
