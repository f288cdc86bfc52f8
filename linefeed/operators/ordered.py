"""Ordered operators: bounded preview (L1) and first match in an ordered list (L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefeed.functions import columns as C
from linefeed.operators.joins import join_dimension

PREVIEW_DEFAULT, PREVIEW_MAX = 5000, 100_000


def preview(df: DataFrame, limit: int = PREVIEW_DEFAULT) -> DataFrame:
    """L1: at most ``limit`` rows, 1 <= limit <= 100000.

    After an ``orderBy`` Spark plans this as a per-task top-k merged once
    (TakeOrderedAndProject), so no full sort or collect happens.
    """
    if not isinstance(limit, int) or not 1 <= limit <= PREVIEW_MAX:
        raise ValueError(f"limit must be within 1..{PREVIEW_MAX}, got {limit!r}")
    return df.limit(limit)


def first_match_in_list(rows: DataFrame, group: str, idx: str, name: str, pattern: str,
                        extra: list[str] | None = None) -> DataFrame:
    """L2: per ``group``, the first row whose ``name`` contains ``pattern`` (any case).

    The list is read the way a screen list is walked: leading blank rows
    are skipped, reading starts at the first non-blank row and stops at
    the first missing position (``idx`` gap).  A group without non-blank
    rows yields nothing.

    The first match after the start is reached exactly if no position
    between the two is missing, that is, if the distinct positions between
    them are as many as their distance plus one.  So three aggregations by
    group do (start, match, count); their results have one row per group
    and join back as size-checked dimensions, and a long list is spread
    over many tasks.
    """
    extra = list(extra or [])
    start = (rows.filter(~C.is_blank(name))
                 .groupBy(group).agg(F.min(idx).alias("__start")))
    hit = F.struct(F.col(idx).alias("index"), F.lower(F.col(name)).alias("name"),
                   *[F.col(c) for c in extra])
    match = (join_dimension(rows.filter(C.contains_ci(name, pattern)), start, group)
             .filter(F.col(idx) >= F.col("__start"))
             .groupBy(group).agg(F.min("__start").alias("__start"), F.min_by(hit, F.col(idx)).alias("__m")))
    between = (join_dimension(rows.select(group, idx), match, group)
               .filter(F.col(idx).between(F.col("__start"), F.col("__m.index")))
               .select(group, idx, "__start", "__m").groupBy(group)
               .agg(F.countDistinct(idx).alias("__n"), F.first("__start").alias("__start"),
                    F.first("__m").alias("__m")))
    return (between.filter(F.col("__n") == F.col("__m.index") - F.col("__start") + 1)
                   .select(group, "__m.*"))
