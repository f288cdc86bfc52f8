"""Keyed merges: last row per key (A2), upsert (K1), keyed update (K2).

All three are plain DataFrame -> DataFrame plans.  The dedup is an
aggregation (the largest row in a total order), so it combines map-side
before the shuffle and a hot key costs one partial row per task, never
a whole group in one task.  Writing the merged table is left to
``linefeed.plans.sinks`` (a new version folder per write).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefeed.operators.expand import repeat_rows
from linefeed.operators.joins import join_dimension, measured_copy

_TABLE_NAME = re.compile(r"^[A-Za-z0-9_]*[A-Za-z0-9][A-Za-z0-9_]*$")
_SRC, _TGT = "__in_source", "__in_target"
#: What a merge did with a row of its result; see ``flag``.
INSERTED, UPDATED, UNCHANGED = "inserted", "updated", "unchanged"


def _c(name: str) -> Column:
    return F.col("`" + name + "`")


def check_table_name(table: str) -> str:
    """K4: letters, digits and '_' only, with at least one letter or digit."""
    if not isinstance(table, str) or not _TABLE_NAME.match(table):
        raise ValueError(f"invalid table name: {table!r}")
    return table


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _rank(values: Sequence[str], order_by: Sequence[str | Column]) -> tuple[Column, dict[str, str]]:
    """A struct that orders rows by ``order_by`` and then all ``values``, and where in it each value stands."""
    ranked = []  # (value column, or None for anything else to order by; the expression)
    for o in order_by:
        known = o if isinstance(o, str) and o in values else None
        if known is None or known not in [c for c, _ in ranked]:
            ranked.append((known, _c(known) if known else F.col(o) if isinstance(o, str) else o))
    ranked += [(c, _c(c)) for c in values if c not in [c for c, _ in ranked]]
    return (F.struct(*[e.alias(f"_{i}") for i, (_, e) in enumerate(ranked or [(None, F.lit(True))])]),
            {c: f"_{i}" for i, (c, _) in enumerate(ranked) if c is not None})


def last_per_key(df: DataFrame, keys: str | Sequence[str],
                 order_by: Sequence[str | Column], null_safe: bool = False) -> DataFrame:
    """A2: for each key keep the row that is last in ``order_by``.

    The order is made total by appending all remaining columns, so the
    pick never depends on task timing.  Rows whose key holds a NULL are
    kept as they are (a NULL key never equals another key), or, with
    ``null_safe``, count as equal where their NULLs stand in the same places.

    One aggregation over one pass of ``df``: its buffer holds every column
    once, in rank order, and the largest is the last row.  Kept rows with a
    NULL in the key are grouped by their whole content, which deals them
    out, and come back as often as they were.
    """
    keys = _as_list(keys)
    if not order_by:
        raise ValueError("last_per_key needs an explicit order_by")
    value_cols = [c for c in df.columns if c not in keys]
    rank, place = _rank(value_cols, order_by)
    row = [_c(c) if c in keys else F.col("__row")[place[c]].alias(c) for c in df.columns]
    grouped = [_c(k) for k in keys]
    if null_safe or not any(df.schema[k].nullable for k in keys):
        return df.groupBy(*grouped).agg(F.max(rank).alias("__row")).select(*row)
    alone = F.when(_any_null(df, keys), rank)
    picked = df.groupBy(*grouped, alone.alias("__alone")).agg(
        F.max(rank).alias("__row"), F.count(F.lit(1)).alias("__n"))
    copies = F.when(F.col("__alone").isNotNull(), F.col("__n")).otherwise(F.lit(1))
    return repeat_rows(picked.withColumn("__n", copies), "__n", "__copy").select(*row)


def _any_null(df: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | _c(k).isNull()
    return cond


def _named(order_by) -> bool:
    """Whether the order is told by columns alone, without expressions."""
    return all(isinstance(o, str) for o in order_by or [])


def _order_only(order_by, target: DataFrame) -> list[str]:
    """Order columns the target lacks: used to pick the last row, never written."""
    return [o for o in (order_by or []) if isinstance(o, str) and o not in target.columns]


_WHOLE = "__whole_key"


def _whole_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with its key as one struct, which is never NULL and equals another where all parts, NULLs too, are equal."""
    return df.withColumn(_WHOLE, F.struct(*[_c(k) for k in keys]))


def one_per_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None,
                null_safe: bool = False) -> DataFrame:
    """The last row per key in ``order_by``, or in the order of all other columns.

    Rows with a NULL in the key are kept as they are, or, with
    ``null_safe``, count as equal where their NULLs stand in the same places.
    """
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        null_key = F.lit(False) if null_safe else _any_null(source, keys)
        return source.filter(~null_key).distinct().unionByName(source.filter(null_key))
    return last_per_key(source, keys, order_by or rest, null_safe)


def upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
           order_by: Sequence[str | Column] | None = None,
           broadcast_max_rows: int | None = None, null_keys: str = "insert",
           flag: str | None = None, unique: bool = False) -> DataFrame:
    """K1: ``INSERT ... ON DUPLICATE KEY UPDATE`` on every source column.

    * a matched key takes all source columns, NULLs included;
    * target-only columns keep their value on a match, NULL on insert;
    * target rows without a source key stay unchanged;
    * several source rows per key: the last one in ``order_by`` wins, or,
      without ``order_by``, the last in the order of all their columns, so
      the result has one row per key whatever the source repeats; order
      columns the target lacks (e.g. a file's line number) only rank rows;
    * order columns the target has (e.g. a snapshot time) also protect it:
      a source row that ranks before the stored one changes nothing;
    * a source row with a NULL key is inserted (``null_keys="insert"``), left
      out (``"skip"``), refused (``"error"``, one small job), or matched like
      any other, a NULL being equal to a NULL (``"match"``), so that a reload
      changes nothing;
    * ``flag`` names a column to add that says of every row of the result
      whether it was inserted, updated or left unchanged;
    * ``unique`` says that the source has one row per key already.

    Plan: when the deduplicated source passes the broadcast size check (the
    usual case: a load is small next to its table), the target is never
    shuffled: one broadcast left join over the target applies the matches,
    and a key-only semi join finds which source keys are new.  Otherwise
    both sides meet in one shuffled full outer join.
    """
    keys = _as_list(keys)
    order_only = _order_only(order_by, target)
    unknown = [c for c in source.columns if c not in target.columns and c not in order_only]
    if unknown:
        raise ValueError(f"source columns not in target: {unknown}")
    missing = [k for k in keys if k not in source.columns or k not in target.columns]
    if missing:
        raise ValueError(f"key columns missing: {missing}")
    if null_keys not in ("insert", "skip", "error", "match"):
        raise ValueError("null_keys must be insert, skip, error or match")
    if null_keys == "match":
        # the key stands once in a row: as the struct, which gives its columns back afterwards
        rank = [o for o in (order_by or []) if o not in keys] if _named(order_by) else order_by
        kept = [] if _named(order_by) else keys
        merged = upsert(*(_whole_key(side, keys).drop(*(k for k in keys if k not in kept)) for side in (target, source)),
                        _WHOLE, rank, broadcast_max_rows, flag=flag, unique=unique)
        return merged.select(*[F.col(_WHOLE)[c].alias(c) if c in keys and c not in kept else _c(c)
                               for c in target.columns], *([] if flag is None else [flag]))
    if null_keys != "insert":
        without = source.filter(_any_null(source, keys))
        if null_keys == "error" and without.limit(1).count():
            raise ValueError(f"source rows with a NULL in the key {keys}")
        source = source.filter(~_any_null(source, keys))
    src = (source if unique else one_per_key(source, keys, order_by)).drop(*order_only)
    # stored order columns: only a source row that does not rank before the stored one applies
    ranks = [o for o in (order_by or []) if isinstance(o, str) and o in target.columns and o not in keys]
    source_cols = src.columns
    values = [c for c in source_cols if c not in keys]
    # NULL keys never match; keep them out of the join so they cannot pile up
    # in the one shuffle partition that NULL hashes to
    src_null, tgt_null = _any_null(src, keys), _any_null(target, keys)
    src_keyed, src_unkeyed = src.filter(~src_null), src.filter(src_null)
    tgt_keyed, tgt_unkeyed = target.filter(~tgt_null), target.filter(tgt_null)
    s_side = src_keyed.select(*[_c(k) for k in keys], *[_c(c).alias(_SRC + c) for c in values],
                              F.lit(True).alias(_SRC))
    matched = F.col(_SRC).isNotNull()
    if ranks:
        stored = F.struct(*[_c(o) for o in ranks])
        matched = matched & (F.struct(*[_c(_SRC + o) for o in ranks]) >= stored)

    def merged_columns():
        out = []
        for c in target.columns:
            if c in keys:
                out.append(_c(c))
            elif c in values:
                out.append(F.when(matched, _c(_SRC + c)).otherwise(_c(c)).alias(c))
            else:
                out.append(_c(c))
        return out

    def flagged(what: Column | str) -> list[Column]:
        return [] if flag is None else [(F.lit(what) if isinstance(what, str) else what).alias(flag)]

    def as_inserted(df: DataFrame) -> DataFrame:
        return df.select(*[(_c(c) if c in keys else _c(_SRC + c).alias(c)) if c in source_cols
                           else F.lit(None).cast(target.schema[c].dataType).alias(c)
                           for c in target.columns], *flagged(INSERTED))

    did = F.when(matched, F.lit(UPDATED)).otherwise(F.lit(UNCHANGED))

    materialized, fits = measured_copy(s_side, max_rows=broadcast_max_rows)
    if fits:
        small = materialized
        updated = tgt_keyed.join(F.broadcast(small), keys, "left").select(
            *merged_columns(), *flagged(did))
        hit = tgt_keyed.select(*keys).join(F.broadcast(small.select(*keys)), keys, "left_semi")
        inserted = as_inserted(small.join(hit, keys, "left_anti"))
        merged = updated.unionByName(inserted)
    else:
        # a source key the target lacks has all-NULL order columns, which rank first
        joined = tgt_keyed.withColumn(_TGT, F.lit(True)).join(materialized, keys, "full_outer")
        merged = joined.select(*merged_columns(), *flagged(
            F.when(F.col(_TGT).isNull(), F.lit(INSERTED)).otherwise(did)))
    unkeyed = src_unkeyed.select(*[_c(c) if c in source_cols
                                   else F.lit(None).cast(target.schema[c].dataType).alias(c)
                                   for c in target.columns], *flagged(INSERTED))
    return merged.unionByName(tgt_unkeyed.select("*", *flagged(UNCHANGED))).unionByName(unkeyed)


def upsert_in_parts(target: DataFrame, source: DataFrame, keys: Sequence[str], part: str, parts: int,
                    order_by: Sequence[str | Column] | None = None, null_keys: str = "insert",
                    flag: str | None = None) -> DataFrame:
    """K1 as :func:`upsert` has it, for a target with one row per key, laid out by ``part``.

    ``part`` is a column of both that follows from the key.  Both sides are
    dealt out by it once; a key's rows meet there in one aggregation, and
    the result, which has ``part`` too, can be written without another
    shuffle.
    """
    order_only = _order_only(order_by, target)
    values = [c for c in source.columns if c not in keys and c != part]
    unknown = [c for c in values if c not in target.columns and c not in order_only]
    if unknown:
        raise ValueError(f"source columns not in target: {unknown}")
    stored = [c for c in target.columns if c not in keys and c != part]
    rank, place = _rank(values, order_by or values)
    new, old = F.col("__new"), F.col("__old")
    by = [_c(part), *[_c(k) for k in keys]]
    rows = target.select(*by, F.struct(F.lit(True).alias("__is"), *[_c(c) for c in stored]).alias("__old")).unionByName(
        source.select(*by, rank.alias("__new")), allowMissingColumns=True).repartition(parts, part)
    # rows with a NULL in the key stay apart: each content is a group of its own, as often as it is there
    alone = F.when(_any_null(rows, keys) if null_keys == "insert" else F.lit(False), F.struct("__old", "__new"))
    met = rows.groupBy(*by, alone.alias("__alone")).agg(
        F.first("__old", ignorenulls=True).alias("__old"), F.max("__new").alias("__new"),
        F.count(F.lit(1)).alias("__n"))
    met = repeat_rows(met.withColumn("__n", F.when(F.col("__alone").isNotNull(), F.col("__n")).otherwise(F.lit(1))),
                      "__n", "__copy")
    applies = new.isNotNull()
    ranks = [o for o in (order_by or []) if isinstance(o, str) and o in stored]
    if ranks:
        applies = applies & (old.isNull() | (F.struct(*[new[place[o]] for o in ranks])
                                             >= F.struct(*[old[o] for o in ranks])))
    out = [_c(c) if c in keys else
           (F.when(applies, new[place[c]]).otherwise(old[c]) if c in place else old[c]).alias(c)
           for c in target.columns if c != part]
    did = F.when(old.isNull(), F.lit(INSERTED)).when(applies, F.lit(UPDATED)).otherwise(F.lit(UNCHANGED))
    return met.select(*out, *([] if flag is None else [did.alias(flag)]), _c(part))


def update_by_key(target: DataFrame, source: DataFrame, key: str,
                  order_by: Sequence[str | Column] | None = None, flag: str | None = None) -> DataFrame:
    """K2: ``UPDATE target SET <source columns> WHERE key = ?`` for each source row.

    Every target row with a matching key is updated (one source row may
    hit many); unknown and NULL keys change nothing; nothing is inserted,
    so the target keeps its row count.  The last source row per key in
    ``order_by`` wins, or, without it, in the order of all source columns.
    ``flag`` adds a column that says which rows were updated.
    """
    if key not in source.columns:
        raise ValueError(f"key column '{key}' does not exist in the source")
    if key not in target.columns:
        raise ValueError(f"key column '{key}' does not exist in the target")
    order_only = _order_only(order_by, target)
    set_cols = [c for c in source.columns if c != key and c not in order_only]
    if not set_cols:
        raise ValueError("source has no column to update besides the key")
    unknown = [c for c in set_cols if c not in target.columns]
    if unknown:
        raise ValueError(f"source columns not in target: {unknown}")
    src = source.filter(_c(key).isNotNull())
    src = one_per_key(src, [key], order_by)
    # one row per key after the dedup: a dimension of the target, broadcast when
    # its size check passes, shuffled (AQE splits hot target keys) otherwise
    src = src.select(_c(key), *[_c(c).alias(_SRC + c) for c in set_cols],
                     F.lit(True).alias(_SRC))
    # target rows with a NULL key match nothing: route them around the join
    tgt_keyed, tgt_unkeyed = target.filter(_c(key).isNotNull()), target.filter(_c(key).isNull())
    joined = join_dimension(tgt_keyed, src, key, "left")
    matched = F.col(_SRC).isNotNull()
    out = []
    for c in target.columns:
        if c in set_cols:
            out.append(F.when(matched, _c(_SRC + c)).otherwise(_c(c)).alias(c))
        else:
            out.append(_c(c))
    if flag is not None:
        out.append(F.when(matched, F.lit(UPDATED)).otherwise(F.lit(UNCHANGED)).alias(flag))
        tgt_unkeyed = tgt_unkeyed.withColumn(flag, F.lit(UNCHANGED))
    return joined.select(*out).unionByName(tgt_unkeyed)
