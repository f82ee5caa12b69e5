"""Upserts and dimension history, each as one join of the table with the batch."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.digests import row_digest
from tidemark.functions.moments import day, moment
from tidemark.session import settled

CHANGE = "_change"  # kept, closed, new or changed


def one_per_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """The last row of each key by `order_by`, then by the remaining columns.

    It is an aggregate, so map-side combining shrinks a key with very many copies before the shuffle.
    Rows with a NULL in the key equal no other row and all stay.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [c for c in (order_by or []) if c in rest]
    ranked += [c for c in rest if c not in ranked]
    whole_key = reduce(and_, [F.col(k).isNotNull() for k in keys])
    if not ranked:
        return df.where(whole_key).distinct().unionByName(df.where(~whole_key))
    last = df.where(whole_key).groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_last"))
    return (
        last.select(*keys, "_last.*").select(*df.columns).unionByName(df.where(~whole_key))
    )


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    run_ts: datetime | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """The table after insert-or-update on `keys`, with the columns of `existing`.

    A row already there takes `update_cols` from the batch (all batch columns but the keys and
    `created_at`, unless given) and keeps the others; a row not there takes all batch columns. If a
    key comes twice in the batch, its last row counts.
    """
    batch = one_per_key(incoming, keys, order_by)
    if update_cols is None:
        update_cols = [c for c in incoming.columns if c not in keys and c != "created_at"]
    now = moment(run_ts) if run_ts else None

    def sided(df: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
        """The rows that can match, with their keys, and the rows with a NULL in the key."""
        whole_key = reduce(and_, [F.col(k).isNotNull() for k in keys])
        row = F.struct(*df.columns).alias(side)
        named = [F.col(k).alias(f"{side}{i}") for i, k in enumerate(keys)]
        return df.where(whole_key).select(row, *named), df.where(~whole_key).select(row)

    old, old_apart = sided(existing, "_old")
    new, new_apart = sided(batch, "_new")
    on = reduce(and_, [F.col(f"_old{i}") == F.col(f"_new{i}") for i in range(len(keys))])
    # Rows with a NULL in the key match nothing; joined, they would all meet in one task.
    pairs = (
        old.join(new, on, "full_outer")
        .select("_old", "_new")
        .unionByName(old_apart, allowMissingColumns=True)
        .unionByName(new_apart, allowMissingColumns=True)
    )
    inserted, untouched = F.col("_old").isNull(), F.col("_new").isNull()

    def value(name: str) -> Column:
        was = F.col(f"_old.{name}")
        arrived = F.col(f"_new.{name}") if name in batch.columns else None
        if name in keys:
            return F.when(inserted, arrived).otherwise(was)
        if name == "updated_at" and now is not None:
            return F.when(untouched, was).otherwise(now)
        if name == "created_at" and now is not None:
            return F.when(inserted, now if arrived is None else arrived).otherwise(was)
        if arrived is None:
            return was
        if name in update_cols:
            return F.when(untouched, was).otherwise(arrived)
        return F.when(inserted, arrived).otherwise(was)

    return pairs.select(
        *[value(f.name).cast(f.dataType).alias(f.name) for f in existing.schema]
    )


def overwrite_dimension(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    run_ts: datetime | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Type 1 dimension: the batch replaces what is there, without history."""
    return upsert(existing, incoming, [key], run_ts=run_ts, order_by=order_by)


def dimension_changes(current: DataFrame, batch: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """The keys of a batch that are new or changed: key, `_change`, and the version the changed ones are at.

    Only keys and digests of the compared columns meet; a digest tells text and NULL apart. `batch` has each key
    once. A key with more than one current row is an error.
    """
    compared = [c for c in compare if c in batch.columns and c in current.columns]

    def digested(df: DataFrame) -> list[Column]:
        return [c.alias(f"_d{i}") for i, c in enumerate(row_digest([F.col(c) for c in compared]))]

    unique = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit(f"more than one current row of {key} "), F.col(key).cast("string")))
    )
    old = (
        current.where(F.col(key).isNotNull())
        .select(key, F.coalesce("version_number", F.lit(1)).alias("_v"), *digested(current))
        .groupBy(key)
        .agg(F.coalesce(unique.cast("int"), F.max("_v")).alias("_at"), F.max("_d0").alias("_o0"), F.max("_d1").alias("_o1"))
    )
    differs = (F.col("_d0") != F.col("_o0")) | (F.col("_d1") != F.col("_o1"))
    change = F.when(F.col("_at").isNull(), "new").when(differs, "changed")
    return (
        batch.select(key, *digested(batch))
        .join(old, key, "left")
        .select(key, change.alias(CHANGE), "_at")
        .where(F.col(CHANGE).isNotNull())
    )


def changed_versions(
    current: DataFrame, batch: DataFrame, key: str, changes: DataFrame, as_of: date, run_ts: datetime | None = None
) -> DataFrame:
    """What current rows become: kept, closed, and opened as new or changed, told apart by `_change`."""
    now = moment(run_ts) if run_ts else F.lit(None)
    moved = changes.where(F.col(CHANGE) == "changed").select(key)

    def rows(df: DataFrame, change: Column, values: dict[str, Column]) -> DataFrame:
        columns = [
            values.get(f.name, F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in current.schema
        ]
        return df.select(*columns, change.alias(CHANGE))

    kept = rows(current.join(moved, key, "left_anti"), F.lit("kept"), {})
    ended = {"effective_end_date": day(as_of), "is_current": F.lit(False), "updated_at": now}
    closed = rows(current.join(moved, key, "left_semi"), F.lit("closed"), ended)
    started = {
        "effective_start_date": day(as_of),
        "effective_end_date": F.lit(None),
        "is_current": F.lit(True),
        "version_number": F.coalesce(F.col("_at") + 1, F.lit(1)),
        "created_at": now,
        "updated_at": now,
    }
    opened = rows(batch.join(changes, key), F.col(CHANGE), started)
    return kept.unionByName(closed).unionByName(opened)


def version_dimension(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    compare: list[str],
    as_of: date,
    run_ts: datetime | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Type 2 dimension: what the current rows become after the batch.

    A key not seen before opens version 1. A key whose compared columns differ as text closes its
    current row and opens the next version. Keys absent from the batch and unchanged ones stay. The
    result has the columns of `current` plus `_change`, which tells kept, closed, new and changed rows
    apart; rows closed earlier are not read, and need not be rewritten. The changes are settled first, so
    wide rows move only where one changed.
    """
    batch = one_per_key(incoming.where(F.col(key).isNotNull()), [key], order_by)
    changes = settled(dimension_changes(current, batch, key, compare))
    return changed_versions(current, batch, key, changes, as_of, run_ts)


def change_counts(versions: DataFrame) -> DataFrame:
    """How many keys a batch inserted and how many it gave a new version."""
    return versions.agg(
        F.count_if(F.col(CHANGE) == "new").alias("inserted"),
        F.count_if(F.col(CHANGE) == "changed").alias("updated"),
    )


def versions_of(dimension: DataFrame, key: str, value: str | None = None) -> DataFrame:
    """All versions of one key, or of every key, by version number."""
    chosen = dimension if value is None else dimension.where(F.col(key) == value)
    return chosen.orderBy(key, "version_number")
