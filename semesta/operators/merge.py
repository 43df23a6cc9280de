"""Write rules of the warehouse tables as joins: each returns the rows to write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_if_absent(source: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Source rows whose key is not there yet; existing rows are never changed.

    A NULL key part equals nothing, so such a row counts as absent.
    """
    return source.join(existing.select(*key), key, "left_anti")


def insert_or_ignore(batch: DataFrame, existing: DataFrame, key: list[str], arrival: list[str]) -> DataFrame:
    """Conflict-free part of a batch: the existing row wins, then the one of the batch that arrived first.

    ``arrival`` orders the batch, nulls first; rows equal in it are ordered by their other columns, so the same row
    wins whatever the partitions are.
    """
    return insert_if_absent(first_arrived(batch, key, arrival), existing, key)


def first_arrived(batch: DataFrame, key: list[str], arrival: list[str]) -> DataFrame:
    """One row per key: the first by ``arrival``. Combined before the shuffle, so a key with many rows sends few.

    NULL key parts equal nothing, so every row with one stays, as in a database.
    """
    rest = [*arrival, *(c for c in batch.columns if c not in (*key, *arrival))]
    whole = F.struct(*rest)
    named = reduce(Column.__and__, (F.col(c).isNotNull() for c in key))
    winners = batch.filter(named).groupBy(*key).agg(F.min(whole).alias("_first"))
    return winners.select(*key, "_first.*").select(*batch.columns).unionByName(batch.filter(~named))


def upsert(source: DataFrame, existing: DataFrame, key: str, update: list[str]) -> DataFrame:
    """All rows after an upsert on ``key``: ``update`` columns come from the source, others keep the old value.

    Columns the source lacks (a surrogate id) stay NULL on new rows.
    """
    old = existing.select(key, *(F.col(c).alias(f"_old_{c}") for c in existing.columns if c != key), F.lit(True).alias("_known"))
    new = source.select(key, *(c for c in source.columns if c != key), F.lit(True).alias("_sent"))
    merged = new.join(old, key, "full_outer")

    def value(column: str):
        if column == key:
            return F.col(key)
        kept = F.col(f"_old_{column}")
        if column in update:
            return F.when(F.col("_sent"), F.col(column)).otherwise(kept).alias(column)
        if column in source.columns:
            return F.when(F.col("_known"), kept).otherwise(F.col(column)).alias(column)
        return kept.alias(column)

    return merged.select(*map(value, existing.columns))


def outside(existing: DataFrame, impacted: DataFrame, key: str) -> DataFrame:
    """Rows that survive the delete of every impacted ``key``."""
    return existing.join(impacted.select(key), key, "left_anti")


def replace(existing: DataFrame, impacted: DataFrame, rebuilt: DataFrame, key: str) -> DataFrame:
    """Delete-and-rebuild: impacted keys without rebuilt rows end up empty."""
    return outside(existing, impacted, key).unionByName(rebuilt)
