"""Row operators that Spark lacks as one call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_rows(df: DataFrame, by: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each group. The filter on row_number lets Spark keep k rows a group before the shuffle."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def latest_rows(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by order, nulls first. Rows without a whole key go."""
    whole = batch.dropna(subset=keys)
    return top_rows(whole, keys, [F.col(c).desc_nulls_last() for c in order])


def upsert(target: DataFrame | None, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """target with the rows of batch, which replace those of the same key.

    A batch that has a key twice counts with its last row (by order); the columns of order are left out of the result
    unless target has them. Applying the same batch again changes nothing.
    """
    fresh = latest_rows(batch, keys, order)
    columns = target.columns if target is not None else [c for c in fresh.columns if c not in order or c in keys]
    fresh = fresh.select(columns)
    return fresh if target is None else target.join(fresh.select(keys), keys, "left_anti").unionByName(fresh)


def unseen(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key target does not have; a key with nulls counts as any other.

    Of target only the keys that rows has too are kept, by a semi join that a small batch of rows is broadcast to. So a
    large target is read by its key columns and does not move.
    """
    asked = rows.select(*[F.col(k).alias(f"_asked_{k}") for k in keys]).distinct()
    named = target.select(*[F.col(k).alias(f"_{k}") for k in keys])
    known = named.join(asked, [named[f"_{k}"].eqNullSafe(asked[f"_asked_{k}"]) for k in keys], "left_semi").distinct()
    return rows.join(known, [rows[k].eqNullSafe(known[f"_{k}"]) for k in keys], "left_anti")


def insert_missing(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows, one per key, whose key target does not have yet; a key with nulls counts as any other."""
    return unseen(target, rows.dropDuplicates(keys), keys)


def orphans(rows: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a parent."""
    return rows.join(parents.select(keys).distinct(), keys, "left_anti")
