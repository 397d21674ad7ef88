"""Keyed tables as parquet folders by day: an upsert reads and rewrites the days that a batch touches, and no other.

Parquet has no MERGE. A row stands in the partition of a day that batches share (the day of a match, of a file, of an
order), so a batch of one day costs a day and not the table. Where a row's day may change, the days that hold the batch's
keys now are looked up by the key columns alone and are rewritten too.

A write goes twice: first, whole, to a folder beside the table, then over the days in it by dynamic partition overwrite.
Old files stay until the new ones are complete there; a writer that is lost at any moment leaves either the table as it
was, or a complete copy that readers take for those days and the next writer puts in place before anything else. An upsert of the same
batch gives the same rows, so a batch that is run again changes nothing. One writer at a time, as a stream is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rows import latest_rows

#: Partition of rows without a day.
NO_DAY = "none"


def day_of(column: Column | str) -> Column:
    """The partition of a date or timestamp: its day. A table of many years and few rows does better by month."""
    return F.date_format(column, "yyyy-MM-dd")


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], day: Column | None = None, *, moves: bool = True) -> None:
        """day is worked out of a batch's columns; without it the table is one partition, which is right for small ones.
        moves=False says that a key never changes its day, which saves the look at the keys of other days."""
        self.spark, self.path, self.schema, self.keys, self.moves = spark, path.rstrip("/"), schema, keys, moves and day is not None
        self._day = F.lit(NO_DAY) if day is None else F.coalesce(day, F.lit(NO_DAY))
        self._with_day = T.StructType([*schema.fields, T.StructField("_day", T.StringType())])
        self._pending, self._touched = f"{self.path}_pending", f"{self.path}_touched"

    def _exists(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _rows(self, folder: str) -> DataFrame:
        if not self._exists(folder):  # no batch has come yet
            return self.spark.createDataFrame([], self._with_day)
        return self.spark.read.schema(self._with_day).parquet(folder)

    def _complete(self) -> list[str] | None:
        """The days of a complete pending write, or None."""
        return [r.value for r in self.spark.read.text(self._touched).collect()] if self._exists(f"{self._pending}/_SUCCESS") else None

    def _publish(self) -> None:
        """Put a complete pending write in place; drop one that is not complete."""
        days = self._complete()
        if days is not None:
            pending = self._rows(self._pending)
            pending.hint("rebalance", "_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day").parquet(self.path)
            left = {r["_day"] for r in pending.select("_day").distinct().collect()}
            for day in days:
                if day not in left:  # all its rows have moved to other days
                    self._delete(f"{self.path}/_day={day}")
        self._delete(self._pending)

    def read(self) -> DataFrame:
        """All rows; where a complete write is pending, as they are with it."""
        days, rows = self._complete(), self._rows(self.path)
        if days is not None:
            rows = rows.where(~F.col("_day").isin(days)).unionByName(self._rows(self._pending))
        return rows.select(self.schema.names)

    def upsert(self, batch: DataFrame, order: list[str]) -> None:
        """Rows of batch in, in place of those of the same key; of a key that batch has twice, the last by order."""
        if self._exists(self._pending):
            self._publish()
        fresh = latest_rows(batch.withColumn("_day", self._day), self.keys, order).select(self._with_day.names).persist()
        try:
            stored, keys = self._rows(self.path), fresh.select(self.keys)
            days = fresh.select("_day").distinct()
            if self.moves:
                days = days.union(stored.select(*self.keys, "_day").join(keys, self.keys, "left_semi").select("_day")).distinct()
            touched = [r["_day"] for r in days.collect()]  # as many as there are days in a batch
            if touched:
                kept = stored.where(F.col("_day").isin(touched)).join(keys, self.keys, "left_anti").select(self._with_day.names)
                self._write(kept.unionByName(fresh), touched)
                self._publish()
        finally:
            fresh.unpersist()

    def _write(self, rows: DataFrame, touched: list[str]) -> None:
        """The new state of the touched days, beside the table. Days of any size are dealt over tasks by rebalancing."""
        self.spark.createDataFrame([(d,) for d in touched], "value string").coalesce(1).write.mode("overwrite").text(self._touched)
        rows.hint("rebalance", "_day").write.mode("overwrite").partitionBy("_day").parquet(self._pending)
