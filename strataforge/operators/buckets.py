"""Writing to buckets."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Files that a task writes at once.
WRITERS = 256


@contextmanager
def many_files(spark: SparkSession) -> Iterator[None]:
    """Tasks that write to buckets keep the files of theirs open, up to WRITERS, and don't sort their rows by bucket first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), WRITERS)))
    try:
        yield
    finally:
        spark.conf.set(name, before)
