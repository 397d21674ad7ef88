"""Models as tables of the session's catalogue, with comments and statistics, and what the catalogue knows of them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_KNOWN = T.StructType().add("model", T.StringType()).add("row_count", T.LongType()).add("bytes", T.LongType()).add("comment", T.StringType()).add("columns", T.LongType()).add("comments", T.MapType(T.StringType(), T.StringType()))


def publish(spark: SparkSession, database: str, models: dict[str, DataFrame], comments: dict[str, str] | None = None, location: str | None = None) -> None:
    """Each model in place of the table of its name. Column comments come with the columns' metadata; rows and bytes are
    counted by the catalogue's own statistics."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for name, df in models.items():
        df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")
        text = (comments or {}).get(name, "").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {database}.{name} IS '{text}'")
        spark.sql(f"ANALYZE TABLE {database}.{name} COMPUTE STATISTICS")


def known_tables(spark: SparkSession, database: str) -> DataFrame:
    """(model, row_count, bytes, comment, columns, comments) of the tables of a database, from the catalogue alone."""
    rows = []
    for table in spark.catalog.listTables(database):
        facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{table.name}").collect()}
        numbers = dict((unit, int(n)) for n, unit in re.findall("([0-9]+) (bytes|rows)", facts.get("Statistics", "")))
        columns = spark.catalog.listColumns(f"{database}.{table.name}")
        rows.append((table.name, numbers.get("rows"), numbers.get("bytes"), facts.get("Comment"), len(columns), {c.name: c.description for c in columns if c.description}))
    return spark.createDataFrame(rows, _KNOWN)
