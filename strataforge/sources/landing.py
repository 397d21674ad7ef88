"""Files: reading CSV as text rows with load columns, rejecting bad files, listing folders, writing CSV."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..plans.schemas import RAW

# What a row says about where it came from.
SOURCES = {t: "League Static Data" if t.endswith("_ref") else "Kaggle simulated daily ingestion" for t in RAW}
BACKFILL_SOURCE = "Manual backfill"
#: Share of bad rows, in percent, from which a whole file is rejected.
REJECT_PERCENT = 10

_CSV = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "enforceSchema": "true", "columnPruning": "false"}


def csv_schema(table: str) -> T.StructType:
    return T.StructType([*RAW[table].fields, T.StructField("_bad", T.StringType())])


def csv_options(table: str, multi_line: bool = False) -> dict[str, str]:
    """Comma, one header line that is skipped, optional quotes, trimmed; files are matched by the table's prefix. With
    multi_line a quoted field may go over lines, and a file is read by one task."""
    return _CSV | {"pathGlobFilter": f"{table}*", "multiLine": str(multi_line).lower()}


def _null_word(column: Column) -> Column:
    return F.when(~column.isin("", "NULL"), column)


def with_load_columns(rows: DataFrame, table: str, loaded_at: Column | None = None, source: str | None = None) -> DataFrame:
    """Source columns, with the words '' and NULL as null, then ldts, file_name, rsrc and the flag of bad rows.

    The flag names a source column, though it does not depend on it: Spark refuses to read the flag alone.
    """
    bad = F.when(F.length(F.coalesce(F.col(RAW[table].names[0]), F.lit(""))) >= 0, F.col("_bad"))
    return rows.select(
        *[_null_word(F.col(c)).alias(c) for c in RAW[table].names], (F.localtimestamp() if loaded_at is None else loaded_at).alias("ldts"),
        F.col("_metadata.file_path").alias("file_name"), F.lit(source or SOURCES[table]).alias("rsrc"), bad.alias("_bad"), F.col("_metadata.file_block_start").alias("_block"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """file_row_number from 1, in the order of the file. Rows of a block of a file lie one after the other in a partition of
    what was read, so a row's number is its distance from the first row of its block, plus the rows of the blocks before. Rows
    are not moved or sorted for it; what goes to all tasks is a row per block."""
    placed = rows.withColumn("_order", F.monotonically_increasing_id())
    blocks = placed.groupBy("file_name", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_order").alias("_first"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy("file_name").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("file_name", "_block", (before - F.col("_first") + 1).alias("_shift"))
    return placed.join(F.broadcast(starts), ["file_name", "_block"]).withColumn("file_row_number", (F.col("_order") + F.col("_shift")).cast("bigint")).drop("_order", "_shift", "_block")


def file_report(rows: DataFrame, reject_percent: int = REJECT_PERCENT) -> DataFrame:
    """file_name, parsed, rejected, first_error, accepted. Rows with too few or too many fields are errors."""
    out = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("parsed"), F.count("_bad").alias("rejected"), F.min("_bad").alias("first_error"))
    return out.withColumn("accepted", 100 * F.col("rejected") < reject_percent * F.col("parsed"))


def accepted_rows(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Rows of accepted files, without the bad ones. The names of files go to all tasks: rows of one file are many tasks' work."""
    good = report.where("accepted").select("file_name")
    return rows.where(F.col("_bad").isNull()).join(F.broadcast(good), "file_name", "left_semi").drop("_bad")


def same_path(column: Column) -> Column:
    """A path as both the file sources and the metadata columns write it: one slash after the scheme."""
    return F.regexp_replace(column, "^([a-zA-Z0-9]+):/+", "$1:/")


def broken_over_lines(spark: SparkSession, folder: str | list[str], pattern: str) -> DataFrame:
    """(path) of the files, of a folder or named, with a quoted line break: those in which some line has an odd number of quotes.

    Lines are looked at in splits of any place, so a large file is many tasks' work.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
    return lines.where(F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1).select("path").distinct()


def csv_rows(spark: SparkSession, paths: list[str], table: str, loaded_at: Column | None = None, source: str | None = None, pattern: str | None = None) -> DataFrame:
    """Rows with load columns of the files that are named. Those with a quoted line break are read whole, each by a task;
    all others in splits."""
    pattern = pattern or f"{table}*"
    named = {_plain_path(p): _literal(p) for p in paths}
    whole = {_plain_path(unquote(r.path)) for r in broken_over_lines(spark, list(named.values()), pattern).collect()}  # names of files, as paths are
    out = None
    for multi_line, some in ((False, [n for p, n in named.items() if p not in whole]), (True, [n for p, n in named.items() if p in whole])):
        if some:
            rows = with_load_columns(spark.read.schema(csv_schema(table)).options(**csv_options(table, multi_line) | {"pathGlobFilter": pattern}).csv(some), table, loaded_at, source)
            out = rows if out is None else out.unionByName(rows)
    return out


def read_csv(spark: SparkSession, folder: str, table: str, source: str | None = None, loaded_at: Column | None = None, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with load columns of the accepted files, the report on all files). Files: the table's prefix, or a pattern.

    Files with a quoted line break are read whole, each by a task; all others in splits.
    """
    pattern = pattern or f"{table}*"
    whole = [r.path for r in broken_over_lines(spark, folder, pattern).collect()]  # names of files, of which the driver lists all anyway
    read = lambda multi_line, *paths: spark.read.schema(csv_schema(table)).options(**csv_options(table, multi_line) | {"pathGlobFilter": pattern}).csv(list(paths))
    path = same_path(F.col("_metadata.file_path"))
    raw = with_load_columns(read(False, folder).where(~path.isin([_plain_path(p) for p in whole])) if whole else read(False, folder), table, loaded_at, source)
    if whole:
        raw = raw.unionByName(with_load_columns(read(True, *whole), table, loaded_at, source))
    report = file_report(raw)
    return accepted_rows(numbered(raw), report), report


def _literal(path: str) -> str:
    """A path for a reader that takes signs of patterns for what they are."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _plain_path(path: str) -> str:
    scheme, slash, rest = path.partition(":/")
    return f"{scheme}:/{rest.lstrip('/')}" if slash else path


def load_errors(history: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Files of the last days in which a row was rejected, newest first."""
    return history.where((F.col("rejected") > 0) & (F.col("loaded_at") >= now - F.expr(f"interval {days} days"))).orderBy(F.desc("loaded_at"), "file_name")


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, size and time of the files of a folder and of those in it. No file is opened: the column of contents is not
    asked for. Sizes and times come from tasks, which pass over empty files; the index of the source, which lists many
    folders by a job, knows those too: they have size 0 and no time."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup="true").load(folder)
    sized = files.select(same_path(F.col("path")).alias("_path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    named = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string")
    return named.join(sized, same_path(F.col("path")) == F.col("_path"), "left").select("path", F.coalesce("size", F.lit(0)).alias("size"), "modified")


def unloaded(files: DataFrame, history: DataFrame) -> DataFrame:
    """The files of a listing that the load history (file_name) does not know, among them those without a row."""
    known = history.select(same_path(F.col("file_name")).alias("_known")).distinct()
    return files.join(known, same_path(F.col("path")) == F.col("_known"), "left_anti")


def has_data(files: DataFrame, history: DataFrame) -> bool:
    """Whether a file that is not empty waits to be loaded."""
    return bool(unloaded(files, history).where("size > 0").take(1))


def count_lines(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Rows in the CSV files that match, header lines aside."""
    return spark.read.options(header="true", pathGlobFilter=pattern).csv(folder).agg(F.count(F.lit(1)).alias("n"))


def export_csv(df: DataFrame, folder: str) -> None:
    """CSV part files with headers, each written by a task, in a folder that is replaced. Quotes are doubled, so that
    quotes, commas and line breaks in a field come back as they were."""
    df.write.mode("overwrite").options(header="true", quote='"', escape='"', emptyValue="").csv(folder)


def unload_csv(df: DataFrame, folder: str) -> None:
    """One CSV file with a header, in a folder that is replaced. For exports that one file is meant to hold."""
    export_csv(df.coalesce(1), folder)
