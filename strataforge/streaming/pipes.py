"""The two streams: CSV files to raw parquet, and raw parquet to cleaned, keyed tables."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import stamp_in_name
from ..operators.keyed import KeyedTable, day_of
from ..plans.schemas import KEYS, LOAD_COLUMNS, LOAD_ORDER, RAW, SILVER
from ..plans.silver import cleaned
from ..sources.landing import accepted_rows, csv_rows, file_report, numbered
from .history import StreamHistory, Suspended


_FILES = "path string, modificationTime timestamp, length long, content binary"


class Lake:
    """Where the tables of one installation are: landing, bronze, silver, gold and the streams' checkpoints under a root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.name = self.root.rsplit("/", 1)[-1]  # streams of two lakes in a session need names of their own

    def history(self) -> StreamHistory:
        """What the streams of this lake did, as far as they were watched."""
        return StreamHistory(self.spark, self.path("stream_history"), f"{self.name}:")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def bronze_schema(self, table: str):
        return type(RAW[table])([*RAW[table].fields, *LOAD_COLUMNS.fields])

    def bronze(self, table: str) -> DataFrame:
        return self.spark.read.schema(self.bronze_schema(table)).parquet(self.path("bronze", table))

    def silver(self, table: str) -> KeyedTable:
        """By the day in the name of the file that a row came with; the tables of names are one partition."""
        day = None if table.endswith("_ref") else day_of(F.coalesce(stamp_in_name(F.col("file_name")), F.col("ldts")))
        return KeyedTable(self.spark, self.path("silver", table), SILVER[table], KEYS[table], day)

    def silver_tables(self) -> dict[str, DataFrame]:
        return {t: self.silver(t).read() for t in SILVER}


def once_or_every(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def land(lake: Lake, table: str, every: str | None = None) -> StreamingQuery:
    """New CSV files of a table into bronze, each batch in a folder of its own number: a batch that is run again replaces
    what it wrote. Bad files are left out and reported. Without `every`, all that is there is taken and the query ends."""

    def write(batch: DataFrame, batch_id: int) -> None:
        files = batch.collect()  # a row per file
        if not files:
            return
        batch = csv_rows(lake.spark, [f.path for f in files], table, F.lit(files[0].ldts).cast("timestamp_ntz")).persist()
        report = file_report(batch).withColumn("loaded_at", F.localtimestamp()).withColumn("table", F.lit(table))
        rows = accepted_rows(numbered(batch), report).select(lake.bronze_schema(table).names)
        rows.write.mode("overwrite").parquet(lake.path("bronze", table, f"batch={batch_id}"))
        report.write.mode("overwrite").parquet(lake.path("load_history", f"table={table}", f"batch={batch_id}"))
        batch.unpersist()

    # the stream names the files, whose contents it does not open; each batch reads them in splits, where they can be split
    files = lake.spark.readStream.schema(_FILES).format("binaryFile").option("pathGlobFilter", f"{table}*").load(lake.path("landing"))
    writer = files.select("path", F.localtimestamp().cast("string").alias("ldts")).writeStream.foreachBatch(write).queryName(f"{lake.name}:land:{table}").option("checkpointLocation", lake.path("checkpoints", "land", table))
    return once_or_every(writer, every).start()


def refine(lake: Lake, table: str, every: str | None = None) -> StreamingQuery:
    """New bronze rows, cleaned, upserted into silver. A batch that is run again changes nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        lake.silver(table).upsert(cleaned(table, batch), LOAD_ORDER)

    stream = lake.spark.readStream.schema(lake.bronze_schema(table)).option("recursiveFileLookup", "true").parquet(lake.path("bronze", table))
    writer = stream.writeStream.foreachBatch(merge).queryName(f"{lake.name}:refine:{table}").option("checkpointLocation", lake.path("checkpoints", "refine", table))
    return once_or_every(writer, every).start()


def run_until_done(start: Callable[[], StreamingQuery], attempts: int = 3, pause: float = 0.0) -> None:
    """Run a query that ends by itself; after `attempts` failures in a row the last error is raised."""
    for attempt in range(attempts):
        try:
            start().awaitTermination()
            return
        except Exception:
            if attempt + 1 == attempts:
                raise
            time.sleep(pause)


def run_guarded(history: StreamHistory, stream: str, start: Callable[[], StreamingQuery]) -> None:
    """Run a query that ends by itself, unless the history says that its stream is suspended."""
    history.check(stream)
    start().awaitTermination()


def refresh_watched(lake: Lake, tables: tuple[str, ...] = tuple(RAW)) -> dict[str, str]:
    """As `refresh`, with every run in the lake's history; what keeps a stream from running is returned by its name, and
    the other streams go on. A stream that has failed three times in a row stays away until it is resumed."""
    history, kept = lake.history(), {}
    with history.watching():
        for stage, start in (("land", land), ("refine", refine)):
            for table in tables:
                name = f"{lake.name}:{stage}:{table}"
                try:
                    run_guarded(history, name, lambda s=start, t=table: s(lake, t))
                except (Suspended, StreamingQueryException, AnalysisException) as e:
                    kept[name] = str(e)
    return kept


def refresh(lake: Lake, tables: tuple[str, ...] = tuple(RAW)) -> None:
    """Take all new files through both streams. Tables without a file yet are left out."""
    for table in tables:
        run_until_done(lambda t=table: land(lake, t))
        if lake.spark._jvm.org.apache.hadoop.fs.Path(lake.path("bronze", table)).getFileSystem(lake.spark._jsc.hadoopConfiguration()).exists(lake.spark._jvm.org.apache.hadoop.fs.Path(lake.path("bronze", table))):
            run_until_done(lambda t=table: refine(lake, t))
