"""The change history as streams: raw rows to a hub and a satellite, and new states to four derived tables.

One micro-batch goes to several tables. Each table is in folders of batches, named after the stream and the number of the
batch (a derived table: after the folder of the satellite that it comes from); a batch that runs again, after a failure anywhere between the first table and the last, replaces what it wrote
and compares itself with all other batches only. So nothing is there twice and nothing is lost, in whichever table the
failure was. A batch that had written its last table (a note of its own says so) before the stream was lost is left as it
is: its files are those that the checkpoint names, so it would write the same. A stream that starts anew with empty
checkpoints finds its rows there already and adds nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.buckets import many_files
from ..plans import vault
from ..plans.schemas import ITEM_SLOTS, LOAD_COLUMNS, RAW
from .pipes import once_or_every

#: Rows of a batch that are few enough to send their keys to all tasks.
SMALL_BATCH = 100_000

_STAGED = T.StructType([*RAW["intervals"].fields, *LOAD_COLUMNS.fields])
_KEYED = T.StructType([T.StructField("key", T.StringType()), *_STAGED.fields])
#: Many files are written at once, so dictionaries are small, and columns that hardly repeat keep none. Dynamic: each
#: writer has a folder of its own until it is done, so that several can write at a time.
_STORED_AS = ", ".join(f"'{k}' '{v}'" for k, v in {
    "partitionOverwriteMode": "dynamic", "compression": "zstd", "parquet.dictionary.page.size": 65536,
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("key", "id", "match_id", "file_row_number")},
}.items())
_BINARY, _TEXT, _LONG, _RATIO = T.BinaryType(), T.StringType(), T.LongType(), T.DecimalType(10, 2)


def _schema(*groups: tuple[list[str], T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for names, kind in groups for name in names])


_KEY = ((vault.HUB[:3], _TEXT), (["minute"], _LONG))
TARGETS = {
    "hub": T.StructType([T.StructField("hub_hash", _BINARY), *_schema((vault.HUB, _TEXT)).fields, LOAD_COLUMNS["ldts"], LOAD_COLUMNS["rsrc"]]),
    "satellite": T.StructType([T.StructField("hub_hash", _BINARY), LOAD_COLUMNS["ldts"], LOAD_COLUMNS["rsrc"], *_schema((vault.STATE, _TEXT)).fields, T.StructField("diff_hash", _BINARY)]),
    "kda": _schema(*_KEY, (["kills", "deaths", "assists"], _LONG), (["kda_ratio"], _RATIO)),
    "economy": _schema(*_KEY, (vault.ECONOMY, _LONG), (["net_cs"], _LONG), (["gold_per_min"], _RATIO)),
    "items": _schema(*_KEY, (ITEM_SLOTS, _LONG)),
    "team_objectives": _schema(*_KEY, (vault.DERIVED["team_objectives"], _LONG), (["total_objectives"], _LONG)),
}
DERIVED = tuple(vault.DERIVED)


class VaultStreams:
    """The tables of TARGETS under root, the raw rows that feed them, and the two streams between."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._table = self._keyed = None

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _history(self) -> str:
        """The table of raw rows, hub and satellite, by target and batch, bucketed by key: who compares or joins them finds
        their rows where they are. The name of its folder tells the number of buckets, which never changes."""
        if self._table is None:
            files, path = self._hadoop(self.root)
            found = [n for n in (f.getPath().getName() for f in files.listStatus(path)) if n.startswith("keyed_")] if files.exists(path) else []
            name = found[0] if found else f"keyed_{self.spark.conf.get('spark.sql.shuffle.partitions')}"
            self._table, columns = f"vault_{uuid.uuid4().hex}.history", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _KEYED.fields)
            self.spark.sql(f"CREATE DATABASE {self._table.split('.')[0]} LOCATION '{self.path('catalogue')}'")
            self.spark.sql(
                f"CREATE TABLE {self._table} ({columns}, target string, batch string) USING parquet OPTIONS ({_STORED_AS}) PARTITIONED BY (target, batch)"
                f" CLUSTERED BY (key) INTO {name.rsplit('_', 1)[-1]} BUCKETS LOCATION '{self.path(name)}'"
            )
            self._keyed = name
            self._see_all()
        return self._table

    def _see_all(self) -> None:
        """What others have written since."""
        if self._exists(self.path(self._keyed)):
            self.spark.sql(f"MSCK REPAIR TABLE {self._table} SYNC PARTITIONS")

    def _stored(self, which: Column) -> DataFrame:
        return self.spark.table(self._history()).where(which)

    def read(self, target: str) -> DataFrame:
        if target in ("hub", "satellite"):
            self._history()
            self._see_all()
            return vault.hashed(self._stored(F.col("target") == target), TARGETS[target].names)
        folder = self.path(target)
        if not self._exists(folder):
            return self.spark.createDataFrame([], TARGETS[target])
        return self.spark.read.schema(T.StructType([*TARGETS[target].fields, T.StructField("batch", T.StringType())])).parquet(folder).select(TARGETS[target].names)

    def known_states(self) -> DataFrame:
        """key and diff_hash of all states that have a row of the hub; they lie bucketed by key."""
        hub = self._stored(F.col("target") == "hub").select("key")
        return vault.hashed(self._stored(F.col("target") == "satellite"), ["key", "diff_hash"]).join(hub.hint("merge"), "key")

    def summary(self) -> DataFrame:
        return vault.player_summary(self.read("kda"), self.read("economy"))

    def _remove(self, target: str, batch: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._history()} DROP IF EXISTS PARTITION (target = '{target}', batch = '{batch}')")
        files, path = self._hadoop(self.path(self._keyed, f"target={target}", f"batch={batch}"))
        files.delete(path, True)

    def _insert(self, target: str, rows: DataFrame, batch: str) -> None:
        """Rows with key into their buckets, in place of what a lost run may have left there."""
        self._remove(target, batch)
        columns = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in _KEYED.fields]
        self.spark.sql(f"INSERT OVERWRITE TABLE {self._history()} PARTITION (target, batch) SELECT * FROM {{rows}}", rows=rows.select(*columns, F.lit(target), F.lit(batch)))

    def _write(self, target: str, rows: DataFrame, batch: str) -> None:
        if target in ("hub", "satellite"):
            return self._insert(target, rows, batch)
        columns = [F.col(f.name).cast(f.dataType) for f in TARGETS[target].fields]
        rows.select(columns).write.mode("overwrite").option("compression", "zstd").parquet(self.path(target, f"batch={batch}"))

    def _write_all(self, tables: dict[str, DataFrame], batch: str) -> None:
        """Tables that do not wait for each other; a failure of one comes up when all have ended."""
        with ThreadPoolExecutor(len(tables)) as pool:
            for written in [pool.submit(self._write, target, rows, batch) for target, rows in tables.items()]:
                written.result()

    def _hadoop(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, folder: str) -> bool:
        files, path = self._hadoop(folder)
        return files.exists(path)

    @staticmethod
    def _files(paths: DataFrame) -> list[str]:
        """The files of a batch of paths. A batch itself can't be cut to columns any more; its files can, for each table."""
        return sorted(unquote(r[0]) for r in paths.distinct().collect())

    def _rows(self, files: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def _note(self, stream: str, batch: str, lines: list[str]) -> None:
        """That a batch has written all its tables, and what it read."""
        self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(self.path("notes", stream, batch))

    def _noted(self, stream: str, batch: str) -> list[str] | None:
        """The note of a batch; None if it has not written all."""
        folder = self.path("notes", stream, batch)
        return [r.value for r in self.spark.read.text(folder).collect()] if self._exists(f"{folder}/_SUCCESS") else None

    def _stream_name(self, stream: str) -> str:
        """The id that a stream keeps with its checkpoint, which tells its batches from those of another start."""
        text = self.spark.read.text(self.path("checkpoints", stream, "metadata")).first()[0]
        return json.loads(text)["id"]

    def deliver(self, rows: DataFrame) -> str:
        """Raw rows for the first stream, stored by key as it compares them, so that it need not store them again as it
        does with other files of `staged`. The name of the delivery."""
        name = uuid.uuid4().hex
        with many_files(self.spark):
            self._insert("staged", vault.with_key(rows), name)
        return name

    def load(self, batch: str, deliveries: list[str], files: list[str] = ()) -> None:
        """One batch of raw rows into hub and satellite, of deliveries, where they are, and of other files."""
        self._history()
        self._see_all()
        with many_files(self.spark):
            if files:
                self._insert("arrived", vault.with_key(self._rows(files, _STAGED)), batch)
            target, of = F.col("target"), F.col("batch")
            staged = (target == "staged") & of.isin(deliveries) | (target == "arrived") & (of == batch)
            asked = self._stored(staged).select(F.col("key").alias("_asked"))
            small, fresh = asked.count() <= SMALL_BATCH, {}
            for name, first in (("hub", vault.first_hub_rows), ("satellite", vault.first_states)):
                rows = self._stored(staged | (target == name) & (of != batch)).withColumn("_known", target == name)
                if small:  # of a long history only what has one of these keys is sorted
                    rows = rows.join(F.broadcast(asked.distinct()), F.col("key").eqNullSafe(F.col("_asked")), "left_semi")
                fresh[name] = first(rows)
            self._write_all(fresh, batch)
        if files:
            self._remove("arrived", batch)

    def record(self, every: str | None = None, files_at_once: int | None = None) -> StreamingQuery:
        """New raw rows into hub and satellite."""

        def merge(rows: DataFrame, number: int) -> None:
            batch = f"{self._stream_name('record')}_{number}"
            if self._noted("record", batch) is not None:
                return
            files = self._files(rows)
            whole = self._whole_deliveries(files)
            self.load(batch, whole, [f for f in files if self._delivery(f) not in whole])
            self._note("record", batch, [])

        source = self.spark.readStream.schema(_STAGED).option("recursiveFileLookup", "true")
        if files_at_once:
            source = source.option("maxFilesPerTrigger", files_at_once)
        self._history()
        paths = source.parquet(self.path(f"{{staged,{self._keyed}/target=staged}}")).select("_metadata.file_path")
        return once_or_every(paths.writeStream.foreachBatch(merge).option("checkpointLocation", self.path("checkpoints", "record")), every).start()

    @staticmethod
    def _delivery(file: str) -> str | None:
        found = re.search(r"/target=staged/batch=([^/]+)/[^/]+$", file)
        return found[1] if found else None

    def _whole_deliveries(self, files: list[str]) -> list[str]:
        """The deliveries of which all files are among these."""
        whole = []
        for name in sorted({d for f in files if (d := self._delivery(f))}):
            store, path = self._hadoop(self.path(self._keyed, "target=staged", f"batch={name}"))
            there = {n for n in (f.getPath().getName() for f in store.listStatus(path)) if n[0] not in "._"}
            if there <= {f.rsplit("/", 1)[-1] for f in files if self._delivery(f) == name}:
                whole.append(name)
        return whole

    @staticmethod
    def derive_name(target: str | None = None) -> str:
        """The stream that fills a derived table by itself, or the one that fills all four."""
        return f"derive_{target}" if target else "derive"

    def derive(self, every: str | None = None, target: str | None = None) -> StreamingQuery:
        """New states, joined with the hub as it is now, into the four derived tables; or into one, by a stream of its own
        that reads only what this table is made of. A history is derived in one way or the other.

        A state counts once. The satellite has it once, and a folder of the satellite is derived as a whole, into a folder
        of the same name that replaces what was there. That is what happens when `record` ran a batch again after this
        stream had read its files, when a folder comes in parts, and with empty checkpoints.
        """
        stream, targets = self.derive_name(target), (target,) if target else DERIVED
        if any(self._exists(self.path("checkpoints", self.derive_name(t))) for t in ((None,) if target else DERIVED)):
            raise ValueError("the derived tables are filled together or each by itself, not both")

        def fan_out(states: DataFrame, number: int) -> None:
            batch = f"{self._stream_name(stream)}_{number}"
            if self._noted(stream, batch) is not None:
                return
            sources = sorted({f.rsplit("/", 2)[-2].removeprefix("batch=") for f in self._files(states)})
            self._see_all()
            work, hub = self.path("work", batch), self._stored(F.col("target") == "hub")
            for source in sources:
                fresh = self._stored((F.col("target") == "satellite") & (F.col("batch") == source))
                if target:
                    self._write(target, vault.derived(vault.numbered(fresh, hub, vault.DERIVED[target]), targets)[target], source)
                else:  # joined with the hub once, and stored, for the tables to take their columns from
                    vault.numbered(fresh, hub).write.mode("overwrite").option("compression", "zstd").parquet(work)
                    self._write_all(vault.derived(self.spark.read.parquet(work)), source)
            self._note(stream, batch, sources)
            files, path = self._hadoop(work)
            files.delete(path, True)

        self._history()
        source = self.spark.readStream.schema(TARGETS["satellite"]).option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").parquet(self.path(self._keyed, "target=satellite"))
        paths = source.select("_metadata.file_path")
        return once_or_every(paths.writeStream.foreachBatch(fan_out).option("checkpointLocation", self.path("checkpoints", stream)), every).start()

    def run(self, files_at_once: int | None = None) -> None:
        """Everything staged so far, through both streams."""
        self.record(files_at_once=files_at_once).awaitTermination()
        self.derive().awaitTermination()
