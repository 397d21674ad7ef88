"""Shared pieces of the corpus operators: column selection, durable cuts, byte-level word splitting."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing A-Z stay; every other byte becomes a space.
ALNUM_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: A-Z to a-z, nothing else.
LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of one Arrow batch at most. Batches are counted in rows, and whole texts can be long.
BATCH_ROWS = 1000


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, so that no extra column of the caller can clash with ours.

    Lowers the session's Arrow batches to BATCH_ROWS if they are larger: tasks then hold a few MB of text at a time.
    """
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder. It survives lost executors and cuts the lineage.

    The folder is spark.checkpoint.dir; where that is unset, one beside the warehouse, never a local temporary folder.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir; beside the warehouse where that is unset, as `cut` does."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """df as a Parquet table in a new shared folder, and that folder: smaller than a cut, and read by columns."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, *folders: str) -> None:
    """Delete what `stored` has written, once nothing reads it any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def to_tasks(spark: SparkSession, value: object) -> Callable[[], object]:
    """value for all tasks, of a size the caller has bounded. A broadcast names own classes by their module, which executors
    may not have; so it goes as bytes that hold the classes too (see strataforge/__init__.py)."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files that led to what has been cut since: its cleaner does so once the driver's JVM has
    collected what referred to them, which a driver with little to do may put off until disks are full."""
    spark.sparkContext._jvm.System.gc()


def binary_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow column; null is empty."""
    for value in column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()):
        yield value.as_py() or b""


#: Keys that `salted_join` may send to all tasks, of about 20 bytes each: those that hold more than one row in HOT_KEYS.
HOT_KEYS = 50_000


def salted_join(rows: DataFrame, counted: DataFrame, on: list[str], spread: list[str]) -> DataFrame:
    """Inner join of rows with counted, which has one row per key and k, the number of rows of the key.

    A key with more than one in HOT_KEYS of all rows (there are fewer than HOT_KEYS of those, whatever the input) is
    dealt over several tasks by a hash of the columns in spread, and its row of counted goes to each of them.
    """
    counted = cut(counted)
    most = max(100, (counted.agg(F.sum("k")).first()[0] or 0) // HOT_KEYS)
    hot = counted.where(F.col("k") > most).select(*on, F.expr(f"cast(k div {most} + 1 as int)").alias("_parts"))
    dealt = rows.join(F.broadcast(hot), on, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    parts = F.when(F.col("k") > most, F.expr(f"sequence(0, cast(k div {most} as int))")).otherwise(F.array(F.lit(0)))
    return dealt.join(counted.withColumn("_part", F.explode(parts)).drop("k"), [*on, "_part"]).drop("_part")


#: Bytes that are sent to all tasks at most, as `checked` counts them; more is joined by a shuffle.
BROADCAST_BYTES = 16_000_000


def checked(small: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """small, marked for broadcast if its values take at most `most` bytes: 8 a number, texts and arrays by their length,
    16 a row besides. Rows are read to know that, so small is best a cut or cheap."""
    wide = {"string": lambda c: F.octet_length(c), "binary": lambda c: F.octet_length(c), "array": lambda c: 16 * F.size(c)}
    sizes = [wide.get(f.dataType.typeName(), lambda c: F.lit(8))(F.col(f"`{f.name}`")) for f in small.schema.fields]
    total = small.agg(F.sum(sum((F.coalesce(x, F.lit(0)) for x in sizes), F.lit(16)).cast("long"))).first()[0] or 0
    return F.broadcast(small) if total <= most else small


def _among(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = checked(cut(keys.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()))
    match = docs["doc_id"].eqNullSafe(keys["_id"]) & (F.xxhash64(docs["text"].cast("string")) == keys["_h"])
    return docs.join(keys, match, how)


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id (null equals null) and hash of text are among keys (doc_id, h)."""
    return _among(docs, keys, "left_anti")


def only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id (null equals null) and hash of text are among keys (doc_id, h)."""
    return _among(docs, keys, "left_semi")
