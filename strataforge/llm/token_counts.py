"""Exact length histogram of encoded documents, with suffix sums for every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import binary_texts, cut, id_text, read_table

#: Lengths that one group of the running sums holds.
BAND = 1024


def default_ranks() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _lengths(ranks_file, pattern: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.value.splitlines()) if a}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            sizes = [len(encoding.encode_ordinary(t.decode())) for t in binary_texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64())], names=["doc_id", "n_tokens"])

    return count


def token_lengths(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every whole text; a null or empty text has 0. Special strings are ordinary text.

    The vocabulary file is read by the driver and sent to the tasks, which need no shared path.
    """
    path, own = default_ranks() if ranks_path is None else (ranks_path, pattern)
    with open(path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = id_text(docs, id_col, text_col)
    return rows.mapInArrow(_lengths(ranks, pattern or own), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long")


def length_histogram(lengths: DataFrame, band: int = BAND) -> DataFrame:
    """One row per distinct length, as context limit: what any limit, total or quantile needs.

    n_tokens, n_docs, docs_at_least and tokens_at_least (suffix sums), docs_at_most, share_at_most (the quantile rank),
    total_docs, total_tokens, truncated_tokens (all documents cut to this length). An empty input has no rows. For a
    limit between two lengths, use `at_limit`. Running sums go band by band: rows within a band of lengths, then the
    few band totals, so that no task sees the whole histogram.
    """
    counts = cut(lengths.where("n_tokens is not null").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))).withColumn("band", F.floor(F.col("n_tokens") / band))
    sums = counts.groupBy("band").agg(F.sum("n_docs").alias("band_docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("band_tokens"))
    above = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = sums.select(
        "band", *[F.coalesce(F.sum(f"band_{k}").over(above), F.lit(0)).alias(f"{k}_above") for k in ("docs", "tokens")],
        *[F.sum(f"band_{k}").over(whole).alias(f"total_{k}") for k in ("docs", "tokens")],
    )
    within = Window.partitionBy("band").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = counts.withColumn("d", F.sum("n_docs").over(within)).withColumn("t", F.sum(F.col("n_docs") * F.col("n_tokens")).over(within)).join(totals, "band")
    out = out.withColumn("docs_at_least", F.col("d") + F.col("docs_above")).withColumn("tokens_at_least", F.col("t") + F.col("tokens_above"))
    at_most = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    return out.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", at_most.alias("docs_at_most"), (at_most / F.col("total_docs")).alias("share_at_most"),
        "total_docs", "total_tokens", (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
    )


def at_limit(histogram: DataFrame, limit: int) -> DataFrame:
    """(limit, docs_cut, truncated_tokens) for any context limit, from the suffix sums of the next longer length."""
    longer = histogram.where(F.col("n_tokens") > limit).agg(F.max("docs_at_least").alias("d"), F.max("tokens_at_least").alias("t"))
    total = histogram.agg(F.max("total_tokens").alias("total"))
    d, t = F.coalesce("d", F.lit(0)), F.coalesce("t", F.lit(0))
    return longer.crossJoin(total).select(F.lit(limit).cast("long").alias("limit"), d.alias("docs_cut"), (F.coalesce("total", F.lit(0)) - t + limit * d).alias("truncated_tokens"))


def quantile(histogram: DataFrame, q: float) -> DataFrame:
    """(q, n_tokens): the smallest length that at least a share q of the documents does not exceed; null without documents."""
    return histogram.where(F.col("docs_at_most") >= q * F.col("total_docs")).agg(F.min("n_tokens").alias("n_tokens")).select(F.lit(q).alias("q"), "n_tokens")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(token_lengths(read_table(spark, sf_dir, "documents")))
