"""Filter interaction audit: what each of five filters removes at each place of every order of the filters.

A document is a mask of the filters that it fails. Masks are counted per part, a table of at most 32 rows a part. Those
cells are laid out long against the steps of all orders; a running bit-or over the steps before tells what an earlier
filter has removed, conditional sums over cells give the counts, and a total by filter over all orders its share.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import checked, cut, read_table, salted_join
from .native import let, text_or_empty

FILTERS = "ABCDE"
_WORD_GAP = "[\\x20\\x09-\\x0D]+"


def _own_failures(text: Column) -> Column:
    """Bits 0 to 3: under 200 words, under half of them distinct, over 3 % of A-Z, a symbol."""

    def bits(words: Column) -> Column:
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
        fails = (n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * F.length(text), F.regexp_like(text, F.lit("[#$%&*|]")))
        return sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)), F.lit(0))

    return let(F.array_remove(F.split(text, _WORD_GAP), ""), bits)


def masks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask) for every row of docs; bit k of mask is set where the row fails the k-th of FILTERS.

    A null text is empty, a null part the empty string. E fails where a row with a smaller id has the same text (the
    same SHA-256); a null id is never smaller nor larger, rows that repeat an id are not smaller than each other. Copies
    of a text meet in a salted join, so a text that a third of the rows share is dealt over tasks.
    """
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    text = text_or_empty(F.col("text"))
    rows = cut(named.select("doc_id", "part", F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), _own_failures(text).alias("own")))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("k"))
    copied = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    return salted_join(rows, first, ["digest"], ["doc_id", "part"]).select("doc_id", "part", (F.col("own") + F.when(copied, F.lit(16)).otherwise(F.lit(0))).alias("mask"))


def cells(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and mask, and those of them that labels call good or toxic.

    labels needs doc_id, quality and toxic. An id counts as good (toxic) if any of its rows says 1; a null id has no label.
    """
    says = lambda c: F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("int")).alias(f"_{c}")
    known = checked(labels.where("doc_id is not null").groupBy("doc_id").agg(says("quality"), says("toxic")))
    counted = lambda c: F.coalesce(F.sum(f"_{c}"), F.lit(0))
    return marked.join(known, "doc_id", "left").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), counted("quality").alias("good"), counted("toxic").alias("toxic"))


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part of counted (as from `cells`), order of the filters and step; see op13 for the columns.

    Nothing here grows with the documents: at most 2^k cells a part against k * k! steps. No cells, no rows.
    """
    orders = F.array(*(F.lit("".join(p)) for p in permutations(filters)))
    steps = counted.select("*", F.explode(orders).alias("filter_order")).select("*", F.posexplode(F.split("filter_order", "")).alias("at", "filter"))
    bit = F.expr(f"shiftleft(1, instr('{filters}', filter) - 1)")
    long = steps.withColumn("fails", F.col("mask").bitwiseAND(bit))
    before = W.Window.partitionBy("part", "mask", "filter_order").orderBy("at").rowsBetween(W.Window.unboundedPreceding, -1)
    long = long.withColumn("gone", F.coalesce(F.bit_or("fails").over(before), F.lit(0)) != 0).withColumn("fails_here", F.col("fails") != 0)
    total = lambda which, n="n": F.coalesce(F.sum(F.when(which, F.col(n))), F.lit(0)).cast("long")
    here = F.col("fails_here") & ~F.col("gone")
    out = long.groupBy("part", "filter_order", (F.col("at") + 1).alias("step"), "filter").agg(
        total(~F.col("gone") & ~F.col("fails_here")).alias("kept"), total(here).alias("removed"), total(F.col("fails_here") & F.col("gone")).alias("redundant"),
        total(F.col("fails_here") & (F.col("mask") == F.col("fails"))).alias("unique_fails"), total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"),
    )
    return out.withColumn("shapley", F.sum("removed").over(W.Window.partitionBy("part", "filter"))).drop("filter")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(cells(masks(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "labels")))
