"""Near-duplicate lines, by a deletion-neighbourhood join within one edit.

Two lines are within one edit exactly if they leave the same text when the character at the same place is deleted from
both (substitution), or if one of them is left when a character is deleted from the other. So every line emits all its
one-deletion variants as hashed keys, equal keys are joined, and what meets is verified by edit distance.

Variants are many, so lines that can have no partner are first put aside, without losing any pair: an edit leaves the
first or the last half of a line as it is, hence only lines that share a hashed half with another line go on; of these,
only lines that share all but a short segment with another. Short lines have one key, the whole line. A key's
group is never enumerated: each member is compared with the earliest member of the other side only, which is all that
"keep the earliest" needs, because all of them are within one edit of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checked, cut, id_text, read_table, salted_join
from .shingles import Hasher, mix

#: Shorter lines, in characters without outer white space, are dropped only where an earlier line is equal: one edit
#: apart, short lines ("1." and "2.") say different things.
NEAR_CHARS = 24

_BLANK = " \t\r\x0b\x0c"
_KEY = ["a", "b"]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and 128 bits of both as the document's key: rows that repeat id and text are the same document."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "text", "doc_id").alias("b"))


def _lines(keyed: DataFrame) -> DataFrame:
    """The lines that have a word."""
    rows = keyed.select("doc_id", "a", "b", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    rows = rows.select("doc_id", "a", "b", "line_no", F.btrim("raw", F.lit(_BLANK)).alias("line")).withColumn("n", F.length("line"))
    return rows.where("n > 0")


def _halves(lines: DataFrame, near_chars: int) -> DataFrame:
    """A row for each half key of a line: its first and its last g characters; for a short line, the line.

    g(n) is the largest 2^k or 3 * 2^(k-1) up to half of n, or half of n itself below 2. A line of n characters has keys
    for g(n) and, where it differs, g(n - 1): so it meets lines of its own length and of one more or less.
    """
    size = lambda n: F.expr(
        f"case when {n} < 4 then {n} div 2 when ({n} div 2) * 2 >= 3 * shiftleft(1, cast(floor(log2({n} div 2)) as int)) "
        f"then (3 * shiftleft(1, cast(floor(log2({n} div 2)) as int))) div 2 else shiftleft(1, cast(floor(log2({n} div 2)) as int)) end"
    )
    both = lines.withColumn("g0", size("n")).withColumn("g1", size("(n - 1)"))
    ends = both.withColumn("g", F.explode(F.when((F.col("g0") == F.col("g1")) | (F.col("n") < near_chars), F.array("g0")).otherwise(F.array("g0", "g1"))))
    start = F.xxhash64(F.lit(0), "g", F.expr("substring(line, 1, g)"))
    stop = F.xxhash64(F.lit(1), "g", F.expr("substring(line, -g, g)"))
    return ends.withColumn("half", F.explode(F.when(F.col("n") < near_chars, F.array(F.xxhash64(F.lit(2), "l1", "l2"))).otherwise(F.array(start, stop))))


def _codes(line: str, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Mixed code points of a line, and the sums that give the hash of any stretch of it."""
    codes = mix(np.frombuffer(line.encode("utf-32-le"), "<u4").astype(np.uint64))
    hasher.reach(len(codes))
    return codes, np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * hasher.powers[: len(codes)], dtype=np.uint64)])


def _segments(most: int):
    """Keys of all but one segment of each line, for up to `most` segments: one edit leaves all segments but one.

    For the shorter length m of two lines that differ by one edit, some segment i holds the edit: what stands before
    it, and as much as stands behind it, are equal. So a line of n characters has keys for m = n and for m = n - 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            for l1, l2, line in zip(*(b.column(c).to_pylist() for c in ("l1", "l2", "line")), strict=True):
                _, sums = _codes(line, hasher)
                n, keys = len(sums) - 1, []
                for m in (n, n - 1):
                    count = min(most, max(4, m // 8))
                    i, q = np.arange(count), m // count
                    behind = np.where(i == count - 1, 0, m - (i + 1) * q)
                    tail = hasher.between(sums, n - behind, np.full(count, n))
                    keys.append(mix(mix(sums[i * q], 21) + mix(tail, 22) + mix(i.astype(np.uint64) + np.uint64(128 * m), 23)))
                k = np.concatenate(keys).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), l1)), pa.array(np.full(len(k), l2)), pa.array(k)], names=["l1", "l2", "key"])

    return run


def _with_partner(texts: DataFrame, most: int) -> DataFrame:
    """The lines that share all but one of their segments with another line."""
    keys = cut(texts.select("l1", "l2", "line").mapInArrow(_segments(most), "l1 long, l2 long, key long"))
    shared = keys.groupBy("key").agg(F.min("l1").alias("x"), F.max("l1").alias("y")).where("x < y").select("key")
    return cut(texts.join(keys.join(shared, "key").select("l1", "l2").distinct(), ["l1", "l2"]))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All one-deletion variants of each line as hashed keys: with the place for substitutions (at), without it (-1); and
    the line itself (-2), which the variants of longer lines meet."""
    hasher = Hasher()
    for b in batches:
        for l1, l2, line in zip(*(b.column(c).to_pylist() for c in ("l1", "l2", "line")), strict=True):
            codes, sums = _codes(line, hasher)
            n = len(codes)
            # what stands behind the deleted character moves one place to the front
            left = sums[:-1] + (sums[-1] - sums[1:]) * hasher.inverse[1]
            shorter = np.unique(mix(left, 5))
            k = np.concatenate([mix(left + np.uint64(n), 3), shorter, mix(sums[-1:], 5)]).astype(np.int64)
            at = np.concatenate([np.arange(n), np.full(len(shorter), -1), [-2]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), l1)), pa.array(np.full(len(k), l2)), pa.array(k), pa.array(at)], names=["l1", "l2", "key", "at"])


def duplicate_lines(docs: DataFrame, *, near_chars: int = NEAR_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, dropped): the key of a document (see `_keyed`) and the numbers of its lines that an earlier line makes redundant.

    A line with a word is dropped if any earlier line, of any document, is equal to it, or, where both have near_chars
    characters or more, one edit (an inserted, deleted or replaced character) away; white space at its ends does not
    count. Lines without a word stay. Null and empty texts have nothing to drop, an empty table gives no rows. Earlier means a smaller id (no id comes last), for texts
    that share an id the smaller hash, then the smaller line number. Rows that repeat both id and text are one document.
    """
    keyed = _keyed(id_text(docs, id_col, text_col).where("text is not null"))
    lines = _lines(keyed).withColumn("l1", F.xxhash64("line")).withColumn("l2", F.xxhash64(F.lit(2), "line"))
    halves = _halves(lines, near_chars)
    groups = halves.groupBy("half").agg(F.count(F.lit(1)).alias("k"), F.min("l1").alias("x"), F.max("l1").alias("y"))
    groups = groups.where("k > 1").select("half", "k", (F.col("x") < F.col("y")).alias("near"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("a"), F.col("b"), F.col("line_no"))
    rows = cut(salted_join(halves.select("half", "n", "l1", "l2", place.alias("place")), groups, ["half"], ["place"]).drop_duplicates(["half", "place"]))
    first = cut(rows.groupBy("l1", "l2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("k"), F.max((F.col("n") >= near_chars) & F.col("near")).alias("near")))

    near = first.where("near").select("l1", "l2", "first")
    wanted = near.select("l1", "l2", "first", F.col("first.a").alias("a"), F.col("first.b").alias("b"), F.col("first.line_no").alias("line_no"))
    texts = keyed.select("a", "b", "text").join(checked(wanted), _KEY)
    texts = texts.select("l1", "l2", "first", F.btrim(F.element_at(F.split("text", "\n"), F.col("line_no") + 1), F.lit(_BLANK)).alias("line"))
    texts = cut(texts.drop_duplicates(["l1", "l2"]))
    for most in (4, 64):
        texts = _with_partner(texts, most)
    variants = texts.select("l1", "l2", "line").mapInArrow(_variants, "l1 long, l2 long, key long, at int").join(texts.select("l1", "l2", "first"), ["l1", "l2"])
    variants = variants.withColumn("place", F.greatest("at", F.lit(-1)))
    own = F.struct("first", "l1", "l2")
    groups = variants.groupBy("key", "place").agg(F.min(F.when(F.col("at") > -2, own)).alias("variant"), F.min(F.when(F.col("at") == -2, own)).alias("whole"), F.count(F.lit(1)).alias("k"))
    groups = groups.where("k > 1").select("key", "place", "k", "variant", "whole")
    # lines of one length meet in their variants; a variant of a longer line meets the whole shorter line, and it that
    met = salted_join(variants, groups, ["key", "place"], ["l1"]).withColumn("e", F.when(F.col("at") == -1, F.col("whole")).otherwise(F.col("variant")))
    met = met.where(F.col("e.first") < F.col("first")).select("l1", "l2", F.col("e.l1").alias("e1"), F.col("e.l2").alias("e2")).distinct()
    other = texts.select(F.col("l1").alias("e1"), F.col("l2").alias("e2"), F.col("line").alias("e_line"), F.col("first").alias("e_first"))
    proven = met.join(texts.select("l1", "l2", "line"), ["l1", "l2"]).join(other, ["e1", "e2"]).where(F.levenshtein("line", "e_line", 1).between(0, 1))
    nearest = proven.groupBy("l1", "l2").agg(F.min("e_first").alias("near_first"))

    kept = first.join(nearest, ["l1", "l2"], "left").select("l1", "l2", "k", F.least("first", F.coalesce("near_first", "first")).alias("kept"))
    dropped = salted_join(rows.select("l1", "l2", "place").distinct(), kept, ["l1", "l2"], ["place"]).where(F.col("place") > F.col("kept"))
    return dropped.groupBy(F.col("place.a").alias("a"), F.col("place.b").alias("b")).agg(F.array_sort(F.collect_list("place.line_no")).alias("dropped"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, counts = [], []
        for text, dropped in zip(b.column("_text").to_pylist(), b.column("dropped").to_pylist(), strict=True):
            lines, gone = (text or "").split("\n"), set(dropped or ())
            texts.append(text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone))
            counts.append(0 if text is None else len(lines))
        dropped = pa.array([len(x or ()) for x in b.column("dropped").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), dropped], schema=pa.schema([pa.field("_row", b.column("_row").type), ("_text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())]))


def dedup_lines(docs: DataFrame, *, near_chars: int = NEAR_CHARS, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per row of docs: _row (a struct of the columns in carry, the id at least), _text without the dropped lines, n_lines, n_dropped.

    A null text stays null and has no lines; an empty text has one empty line. Lines are what `\\n` separates, and the
    lines that stay are joined by it. Rows that repeat id and text lose the same lines; an empty table gives no rows.
    """
    gone = cut(duplicate_lines(docs, near_chars=near_chars, id_col=id_col, text_col=text_col))
    packed = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in carry or [id_col]]).alias("_row"), docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    keys = (F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "text", "doc_id").alias("b"))
    rows = packed.select("_row", F.col("text").alias("_text"), *keys).join(checked(gone), _KEY, "left").select("_row", "_text", "dropped")
    kept = T.StructType([T.StructField("_row", rows.schema["_row"].dataType), T.StructField("_text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return rows.mapInArrow(_without, kept)


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """docs, with its columns, without redundant lines (n_chars follows the text), and without the documents of which
    no word is left; documents that had none before stay, null and empty texts among them. Columns of any name stay as
    they are; an empty table gives no rows."""
    out = dedup_lines(docs, carry=docs.columns, **options)
    has_word = lambda c: F.coalesce(c.rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    out = out.where(has_word(F.col("_text")) | ~has_word(F.col("_row.text")))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return out.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read_table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("_text", F.lit("")).cast("binary"), 256)
    return out.select("_row.doc_id", "n_lines", "n_dropped", digest.alias("text_sha256"), F.length(F.coalesce("_text", F.lit(""))).cast("long").alias("n_chars"))
