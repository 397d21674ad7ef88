"""Removal of repeated byte strings by suffix arrays, anywhere in the corpus.

A string of `size` bytes that starts at some place is a window. Every window chooses an anchor, the stretch of half its
length with the least hash inside it, so equal windows choose equal anchors at the same distance, and neighbouring
windows mostly choose the same one: a context is such a run of windows. Only contexts whose anchor stands in two contexts
or more can hold a repeated window. Of contexts with the same bytes the earliest stays and all windows of the others are
repeats. The earliest ones go, with their bytes, to shards by anchor; a shard sorts all suffixes by induced sorting and
finds stretches of them that share `size` bytes or more from the permuted common prefixes: of each stretch the earliest
window stays. Windows of anchors with more than `hot_contexts` different contexts, the edges of a passage in very many
texts, are too many for one shard: each is dealt by a 128-bit hash of its own bytes instead, and the earliest of each stays.

Texts that are equal as a whole are told apart first, by their SHA-256.

Order is by doc_id (null last), a hash of id and text, and start. So rows with the same id and text are one document, and
of different texts with one id the one with the smaller hash comes first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bits import bit_filter, may_be
from .common import binary_texts, checked, discard, id_text, read_table, salted_join, stored
from .shingles import Hasher, mix
from .suffix_array import common_prefixes, suffix_array

SIZE = 100
#: Different contexts of one anchor that go to one shard at most.
HOT_CONTEXTS = 1000
#: Bytes of contexts that one shard holds, about.
SHARD_BYTES = 1_000_000
#: Bytes of text that are hashed together; places inside take _PLACE bits.
_PART, _PLACE = 1 << 19, 21


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring values: from the least so far in blocks of that width, from either side."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class _Contexts:
    """Contexts of many texts at once."""

    def __init__(self, size: int) -> None:
        self.size, self.gram, self.hasher = size, size // 2, Hasher()

    def find(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, start, windows, anchor, hash of the bytes) of the contexts of texts, in order.

        Long texts are looked at in parts. A context that goes over the end of one is two, which leaves all windows.
        """
        out: list[list[np.ndarray]] = []
        waiting: list[tuple[int, int, bytes]] = []
        held = 0
        for i, text in enumerate(texts):
            for start in range(0, len(text) - self.size + 1, _PART):
                part = text[start : start + _PART + self.size - 1]
                if held + len(part) > 2 * _PART:
                    out.append(self._parts(waiting))
                    waiting, held = [], 0
                waiting.append((i, start, part))
                held += len(part)
        if waiting:
            out.append(self._parts(waiting))
        return tuple(map(np.concatenate, zip(*out, strict=True))) if out else tuple(np.zeros(0, np.int64) for _ in range(5))

    def _parts(self, parts: list[tuple[int, int, bytes]]) -> list[np.ndarray]:
        raw = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        sizes = np.array([len(p) for _, _, p in parts])
        begin = np.cumsum(sizes) - sizes
        prefix = self.hasher.prefix(raw)
        at = np.arange(len(raw) - self.gram + 1)
        grams = mix(self.hasher.between(prefix, at, at + self.gram))
        places = np.uint64((1 << _PLACE) - 1)
        chosen = (_least((grams & ~places) | at.astype(np.uint64), self.size - self.gram + 1) & places).astype(np.int64)
        n_windows = sizes - self.size + 1
        part = np.repeat(np.arange(len(parts)), n_windows)
        window = np.arange(len(part)) + np.repeat(begin - (np.cumsum(n_windows) - n_windows), n_windows)
        anchor = chosen[window]
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]))
        times = np.diff(np.append(first, len(window)))
        start = window[first]
        of = part[first]
        whole = mix(self.hasher.between(prefix, start, start + times + self.size - 1), 1)
        text, offset = np.array([i for i, _, _ in parts]), np.array([s for _, s, _ in parts])
        return [text[of], start - begin[of] + offset[of], times, grams[anchor[first]].view(np.int64), whole.view(np.int64)]


def _anchor_finder(size: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts = _Contexts(size)
        for b in batches:
            anchor, k = np.unique(contexts.find(list(binary_texts(b.column("text"))))[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(k)], names=["anchor", "k"])

    return find


def _context_finder(size: int, repeated: Callable[[], np.ndarray]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, bits = _Contexts(size), repeated()
        for b in batches:
            found = contexts.find(list(binary_texts(b.column("text"))))
            keep = may_be(bits, found[3].view(np.uint64))
            text, start, times, anchor, whole = (x[keep] for x in found)
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(rows), b.column("h").take(rows), pa.array(start.astype(np.int32)), pa.array(times.astype(np.int32)), pa.array(anchor), pa.array(whole)],
                names=["doc_id", "h", "start", "n", "anchor", "ctx"],
            )

    return find


def _fetcher(size: int):
    """The bytes of contexts, or, of the hot ones, the windows with two hashes of each."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(binary_texts(b.column("text"))):
                anchor, start, piece, w1, w2 = [], [], [], [], []
                for c in b.column("wanted")[i].as_py():
                    if not c["hot"]:
                        anchor.append(c["anchor"])
                        start.append(c["start"])
                        piece.append(text[c["start"] : c["start"] + c["n"] + size - 1])
                        w1.append(None)
                        w2.append(None)
                        continue
                    for s in range(c["start"], c["start"] + c["n"]):
                        key = hashlib.blake2b(text[s : s + size], digest_size=16).digest()
                        anchor.append(None)
                        start.append(s)
                        piece.append(None)
                        w1.append(int.from_bytes(key[:8], "little", signed=True))
                        w2.append(int.from_bytes(key[8:], "little", signed=True))
                rows = pa.array(np.full(len(start), i))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(rows), b.column("h").take(rows), pa.array(start, pa.int32()), pa.array(anchor, pa.int64()), pa.array(piece, pa.binary()), pa.array(w1, pa.int64()), pa.array(w2, pa.int64())],
                    names=["doc_id", "h", "start", "anchor", "piece", "w1", "w2"],
                )

    return fetch


def _repeats(size: int):
    def repeats(shard: pa.Table) -> pa.Table:
        """Runs of windows of the contexts of a shard that an earlier window of the shard equals."""
        shard = shard.sort_by([("doc_id", "ascending"), ("h", "ascending"), ("start", "ascending")])  # null ids last
        pieces = shard.column("piece").to_pylist()
        symbols = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
        begin = np.cumsum(sizes) - sizes
        piece, at = np.repeat(np.arange(len(pieces)), sizes), np.arange(len(symbols))
        window = (begin + sizes - 1)[piece] - at >= size  # the others go over the end of a context and count for nothing
        doc, h, start = shard.column("doc_id"), shard.column("h"), shard.column("start").to_numpy()
        documents = list(zip(doc.to_pylist(), h.to_pylist(), strict=True))
        rank = np.cumsum([False] + [x != y for x, y in zip(documents[1:], documents, strict=False)])
        key = np.where(window, (rank[piece] << 32) + start[piece] + at - begin[piece], np.iinfo(np.int64).max)
        order = suffix_array(symbols)
        group = np.flatnonzero(common_prefixes(symbols, order)[order] < size)
        least = np.minimum.reduceat(key[order], group)
        gone = np.zeros(len(symbols), bool)
        gone[order] = key[order] > np.repeat(least, np.diff(np.append(group, len(order))))
        gone &= window
        step = np.diff(gone.astype(np.int8), prepend=0, append=0)
        low, high = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        of = piece[low]
        at = start[of] + low - begin[of]
        rows = pa.array(of)
        return pa.table([doc.take(rows), h.take(rows), pa.array(at.astype(np.int32)), pa.array((at + high - low + size - 1).astype(np.int32))], names=["doc_id", "h", "start", "end"])

    return repeats


def repeated_spans(docs: DataFrame, *, size: int = SIZE, hot_contexts: int = HOT_CONTEXTS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, h, start, end) of byte stretches that are covered by repeated windows, for docs of (doc_id, h, text)."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    null_id = F.col("doc_id").isNull().alias("null_id")
    context, window = F.struct(null_id, "doc_id", "h", "start", "n"), F.struct(null_id, "doc_id", "h", "start")
    count = F.count(F.lit(1))

    # whole texts that stand earlier as they are: all of them goes, and they need no contexts
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("digest")
    texts, in_texts = stored(docs.where(F.octet_length("text") >= size).select("doc_id", "h", F.octet_length("text").alias("bytes"), digest))
    one = F.struct(null_id, "doc_id", "h")
    same = texts.groupBy("digest").agg(F.min(one).alias("first"), count.alias("k")).where("k > 1")
    equal, in_equal = stored(salted_join(texts, same, ["digest"], ["doc_id", "h"]).where(~one.eqNullSafe(F.col("first"))).select("doc_id", "h", F.lit(0).alias("start"), F.col("bytes").alias("end")).distinct())
    discard(spark, in_texts)
    gone = checked(equal.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")))
    docs = docs.where(F.octet_length("text") >= size).join(gone, (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")

    twice = docs.select("text").mapInArrow(_anchor_finder(size), "anchor long, k long").groupBy("anchor").agg(F.sum("k").alias("k")).where("k > 1")
    repeated = bit_filter(twice, "anchor")
    found, in_found = stored(docs.mapInArrow(_context_finder(size, repeated), f"doc_id {kind}, h long, start int, n int, anchor long, ctx long"))
    firsts, in_firsts = stored(found.groupBy("anchor", "ctx").agg(F.min(context).alias("first"), count.alias("k")))
    copies = salted_join(found, firsts.where("k > 1"), ["anchor", "ctx"], ["doc_id", "start"]).where(~context.eqNullSafe(F.col("first")))
    whole = copies.select("doc_id", "h", "start", (F.col("start") + F.col("n") + size - 1).alias("end"))

    several = firsts.groupBy("anchor").agg(count.alias("k")).where("k > 1").withColumn("hot", F.col("k") > hot_contexts)
    asked = salted_join(firsts.select("anchor", "ctx", "first"), several, ["anchor"], ["ctx"])
    wanted = asked.groupBy("first.doc_id", "first.h").agg(F.collect_list(F.struct("first.start", "first.n", "anchor", "hot")).alias("wanted"))
    joined = docs.alias("d").join(wanted.alias("w"), (F.col("d.h") == F.col("w.h")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))).select("d.doc_id", "d.h", "d.text", "w.wanted")
    pieces, in_pieces = stored(joined.mapInArrow(_fetcher(size), f"doc_id {kind}, h long, start int, anchor long, piece binary, w1 long, w2 long"))
    shards = (pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0) // shard_bytes + 1
    dealt = pieces.where("piece is not null").select("doc_id", "h", "start", "piece", F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"))
    sorted_ = dealt.groupBy("shard").applyInArrow(_repeats(size), f"doc_id {kind}, h long, start int, end int")

    windows = pieces.where("piece is null").select("doc_id", "h", "start", "w1", "w2")
    least = windows.groupBy("w1", "w2").agg(F.min(window).alias("first"), count.alias("k")).where("k > 1")
    alone = salted_join(windows, least, ["w1", "w2"], ["doc_id", "start"]).where(~window.eqNullSafe(F.col("first"))).select("doc_id", "h", "start", (F.col("start") + size).alias("end"))
    out, _ = stored(equal.unionByName(whole).unionByName(sorted_).unionByName(alone))
    discard(spark, in_equal, in_found, in_firsts, in_pieces)
    return out


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for text, spans in zip(binary_texts(b.column("text")), b.column("spans").to_pylist(), strict=True):
            runs: list[list[int]] = []
            for s in sorted((s["start"], s["end"]) for s in spans or ()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            edges = [0, *(e for run in runs for e in run), len(text)]
            kept = b"".join(text[a:z] for a, z in zip(edges[0::2], edges[1::2], strict=True))
            rows.append((len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept, [{"start": a, "end": z} for a, z in runs]))
        n_bytes, removed, n_spans, digest, kept, runs = zip(*rows, strict=True) if rows else [[]] * 6
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.binary()), pa.array(runs, pa.list_(span))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"],
        )


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, hot_contexts: int = HOT_CONTEXTS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left), spans (removed).

    A byte goes where a string of `size` bytes that covers it also starts earlier, in a document before or in the same.
    A null text is empty; texts below `size` bytes stay. For repeated ids and rows see the top of this module. Empty
    tables give no rows. Other columns of docs are ignored.
    """
    rows = id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("doc_id", "text").alias("h"), "text")
    gone = repeated_spans(rows, size=size, hot_contexts=hot_contexts, shard_bytes=shard_bytes)
    listed, _ = stored(gone.groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    listed = checked(listed.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "spans"))
    joined = rows.join(listed, (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "spans")
    kind = rows.schema["doc_id"].dataType
    long, span = T.LongType(), T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()))
    schema = T.StructType().add("doc_id", kind).add("n_bytes", long).add("n_removed", long).add("n_spans", long).add("kept_sha256", T.StringType()).add("kept", T.BinaryType()).add("spans", span)
    return joined.mapInArrow(_cutter, schema)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
