"""Benchmark decontamination over a positional inverted index.

The corpus is indexed by document: a row holds the posting lists (term, places) of the test terms in it, and the index is
a stored table. Matches are read off the lists alone. An exact match of a window comes from its rarest term: the lists of
all its terms, shifted by their offsets in the window, are intersected one after the other, the next rarest first, each
asked only for the starts that are left. A proximity match starts from the rarest term as well: the lists of the others
are asked for a place near by, until one has none, then for the least stretch that holds them all.

The test set is handled in blocks of at most `block_windows` distinct windows, so what the driver and the executors
hold of it is bounded, for either kind of match; every block looks at all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from .common import ALNUM_TABLE, binary_texts, cut, id_text, read_table, stored, to_tasks, without

WINDOW = 10
BLOCK_WINDOWS = 100_000
#: Words that a proximity match may have beside those of the window.
SLOP = 5
#: Pairs of a posting and a window that a task looks at together, about.
_PAIRS = 200_000

_INDEX_SCHEMA = "row long, doc_id {id}, h long, n_words long, postings array<struct<term:int,places:array<int>>>"


def split_words(text: bytes) -> list[bytes]:
    return text.translate(ALNUM_TABLE).split()


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words = [[w.decode() for w in split_words(t)] for t in binary_texts(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(words, pa.list_(pa.string()))], names=["item_id", "words"])


def test_windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item_id, words) of every window: n consecutive words of an item, or all of an item that has fewer, but not none."""
    words = items.mapInArrow(
        _word_lists, T.StructType([T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("words", T.ArrayType(T.StringType()))])
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - n + 1, F.lit(1)))
    return (
        words.where(F.size("words") > 0)
        .select("item_id", "words", F.explode(starts).alias("at"))
        .select("item_id", F.slice("words", F.col("at"), n).alias("words"))
        .distinct()
    )


def _counter(vocabulary):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = vocabulary()
        total = np.zeros(len(ids) + 1, np.int64)
        for b in batches:
            for text in binary_texts(b.column("text")):
                words = split_words(text)
                total += np.bincount(np.fromiter(map(ids.get, words, repeat(len(ids))), np.int32, len(words)), minlength=len(total))
        seen = np.flatnonzero(total[:-1])
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["term", "n"])

    return count


class Block:
    """The windows of a block as term numbers: terms of each by place, rarest first, and distinct terms with their counts."""

    def __init__(self, windows: list[list[int]], frequency: np.ndarray, n: int, slop: int, lists: int) -> None:
        self.n, self.slop, self.lists = n, slop, min(lists, n)
        shape = (len(windows), n)
        self.size = np.array(list(map(len, windows)), np.int64)
        self.term, self.offset = np.full(shape, -1, np.int64), np.zeros(shape, np.int64)
        self.distinct, self.need = np.full(shape, -1, np.int64), np.zeros(shape, np.int64)
        for w, seq in enumerate(windows):
            order = sorted(range(len(seq)), key=lambda i: (frequency[seq[i]], i))
            own = list(dict.fromkeys(seq[i] for i in order))
            self.term[w, : len(seq)], self.offset[w, : len(seq)] = [seq[i] for i in order], order
            self.distinct[w, : len(own)], self.need[w, : len(own)] = own, [seq.count(t) for t in own]
        self.lead = np.zeros(len(frequency), bool)
        if len(windows):
            self.lead[self.term[:, 0]] = True


class Postings:
    """Posting lists of some documents, in one run of places with room between documents: sorted keys of term and place."""

    def __init__(self, term: np.ndarray, place: np.ndarray, length: int) -> None:
        self.length = length
        self.keys = np.sort(term * length + place)

    def at(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How many postings there are before that place of the list of term, and all those of lesser terms."""
        return np.searchsorted(self.keys, term * self.length + place)

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        found = self.at(term, place)
        return (found < len(self.keys)) & (self.keys[np.minimum(found, len(self.keys) - 1)] == term * self.length + place)

    def leads(self, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, place) of all postings of the rarest term of each window, some at a time."""
        first = self.at(block.term[:, 0], np.int64(0))
        times = self.at(block.term[:, 0] + 1, np.int64(0)) - first
        some = np.flatnonzero(times)
        for part in np.split(some, np.flatnonzero(np.diff(np.cumsum(times[some]) // _PAIRS)) + 1):
            k = times[part]
            posting = np.arange(int(k.sum())) + np.repeat(first[part] - (np.cumsum(k) - k), k)
            window = np.repeat(part, k)
            yield window, self.keys[posting] - block.term[window, 0] * self.length

    def phrases(self, block: Block, window: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of exact matches: the lists of the window's terms, shifted by their offsets, are intersected
        from the rarest on; each next list is asked for the starts that are left."""
        start = place - block.offset[window, 0]
        for j in range(1, block.lists):
            term = block.term[window, j]
            keep = (term < 0) | self.has(term, start + block.offset[window, j])
            window, start = window[keep], start[keep]
        return window, start

    def spans(self, block: Block, window: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, start, span) of stretches around places of rarest terms that hold all terms of the window as often as
        it has them, within its size and slop. Lists are asked from the rarest on, for what is left; span is the least."""
        reach = block.size + block.slop
        for j in range(1, block.n):
            term, r = block.distinct[window, j], reach[window]
            keep = (term < 0) | (self.at(term, place + r) > self.at(term, np.maximum(place - r + 1, 0)))
            window, place = window[keep], place[keep]
        out = []
        for back in range(block.n + block.slop):
            start, fits = place - back, back < reach[window]
            span = block.size[window]
            for j in range(block.n):
                term = block.distinct[window, j]
                last = self.at(term, start) + block.need[window, j] - 1
                key = self.keys[np.minimum(last, len(self.keys) - 1)]
                there = (last < len(self.keys)) & (key < (term + 1) * self.length) & (last >= 0)
                span = np.where(term < 0, span, np.maximum(span, np.where(there, key - term * self.length - start + 1, 1 << 40)))
            fits &= (span <= reach[window]) & (start >= 0)
            out.append((window[fits], start[fits], span[fits]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _indexer(vocabulary, block):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lead = vocabulary(), block().lead
        for b in batches:
            n_words, size, terms, counts, places = [], [], [], [], []
            for text in binary_texts(b.column("text")):
                words = split_words(text)
                seq = np.fromiter(map(ids.get, words, repeat(-1)), np.int32, len(words))
                n_words.append(len(words))
                place = np.flatnonzero(seq >= 0)
                if not lead[seq[place]].any():
                    size.append(0)
                    continue
                place = place[np.argsort(seq[place], kind="stable")]
                term, times = np.unique(seq[place], return_counts=True)
                size.append(len(term))
                terms.append(term)
                counts.append(times)
                places.append(place)
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            joined = lambda x: np.concatenate([np.zeros(0, np.int32), *x]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(joined(counts))]).astype(np.int32)), pa.array(joined(places)))
            postings = pa.StructArray.from_arrays([pa.array(joined(terms)), lists], names=["term", "places"])
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("h"), pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), postings)],
                names=["row", "doc_id", "h", "n_words", "postings"],
            )

    return index


def _matcher(block):
    """(row, win, start, span, exact) of all matches, from the postings of the documents alone."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block()
        room = b.n + b.slop
        for batch in batches:
            postings = batch.column("postings")
            of = np.repeat(np.arange(len(postings)), np.diff(postings.offsets.to_numpy()))
            flat = postings.flatten()
            if not len(flat):
                continue
            lists = flat.field("places")
            times = np.diff(lists.offsets.to_numpy())
            begin = room + np.cumsum(batch.column("n_words").to_numpy() + room) - (batch.column("n_words").to_numpy() + room)
            term, place = np.repeat(flat.field("term").to_numpy().astype(np.int64), times), lists.flatten().to_numpy() + np.repeat(begin[of], times)
            held = Postings(term, place, int(begin[-1] + batch.column("n_words")[-1].as_py() + 2 * room))
            for window, at in held.leads(b):
                for exact, (win, start, *span) in ((True, held.phrases(b, window, at)), (False, held.spans(b, window, at))):
                    row = np.searchsorted(begin, start + (0 if exact else span[0] - 1), "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").take(pa.array(row)), pa.array(win.astype(np.int32)), pa.array(start - begin[row]), pa.array(b.size[win] if exact else span[0]), pa.array(np.full(len(win), exact))],
                        names=["row", "win", "start", "span", "exact"],
                    )

    return match


def _block_index(rows: DataFrame, windows: list[list[str]], n: int, slop: int, lists: int) -> tuple[DataFrame, Callable[[], Block]]:
    """The index of the documents for these windows, stored: for each document its words and its posting lists of test terms."""
    spark = rows.sparkSession
    terms = {t: i for i, t in enumerate(sorted({t for words in windows for t in words}))}
    vocabulary = to_tasks(spark, {t.encode(): i for t, i in terms.items()})
    counted = rows.select("text").mapInArrow(_counter(vocabulary), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = np.zeros(len(terms) + 1, np.int64)
    for term, k in counted.toLocalIterator():
        frequency[term] = k
    block = to_tasks(spark, Block([[terms[t] for t in words] for words in windows], frequency, n, slop, lists))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInArrow(_indexer(vocabulary, block), _INDEX_SCHEMA.format(id=kind)))[0], block


def _blocks(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, n: int, block_windows: int) -> tuple[DataFrame, DataFrame, Iterator[list[list[str]]]]:
    """Rows of docs (row, doc_id, h, text), windows of items (item_id, phrase), and the blocks of windows in turn."""
    rows = id_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("h"), "text")
    windows = cut(test_windows(items.select("item_id", F.col("text").cast("string").alias("text")), n).withColumn("phrase", F.array_join("words", " ")))
    phrases = windows.select("words", "phrase").distinct()
    n_blocks = max(1, -(-phrases.count() // block_windows))
    if n_blocks > 1:
        rows = cut(rows)  # the same row numbers for each block
    part = lambda k: [w.words for w in phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(n_blocks)) == k).orderBy("phrase").select("words").toLocalIterator()]
    return rows, windows.select("item_id", "phrase"), map(part, range(n_blocks))


def _all_matches(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, n: int, slop: int, lists: int, block_windows: int) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, h, n_words) of the documents and (row, start, span, exact, item_id) of matches, block by block."""
    rows, windows, blocks = _blocks(docs, items, id_col, text_col, n, block_windows)
    base, found = None, None
    for part in blocks:
        index, block = _block_index(rows, part, n, slop, lists)
        keys = docs.sparkSession.createDataFrame([(i, " ".join(words)) for i, words in enumerate(part)], "win int, phrase string")
        hits = index.select("row", "n_words", "postings").mapInArrow(_matcher(block), "row long, win int, start long, span long, exact boolean")
        hits = cut(hits.distinct()).join(F.broadcast(keys), "win").drop("win")
        base = index.select("row", "doc_id", "h", "n_words") if base is None else base
        found = hits if found is None else found.unionByName(hits)
    return base, found.join(windows, "phrase").drop("phrase")


def matches(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW, lists: int = WINDOW, slop: int = SLOP, block_windows: int = BLOCK_WINDOWS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of the documents (row, doc_id, h: a hash of the text, n_words), exact matches (row, start, size, item_id), and
    (row, item_id) of proximity matches: all words of a window, in any order, within its size and slop.

    docs needs id_col and text_col, items item_id and text; other columns are ignored. A null or empty text has no
    words and no match. Rows that repeat an id are separate rows. Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`
    after lower-casing A-Z. Ties between equally rare terms go to the earlier offset, which changes no result. Empty
    tables give no matches. With fewer lists than a window has words, those of its rarest words alone are intersected.
    """
    base, found = _all_matches(docs, items, id_col, text_col, n, slop, lists, block_windows)
    return base, found.where("exact").select("row", "start", F.col("span").alias("size"), "item_id"), found.where("not exact").select("row", "item_id").distinct()


def proximity_matches(docs: DataFrame, items: DataFrame, *, slop: int = SLOP, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, item_id, start, span) where all terms of a window stand within its size and slop, in any order.

    start is the first word of a stretch, one of the window's; span is the least number of words from there that holds
    all. A term that the window has twice must be there twice. Null, empty and repeated rows are as in `matches`; equal
    matches are given once.
    """
    base, found = _all_matches(docs, items, id_col, text_col, n, slop, n, block_windows)
    return base.select("row", "doc_id").join(found.where("not exact"), "row").select("doc_id", "item_id", "start", "span").distinct()


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per row of docs: doc_id, h (a hash of the text), n_words, n_hit, n_items, items (their ids as sorted
    strings), contaminated, near_items (ids as sorted strings of the items with proximity matches, exact ones included).

    n_hit counts the document words inside any exact occurrence of a window, each once. Without a match n_hit and n_items
    are 0 and items is empty; so it is for every document when items is empty. An item without an id has matches that
    count as hit words, but is in no list.
    """
    base, found, close = matches(docs, items, **options)
    found = cut(found)
    spans = found.groupBy("row", "start").agg(F.max("size").alias("size"))
    order = W.Window.partitionBy("row").orderBy("start")
    before = F.max(F.col("start") + F.col("size")).over(order.rowsBetween(W.Window.unboundedPreceding, -1))
    new = F.col("start") + F.col("size") - F.greatest(F.col("start"), F.coalesce(before, F.col("start")))
    hit = spans.select("row", F.greatest(new, F.lit(0)).alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))
    listed = lambda x, name: x.where("item_id is not null").select("row", F.col("item_id").cast("string").alias("item")).distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias(name))
    out = base.join(hit, "row", "left").join(listed(found, "items"), "row", "left").join(listed(close, "near_items"), "row", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id", "h", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.coalesce("near_items", none).alias("near_items"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """docs, with all its columns, without the rows in which a window of the test items occurs exactly. Null and empty
    texts stay, rows that repeat go or stay together; with an empty table on either side docs comes back as it is."""
    bad = decontaminate(docs, items, **options).where("contaminated").select("doc_id", "h")
    return without(docs, bad)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
        F.size("near_items").cast("long").alias("n_near_items"), F.sha2(F.array_join("near_items", ",").cast("binary"), 256).alias("near_items_sha256"),
    )
