"""Phrase collocation mining over position bitmaps.

A task goes through its texts in shards of whole pieces. In a shard every word has a bitmap of the positions it stands
at, kept as the blocks of eight positions that hold it and a byte of bits for each. A phrase is extended by shifting its
bitmap one position up and AND-ing it with the bitmaps of the words in the same blocks; popcounts of what is left are the
counts of the longer phrases, whose bitmaps are extended at once, by groups of first words. Between pieces one position
belongs to no word, so nothing extends over it. Counts of a phrase are summed over shards.

Words are counted first, then phrases of two, then of three. A word or pair below the least count can be in no candidate,
so bitmaps are made and extended only for words and pairs that pass a filter of the frequent ones, a bit array of fixed
size that goes to all tasks: where it is wrong it lets something through that the sums then drop. Nothing else is left
out: no sample, no cap. Words are told apart by 64 bits of language and word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .bits import bit_filter, may_be
from .common import BATCH_ROWS, binary_texts, discard, read_table, salted_join, stored

MIN_COUNT, TOP, CONTAINED_PERCENT = 10, 2000, 50
#: Words of one shard, and at most one text more.
SHARD_WORDS = 1_000_000
#: Bitmap blocks of first words that are extended together.
_GROUP = 100_000

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(10 if b in _BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAP, _EMPTY = 0, 1

def _bitmaps(word: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, block, bits) of the bitmaps of words, which are sorted, with their places in order."""
    block, bit = place >> 3, np.left_shift(1, place & 7)
    at = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (block[1:] != block[:-1])])[: len(word)])
    return word[at], block[at], (np.add.reduceat(bit, at) if len(at) else at).astype(np.uint8)


class Shard:
    """The bitmaps of a shard: entries (word, block, bits) by word, and again by block. Words are numbers below n_words."""

    def __init__(self, word: np.ndarray, place: np.ndarray, n_words: int) -> None:
        self.n_words = n_words
        self.word, self.block, self.bits = _bitmaps(word, place)
        order = np.argsort(self.block, kind="stable")
        self.by_word, self.by_bits = self.word[order], self.bits[order]
        self.start = np.searchsorted(self.block[order], np.arange(int(self.block.max(initial=0)) + 3))

    def extend(self, phrase: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bitmaps of phrases, extended by every word that follows them somewhere.

        Gives per longer phrase its count, the number of the phrase it extends, and the word; then the entries of its
        bitmap (number of the longer phrase, block, bits), which say where its last word stands.
        """
        over = bits > 127  # the last position of a block goes to the first of the next
        shifted = np.concatenate([bits << 1, np.ones(int(over.sum()), np.uint8)])  # uint8 drops what is over
        phrase, block = np.concatenate([phrase, phrase[over]]), np.concatenate([block, block[over] + 1])
        times = self.start[block + 1] - self.start[block]
        entry = np.arange(int(times.sum())) + np.repeat(self.start[block] - (np.cumsum(times) - times), times)
        both = np.repeat(shifted, times) & self.by_bits[entry]
        hit = np.flatnonzero(both)
        key = np.repeat(phrase, times)[hit] * self.n_words + self.by_word[entry[hit]]
        order = np.argsort(key, kind="stable")
        key, hit = key[order], hit[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        counts = np.add.reduceat(np.bitwise_count(both[hit]).astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        number = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(key))))
        return counts, key[at] // self.n_words, key[at] % self.n_words, number, np.repeat(block, times)[hit], both[hit]

    def phrases(self, common: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> Iterator[list[np.ndarray]]:
        """[first, second, count] of all phrases of two words by groups of first words; or, with common, which says what
        pairs of words can be in a candidate, [first, second, third, count] of the phrases of three words made of those."""
        ends = np.searchsorted(self.word, np.arange(self.n_words + 1))
        low = 0
        while low < self.n_words:
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + _GROUP, "right")) - 1)
            own = slice(ends[low], ends[high])
            low = high
            counts, first, second, number, block, bits = self.extend(self.word[own], self.block[own], self.bits[own])
            if common is None:
                yield [first, second, counts]
                continue
            deeper = common(first, second)[number]
            counts, pair, third, *_ = self.extend(number[deeper], block[deeper], bits[deeper])
            keep = common(second[pair], third)
            yield [first[pair[keep]], second[pair[keep]], third[keep], counts[keep]]


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[tuple[dict[str, dict[bytes, int]], np.ndarray]]:
    """Whole texts in turn as (numbers of the words by language, the numbers as they follow each other), so many at a time.
    _GAP stands between pieces and between texts."""

    def fresh():
        ids = count(_EMPTY + 1).__next__
        return defaultdict(lambda: defaultdict(ids, {b"\n": _GAP, b"": _EMPTY})), [np.zeros(1, np.int32)]

    langs, parts = fresh()
    held = 0
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), binary_texts(b.column("text")), strict=True):
            words = text.translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
            parts += [np.fromiter(map(langs[lang].__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
            held += len(words)
            if held >= shard_words:
                yield langs, np.concatenate(parts)
                langs, parts = fresh()
                held = 0
    if held:
        yield langs, np.concatenate(parts)


def _hashes(langs: dict[str, dict[bytes, int]]) -> np.ndarray:
    """64 bits of language and word, by number."""
    out = np.zeros(2 + sum(len(w) - 2 for w in langs.values()), np.uint64)
    for lang, words in langs.items():
        seed = xxhash.xxh64_intdigest(lang.encode())
        for text, w in words.items():
            out[w] = xxhash.xxh64_intdigest(text, seed)
    return out


def _word_counter(shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, seq in _shards(batches, shard_words):
            times, hashes = np.bincount(seq, minlength=2), _hashes(langs).view(np.int64)
            for lang, words in langs.items():
                del words[b"\n"], words[b""]
                w = np.fromiter(words.values(), np.int64, len(words))
                texts = pa.array(list(words), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(hashes[w]), pa.array([lang] * len(w), pa.string()), texts, pa.array(times[w])], names=["id", "lang", "word", "f"])

    return run


def _phrase_counter(shard_words: int, words: Callable[[], np.ndarray], pairs: Callable[[], np.ndarray] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_words, in_pairs = words(), pairs() if pairs else None
        for langs, seq in _shards(batches, shard_words):
            hashes = _hashes(langs)
            common = may_be(in_words, hashes)
            common[[_GAP, _EMPTY]] = False
            seq = seq[seq != _EMPTY]
            place = np.flatnonzero(common[seq])
            number = np.cumsum(common) - 1
            word = number[seq[place]]
            order = np.argsort(word, kind="stable")
            own = hashes[common]
            shard = Shard(word[order], place[order], len(own))
            test = (lambda a, b: may_be(in_pairs, own[a], own[b])) if pairs else None  # noqa: B023
            for *phrase, counts in shard.phrases(test):
                yield pa.RecordBatch.from_arrays([*(pa.array(own[p].view(np.int64)) for p in phrase), pa.array(counts)], names=[*(f"w{i + 1}" for i in range(len(phrase))), "a"])

    return run


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts up to 10^15."""
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a)), wide(left) * wide(right)).cast("long")


def _looked_up(rows: DataFrame, base: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """rows with the columns of table, which has one row per key and holds every key of rows; common keys are dealt over
    tasks. base has the keys of rows, as often, and is cheap to read."""
    return salted_join(rows, table.join(base.groupBy(*on).agg(F.count(F.lit(1)).alias("k")), on), on, [c for c in ("w1", "w2", "w3") if c not in on])


def _named(words: DataFrame, i: int) -> DataFrame:
    return words.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"word{i}"), F.col("f").alias(f"f{i}"), *(["lang"] if i == 1 else []))


def collocations(docs: DataFrame, *, min_count: int = MIN_COUNT, top: int = TOP, contained_percent: int = CONTAINED_PERCENT, text_col: str = "text", lang_col: str = "lang", shard_words: int = SHARD_WORDS) -> DataFrame:
    """The best `top` phrases of two or three words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split at `[.,;:!?\\x0A-\\x0D]` into pieces and those into words `[^\\x20\\x09]+`. A
    phrase with a count a of `min_count` or more within pieces is a candidate; each cut of it in two has a score
    floor(1000000 * a * a / (l * r)) of the counts of its parts, and the lowest counts, of equal ones the first. Two words
    inside a candidate of three that has `contained_percent` of their count or more are dropped. Ranks go by score, count
    and phrase (by bytes); n counts all words of the language. A null language is `und`, a null text empty; repeated rows
    count again; tables without words give no rows. Other columns of docs are ignored.
    """
    spark = docs.sparkSession
    conf, name = spark.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counted, in_counted = stored(rows.mapInArrow(_word_counter(shard_words), "id long, lang string, word string, f long").groupBy("id", "lang", "word").agg(F.sum("f").alias("f")))
    words, _ = stored(counted.where(F.col("f") >= min_count))
    sizes, _ = stored(counted.groupBy("lang").agg(F.sum("f").alias("n")))
    discard(spark, in_counted)
    in_words = bit_filter(words, "id")
    pairs = rows.mapInArrow(_phrase_counter(shard_words, in_words, None), "w1 long, w2 long, a long").groupBy("w1", "w2").agg(F.sum("a").alias("a"))
    pairs, _ = stored(pairs.where(F.col("a") >= min_count))
    in_pairs = bit_filter(pairs, "w1", "w2")
    triples = rows.mapInArrow(_phrase_counter(shard_words, in_words, in_pairs), "w1 long, w2 long, w3 long, a long").groupBy("w1", "w2", "w3").agg(F.sum("a").alias("a"))
    triples, _ = stored(triples.where(F.col("a") >= min_count))

    inside = triples.select(F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a").groupBy("p.w1", "p.w2").agg(F.max("a").alias("most"))
    free = pairs.join(inside, ["w1", "w2"], "left").where(F.coalesce(100 * F.col("most") < contained_percent * F.col("a"), F.lit(True))).drop("most")
    free, _ = stored(free.select("w1", "w2", F.lit(None).cast("long").alias("w3"), "a"))
    keys = free.unionByName(triples)
    heads = _looked_up(triples, triples, pairs.select("w1", "w2", F.col("a").alias("f12")), ["w1", "w2"])
    both = _looked_up(heads, triples, pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23")), ["w2", "w3"])
    none = F.lit(None).cast("long")
    rows = free.select("*", none.alias("f12"), none.alias("f23")).unionByName(both)
    for i in (1, 2):
        rows = _looked_up(rows, keys, _named(words, i), [f"w{i}"])
    short = rows.where("w3 is null").withColumns({"word3": none.cast("string"), "f3": none})
    rows = short.unionByName(_looked_up(rows.where("w3 is not null"), triples, _named(words, 3), ["w3"]))
    cut1, cut2 = _score(F.col("a"), F.col("f1"), F.coalesce("f23", "f2")), _score(F.col("a"), F.col("f12"), F.col("f3"))
    scored = rows.withColumn("s1", cut1).withColumn("s2", F.when(F.col("w3").isNotNull(), cut2)).withColumn("second", F.coalesce(F.col("s2") < F.col("s1"), F.lit(False)))
    pick = lambda a, b: F.when(F.col("second"), F.col(a)).otherwise(b)
    out = scored.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", pick("f12", F.col("f1")).alias("l"), pick("f3", F.coalesce("f23", "f2")).alias("r"), pick("s2", F.col("s1")).alias("score"))
    ranked = out.withColumn("rank", F.row_number().over(W.Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
    return ranked.where(F.col("rank") <= top).join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))
