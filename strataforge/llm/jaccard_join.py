"""N-gram Jaccard join with prefix filters under several global orders.

Two sets with a Jaccard similarity of at least t share a token among the first n - ceil(t n) + 1 of each, whatever the
global order of all tokens. The orders here put rare words first and tokens that stand out in a bounded sketch of the
corpus last, and differ in a seeded hash. Tokens shared under the first order make candidates. Sizes, the places of the
shared token and a small histogram of each set then rule out most of them, exactly; the others must share a prefix token
under every other order before the whole sets are compared.

Documents with equal sets are one class. Within the classes that share a token, all are first compared with one
head only (a star, linear in the group); pairs that are then still in different components are compared in a
second round. So a group of copies costs no quadratic work, and no link between different components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_texts, checked, cut, id_text, only, read_table, release, without
from .components import components
from .shingles import Hasher, mix

WORDS = 5
PERCENT = 80
#: Buckets of the frequency sketches of words and of tokens: what the driver and each task hold of them (a byte each),
#: however large the corpus.
WORD_SKETCH, TOKEN_SKETCH = 1 << 20, 1 << 22
#: The level of a token that stands out; others have half the summed logarithms of their words' frequencies.
HEAVY = 63
#: Global orders: the first makes candidates, the others filter them.
ORDERS = 3


def class_id(tokens: np.ndarray) -> int:
    """64 bits of a set, the same for equal sets; 0 is the empty set."""
    if not len(tokens):
        return 0
    return int(mix(np.array([mix(tokens, 11).sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64)).astype(np.int64)[0])


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def histogram(tokens: np.ndarray) -> bytes | None:
    """How many tokens fall into each of about n / 4 buckets, a byte each; None where a byte is too small."""
    size = 1 << max(4, len(tokens).bit_length() - 3)
    counts = np.bincount((mix(tokens, 77) >> np.uint64(40)).astype(np.int64) & (size - 1), minlength=size)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else None


def most_common(a: bytes | None, b: bytes | None, n: int) -> int:
    """An upper bound of the intersection size of two sets, from their histograms; n where one is missing."""
    if a is None or b is None:
        return n
    x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (a, b))
    size = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, size).sum(0), y.reshape(-1, size).sum(0)).sum())


def _buckets(tokens: np.ndarray, size: int) -> np.ndarray:
    return (tokens & np.uint64(size - 1)).astype(np.int32)


def _word_levels(sketch: np.ndarray) -> np.ndarray:
    return np.minimum(60, np.log2(np.maximum(sketch, 1))).astype(np.uint8)


def _classify(words: int, percent: int):
    """Rows of documents with their class, and at the end of a task what stands out in its sketches (0 words, 1 tokens).

    All tokens are counted until they would fill a sixteenth of the sketch; from then on those that matter, in prefixes: of
    each document the rarest by the words that this task has seen so far.
    """
    names = ["doc_id", "h", "cls", "n", "hist", "sketch", "bucket", "seen"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, kind = Hasher(), None
        sketches = [np.zeros(WORD_SKETCH, np.int64), np.zeros(TOKEN_SKETCH, np.int64)]
        pending: list[list] = [[], []]
        level, none_heavy, fresh = np.zeros(WORD_SKETCH, np.uint8), np.zeros(TOKEN_SKETCH, bool), False
        counted = 0

        def count(least: int) -> bool:
            """Counts what waits, once it is worth a pass over the sketch; says whether it did."""
            done = False
            for sketch, parts in zip(sketches, pending, strict=True):
                if parts and sum(map(len, parts)) >= least:
                    sketch += np.bincount(np.concatenate(parts), minlength=len(sketch))
                    parts.clear()
                    done = True
            return done

        for b in batches:
            kind, ids, sizes, hists = b.column("doc_id").type, [], [], []
            if fresh:
                level, fresh = _word_levels(sketches[0]), False
            for text in binary_texts(b.column("text")):
                tokens, rarity, hashes = leveled(hasher, text, words, (level, none_heavy))
                ids.append(class_id(tokens))
                sizes.append(len(tokens))
                hists.append(histogram(tokens))
                pending[0].append(_buckets(hashes, WORD_SKETCH))
                counted += len(tokens)
                some = tokens if counted < TOKEN_SKETCH // 16 else _rarest(tokens, rarity, 0, prefix_size(len(tokens), percent))
                pending[1].append(_buckets(some, TOKEN_SKETCH))
            fresh = count(500_000) or fresh
            none, empty = pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(hists, pa.binary()), none, none, empty], names=names)
        count(1)
        for which, sketch in enumerate(sketches if kind is not None else ()):
            out = np.flatnonzero(sketch > (8 + 4 * sketch.mean(), 1 + 4 * max(0.0, sketch.mean() - 0.25))[which])
            for at in range(0, len(out), 100_000):
                part = out[at : at + 100_000]
                empty = pa.nulls(len(part), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.nulls(len(part), kind), empty, empty, empty, pa.nulls(len(part), pa.binary()), pa.array(np.full(len(part), which, np.int32)), pa.array(part.astype(np.int32)), pa.array(sketch[part])], names=names)

    return run


def _levels(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(levels of word buckets: logarithms of what was seen; which token buckets stand out), at most a byte a bucket.

    A token bucket stands out if the tasks saw more than a dozen in it, and well more than in the average bucket.
    """
    sums = found.where("sketch is not null").groupBy("sketch", "bucket").agg(F.sum("seen").alias("seen"))
    total = sums.where("sketch = 1").agg(F.sum("seen").alias("total")).first()["total"] or 0
    some = sums.where((F.col("sketch") == 0) | (F.col("seen") > 12 + 4 * total / TOKEN_SKETCH)).toPandas()
    words, heavy = np.zeros(WORD_SKETCH, np.int64), np.zeros(TOKEN_SKETCH, bool)
    of_words = some["sketch"].to_numpy(int) == 0
    words[some["bucket"].to_numpy(int)[of_words]] = some["seen"].to_numpy(int)[of_words]
    heavy[some["bucket"].to_numpy(int)[~of_words]] = True
    return _word_levels(words), heavy


def leveled(hasher: Hasher, text: bytes, words: int, levels: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct tokens of a text, the level of each, which comes first in every global order, and the words."""
    hashes = hasher.words(text)
    if not len(hashes):
        return hashes, np.zeros(0, np.uint64), hashes
    tokens, first = np.unique(hasher.shingles(hashes, words), return_index=True)
    own = np.concatenate([[0], np.cumsum(levels[0][_buckets(hashes, WORD_SKETCH)], dtype=np.int64)])
    n = min(words, len(hashes))
    level = np.minimum((own[n:] - own[: len(own) - n])[first] // 2, HEAVY - 1)
    return tokens, np.where(levels[1][_buckets(tokens, TOKEN_SKETCH)], HEAVY, level).astype(np.uint64), hashes


def _keys(tokens: np.ndarray, level: np.ndarray, order: int) -> np.ndarray:
    return (mix(tokens, 100 + order) >> np.uint64(6)) | (level << np.uint64(58))


def _rarest(tokens: np.ndarray, level: np.ndarray, order: int, size: int) -> np.ndarray:
    return tokens[np.argpartition(_keys(tokens, level, order), size - 1)[:size]] if size < len(tokens) else tokens


def ordered_prefix(tokens: np.ndarray, level: np.ndarray, order: int, size: int) -> np.ndarray:
    """The first `size` tokens in this order: by level, then by a hash of the order's own."""
    key = _keys(tokens, level, order)
    if size < len(tokens):
        part = np.argpartition(key, size - 1)[:size]
        tokens, key = tokens[part], key[part]
    return tokens[np.argsort(key)]


def _prefixes(words: int, percent: int, levels):
    """(token, cls, n, place) of the first order's prefix; the place of a token counts from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            parts, ids, sizes, done = [], [], [], set()
            for text in binary_texts(b.column("text")):
                tokens, level, _ = leveled(hasher, text, words, levels.value)
                if not len(tokens) or (c := class_id(tokens)) in done:
                    continue
                done.add(c)
                parts.append(ordered_prefix(tokens, level, 0, prefix_size(len(tokens), percent)).astype(np.int64))
                ids.append(c)
                sizes.append(len(tokens))
            if parts:
                counts = list(map(len, parts))
                place = np.concatenate([np.arange(k, dtype=np.int32) for k in counts])
                arrays = np.concatenate(parts), np.repeat(np.array(ids, np.int64), counts), np.repeat(np.array(sizes, np.int32), counts), place
                for i in range(0, len(place), 200_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 200_000]) for x in arrays], names=["token", "cls", "n", "place"])

    return run


def _sets(words: int, percent: int, levels):
    """(cls, tokens, the prefixes of the other orders) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, done = Hasher(), set()
        for b in batches:
            ids, columns = [], [[] for _ in range(ORDERS)]
            for text in binary_texts(b.column("text")):
                tokens, level, _ = leveled(hasher, text, words, levels.value)
                if not len(tokens) or (c := class_id(tokens)) in done:
                    continue
                done.add(c)
                ids.append(c)
                size = prefix_size(len(tokens), percent)
                columns[0].append(tokens.astype(np.int64))
                for k in range(1, ORDERS):
                    columns[k].append(ordered_prefix(tokens, level, k, size).astype(np.int64))
            if ids:
                lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]).astype(np.int32)), pa.array(np.concatenate(x))) for x in columns]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *lists], names=["cls", "tokens", *[f"p{k}" for k in range(1, ORDERS)]])

    return run


def _possible(percent: int):
    """Of pairs with both sizes and histograms, those that may be similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("a_n", "b_n", "a_hist", "b_hist")), strict=True)
            keep = [100 * c >= percent * (x + y - c) for x, y, c in ((x, y, min(x, y, most_common(g, h, min(x, y)))) for x, y, g, h in rows)]
            yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _verified(texts: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int, levels) -> DataFrame:
    """The pairs (a, b) of classes that pass every filter and whose sets are similar enough.

    First the histograms decide, then prefixes must meet under every other order, then, for the pairs that are left, the
    sets are intersected. Only the sets that a remaining pair needs are made: their texts are found by hash.
    """
    side = lambda x: classes.select(F.col("cls").alias(x), F.col("n").alias(f"{x}_n"), F.col("hist").alias(f"{x}_hist"))
    sized = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
    pairs = cut(sized.mapInArrow(_possible(percent), "a long, b long"))
    picked = _texts_of(texts, classes, pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
    fields = ", ".join(f"p{k} array<long>" for k in range(1, ORDERS))
    sets = cut(picked.mapInArrow(_sets(words, percent, levels), f"cls long, tokens array<long>, {fields}").dropDuplicates(["cls"]))
    named = lambda side, names: sets.select(F.col("cls").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in names])
    short = [f"p{k}" for k in range(1, ORDERS)]
    both = pairs.join(named("a", short), "a").join(named("b", short), "b")
    for p in short:
        both = both.where(F.arrays_overlap(f"a_{p}", f"b_{p}"))
    both = both.select("a", "b").join(named("a", ["tokens"]), "a").join(named("b", ["tokens"]), "b")
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return both.where(100 * common >= percent * (F.size("a_tokens") + F.size("b_tokens") - common)).select("a", "b")


def _texts_of(texts: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the classes in wanted (cls), found by hash; a text may come more than once, and few others with it."""
    hashes = checked(cut(wanted.join(classes.select("cls", "h"), "cls").select("h")))
    return texts.withColumn("h", F.xxhash64("text")).join(hashes, "h", "left_semi").select("text")


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct rows (token, cls, n, place) with the label of the class, of tokens that different labels share; usual says
    whether it is the token's most frequent label."""
    rows = rows.distinct().join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    counts = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k"))
    open_ = counts.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max_by("label", F.struct("k", "label")).alias("top")).where("x < y").select("token", "top")
    return rows.join(open_, "token").withColumn("usual", F.col("label") == F.col("top")).drop("top")


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, a_label, b_label) of classes with different labels that share a token and may be similar enough by their
    sizes and the token's places; the labels are in no order.

    Sizes are dealt in bands, so that only neighbours in size meet. The smaller set of a pair takes part only with the
    tokens before which it has room for a set of its own size. Of two different labels one is not the token's usual
    label: rows with the usual one meet the others, never each other, so a large group that is one component already
    costs a row each for every stranger, not the square of its size.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent))
    side = lambda x: [F.col(c).alias(f"{x}{t}") for c, t in (("cls", ""), ("n", "_n"), ("place", "_place"), ("label", "_label"))]
    strangers = F.when(F.col("usual"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    large = rows.select("token", *side("x"), band.alias("band"), F.explode(strangers).alias("usual"))
    small = rows.where((100 + percent) * (F.col("n") - F.col("place")) >= 2 * percent * F.col("n"))
    small = small.select("token", *side("y"), "usual", F.explode(F.array(band, band + 1)).alias("band"))
    near = (F.struct("x_n", "x") > F.struct("y_n", "y")) & (F.col("x_label") != F.col("y_label")) & (100 * F.col("y_n") >= percent * F.col("x_n"))
    # the first token that two sets share leaves room for enough others behind it in both
    room = (100 + percent) * F.least(F.col("x_n") - F.col("x_place"), F.col("y_n") - F.col("y_place")) >= percent * (F.col("x_n") + F.col("y_n"))
    found = large.join(small, ["token", "band", "usual"]).where(near & room)
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.col("x_label").alias("a_label"), F.col("y_label").alias("b_label")).distinct()


def jaccard_classes(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, h (a hash of the text), n_shingles, component_id, component (null for no words).

    The set of a document: its distinct runs of `words` words (A-Z lower-cased); with fewer words the whole sequence;
    without words or text the empty set, which is linked with nothing. Documents link when 100 * intersection size is
    at least percent * union size; component_id is the smallest id that links reach, the document's own included, null
    where no reachable row has an id. Rows that repeat an id or a text are linked like any others.
    """
    texts = id_text(docs, id_col, text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, h long, cls long, n long, hist binary, sketch int, bucket int, seen long"
    found = cut(texts.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(_classify(words, percent), schema))
    rows = found.where("sketch is null").select("doc_id", "h", "cls", "n", "hist")
    levels = docs.sparkSession.sparkContext.broadcast(_levels(found))
    classes = cut(rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.first("hist", ignorenulls=True).alias("hist"), F.min("h").alias("h")))
    texts = texts.select("text")

    prefixes = texts.mapInArrow(_prefixes(words, percent, levels), "token long, cls long, n int, place int")
    # the head of a token's star has the fewest rarer tokens before it: of near copies, the one in the middle
    order = F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("cls").bitwiseAND(0xFFFFFFFF))
    heads = prefixes.groupBy("token").agg(F.min_by("cls", order).alias("head"), F.min("cls").alias("x"), F.max("cls").alias("y")).where("x < y").select("token", "head")
    shared = cut(prefixes.join(heads, "token").select("token", "cls", "n", "place", "head"))
    release(docs.sparkSession)
    stars = cut(shared.where("cls != head").select(F.least("head", "cls").alias("a"), F.greatest("head", "cls").alias("b")).distinct())
    first = cut(components(_verified(texts, classes, stars, words, percent, levels)))
    release(docs.sparkSession)

    labels = first.withColumnRenamed("node", "cls").withColumnRenamed("component", "label")
    member = cut(_mixed(shared.select("token", "cls", "n", "place"), labels))
    rest = cut(_pairs(member, percent).join(stars, ["a", "b"], "left_anti"))
    more = _verified(texts, classes, rest, words, percent, levels).join(rest, ["a", "b"])
    second = cut(components(more.select(F.col("a_label").alias("a"), F.col("b_label").alias("b"))))

    label = first.select(F.col("node").alias("cls"), "component").join(second.select(F.col("node").alias("component"), F.col("component").alias("further")), "component", "left")
    label = label.select("cls", F.coalesce("further", "component").alias("component"))
    label = label.unionByName(second.select(F.col("node").alias("cls"), "component").join(label.select("cls"), "cls", "left_anti"))
    named = classes.select("cls", "least").join(label, "cls", "left").select("cls", "least", F.coalesce("component", "cls").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = named.join(smallest, "component").select("cls", "component_id", "component")
    component_id = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "h", "cls", "n").join(by_class, "cls", "left").select("doc_id", "h", F.col("n").alias("n_shingles"), component_id.alias("component_id"), "component")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """docs, with all its columns, with one row of each component: the smallest id (no id comes last), then the smallest
    hash of the text; of rows with words that repeat both, one (any, if other columns differ). Rows without words or
    text all stay, repeated ones too. An empty table gives no rows."""
    found = cut(jaccard_classes(docs, **options).where("component is not null").select("doc_id", "h", "component"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("h").alias("h"))
    best = cut(found.groupBy("component").agg(F.min(rank).alias("best")))
    out = without(docs, found.join(best, "component").where(~rank.eqNullSafe(F.col("best"))))
    rows = found.groupBy("component", "doc_id", "h").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    twice = cut(rows.join(best, "component").where(rank.eqNullSafe(F.col("best"))).select("doc_id", "h"))
    if not twice.limit(1).count():
        return out
    one = only(out, twice).dropDuplicates(["doc_id", "text"])
    return without(out, twice).unionByName(one)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_classes(read_table(spark, sf_dir, "documents"), words=4, percent=85)
    return out.select("doc_id", "n_shingles", "component_id")
