"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network predicts a token from its two neighbours on either side: four embeddings are added, squashed, and give a
softmax over VOCABULARY tokens, factored into clusters and the members of a cluster. The most frequent words of the
corpus are tokens of their own; every other word is of a token that stands for its shape, and has its own probability
within the shape from its count in the corpus, its own occurrence left out. So every word of every text is predicted.

The counts of words are over the whole corpus and grow with it: a table of all words, of which the most frequent are
sent to the tasks and all others joined by a shuffle. The weights are fitted on every window of every text, in the tasks:
texts are dealt by hash into parts of about PART_WINDOWS windows; a first part is fitted from random weights, all others
follow in ROUNDS rounds, in each of which every task goes on from the same weights and the mean of what they come to is
where the next round begins. Scoring is in the tasks, over all words of all texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_texts, cut, id_text, read_table, to_tasks
from .shingles import Hasher, mix

#: Tokens of the network, in clusters of CLUSTER. The first cluster holds the shapes of the words that are no tokens.
VOCABULARY, CLUSTER = 4096, 64
SHAPES = CLUSTER
#: Neighbours on either side.
SIDE = 2
DIM = 24
#: Windows of a part of the corpus, about: what a task holds and fits at once. All parts are fitted, however many they are.
PART_WINDOWS = 200_000
#: Parts that a task fits one after the other in a round, at most, and rounds after the first part.
PARTS_OF_TASK, ROUNDS = 5, 4
#: Windows of a step of the rounds, and the rate of the first round; it falls to nothing over the rounds.
BATCH, RATE = 16_384, 0.016
#: Blocks that weights are cut into on their way from the tasks.
BLOCKS = 64
#: Words whose counts are sent to all tasks at most; the counts of all others are joined by a shuffle. Changes no result.
HEAD_WORDS = 100_000
#: What every word of a shape has besides its count.
ALPHA = 0.5

_CONTEXT = [k for k in range(-SIDE, SIDE + 1) if k]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_KIND = np.zeros((256, 3), np.int32)  # upper case, digit, other ASCII sign
_KIND[65:91, 0] = _KIND[48:58, 1] = 1
_KIND[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,"], 2] = 1


def words_and_shapes(text: bytes, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """For each word `[^\\x20\\x09-\\x0D]+` its 64-bit hash, and its shape: signs in it, length, two bits of the hash."""
    raw = np.frombuffer(text, np.uint8)
    edge = np.diff(np.concatenate([[True], _IS_SPACE[raw], [True]]).view(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    h = mix(hasher.between(hasher.prefix(raw), start, end))
    sums = np.zeros((len(raw) + 1, 3), np.int32)
    np.cumsum(_KIND[raw], axis=0, out=sums[1:])
    upper, digit, sign = (sums[end] - sums[start]).T
    kind = np.where(sign > 0, 3, np.where(digit > 0, 2, np.where(upper > 1, 1, 0)))
    return h.view(np.int64), (16 * kind + 4 * np.digitize(end - start, (4, 7, 11)) + (h >> np.uint64(62)).astype(np.int64)).astype(np.int32)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for b in batches:
        found = [words_and_shapes(text, hasher) for text in binary_texts(b.column("text"))]
        words, shapes = (np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, np.int32)), *found, strict=True))
        word, first, n = np.unique(words, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(shapes[first]), pa.array(n.astype(np.int64))], names=["word", "shape", "n"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, shape, n): the hash of every word of docs (a column text) and how often it occurs, cut to the shared folder."""
    counts = docs.select("text").mapInArrow(_count_words, "word long, shape int, n long")
    return cut(counts.groupBy("word").agg(F.max("shape").alias("shape"), F.sum("n").alias("n")))


class Words:
    """What tasks know of the corpus: its frequent words by hash, with their tokens, and log P(word | shape) of the others."""

    def __init__(self, frequent, of_shape: np.ndarray, kinds: np.ndarray, total: int) -> None:
        """frequent: word, shape, n of the most frequent words; of_shape, kinds: words of each shape that are no tokens,
        counted and distinct; total: all words, counted."""
        self.total = total
        tops = frequent.sort_values(["n", "word"], ascending=[False, True]).reset_index(drop=True)
        rank, shape, n = np.arange(len(tops)), tops["shape"].to_numpy(np.int64), tops["n"].to_numpy(np.int64)
        own = rank < VOCABULARY - SHAPES
        self.log_shape = np.log(np.maximum(of_shape - 1, 0) + ALPHA * np.maximum(kinds, 1))
        inside = np.where(own, 0.0, np.log(n - 1 + ALPHA) - self.log_shape[shape])
        order = np.argsort(tops["word"].to_numpy(np.int64))
        self.word, self.inside = tops["word"].to_numpy(np.int64)[order], inside[order]
        self.token = np.where(own, SHAPES + rank, shape)[order].astype(np.int32)

    def tokens(self, word: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of words, log P(word | token), and which words are not known here."""
        if not len(self.word):
            return shape, np.zeros(len(word)), np.ones(len(word), bool)
        at = np.minimum(np.searchsorted(self.word, word), len(self.word) - 1)
        known = self.word[at] == word
        return np.where(known, self.token[at], shape), np.where(known, self.inside[at], 0.0), ~known


def padded(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of texts one after the other with edges around each, and the places of the tokens."""
    edge = np.full(SIDE, VOCABULARY, np.int32)
    seq = np.concatenate([edge, *[x for t in tokens for x in (t, edge)]])
    return seq, np.flatnonzero(seq != VOCABULARY)


def _encoder(words):
    """Texts as tokens of two bytes each, with the sum of log P(word | token) of the words known to the tasks, and the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known = Hasher(), words()
        for b in batches:
            found = [words_and_shapes(text, hasher) for text in binary_texts(b.column("text"))]
            n = np.array([len(w) for w, _ in found], np.int64)
            of = np.repeat(np.arange(len(n)), n)
            word, shape = (np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, np.int32)), *found, strict=True))
            tokens, inside, rare = known.tokens(word, shape)
            ends = np.concatenate([[0], np.cumsum(np.bincount(of[rare], minlength=len(n)))]).astype(np.int32)
            packed = pa.array([x.astype("<u2").tobytes() for x in np.split(tokens, np.cumsum(n)[:-1])][: len(n)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("h"), pa.array(n), pa.array(np.bincount(of, inside, len(n))), packed, pa.ListArray.from_arrays(pa.array(ends), pa.array(word[rare]))],
                names=["row", "doc_id", "h", "n_tokens", "inside", "tokens", "rare"],
            )

    return run


def encoded(rows: DataFrame, known: Words) -> DataFrame:
    """rows (doc_id, text) as row, doc_id, h, n_tokens, inside, tokens, rare: see `_encoder`; h is a hash of id and text. Cut."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64(F.lit(5), "doc_id", "text").alias("h"), "text")
    return cut(rows.mapInArrow(_encoder(to_tasks(rows.sparkSession, known)), f"row long, doc_id {kind}, h long, n_tokens long, inside double, tokens binary, rare array<bigint>"))


def unpacked(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), "<u2").astype(np.int32) for x in column]


def distinct_windows(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different windows of texts: contexts, tokens, and how often each is seen."""
    seq, at = padded(tokens)
    key, bits = seq[at].astype(np.uint64), VOCABULARY.bit_length()  # 12 bits and four times 13: an edge is VOCABULARY
    for j, k in enumerate(_CONTEXT):
        key |= seq[at + k].astype(np.uint64) << np.uint64(bits * (j + 1) - 1)
    key, n = np.unique(key, return_counts=True)
    context = [key >> np.uint64(bits * (j + 1) - 1) & np.uint64((1 << bits) - 1) for j in range(2 * SIDE)]
    return np.stack(context, axis=1).astype(np.int32), (key & np.uint64(VOCABULARY - 1)).astype(np.int64), n


class Network:
    """Weights, and the log-probability of tokens in their contexts."""

    def __init__(self, seed: int = 3, dim: int = DIM) -> None:
        draw = np.random.default_rng(seed)
        shapes = {"in": (2 * SIDE, VOCABULARY + 1, dim), "hidden": (dim,), "cluster": (dim, VOCABULARY // CLUSTER), "cluster_bias": (VOCABULARY // CLUSTER,), "member": (VOCABULARY // CLUSTER, dim, CLUSTER), "member_bias": (VOCABULARY // CLUSTER, CLUSTER)}
        self.moments: tuple = ()
        self.p = {k: (draw.normal(0, 0.1, s) if len(s) > 1 and "bias" not in k else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """What the network makes of contexts, and a last column of ones for the biases."""
        h = np.ones((len(context), len(self.p["hidden"]) + 1), np.float32)
        h[:, :-1] = np.tanh(sum(self.p["in"][k].take(context[:, k], axis=0) for k in range(2 * SIDE)) + self.p["hidden"])
        return h

    def outer(self) -> tuple[np.ndarray, np.ndarray, bool]:
        """The matrices of the clusters and of their members, biases below, and whether no exponential of their logits can
        overflow or vanish: what is hidden is within -1 and 1."""
        p = self.p
        clusters, members = np.vstack([p["cluster"], p["cluster_bias"]]), np.concatenate([p["member"], p["member_bias"][:, None]], axis=1)
        return clusters, members, bool(np.abs(clusters).sum(0).max() <= 80 and np.abs(members).sum(1).max() <= 80)

    @staticmethod
    def by_cluster(token: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """An order of tokens by cluster, and where each cluster that occurs then lies."""
        cluster = (token // CLUSTER).astype(np.uint16)
        ends = np.concatenate([[0], np.cumsum(np.bincount(cluster, minlength=VOCABULARY // CLUSTER))])
        return np.argsort(cluster, kind="stable"), [(c, slice(ends[c], ends[c + 1])) for c in np.flatnonzero(np.diff(ends))]

    @staticmethod
    def member_logits(h: np.ndarray, members: np.ndarray, clusters: list[tuple[int, slice]]) -> np.ndarray:
        z = np.empty((len(h), CLUSTER), np.float32)
        for c, at in clusters:
            np.matmul(h[at], members[c], out=z[at])
        return z

    @staticmethod
    def exponentials(z: np.ndarray, own: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray]:
        """The log-probability of `own` in each row of logits, and the sums of the exponentials, which take the place of z."""
        if not safe:
            z -= z.max(1, keepdims=True)
        chosen = z[np.arange(len(z)), own]
        sums = np.exp(z, out=z) @ np.ones(z.shape[1], z.dtype)
        return chosen - np.log(sums), sums

    def log_p(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        out, (first, members, safe) = np.zeros(len(token), np.float32), self.outer()
        for i in range(0, len(token), 16_384):
            order, clusters = self.by_cluster(token[i : i + 16_384])
            t, h = token[i : i + 16_384][order], self.hidden(context[i : i + 16_384].take(order, axis=0))
            for z, own in ((h @ first, t // CLUSTER), (self.member_logits(h, members, clusters), t % CLUSTER)):
                out[i + order] += self.exponentials(z, own, safe)[0]
        return out

    def fit(self, context: np.ndarray, token: np.ndarray, weight: np.ndarray, *, epochs: int = 4, batch: int = 1024, rate: float = 0.01, steps: int = 200, seed: int = 5, resume: bool = False) -> Network:
        """Adam on the weighted log loss, for so many epochs and at least so many steps. The biases begin at the
        frequencies of the tokens, unless the fit resumes an earlier one."""
        p, draw = self.p, np.random.default_rng(seed)
        if not resume:
            counts = np.bincount(token, weight, VOCABULARY).reshape(-1, CLUSTER) + 0.01
            p["cluster_bias"] += np.log(counts.sum(1) / counts.sum()).astype(np.float32)
            p["member_bias"] += np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)
        first, second, t = self.moments or ({k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0)
        epochs = max(epochs, -(-steps // -(-len(token) // batch))) if len(token) else 0
        for epoch in range(epochs):
            for part in np.array_split(draw.permutation(len(token)), -(-len(token) // batch)):
                order, clusters = self.by_cluster(token[part])
                part = part[order]
                c, tok, w = context.take(part, axis=0), token[part], (weight[part] / weight[part].sum()).astype(np.float32)
                (outer, members, safe), h, at_row = self.outer(), self.hidden(c), np.arange(len(tok))
                both = []
                for z, own in ((h @ outer, tok // CLUSTER), (self.member_logits(h, members, clusters), tok % CLUSTER)):
                    z *= (w / self.exponentials(z, own, safe)[1])[:, None]
                    z[at_row, own] -= w
                    both.append(z)
                d_outer, d_members, dh = h.T @ both[0], np.zeros_like(members), both[0] @ p["cluster"].T
                for k, at in clusters:
                    d_members[k] = h[at].T @ both[1][at]
                    dh[at] += both[1][at] @ p["member"][k].T
                dh *= 1 - h[:, :-1] * h[:, :-1]
                g = {"cluster": d_outer[:-1], "cluster_bias": d_outer[-1], "member": d_members[:, :-1], "member_bias": d_members[:, -1], "hidden": dh.sum(0), "in": np.empty_like(p["in"])}
                turned = np.ascontiguousarray(dh.T, np.float64)
                for k in range(2 * SIDE):
                    column = c[:, k].astype(np.int64)
                    g["in"][k] = np.stack([np.bincount(column, x, VOCABULARY + 1) for x in turned], axis=1)
                t += 1
                for k in p:
                    first[k] += 0.1 * (g[k] - first[k])
                    second[k] += 0.01 * (g[k] * g[k] - second[k])
                    p[k] -= rate * (1 - epoch / epochs) / (1 - 0.9**t) * first[k] / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
        self.moments = first, second, t
        return self

    def vector(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def take(self, vector: np.ndarray) -> Network:
        """The weights of `vector`, and no moments of an earlier fit."""
        at, self.moments = 0, ()
        for k in sorted(self.p):
            self.p[k] = vector[at : at + self.p[k].size].reshape(self.p[k].shape).astype(np.float32)
            at += self.p[k].size
        return self


def _fitter(model, windows: int, how: dict, resume: bool):
    """Goes on from the weights of `model` with every window of its rows, about `windows` at once; yields the weights by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, held, size, seen = model(), [], 0, 0

        def fit() -> None:
            context, token, n = distinct_windows(held)
            # a window counts by the square root of how often it is seen, so that copies do not drown the rest
            network.fit(context, token, np.sqrt(n), **how, resume=resume or seen > 0)

        for b in batches:
            for tokens in unpacked(b.column("tokens")):
                held.append(tokens)
                size += len(tokens)
                if size >= windows:
                    fit()
                    held, size, seen = [], 0, seen + size
        if size:
            fit()
        if seen + size:
            blocks = [x.astype("<f4").tobytes() for x in np.array_split(network.vector(), BLOCKS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([seen + size] * BLOCKS, pa.int64()), pa.array(blocks, pa.binary())], names=["block", "n", "weights"])

    return run


def _mean(table: pa.Table) -> pa.Table:
    """The mean of a block over the tasks, by their windows; and these."""
    n = table["n"].to_numpy()
    total = sum(k * np.frombuffer(x.as_py(), "<f4").astype(np.float64) for k, x in zip(n, table["weights"], strict=True))
    return pa.table({"block": table["block"][:1].cast(pa.int32()), "n": pa.array([int(n.sum())], pa.int64()), "weights": pa.array([(total / n.sum()).astype("<f4").tobytes()], pa.binary())})


def fit_weights(texts: DataFrame, total: int, windows: int = PART_WINDOWS) -> Network:
    """The network fitted on all `total` windows of texts (h, n_tokens, tokens), in parts of about `windows`.

    A text is in one part, by its hash, and parts are taken in order of part and hash, so the weights do not depend on how
    texts are partitioned, but for the rounding of means.
    """
    network, parts = Network(), max(1, -(-total // windows))
    spark, network.windows = texts.sparkSession, 0
    texts = texts.where("n_tokens > 0").select(F.pmod("h", F.lit(parts)).cast("int").alias("part"), "h", "tokens")
    rounds = min(ROUNDS, parts - 1)
    ends = [0, 1, *(1 + (parts - 1) * (r + 1) // rounds for r in range(rounds))]
    for r, (low, high) in enumerate(zip(ends, ends[1:])):
        how = {"epochs": 1, "steps": 0, "batch": BATCH, "rate": RATE * (1 - (r - 1) / rounds)} if r else {}
        tasks = -(-(high - low) // PARTS_OF_TASK)
        dealt = texts.where(F.col("part").between(low, high - 1)).repartitionById(tasks, F.expr(f"cast((part - {low}) % {tasks} as int)")).sortWithinPartitions("part", "h")
        # the first part is fitted in one go, unless few texts hold most of it
        fitted = dealt.mapInArrow(_fitter(to_tasks(spark, network), windows if r else 4 * windows, how, network.windows > 0), "block int, n long, weights binary")
        blocks = sorted(fitted.groupBy("block").applyInArrow(_mean, "block int, n long, weights binary").collect())
        if blocks:
            seen = network.windows + blocks[0].n
            network.take(np.concatenate([np.frombuffer(x.weights, "<f4") for x in blocks])).windows = seen
    return network


def frequent_words(words: DataFrame, most: int):
    """The words that occur at least so often that there are at most `most` of them, as pandas: word, shape, n."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 8)
    steps = words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).orderBy(F.desc("level")).collect()
    least, total = None, 0
    for s in steps:  # a few hundred levels at most
        total += s.k
        if total > most:
            break
        least = s.least
    return words.where(F.lit(False) if least is None else F.col("n") >= least).select("word", "shape", "n").toPandas()


def known_words(words: DataFrame, head_words: int = HEAD_WORDS) -> Words:
    """What tasks are to know, from the counts of all words."""
    frequent = frequent_words(words, max(head_words, VOCABULARY - SHAPES))
    tops = frequent.sort_values(["n", "word"], ascending=[False, True])["n"].head(VOCABULARY - SHAPES)
    sums = {r["shape"]: (r["n"], r["k"]) for r in words.groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect()}
    of_shape, kinds = (np.array([sums.get(s, (0, 0))[i] for s in range(SHAPES)], np.int64) for i in (0, 1))
    total, chosen = int(of_shape.sum()), frequent.loc[tops.index]
    np.subtract.at(of_shape, chosen["shape"].to_numpy(np.int64), chosen["n"].to_numpy(np.int64))
    np.subtract.at(kinds, chosen["shape"].to_numpy(np.int64), 1)
    return Words(frequent, of_shape, kinds, total)


def train(rows: DataFrame, words: DataFrame, *, head_words: int = HEAD_WORDS, windows: int = PART_WINDOWS) -> tuple[Words, Network]:
    """The known words, from the counts of all words, and the network fitted on all windows of rows (doc_id, text)."""
    known = known_words(words, head_words)
    return known, fit_weights(encoded(rows, known), known.total, windows)


def _scorer(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = model()
        for b in batches:
            tokens = unpacked(b.column("tokens"))
            n = np.array([len(x) for x in tokens], np.int64)
            seq, at = padded(tokens)
            logp = network.log_p(np.stack([seq[at + k] for k in _CONTEXT], axis=1), seq[at])
            total = np.bincount(np.repeat(np.arange(len(n)), n), logp.astype(np.float64), len(n)) + b.column("inside").to_numpy()
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), b.column("n_tokens"), pa.array(total)], names=["row", "doc_id", "n_tokens", "total"])

    return score


def pseudo_likelihood(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", head_words: int = HEAD_WORDS, windows: int = PART_WINDOWS) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, pseudo_log_likelihood (the sum over all words), mean_log_likelihood.

    A word's probability is that of its token between its neighbours, times, for a word that is no token, its own within
    the shape: (n - 1 + ALPHA) / (N - 1 + ALPHA * distinct words), of counts over all of docs. Null and empty texts have
    no tokens, sum 0 and a null mean. Rows that repeat count, in the corpus, as often as they are there. Equal counts go
    to the smaller hash. An empty table gives an empty result; other columns are ignored.
    """
    rows = id_text(docs, id_col, text_col)
    words = vocabulary(rows)
    known = known_words(words, head_words)
    texts = encoded(rows, known)
    network = fit_weights(texts, known.total, windows)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = texts.select("row", "doc_id", "n_tokens", "inside", "tokens").mapInArrow(_scorer(to_tasks(docs.sparkSession, network)), f"row long, doc_id {kind}, n_tokens long, total double")
    scored = cut(scored)
    inside = F.log(F.col("n") - 1 + F.lit(ALPHA)) - F.get(F.array(*[F.lit(float(x)) for x in known.log_shape]), F.col("shape"))
    rare = texts.select("row", F.explode("rare").alias("word")).join(words.select("word", inside.alias("inside")), "word").groupBy("row").agg(F.sum("inside").alias("inside"))
    scored = scored.join(rare, "row", "left")
    scored = scored.select("doc_id", "n_tokens", (F.col("total") + F.coalesce("inside", F.lit(0.0))).alias("pseudo_log_likelihood"))
    return scored.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("pseudo_log_likelihood") / F.col("n_tokens")))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(read_table(spark, sf_dir, "documents"))
