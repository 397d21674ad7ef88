"""Quality classifier: Bradley-Terry ranking from preference pairs.

Every document gets the same short vector of text statistics (Arrow batches in tasks). From labelled documents, pairs
(good, bad) are preferences; the score w.x is learned from the logistic loss on x_good - x_bad. A quantile of the
learned scores, at the share of bad documents among the labelled ones, is the threshold; the score that is returned is
a logistic map of the distance to it, so that `CUT` stands exactly at the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_texts, id_text, read_table

#: Labelled documents that training takes, about, where there are more: an even share by a hash of id and text.
TRAIN_ROWS = 20_000
#: Preference pairs at most; with more combinations, seeded draws.
PAIRS = 200_000
#: The returned score at the threshold.
CUT = 0.3
FOLDS = 5

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
FEATURES = (
    "log_bytes", "log_words", "upper", "digit", "symbol", "bang", "stop", "comma", "non_ascii", "control", "word_len", "distinct",
    "distinct_pairs", "same_next", "dup_lines", "worst_upper", "worst_symbol", "worst_repeat", "doubled_marks", "line_len", "empty",
)


def _repeat(words: list[bytes]) -> float:
    return 1 - len(set(words)) / len(words)


def _shares(counts: np.ndarray) -> tuple[float, float]:
    letters = counts[65:91].sum() + counts[97:123].sum()
    return counts[65:91].sum() / max(1, letters), counts[_SYMBOLS].sum() / max(1, counts.sum())


def _starts(n: int, size: int) -> list[int]:
    """Starts of stretches that cover 0 to n, all of the same size but where n is less."""
    return sorted({max(0, min(i, n - size)) for i in range(0, n, size)})


def features(text: bytes) -> list[float]:
    """Statistics of one whole text; all 0 but `empty` where it has no word."""
    words = text.split()
    if not words:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    raw = np.frombuffer(text, np.uint8)
    c, n, k = np.bincount(raw, minlength=256), len(raw), len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper, symbol = _shares(c)
    # the worst stretch of a thousand bytes or a hundred words, so that junk inside a long clean text shows; the last one
    # ends with the text, a shorter text is one stretch
    parts = [_shares(np.bincount(raw[i : i + 1024], minlength=256)) for i in _starts(n, 1024)]
    chunks = [words[i : i + 100] for i in _starts(k, 100)]
    same = sum(map(bytes.__eq__, words, words[1:]))
    doubled = sum(text.count(x) for x in (b"!!", b"**", b"##", b"$$", b"%%", b"&&", b" | "))
    return [
        math.log1p(n), math.log1p(k), upper, c[48:58].sum() / n, math.log1p(100 * symbol), math.log1p(100 * c[33] / n), c[46] / k, c[44] / k, c[128:].sum() / n, c[:32].sum() / n,
        min(30.0, sum(map(len, words)) / k), len(set(words)) / k, len(set(zip(words, words[1:], strict=False))) / k, math.log1p(100 * same / k), 1 - len(set(lines)) / len(lines),
        max(p[0] for p in parts), math.log1p(100 * max(p[1] for p in parts)), max(map(_repeat, chunks)), math.log1p(100 * doubled / k), math.log1p(n / len(lines)), 0.0,
    ]


def _matrix(texts: Iterator[bytes]) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))


def fit(x: np.ndarray, good: np.ndarray, *, pairs: int = PAIRS, l2: float = 1e-3, seed: int = 7) -> dict:
    """Bradley-Terry weights by Newton steps on the pairwise logistic loss, then the threshold and the slope."""
    mean, spread = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    share = float(good.mean()) if len(good) else 1.0
    if not len(x) or good.all() or not good.any():  # nothing to prefer: everything gets the known share
        return {"mean": mean, "spread": spread, "w": np.zeros(len(mean)), "t": 0.0, "slope": 1.0, "shift": 5.0 if share else -5.0}
    z = (x - mean) / spread
    best, worst = np.flatnonzero(good), np.flatnonzero(~good)
    if len(best) * len(worst) <= pairs:
        i, j = (a.ravel() for a in np.meshgrid(best, worst))
    else:
        draw = np.random.default_rng(seed)
        i, j = draw.choice(best, pairs), draw.choice(worst, pairs)
    d, w = z[i] - z[j], np.zeros(z.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # chance that the preference is the wrong way round
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + l2 * np.eye(len(w)), d.T @ p / len(d) - l2 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    t = float(np.quantile(s, 1 - share))
    slopes = np.geomspace(0.05, 20, 40) / (s.std() + 1e-9)
    shift = math.log(CUT / (1 - CUT))
    loss = [np.logaddexp(0, np.where(good, -1, 1) * (a * (s - t) + shift)).mean() for a in slopes]
    return {"mean": mean, "spread": spread, "w": w, "t": t, "slope": float(slopes[int(np.argmin(loss))]), "shift": shift}


def _scores(model: dict, x: np.ndarray) -> np.ndarray:
    s = ((x - model["mean"]) / model["spread"]) @ model["w"]
    return 1 / (1 + np.exp(-np.clip(model["slope"] * (s - model["t"]) + model["shift"], -30, 30)))


def _scorer(model: dict):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(_scores(model, _matrix(binary_texts(b.column("text")))))], names=["doc_id", "score"])

    return score


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = _matrix(binary_texts(b.column("text")))
        ends = pa.array(np.arange(0, rows.size + 1, len(FEATURES), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([b.column("place"), b.column("quality"), pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))], names=["place", "quality", "x"])


def held_out(id_column) -> F.Column:
    """Rows that training never sees: crc32 of the id as text divisible by 5, and rows without an id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, *, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model from the labelled rows of docs that are not held out; only the texts of the share that is used are read
    whole and moved. Rows that repeat id, text and label count once."""
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    known = labels.select(F.col("doc_id").cast(kind).alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality is not null").where(~held_out(F.col("doc_id")))
    known = known.distinct()
    total = rows.select("doc_id").join(known, "doc_id").count()
    share = min(1.0, train_rows / max(1, total))
    place = F.xxhash64("doc_id", "text")
    picked = rows.withColumn("place", place).where(F.pmod(F.xxhash64("place"), F.lit(1_000_000)) < math.ceil(1_000_000 * share)).join(known, "doc_id")
    picked = picked.select("place", "quality", "text").dropDuplicates(["place", "quality"]).mapInArrow(_featurise, "place long, quality int, x array<double>")
    found = picked.toPandas().sort_values(["place", "quality"])
    return fit(np.array(found["x"].tolist(), float).reshape(-1, len(FEATURES)), found["quality"].to_numpy(int) == 1)


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    labels has doc_id and quality (1 good, 0 bad); null labels are ignored, an id with two labels counts with both, a
    label without a document counts not at all. The model sees text statistics only. A null text is as empty, and gets
    a score too. With labels of one kind or none, every score is the same. Training takes all labelled documents, or
    about `train_rows`, a fixed choice by hash, where there are more; the result has a row for every row of docs, none
    for an empty table. Rows that repeat get the same score; other columns are ignored.
    """
    rows = id_text(docs, id_col, text_col)
    model = train(docs, labels, train_rows=train_rows, id_col=id_col, text_col=text_col)
    scored = rows.mapInArrow(_scorer(model), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """docs, with all its columns, without the rows that the classifier rejects. Null and empty texts are judged as such,
    rows that repeat are judged alike; an empty table gives no rows."""
    id_text(docs)  # small Arrow batches
    model = train(docs, labels, **options)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series(_scores(model, _matrix((t or "").encode() for t in texts)) >= CUT)

    return docs.where(good(docs["text"].cast("string")))


def op2_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")
