"""Collocations, suffix arrays and removal of repeats against plain counting."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataforge.llm import collocations, suffix_array, suffix_dedup

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# --- 11 -------------------------------------------------------------------------------------------------------------


def brute_collocations(rows, min_count=10, top=2000):
    f = {}
    for lang, text in rows:
        counts = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            for s in (1, 2, 3):
                counts.update(tuple(w[i : i + s]) for i in range(len(w) - s + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        found = []
        for p, a in counts.items():
            if len(p) < 2 or a < min_count:
                continue
            if len(p) == 2 and any(len(q) == 3 and c >= min_count and p in (q[:2], q[1:]) and 100 * c >= 50 * a for q, c in counts.items()):
                continue
            score, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def clashing(df, *names):
    for name in names:
        df = df.withColumn(name, F.lit("clash"))
    return df


def mined(spark, rows, **options):
    df = clashing(spark.createDataFrame(rows, "lang string, text string"), "shard", "word", "k", "id", "n", "w1", "a", "f", "_part", "rank")
    return sorted(tuple(r) for r in collocations.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("shard_words,seed", [(40, 1), (500_000, 2), (7, 3)])
def test_collocations(spark, shard_words, seed):
    rnd = random.Random(seed)
    words = ["a", "B", "b", "é", "the", "x\x00", "x\x1fy", "of", "😀"]
    rows = [(rnd.choice(["en", "de", None, "und"]), "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t ", ". ", "\n", ","]) for _ in range(rnd.randint(0, 60)))) for _ in range(60)]
    rows += [("en", None), (None, ""), ("fr", " \t.,\n"), ("en", "the of " * 300), ("en", "the of " * 300), ("de", "a b " * 30)]
    want = brute_collocations(rows, min_count=5, top=30)
    assert mined(spark, rows, min_count=5, top=30, shard_words=shard_words) == want and len(want) > 50


@pytest.mark.parametrize("rows", [[], [("en", None)], [("en", "one two three")], [(None, "...")]])
def test_collocations_of_little(spark, rows):
    assert mined(spark, rows) == []


def test_one_word_in_all_shards(spark):
    """A word that is half of all words: its phrases are counted whole, runs of it with overlaps."""
    rows = [("en", "go go go go" if i % 3 == 0 else f"go w{i % 7} go") for i in range(900)]
    assert mined(spark, rows, shard_words=100) == brute_collocations(rows)


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**12, 10**12 + 7, 10**12 + 9), (3_000_000_000, 4_000_000_000, 5_000_000_000)], "a long, l long, r long")
    got = df.select("*", collocations._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in got)


def test_bitmaps_and_extension():
    """a b a a | a b: words 0 and 1 at places with one free place between the pieces, as bits of blocks of eight."""
    word, place = np.array([0, 0, 0, 0, 1, 1]), np.array([6, 8, 9, 11, 7, 12])
    shard = collocations.Shard(word, place, 2)
    assert list(zip(shard.word, shard.block, shard.bits)) == [(0, 0, 0b1000000), (0, 1, 0b1011), (1, 0, 0b10000000), (1, 1, 0b10000)]
    pairs = {(int(a), int(b)): int(n) for x in shard.phrases(None) for a, b, n in zip(*x)}
    assert pairs == {(0, 1): 2, (1, 0): 1, (0, 0): 1}
    triples = {tuple(map(int, t[:3])): int(t[3]) for x in shard.phrases(lambda a, b: np.ones(len(a), bool)) for t in zip(*x)}
    assert triples == {(0, 1, 0): 1, (1, 0, 0): 1}


# --- 12 -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("symbols", [1, 2, 4, 255])
def test_suffix_array(symbols):
    rnd = random.Random(symbols)
    for n in [0, 1, 2, 3, *range(5, 200, 13), 2000]:
        text = bytes(rnd.randint(0, symbols) for _ in range(n))
        order = suffix_array.suffix_array(np.frombuffer(text, np.uint8))
        assert order.tolist() == sorted(range(n), key=lambda i: text[i:])
        shared = suffix_array.common_prefixes(np.frombuffer(text, np.uint8), order)
        for a, b in zip(order[:-1], order[1:]):
            x, y = text[a:], text[b:]
            assert shared[b] == next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))


def brute_repeats(rows, size):
    """Rows (id, text) with ids that differ; a null id comes last."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - size + 1):
            w = raw[s : s + size]
            if w in seen:
                gone[s : s + size] = True
            seen.add(w)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out[i] = (len(raw), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def removed(spark, rows, **options):
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"), "h", "start", "n", "anchor", "ctx", "k", "spans", "_part", "first")
    return [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in suffix_dedup.remove_repeats(df, **options).collect()]


@pytest.mark.parametrize("hot,shard,seed", [(1000, 1_000_000, 1), (1, 200, 2), (2, 3000, 3)])
def test_repeats(spark, hot, shard, seed):
    rnd = random.Random(seed)
    phrases = ["".join(rnd.choice("abcé ") for _ in range(rnd.randint(5, 60))) for _ in range(12)]
    rows = [(i, "".join(rnd.choice(phrases) + rnd.choice(["", "x", "y\n"]) for _ in range(rnd.randint(0, 8)))) for i in rnd.sample(range(-50, 1000), 80)]
    rows += [(2000, None), (2001, ""), (2002, "short"), (None, phrases[0] * 3), (2003, "z" * 3000), (2004, "ab" * 700 + "\x00" * 50), (2005, "\x00" * 60)]
    got, want = removed(spark, rows, size=20, hot_contexts=hot, shard_bytes=shard), brute_repeats(rows, 20)
    assert len(got) == len(rows) and dict(got) == want and sum(v[1] for v in want.values()) > 1000


def test_repeats_in_repeated_rows(spark):
    """Rows of one id and text are one document; of two texts with an id one goes before the other."""
    rnd = random.Random(4)
    text = "".join(rnd.choice("abcdef ") for _ in range(300))
    got = removed(spark, [(1, text), (1, text), (2, text), (3, "other"), (3, text + "!")])
    assert sorted((i, v[1]) for i, v in got) == [(1, 0), (1, 0), (2, 300), (3, 0), (3, 300)]
    (first, second) = (v for i, v in removed(spark, [(1, text), (1, text + "?")]))
    assert {first[1], second[1]} == {0, 300}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, ""), (None, None)], [(1, "x" * 99), (2, "x" * 99)]])
def test_repeats_of_little(spark, rows):
    assert all(v[1:3] == (0, 0) for _, v in removed(spark, rows)) and len(removed(spark, rows)) == len(rows)


def test_long_text_in_parts(spark, monkeypatch):
    """A repeat over the end of a part is found as any other."""
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdefgh") for _ in range(1_100_000))
    rows = [(1, text), (2, "q" * 77 + text[400_000:600_000])]
    assert dict(removed(spark, rows)) == brute_repeats(rows, 100)


def test_passage_in_most_texts(spark):
    """The edges of a passage stand in as many contexts as there are texts: they are dealt by window."""
    rnd = random.Random(5)
    passage = "".join(rnd.choice("abcdefghij ") for _ in range(400))
    rows = [(i, "".join(rnd.choice("klmnop") for _ in range(150)) + passage + "".join(rnd.choice("klmnop") for _ in range(150))) for i in range(300)]
    got = dict(removed(spark, rows, hot_contexts=50))
    assert got == brute_repeats(rows, 100) and sum(v[1] >= 400 for v in got.values()) == 299
