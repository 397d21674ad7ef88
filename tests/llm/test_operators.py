"""Small and brute-force tests of the corpus operators."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm import decontaminate, jaccard_join, line_dedup, lm_score, native, pii, quality_rank, quality_rules, secret_scan, sentence_pieces, token_counts
from strataforge.llm.components import components
from strataforge.llm.queries import QUERIES, SQL

SCHEMA = "doc_id long, text string"
WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def docs(spark, rows):
    """Documents with columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "h", "n", "words", "lang", "cls", "label", "token", "_row", "spans", "n_words", "x"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def corpus(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "x" * 50_000), (7, "a b c d e f g h " * 4000), (None, "one two three"), (4, "one"), (8, "é" * 30 + " 😀 ﬁ\x00end")]


# --- 1 --------------------------------------------------------------------------------------------------------------


def windows_of(items, n=10):
    pattern, out = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), {}
    for item, text in items:
        w = pattern.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - n + 1) if w else 0):
            out.setdefault(tuple(w[i : i + n]), set()).add(item)
    return out


def brute_contamination(text, windows):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    hit, items = np.zeros(len(w), bool), set()
    for size in {len(k) for k in windows}:
        for i in range(len(w) - size + 1):
            if found := windows.get(tuple(w[i : i + size])):
                hit[i : i + size] = True
                items |= found
    return len(w), int(hit.sum()), sorted(map(str, items - {None}))


def test_contamination_small(spark):
    items = [(1, "A b, c!"), (2, "one two three four five six seven eight nine ten eleven"), (3, None), (4, " -- "), (20, "a B c"), (1, "A b, c!")]
    texts = [(1, "x a b c a b c y"), (2, "a b. C"), (3, "one two three four five six seven eight nine ten"), (4, "Two three four five six seven eight nine ten eleven!"), (5, None), (6, ""), (7, "a b"), (8, "a b c " * 3000), (1, "a b c"), (None, "a b c")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1))
    got = decontaminate.decontaminate(docs(spark, texts), bench).collect()
    windows = windows_of(items)
    want = Counter((i, *brute_contamination(t, windows)[:2], tuple(brute_contamination(t, windows)[2])) for i, t in texts)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want


def test_contamination_blocks_give_the_same(spark, data):
    d, b = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    one, many = (sorted(map(str, decontaminate.decontaminate(d, b, block_windows=k).collect())) for k in (100_000, 300))
    assert one == many


def test_contamination_query(spark, data):
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    windows, texts = windows_of(items), corpus(spark, data)
    for r in QUERIES["op1_decontaminate"](spark, data).collect():
        n, hit, ids = brute_contamination(texts[r.doc_id], windows)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()


def test_contamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.decontaminate(docs(spark, EDGE), none).collect()] == [0] * len(EDGE)
    assert decontaminate.decontaminate(docs(spark, []), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_keep_clean_keeps_columns(spark):
    d = docs(spark, [(1, "a b c"), (2, "a c b"), (None, None), (None, "a b c")])
    kept = decontaminate.keep_clean(d, spark.createDataFrame([(1, "a b c")], "item_id long, text string"))
    assert kept.columns == d.columns and sorted(r.text or "" for r in kept.collect()) == ["", "a c b"]


def test_every_list_counts(spark):
    """Intersecting the lists of the rarest words alone finds what is no match; with each list more it finds less."""
    window = "a b c d e f g h i j"
    items = spark.createDataFrame([(1, window)], "item_id long, text string")
    texts = [(0, window)] + [(k, " ".join("x" if i >= k else w for i, w in enumerate(window.split()))) for k in range(1, 10)]
    texts.append((99, " x ".join(f"{w} x " * (100 * (i + 1)) for i, w in enumerate(window.split()))))  # a is the rarest, then b
    hits = [decontaminate.matches(docs(spark, texts), items, lists=k)[1].count() for k in range(1, 11)]
    assert hits == [110, *range(9, 0, -1)], hits


def brute_near(text, windows, slop):
    """Items whose windows have all words, as often, in some stretch of their size and slop."""
    w, items = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER)), set()
    for key, of in windows.items():
        if any(not Counter(key) - Counter(w[max(0, i) : i + len(key) + slop]) for i in range(-len(key) - slop, len(w))):
            items |= of
    return sorted(map(str, items - {None}))


def test_proximity(spark):
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    d = docs(spark, [(1, "blue x red y green"), (2, "red a b c d e f g h i j k l m n green blue"), (3, "red green")])
    assert decontaminate.proximity_matches(d, items, slop=0).count() == 0
    got = decontaminate.proximity_matches(d, items, slop=2).collect()
    assert [(r.doc_id, r.start, r.span) for r in got] == [(1, 0, 5)]
    assert decontaminate.proximity_matches(d, items.limit(0)).count() == decontaminate.proximity_matches(docs(spark, []), items).count() == 0


def test_proximity_against_brute_force(spark):
    draw = random.Random(12)
    word = lambda: draw.choice("abcdefghijklmnop")
    items = [(i, " ".join(word() for _ in range(draw.choice((2, 5, 10, 13))))) for i in range(30)] + [(90, None), (91, ""), (None, "a b c")]
    rows = [(i, " ".join(word() for _ in range(draw.randrange(40)))) for i in range(60)] + [(70, None), (71, ""), (72, " ".join("abcdefghijklmnop") * 200), (70, "a b c")]
    for i in range(60, 70):  # a word inserted, removed or moved
        w = items[i % 30][1].split()
        w.insert(draw.randrange(len(w)), "zz")
        draw.shuffle(w)
        rows.append((200 + i, " ".join(w)))
    bench, windows = spark.createDataFrame(items, "item_id long, text string"), windows_of(items)
    for slop, block in ((5, 100_000), (2, 20)):
        got = Counter((r.doc_id, tuple(r.near_items)) for r in decontaminate.decontaminate(docs(spark, rows), bench, slop=slop, block_windows=block).collect())
        assert got == Counter((i, tuple(brute_near(t, windows, slop))) for i, t in rows)
        found = {(r.doc_id, r.item_id) for r in decontaminate.proximity_matches(docs(spark, rows), bench, slop=slop, block_windows=block).collect()}
        assert {x for x in found if x[1] is not None} == {(i, int(k)) for (i, near), _ in got.items() for k in near}


# --- 2 --------------------------------------------------------------------------------------------------------------


def test_quality_query(spark, data):
    got = {r.doc_id: r for r in QUERIES["op2_quality_rank"](spark, data.replace("sf0.001", "sf0.01")).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data.replace('sf0.001', 'sf0.01')}/labels.parquet").collect()}
    unseen = [(labels[i], r.predicted) for i, r in got.items() if i in labels and r.held_out]
    assert np.mean([a == b for a, b in unseen]) > 0.95


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame([(4, 1), (5, None), (99, 0), (None, 0)], "doc_id long, quality int")
    got = quality_rank.quality_scores(docs(spark, EDGE), labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got) and all(r.held_out for r in got if r.doc_id is None)
    assert quality_rank.quality_scores(docs(spark, []), labels).count() == 0


def test_ranking_learns_preferences():
    x = np.random.default_rng(0).normal(size=(400, len(quality_rank.FEATURES)))
    good = x[:, 3] - x[:, 5] > -0.5
    model = quality_rank.fit(x, good)
    assert ((quality_rank._scores(model, x) >= quality_rank.CUT) == good).mean() > 0.95
    assert 0 < quality_rank._scores(quality_rank.fit(x, good | True), x).min() and len(quality_rank._scores(quality_rank.fit(x[:0], good[:0]), x)) == 400


def test_ranking_equals_plain_descent():
    """Bradley-Terry weights against a plain descent over every pair, written apart."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(60, len(quality_rank.FEATURES)))
    x[:, 6:] = 0
    good = x[:, 0] + 0.5 * x[:, 1] + draw.normal(size=60) > 0
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    pairs, w = [z[i] - z[j] for i in range(60) for j in range(60) if good[i] and not good[j]], np.zeros(z.shape[1])
    d = np.array(pairs)
    for _ in range(20_000):
        w -= 0.5 * (-(d / (1 + np.exp(d @ w))[:, None]).mean(0) + 1e-3 * w)
    model = quality_rank.fit(x, good)
    assert np.allclose(model["w"], w, atol=1e-3)
    s = z @ w
    assert model["t"] == pytest.approx(np.quantile(s, 1 - good.mean()), abs=1e-2)
    scores = quality_rank._scores(model, x)
    assert ((scores >= quality_rank.CUT) == (s >= np.quantile(s, 1 - good.mean()))).all() and (np.argsort(scores) == np.argsort(s)).all()


def test_training_on_a_share(spark):
    """More labelled rows than training takes: an even share of them; copies of a row count once; filters keep columns."""
    rows = [(i, "fine words of a plain text, one more sentence here. " * 3 if i % 2 else "BUY !!! $$$ ### NOW " * 9) for i in range(600)] + [(1, "fine words")] * 300
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    d = docs(spark, rows)
    for n in (50, 10_000):
        got = {r.doc_id: r.predicted for r in quality_rank.quality_scores(d, labels, train_rows=n).collect() if r.doc_id != 1}
        assert all(p == i % 2 for i, p in got.items())
    kept = quality_rank.keep_good(d.unionByName(docs(spark, [(None, None), (7000, "")])), labels)
    assert kept.columns == d.columns and {r.doc_id % 2 for r in kept.where("doc_id < 600").collect()} == {1}
    assert quality_rank.keep_good(docs(spark, []), labels).count() == 0


@pytest.mark.parametrize("n", [1, 255, 1023, 1024, 1025, 1500, 2048, 2049, 2100, 5000])
def test_worst_stretch_reaches_the_end(n):
    """Junk counts the same at the end of a text as at its start, whatever the length; every byte and word is looked at."""
    clean, junk = "word " * (n // 5 + 1), "#$% " * 60
    names = dict(zip(quality_rank.FEATURES, range(100)))
    first, last = (quality_rank.features(t.encode()) for t in (junk + clean[:n], clean[:n] + junk))
    assert last[names["worst_symbol"]] > 2 and abs(first[names["worst_symbol"]] - last[names["worst_symbol"]]) < 1.2
    assert first[names["worst_repeat"]] > 0.5 and last[names["worst_repeat"]] > 0.5
    for size in (100, 1024):
        starts = quality_rank._starts(n, size)
        assert starts[0] == 0 and max(starts) + size >= n and all(b - a <= size for a, b in zip(starts, starts[1:])) and all(s + size <= max(n, size) for s in starts)


# --- 3 --------------------------------------------------------------------------------------------------------------


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_lines(rows, least):
    order = sorted({(i is None, i or 0, i, t) for i, t in rows if t is not None}, key=lambda x: x[:2])
    earlier, out = [], {}
    for _, _, i, text in order:
        gone = []
        for k, line in enumerate(text.split("\n")):
            x = line.strip(" \t\r\x0b\x0c")
            if x:
                if any(x == y or min(len(x), len(y)) >= least and abs(len(x) - len(y)) < 2 and edits(x, y) < 2 for y in earlier):
                    gone.append(k)
                earlier.append(x)
        out[i, text] = gone
    return out


def test_lines_against_brute_force(spark):
    draw = random.Random(4)
    base = ["".join(draw.choice("abcé ") for _ in range(n)).strip() + "zz" for n in (8, 9, 20, 41, 60)]

    def changed(s):
        p = draw.randrange(len(s))
        return draw.choice([s, s[:p] + s[p + 1 :], s[:p] + "q" + s[p:], s[:p] + "q" + s[p + 1 :], s[:p] + s[p + 2 :], "q" + s[1:-1] + "w"])

    rows = [(i, "\n".join(draw.choice(["", " "]) + changed(draw.choice(base)) for _ in range(6))) for i in range(25)] + [(None, base[2]), (30, None), (31, ""), (3, "\n")]
    want = brute_lines(rows, 6)
    for r in line_dedup.dedup_lines(docs(spark, rows), near_chars=6).collect():
        text = next(t for i, t in rows if i == r._row.doc_id and (t is None or len(t.split("\n")) == r.n_lines)) if r._row.doc_id != 3 else None
        if text is not None:
            gone = want[r._row.doc_id, text]
            assert r.n_dropped == len(gone) and r._text == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)


def test_repeated_rows_and_edges_of_lines(spark):
    line = "the same long line in every document"
    rows = [(2, f"{line}\nown"), (1, line), (1, line), (3, line[:-1]), (4, None), (5, ""), (6, "x" * 60_000), (7, "x" * 59_999)]
    got = sorted((r._row.doc_id, None if r._text is None else len(r._text), r.n_dropped) for r in line_dedup.dedup_lines(docs(spark, rows)).collect())
    assert got == [(1, len(line), 0), (1, len(line), 0), (2, 3, 1), (3, 0, 1), (4, None, 0), (5, 0, 0), (6, 60_000, 0), (7, 0, 1)]
    short = [(1, "Read more\nown text"), (2, "Read more\n \nRead morE\n1."), (3, "Read more"), (4, "2.\n1.\n\n")]
    assert sorted((r._row.doc_id, r._text) for r in line_dedup.dedup_lines(docs(spark, short)).collect()) == [(1, "Read more\nown text"), (2, " \nRead morE\n1."), (3, ""), (4, "2.\n\n")]
    kept = line_dedup.drop_lines(docs(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 2, 4, 5, 6] and kept.columns == docs(spark, rows).columns
    assert line_dedup.drop_lines(docs(spark, [])).count() == 0


def test_hot_lines(spark):
    """A line that most documents share, and lines that differ in one place: dealt over tasks, nothing lost."""
    rows = [(i, f"the line that every document here has\nline number {i:05d} of the list of all of them") for i in range(700)]
    got = {r._row.doc_id: r.n_dropped for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    # an earlier number one digit away: all but 0
    assert got == {i: int(i > 0) + int(i > 0) for i in range(700)}


# --- 4 --------------------------------------------------------------------------------------------------------------


def brute_rules(text):
    words, seen, dup = WORDS.findall(text or ""), set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, hit = Counter(windows), [False] * len(words)
    for i, w in enumerate(windows):
        if counts[w] > 1:
            hit[i : i + 8] = [True] * 8
    n, repeat = len(words), sum(hit)
    return n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, repeat, n < 20 or 100 * repeat > 30 * n


def test_rules(spark, data):
    rows = EDGE + [(20, "a b c d e f g h i " * 2 + "# $ & a"), (21, "x\nx\n\n\ny\nx"), (22, "w " * 9), (23, "w " * 8)] + list(corpus(spark, data).items())
    got = quality_rules.quality_rules(docs(spark, rows)).collect()
    fields = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    assert Counter((r.doc_id, *fields(r)) for r in got) == Counter((i, *brute_rules(t)) for i, t in rows)
    assert all(r.kept == (r.failed_rule is None) and not (r.base_failed and r.kept) for r in got)
    assert quality_rules.quality_rules(docs(spark, [])).count() == 0


def test_few_words_at_every_length(spark):
    draw = random.Random(8)
    spam = lambda n: " ".join(f"word{draw.randrange(300)}" for _ in range(n))
    prose = lambda n: " ".join(f"word{draw.randrange(5000)}" for _ in range(n))
    rows = [(n, spam(n)) for n in (5000, 5001, 9999, 10_000, 12_345)] + [(-n, prose(n)) for n in (5000, 5001, 12_345)]
    rule = next(r for r in quality_rules.default_rules() if r.name == "few_words")
    got = {r.doc_id: (r.base_failed, r.v) for r in quality_rules.with_base(docs(spark, rows)).select("doc_id", "base_failed", rule.fails.alias("v")).collect()}
    assert got == {i: (False, i > 0) for i, _ in rows}


def test_cascade_order(spark):
    rows = quality_rules.with_base(docs(spark, [(i, "word " * 30 + "# " * i) for i in range(20)]))
    rules = [quality_rules.Rule("never", F.lit(False)), quality_rules.Rule("often", F.col("n_symbols") > 3)]
    ordered = quality_rules.rule_order(rows, rules)
    assert [r.name for r, _, _ in ordered] == ["often", "never"] and ordered[0][1] == 0.8
    slow = quality_rules.Rule("slow", F.aggregate(F.sequence(F.lit(1), F.lit(30_000) + F.col("n_symbols").cast("int")), F.lit(0), lambda a, x: (a + x) % 7) >= 0)
    assert [r.name for r, _, _ in quality_rules.rule_order(rows, [slow, rules[1]])] == ["often", "slow"]  # rejects less, costs far less
    both = [quality_rules.cascade([r for r, _, _ in o]).alias("v") for o in (ordered, ordered[::-1])]
    assert rows.select(both[0]).collect() == rows.select(both[1]).collect()


# --- 5 --------------------------------------------------------------------------------------------------------------


def test_token_counts(spark, data):
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sizes = sorted(len(encoding.encode_ordinary(t or "")) for t in corpus(spark, data).values())
    got = QUERIES["op5_token_counts"](spark, data).cache()
    rows = {r.n_tokens: r for r in got.collect()}
    assert set(rows) == set(sizes)
    for n, r in rows.items():
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least, r.docs_at_most) == (sizes.count(n), sum(s >= n for s in sizes), sum(s for s in sizes if s >= n), sum(s <= n for s in sizes))
        assert (r.total_docs, r.total_tokens, r.truncated_tokens) == (len(sizes), sum(sizes), sum(min(s, n) for s in sizes))
    for limit in (0, 7, 500, 10**6):
        assert tuple(token_counts.at_limit(got, limit).first()) == (limit, sum(s > limit for s in sizes), sum(min(s, limit) for s in sizes))
    assert token_counts.quantile(got, 0.5).first().n_tokens == sizes[(len(sizes) + 1) // 2 - 1]


def test_token_counts_edges(spark):
    rows = {r.n_tokens: r.n_docs for r in token_counts.length_histogram(token_counts.token_lengths(docs(spark, EDGE))).collect()}
    assert sum(rows.values()) == len(EDGE) and rows[0] == 2
    assert token_counts.length_histogram(token_counts.token_lengths(docs(spark, []))).count() == 0


# --- 6 --------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_model())


def test_pieces(spark, data, library):
    texts = [(i, t or "") for i, t in [*EDGE, *corpus(spark, data).items()]]
    for r in sentence_pieces.encode(docs(spark, texts)).collect():
        text = next(t for i, t in texts if i == r.doc_id) if r.doc_id != 1 or r.decoded == "" else None
        if text is None or r.doc_id in {i for i, _ in EDGE}:
            continue
        assert list(r.ids) == library.encode(text) and r.decoded == library.decode(list(r.ids))


def test_piece_edges(spark, library):
    got = sentence_pieces.encode(docs(spark, EDGE))
    want = Counter((i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in EDGE)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got.collect()) == want
    assert {(r.doc_id, r.text) for r in sentence_pieces.decode(got).collect()} == {(i, d) for i, _, d in want}
    assert sentence_pieces.encode_digests(docs(spark, [])).count() == 0


def test_digests(spark, library):
    for r in sentence_pieces.encode_digests(docs(spark, EDGE[:8])).collect():
        text = dict(EDGE[:8])[r.doc_id] or ""
        ids = library.encode(text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest() and r.span_bytes == len(text.encode())


def test_spans_cover_the_original(library):
    model = open(sentence_pieces.default_model(), "rb").read()
    own = sentence_pieces.Encoder(model, sentence_pieces.piece_sizes(model))
    for text in ("Hello  world ", " é😀\n\tx", "a", "▁ b"):
        raw = text.encode()
        ids = np.array(library.encode(text))
        spans = own.spans(raw, ids)
        assert spans[0, 0] == 0 and spans[-1, 1] == len(raw) and (spans[1:, 0] == spans[:-1, 1]).all()
        for i, (s, e) in zip(ids.tolist(), spans, strict=True):
            piece = library.id_to_piece(i)
            if not library.is_byte(i):
                assert piece.replace("▁", " ").encode()[-(e - s) or 99 :] == raw[s:e].replace("▁".encode(), b" ")[-(e - s) or 99 :] or "▁" in text


def trie(entries):
    """A compiled character map in the public double-array layout, for tests."""
    units, strings = [0] * 4096, b""
    values = {}
    for key, value in entries.items():
        values[key] = len(strings)
        strings += value + b"\0"
    free = [256]

    def build(node, keys):
        base = free[0]
        free[0] += 256
        offset = node ^ base
        units[node] = units[node] & 0x800003FF | offset << 10 | (1 << 8 if b"" in keys else 0)
        if b"" in keys:
            units[base] = keys[b""] | 1 << 31
        for first in sorted({k[0] for k in keys if k}):
            child = base ^ first
            units[child] = first
            build(child, {k[1:]: v for k, v in keys.items() if k and k[0] == first})

    build(0, values)
    import struct

    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + strings


def test_longest_prefix_and_alignment():
    blob = trie({"ﬁ".encode(): b"fi", b"a": b"A", b"ab": b"XYZ", b"\t": b" "})
    found = sentence_pieces.CharacterMap(blob)
    assert found.longest(b"abc", 0) == (2, b"XYZ") and found.longest(b"acb", 0) == (1, b"A") and found.longest(b"zab", 0) is None
    normal = sentence_pieces.Normaliser(b"")
    normal.map, normal.strip = found, True
    out, source = normal("  abﬁ\t c ".encode())
    assert out.decode() == "▁XYZfi▁c"
    assert source.tolist() == [0, 0, 0, 2, 2, 2, 4, 4, 7, 7, 7, 9, 10]


# --- 7 --------------------------------------------------------------------------------------------------------------


def test_pseudo_likelihood(spark):
    rows = [(i, "the cat sat on the mat and the dog ran " * 5) for i in range(30)] + [(100, "mat the the on dog and ran sat cat the " * 5), (101, None), (102, ""), (None, "the cat")]
    got = {r.doc_id: r for r in lm_score.pseudo_likelihood(docs(spark, rows)).collect()}
    assert got[0].mean_log_likelihood > got[100].mean_log_likelihood
    assert got[101].n_tokens == got[102].n_tokens == 0 and got[101].mean_log_likelihood is None and got[101].pseudo_log_likelihood == 0
    assert got[0].n_tokens == 50 and got[0].pseudo_log_likelihood == pytest.approx(50 * got[0].mean_log_likelihood)
    assert lm_score.pseudo_likelihood(docs(spark, [])).count() == 0


def test_network_learns_contexts():
    draw = np.random.default_rng(1)
    context = draw.integers(64, 80, (3000, 4)).astype(np.int32)
    token = 200 + 3 * (context[:, 1] - 64) + (context[:, 2] > 71)  # told by the two nearest neighbours
    net = lm_score.Network().fit(context, token, np.ones(3000), epochs=20)
    assert net.log_p(context, token).mean() > -0.5
    every = np.arange(lm_score.VOCABULARY)
    assert np.exp(net.log_p(np.repeat(context[:1], len(every), 0), every)).sum() == pytest.approx(1, abs=1e-4)


def brute_likelihood(text, known, network, counts):
    """Sum of the log-probabilities of all words, one by one, from weights and counts."""
    hasher = lm_score.Hasher()
    words = [w.encode() for w in WORDS.findall(text or "")]
    pairs = [[x[0] for x in lm_score.words_and_shapes(w, hasher)] for w in words]
    token_of = dict(zip(known.word.tolist(), known.token.tolist(), strict=True))
    tokens = [token_of.get(int(h), int(s)) for h, s in pairs]
    around, p, total = [lm_score.VOCABULARY] * 2 + tokens + [lm_score.VOCABULARY] * 2, network.p, 0.0
    for i, (word, t) in enumerate(zip(words, tokens, strict=True)):
        h = np.tanh(sum(p["in"][k][around[i + j]] for k, j in enumerate((0, 1, 3, 4))) + p["hidden"])
        z, m = h @ p["cluster"] + p["cluster_bias"], h @ p["member"][t // 64] + p["member_bias"][t // 64]
        total += float(z[t // 64] - np.log(np.exp(z).sum()) + m[t % 64] - np.log(np.exp(m).sum()))
        if t < 64:
            n_shape, k_shape = (sum(f(n) for w, (s, n, own) in counts.items() if s == t and not own) for f in (lambda n: n, lambda n: 1))
            total += float(np.log(counts[word][1] - 0.5) - np.log(n_shape - 1 + 0.5 * k_shape))
    return total


def test_likelihood_query(spark, data):
    """The query's sums against the brute-force sums of some texts."""
    from strataforge.llm.common import id_text

    texts = corpus(spark, data)
    rows = id_text(spark.read.parquet(f"{data}/documents.parquet"))
    known, network = lm_score.train(rows, lm_score.vocabulary(rows))
    hasher, seen = lm_score.Hasher(), Counter(w.encode() for t in texts.values() for w in WORDS.findall(t or ""))
    ranked = sorted(seen, key=lambda w: (-seen[w], int(lm_score.words_and_shapes(w, hasher)[0][0])))
    tops = set(ranked[: lm_score.VOCABULARY - lm_score.SHAPES])
    counts = {w: (int(lm_score.words_and_shapes(w, hasher)[1][0]), n, w in tops) for w, n in seen.items()}
    got = {r.doc_id: r for r in QUERIES["op7_lm_score"](spark, data).collect()}
    assert set(got) == set(texts) and all(got[i].n_tokens == len(WORDS.findall(t or "")) for i, t in texts.items())
    some = sorted(texts, key=lambda i: (len(texts[i] or ""), i))[: len(texts) // 4 : 5]
    for i in some:
        assert got[i].pseudo_log_likelihood == pytest.approx(brute_likelihood(texts[i], known, network, counts), rel=1e-3, abs=1e-2)


def test_every_word_is_predicted(spark):
    """Words outside the tokens, of one shape and beside the same words, score by their own counts; the table of words
    holds all of them."""
    hasher, shapes = lm_score.Hasher(), {}
    for i in range(1000):
        word = "zq" + "".join(chr(97 + i // 26**k % 26) for k in range(4))
        shapes.setdefault(int(lm_score.words_and_shapes(word.encode(), hasher)[1][0]), []).append(word)
    known, odd = max(shapes.values(), key=len)[:2]
    common = [f"w{i}" for i in range(lm_score.VOCABULARY)]
    rows = [(i, " ".join(common)) for i in range(10)] + [(100 + i, f"w1 {known} w2") for i in range(8)] + [(200, f"w1 {odd} w2"), (201, None)]
    for head in (0, lm_score.HEAD_WORDS):
        got = {r.doc_id: r.pseudo_log_likelihood for r in lm_score.pseudo_likelihood(docs(spark, rows), head_words=head, windows=2000).collect()}
        assert got[100] - got[200] == pytest.approx(np.log(7.5 / 0.5), abs=1e-4) and got[201] == 0
    count = lm_score.vocabulary(docs(spark, rows)).agg(F.count("n"), F.sum("n")).first()
    assert tuple(count) == (len(common) + 2, 10 * len(common) + 9 * 3)


def test_network_is_fitted_on_all_windows(spark):
    """Of a corpus of many parts every window is fitted: no token that occurs keeps its random weights. How texts are
    partitioned does not matter."""
    from strataforge.llm.common import id_text

    texts = [(i, " ".join(f"{chr(97 + j % 26)}{j}" for j in range(40 * i, 40 * i + 40))) for i in range(90)]
    fitted = []
    for n in (1, 7):
        rows = id_text(docs(spark, texts)).repartition(n)
        known, network = lm_score.train(rows, lm_score.vocabulary(rows), windows=100)
        fitted.append(network)
    assert set(lm_score.SHAPES + np.arange(3600)) == set(known.token.tolist())
    moved = (network.p["in"] != lm_score.Network().p["in"]).any(axis=2)
    assert moved[:, known.token].any(axis=0).all() and network.windows == known.total == 3600
    assert all(np.allclose(fitted[0].p[k], fitted[1].p[k], atol=1e-4) for k in network.p)


def test_distinct_windows():
    texts = [np.array(x, np.int32) for x in ([5, 4095, 5], [], [0], [5, 4095, 5])]
    context, token, n = lm_score.distinct_windows(texts)
    e = lm_score.VOCABULARY
    want = {(e, e, 4095, 5, 5): 2, (e, 5, 5, e, 4095): 2, (5, 4095, e, e, 5): 2, (e, e, e, e, 0): 1}
    assert {(*map(int, c), int(t)): int(k) for c, t, k in zip(context, token, n, strict=True)} == want


def test_network_with_large_weights():
    """Logits beyond the range of exponentials give finite log-probabilities, and a fit goes on from them."""
    net = lm_score.Network()
    net.p["cluster_bias"][3], net.p["member_bias"][:, 1] = 200, -300
    context, token = np.full((4, 4), lm_score.VOCABULARY, np.int32), np.array([0, 1, 200, 193])
    assert net.log_p(context, token)[[0, 2]] == pytest.approx([-200 - np.log(63), -np.log(63)], abs=1.0)
    assert np.isfinite(net.log_p(context, token)).all()
    net.fit(context, token, np.ones(4), resume=True, steps=3, epochs=1)
    assert all(np.isfinite(x).all() for x in net.p.values())


# --- 8 --------------------------------------------------------------------------------------------------------------


def brute_pii(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        return sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c) for i, c in enumerate(reversed(s))) % 10 == 0

    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    )
    return [[m.span() for m in re.finditer(p, text) if ok(m[0])] for p, ok in kinds]


def noise(draw, alphabet, n=60):
    return "".join(draw.choice(alphabet) for _ in range(draw.randrange(n)))


def test_personal_data(spark, data):
    draw = random.Random(1)
    rows = EDGE + [(100 + i, noise(draw, "a.@-+ 1é😀_%")) for i in range(400)] + [(600 + i, noise(draw, "0123456789 .-+()", 80)) for i in range(400)]
    rows += [(1100, "é😀 a@b.c_x@d.e 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 4111 1111-1111 1111 +1 (168) 555-5254 ."), (1101, "1" * 20_000), (1102, "1 " * 20_000), (1103, "a" * 20_000 + "@")]
    for r in pii.personal_spans(docs(spark, rows)).collect():
        text = next((t for i, t in rows if i == r.doc_id), None) or ""
        assert [[(x.start, x.end) for x in r.found if x.kind == k] for k in range(4)] == brute_pii(text), text


def test_personal_query(spark, data):
    texts = corpus(spark, data)
    for r in QUERIES["op8_pii"](spark, data).collect():
        found = brute_pii(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, spans in zip(pii.KINDS, found, strict=False) for a, b in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == list(map(len, found)) and r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_disclosing_terms(spark):
    rows = [(i, f"note {i} mail zorblax to kim@example.org please") for i in range(4)] + [(10 + i, f"please note plain text {i} to mail") for i in range(40)] + [(90, "please zorblax"), (91, None)]
    certain = rows[:-2]
    got = {r.doc_id: r for r in pii.personal_spans(docs(spark, certain)).collect()}
    assert [(x.start, x.end, x.certain) for x in got[0].terms] == [(12, 19, True)] and not got[10].terms
    clean = {r.doc_id: r.text for r in pii.sanitise(docs(spark, certain)).collect()}
    assert clean[0] == "note 0 mail  to [email] please" and clean[10] == rows[4][1]
    loose = {r.doc_id: r.text for r in pii.sanitise(docs(spark, rows), share=0.8).collect()}
    assert loose[0] == "note 0 mail [term] to [email] please" and loose[90] == "please [term]" and loose[91] == ""


def test_terms_anywhere_in_the_text(spark):
    far = "so it is " * 20
    rows = [(i, f"zorblax {i} {far} kim@example.org {far} Zorblax") for i in range(4)] + [(10 + i, f"plain text {i} {far}") for i in range(40)] + [(None, None), (80, "")]
    got = {r.doc_id: r for r in pii.personal_spans(docs(spark, rows)).collect()}
    for i in range(4):
        assert [(rows[i][1][x.start : x.end], x.certain) for x in got[i].terms] == [("zorblax", True), ("Zorblax", True)]
    assert not got[10].terms
    clean = {r.doc_id: r.text for r in pii.sanitise(docs(spark, rows)).collect()}
    assert clean[0] == f" 0 {far} [email] {far} "


def test_terms_without_their_entity(spark):
    """A term that tells an entity is generalised where the entity is not named; extra columns and repeats change nothing."""
    rows = [(i, f"ask zorblax at kim@example.org for {i}") for i in range(8)] + [(50, "ask zorblax for it")] + [(100 + i, f"ask at desk for {i}") for i in range(60)]
    got = {r.doc_id: r.text for r in pii.sanitise(docs(spark, rows + rows[:3])).collect()}
    assert got[50] == "ask [term] for it" and got[0] == "ask [term] at [email] for 0" and got[100] == "ask at desk for 0"
    assert pii.personal_spans(docs(spark, [])).count() == 0


# --- 9 --------------------------------------------------------------------------------------------------------------


def brute_components(rows, k, percent):
    sets, parent = [], list(range(len(rows)))
    for _, t in rows:
        w = WORDS.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def test_components_of_near_copies(spark):
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[draw.choice(vocabulary) for _ in range(n)] for n in (5, 30, 60, 90)]
    rows = list(EDGE)
    for i in range(120):
        words = list(draw.choice(base))
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        rows.append((1000 - i, " ".join(words).upper() if i % 7 == 0 else " ".join(words)))
    got = jaccard_join.jaccard_classes(docs(spark, rows), words=4, percent=85)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == Counter(brute_components(rows, 4, 85))


def test_jaccard_query_and_keep_one(spark, data):
    texts = list(corpus(spark, data).items())
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op9_jaccard_join"](spark, data).collect()}
    assert got == set(brute_components(texts, 4, 85))
    rows = [(3, "a b c d e f g"), (1, "A b c d e f g"), (2, None), (5, ""), (1, "A b c d e f g"), (None, "a b c d e f g"), (9, "other words in this one here")]
    kept = jaccard_join.keep_one(docs(spark, rows))
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, "A b c d e f g"), (2, ""), (5, ""), (9, "other words in this one here")] and kept.columns == docs(spark, rows).columns
    assert jaccard_join.keep_one(docs(spark, [])).count() == 0
    for more in ([], [(1, "A b c d e f g")]):  # rows without words stay, however often, whatever else repeats
        kept = jaccard_join.keep_one(docs(spark, [(5, ""), (5, ""), (6, None), (6, None), (1, "A b c d e f g"), *more]))
        assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, "A b c d e f g"), (5, ""), (5, ""), (6, ""), (6, "")]


def test_pairs_against_brute_force(spark):
    draw = random.Random(12)
    n, label = [draw.randrange(1, 60) for _ in range(90)], [draw.choice((1, 1, 1, 2, 3, 4)) for _ in range(90)]
    rows = [(token, c, n[c], draw.randrange(jaccard_join.prefix_size(n[c], 80))) for token in range(6) for c in range(90) if draw.random() < 0.5]
    rows += [(9, c, n[c], 0) for c in range(90) if label[c] == 1]  # a token of one label alone
    member = jaccard_join._mixed(spark.createDataFrame(rows * 2, "token long, cls long, n int, place int"), spark.createDataFrame(list(enumerate(label)), "cls long, label long"))
    assert member.where("token = 9").count() == 0 and member.count() == len(rows) - label.count(1)
    assert {r.label for r in member.where("usual").collect()} == {1}
    want = set()
    for t, a, x, p in rows:
        for u, b, y, q in rows:
            if t == u and a < b and label[a] != label[b] and 100 * min(x, y) >= 80 * max(x, y) and 180 * min(x - p, y - q) >= 80 * (x + y):
                want.add((a, b, *sorted((label[a], label[b]))))
    got = [(r.a, r.b, *sorted((r.a_label, r.b_label))) for r in jaccard_join._pairs(member, 80).collect()]
    assert len(got) == len(want) and set(got) == want


def test_group_with_a_stranger(spark):
    """A large group of near copies and a few texts beside it: their links are found, as brute force does."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words, f"own{i}"])) for i in range(1, 150)]
    rows += [(200 + k, " ".join([*words[: 60 - 2 * k], *(f"x{k}_{j}" for j in range(2 * k))])) for k in range(12)]
    got = jaccard_join.jaccard_classes(docs(spark, rows), words=4, percent=85)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()} == set(brute_components(rows, 4, 85))


@pytest.mark.parametrize("per_task", [50_000, 10])
def test_connected_components(spark, monkeypatch, per_task):
    monkeypatch.setattr("strataforge.llm.components.TASK_LINKS", per_task)
    draw = random.Random(3)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)] + [(7, 7)]
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_histogram_never_underestimates():
    draw = np.random.default_rng(5)
    for n, m in ((10, 10), (300, 260), (5000, 4300)):
        a = np.unique(draw.integers(0, 2**63, n, np.uint64))
        b = np.unique(np.concatenate([a[: m // 2], draw.integers(0, 2**63, m // 2, np.uint64)]))
        assert jaccard_join.most_common(jaccard_join.histogram(a), jaccard_join.histogram(b), n) >= len(np.intersect1d(a, b))


# --- 10 -------------------------------------------------------------------------------------------------------------


def brute_secrets(text):
    assign = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_secrets(spark, data):
    draw = random.Random(6)
    parts = ["token", "Secret", "api_key", "APIKEY", "passwd", "=", ": ", "'", "abcdef", "0123456789", "AKIA", "ABCDEF0123", " ", "é😀", "zzzzzz", "=abc=", "\n", "a1b2c3d4e5f6"]
    rows = EDGE + [(100 + i, "".join(draw.choice(parts) for _ in range(draw.randrange(25)))) for i in range(500)] + [(900, "token=secret=abcdefghijklmnop token: secret: abcdefghijklmnop"), (901, "f" * 30_000)]
    for r in secret_scan.secret_spans(docs(spark, rows)).collect():
        text = next((t for i, t in rows if i == r.doc_id), None) or ""
        assert [tuple(x) for x in r.base] == brute_secrets(text), text


def test_secret_query(spark, data):
    texts = corpus(spark, data)
    for r in QUERIES["op10_secret_scan"](spark, data).collect():
        found = brute_secrets(texts[r.doc_id])
        listed = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in found)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == k for x in found) for k in range(3)] and r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_entropy(spark):
    def brute(value, entropy, needs):
        parts = [value[i : i + 20] for i in range(len(value) - 19)]
        bits = lambda p: -sum(c / 20 * np.log2(c / 20) for c in Counter(p).values())
        return any(bits(p) >= entropy - 1e-9 and re.search(needs, p) and not re.search(secret_scan.PLACEHOLDER, p) for p in parts)

    draw = random.Random(7)
    values = ["".join(draw.choice(a) for _ in range(n)) for n in (20, 21, 64, 300, 513) for a in ("abcDEF0123+/=", "ab1", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz0123456789", "aB3xYz9Kq/example_-") for _ in range(4)] + ["a" * 30, "a" * 19 + "bcdefghijklmnop", "a1b2"]
    values += ["a" * (255 - k) + "kJ8s0dPq2LmZx7Vb4Nt9" + "a" * 300 for k in range(0, 24, 3)]
    for _, _, entropy, needs in secret_scan.CLASSES:
        got = spark.createDataFrame([(v,) for v in values], "v string").select("v", secret_scan.random_window(F.col("v"), entropy, needs).alias("h")).collect()
        assert {r.v: r.h for r in got} == {v: bool(brute(v, entropy, needs)) for v in values}
    texts = [
        (1, "key kJ8s0dPq2LmZx7Vb4Nt9 end"), (2, "id 123e4567-e89b-12d3-a456-426614174000"), (3, "some-long-compound-words-joined/with/slashes"), (4, "AbCdExample0123456789xyz"), (5, "1111111111111111111111111a"),
        (6, "KEY_0A7F3C9E15B8D2640F9A"), (7, "api/example/kJ8s0dPq2LmZx7Vb4Nt9"), (8, "x q7w3e9r2t5y8u1i4o6p0a z"), (9, "api/v1/users/profile/settings/2024-01-02"),
    ]
    got = {r.doc_id: r.entropy for r in secret_scan.secret_spans(docs(spark, texts)).collect()}
    assert {i: len(e) for i, e in got.items()} == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1, 7: 1, 8: 1, 9: 0}
    assert (got[6][0].start, got[6][0].end) == (0, 24) and (got[7][0].start, got[7][0].end) == (0, 32)


def test_long_candidates(spark):
    """Long paths, dashes and blobs: no recursion in the patterns, no quadratic time."""
    draw = random.Random(9)
    blob = "".join(draw.choice("ABCDEFabcdef0123456789+/") for _ in range(100_000))
    texts = [(1, "a/" * 50_000 + "a12345b"), (2, "-" * 100_000), (3, blob), (4, "a-1_" * 30_000), (5, "token=" * 20_000), (6, "0" * 100_000 + "a")]
    got = {r.doc_id: len(r.entropy) for r in secret_scan.secret_spans(docs(spark, texts)).collect()}
    assert got[1] == got[2] == got[4] == got[6] == 0 and got[3] == 1


# --- all ------------------------------------------------------------------------------------------------------------


def test_running_totals(spark):
    for values in ([], [5], list(range(1000))):
        got = spark.createDataFrame([(values,)], "v array<int>").select(native.running_totals(F.col("v"))).first()[0]
        assert got == np.cumsum(values).tolist()


def test_native_plans_have_no_python(spark, data):
    for name in ("op4_quality_rules", "op8_pii", "op10_secret_scan"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_each_operator_has_its_query():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op")} == set(range(1, 11)) and set(SQL) <= set(QUERIES)


def test_text_ids(spark):
    """Ids need not be numbers."""
    df = spark.createDataFrame([("b", "one two three four five six"), ("a", "one two three four five six"), (None, "x")], T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("text", T.StringType())]))
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(df).collect()}
    assert got == {"a": "a", "b": "a", None: None}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, data, name):
    from ..oracle import compare, connect

    compare(connect(data), QUERIES[name](spark, data), SQL[name])
