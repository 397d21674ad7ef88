"""The corpus pipeline, each stage against a brute-force version on what the stage before it kept."""

import importlib
import os

import pytest
from pyspark.sql import functions as F

from .test_operators import EDGE, WORDS, brute_components, brute_contamination, brute_lines, windows_of

pipeline = pytest.importorskip("corpus_pipeline")


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    """Input and output of every stage, written and read again between stages."""
    out, docs = {}, spark.read.parquet(f"{data}/documents.parquet")
    for k, (name, stage) in enumerate(pipeline.STAGES):
        folder = os.path.join(tmp_path_factory.mktemp("stage"), str(k))
        stage(spark, docs, data).write.parquet(folder)
        after = spark.read.parquet(folder)
        out[name], docs = (docs, after), after
    return out


def test_columns(spark, data, stages):
    columns = spark.read.parquet(f"{data}/documents.parquet").dtypes
    assert all(out.dtypes == columns for name, (_, out) in stages.items() if name != pipeline.STAGES[-1][0])


def test_quality(spark, data, stages):
    before, after = stages["quality_rank"]
    from strataforge.llm.quality_rank import quality_scores

    good = {r.doc_id for r in quality_scores(before, spark.read.parquet(f"{data}/labels.parquet")).where("predicted = 1").collect()}
    assert rows(after) == [x for x in rows(before) if x[0] in good] and 0 < len(good) < before.count()


def test_lines(stages):
    before, after = stages["line_dedup"]
    want = []
    for (i, text), gone in brute_lines(rows(before), 24).items():
        kept = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        if WORDS.search(kept) or not WORDS.search(text):
            want.append((i, kept))
    assert rows(after) == sorted(want) and all(r.n_chars == len(r.text) for r in after.collect())


def test_near_copies(stages):
    before, after = stages["jaccard_join"]
    all_rows = rows(before)
    assert rows(after) == [x for x, (i, _, c) in zip(all_rows, brute_components(all_rows, 5, 80), strict=True) if i == c]


def test_benchmark(spark, data, stages):
    before, after = stages["decontaminate"]
    windows = windows_of([tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()])
    assert rows(after) == [x for x in rows(before) if not brute_contamination(x[1], windows)[1]]


def test_pieces_and_run(spark, data, stages):
    before, after = stages["sentence_pieces"]
    assert after.count() == before.count() > 0
    assert sorted(map(str, pipeline.run(spark, data).collect())) == sorted(map(str, after.collect()))


CLASHES = ("h", "_id", "_h", "_row", "_text", "a", "b", "dropped", "best", "component", "cls", "row", "place", "quality", "score", "n_words", "x.y")
LONG = " ".join(f"word{k}" for k in range(40))


def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, near copies, a benchmark passage,
    and columns named as the operators name theirs."""
    texts = [*EDGE, (20, LONG), (20, LONG), (21, LONG), (22, LONG + " more"), (None, LONG), (None, None), (23, None), (24, "alpha beta\nalpha beta\n")]
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 2 == 0 else "web", None if t is None else len(t)) for k, (i, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit("clash").alias(name) for name in CLASHES])


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with labels and a benchmark that have nulls and repeated rows."""
    folder = str(tmp_path_factory.mktemp("small"))
    labels = [(20, 1, 0), (20, 1, 0), (7, 0, 0), (6, 0, None), (5, 1, 0), (8, None, 0), (None, 1, 0), (999, 0, 0), (21, 1, 0), (24, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, "one two three"), (1, "one two three"), (2, None), (3, ""), (None, "never to be found in any text at all or anywhere else")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def texts_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_edge_rows(spark, small, name, stage):
    docs = edge_docs(spark)
    out = stage(spark, docs, small)
    before, after = texts_of(docs), None
    if name != pipeline.STAGES[-1][0]:
        assert out.dtypes == docs.dtypes and all(r["x.y"] == "clash" for r in out.collect())
        after = texts_of(out)
    if name == "quality_rank":
        assert set(after) <= set(before) and all(after.count(x) == before.count(x) for x in after)
    elif name == "line_dedup":
        assert [x for x in after if x[1] is None] == [x for x in before if x[1] is None]
        assert (24, "alpha beta\n") in after and (21, LONG) not in after and after.count((4, "one")) == 2
    elif name == "jaccard_join":
        assert [x for x in after if not WORDS.search(x[1] or "")] == [x for x in before if not WORDS.search(x[1] or "")]
        assert after.count((20, LONG)) == 1 and {21, 22}.isdisjoint(i for i, _ in after) and after.count((4, "one")) == 1
    elif name == "decontaminate":
        assert after == [x for x in before if "one two three" not in (x[1] or "")]
    else:
        assert out.count() == len(before) and out.where("n_tokens is null or ids_sha256 is null").count() == 0


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_empty_tables(spark, small, tmp_path, name, stage):
    docs = edge_docs(spark)
    assert stage(spark, docs.limit(0), small).count() == 0
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    if name in ("quality_rank", "decontaminate"):
        got = texts_of(stage(spark, docs, str(tmp_path)))
        assert got == texts_of(docs) if name == "decontaminate" else got in ([], texts_of(docs))


def test_entry_without_the_pipeline(monkeypatch):
    import sys

    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert "pipeline" not in importlib.reload(entry).queries() and "op1_decontaminate" in entry.queries()
    monkeypatch.setitem(sys.modules, "strataforge.llm", None)
    for name in [m for m in sys.modules if m.startswith("strataforge.llm.")]:
        monkeypatch.setitem(sys.modules, name, None)
    assert not any(n.startswith("op") and "_" in n and n[2].isdigit() for n in importlib.reload(entry).queries())
    monkeypatch.undo()
    assert "pipeline" in importlib.reload(entry).queries()
