"""The filter audit against a walk through every order, document by document."""

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from strataforge.llm import filter_audit

WORDS = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    failing = []
    for i, text, lang in rows:
        t = text or ""
        w = WORDS.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and first[t] < i}
        failing.append((lang or "", i, {k for k, v in fails.items() if v}))
    out = {}
    for part in {p for p, _, _ in failing}:
        for order in permutations("ABCDE"):
            for at, f in enumerate(order):
                of = [(i, s) for p, i, s in failing if p == part]
                here = [i for i, s in of if f in s and not s & set(order[:at])]
                out[part, "".join(order), at + 1] = [
                    sum(not s & set(order[: at + 1]) for _, s in of), len(here), sum(f in s and bool(s & set(order[:at])) for _, s in of), sum(s == {f} for _, s in of), sum(i in good for i in here), sum(i in toxic for i in here)
                ]
    for part, order, step in out:
        f = order[step - 1]
        out[part, order, step].append(sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == f))
    return out


def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("part", "mask", "digest", "n", "own", "filter", "_part", "k", "first"):
        docs = docs.withColumn(name, F.lit("clash"))
    marks = spark.createDataFrame(labels, LABELS).withColumn("part", F.lit("clash")).withColumn("mask", F.lit(3))
    out = filter_audit.audit(filter_audit.cells(filter_audit.masks(docs), marks))
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in out.collect()}
    assert len(got) == out.count()
    return got


def test_audit_by_hand_counts(spark):
    clean = " ".join(f"w{i}" for i in range(250))
    rows = [(1, clean, "en"), (2, clean, "en"), (3, None, "en"), (4, "", None), (5, "A b #", "de"), (6, "a " * 300, "en"), (7, clean + " #", ""), (8, "A" * 90 + " " + clean, "en")]
    rows += [(None, clean, "en"), (2, clean, "de"), (9, "x" * 40_000 + " é\x0b\x0c", "de"), (10, "é " * 199 + "É", None)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (5, 0, 1), (None, 1, 1), (6, None, None), (99, 1, 1)]
    got, want = audited(spark, rows, labels), brute(rows, labels)
    assert set(got) == set(want) and {p for p, _, _ in got} == {"en", "de", ""}
    for key, value in want.items():
        assert got[key] == value, key


@pytest.mark.parametrize("rows,labels", [([], []), ([], [(1, 1, 1)]), ([(1, "one", "en")], [])])
def test_audit_of_empty_tables(spark, rows, labels):
    got = audited(spark, rows, labels)
    assert len(got) == 600 * len({r[2] for r in rows}) and got == brute(rows, labels)


def test_one_text_in_most_rows(spark):
    """Copies of one text are dealt over tasks; every copy but the smallest id fails E."""
    rows = [(i, "same text" if i % 3 else f"text {i}", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    assert filter_audit.masks(docs).where(F.col("mask") >= 16).count() == 1999
