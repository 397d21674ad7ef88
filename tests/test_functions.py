import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataforge.functions import columns as C
from strataforge.operators import rows as R


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, value, f, kind="string"):
    return values(spark, [(value,)], f"x {kind}", f(F.col("x")).alias("y"))[0][0]


@pytest.mark.parametrize("text,want", [("12.5", 13), ("0.4999996", 1), ("abc", None), (None, None), ("-2.5", -3), ("99999999999999999999", None)])
def test_safe_int(spark, text, want):
    assert one(spark, text, C.safe_int) == want


@pytest.mark.parametrize("text,want", [("anti-magic rod", "Anti-Magic Rod"), ("B.F. SWORD", "B.F. Sword"), ("doran's blade", "Doran's Blade"), ("élan vital", "Élan Vital"), ("", ""), (None, None)])
def test_title_case(spark, text, want):
    assert one(spark, text, C.title_case) == want


def test_words_of_pascal(spark):
    assert one(spark, " TwistedFate ", C.words_of_pascal) == "Twisted Fate"


@pytest.mark.parametrize(
    "text,want",
    [("2024-05-01 10:00:00", dt.datetime(2024, 5, 1, 10)), ("1700000000", dt.datetime(2023, 11, 14, 22, 13, 20)), ("1700000000000", dt.datetime(2023, 11, 14, 22, 13, 20)), ("1700000000000000", dt.datetime(2023, 11, 14, 22, 13, 20)), ("1700000000000000000", dt.datetime(2023, 11, 14, 22, 13, 20)), ("soon", None), (None, None)],
)
def test_parse_timestamp(spark, text, want):
    assert one(spark, text, C.parse_timestamp) == want


def test_strict_extremes(spark):
    rows = values(spark, [(1, 2), (None, 2), (3, -1)], "a int, b int", C.strict_greatest(F.col("a"), F.col("b")), C.strict_least(F.col("a"), F.col("b")))
    assert rows == [(2, 1), (None, None), (3, -1)]


def test_ranges(spark):
    assert values(spark, [(10800,), (10801,), (-1,), (None,)], "x int", C.valid_range(F.col("x"), 0, 10800)) == [(10800,), (None,), (None,), (None,)]
    assert one(spark, "abcd", lambda c: C.null_if_longer(c, 3)) is None


def test_hash_of_nulls_differs(spark):
    hashed = C.fast_hash(C.joined([F.col("a"), F.col("b"), F.col("c")]))
    (a,), (b,) = values(spark, [(1, None, 2), (1, 2, None)], "a int, b int, c int", hashed)
    assert a != b and len(a) == 20


def test_boundaries(spark):
    t = lambda s: dt.datetime.fromisoformat(s)
    rows = [(t("2024-01-01 10:00:59"), t("2024-01-01 10:01:00")), (t("2024-01-01 10:01:00"), t("2024-01-01 10:01:59")), (None, t("2024-01-01"))]
    assert values(spark, rows, "a timestamp, b timestamp", C.boundaries_between("minute", F.col("a"), F.col("b"))) == [(1,), (0,), (None,)]


def test_decimal_rounding(spark):
    assert one(spark, 1005, lambda c: C.decimal_ratio(c, F.lit(1000), 2), "long") == 1.01
    assert one(spark, 1, lambda c: C.decimal_ratio(c, F.lit(0), 2), "long") is None


def test_upsert_takes_the_last_of_a_batch_and_repeats(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "c", 1), (None, "x", 9)], "k int, v string, at int")
    once = R.upsert(target, batch, ["k"], ["at"])
    twice = R.upsert(once, batch, ["k"], ["at"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "a"), (2, "new"), (3, "c")]


def test_insert_missing_with_null_keys(spark):
    target = spark.createDataFrame([(1,), (None,)], "k int")
    rows = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    assert [r.k for r in R.insert_missing(target, rows, ["k"]).collect()] == [2]


def test_top_rows_null_order(spark):
    df = spark.createDataFrame([("g", None), ("g", 5), ("h", 1)], "g string, v int")
    assert sorted(map(str, R.top_rows(df, ["g"], [F.col("v").desc_nulls_first()]).collect())) == sorted(["Row(g='g', v=None)", "Row(g='h', v=1)"])


def test_safe_int_of_many_columns_stays_out_of_generated_code(spark):
    """The way over decimals is a lambda: no column brings its decimals into the code of a row."""
    df = spark.createDataFrame([("7", "1.5", "5\x7f")], "a string, b string, c string")
    out = df.select(*[C.safe_int(F.col(c)).alias(c) for c in df.columns])
    assert out.first() == (7, 2, None) and "transform(" in out._jdf.queryExecution().executedPlan().toString().lower().replace("lambdafunction", "transform(")
