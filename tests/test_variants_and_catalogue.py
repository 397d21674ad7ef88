import uuid

from pyspark.sql import functions as F

from strataforge.functions.variants import element_pairs, exploded
from strataforge.plans import catalogue
from strataforge.plans.classifiers import profile


def test_exploded(spark):
    rows = [(1, '[{"id":1},null,"x"]'), (2, "[]"), (3, None), (4, "7"), (5, '{"a":1,"b":[2]}'), (6, "null")]
    df = spark.createDataFrame(rows, "k int, j string").select("k", F.parse_json("j").alias("v"))
    got = sorted((r.k, r.e_pos, r.e_key, r.t) for r in exploded(df, "v", "e").select("k", "e_pos", "e_key", F.to_json("e_value").alias("t")).collect())
    assert got == [(1, 0, None, '{"id":1}'), (1, 1, None, "null"), (1, 2, None, '"x"'), (5, 0, "a", "1"), (5, 1, "b", "[2]")]
    pairs = element_pairs(df, "v")
    assert pairs.where("k = 1").count() == 6 and pairs.where("k not in (1, 5)").count() == 0 and exploded(df.limit(0), "v", "e").count() == 0


def test_catalogue_keeps_comments_and_counts(spark, tmp_path):
    database = f"d{uuid.uuid4().hex}"
    df = spark.range(7).withColumn("x", F.lit("a")).withMetadata("x", {"comment": "what x is"})
    catalogue.publish(spark, database, {"one": df, "none": df.limit(0)}, {"one": "it's one"}, str(tmp_path))
    catalogue.publish(spark, database, {"one": df.limit(3)}, {"one": "it's one"})  # in place of the first
    got = {r.model: r for r in catalogue.known_tables(spark, database).collect()}
    assert (got["one"].row_count, got["one"].comment, got["one"].columns, got["one"].comments) == (3, "it's one", 2, {"x": "what x is"}) and got["one"].bytes > 0
    assert got["none"].row_count == 0
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_profile_by_counts(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", None), (2, None, None), (10, "a", None)], "n int, s string, e string")
    got = {r.name: tuple(r)[1:] for r in profile(df).collect()}
    assert got == {"n": ("int", 0.0, 0.75, "1", "10"), "s": ("string", 0.25, 0.5, "a", "b"), "e": ("string", 1.0, 0.0, None, None)}
    assert {r.null_share for r in profile(df.limit(0)).collect()} == {None}
