"""What keeps the season's tables in order, as queries with SQL twins: nameless items and their backfill, matches without
snapshots, load errors, freshness and run times of the models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.rows import upsert
from .plans import gold, monitors
from .plans.schemas import KEYS, LOAD_ORDER, SILVER
from .plans.silver import cleaned
from .season import raw_tables, silver_tables
from .season_queries import _M4, _with
from .sources import landing

QUERIES, SQL = {}, {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


@_query(f"{_with()} SELECT DISTINCT u.item_id FROM (SELECT unnest([item_0, item_1, item_2]) AS item_id FROM iv) u LEFT JOIN it ON it.item_id = u.item_id WHERE u.item_id IS NOT NULL AND it.item_name IS NULL")
def nameless_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_tables(spark, sf_dir)
    return monitors.nameless_items(silver["intervals"], silver["items_ref"])


@_query(f"{_with()} SELECT item_id, item_name, item_category FROM it UNION ALL SELECT * FROM (VALUES (26, 'Long Sword', 'Basic'), (27, 'Cloak', 'Epic')) AS t")
def backfilled_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two entries that the reference lacks and one that it has, put in by hand, twice; then cleaned as all others."""
    raw = raw_tables(spark, sf_dir)["items_ref"]
    for _ in range(2):
        raw = raw.unionByName(monitors.backfill(spark, raw, [(26, "long sword", "Basic"), (27, "cloak", "Epic"), (1, "something else", "Basic")]))
    return upsert(None, cleaned("items_ref", raw), KEYS["items_ref"], LOAD_ORDER).select(SILVER["items_ref"].names)


@_query("SELECT 'ord_' || o_orderkey AS match_id, 'matches_20240601.csv' AS file_name, 'season' AS rsrc FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)")
def unlogged_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw matches without any raw snapshot from minute 41 on."""
    raw = raw_tables(spark, sf_dir)
    late = raw["intervals"].where("cast(minute as bigint) > 40 and cast(team_kills as bigint) = cast(total_gold as bigint) / 10 % 60")
    return monitors.unlogged_matches(raw["matches"], late).select("match_id", "file_name", "rsrc")


_NOW = "TIMESTAMP '1998-08-02 12:34:56'"
_HISTORY = f"""h AS (SELECT [{", ".join(f"'{m}'" for m in gold.MODELS)}][1 + o_orderkey % 6] AS model, CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' ELSE 'FAILED' END AS state, CAST(o_orderdate AS TIMESTAMP) AS started_at,
  CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 SECOND * (o_custkey % 601) AS ended_at FROM orders)"""
_TARGETS = ", ".join(f"('{m}', {hours * 60})" for m, (_, _, hours) in gold.MODELS.items())


def _refreshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as refreshes of the models: done orders succeeded, a run takes up to ten minutes."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    started = F.col("o_orderdate").cast("timestamp_ntz")
    model = F.get(F.array(*[F.lit(m) for m in gold.MODELS]), (F.col("o_orderkey") % 6).cast("int"))
    ended = started + F.make_dt_interval(secs=(F.col("o_custkey") % 601).cast("decimal(18,6)"))
    return orders.select(model.alias("model"), F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").otherwise("FAILED").alias("state"), started.alias("started_at"), ended.alias("ended_at"), F.lit(1).cast("bigint").alias("n_rows"))


@_query(f"""
WITH {_HISTORY}, last AS (SELECT model, max(ended_at) AS at_ FROM h WHERE state = 'SUCCEEDED' GROUP BY model)
SELECT t.model, CAST(target AS BIGINT) AS target_minutes, date_diff('minute', at_, {_NOW}) AS lag_minutes, CASE WHEN date_diff('minute', at_, {_NOW}) <= target THEN 'FRESH' ELSE 'BEHIND' END AS status FROM (VALUES {_TARGETS}) AS t(model, target) LEFT JOIN last USING (model)
""")
def model_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitors.freshness(_refreshes(spark, sf_dir), F.expr(_NOW).cast("timestamp_ntz")).select("model", "target_minutes", "lag_minutes", "status")


@_query(f"""
WITH {_HISTORY} SELECT model, count(*) AS runs, count(*) FILTER (WHERE state <> 'SUCCEEDED') AS failures, round(avg(date_diff('second', started_at, ended_at)), 2) AS mean_seconds FROM h WHERE started_at >= {_NOW} - INTERVAL 2400 HOURS GROUP BY model
""")
def model_run_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs, failures and mean time of the last hundred days."""
    return monitors.run_times(_refreshes(spark, sf_dir), F.expr(_NOW).cast("timestamp_ntz"), hours=2400)


@_query(f"""
SELECT 'orders_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS file_name, count(*) AS parsed, count(*) FILTER (WHERE o_orderstatus = 'P') AS rejected FROM orders WHERE CAST(o_orderdate AS TIMESTAMP) >= {_NOW} - INTERVAL 1500 DAYS GROUP BY ALL HAVING count(*) FILTER (WHERE o_orderstatus = 'P') > 0
""")
def load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a file a day, in which partial orders are errors."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = orders.select(F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv")).alias("file_name"), F.when(F.col("o_orderstatus") == "P", "partial").alias("_bad"))
    history = landing.file_report(rows).withColumn("loaded_at", F.to_timestamp(F.regexp_extract("file_name", "_([0-9]+)", 1), "yyyyMMdd").cast("timestamp_ntz"))
    return landing.load_errors(history, F.expr(_NOW).cast("timestamp_ntz"), days=1500).select("file_name", "parsed", "rejected")


@_query(f"""{_with(_M4)} SELECT match_id, CASE WHEN red_towers = 3 THEN 'MISMATCH' ELSE 'MATCH' END AS verification FROM m4
WHERE match_id IN (SELECT match_id FROM iv WHERE team = 'BLUE') AND match_id IN (SELECT match_id FROM iv WHERE team = 'RED')""")
def pivot_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pivot of all matches against the snapshots it was made of; where red has three towers it has been tampered with."""
    silver = silver_tables(spark, sf_dir, by_match=True)
    pivot = gold.matchend_pivot_teamstats(silver["intervals"], silver["matches"])
    tampered = pivot.withColumn("blue_kills", F.col("blue_kills") + F.when(F.col("red_towers") == 3, 1).otherwise(0))
    return monitors.verified_sides(tampered, silver["intervals"])
