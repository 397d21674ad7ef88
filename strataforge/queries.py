"""The library's operators as queries over the driver's tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions import columns as C
from . import season_queries, upkeep_queries
from .functions.variants import element_pairs
from .operators import rows as R
from .operators.keyed import KeyedTable
from .plans import gold, monitors, proportions
from .season import scratch
from .sources import landing
from .streaming.history import StreamHistory, Suspended, last_errors, stream_summary
from .streaming.pipes import Lake, refresh, run_guarded
from .streaming.replay import export

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ntz(column: str):
    return F.col(column).cast("timestamp_ntz")


# --- cleaning -------------------------------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OPEN' END AS state,
  CASE WHEN w BETWEEN 0 AND 200000 THEN w END AS whole_price,
  CASE WHEN CAST(o_orderdate AS TIMESTAMP) BETWEEN TIMESTAMP '1994-01-01' AND TIMESTAMP '1997-12-31' THEN CAST(o_orderdate AS TIMESTAMP) END AS bounded_date,
  upper(o_orderpriority) AS priority, CASE WHEN length(o_orderpriority) <= 6 THEN o_orderpriority END AS short_priority
FROM (SELECT *, CAST(round(TRY_CAST(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS DECIMAL(38,6)), 0) AS BIGINT) AS w FROM orders)
WHERE o_orderkey IS NOT NULL
""")
def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = C.safe_int(F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    low, high = (F.lit(x).cast("timestamp_ntz") for x in ("1994-01-01", "1997-12-31"))
    return table(spark, sf_dir, "orders").dropna(subset=["o_orderkey"]).select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "FINAL").when(F.col("o_orderstatus") == "O", "OPEN").alias("state"), C.valid_range(price, 0, 200000).alias("whole_price"),
        C.valid_range(_ntz("o_orderdate"), low, high).alias("bounded_date"), F.upper("o_orderpriority").alias("priority"), C.null_if_longer(F.col("o_orderpriority"), 6).alias("short_priority"),
    )


@query("""
SELECT p_partkey, list_transform(string_split(p_type, ' '), lambda x: CASE WHEN x = 'SMALL' THEN 'S' ELSE upper(x) END) AS words,
  TRY_CAST(CASE WHEN p_size % 7 = 0 THEN 'x' ELSE CAST(p_size AS VARCHAR) END AS BIGINT) AS size_number,
  nullif(p_size % 5, 0) AS slot, coalesce(nullif(p_brand, 'Brand#11'), '<none>') AS brand
FROM part
""")
def clean_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("p_size") % 7 == 0, "x").otherwise(F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.transform(F.split("p_type", " "), lambda x: F.when(x == "SMALL", "S").otherwise(F.upper(x))).alias("words"), size.try_cast("bigint").alias("size_number"),
        F.nullif(F.col("p_size") % 5, F.lit(0)).alias("slot"), F.coalesce(F.nullif("p_brand", F.lit("Brand#11")), F.lit("<none>")).alias("brand"),
    )


# --- snapshots, groups, pivots --------------------------------------------------------------------------------------


@query("""
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) AS r FROM events) WHERE r = 1
""")
def last_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_rows(table(spark, sf_dir, "events"), ["user_id"], [F.col("ts").desc_nulls_first(), F.col("event_id").desc()]).select("user_id", "event_id", "event_type", "value")


@query("""
SELECT event_type, minute5, count(*) AS rows_sampled,
  CAST((2 * CAST(sum(cents) AS BIGINT) * 100 + CASE WHEN sum(cents) < 0 THEN -count(cents) ELSE count(cents) END) // (2 * count(cents)) AS DOUBLE) / 100 AS avg_cents_raw,
  CAST(sum(cents) AS BIGINT) AS sum_cents, count(cents) AS n_cents
FROM (SELECT event_type, CAST(round(minute(ts) / 5.0) * 5 AS BIGINT) AS minute5, CAST(round(CAST(value AS DECIMAL(20,4)), 0) AS BIGINT) AS cents FROM events)
GROUP BY event_type, minute5
""")
def bucket_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute = (F.round(F.minute("ts").cast("decimal(20,0)") / 5, 0) * 5).cast("bigint")
    rows = table(spark, sf_dir, "events").select("event_type", minute.alias("minute5"), F.round(F.col("value").cast("decimal(20,4)"), 0).cast("bigint").alias("cents"))
    return rows.groupBy("event_type", "minute5").agg(F.count(F.lit(1)).alias("rows_sampled"), C.decimal_mean(F.col("cents"), 2).alias("avg_cents_raw"), F.sum("cents").alias("sum_cents"), F.count("cents").alias("n_cents"))


@query("""
WITH last AS (SELECT * FROM (SELECT l_orderkey, l_returnflag, l_shipdate, l_quantity, row_number() OVER (PARTITION BY l_orderkey, l_returnflag
    ORDER BY l_shipdate DESC NULLS FIRST, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS r FROM lineitem) WHERE r = 1),
wide AS (SELECT l_orderkey, max(l_shipdate) AS last_ship, max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS a_quantity,
    max(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS n_quantity, max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS r_quantity FROM last GROUP BY l_orderkey)
SELECT o_orderkey, o_orderstatus, a_quantity, n_quantity, r_quantity, CASE o_orderstatus WHEN 'F' THEN a_quantity WHEN 'O' THEN n_quantity END AS own_quantity,
  CASE WHEN d IS NOT NULL THEN greatest(d, 0) END AS days_open
FROM (SELECT *, date_diff('day', CAST(nullif(o_orderdate, TIMESTAMP '1995-01-01') AS DATE), CAST(last_ship AS DATE)) AS d FROM wide JOIN orders ON o_orderkey = l_orderkey)
""")
def order_status_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("l_shipdate").desc_nulls_first(), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    last = R.top_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"], order)
    wide = last.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"), *[F.max(F.when(F.col("l_returnflag") == x, F.col("l_quantity"))).alias(f"{x.lower()}_quantity") for x in "ANR"])
    rows = wide.join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    start = F.when(_ntz("o_orderdate") != F.lit("1995-01-01").cast("timestamp_ntz"), F.col("o_orderdate"))
    days = F.date_diff(F.to_date("last_ship"), F.to_date(start)).cast("bigint")
    own = F.when(F.col("o_orderstatus") == "F", F.col("a_quantity")).when(F.col("o_orderstatus") == "O", F.col("n_quantity"))
    return rows.select("o_orderkey", "o_orderstatus", "a_quantity", "n_quantity", "r_quantity", own.alias("own_quantity"), C.strict_greatest(days, F.lit(0).cast("bigint")).alias("days_open"))


_OVERVIEW = """
WITH played AS (SELECT nullif(c_nationkey, 6) AS k, nullif(o_orderpriority, '5-LOW') AS role, o_orderkey, o_totalprice >= 50000 AS eligible, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS win
    FROM orders JOIN customer ON o_custkey = c_custkey),
by_role AS (SELECT k, role, count(*) AS n FROM played GROUP BY k, role),
lane AS (SELECT k, role, n, a FROM (SELECT *, sum(n) OVER (PARTITION BY k) AS a, row_number() OVER (PARTITION BY k ORDER BY n DESC NULLS FIRST, role ASC NULLS LAST) AS r FROM by_role) WHERE r = 1),
picks AS (SELECT k, count(*) AS n FROM played GROUP BY k),
wins AS (SELECT k, count(*) AS games, count(*) FILTER (WHERE win) AS wins FROM played WHERE eligible AND win IS NOT NULL GROUP BY k),
bans AS (SELECT k, count(*) AS n FROM (SELECT DISTINCT o_orderkey, k FROM (SELECT o_orderkey, o_custkey % 25 AS k FROM orders UNION ALL SELECT o_orderkey, o_orderkey % 25 FROM orders) WHERE k <> 0) GROUP BY k),
total AS (SELECT count(*) AS n FROM orders)
SELECT n_nationkey AS nation_id, n_name AS nation, lane.role AS main_priority, CAST(lane.n AS BIGINT) AS main_n, CAST(lane.a AS BIGINT) AS all_n,
  CAST(coalesce(picks.n, 0) AS BIGINT) AS games, CAST(wins.wins AS BIGINT) AS wins, CAST(wins.games AS BIGINT) AS eligible, CAST(coalesce(bans.n, 0) AS BIGINT) AS bans, total.n AS total
FROM nation LEFT JOIN picks ON picks.k = n_nationkey LEFT JOIN wins ON wins.k = n_nationkey LEFT JOIN lane ON lane.k = n_nationkey LEFT JOIN bans ON bans.k = n_nationkey CROSS JOIN total
WHERE n_nationkey <> 0
"""


@query(_OVERVIEW)
def nation_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    win = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    played = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(F.nullif("c_nationkey", F.lit(6)).alias("k"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("role"), (F.col("o_totalprice") >= 50000).alias("eligible"), win.alias("win"))
    by_role = played.groupBy("k", "role").agg(F.count(F.lit(1)).alias("n"))
    lane = gold.mode_of(by_role.withColumn("a", F.sum("n").over(Window.partitionBy("k"))), ["k"], "role").select("k", F.col("role").alias("main_priority"), F.col("n").alias("main_n"), F.col("a").alias("all_n"))
    picks = by_role.groupBy("k").agg(F.sum("n").alias("games"))
    wins = played.where(F.col("eligible") & F.col("win").isNotNull()).groupBy("k").agg(F.count(F.lit(1)).alias("eligible"), F.count_if("win").alias("wins"))
    banned = orders.select("o_orderkey", (F.col("o_custkey") % 25).alias("k")).union(orders.select("o_orderkey", F.col("o_orderkey") % 25)).where("k != 0").distinct()
    bans = banned.groupBy("k").agg(F.count(F.lit(1)).alias("bans"))
    total = orders.agg(F.count(F.lit(1)).alias("total"))
    rows = table(spark, sf_dir, "nation").where("n_nationkey != 0").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("nation"))
    for other in (picks, wins, lane, bans):
        rows = rows.join(other, "k", "left")
    zero = F.lit(0).cast("bigint")
    return rows.crossJoin(total).select(F.col("k").alias("nation_id"), "nation", "main_priority", "main_n", "all_n", F.coalesce("games", zero).alias("games"), "wins", "eligible", F.coalesce("bans", zero).alias("bans"), "total")


@query("""
SELECT o_orderstatus, o_orderpriority, n, CAST(sum(n) OVER (PARTITION BY o_orderstatus) AS BIGINT) AS status_n
FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority)
""")
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("status_n", F.sum("n").over(Window.partitionBy("o_orderstatus")))


@query("""
SELECT user_id, max(value) AS top_value, max(CASE WHEN rf = 1 THEN event_type END) AS first_type, max(CASE WHEN rl = 1 THEN event_type END) AS last_type, max(CASE WHEN rl = 1 THEN v END) AS last_value
FROM (SELECT user_id, value, event_type, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rf, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rl FROM events)
GROUP BY user_id
""")
def max_by_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("v", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return rows.groupBy("user_id").agg(F.max("value").alias("top_value"), F.min_by("event_type", "ts").alias("first_type"), F.max_by("event_type", "ts").alias("last_type"), F.max_by("v", "ts").alias("last_value"))


# --- baskets --------------------------------------------------------------------------------------------------------

def _basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as items in one of 40 kinds, orders as baskets; ten kinds have no tier."""
    parts = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 40).alias("item_id"), F.concat(F.lit("item "), (F.col("p_partkey") % 40).cast("string")).alias("item_name"), F.when(F.col("p_partkey") % 40 < 30, F.col("p_partkey") % 40 % 5 + 1).cast("int").alias("tier"))
    return table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select("l_linestatus", "l_orderkey", "item_id", "item_name", "tier")


@query("""
WITH items AS (SELECT l_linestatus, l_orderkey, l_partkey % 40 AS item_id, CASE WHEN l_partkey % 40 < 30 THEN l_partkey % 40 % 5 + 1 END AS tier FROM lineitem JOIN part ON l_partkey = p_partkey),
numbered AS (SELECT *, row_number() OVER () AS line FROM items WHERE tier IS NOT NULL),
pairs AS (SELECT a.l_linestatus, a.item_id, b.item_id AS other, count(*) AS n FROM numbered a JOIN numbered b ON a.l_linestatus = b.l_linestatus AND a.l_orderkey = b.l_orderkey
    WHERE a.item_id <> b.item_id AND a.tier <= b.tier GROUP BY a.l_linestatus, a.item_id, b.item_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_linestatus, item_id ORDER BY n DESC, 'item ' || CAST(other AS VARCHAR), other) AS r FROM pairs)
SELECT l_linestatus, item_id, max(CASE WHEN r = 1 THEN 'item ' || CAST(other AS VARCHAR) END) AS top_item_1, max(CASE WHEN r = 2 THEN 'item ' || CAST(other AS VARCHAR) END) AS top_item_2,
  max(CASE WHEN r = 3 THEN 'item ' || CAST(other AS VARCHAR) END) AS top_item_3
FROM ranked WHERE r <= 3 GROUP BY l_linestatus, item_id
""")
def copurchase_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.companions(_basket(spark, sf_dir), ["l_linestatus"], ["l_orderkey"])


@query("""
WITH first AS (SELECT l_suppkey, l_partkey, min(l_linenumber) AS line FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand NOT IN ('Brand#11', 'Brand#12') GROUP BY l_suppkey, l_partkey),
counts AS (SELECT l_suppkey, line, count(*) AS n FROM first GROUP BY l_suppkey, line)
SELECT l_suppkey, line FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC NULLS FIRST, line ASC NULLS LAST) AS r FROM counts) WHERE r = 1
""")
def first_purchase_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").where(~F.col("p_brand").isin("Brand#11", "Brand#12")).select(F.col("p_partkey").alias("l_partkey"))
    first = table(spark, sf_dir, "lineitem").join(parts, "l_partkey").groupBy("l_suppkey", "l_partkey").agg(F.min("l_linenumber").alias("line"))
    counts = first.groupBy("l_suppkey", "line").agg(F.count(F.lit(1)).alias("n"))
    return gold.mode_of(counts, ["l_suppkey"], "line").select("l_suppkey", "line")


@query("""
SELECT l_orderkey, list_sort(list(p_name)) AS names, count(*) AS n FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey WHERE p_name IS NOT NULL GROUP BY l_orderkey
""")
def named_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(parts, "l_partkey", "left")
    return rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("p_name")).alias("names"), F.count("p_name").alias("n")).where("n > 0")


@query("""
SELECT p_brand, string_agg(p_name, '|' ORDER BY p_name, p_partkey) AS names FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS r FROM part) WHERE r <= 5) GROUP BY p_brand
""")
def brand_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = R.top_rows(table(spark, sf_dir, "part"), ["p_brand"], [F.col("p_name").asc_nulls_last(), F.col("p_partkey").asc_nulls_last()], 5)
    return few.groupBy("p_brand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_name", "p_partkey"))), lambda x: x["p_name"]), "|").alias("names"))


# --- joins ----------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.orphans(table(spark, sf_dir, "orders"), lines, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, o_orderstatus, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def line_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_orderpriority")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").join(orders, "l_orderkey")


@query("""
SELECT prefix, count(p_name) AS n, count(*) FILTER (WHERE p_size > 45) AS large FROM (VALUES ('part_'), ('PART_1'), ('zz_')) AS w(prefix) LEFT JOIN part ON p_name ILIKE prefix || '%' GROUP BY prefix
""")
def prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = spark.createDataFrame([("part_",), ("PART_1",), ("zz_",)], "prefix string")
    joined = table(spark, sf_dir, "part").select("p_name", "p_size").join(F.broadcast(wanted), F.expr("p_name ilike concat(prefix, '%')"))
    counts = joined.groupBy("prefix").agg(F.count("p_name").alias("n"), F.count_if(F.col("p_size") > 45).alias("large"))
    zero = F.lit(0).cast("bigint")
    return wanted.join(counts, "prefix", "left").select("prefix", F.coalesce("n", zero).alias("n"), F.coalesce("large", zero).alias("large"))


@query("""
SELECT n_name, r_name, count(c_custkey) AS customers, count(s_suppkey) AS suppliers FROM nation JOIN region ON n_regionkey = r_regionkey
LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal < -900 LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 9000 GROUP BY n_name, r_name
""")
def nation_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf_dir, "customer").where("c_acctbal < -900").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey")
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey")
    return rows.join(c, "n_nationkey", "left").join(s, "n_nationkey", "left").groupBy("n_name", "r_name").agg(F.count("c_custkey").alias("customers"), F.count("s_suppkey").alias("suppliers"))


# --- sets, sorts ----------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT k, v FROM (SELECT l_orderkey AS k, l_partkey % 25 AS v FROM lineitem UNION ALL SELECT l_orderkey, l_suppkey % 25 FROM lineitem) WHERE v <> 0")
def distinct_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_orderkey").alias("k"), (F.col("l_partkey") % 25).alias("v")).union(lines.select("l_orderkey", F.col("l_suppkey") % 25)).where("v != 0").distinct()


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 50")
def offset_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").offset(50).limit(100)


@query("SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 20")
def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").orderBy(F.desc("ts"), "event_id").limit(20).select("event_id", "event_type")


@query("SELECT * FROM orders ORDER BY md5('7|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 30")
def random_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 30 rows: the limit is what it is for."""
    return monitors.random_rows(table(spark, sf_dir, "orders"), 30, 7, ["o_orderkey"])


@query("""
SELECT status, n FROM (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus) UNION ALL SELECT 'TOTAL', count(*) FROM orders
""")
def counts_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return n.unionByName(n.agg(F.lit("TOTAL").alias("status"), F.sum("n").alias("n")))


# --- keyed writes ---------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, if(o_orderstatus = 'F' AND o_totalprice <= 100000, 'F', 'NEW') AS o_orderstatus, o_totalprice FROM orders")
def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final orders are there; all others come, with the dear ones of those, twice: the later row counts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    batch = orders.where("o_orderstatus != 'F' or o_totalprice > 100000")
    late = batch.withColumn("o_orderstatus", F.lit("NEW")).withColumn("at", F.lit(2))
    return R.upsert(orders.where("o_orderstatus = 'F'"), batch.withColumn("o_orderstatus", F.lit("OLD")).withColumn("at", F.lit(1)).unionByName(late), ["o_orderkey"], ["at"])


@query("""
SELECT s_suppkey, s_name, 'old' AS origin FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, s_name, 'new' FROM supplier WHERE s_suppkey % 2 <> 0
""")
def insert_missing_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    target = rows.where("s_suppkey % 2 = 0").withColumn("origin", F.lit("old"))
    return target.unionByName(R.insert_missing(target, rows.withColumn("origin", F.lit("new")), ["s_suppkey"]))


@query("""
SELECT c_custkey, upper(sha1(upper(trim(c_name)))) AS hub_hash,
  upper(sha1(upper(trim(c_mktsegment || '^' || CAST(c_nationkey AS VARCHAR) || '^' || coalesce(CAST(nullif(c_custkey % 4, 0) AS VARCHAR), '') || '^' || CAST(c_custkey AS VARCHAR))))) AS diff_hash FROM customer
""")
def hash_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = [F.col("c_mktsegment"), F.col("c_nationkey"), F.nullif(F.col("c_custkey") % 4, F.lit(0)), F.col("c_custkey")]
    return table(spark, sf_dir, "customer").select("c_custkey", F.hex(C.fast_hash(F.col("c_name"))).alias("hub_hash"), F.hex(C.fast_hash(C.joined(state))).alias("diff_hash"))


@query("""
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus FROM orders
""")
def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final orders into a table by month, with a month's delay; then all orders, twice, which move to their own month."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    store = KeyedTable(spark, scratch(spark), orders.drop("o_orderdate").schema, ["o_orderkey"], F.date_format("o_orderdate", "yyyy-MM"))
    late = orders.where("o_orderstatus = 'F'").withColumn("o_orderdate", F.add_months("o_orderdate", 1)).withColumn("o_custkey", F.lit(0).cast("int"))
    for batch in (late, orders, orders):
        store.upsert(batch.withColumn("o_custkey", F.col("o_custkey").cast(orders.schema["o_custkey"].dataType)), ["o_custkey"])
    return store.read()


# --- scalar functions -----------------------------------------------------------------------------------------------


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"))


@query("""
WITH j AS (SELECT event_id, '[{"id":' || k % 7 || '},{"id":' || k % 5 || ',"kind":"' || event_type || '"},{"id":null},{"kind":"x"},' || k || ',{"id":' || k % 3 || '}]' AS j FROM (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)),
u AS (SELECT event_id, i, CAST(json_extract(j, '$[' || i || '].id') AS BIGINT) AS id, json_extract_string(j, '$[' || i || '].kind') AS kind FROM j, (SELECT unnest(range(6)) AS i))
SELECT a.id, b.id AS other, b.kind, count(*) AS n FROM u a JOIN u b ON a.event_id = b.event_id AND a.i <> b.i WHERE a.id IS NOT NULL AND b.id IS NOT NULL GROUP BY ALL
""")
def variant_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of objects in a variant, exploded twice in each row; objects without an id, nulls and bare numbers go."""
    k = F.variant_get(F.parse_json("props"), "$.k", "bigint")
    text = lambda c: c.cast("string")
    array = F.concat(F.lit('[{"id":'), text(k % 7), F.lit('},{"id":'), text(k % 5), F.lit(',"kind":"'), "event_type", F.lit('"},{"id":null},{"kind":"x"},'), text(k), F.lit(',{"id":'), text(k % 3), F.lit("}]"))
    pairs = element_pairs(table(spark, sf_dir, "events").select(F.parse_json(array).alias("items")), "items")
    of = lambda side, path, kind: F.try_variant_get(f"{side}_value", path, kind)
    rows = pairs.select(of("a", "$.id", "bigint").alias("id"), of("b", "$.id", "bigint").alias("other"), of("b", "$.kind", "string").alias("kind"))
    return rows.where("id is not null and other is not null").groupBy("id", "other", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id, date_diff('minute', TIMESTAMP '1995-03-05 10:20:30', ts) AS minutes, date_diff('second', date_trunc('day', ts), ts) AS seconds,
  strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) AS day_before, ts - INTERVAL 24 HOURS AS earlier FROM events
""")
def time_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.lit("1995-03-05 10:20:30").cast("timestamp")
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", C.boundaries_between("minute", base, ts).alias("minutes"), C.boundaries_between("second", F.date_trunc("day", ts), ts).alias("seconds"), F.date_format(ts, "yyyyMMdd").alias("day"),
        F.date_format(ts, "yyyyMMdd_HHmmss").alias("stamp"), F.date_add(F.to_date(ts), -1).alias("day_before"), (_ntz("ts") - F.expr("interval 24 hours")).alias("earlier"),
    )


@query("""
SELECT p_partkey, upper(p_name) AS upper_name, length(p_name) AS n, regexp_extract(p_brand, '#([0-9]+)', 1) AS brand_no, regexp_replace(p_type, '([A-Z])([A-Z]+)', '\\1.\\2', 'g') AS dotted, p_brand || '|' || CAST(p_size AS VARCHAR) AS both,
  CASE WHEN p_size IS NULL THEN NULL ELSE least(p_size, 10) END AS capped, p_size % 7 AS rest, -p_size AS negative, CAST(round(CAST(p_retailprice AS DECIMAL(12,4)), 1) AS DECIMAL(12,1)) AS price,
  CASE WHEN p_size NOT IN (1, 2, 3) THEN 'other' END AS kind, CAST(p_size NOT BETWEEN 5 AND 40 AS BOOLEAN) AS odd FROM part
""")
def text_and_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.upper("p_name").alias("upper_name"), F.length("p_name").cast("bigint").alias("n"), F.regexp_extract("p_brand", "#([0-9]+)", 1).alias("brand_no"),
        F.expr("regexp_replace(p_type, '([A-Z])([A-Z]+)', '$1.$2', 1)").alias("dotted"), F.concat("p_brand", F.lit("|"), size.cast("string")).alias("both"), C.strict_least(size, F.lit(10)).alias("capped"),
        (size % 7).alias("rest"), (-size).alias("negative"), F.round(F.col("p_retailprice").cast("decimal(12,4)"), 1).cast("decimal(12,1)").alias("price"),
        F.when(~size.isin(1, 2, 3), "other").alias("kind"), (~size.between(5, 40)).alias("odd"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, list_filter([nullif(l_partkey % 3, 0), nullif(l_suppkey % 4, 0), CAST(l_linenumber AS BIGINT)], lambda x: x IS NOT NULL) AS slots,
  len(list_filter([nullif(l_partkey % 3, 0), nullif(l_suppkey % 4, 0), CAST(l_linenumber AS BIGINT)], lambda x: x IS NOT NULL)) AS n_slots,
  array_to_string([coalesce(CAST(nullif(l_partkey % 3, 0) AS VARCHAR), ''), CAST(l_linenumber AS VARCHAR)], '^') AS joined, {'id': l_partkey, 'line': l_linenumber} AS object FROM lineitem
""")
def arrays_and_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = F.array_compact(F.array(F.nullif(F.col("l_partkey") % 3, F.lit(0)), F.nullif(F.col("l_suppkey") % 4, F.lit(0)), F.col("l_linenumber").cast("bigint")))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", slots.alias("slots"), F.size(slots).cast("bigint").alias("n_slots"),
        C.joined([F.nullif(F.col("l_partkey") % 3, F.lit(0)), F.col("l_linenumber")]).alias("joined"), F.struct(F.col("l_partkey").alias("id"), F.col("l_linenumber").alias("line")).alias("object"),
    )


@query("""
SELECT o_custkey, slot, count(*) AS n, min(o_orderkey) AS first_order FROM (SELECT o_custkey, o_orderkey, unnest(list_filter([nullif(o_orderkey % 3, 0), nullif(o_custkey % 2, 0)], lambda x: x IS NOT NULL)) AS slot FROM orders) GROUP BY o_custkey, slot
""")
def exploded_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = F.array_compact(F.array(F.nullif(F.col("o_orderkey") % 3, F.lit(0)), F.nullif(F.col("o_custkey") % 2, F.lit(0))))
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.explode(slots).alias("slot")).groupBy("o_custkey", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_order"))


# --- checks, monitors, statistics -----------------------------------------------------------------------------------

@query("""
WITH line AS (SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS keys, count(DISTINCT l_orderkey) AS orders FROM lineitem),
pair AS (SELECT unnest([{'name': 'LINES', 'a': n, 'b': keys}, {'name': 'ORDERS', 'a': orders, 'b': (SELECT count(*) FROM orders)},
  {'name': 'NATIONS', 'a': (SELECT count(DISTINCT c_nationkey) FROM customer), 'b': (SELECT count(*) FROM nation)}]) AS x FROM line)
SELECT x.name AS check_name, x.a AS gold_rows, x.b AS expected_rows, x.a - x.b AS row_diff, if(x.a = x.b, 'PASS', if(x.a < x.b, 'ROWS DROPPED', 'MORE ROWS THAN EXPECTED')) AS status FROM pair
""")
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    n = lambda df, *c: df.agg((F.count_distinct(*c) if c else F.count(F.lit(1))).alias("n"))
    out = monitors.compared("LINES", n(lines), n(lines, "l_orderkey", "l_linenumber")).unionByName(monitors.compared("ORDERS", n(lines, "l_orderkey"), n(orders)))
    return out.unionByName(monitors.compared("NATIONS", n(table(spark, sf_dir, "customer"), "c_nationkey"), n(table(spark, sf_dir, "nation"))))


@query("""
SELECT count(*) FILTER (WHERE l_orderkey IS NULL) AS dropped, count(*) AS total, CAST((2 * count(*) FILTER (WHERE l_orderkey IS NULL) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS percent
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey
""")
def dropped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return monitors.dropped_share(table(spark, sf_dir, "orders"), lines, ["o_orderkey"])


@query("""
WITH m AS (SELECT user_id % 50 AS match_id, CASE WHEN user_id % 2 = 0 THEN 'BLUE' ELSE 'RED' END AS team, min(CASE WHEN event_type = 'click' THEN event_id END) AS a, min(CASE WHEN event_type = 'view' THEN event_id END) AS b,
    min(CASE WHEN value > 150 THEN event_id END) AS c FROM events GROUP BY user_id % 50, CASE WHEN user_id % 2 = 0 THEN 'BLUE' ELSE 'RED' END)
SELECT match_id, team, list_sort(list_filter([a, b, c], lambda x: x IS NOT NULL))[2] AS minute FROM m
""")
def second_milestone(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 50).alias("match_id"), F.when(F.col("user_id") % 2 == 0, "BLUE").otherwise("RED").alias("team"), F.col("event_id").alias("minute"),
        F.when(e == "click", 3).alias("team_kills"), F.when(e == "view", 1).alias("team_towers"), F.when(F.col("value") > 150, 3).alias("epic_monsters"),
    )
    return proportions.milestone_minutes(rows)


@query("""
SELECT o_orderpriority, count(*) AS n, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS successes FROM orders GROUP BY o_orderpriority
""")
def success_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("done", (F.col("o_orderstatus") == "F").cast("int"))
    return proportions.counts(rows, "o_orderpriority", "done")


# the critical values of the normal distribution for 5 %, two-sided and one-sided, stand in for its tail, which SQL lacks
@query("""
WITH g AS (SELECT o_orderpriority = '1-URGENT' AS urgent, count(*) AS n, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS p FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ALL),
d AS (SELECT a.n + b.n AS n, a.p - b.p AS d, sqrt(a.p * (1 - a.p) / a.n + b.p * (1 - b.p) / b.n) AS se FROM g a, g b WHERE a.urgent AND NOT b.urgent)
SELECT mode, n, round(d, 12) AS difference, round(se, 12) AS se, CASE mode WHEN 'twotail' THEN abs(d / se) >= 1.959963984540054 WHEN 'ge' THEN d / se >= 1.6448536269514722 ELSE d / se <= -1.6448536269514722 END AS reject
FROM d, (VALUES ('twotail'), ('ge'), ('le')) AS t(mode)
""")
def two_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test of two shares: counts in Spark, scalars on the driver."""
    rows = table(spark, sf_dir, "orders").withColumn("done", (F.col("o_orderstatus") == "F").cast("int")).withColumn("urgent", F.col("o_orderpriority") == "1-URGENT")
    found = {r.urgent: r for r in proportions.counts(rows, "urgent", "done").collect()}
    a, b = (proportions.proportion(found[k].n, found[k].successes) if k in found else proportions.proportion(0, 0) for k in (True, False))
    out = [(m, d.n, round(d.p, 12), round(d.se, 12), d.reject) for m in ("twotail", "ge", "le") for d in [proportions.difference(a, b, m)]]
    return spark.createDataFrame(out, "mode string, n long, difference double, se double, reject boolean")


_PROFILE = "SELECT '{0}' AS name, '{1}' AS dtype, avg(CASE WHEN {0} IS NULL THEN 1.0 ELSE 0.0 END) AS null_share, CAST(count(DISTINCT {0}) AS DOUBLE) / count(*) AS distinct_share, CAST(min({0}) AS VARCHAR) AS min, CAST(max({0}) AS VARCHAR) AS max FROM orders"


@query(" UNION ALL ".join(_PROFILE.format(c, kind) for c, kind in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_orderpriority", "string"))))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns but the price and the date, which the two engines write differently."""
    from .plans.classifiers import profile

    return profile(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN date_trunc('day', o_orderdate) END AS stamp FROM orders
""")
def file_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days read back from file names; names of every seventh order carry no date that exists."""
    day = F.when(F.col("o_orderkey") % 7 == 0, "20240231").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", C.stamp_in_name(F.concat(F.lit("landing/matches_"), day, F.lit(".csv"))).alias("stamp"))


# --- files and streams ----------------------------------------------------------------------------------------------


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS champion_id, c_name || CASE c_custkey % 4 WHEN 0 THEN ', "the ' || c_mktsegment || '"' WHEN 1 THEN E'\\nof ' || c_mktsegment || E',\\n"' ELSE '' END AS champion_name, 'League Static Data' AS rsrc, TRUE AS numbered FROM customer
""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV export with quotes, commas and line breaks in its fields, read back as raw rows with load columns. Part
    files are sorted, so the row numbers of a file go with its keys."""
    folder, key = scratch(spark), F.col("c_custkey")
    more = F.when(key % 4 == 0, F.concat(F.lit(', "the '), "c_mktsegment", F.lit('"'))).when(key % 4 == 1, F.concat(F.lit("\nof "), "c_mktsegment", F.lit(',\n"'))).otherwise("")
    rows = table(spark, sf_dir, "customer").select(key.alias("champion_id"), F.concat("c_name", more).alias("champion_name"))
    landing.export_csv(rows.repartitionByRange(4, "champion_id").sortWithinPartitions("champion_id"), folder)
    back, _ = landing.read_csv(spark, folder, "champions_ref", pattern="part-*")
    place = F.row_number().over(Window.partitionBy("file_name").orderBy(F.col("champion_id").cast("bigint")))
    return back.select("champion_id", "champion_name", "rsrc", (place == F.col("file_row_number")).alias("numbered"))


@query("""
SELECT o_orderstatus AS status, o_orderstatus <> 'P' AS loaded, CASE WHEN o_orderstatus <> 'P' THEN count(*) END AS row_count, TRUE AS has_bytes FROM orders GROUP BY o_orderstatus UNION ALL SELECT 'empty', FALSE, NULL, FALSE
""")
def unloaded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of orders by status and an empty one; those of partial orders have not been loaded yet."""
    folder, orders = scratch(spark), table(spark, sf_dir, "orders")
    named = orders.select(F.col("o_orderkey").alias("champion_id"), F.col("o_orderpriority").alias("champion_name"), F.col("o_orderstatus").alias("status"))
    named.repartition("status").write.partitionBy("status").option("header", True).csv(folder)
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{folder}/status=empty")
    history = None
    for status in ("F", "O"):
        _, report = landing.read_csv(spark, f"{folder}/status={status}", "champions_ref", pattern="part-*")
        history = report if history is None else history.unionByName(report)
    files = landing.listing(spark, folder, "part-*")
    waiting = landing.unloaded(files, history).select("path", F.lit(True).alias("waits"))
    parsed = history.select(landing.same_path(F.col("file_name")).alias("known"), F.col("parsed").alias("row_count"))
    out = files.join(waiting, "path", "left").join(parsed, landing.same_path(F.col("path")) == F.col("known"), "left")
    return out.select(F.regexp_extract("path", "status=([A-Za-z]+)", 1).alias("status"), F.col("waits").isNull().alias("loaded"), "row_count", (F.col("size") > 0).alias("has_bytes"))


@query("SELECT CAST(o_orderkey AS BIGINT) AS champion_id, if(o_orderstatus = 'O', 'LATE ', '') || upper(o_orderpriority) AS champion_name FROM orders")
def stream_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files through both streams: landing to raw parquet to a keyed table. Two files, one of bad rows that is left
    out, then a second batch that has open orders again and counts for them."""
    lake = Lake(spark, scratch(spark))
    orders = table(spark, sf_dir, "orders")
    name = lambda df, text: df.select(F.col("o_orderkey").cast("string").alias("champion_id"), F.concat(F.lit(text), F.col("o_orderpriority")).alias("champion_name"))
    export(lake, name(orders.where("o_orderkey % 2 = 0"), ""), "champions_ref_1")
    export(lake, name(orders.where("o_orderkey % 2 != 0"), ""), "champions_ref_2")
    bad = name(orders, "bad ").withColumns({"one": F.lit("x"), "more": F.lit("y")})
    export(lake, bad, "champions_ref_3")
    refresh(lake, ("champions_ref",))
    export(lake, name(orders.where("o_orderstatus = 'O'"), "late "), "champions_ref_4")
    refresh(lake, ("champions_ref",))
    return lake.silver("champions_ref").read()


@query("""
SELECT o_orderstatus AS stream, CASE o_orderstatus WHEN 'P' THEN 3 ELSE 2 END AS runs, CASE o_orderstatus WHEN 'P' THEN 3 WHEN 'O' THEN 1 ELSE 0 END AS failures, CASE o_orderstatus WHEN 'P' THEN 0 ELSE count(*) END AS rows,
  CASE o_orderstatus WHEN 'P' THEN 3 ELSE 0 END AS failures_in_a_row, o_orderstatus = 'P' AS suspended, o_orderstatus = 'P' AS refused, CASE o_orderstatus WHEN 'P' THEN 'broken P' WHEN 'O' THEN 'broken O' END AS last_error FROM orders GROUP BY o_orderstatus
""")
def stream_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status in streams of their own, and their history. One fails once, one every time: that is refused when
    it starts for the fourth time."""
    folder, broken, refused = scratch(spark), {"O": 1, "P": 9}, []
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").parquet(f"{folder}/orders")
    states = [r[0] for r in orders.select("o_orderstatus").distinct().collect()]
    name = folder.rsplit("/", 1)[-1]
    history = StreamHistory(spark, f"{folder}/history", f"{name}:")

    def start(status: str):
        def take(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/taken/{status}/{number}")
            if broken.get(status, 0):
                broken[status] -= 1
                raise ValueError(f"broken {status}")

        source = spark.readStream.schema("o_orderkey long").parquet(f"{folder}/orders/o_orderstatus={status}")
        return source.writeStream.foreachBatch(take).queryName(f"{name}:{status}").option("checkpointLocation", f"{folder}/checkpoints/{status}").trigger(availableNow=True).start()

    with history.watching():
        for status in states:
            for _ in range(4 if status == "P" else 2):
                try:
                    run_guarded(history, f"{name}:{status}", lambda s=status: start(s))
                except Suspended:
                    refused.append(status)
                except StreamingQueryException:
                    pass
    events = history.events()
    out = stream_summary(events, F.current_timestamp()).join(last_errors(events).select("stream", F.regexp_extract("error", "broken [A-Z]", 0).alias("last_error")), "stream", "left")
    stream = F.substring_index("stream", ":", -1)
    return out.select(stream.alias("stream"), "runs", "failures", "rows", "failures_in_a_row", "suspended", stream.isin(refused).alias("refused"), "last_error")


# the models, cleaning and checks over a season made of these tables
for _module in (season_queries, upkeep_queries):
    QUERIES.update(_module.QUERIES)
    SQL.update(_module.SQL)
