"""The driver's tables in the shape of the telemetry source: orders as matches, lines as players and snapshots.

Every raw column is text, as in the source files. Keys repeat, values fall out of range, names and references are
missing, so that cleaning, models and checks have something to do. Nothing of a table is left out.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.buckets import many_files
from .operators.rows import upsert
from .plans import gold
from .plans.schemas import KEYS, LOAD_ORDER, RAW, SILVER
from .plans.silver import cleaned

#: By region of a nation.
CATEGORIES = ("Starter", "Basic", "Epic", "Legendary", "Other")
ROLES = ("utility", "jungle", "top", "middle", "bottom")


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share: under spark.checkpoint.dir, or beside the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root}/{uuid.uuid4().hex}"


def stored(tables: dict[str, DataFrame], spark: SparkSession) -> dict[str, DataFrame]:
    """The tables, written once and read from there, for what reads them more than once. Those with players of matches are
    bucketed by them, so that windows by player and joins of such tables need not move them again."""
    folder = scratch(spark)
    database, buckets = f"stored_{folder.rsplit('/', 1)[-1]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_player = {name for name, df in tables.items() if name in ("intervals", "players") and set(gold.PLAYER) <= set(df.columns)}
    if by_player:
        spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/{database}'")

    def store(name: str) -> DataFrame:
        if name in by_player:
            tables[name].write.format("parquet").bucketBy(buckets, *gold.PLAYER).saveAsTable(f"{database}.{name}")
            return spark.table(f"{database}.{name}")
        tables[name].write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    with many_files(spark), ThreadPoolExecutor(len(tables)) as pool:  # they do not wait for each other
        return dict(zip(tables, pool.map(store, tables), strict=True))


def _raw(table: str, rows: DataFrame, values: dict) -> DataFrame:
    columns = [values.get(c, F.lit("0")).cast("string").alias(c) for c in RAW[table].names]
    load = [F.lit("2024-06-01").cast("timestamp_ntz").alias("ldts"), F.lit(f"{table}_20240601.csv").alias("file_name"), values["row"].cast("bigint").alias("file_row_number"), F.lit("season").alias("rsrc")]
    return rows.select(*columns, *load)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    pick = lambda values, index: F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))
    matches = _raw("matches", read("orders"), {
        "match_id": F.concat(F.lit("ord_"), key), "game_duration": F.concat((customer * 37 % 12000).cast("string"), F.lit(".5")), "winning_team": F.when(F.col("o_orderstatus") == "F", "100").when(F.col("o_orderstatus") == "O", "200").otherwise("300"),
        "game_date": F.date_format(F.add_months(F.to_date("o_orderdate"), 17 * 12), "yyyy-MM-dd"), "game_version": F.concat(F.lit("1"), (key % 4).cast("string"), F.lit(".1")), "average_rank": F.lower("o_orderpriority"),
        "blue_bans": F.concat((customer % 25).cast("string"), F.lit(",-1")), "red_bans": F.concat((key % 25).cast("string"), F.lit(",x")), "row": key,
    })
    p, s = F.col("l_partkey").cast("bigint"), F.col("l_suppkey").cast("bigint")
    position, row = F.col("l_linenumber").cast("bigint") + p % 4, p * 1000000 + s
    match = F.concat(F.lit("ord_"), F.col("l_orderkey"))
    players = _raw("players", read("lineitem"), {
        "id": row, "match_id": match, "participant_id": position, "team_id": F.when(position <= 5, "100").otherwise("200"), "champion": F.concat(F.lit("champ"), (s % 40).cast("string")), "role": pick(ROLES, p % 5), "row": row,
    })
    lines = read("lineitem").withColumn("later", F.explode(F.array(F.lit(0), F.lit(10))))
    team = {"kills": 60, "inhibitors": 4, "towers": 12, "dragons": 6, "barons": 3, "void_grubs": 7, "heralds": 2}
    intervals = _raw("intervals", lines, {
        "id": row, "match_id": match, "player_id": 3200 + position, "minute": F.col("l_quantity").cast("bigint") + F.col("later"), "total_gold": p * 10, "cs": p % 300, "jungle_cs": s % 50, "level": 1 + p % 22,
        "kills": p % 12, "deaths": pick((0, 1, 3, 4), s % 4), "assists": p % 9, "item_0": p % 30, "item_1": s % 30, "item_2": (p + s) % 30, "gold_diff": s - 50, "xp_diff": s - 70, "team_gold_diff": p - 500, "row": row,
        **{f"team_{c}": (p + F.col("later")) % n for c, n in team.items()},
    })
    items = _raw("items_ref", read("nation"), {"item_id": F.col("n_nationkey") + 1, "item_name": F.lower("n_name"), "item_category": pick(CATEGORIES, F.col("n_regionkey")), "row": F.col("n_nationkey")})
    k = F.col("k")
    champions = _raw("champions_ref", read("supplier").select((F.col("s_suppkey") % 40).alias("k")).distinct(), {"champion_id": k, "champion_name": F.when(k == 7, "other7").otherwise(F.concat(F.lit("champ"), k.cast("string"))), "row": k})
    return {"matches": matches, "players": players, "items_ref": items, "champions_ref": champions, "intervals": intervals}


def silver_tables(spark: SparkSession, sf_dir: str, by_match: bool = False) -> dict[str, DataFrame]:
    """The cleaned tables. Snapshots and players move once, by player of a match, or by match for what is about teams:
    one row per key, last snapshots and the join of the two find their rows where they are."""
    place = {t: [k for k in KEYS[t] if k == "match_id" or k == "participant_pos_id" and not by_match] for t in ("intervals", "players")}
    out, parts = {}, int(spark.conf.get("spark.sql.shuffle.partitions"))  # as many as buckets of a stored table
    for t, raw in raw_tables(spark, sf_dir).items():
        rows = cleaned(t, raw)
        out[t] = upsert(None, rows.repartition(parts, *place[t]) if t in place else rows, KEYS[t], LOAD_ORDER).select(SILVER[t].names)
    return out


def gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {m: gold.build(m, silver) for m in gold.MODELS}
