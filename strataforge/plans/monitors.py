"""Reconciliation and audit: layer against layer, refresh history, orphans, and backfill of reference rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import boundaries_between
from ..operators.rows import insert_missing, orphans, top_rows
from ..sources.landing import BACKFILL_SOURCE
from .gold import MODELS, TEAM_MEASURES
from .schemas import ITEM_SLOTS

PLAYER = ["match_id", "participant_pos_id"]
HISTORY = "model string, state string, started_at timestamp_ntz, ended_at timestamp_ntz, n_rows long"


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n) of every table, in one job per table and none on the driver but the plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compared(name: str, actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(check_name, gold_rows, expected_rows, row_diff, status) of two one-row counts (n)."""
    both = actual.select(F.col("n").alias("gold_rows")).crossJoin(expected.select(F.col("n").alias("expected_rows")))
    diff = F.col("gold_rows") - F.col("expected_rows")
    status = F.when(diff == 0, "PASS").when(diff < 0, "ROWS DROPPED").otherwise("MORE ROWS THAN EXPECTED")
    return both.select(F.lit(name).alias("check_name"), "gold_rows", "expected_rows", diff.alias("row_diff"), status.alias("status"))


def _n(df: DataFrame, *distinct: str) -> DataFrame:
    return df.agg((F.count_distinct(*distinct) if distinct else F.count(F.lit(1))).alias("n"))


def expected_rows(gold: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    checks = {
        "matchend_player_stats": _n(silver["players"], *PLAYER), "matchend_pivot_teamstats": _n(silver["intervals"], "match_id"),
        "champion_overviews": _n(silver["champions_ref"].where("champion_id != 0")), "diff_intervals": _n(silver["intervals"]),
    }
    parts = [compared(m.upper(), _n(gold[m]), n) for m, n in checks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def dropped_share(parent: DataFrame, child: DataFrame, keys: list[str]) -> DataFrame:
    """(dropped, total, percent): keys of parent that child lacks."""
    wanted = parent.select(keys).distinct()
    missing = orphans(wanted, child, keys).agg(F.count(F.lit(1)).alias("dropped"))
    both = missing.crossJoin(wanted.agg(F.count(F.lit(1)).alias("total")))
    percent = F.round(F.col("dropped").cast("decimal(20,0)") * 100 / F.nullifzero("total").cast("decimal(20,0)"), 2)
    return both.select("dropped", "total", percent.cast("double").alias("percent"))


def unlogged_matches(matches: DataFrame, intervals: DataFrame) -> DataFrame:
    """Raw matches without any raw interval, with where they came from."""
    return orphans(matches, intervals, ["match_id"]).select("match_id", "file_name", "ldts", "rsrc")


def nameless_items(intervals: DataFrame, items_ref: DataFrame) -> DataFrame:
    """Item ids in use that have no name: not in the reference, or there without one."""
    used = intervals.select(F.explode(F.array_compact(F.array(*ITEM_SLOTS))).alias("item_id")).where("item_id != 0").distinct()
    return used.join(items_ref.select("item_id", "item_name"), "item_id", "left").where("item_name is null").select("item_id").distinct()


def backfill(spark: SparkSession, bronze_items: DataFrame, entries: list[tuple[int, str, str]]) -> DataFrame:
    """Raw rows for hand-made reference entries that are not there yet; a second run has none."""
    rows = spark.createDataFrame([(str(i), name, kind, n) for n, (i, name, kind) in enumerate(entries, 1)], "item_id string, item_name string, item_category string, file_row_number long")
    rows = rows.select("item_id", "item_name", "item_category", F.localtimestamp().alias("ldts"), F.lit("_NULL.csv").alias("file_name"), "file_row_number", F.lit(BACKFILL_SOURCE).alias("rsrc"))
    return insert_missing(bronze_items, rows, ["item_id"])


def side_by_side(sample: DataFrame, full: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """For each row of sample: its values and those of full with the same key."""
    other = full.select(*keys, *[F.col(c).alias(f"full_{c}") for c in columns])
    return sample.select(*keys, *columns).join(other, keys, "left")


def verified_sides(pivot: DataFrame, intervals: DataFrame) -> DataFrame:
    """(match_id, verification) of a pivot of both teams: its values beside the last snapshots of the two teams, side by
    side in one row, which is joined once. MATCH where all are equal, else MISMATCH; matches that lack a team are left out."""
    last = top_rows(intervals, ["match_id", "team"], [F.col("minute").desc_nulls_first(), F.col("participant_pos_id").asc_nulls_last()])
    values = F.struct(*[F.col(f"team_{m}").alias(m) for m in TEAM_MEASURES])
    sides = last.groupBy("match_id").agg(*[F.max(F.when(F.col("team") == side.upper(), values)).alias(f"_{side}") for side in ("blue", "red")])
    joined, same = pivot.join(sides.where("_blue is not null and _red is not null"), "match_id"), F.lit(True)
    for side in ("blue", "red"):
        for m in TEAM_MEASURES:
            same = same & (F.col(f"{side}_{m}") == F.col(f"_{side}.{m}"))
    return joined.select("match_id", F.when(same, "MATCH").otherwise("MISMATCH").alias("verification"))


def random_rows(df: DataFrame, n: int, seed: int, keys: list[str]) -> DataFrame:
    """n rows by the order of a digest of seed and keys: the same ones whenever and wherever it runs."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(seed).cast("string"), *[F.col(k).cast("string") for k in keys])), *keys).limit(n)


def refresh_model(spark: SparkSession, name: str, tables: dict[str, DataFrame], folder: str, history: str, clock=dt.datetime.now) -> DataFrame:
    """Rebuild a model in full, replace its folder, append to the history, and return what was written."""
    from .gold import build

    started = clock()
    target = f"{folder}/{name}"
    try:
        build(name, tables).write.mode("overwrite").parquet(target)
        done, state = spark.read.parquet(target), "SUCCEEDED"
        n = done.count()
    except Exception:
        state, n = "FAILED", None
        raise
    finally:
        spark.createDataFrame([(name, state, started, clock(), n)], HISTORY).write.mode("append").parquet(history)
    return done


def freshness(history: DataFrame, now: Column) -> DataFrame:
    """(model, lag_minutes, target_minutes, status) since the last refresh that succeeded: FRESH or BEHIND."""
    targets = history.sparkSession.createDataFrame([(m, hours * 60) for m, (_, _, hours) in MODELS.items()], "model string, target_minutes long")
    good = top_rows(history.where("state = 'SUCCEEDED'"), ["model"], [F.col("ended_at").desc_nulls_last()])
    lag = boundaries_between("minute", F.col("ended_at"), now)
    out = targets.join(good.select("model", lag.alias("lag_minutes")), "model", "left")
    return out.withColumn("status", F.when(F.col("lag_minutes") <= F.col("target_minutes"), "FRESH").otherwise("BEHIND"))


def run_times(history: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """(model, runs, failures, mean_seconds) of the last hours."""
    seconds = boundaries_between("second", F.col("started_at"), F.col("ended_at"))
    recent = history.where(F.col("started_at") >= now - F.expr(f"interval {hours} hours"))
    return recent.groupBy("model").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("state") != "SUCCEEDED").alias("failures"), F.round(F.avg(seconds), 2).alias("mean_seconds"))


def copy_history(history: DataFrame, table: str, days: int, now: Column) -> DataFrame:
    """(file_name, loaded_at, row_count) of a table's loads in the last days."""
    rows = history.where((F.col("table") == table) & (F.col("loaded_at") >= now - F.expr(f"interval {days} days")))
    return rows.select("file_name", "loaded_at", F.when(F.col("accepted"), F.col("parsed") - F.col("rejected")).otherwise(F.lit(0)).cast("bigint").alias("row_count"))
