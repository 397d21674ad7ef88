"""Data checks of the models: failure rows, and a report of one line per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import strict_least
from ..operators.rows import orphans, top_rows

# Id, name, status when it trips, scope.
CHECKS = (
    (1, "Existence", "FAIL", "all 5"),
    (2, "Record uniqueness", "FAIL", "all 5"),
    (3, "Missing records from parents (orphaned rows)", "FAIL", "M1, M4"),
    (4, "Champions name linked to refs", "FAIL", "M1, M2, M5"),
    (5, "Logical values", "FAIL", "all 5"),
    (6, "Win-rate plausibility", "REVIEW", "M3"),
    (7, "Global win balance", "REVIEW", "M1"),
    (8, "Refresh state", "FAIL", "all 5"),
)
NAMES = {i: name for i, name, _, _ in CHECKS}
MODEL_KEYS = {
    "matchend_player_stats": ["match_id", "participant_pos_id"], "champion_intervals": ["champion_name", "minute"], "champion_overviews": ["champion_id"],
    "matchend_pivot_teamstats": ["match_id"], "item_recommendations": ["champion_name", "item_name"],
}
LEAST_ROWS = 50
SAMPLES = 5


def failures(df: DataFrame, check: int, model: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check_id"), F.lit(NAMES[check]).alias("check_name"), F.lit(model.upper()).alias("model"), key.cast("string").alias("offending_key"), detail.alias("detail"))


def key_text(columns: list[str]) -> Column:
    """Key columns with a bar between; null if one is null."""
    parts = [F.col(c).cast("string") for c in columns]
    return reduce(lambda a, b: F.concat(a, F.lit("|"), b), parts)


def told(*parts) -> Column:
    """Text with values between; null if a value is null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def too_few(df: DataFrame, model: str, floor: int = LEAST_ROWS) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < floor)
    return failures(n, 1, model, F.lit(model.upper()), told("row_count=", F.col("n"), f" < floor={floor}"))


def repeated(df: DataFrame, model: str, keys: list[str]) -> DataFrame:
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return failures(n, 2, model, key_text(keys), told("duplicate_rows=", F.col("n")))


def unmatched(child: DataFrame, parent: DataFrame, model: str, keys: list[str], missing: str, orphan: str) -> DataFrame:
    lost = failures(orphans(parent, child, keys), 3, model, key_text(keys), F.lit(f"missing_from_gold ({missing})"))
    return lost.unionByName(failures(orphans(child, parent, keys), 3, model, key_text(keys), F.lit(f"orphan_in_gold ({orphan})")))


def unresolved(df: DataFrame, ref: DataFrame, model: str) -> DataFrame:
    names = df.select("champion_name").distinct()
    return failures(names.join(ref.select("champion_name").distinct(), "champion_name", "left_anti"), 4, model, F.col("champion_name"), F.lit("unresolved champion name"))


def _outside(column: str, low, high) -> Column:
    return ~F.col(column).between(low, high)


def _any(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _negative(*columns: str) -> Column:
    return strict_least(*[F.col(c) for c in columns]) < 0 if len(columns) > 1 else F.col(columns[0]) < 0


def _or_null(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("<null>"))


def logical_values(gold: dict[str, DataFrame]) -> list[DataFrame]:
    teams = ("BLUE", "RED")
    m1 = _any(_outside("level", 1, 20), _negative("kills", "deaths", "assists", "cs", "total_gold"), _negative("unlogged_duration"), ~F.col("team").isin(*teams))
    d1 = told("level=", F.col("level"), " k=", F.col("kills"), " d=", F.col("deaths"), " a=", F.col("assists"), " cs=", F.col("cs"), " gold=", F.col("total_gold"), " team=", _or_null("team"))
    m2 = _any(_outside("avg_level", 1, 20), _negative("avg_cumu_kills", "avg_cumu_deaths", "avg_cumu_assists", "avg_cumu_cs", "avg_cumu_total_gold"), F.col("rows_sampled") < 1, _negative("minute"))
    d2 = told("avg_level=", F.col("avg_level"), " rows_sampled=", F.col("rows_sampled"), " minute=", F.col("minute"))
    m3 = _any(*[_outside(c, 0, 1) for c in ("global_win_rate", "global_ban_rate", "primary_lane_share", "global_pick_rate")], _negative("global_games_played"))
    d3 = told("pick=", F.col("global_pick_rate"), " win=", _or_null("global_win_rate"), " ban=", F.col("global_ban_rate"), " lane_share=", F.col("primary_lane_share"))
    sides = [f"{t.lower()}_{m}" for m in ("kills", "towers", "inhibitors", "dragons", "void_grubs", "heralds", "barons") for t in teams]
    m4 = _any(~F.col("winning_team").isin(*teams), _negative("game_duration"), _negative("unlogged_duration"), *[F.col(c).isNull() for c in sides], _negative(*sides))
    d4 = told("winning_team=", _or_null("winning_team"), " blue_kills=", _or_null("blue_kills"), " red_kills=", _or_null("red_kills"))
    tops = [F.col(f"top_item_{i}") for i in (1, 2, 3)]
    m5 = _any(_outside("player_purchase_rate", 0, 1), _outside("win_rate", 0, 1), _negative("avg_kda"), _negative("most_common_first_purchase_minute"), tops[0] == tops[1], tops[1] == tops[2], tops[0] == tops[2])
    d5 = told("purchase_rate=", F.col("player_purchase_rate"), " win=", F.col("win_rate"), " kda=", F.col("avg_kda"))
    rules = zip(MODEL_KEYS, ((m1, d1), (m2, d2), (m3, d3), (m4, d4), (m5, d5)), strict=True)
    return [failures(gold[m].where(rule), 5, m, key_text(MODEL_KEYS[m]), detail) for m, (rule, detail) in rules]


def win_rates(overviews: DataFrame) -> DataFrame:
    odd = overviews.where((F.col("global_games_played") >= 30) & _outside("global_win_rate", 0.40, 0.60))
    return failures(odd, 6, "champion_overviews", F.col("champion_id"), told("win_rate=", F.col("global_win_rate"), " games=", F.col("global_games_played")))


def win_balance(stats: DataFrame) -> DataFrame:
    mean = stats.agg(F.avg(F.when(F.col("win"), 1.0).when(~F.col("win"), 0.0)).alias("w")).where(_outside("w", 0.48, 0.52))
    return failures(mean, 7, "matchend_player_stats", F.lit("GLOBAL"), told("avg_win=", F.round("w", 4), " (expected 0.48-0.52)"))


def refresh_states(history: DataFrame) -> DataFrame:
    """history: model, state, started_at. Models whose last refresh did not succeed."""
    last = top_rows(history.where(F.col("model").isin(*MODEL_KEYS)), ["model"], [F.col("started_at").desc_nulls_last(), F.col("state").asc_nulls_last()])
    bad = last.where(~F.col("state").isin("SUCCEEDED"))
    return bad.select(F.lit(8).alias("check_id"), F.lit(NAMES[8]).alias("check_name"), F.upper("model").alias("model"), F.upper("model").alias("offending_key"), told("last_state=", F.col("state")).alias("detail"))


def all_failures(gold: dict[str, DataFrame], silver: dict[str, DataFrame], history: DataFrame) -> DataFrame:
    player, match = MODEL_KEYS["matchend_player_stats"], MODEL_KEYS["matchend_pivot_teamstats"]
    parts = [
        *[too_few(gold[m], m) for m in MODEL_KEYS], *[repeated(gold[m], m, k) for m, k in MODEL_KEYS.items()],
        unmatched(gold["matchend_player_stats"], silver["players"], "matchend_player_stats", player, "no interval snapshot?", "no players_silver parent"),
        unmatched(gold["matchend_pivot_teamstats"], silver["matches"], "matchend_pivot_teamstats", match, "no team interval rows?", "no matches_silver parent"),
        *[unresolved(gold[m], silver["champions_ref"], m) for m in ("matchend_player_stats", "champion_intervals", "item_recommendations")],
        *logical_values(gold), win_rates(gold["champion_overviews"]), win_balance(gold["matchend_player_stats"]), refresh_states(history),
    ]
    return reduce(DataFrame.unionByName, parts)


def report(spark: SparkSession, failed: DataFrame, checks=CHECKS) -> DataFrame:
    """A row per check, with up to five offenders, and row 99 for the whole, which only FAIL turns red."""
    defs = spark.createDataFrame(list(checks), "check_id int, check_name string, trip string, scope string")
    counts = failed.groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))
    few = top_rows(failed.select("check_id", "model", "offending_key"), ["check_id"], [F.col("model").asc_nulls_last(), F.col("offending_key").asc_nulls_last()], SAMPLES)
    named = few.where("offending_key is not null").select("check_id", F.struct("model", "offending_key").alias("x"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: F.concat(x["model"], F.lit(":"), x["offending_key"])), "  |  ")
    sample = named.groupBy("check_id").agg(text.alias("sample_offenders"))
    grid = defs.join(counts, "check_id", "left").join(sample, "check_id", "left")
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    grid = grid.select("check_id", "check_name", "scope", F.when(n == 0, "PASS").otherwise(F.col("trip")).alias("status"), n.alias("n_failures"), "sample_offenders")
    fails, reviews = F.count_if(F.col("status") == "FAIL"), F.count_if(F.col("status") == "REVIEW")
    clean = fails == 0
    total = grid.agg(
        F.lit(99).alias("check_id"), F.when(clean, "OVERALL: PASS").otherwise("OVERALL: FAIL").alias("check_name"), F.lit("").alias("scope"),
        F.when(clean, "PASS").otherwise("FAIL").alias("status"), fails.alias("n_failures"), told("FAILS=", fails, "  REVIEWS=", reviews).alias("sample_offenders"),
    )
    return grid.unionByName(total)
