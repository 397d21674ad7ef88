"""The six analytical models, as pure functions of cleaned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import decimal_mean, decimal_ratio, strict_greatest
from ..operators.rows import top_rows
from .schemas import ITEM_SLOTS

PLAYER = ["match_id", "participant_pos_id"]
#: Matches shorter than this, in seconds, say nothing about winning.
SHORTEST = 300
# Item categories from low to high; others take no part in recommendations.
TIERS = ("Trinket", "Consumable", "Starter", "Basic", "Boots", "Epic", "Legendary")
NO_FIRST_PURCHASE = ("Other", "Legacy", "Distributed")
TEAM_MEASURES = ("kills", "towers", "inhibitors", "dragons", "void_grubs", "heralds", "barons")


def final_snapshot(intervals: DataFrame) -> DataFrame:
    """The last snapshot of every player of a match."""
    return top_rows(intervals, PLAYER, [F.col("minute").desc_nulls_first()])


def _items() -> Column:
    return F.array_compact(F.array(*ITEM_SLOTS))


def _unlogged(minute: str) -> Column:
    return strict_greatest(F.col("game_duration") - F.col(minute) * 60, F.lit(0).cast("bigint"))


def matchend_player_stats(intervals: DataFrame, matches: DataFrame, players: DataFrame, items_ref: DataFrame) -> DataFrame:
    """A row per player of a match, from the last snapshot. No item at all gives a null build, only unknown ones an empty."""
    kept = ["minute", "level", "kills", "deaths", "assists", "cs", "total_gold"]
    last = final_snapshot(intervals.withColumn("cs", F.col("cs") + F.col("jungle_cs")).withColumn("items", _items()).select(*PLAYER, *kept, "items"))
    # snapshots stay where their window has put them: a row per item, its name, and back to a row per player
    slots = last.select(*PLAYER, F.struct(*kept, F.size("items").alias("n_items")).alias("s"), F.explode_outer("items").alias("item_id"))
    named = slots.join(items_ref.select("item_id", "item_name"), "item_id", "left")
    stats = named.groupBy(*PLAYER).agg(F.any_value("s").alias("s"), F.array_sort(F.collect_list("item_name")).alias("names"))
    stats = stats.select(*PLAYER, "s.*", F.when(F.col("s.n_items") > 0, F.col("names")).alias("item_build"))
    who = players.select(*PLAYER, "team", "champion_name", "champion_role")
    joined = stats.join(matches.select("match_id", "game_duration", "winning_team"), "match_id").join(who, PLAYER)
    return joined.select(
        *PLAYER, "game_duration", "team", (F.col("team") == F.col("winning_team")).alias("win"), "champion_name", "champion_role",
        "level", "kills", "deaths", "assists", "cs", "total_gold", "item_build", _unlogged("minute").alias("unlogged_duration"),
    )


def champion_intervals(intervals: DataFrame, players: DataFrame) -> DataFrame:
    rows = intervals.join(players.select(*PLAYER, "champion_name"), PLAYER).withColumn("all_cs", F.col("cs") + F.col("jungle_cs"))
    means = {"avg_level": ("level", 0), "avg_cumu_kills": ("kills", 2), "avg_cumu_deaths": ("deaths", 2), "avg_cumu_assists": ("assists", 2), "avg_cumu_cs": ("all_cs", 0), "avg_cumu_total_gold": ("total_gold", 0)}
    return rows.groupBy("champion_name", "minute").agg(F.count(F.lit(1)).alias("rows_sampled"), *[decimal_mean(F.col(c), d).alias(k) for k, (c, d) in means.items()])


def mode_of(counts: DataFrame, by: list[str], value: str, n: str = "n") -> DataFrame:
    """The value with the highest count per group; the smallest of equals, nulls last."""
    return top_rows(counts, by, [F.col(n).desc_nulls_first(), F.col(value).asc_nulls_last()])


def champion_overviews(matches: DataFrame, players: DataFrame, champions_ref: DataFrame) -> DataFrame:
    played = matches.select("match_id", "winning_team", "game_duration").join(players, "match_id").withColumn("win", F.col("team") == F.col("winning_team"))
    by_role = played.groupBy("champion_name", "champion_role").agg(F.count(F.lit(1)).alias("n"))
    share = by_role.withColumn("all_n", F.sum("n").over(Window.partitionBy("champion_name")))
    lane = mode_of(share, ["champion_name"], "champion_role").select("champion_name", F.col("champion_role").alias("most_picked_lane"), decimal_ratio(F.col("n"), F.col("all_n"), 4).alias("primary_lane_share"))
    picks = by_role.groupBy("champion_name").agg(F.sum("n").alias("picks"))
    wins = played.where((F.col("game_duration") >= SHORTEST) & F.col("win").isNotNull()).groupBy("champion_name").agg(F.count(F.lit(1)).alias("games"), F.count_if("win").alias("wins"))
    banned = matches.select("match_id", F.explode(F.concat(*[F.coalesce(c, F.array().cast("array<bigint>")) for c in ("blue_bans", "red_bans")])).alias("champion_id"))
    bans = banned.where("champion_id != 0").distinct().groupBy("champion_id").agg(F.count(F.lit(1)).alias("bans"))
    total = matches.agg(F.count(F.lit(1)).alias("total"))
    none = F.lit(0).cast("bigint")
    ref = champions_ref.where("champion_id != 0")
    joined = ref.join(picks, "champion_name", "left").join(wins, "champion_name", "left").join(lane, "champion_name", "left").join(bans, "champion_id", "left").crossJoin(total)
    return joined.select(
        "champion_id", "champion_name", "most_picked_lane", "primary_lane_share", F.coalesce("picks", none).alias("global_games_played"),
        decimal_ratio(F.coalesce("picks", none), F.col("total"), 4).alias("global_pick_rate"), decimal_ratio(F.col("wins"), F.col("games"), 4).alias("global_win_rate"),
        decimal_ratio(F.coalesce("bans", none), F.col("total"), 4).alias("global_ban_rate"),
    )


def matchend_pivot_teamstats(intervals: DataFrame, matches: DataFrame) -> DataFrame:
    """A row per match, the teams side by side. Of a team's snapshots of the last minute, that of the first position counts."""
    last = top_rows(intervals, ["match_id", "team"], [F.col("minute").desc_nulls_first(), F.col("participant_pos_id").asc_nulls_last()])
    of = lambda team, measure: F.max(F.when(F.col("team") == team, F.col(measure)))
    sides = [of(team, f"team_{m}").alias(f"{team.lower()}_{m}") for m in TEAM_MEASURES for team in ("BLUE", "RED")]
    gold = [of(team, "team_gold_diff").alias(f"{team.lower()}_gold") for team in ("BLUE", "RED")]
    wide = last.groupBy("match_id").agg(F.max("minute").alias("last_minute"), *sides, *gold)
    diff = F.when(F.col("winning_team") == "BLUE", F.col("blue_gold")).when(F.col("winning_team") == "RED", F.col("red_gold"))
    columns = [f"{team}_{m}" for m in TEAM_MEASURES for team in ("blue", "red")]
    joined = wide.join(matches.select("match_id", "game_duration", "game_date", "game_version", "winning_team", "average_rank"), "match_id")
    return joined.select("match_id", "game_duration", "game_date", "game_version", "winning_team", "average_rank", *columns, diff.alias("winning_gold_diff"), _unlogged("last_minute").alias("unlogged_duration"))


def companions(items: DataFrame, by: list[str], basket: list[str], k: int = 3, names: DataFrame | None = None) -> DataFrame:
    """(by, item_id, top_item_1..k): names of the items most often in one basket with an item, of the same or a higher tier.

    items: by, basket, item_id, item_name, tier. Copies in a basket count each. Pairs are made within a basket's array,
    so no join multiplies the rows of the table. names has item_id and item_name, one row an item; without it they are
    sought among items.
    """
    baskets = items.where("tier is not null").groupBy(*by, *basket).agg(F.collect_list(F.struct("tier", "item_id")).alias("items"))
    pairs = baskets.select(*by, F.explode("items").alias("l"), "items").select(*by, "l", F.explode("items").alias("r")).where("l.item_id != r.item_id and l.tier <= r.tier")
    counts = pairs.groupBy(*by, F.col("l.item_id").alias("item_id"), F.col("r.item_id").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    names = items.select("item_id", "item_name").distinct() if names is None else names
    named = counts.join(names.select(F.col("item_id").alias("other"), F.col("item_name").alias("name")), "other", "left")
    rank = F.row_number().over(Window.partitionBy(*by, "item_id").orderBy(F.col("n").desc_nulls_first(), F.col("name").asc_nulls_last(), F.col("other").asc()))
    top = named.withColumn("rank", rank).where(F.col("rank") <= k)
    return top.groupBy(*by, "item_id").agg(*[F.max(F.when(F.col("rank") == i, F.col("name"))).alias(f"top_item_{i}") for i in range(1, k + 1)])


def first_minutes(intervals: DataFrame, players: DataFrame, items_ref: DataFrame) -> DataFrame:
    """(champion_name, item_id, minute): when an item is most often first seen."""
    ref = items_ref.where(~F.col("item_category").isin(*NO_FIRST_PURCHASE)).select("item_id")
    seen = intervals.select(*PLAYER, "minute", F.explode(_items()).alias("item_id")).join(ref, "item_id")
    first = seen.groupBy(*PLAYER, "item_id").agg(F.min("minute").alias("minute"))
    counts = first.join(players.select(*PLAYER, "champion_name"), PLAYER).groupBy("champion_name", "item_id", "minute").agg(F.count(F.lit(1)).alias("n"))
    return mode_of(counts, ["champion_name", "item_id"], "minute").select("champion_name", "item_id", F.col("minute").alias("most_common_first_purchase_minute"))


def item_recommendations(intervals: DataFrame, matches: DataFrame, players: DataFrame, items_ref: DataFrame) -> DataFrame:
    """A row per champion and item of final builds. A second copy of an item in a build counts again."""
    tier = F.coalesce(*[F.when(F.col("item_category") == t, F.lit(i + 1)) for i, t in enumerate(TIERS)])
    last = final_snapshot(intervals).select(*PLAYER, "kills", "deaths", "assists", _items().alias("items"))
    last = last.join(matches.select("match_id", "winning_team"), "match_id").join(players.select(*PLAYER, "team", "champion_name"), PLAYER)
    last = last.withColumn("win", F.col("team") == F.col("winning_team"))
    ref = items_ref.select("item_id", "item_name", "item_category", tier.alias("tier"))
    items = last.select(*PLAYER, "champion_name", "win", "kills", "deaths", "assists", F.posexplode_outer("items").alias("slot", "item_id"))
    kda = (F.col("kills") + F.col("assists")).cast("decimal(20,0)") / (F.col("deaths") + 1).cast("decimal(20,0)")
    stats = items.groupBy("champion_name", "item_id").agg(F.count(F.lit(1)).alias("bought"), F.sum(F.when(F.col("win"), 1).otherwise(0)).alias("wins"), F.round(F.avg(kda), 2).cast("double").alias("avg_kda"), F.count_if(F.coalesce("slot", F.lit(0)) == 0).alias("first"))
    stats = stats.withColumn("picks", F.sum("first").over(Window.partitionBy("champion_name"))).where("item_id is not null")  # a player's first slot, empty or not, counts the player
    top = companions(items.where("item_id is not null").join(ref, "item_id", "left"), ["champion_name"], PLAYER, names=ref)
    joined = stats.join(ref, "item_id", "left").join(top, ["champion_name", "item_id"], "left").join(first_minutes(intervals, players, items_ref), ["champion_name", "item_id"], "left")
    return joined.where("champion_name is not null and item_name is not null").select(
        "champion_name", "item_name", "item_category", decimal_ratio(F.col("bought"), F.col("picks"), 4).alias("player_purchase_rate"),
        decimal_ratio(F.col("wins"), F.col("bought"), 4).alias("win_rate"), "avg_kda", "most_common_first_purchase_minute", "top_item_1", "top_item_2", "top_item_3",
    )


def diff_intervals(intervals: DataFrame, players: DataFrame) -> DataFrame:
    who = players.select(*PLAYER, "team", "champion_role", "champion_name")
    return intervals.select(*PLAYER, "minute", "gold_diff", "xp_diff").join(who, PLAYER).select(*PLAYER, "minute", "team", "champion_role", "champion_name", "gold_diff", "xp_diff")


#: Name of each model, the tables it needs, and how fresh it is to be kept, in hours.
MODELS = {
    "matchend_player_stats": (matchend_player_stats, ("intervals", "matches", "players", "items_ref"), 24),
    "champion_intervals": (champion_intervals, ("intervals", "players"), 24),
    "champion_overviews": (champion_overviews, ("matches", "players", "champions_ref"), 24),
    "matchend_pivot_teamstats": (matchend_pivot_teamstats, ("intervals", "matches"), 24),
    "item_recommendations": (item_recommendations, ("intervals", "matches", "players", "items_ref"), 168),
    "diff_intervals": (diff_intervals, ("intervals", "players"), 1),
}


#: What columns mean that do not say it themselves; kept as comments of the columns.
DESCRIPTIONS = {
    "match_id": "Match, in upper case",
    "game_duration": "Length of the match in seconds, up to three hours",
    "game_date": "When the match was played",
    "game_version": "Version of the game as the source has it",
    "winning_team": "Side that won",
    "average_rank": "Mean rank of the players, in title case",
    "team": "Side of the player",
    "win": "Whether the player's side won",
    "champion_id": "Number of the champion in the reference",
    "champion_name": "Champion, in upper case",
    "champion_role": "Where the champion was played",
    "minute": "Minute of the snapshot, to the nearest five",
    "level": "Level at the snapshot",
    "kills": "Kills so far",
    "deaths": "Deaths so far",
    "assists": "Assists so far",
    "cs": "Minions and monsters so far, jungle included",
    "total_gold": "Gold earned so far",
    "gold_diff": "Gold ahead of the opponent",
    "xp_diff": "Experience ahead of the opponent",
    "avg_level": "Mean level at the minute",
    **{f"avg_cumu_{c}": f"Mean {c.replace('_', ' ')} so far at the minute" for c in ("kills", "deaths", "assists", "cs", "total_gold")},
    "most_picked_lane": "Role in which the champion is played most",
    "global_games_played": "Games with the champion",
    "global_pick_rate": "Games with the champion per match",
    **{f"{team}_{m}": f"{m.replace('_', ' ').capitalize()} of the {team} side at its last snapshot" for m in TEAM_MEASURES for team in ("blue", "red")},
    "item_name": "Item, in title case",
    "item_category": "Category of the item in the reference",
    "win_rate": "Share of wins among the builds with the item",
    "avg_kda": "Mean of kills and assists per death and one",
    **{f"top_item_{i}": f"Number {i} of the items most often in one build with it, of its tier or above" for i in (1, 2, 3)},
    "participant_pos_id": "Place at queue time: 1 to 5 blue, 6 to 10 red",
    "unlogged_duration": "Seconds between the last snapshot and the end of the match",
    "item_build": "Sorted names of the last items, copies included",
    "rows_sampled": "Snapshots behind the averages",
    "primary_lane_share": "Share of a champion's games in its most frequent lane",
    "global_win_rate": "Wins per game of five minutes or more",
    "global_ban_rate": "Share of matches in which a champion was banned, once a match",
    "winning_gold_diff": "Gold difference of the winner; negative if it was behind",
    "player_purchase_rate": "Copies bought per player of the champion; over 1 with copies",
    "most_common_first_purchase_minute": "Most frequent minute in which the item is first seen",
}


def build(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """A model by name, its columns with their comments."""
    make, needs, _ = MODELS[name]
    out = make(*[tables[t] for t in needs])
    for column in out.columns:
        if column in DESCRIPTIONS:
            out = out.withMetadata(column, {"comment": DESCRIPTIONS[column]})
    return out
