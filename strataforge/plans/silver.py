"""Cleaning: raw text rows to typed rows. Each function keeps the load columns, which decide between rows of one key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import parse_timestamp, safe_int, title_case, valid_range
from .schemas import ITEM_SLOTS, KEYS, LOAD_ORDER, REQUIRED, SILVER

# Bounds of plausible values; a value outside is null.
MAX_DURATION = 3 * 60 * 60
FIRST_DATE = "2009-10-27"
RANGES = {
    "total_gold": 10**9, "xp": 10**9, "cs": 10**4, "jungle_cs": 10**4, "level": 20, "kills": 10**3, "deaths": 10**3, "assists": 10**3,
    "team_kills": 10**4, "team_inhibitors": 100, "team_towers": 100, "team_dragons_fire": 4, "team_dragons_water": 4, "team_dragons_earth": 4,
    "team_dragons_air": 4, "team_dragons_chemtech": 4, "team_dragons_hextech": 4, "team_dragons": 100, "team_barons": 100, "team_void_grubs": 100, "team_heralds": 100,
}


def side(code: Column) -> Column:
    return F.when(code == "100", "BLUE").when(code == "200", "RED")


def _bans(text: Column) -> Column:
    number = lambda x: x.try_cast("decimal(38,0)").try_cast("bigint")
    return F.transform(F.split(text, ","), lambda x: F.when(number(F.trim(x)) == -1, F.lit(0)).otherwise(number(F.trim(x))))


def clean_matches(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """as_of bounds dates from above; the time of the run by default."""
    last = F.localtimestamp() if as_of is None else as_of
    return raw.select(
        F.upper("match_id").alias("match_id"), side(F.col("winning_team")).alias("winning_team"),
        valid_range(safe_int(F.col("game_duration")), 0, MAX_DURATION).alias("game_duration"),
        valid_range(parse_timestamp(F.col("game_date")), F.lit(FIRST_DATE).cast("timestamp_ntz"), last).alias("game_date"),
        "game_version", title_case(F.col("average_rank")).alias("average_rank"),
        _bans(F.col("blue_bans")).alias("blue_bans"), _bans(F.col("red_bans")).alias("red_bans"), *_load(raw),
    )


def clean_players(raw: DataFrame) -> DataFrame:
    role = F.upper("role")
    return raw.select(
        F.upper("match_id").alias("match_id"), valid_range(safe_int(F.col("participant_id")), 1, 10).alias("participant_pos_id"), side(F.col("team_id")).alias("team"),
        F.upper("champion").alias("champion_name"), F.when(role == "UTILITY", "SUPPORT").otherwise(role).alias("champion_role"), *_load(raw),
    )


def clean_items_ref(raw: DataFrame) -> DataFrame:
    return raw.select(safe_int(F.col("item_id")).alias("item_id"), title_case(F.col("item_name")).alias("item_name"), title_case(F.col("item_category")).alias("item_category"), *_load(raw))


def clean_champions_ref(raw: DataFrame) -> DataFrame:
    return raw.select(safe_int(F.col("champion_id")).alias("champion_id"), F.upper("champion_name").alias("champion_name"), *_load(raw))


def clean_intervals(raw: DataFrame) -> DataFrame:
    """Positions repeat every ten player ids; 1 to 5 are blue. Minutes go to the nearest multiple of five."""
    position = (safe_int(F.col("player_id")) - 1) % 10 + 1
    minute = (F.round(safe_int(F.col("minute")).cast("decimal(20,0)") / 5, 0) * 5).cast("bigint")
    out = {
        "match_id": F.upper("match_id"), "participant_pos_id": position,
        "team": F.when(position.between(1, 5), "BLUE").when(position.between(6, 10), "RED"), "minute": valid_range(minute, 0, 10**4),
    }
    for name in SILVER["intervals"].names[4:]:
        value = safe_int(F.col(name))
        out[name] = F.nullif(value, F.lit(0)) if name in ITEM_SLOTS else valid_range(value, 0, RANGES[name]) if name in RANGES else value
    return raw.select(*[c.alias(k) for k, c in out.items()], *_load(raw))


def _load(raw: DataFrame) -> list[str]:
    return [c for c in LOAD_ORDER if c in raw.columns]


CLEAN: dict[str, Callable[[DataFrame], DataFrame]] = {"matches": clean_matches, "players": clean_players, "items_ref": clean_items_ref, "champions_ref": clean_champions_ref, "intervals": clean_intervals}


def cleaned(table: str, raw: DataFrame) -> DataFrame:
    """Cleaned rows that have a key and what the table requires."""
    return CLEAN[table](raw).dropna(subset=KEYS[table] + REQUIRED[table])
