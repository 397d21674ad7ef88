"""Schemas and keys of the raw (bronze) and cleaned (silver) tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(text: str) -> T.StructType:
    kinds = {"s": T.StringType(), "l": T.LongType(), "t": T.TimestampNTZType(), "a": T.ArrayType(T.LongType())}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in (x.split(":") for x in text.split())])


def _all_text(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


# Column names of the source files, in file order.
RAW = {
    "matches": _all_text("match_id game_duration patch_version winning_team game_date game_version game_mode queue_id region average_rank blue_bans red_bans"),
    "players": _all_text("id match_id participant_id team_id champion role individual_position"),
    "items_ref": _all_text("item_id item_name item_category"),
    "champions_ref": _all_text("champion_id champion_name"),
    "intervals": _all_text(
        "id match_id player_id minute current_gold total_gold cs jungle_cs xp level kills deaths assists item_0 item_1 item_2 item_3 item_4 item_5 item_6 "
        "team_kills team_inhibitors team_towers team_dragons_fire team_dragons_water team_dragons_earth team_dragons_air team_dragons_chemtech team_dragons_hextech "
        "team_dragons team_barons team_void_grubs team_heralds gold_diff xp_diff team_gold_diff"
    ),
}
LOAD_COLUMNS = T.StructType([T.StructField("ldts", T.TimestampNTZType()), T.StructField("file_name", T.StringType()), T.StructField("file_row_number", T.LongType()), T.StructField("rsrc", T.StringType())])
#: The order in which rows of one batch supersede each other.
LOAD_ORDER = ["ldts", "file_name", "file_row_number"]

ITEM_SLOTS = [f"item_{i}" for i in range(7)]
_MEASURES = [f.name for f in RAW["intervals"]][4:]
SILVER = {
    "matches": _struct("match_id:s winning_team:s game_duration:l game_date:t game_version:s average_rank:s blue_bans:a red_bans:a"),
    "players": _struct("match_id:s participant_pos_id:l team:s champion_name:s champion_role:s"),
    "items_ref": _struct("item_id:l item_name:s item_category:s"),
    "champions_ref": _struct("champion_id:l champion_name:s"),
    "intervals": _struct("match_id:s participant_pos_id:l team:s minute:l " + " ".join(f"{c}:l" for c in _MEASURES)),
}
KEYS = {"matches": ["match_id"], "players": ["match_id", "participant_pos_id"], "items_ref": ["item_id"], "champions_ref": ["champion_id"], "intervals": ["match_id", "participant_pos_id", "minute"]}
#: Columns that a cleaned row must have beside its key.
REQUIRED = {"matches": ["winning_team"], "players": ["team"], "items_ref": [], "champions_ref": [], "intervals": ["team"]}
