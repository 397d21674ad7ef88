"""A small hand-made season: raw rows as text, as the source files have them."""

from strataforge.plans.schemas import RAW


def raw(spark, table, rows):
    """Rows as dicts of the columns that matter; the others are null."""
    names = RAW[table].names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW[table])


def interval(match, player, minute, **values):
    base = dict.fromkeys(RAW["intervals"].names, "0")
    return base | {"id": f"{match}{player}{minute}", "match_id": match, "player_id": str(player), "minute": str(minute), "level": "1"} | {k: str(v) for k, v in values.items()}


ITEMS = [("1", "anti-magic rod", "Basic"), ("2", "b.f. sword", "Legendary"), ("3", "doran's blade", "Legendary"), ("4", "warding totem", "Trinket"), ("9", "old thing", "Legacy")]


def season(spark):
    matches = [
        {"match_id": "na_1", "game_duration": "1830.4", "winning_team": "100", "game_date": "2024-05-01 10:00:00", "game_version": "15.1", "average_rank": "gold iv", "blue_bans": "12,-1,x", "red_bans": "12,7"},
        {"match_id": "na_2", "game_duration": "299", "winning_team": "200", "game_date": "1714644000000", "game_version": "15.2", "average_rank": "SILVER", "blue_bans": "7", "red_bans": None},
        {"match_id": "na_3", "game_duration": "10801", "winning_team": "200", "game_date": "2009-10-26 00:00:00", "game_version": "16.1", "average_rank": None, "blue_bans": "0", "red_bans": "-1"},
        {"match_id": "na_4", "game_duration": "900", "winning_team": "300", "game_date": "soon"},
        {"match_id": None, "game_duration": "900", "winning_team": "100"},
    ]
    players = [{"id": f"{m}{p}", "match_id": m, "participant_id": str(p), "team_id": "100" if p <= 5 else "200", "champion": f"champ{p % 3}", "role": "utility" if p % 5 == 0 else "jungle"} for m in ("na_1", "na_2", "na_3") for p in range(1, 11)]
    players += [{"id": "x", "match_id": "na_1", "participant_id": "11", "team_id": "100", "champion": "a", "role": "top"}, {"id": "y", "match_id": "na_9", "participant_id": "1", "team_id": "100", "champion": "stray", "role": "top"}]
    rows = []
    for m in ("na_1", "na_2"):
        for p in range(1, 11):
            for minute in (2, 8, 12, 29):
                side = "b" if p <= 5 else "r"
                rows.append(interval(m, 3200 + p, minute, kills=minute // 4, deaths=1, assists=p, cs=minute, jungle_cs=p, total_gold=100 * minute, team_kills=minute if side == "b" else 1, team_towers=minute // 10, team_gold_diff=-50 if side == "b" else 50, gold_diff=p, team_dragons=minute // 10, item_0=1, item_1=2 if p % 2 else 0, item_2=3 if p % 2 else 0, item_6=4 if minute > 10 else 0))
    rows.append(interval("na_1", 0, 10))
    champions = [("0", "none"), ("7", "champ0"), ("12", "champ1"), ("13", "champ2"), ("14", "unplayed")]
    return {
        "matches": raw(spark, "matches", matches), "players": raw(spark, "players", players), "intervals": raw(spark, "intervals", rows),
        "items_ref": raw(spark, "items_ref", [dict(zip(RAW["items_ref"].names, x, strict=True)) for x in ITEMS]),
        "champions_ref": raw(spark, "champions_ref", [dict(zip(RAW["champions_ref"].names, x, strict=True)) for x in champions]),
    }
