import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataforge.operators.rows import latest_rows
from strataforge.plans import gold, monitors, proportions, quality, vault
from strataforge.plans.schemas import KEYS, SILVER
from strataforge.plans.silver import clean_intervals, clean_matches, cleaned

from .game import interval, raw, season


@pytest.fixture(scope="module")
def seed(spark):
    return {k: v.withColumn("ldts", F.lit("2024-06-01").cast("timestamp_ntz")).withColumn("file_name", F.lit("f")).withColumn("file_row_number", F.monotonically_increasing_id()) for k, v in season(spark).items()}


@pytest.fixture(scope="module")
def silver(seed):
    return {t: latest_rows(cleaned(t, seed[t]), KEYS[t], ["ldts", "file_name", "file_row_number"]).select(SILVER[t].names).cache() for t in SILVER}


@pytest.fixture(scope="module")
def models(silver):
    return {m: gold.build(m, silver).cache() for m in gold.MODELS}


def rows(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def test_clean_matches(spark, seed):
    got = {r.match_id: r for r in clean_matches(seed["matches"], F.lit("2024-06-01").cast("timestamp_ntz")).collect() if r.match_id}
    assert (got["NA_1"].winning_team, got["NA_1"].game_duration, got["NA_1"].average_rank, got["NA_1"].blue_bans) == ("BLUE", 1830, "Gold Iv", [12, 0, None])
    assert got["NA_2"].game_date == dt.datetime(2024, 5, 2, 10) and got["NA_2"].red_bans is None
    assert got["NA_3"].game_duration is None and got["NA_3"].game_date is None and got["NA_4"].winning_team is None and got["NA_4"].game_date is None


def test_clean_matches_not_after_now(seed):
    got = {r.match_id: r.game_date for r in clean_matches(seed["matches"], F.lit("2024-05-01 12:00:00").cast("timestamp_ntz")).collect()}
    assert got["NA_1"] is not None and got["NA_2"] is None


def test_clean_intervals(spark):
    cases = [interval("m", p, m) for p, m in ((3210, 2), (3156, 3), (0, 8), (1, 12))]
    got = rows(clean_intervals(raw(spark, "intervals", cases)), "participant_pos_id", "team", "minute", "item_0")
    assert got == [(0, None, 10, None), (1, "BLUE", 10, None), (10, "RED", 0, None), (6, "RED", 5, None)]


def test_required_columns_and_keys(silver):
    assert rows(silver["matches"], "match_id") == [("NA_1",), ("NA_2",), ("NA_3",)]
    assert silver["players"].count() == 31  # a position of 11 goes
    assert rows(silver["players"].where("match_id = 'NA_1' and participant_pos_id in (4, 5)"), "champion_role") == [("JUNGLE",), ("SUPPORT",)]
    assert silver["intervals"].count() == 2 * 10 * 3  # minutes 8 and 12 are both 10


def test_player_stats(models):
    stats = models["matchend_player_stats"]
    one = stats.where("match_id = 'NA_1' and participant_pos_id = 1").first()
    assert (one.game_duration, one.team, one.win, one.kills, one.cs, one.total_gold) == (1830, "BLUE", True, 7, 30, 2900)
    assert one.item_build == ["Anti-Magic Rod", "B.F. Sword", "Doran's Blade", "Warding Totem"] and one.unlogged_duration == 30
    assert stats.where("win").count() == stats.where("not win").count() == 10


def test_builds_without_names(spark, silver):
    bare = silver["intervals"].where("match_id = 'NA_1' and participant_pos_id = 2").withColumns({f"item_{i}": F.lit(None).cast("long") for i in range(7)})
    unknown = bare.withColumn("item_0", F.lit(77).cast("long"))
    build = lambda df: gold.matchend_player_stats(df, silver["matches"], silver["players"], silver["items_ref"]).first().item_build
    assert build(bare) is None and build(unknown) == []


def test_champion_intervals(models):
    assert models["champion_intervals"].where("minute = 30").count() == 3
    one = models["champion_intervals"].where("champion_name = 'CHAMP1' and minute = 30").first()
    assert one.rows_sampled == 8 and one.avg_cumu_kills == 7.0 and one.avg_cumu_assists == 5.5


def test_overviews(models):
    got = {r.champion_id: r for r in models["champion_overviews"].collect()}
    assert set(got) == {7, 12, 13, 14}
    assert got[12].global_ban_rate == 0.3333 and got[7].global_ban_rate == 0.6667  # banned twice in a match counts once
    assert got[14].global_games_played == 0 and got[14].global_win_rate is None and got[14].most_picked_lane is None
    assert got[12].global_games_played == 12 and got[12].global_pick_rate == 4.0 and got[12].global_win_rate == 0.5 and got[12].most_picked_lane == "JUNGLE"


def test_lane_ties(spark):
    counts = spark.createDataFrame([("a", "TOP", 2), ("a", "MID", 2), ("b", None, 1), ("b", "TOP", 1)], "k string, v string, n long")
    assert rows(gold.mode_of(counts, ["k"], "v"), "k", "v") == [("a", "MID"), ("b", "TOP")]


def test_pivot(models):
    got = {r.match_id: r for r in models["matchend_pivot_teamstats"].collect()}
    assert set(got) == {"NA_1", "NA_2"}
    assert (got["NA_1"].blue_kills, got["NA_1"].red_kills, got["NA_1"].winning_gold_diff, got["NA_1"].unlogged_duration) == (29, 1, -50, 30)
    assert got["NA_2"].winning_gold_diff == 50 and got["NA_2"].unlogged_duration == 0


def test_recommendations(models):
    got = {(r.champion_name, r.item_name): r for r in models["item_recommendations"].collect()}
    low = got["CHAMP1", "Anti-Magic Rod"]
    assert {low.top_item_1, low.top_item_2} == {"B.F. Sword", "Doran's Blade"} and low.top_item_3 is None
    assert got["CHAMP1", "B.F. Sword"].top_item_1 == "Doran's Blade" and got["CHAMP1", "B.F. Sword"].top_item_2 is None
    assert low.player_purchase_rate == 1.0 and low.most_common_first_purchase_minute == 0 and got["CHAMP1", "Warding Totem"].most_common_first_purchase_minute == 10


def test_duplicate_items_count_twice(spark):
    items = spark.createDataFrame([("c", 1, "A", 1), ("c", 1, "A", 1), ("c", 2, "B", 2)], "champion string, item_id long, item_name string, tier int").withColumn("basket", F.lit(1))
    assert rows(gold.companions(items, ["champion"], ["basket"]), "item_id", "top_item_1") == [(1, "B")]


def test_comments(models):
    assert models["champion_overviews"].schema["global_ban_rate"].metadata["comment"].startswith("Share of matches")


def test_diffs(models, silver):
    assert models["diff_intervals"].count() == silver["intervals"].count()


def history(spark, bad=None):
    return spark.createDataFrame([(m, "FAILED" if m == bad else "SUCCEEDED", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 0, 0, 5), 1) for m in gold.MODELS] + [(m, "FAILED", None, None, None) for m in gold.MODELS], monitors.HISTORY)


def test_checks(spark, models, silver):
    failed = quality.all_failures(models, silver, history(spark, "champion_overviews")).cache()
    report = {r.check_id: r for r in quality.report(spark, failed).collect()}
    assert set(report) == {*range(1, 9), 99}
    assert report[1].status == "FAIL" and report[1].n_failures == 5
    assert report[2].status == "PASS" and report[4].status == "PASS" and report[7].status == "PASS"
    assert report[3].n_failures == 10 + 1 + 1  # the players of na_3, the stray one, and match na_3
    assert report[5].n_failures == 3 and report[5].sample_offenders.count("CHAMPION_OVERVIEWS:") == 3  # pick rates of 4 in 3 matches
    assert report[8].status == "FAIL" and report[8].sample_offenders == "CHAMPION_OVERVIEWS:CHAMPION_OVERVIEWS"
    assert report[99].status == "FAIL" and report[99].check_name == "OVERALL: FAIL"


@pytest.mark.parametrize("model,column,value", [("matchend_player_stats", "level", 21), ("champion_intervals", "avg_level", 0.0), ("champion_overviews", "global_ban_rate", 1.5), ("matchend_pivot_teamstats", "blue_kills", None), ("item_recommendations", "win_rate", -0.1)])
def test_each_rule_of_values(spark, models, model, column, value):
    broken = {**models, model: models[model].withColumn(column, F.lit(value).cast(models[model].schema[column].dataType))}
    assert any(f.where(F.col("model") == model.upper()).count() == models[model].count() for f in quality.logical_values(broken))


def test_duplicates_and_review(spark, models):
    twice = models["champion_overviews"].union(models["champion_overviews"])
    assert quality.repeated(twice, "champion_overviews", ["champion_id"]).count() == 4
    odd = models["champion_overviews"].withColumn("global_games_played", F.lit(30).cast("long")).withColumn("global_win_rate", F.lit(0.61))
    assert quality.win_rates(odd).count() == 4
    assert quality.win_balance(models["matchend_player_stats"].where("win")).first().detail.startswith("avg_win=1.0")


def test_monitors(spark, seed, silver, models):
    counts = {r.check_name: r for r in monitors.expected_rows(models, silver).collect()}
    assert counts["MATCHEND_PLAYER_STATS"].status == "ROWS DROPPED" and counts["MATCHEND_PIVOT_TEAMSTATS"].status == "PASS"
    assert tuple(monitors.dropped_share(silver["matches"], models["matchend_pivot_teamstats"], ["match_id"]).first()) == (1, 3, 33.33)
    unlogged = monitors.unlogged_matches(seed["matches"].withColumn("rsrc", F.lit("r")), seed["intervals"])
    assert rows(unlogged.where("match_id is not null"), "match_id") == [("na_3",), ("na_4",)]
    assert monitors.nameless_items(silver["intervals"].withColumn("item_5", F.lit(77).cast("long")), silver["items_ref"]).first().item_id == 77


def test_backfill_twice(spark, seed):
    target = seed["items_ref"].withColumn("rsrc", F.lit("r"))
    new = monitors.backfill(spark, target, [(1, "there", "Basic"), (50, "New", "Basic")])
    assert rows(new, "item_id", "rsrc") == [("50", "Manual backfill")]
    assert monitors.backfill(spark, target.unionByName(new), [(50, "New", "Basic")]).count() == 0


def test_freshness_and_refresh(spark, silver, tmp_path):
    done = monitors.refresh_model(spark, "champion_overviews", silver, f"{tmp_path}/gold", f"{tmp_path}/history")
    assert done.count() == 4
    log = spark.read.parquet(f"{tmp_path}/history")
    now = F.lit(log.first().ended_at + dt.timedelta(minutes=61))
    got = {r.model: r for r in monitors.freshness(log, now).collect()}
    assert got["champion_overviews"].status == "FRESH" and got["diff_intervals"].status == "BEHIND"
    assert monitors.run_times(log, now).first().failures == 0


def test_vault(spark, seed):
    staged = seed["intervals"].withColumn("rsrc", F.lit("r"))
    hashed = vault.with_hashes(staged)
    empty_hub, empty_sat = vault.new_hub_rows(hashed.limit(0).select("hub_hash", *vault.HUB, "ldts", "rsrc"), hashed), vault.new_states(hashed.limit(0).select("hub_hash", "ldts", "rsrc", *vault.STATE, "diff_hash"), hashed)
    assert empty_hub.count() == empty_sat.count() == staged.count()
    changed = staged.limit(1).withColumn("kills", F.lit("99"))
    keys, states, parts = vault.load_batch(empty_hub, empty_sat, changed)
    assert keys.count() == 0 and states.count() == 1 and parts["kda"].first().kda_ratio is not None
    back = vault.new_states(empty_sat.unionByName(states), vault.with_hashes(staged))
    assert back.count() == 0  # a value that returns is not recorded again
    all_parts = vault.partitions(empty_sat, empty_hub)
    summary = vault.player_summary(all_parts["kda"], all_parts["economy"]).where("player_id = '3201' and match_id = 'na_1'").first()
    assert summary.game_duration == 29 and summary.final_kills == 7 and float(summary.gold_per_min) == 100.0


def test_feats(spark):
    schema = "match_id string, team string, minute long, team_kills long, team_towers long, epic_monsters long, winning_team string"
    data = [("a", "BLUE", 5, 3, 0, 0, "BLUE"), ("a", "BLUE", 10, 3, 1, 0, "BLUE"), ("a", "RED", 15, 3, 1, 3, "BLUE"), ("b", "BLUE", 5, 0, 0, 0, "RED"), ("b", "RED", 5, 3, 0, 0, "RED"), ("c", "BLUE", 5, 3, 1, 0, "RED"), ("c", "RED", 5, 3, 1, 0, "RED"), ("d", "RED", 5, 3, 1, 0, "BLUE"), ("d", "BLUE", 5, 0, 0, 0, "BLUE")]
    df = spark.createDataFrame(data, schema)
    assert rows(proportions.first_team(df), "match_id", "outcome", "team_with_feat") == [("a", "RESOLVED", "BLUE"), ("b", "NO_QUALIFIER", None), ("c", "TIE", None), ("d", "RESOLVED", "RED")]
    assert rows(proportions.team_level(df), "match_id", "team", "has_feat", "is_winner") == [("a", "BLUE", True, 1), ("a", "RED", False, 0), ("d", "BLUE", False, 1), ("d", "RED", True, 0)]
    with_, without, _ = proportions.feat_test(df)
    assert (with_.n, with_.p, without.n, without.p) == (2, 0.5, 2, 0.5)


@pytest.mark.parametrize("n,p,diff,se,p_value", [(32208, 0.567933, 0.135867, 0.003904, 1.995e-20), (1303, 0.588642, 0.177283, 0.019279, 3.052e-5)])
def test_published_numbers(n, p, diff, se, p_value):
    a, b = proportions.proportion(n, p * n), proportions.proportion(n, (1 - p) * n)
    got = proportions.difference(a, b, "ge", offset=0.10)
    assert got.p == pytest.approx(diff, abs=2e-6) and got.se == pytest.approx(se, abs=1e-6) and got.p_value == pytest.approx(p_value, rel=0.01)


def test_modes():
    a, b = proportions.proportion(100, 60), proportions.proportion(100, 50)
    two, le = proportions.difference(a, b), proportions.difference(a, b, "le")
    assert two.low < two.p < two.high and le.low == float("-inf") and le.high > le.p and le.p_value > 0.9
    with pytest.raises(ValueError):
        proportions.difference(a, b, "other")


def test_classifiers(spark):
    from strataforge.plans.classifiers import compare, profile

    df = spark.range(400).select((F.col("id") % 2).cast("string").alias("rank"), (F.col("id") % 2 * 10 + F.rand(1)).alias("gold"), F.rand(2).alias("noise"))
    got = compare(df, "rank", ["gold", "noise"], standard=["gold"], min_max=["noise"], folds=3)
    assert got.count() == 9 and got.agg(F.min("accuracy")).first()[0] > 0.95
    assert profile(df).where("name = 'rank'").first().distinct_share == 2 / 400


def test_snapshots_move_once(spark, data):
    """Cleaned snapshots are sent to other tasks once, whichever of their rows a query then looks for."""
    from strataforge.queries import QUERIES
    from strataforge.season import silver_tables

    for name in ("feat_outcomes", "pivot_verification"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression [match_id") == (1 if name == "feat_outcomes" else 2), plan
    silver = silver_tables(spark, data)
    joined = silver["intervals"].join(silver["players"], ["match_id", "participant_pos_id"])._jdf.queryExecution().executedPlan().toString()
    assert joined.count("Exchange hashpartitioning(match_id") == 2  # one for either table, for its keys and the join


def test_stored_tables_of_players_are_joined_where_they_are(spark, data):
    from strataforge.season import silver_tables, stored

    tables = stored({t: df for t, df in silver_tables(spark, data).items() if t in ("intervals", "players")}, spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gold.diff_intervals(tables["intervals"], tables["players"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" in plan and "Exchange" not in plan


def test_the_report_stores_what_its_checks_read(spark, data, monkeypatch):
    from strataforge import season_queries as q

    kept, store = {}, q.stored
    monkeypatch.setattr(q, "stored", lambda tables, s: kept.update(tables) or store(tables, s))
    total = q.dq_report(spark, data).where("check_id < 99").agg({"n_failures": "sum"}).first()[0]
    assert "diff_intervals" not in kept and not set(q.UNCHECKED) & set(kept["intervals"].columns) and set(q.quality.MODEL_KEYS) < set(kept)
    assert kept["failures"].count() == total > 0
