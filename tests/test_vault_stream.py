import shutil

import pytest
from pyspark.sql import functions as F

from strataforge import season_queries
from strataforge.plans import vault
from strataforge.season_queries import run_again
from strataforge.streaming.vault_stream import DERIVED, TARGETS, VaultStreams

from .game import season


def staged(spark, minute_shift=0):
    raw = season(spark)["intervals"]
    day = F.lit("2024-05-01").cast("timestamp_ntz") + F.expr(f"interval {minute_shift} minutes")
    return raw.select("*", day.alias("ldts"), F.lit("f").alias("file_name"), F.lit(1).cast("long").alias("file_row_number"), F.lit("r").alias("rsrc"))


def later(rows):
    """The same rows with some states changed, after them."""
    return rows.withColumn("kills", F.when(F.col("player_id") == "3201", F.lit("7")).otherwise(F.col("kills"))).withColumn("ldts", F.col("ldts") + F.expr("interval 1 hour"))


def deliver(streams, *batches):
    for rows in batches:
        rows.write.mode("append").parquet(streams.path("staged"))
        streams.run()


def contents(streams):
    return {t: sorted(map(str, streams.read(t).collect())) for t in TARGETS}


@pytest.fixture(scope="module")
def expected(spark, tmp_path_factory):
    streams = VaultStreams(spark, str(tmp_path_factory.mktemp("plain")))
    deliver(streams, staged(spark), later(staged(spark)))
    return contents(streams)


def test_six_targets_of_two_deliveries(spark, expected):
    rows = staged(spark)
    ids, changed = rows.select("id").distinct().count(), rows.where("player_id = '3201' and kills != '7'").select("id").distinct().count()
    states = vault.with_hashes(rows.unionByName(later(rows))).select("hub_hash", "diff_hash").distinct().count()
    assert changed > 0 and len(expected["hub"]) == ids and len(expected["satellite"]) == states > ids
    assert all(len(expected[t]) == states for t in DERIVED)


def test_batches_that_run_again_change_nothing(spark, tmp_path, expected):
    streams = VaultStreams(spark, str(tmp_path))
    deliver(streams, staged(spark))
    first = contents(streams)
    for stream in ("record", "derive"):
        run_again(streams, stream)
        streams.run()
        assert contents(streams) == first
    deliver(streams, later(staged(spark)))
    for stream in ("derive", "record", "record"):
        run_again(streams, stream)
        streams.run()
    assert contents(streams) == expected


@pytest.mark.parametrize("target", ["hub", "satellite", "kda", "team_objectives"])
def test_failure_in_any_target(spark, tmp_path, expected, target):
    """A batch fails in one of its tables, before or after it has been written; the next start completes it."""
    streams = VaultStreams(spark, str(tmp_path))
    deliver(streams, staged(spark))
    write, failed = streams._write, []

    def once(name, rows, batch):
        write(name, rows, batch)
        if name == target and not failed:
            failed.append(batch)
            raise RuntimeError("lost")

    streams._write = once
    later(staged(spark)).write.mode("append").parquet(streams.path("staged"))
    with pytest.raises(Exception, match="lost"):
        streams.run()
    streams.run()
    assert failed and contents(streams) == expected


def test_new_checkpoints_add_nothing(spark, tmp_path, expected):
    streams = VaultStreams(spark, str(tmp_path))
    deliver(streams, staged(spark), later(staged(spark)))
    shutil.rmtree(streams.path("checkpoints"))
    streams.run()
    assert contents(streams) == expected


def test_one_delivery_in_many_batches(spark, tmp_path):
    """Files one by one, as many batches, give the states of one batch."""
    one, many = (VaultStreams(spark, f"{tmp_path}/{x}") for x in ("one", "many"))
    rows = staged(spark).unionByName(later(staged(spark))).repartition(3)
    for streams, at_once in ((one, None), (many, 1)):
        rows.write.parquet(streams.path("staged"))
        streams.run(files_at_once=at_once)
    a, b = ({t: sorted(map(str, s.read(t).drop("ldts").collect())) for t in TARGETS} for s in (one, many))
    assert a == b


def test_nothing_yet(spark, tmp_path):
    streams = VaultStreams(spark, str(tmp_path))
    assert all(streams.read(t).count() == 0 for t in TARGETS) and streams.summary().count() == 0


def test_a_batch_that_has_written_all_is_left_as_it_is(spark, tmp_path, expected):
    streams = VaultStreams(spark, str(tmp_path))
    deliver(streams, staged(spark), later(staged(spark)))
    written = []
    streams._write = lambda name, rows, batch: written.append(name)
    for stream in ("record", "derive"):
        run_again(streams, stream)
    streams.run()
    assert written == [] and contents(streams) == expected


@pytest.mark.parametrize("small", [True, False])
def test_few_and_many_staged_rows_give_the_same(spark, small):
    """Digests may be null; a key that comes several times counts with its earliest row, whichever way target is read."""
    rows = vault.with_hashes(staged(spark).unionByName(later(staged(spark))))
    rows = rows.unionByName(rows.limit(1).withColumn("hub_hash", F.lit(None).cast("binary")))
    hub = vault.new_hub_rows(rows.limit(0), rows.where("minute != '10'"), small)
    more = vault.new_hub_rows(hub, rows, small)
    keys = [r[0] for r in hub.unionByName(more).select("hub_hash").collect()]
    assert None in keys and len(keys) == len(set(keys)) == rows.select("hub_hash").distinct().count()
    assert hub.unionByName(more).where("hub_hash is not null").join(later(staged(spark)), ["id", "ldts"], "left_semi").count() == 0


def test_staged_rows_and_known_keys_move_once(spark):
    rows = staged(spark)
    known = vault.with_hashes(rows)
    for fresh in (vault.new_hub_rows(known, later(rows)), vault.new_states(known, later(rows))):
        plan = fresh._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression") == 1 and "Join" not in plan
    assert vault.new_states(known, rows).count() == 0 and vault.new_hub_rows(known, later(rows)).count() == 0
    a, b = (sorted(map(str, vault.new_states(known, x).collect())) for x in (later(rows), vault.with_hashes(later(rows))))
    assert a == b != []


def test_hub_and_satellite_are_read_without_deriving(spark, data, monkeypatch):
    started = []
    derive = VaultStreams.derive
    monkeypatch.setattr(VaultStreams, "derive", lambda self, **kw: started.append(1) or derive(self, **kw))
    monkeypatch.setattr(season_queries, "_RUNS", {})
    monkeypatch.setattr(season_queries, "_DERIVED", set())
    hub = season_queries.QUERIES["vault_hub"](spark, data).count()
    assert hub > 0 and season_queries.QUERIES["vault_satellite"](spark, data).count() > hub and started == []
    assert season_queries.QUERIES["vault_kda"](spark, data).count() > hub and started


def test_a_derived_table_by_its_own_stream(spark, tmp_path, expected):
    """Each table filled by itself is as all four filled together, run again or not, and is not filled in both ways."""
    streams = VaultStreams(spark, str(tmp_path))
    for rows in (staged(spark), later(staged(spark))):
        rows.write.mode("append").parquet(streams.path("staged"))
        streams.record().awaitTermination()
        for target in DERIVED:
            streams.derive(target=target).awaitTermination()
            run_again(streams, streams.derive_name(target))
            streams.derive(target=target).awaitTermination()
    assert contents(streams) == expected
    shutil.rmtree(streams.path("checkpoints", streams.derive_name("items")))
    streams.derive(target="items").awaitTermination()
    assert contents(streams) == expected
    with pytest.raises(ValueError, match="not both"):
        streams.derive()


def test_a_derived_table_reads_its_own_columns(spark, tmp_path):
    streams = VaultStreams(spark, str(tmp_path))
    rows = vault.numbered(spark.createDataFrame([], TARGETS["satellite"]), spark.createDataFrame([], TARGETS["hub"]), vault.DERIVED["items"])
    assert vault.derived(rows, ("items",))["items"].columns == [*vault.HUB, *vault.DERIVED["items"]]
    staged(spark).write.parquet(streams.path("staged"))
    streams.record().awaitTermination()
    plan = vault.numbered(streams.read("satellite"), streams.read("hub"), vault.DERIVED["items"])._jdf.queryExecution().optimizedPlan().toString()
    assert "item_0" in plan and not any(f"{c}#" in plan.split("Relation")[0] for c in ("kills", "team_kills", "gold_diff"))


def test_only_the_derived_table_asked_for_is_filled(spark, data, monkeypatch):
    monkeypatch.setattr(season_queries, "_RUNS", {})
    monkeypatch.setattr(season_queries, "_DERIVED", set())
    assert season_queries.QUERIES["vault_items"](spark, data).count() > 0
    streams, = season_queries._RUNS.values()
    assert [t for t in DERIVED if streams.read(t).count()] == ["items"]


def moves(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_stored_rows_stay_where_they_are(spark, tmp_path):
    """What compares staged rows with hub and satellite, and joins these, finds its rows in their buckets."""
    streams = VaultStreams(spark, str(tmp_path))
    streams.load("a", [streams.deliver(staged(spark))])
    streams.load("b", [streams.deliver(later(staged(spark)))])
    rows = streams._stored(F.col("target").isin("staged", "satellite")).withColumn("_known", F.col("target") == "satellite")
    hub, satellite = (streams._stored(F.col("target") == t) for t in ("hub", "satellite"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [moves(df) for df in (vault.first_hub_rows(rows), vault.first_states(rows), vault.numbered(satellite, hub), streams.known_states())] == [0] * 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_deliveries_are_as_other_staged_files(spark, tmp_path, expected):
    """A delivery is read where it is, in parts if its files come in parts; one that is repeated adds nothing."""
    streams, parts = (VaultStreams(spark, f"{tmp_path}/{x}") for x in ("whole", "parts"))
    for rows in (staged(spark), later(staged(spark)), staged(spark)):
        streams.deliver(rows)
        parts.deliver(rows)
        streams.run()
        parts.run(files_at_once=2)
    assert contents(streams) == expected == contents(parts)
    again = VaultStreams(spark, f"{tmp_path}/whole")
    assert contents(again) == expected and again._keyed == streams._keyed


def test_states_of_any_text(spark, tmp_path):
    """Nulls, empty texts and those that hold what states are packed with come through as they are."""
    values = [None, "", "a", "\x00", "\x1f", "a\x1fb", "\x00\x1f", "^", " x"]
    rows = staged(spark).limit(1).drop("kills", "item_0", "id").crossJoin(spark.createDataFrame([(f"{i}", a, b) for i, (a, b) in enumerate((a, b) for a in values for b in values)], "id string, kills string, item_0 string"))
    streams = VaultStreams(spark, str(tmp_path))
    streams.load("a", [streams.deliver(rows.unionByName(rows))])
    want = vault.with_hashes(rows).select("hub_hash", "diff_hash", *vault.STATE)
    got = streams.read("satellite").select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    streams.load("b", [streams.deliver(rows.withColumn("id", F.concat(F.lit(" "), "id")))])
    assert streams.read("satellite").count() == streams.read("hub").count() == len(values) ** 2


def test_combat_moves_no_rows(spark, data):
    assert moves(season_queries.QUERIES["vault_combat"](spark, data)) == 0
