import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strataforge.operators.rows import upsert
from strataforge.operators.keyed import KeyedTable
from strataforge.plans.schemas import KEYS, LOAD_ORDER, RAW, SILVER
from strataforge.plans.silver import cleaned
from strataforge.sources import landing
from strataforge.streaming.pipes import Lake, refresh, run_until_done
from strataforge.streaming.replay import Replay, match_days, unreadable_dates, validate_folder

from .game import season


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_csv_dialect(spark, tmp_path):
    write(tmp_path, "items_ref_1.csv", 'ID,NAME,KIND\n1, padded ,Basic\n2,"a, ""quoted"" one",\n3,NULL,"Boots"\n')
    rows, report = landing.read_csv(spark, str(tmp_path), "items_ref")
    got = [tuple(r) for r in rows.orderBy("file_row_number").select("item_id", "item_name", "item_category", "file_row_number", "rsrc").collect()]
    assert got == [("1", "padded", "Basic", 1, "League Static Data"), ("2", 'a, "quoted" one', None, 2, "League Static Data"), ("3", None, "Boots", 3, "League Static Data")]
    assert report.first().accepted and report.first().parsed == 3


def test_bad_files_are_left_out(spark, tmp_path):
    good = "\n".join(f"{i},n,k" for i in range(20))
    write(tmp_path, "items_ref_a.csv", f"h,h,h\n{good}\nshort\n")
    write(tmp_path, "items_ref_b.csv", f"h,h,h\n{good[:23]}\n1,2,3,4,5\n")
    write(tmp_path, "matches_c.csv", "x\n")
    rows, report = landing.read_csv(spark, str(tmp_path), "items_ref")
    assert {(r.file_name[-5:], r.parsed, r.rejected, r.accepted) for r in report.collect()} == {("a.csv", 21, 1, True), ("b.csv", 5, 1, False)}
    assert rows.count() == 20
    history = report.withColumn("loaded_at", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    assert landing.load_errors(history, F.lit(dt.datetime(2024, 1, 5)).cast("timestamp_ntz")).count() == 2
    assert landing.load_errors(history, F.lit(dt.datetime(2024, 3, 5)).cast("timestamp_ntz")).count() == 0


def test_row_numbers_over_blocks(spark, tmp_path):
    write(tmp_path, "champions_ref.csv", "id,name\n" + "\n".join(f"{i},name {i}" for i in range(3000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows, _ = landing.read_csv(spark, str(tmp_path), "champions_ref")
        assert rows.where("cast(champion_id as long) + 1 != file_row_number").count() == 0 and rows.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_listing_and_lines(spark, tmp_path):
    write(tmp_path, "a_1.csv", "h\n1\n2\n")
    write(tmp_path, "b_1.csv", "")
    assert {(os.path.basename(r.path), r.size) for r in landing.listing(spark, str(tmp_path)).collect()} == {("a_1.csv", 6), ("b_1.csv", 0)}
    assert landing.count_lines(spark, str(tmp_path), "a_*").first().n == 2


def test_quoted_line_breaks(spark, tmp_path):
    """Quotes, commas and line breaks in fields, in files of their own and beside plain ones; rows are counted, not lines."""
    write(tmp_path, "items_ref_1.csv", 'ID,NAME,KIND\n1,"two\nlines, ""quoted""",Basic\n2,plain,"x\n\ny"\n3,last,\n')
    write(tmp_path, "items_ref_2.csv", "ID,NAME,KIND\n" + "".join(f"{i},n{i},k\n" for i in range(50)))
    assert [os.path.basename(r.path) for r in landing.broken_over_lines(spark, str(tmp_path), "items*").collect()] == ["items_ref_1.csv"]
    rows, report = landing.read_csv(spark, str(tmp_path), "items_ref")
    got = {(os.path.basename(r.file_name)[-5], r.file_row_number): (r.item_id, r.item_name, r.item_category) for r in rows.collect()}
    assert got["1", 1] == ("1", 'two\nlines, "quoted"', "Basic") and got["1", 2] == ("2", "plain", "x\n\ny") and got["1", 3] == ("3", "last", None)
    assert all(got["2", i + 1] == (str(i), f"n{i}", "k") for i in range(50)) and len(got) == 53
    assert {(r.parsed, r.rejected, r.accepted) for r in report.collect()} == {(3, 0, True), (50, 0, True)}
    values = [(1, 'a,"b"\n c'), (2, ""), (3, None), (4, '"')]
    landing.export_csv(spark.createDataFrame(values, "id int, name string"), f"{tmp_path}/out")
    back, _ = landing.read_csv(spark, f"{tmp_path}/out", "champions_ref", pattern="part-*")
    assert {r.champion_id: r.champion_name for r in back.where("champion_id < 5").collect()} == {"1": 'a,"b"\n c', "2": None, "3": None, "4": '"'}


def test_unloaded_files(spark, tmp_path):
    write(tmp_path / "in" / "deep", "items_ref_1.csv", "ID,NAME,KIND\n1,a,b\n")
    write(tmp_path / "in", "items_ref_2.csv", "ID,NAME,KIND\n1,a,b\n")
    write(tmp_path / "in", "items_ref_0.csv", "")
    files = landing.listing(spark, f"{tmp_path}/in")
    assert sorted((os.path.basename(r.path), r.size > 0) for r in files.collect()) == [("items_ref_0.csv", False), ("items_ref_1.csv", True), ("items_ref_2.csv", True)]
    _, report = landing.read_csv(spark, f"{tmp_path}/in", "items_ref")
    assert {os.path.basename(r.path) for r in landing.unloaded(files, report).collect()} == {"items_ref_0.csv", "items_ref_1.csv"} and landing.has_data(files, report)
    _, more = landing.read_csv(spark, f"{tmp_path}/in/deep", "items_ref")
    assert not landing.has_data(files, report.unionByName(more)) and landing.has_data(files, report.limit(0))
    assert "content#" not in files._jdf.queryExecution().executedPlan().toString()


def test_upload_guard(spark, tmp_path):
    for name, text in (("matches_1.csv", "h\n"), ("players_1.csv", "h\n"), ("players_2.csv", "h\n"), ("items_ref.csv", "")):
        write(tmp_path, name, text)
    validate_folder(spark, str(tmp_path), ["matches"])
    with pytest.raises(ValueError, match="missing: intervals; more than one: players; empty: items_ref"):
        validate_folder(spark, str(tmp_path), ["matches", "players", "items_ref", "intervals"])


ROW = "k long, v string, day string, at long"


def keyed(spark, tmp_path, **options):
    schema = spark.createDataFrame([], ROW).drop("at").schema
    return KeyedTable(spark, f"{tmp_path}/t", schema, ["k"], F.col("day"), **options)


def put(store, rows):
    store.upsert(store.spark.createDataFrame(rows, ROW), ["at"])


def rows_of(store):
    return sorted(tuple(r) for r in store.read().select("k", "v", "day").collect())


def files_of(tmp_path, day="*"):
    return {str(f): os.stat(f).st_mtime_ns for f in tmp_path.glob(f"t/_day={day}/*.parquet")}


def test_keyed_table(spark, tmp_path):
    """A batch of one day rewrites one partition; the same batch again changes nothing."""
    store = keyed(spark, tmp_path)
    assert rows_of(store) == []
    put(store, [(i, "a", f"2024-05-0{i % 5}", 0) for i in range(20)])
    before = files_of(tmp_path)
    for _ in range(2):
        put(store, [(3, "b", "2024-05-03", 1), (3, "c", "2024-05-03", 2), (30, "new", "2024-05-03", 1), (None, "no key", "2024-05-03", 1)])
        assert rows_of(store) == [*[(i, "c" if i == 3 else "a", f"2024-05-0{i % 5}") for i in range(20)], (30, "new", "2024-05-03")]
    same = {f for f, at in files_of(tmp_path).items() if before.get(f) == at}
    assert same == {f for f in before if "2024-05-03" not in f} and len(same) == len(before) - len([f for f in before if "2024-05-03" in f])
    put(store, [])
    assert len(rows_of(store)) == 21


def test_keyed_rows_that_move(spark, tmp_path):
    """A key that comes with another day leaves its old one, also where nothing is left there, and rows without a day stand apart."""
    store = keyed(spark, tmp_path)
    put(store, [(1, "a", "2024-05-01", 0), (2, "a", "2024-05-02", 0), (3, "a", "2024-05-02", 0), (4, "a", None, 0)])
    put(store, [(1, "b", "2024-05-02", 1), (4, "b", "2024-05-07", 1)])
    assert rows_of(store) == [(1, "b", "2024-05-02"), (2, "a", "2024-05-02"), (3, "a", "2024-05-02"), (4, "b", "2024-05-07")]
    assert not files_of(tmp_path, "2024-05-01") and not files_of(tmp_path, "none")


@pytest.mark.parametrize("moment", ["before the copy", "in the copy", "after the copy", "in the table", "after the table"])
def test_keyed_writer_lost(spark, tmp_path, monkeypatch, moment):
    """A writer is lost at some moment: readers see the table as it was or as it will be, and running the batch again ends well."""
    store = keyed(spark, tmp_path)
    old = [(i, "a", f"2024-05-0{i % 3}", 0) for i in range(9)]
    put(store, old)
    batch = [(0, "b", "2024-05-00", 1), (1, "b", "2024-05-00", 1), (4, "b", "2024-05-00", 1), (7, "b", "2024-05-00", 1), (50, "b", "2024-05-02", 1)]
    want = sorted({**{r[0]: r[:3] for r in old}, **{r[0]: r[:3] for r in batch}}.values())
    write, publish = KeyedTable._write, KeyedTable._publish

    def lost_write(self, rows, touched):
        if moment == "in the copy":
            write(self, rows, touched)
            os.remove(f"{self._pending}/_SUCCESS")
        elif moment != "before the copy":
            return write(self, rows, touched)
        raise RuntimeError("lost")

    def lost_publish(self):
        if moment == "in the table":  # the old day is gone, the new one not there yet
            for f in files_of(tmp_path, "2024-05-00"):
                os.remove(f)
        if moment == "after the table":
            monkeypatch.setattr(KeyedTable, "_delete", lambda self, folder: (_ for _ in ()).throw(RuntimeError("lost")))
            publish(self)
        raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, "_write", lost_write)
    monkeypatch.setattr(KeyedTable, "_publish", lost_publish)
    with pytest.raises(RuntimeError, match="lost"):
        put(store, batch)
    monkeypatch.undo()
    assert rows_of(store) == (sorted(r[:3] for r in old) if moment in ("before the copy", "in the copy") else want)
    for _ in range(2):
        put(keyed(spark, tmp_path), batch)
        assert rows_of(store) == want and not os.path.exists(store._pending)


def test_one_day_of_most_rows(spark, tmp_path):
    """A day that holds most rows is written by several tasks, and reads as it was put."""
    store = keyed(spark, tmp_path, moves=False)
    rows = spark.range(200_000).select(F.col("id").alias("k"), F.repeat(F.lit("v"), 50).alias("v"), F.when(F.col("id") % 10 == 0, "2024-05-02").otherwise("2024-05-01").alias("day"), F.lit(1).alias("at"))
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}  # so that little is much
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        store.upsert(rows, ["at"])
    finally:
        for name in small:
            spark.conf.unset(name)
    assert len(files_of(tmp_path, "2024-05-01")) > 1 and store.read().count() == 200_000 and store.read().agg(F.sum("k")).first()[0] == 199_999 * 100_000


def test_retries():
    calls = []

    class Query:
        def awaitTermination(self):
            calls.append(1)
            if len(calls) < 3:
                raise RuntimeError("failed")

    run_until_done(Query)
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(RuntimeError):
        run_until_done(Query, attempts=2)


def test_replay_gives_what_one_load_gives(spark, tmp_path):
    seed = season(spark)
    assert match_days(seed["matches"]).count() == 3 and unreadable_dates(seed["matches"]).first().match_id == "na_4"
    lake = Lake(spark, str(tmp_path))
    replay = Replay(lake, seed)
    assert replay.current() is None
    replay.stage_reference()
    refresh(lake)
    days = []
    while (day := replay.step()) is not None:
        days.append(day)
    assert days == [dt.date(2024, 5, 2), dt.date(2024, 5, 1), dt.date(2009, 10, 26)]
    assert replay.current() is None and replay.step() is None
    progress = replay.progress().first()
    assert progress.days_remaining == -1 and progress.current_day == dt.date(2009, 10, 25)
    dated = match_days(seed["matches"]).select("match_id")
    for table in SILVER:
        raw = seed[table].join(dated, "match_id", "left_semi") if "match_id" in RAW[table].names else seed[table]
        raw = raw.withColumn("ldts", F.lit(0)).withColumn("file_name", F.lit("f")).withColumn("file_row_number", F.monotonically_increasing_id())
        want = upsert(None, cleaned(table, raw), KEYS[table], LOAD_ORDER).select(SILVER[table].names)
        got = lake.silver(table).read()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), table
    before = {t: sorted(map(str, lake.silver(t).read().collect())) for t in SILVER}
    refresh(lake)  # nothing new
    assert {t: sorted(map(str, lake.silver(t).read().collect())) for t in SILVER} == before
    history = spark.read.parquet(lake.path("load_history"))
    assert history.where("rejected = 0").count() == history.count() > 0


def test_a_large_file_lands_by_many_tasks(spark, tmp_path):
    """Files without a quoted line break are split, others are whole; names with signs of patterns and blanks are only names."""
    lake, odd = Lake(spark, str(tmp_path)), "champions_ref [1] {a} %41 *.csv"
    write(lake.path("landing"), odd, "id,name\n" + "\n".join(f"{i},name {i}" for i in range(3000)) + "\n")
    write(lake.path("landing"), "champions_ref_2.csv", "id,name\n" + "\n".join(f'{i},"name\n{i}"' for i in range(3000, 3050)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        refresh(lake, ("champions_ref",))
        rows = lake.bronze("champions_ref")
        assert rows.count() == 3050 and rows.where("cast(champion_id as long) % 3000 + 1 != file_row_number").count() == 0
        assert rows.select("ldts").distinct().count() == 1
        assert rows.where("champion_id >= 3000 and champion_name like '%\n%'").count() == 50
        assert rows.where("cast(champion_id as long) < 3000").select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_numbering_moves_no_rows(spark, tmp_path):
    write(tmp_path, "champions_ref.csv", "id,name\n1,a\n2,b\n")
    rows = landing.csv_rows(spark, [f"file:{tmp_path}/champions_ref.csv"], "champions_ref")
    plan = landing.accepted_rows(landing.numbered(rows), landing.file_report(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2 and "row_number()" not in plan
