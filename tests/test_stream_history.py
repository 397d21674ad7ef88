import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strataforge.streaming import history as H
from strataforge.streaming.pipes import Lake, refresh_watched, run_guarded

from .test_streams import write


def events(spark, rows):
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    return spark.createDataFrame([(s, run, at(m), e, None, n, None if n is None else n / 10, err) for s, run, m, e, n, err in rows], H.EVENTS)


def test_failures_in_a_row(spark):
    rows = [("a", "1", 0, H.FAILED, None, "x"), ("a", "2", 1, H.SUCCEEDED, None, None), ("a", "3", 2, H.FAILED, None, "y"), ("a", "4", 3, H.FAILED, None, "z"), ("b", "5", 1, H.SUCCEEDED, None, None), ("c", "6", 1, H.FAILED, None, "q"), ("c", None, 2, H.RESUMED, None, None), ("d", "7", 0, H.STARTED, None, None)]
    got = {r.stream: (r.failures_in_a_row, r.last_error) for r in H.failures_in_a_row(events(spark, rows)).collect()}
    assert got == {"a": (2, "z"), "b": (0, None), "c": (0, None)}


def test_summary_and_runs(spark):
    rows = [("a", "1", 0, H.STARTED, None, None), ("a", "1", 1, H.BATCH, 40, None), ("a", "1", 2, H.BATCH, 60, None), ("a", "1", 3, H.SUCCEEDED, None, None), ("a", "2", 5, H.STARTED, None, None), ("b", "3", -3000, H.STARTED, None, None)]
    ev = events(spark, rows)
    assert {(r.run_id, r.state, r.batches, r.rows) for r in H.runs(ev).collect()} == {("1", H.SUCCEEDED, 2, 100), ("2", "RUNNING", 0, 0), ("3", "RUNNING", 0, 0)}
    now = F.lit(dt.datetime(2024, 1, 1, 1))
    assert [tuple(r) for r in H.stream_summary(ev, now).select("stream", "runs", "failures", "rows", "mean_seconds", "failures_in_a_row", "suspended").collect()] == [("a", 2, 0, 100, 10.0, 0, False)]
    assert H.stream_summary(ev.limit(0), now).count() == 0


def test_suspended_after_three_failures(spark, tmp_path):
    """A batch that fails every time: the fourth start is refused, also by a new history over the same table; after a
    resume it runs again, and one good run ends the count."""
    broken = [True]
    spark.range(5).write.parquet(f"{tmp_path}/in")

    def start(name="x:s"):
        def take(batch, number):
            if broken[0]:
                raise ValueError("no disk")
            batch.count()

        source = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
        return source.writeStream.foreachBatch(take).queryName(name).option("checkpointLocation", f"{tmp_path}/cp_{name[-1]}").trigger(availableNow=True).start()

    history = H.StreamHistory(spark, f"{tmp_path}/history", "x:")
    with history.watching():
        for _ in range(3):
            with pytest.raises(StreamingQueryException):
                run_guarded(history, "x:s", start)
        with pytest.raises(H.Suspended, match="(?s)3 times in a row.*no disk"):
            run_guarded(H.StreamHistory(spark, f"{tmp_path}/history", "x:"), "x:s", start)
        broken[0] = False
        with pytest.raises(H.Suspended):
            run_guarded(history, "x:s", start)
        history.resume("x:s")
        run_guarded(history, "x:s", start)
        run_guarded(history, "x:s", start)  # nothing new
        start("other:t").awaitTermination()  # not of this prefix
    states = [r.state for r in H.runs(history.events()).orderBy("started_at").collect()]
    assert states == [H.FAILED] * 3 + [H.SUCCEEDED] * 2
    assert {r.stream for r in history.events().collect()} == {"x:s"} and history.events().where("event = 'BATCH'").agg(F.sum("rows")).first()[0] == 5
    assert "no disk" in H.last_errors(history.events()).first().error
    start("x:u").awaitTermination()  # not watched any more
    assert history.events().where("stream = 'x:u'").count() == 0


def test_lake_history(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    write(tmp_path / "landing", "champions_ref_1.csv", "id,name\n1,one\n2,two\n")
    kept = refresh_watched(lake, ("champions_ref", "items_ref"))
    assert lake.silver("champions_ref").read().count() == 2 and all(":items_ref" in k for k in kept)
    got = {r.stream.split(":", 1)[1]: (r.runs, r.failures, r.rows) for r in H.stream_summary(lake.history().events(), F.current_timestamp()).collect()}
    assert got["land:champions_ref"] == (1, 0, 2) and got["refine:champions_ref"] == (1, 0, 2)
