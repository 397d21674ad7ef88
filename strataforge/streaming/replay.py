"""Replay of a seed, one match day at a time, newest first. Its state is a table that grows by a row a step."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import parse_timestamp
from ..plans.schemas import RAW
from ..sources.landing import listing, unload_csv
from .pipes import Lake, refresh

STATE = T.StructType([T.StructField("step", T.LongType()), *[T.StructField(c, T.DateType()) for c in ("current_day", "first_day", "last_day")]])
FACTS = ("matches", "players", "intervals")


def match_days(matches: DataFrame) -> DataFrame:
    """(match_id, day) of the matches whose date can be read."""
    return matches.select("match_id", F.to_date(parse_timestamp(F.col("game_date"))).alias("day")).where("day is not null")


def unreadable_dates(matches: DataFrame) -> DataFrame:
    """(match_id, game_date) that is there but can't be read."""
    return matches.where(F.col("game_date").isNotNull() & parse_timestamp(F.col("game_date")).isNull()).select("match_id", "game_date")


def validate_upload(files: DataFrame, prefixes: list[str]) -> None:
    """Each prefix must have exactly one file, with something in it. `files` is a listing; errors name the prefixes.

    Prefixes are compared as SQL patterns are, without regard to case: `_` stands for any character.
    """
    names = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "size")
    wanted = files.sparkSession.createDataFrame([(p,) for p in prefixes], "prefix string")
    counts = wanted.join(F.broadcast(names), F.expr("name ilike concat(prefix, '%')"), "left").groupBy("prefix").agg(F.count("name").alias("n"), F.count_if(F.col("size") == 0).alias("empty"))
    found = {r.prefix: r for r in counts.collect()}
    faults = {"missing": [p for p in prefixes if found[p].n == 0], "more than one": [p for p in prefixes if found[p].n > 1], "empty": [p for p in prefixes if found[p].empty]}
    if any(faults.values()):
        raise ValueError("; ".join(f"{what}: {', '.join(ps)}" for what, ps in faults.items() if ps))


def validate_folder(spark, folder: str, prefixes: list[str]) -> None:
    validate_upload(listing(spark, folder), prefixes)


def export(lake: Lake, rows: DataFrame, name: str) -> str:
    """rows as one CSV file `name`.csv in the landing folder: written aside, then moved there whole."""
    folder, to = lake.path("staging", name), lake.path("landing", f"{name}.csv")
    unload_csv(rows, folder)
    path = lake.spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(lake.spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in files.listStatus(path(folder)) if s.getPath().getName().startswith("part-"))
    files.mkdirs(path(to).getParent())
    files.delete(path(to), False)
    files.rename(part, path(to))
    files.delete(path(folder), True)
    return to


class Replay:
    """seed: the raw tables of all days. One `step` lands one day and moves on to the next older one."""

    def __init__(self, lake: Lake, seed: dict[str, DataFrame]) -> None:
        self.lake, self.seed = lake, seed
        self.days = match_days(seed["matches"])

    def state(self) -> DataFrame:
        """The last row of the state; none before the start."""
        try:
            rows = self.lake.spark.read.schema(STATE).parquet(self.lake.path("state"))
        except AnalysisException:
            rows = self.lake.spark.createDataFrame([], STATE)
        return rows.orderBy(F.desc("step")).limit(1)

    def _save(self, *row: dt.date | None) -> None:
        last = self.state().first()
        self.lake.spark.createDataFrame([(last.step + 1 if last else 0, *row)], STATE).write.mode("append").parquet(self.lake.path("state"))

    def initialise(self) -> None:
        """Start at the newest day, if nothing has started yet."""
        if self.state().first() is None:
            ends = self.days.agg(F.max("day").alias("last"), F.min("day").alias("first")).first()
            self._save(ends["last"], ends["first"], ends["last"])

    def current(self) -> dt.date | None:
        """The day to load next; None before the start, without days, and when all are loaded."""
        row = self.state().first()
        return None if row is None or row.current_day is None or row.current_day < row.first_day else row.current_day

    def stage(self, table: str, day: dt.date) -> str:
        """Export the rows of a day, as one CSV file in the landing folder."""
        ids = self.days.where(F.col("day") == F.lit(day)).select("match_id").distinct()
        rows = self.seed[table].join(ids, "match_id", "left_semi").select(RAW[table].names)
        return export(self.lake, rows, f"{table}_{day:%Y%m%d}")

    def advance(self) -> None:
        """To the next older day that has matches; past the oldest, to the day before it, which means exhausted."""
        row = self.state().first()
        older = self.days.where(F.col("day") < F.lit(row.current_day)).agg(F.max("day").alias("day")).first()["day"]
        self._save(older or row.first_day - dt.timedelta(days=1), row.first_day, row.last_day)

    def stage_reference(self) -> None:
        """Reference tables are landed once."""
        for table in set(RAW) - set(FACTS):
            export(self.lake, self.seed[table].select(RAW[table].names), table)

    def step(self) -> dt.date | None:
        """Load one day; None when there is none left."""
        self.initialise()
        day = self.current()
        if day is not None:
            for table in FACTS:
                self.stage(table, day)
            refresh(self.lake, FACTS)
            self.advance()
        return day

    def progress(self) -> DataFrame:
        """days_ingested and days_remaining; the latter is -1 when exhausted."""
        return self.state().drop("step").select("*", F.date_diff("last_day", "current_day").alias("days_ingested"), F.date_diff("current_day", "first_day").alias("days_remaining"))
