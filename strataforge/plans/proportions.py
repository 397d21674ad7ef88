"""Who reaches two of three milestones first, and whether that goes with winning: shares, intervals and tests.

For any number of groups all of it is columns (`share_columns`, `difference_columns`, `feat_tests`); `proportion` and
`difference` say the same of single numbers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normal import upper_quantile, upper_tail

MILESTONES = (("team_kills", 3), ("team_towers", 1), ("epic_monsters", 3))


def seasons(matches: DataFrame) -> DataFrame:
    """(match_id, season): the first two characters of the game version."""
    return matches.select("match_id", F.substring("game_version", 1, 2).try_cast("int").alias("season"))


def with_season(intervals: DataFrame, matches: DataFrame) -> DataFrame:
    """intervals with the season, the winner, and the sum of epic monsters."""
    season = matches.select("match_id", "winning_team", F.substring("game_version", 1, 2).try_cast("int").alias("season"))
    epic = F.col("team_dragons") + F.col("team_barons") + F.col("team_void_grubs") + F.col("team_heralds")
    return intervals.withColumn("epic_monsters", epic).join(season, "match_id")


def milestone_minutes(rows: DataFrame) -> DataFrame:
    """(match_id, team, minute): when a team has reached its second milestone, null if never."""
    first = [F.min(F.when(F.col(c) >= n, F.col("minute"))).alias(c) for c, n in MILESTONES]
    reached = F.array_sort(F.array_compact(F.array(*[c for c, _ in MILESTONES])))
    return rows.groupBy("match_id", "team").agg(*first).select("match_id", "team", F.get(reached, 1).alias("minute"))


def first_team(rows: DataFrame) -> DataFrame:
    """(match_id, outcome, team_with_feat): RESOLVED for the earlier team, else NO_QUALIFIER or TIE."""
    wide = milestone_minutes(rows).groupBy("match_id").pivot("team", ["BLUE", "RED"]).agg(F.min("minute"))
    blue, red = F.col("BLUE"), F.col("RED")
    team = F.when(blue.isNotNull() & (red.isNull() | (blue < red)), "BLUE").when(red.isNotNull() & (blue.isNull() | (red < blue)), "RED")
    outcome = F.when(team.isNotNull(), "RESOLVED").when(blue.isNull() & red.isNull(), "NO_QUALIFIER").otherwise("TIE")
    return wide.select("match_id", outcome.alias("outcome"), team.alias("team_with_feat"))


def team_level(rows: DataFrame) -> DataFrame:
    """(match_id, team, has_feat, is_winner): two rows for each match that has an outcome."""
    winner = rows.groupBy("match_id").agg(F.max("winning_team").alias("winning_team"))
    won = first_team(rows).where("outcome = 'RESOLVED'").join(winner, "match_id").withColumn("team", F.explode(F.array(F.lit("BLUE"), F.lit("RED"))))
    is_winner = F.coalesce(F.col("team") == F.col("winning_team"), F.lit(False)).cast("bigint")
    return won.select("match_id", "team", (F.col("team") == F.col("team_with_feat")).alias("has_feat"), is_winner.alias("is_winner"))


def outcomes(rows: DataFrame) -> DataFrame:
    return first_team(rows).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Proportion:
    n: int
    p: float
    se: float
    low: float
    high: float


@dataclass(frozen=True)
class Difference(Proportion):
    p_value: float
    reject: bool


def _quantile(q: float) -> float:
    return NormalDist().inv_cdf(q)


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))  # keeps its precision far out, where 1 - cdf is 0


def proportion(n: int, successes: float, alpha: float = 0.05) -> Proportion:
    """A share with its standard error and a two-sided interval; nan for no trials."""
    if not n:
        return Proportion(0, math.nan, math.nan, math.nan, math.nan)
    p = successes / n
    se = math.sqrt(p * (1 - p) / n)
    z = _quantile(1 - alpha / 2)
    return Proportion(n, p, se, p - z * se, p + z * se)


def difference(a: Proportion, b: Proportion, mode: str = "twotail", alpha: float = 0.05, offset: float = 0.0) -> Difference:
    """Test of p_a - p_b against offset with unpooled errors: twotail, ge (greater) or le (less)."""
    d, se = a.p - b.p, math.hypot(a.se, b.se)
    z = (d - offset) / se if se else math.copysign(math.inf, d - offset)
    two, one = _quantile(1 - alpha / 2) * se, _quantile(1 - alpha) * se
    tails = {"twotail": (2 * _upper_tail(abs(z)), d - two, d + two), "ge": (_upper_tail(z), d - one, math.inf), "le": (_upper_tail(-z), -math.inf, d + one)}
    if mode not in tails:
        raise ValueError(f"mode is one of {', '.join(tails)}, not {mode}")
    p, low, high = tails[mode]
    return Difference(a.n + b.n, d, se, low, high, p, p <= alpha)


def counts(groups: DataFrame, group: str, success: str) -> DataFrame:
    """(group, n, successes), null groups left out."""
    return groups.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(success).cast("bigint")).alias("successes"))


def feat_test(rows: DataFrame, mode: str = "twotail", alpha: float = 0.05, offset: float = 0.0, team: str | None = None) -> tuple[Proportion, Proportion, Difference]:
    """Shares of wins with and without the feat, and the test of their difference; only of one team if it is named."""
    teams = team_level(rows)
    found = {r.has_feat: r for r in counts(teams if team is None else teams.where(F.col("team") == team), "has_feat", "is_winner").collect()}
    shares = [proportion(found[k].n, found[k].successes, alpha) if k in found else proportion(0, 0) for k in (True, False)]
    return shares[0], shares[1], difference(*shares, mode, alpha, offset)


def share_columns(n: Column, successes: Column, alpha: float = 0.05) -> dict[str, Column]:
    """p, se, low, high of a share in every row, as `proportion`; null for no trials."""
    p = successes / F.nullif(n, F.lit(0))
    se = F.sqrt(p * (1 - p) / n)
    z = upper_quantile(F.lit(alpha / 2))
    return {"p": p, "se": se, "low": p - z * se, "high": p + z * se}


def difference_columns(d: Column, se: Column, mode: str = "twotail", alpha: float = 0.05, offset: float = 0.0) -> dict[str, Column]:
    """z, p_value, low, high and reject of a difference in every row, as `difference`; null without an error."""
    z = (d - offset) / F.nullif(se, F.lit(0.0))
    two, one = upper_quantile(F.lit(alpha / 2)) * se, upper_quantile(F.lit(alpha)) * se
    far = F.lit(math.inf)
    tails = {"twotail": (2 * upper_tail(F.abs(z)), d - two, d + two), "ge": (upper_tail(z), d - one, far), "le": (upper_tail(-z), -far, d + one)}
    if mode not in tails:
        raise ValueError(f"mode is one of {', '.join(tails)}, not {mode}")
    p, low, high = tails[mode]
    return {"z": z, "p_value": p, "low": low, "high": high, "reject": p <= alpha}


def feat_tests(rows: DataFrame, by: list[str], mode: str = "twotail", alpha: float = 0.05, offset: float = 0.0) -> DataFrame:
    """One row per group: shares of wins with and without the feat and the test of their difference, no group on the driver.

    by names columns of rows that are the same for all rows of a match, or team. Groups without a resolved match are not
    there; one that has only teams with the feat, or only such without, has null tests.
    """
    fixed = [c for c in by if c != "team"]
    level = team_level(rows)
    if fixed:
        level = level.join(rows.groupBy("match_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in fixed]), "match_id")
    of = lambda has, value: F.sum(F.when(F.col("has_feat") == has, value).otherwise(0))
    sums = {f"{k}_{side}": of(has, v) for side, has in (("with", True), ("without", False)) for k, v in (("n", F.lit(1)), ("wins", F.col("is_winner")))}
    out = level.groupBy(*by).agg(*[v.cast("bigint").alias(k) for k, v in sums.items()])
    for side in ("with", "without"):
        out = out.withColumns({f"{k}_{side}": v for k, v in share_columns(F.col(f"n_{side}"), F.col(f"wins_{side}"), alpha).items()})
    out = out.withColumns({"difference": F.col("p_with") - F.col("p_without"), "se": F.sqrt(F.col("se_with") * F.col("se_with") + F.col("se_without") * F.col("se_without"))})
    return out.withColumns(difference_columns(F.col("difference"), F.col("se"), mode, alpha, offset))
