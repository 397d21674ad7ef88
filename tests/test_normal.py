import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from strataforge.functions.normal import upper_quantile, upper_tail
from strataforge.plans import proportions


def test_upper_tail(spark):
    """The whole range, far out as well, against the complementary error function."""
    zs = [i / 8 for i in range(-320, 301)] + [2.4999999, 2.5, 2.5000001, 1e-9, -1e-300, 9.19, 37.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select("z", upper_tail(F.col("z")).alias("q")).collect()
    for r in got:
        want = 0.5 * math.erfc(r.z / math.sqrt(2))
        assert r.q == pytest.approx(want, rel=2e-13, abs=0), (r.z, r.q, want)
    none = spark.createDataFrame([(None,)], "z double").select(upper_tail(F.col("z"))).first()[0]
    assert none is None


def test_upper_quantile(spark):
    ps = [10.0**-k for k in range(1, 300, 7)] + [0.025, 0.05, 0.5, 0.4999, 0.5001, 0.9, 0.975, 1 - 1e-9]
    for r in spark.createDataFrame([(p,) for p in ps], "p double").select("p", upper_quantile(F.col("p")).alias("z")).collect():
        assert 0.5 * math.erfc(r.z / math.sqrt(2)) == pytest.approx(r.p, rel=1e-11), r
        assert r.z == pytest.approx(-NormalDist().inv_cdf(r.p), rel=1e-9, abs=1e-12) or r.p < 1e-16
    outside = spark.createDataFrame([(0.0,), (1.0,), (-1.0,), (None,)], "p double").select(upper_quantile(F.col("p")).alias("z")).collect()
    assert [r.z for r in outside] == [None] * 4


@pytest.mark.parametrize("mode,offset", [("twotail", 0.0), ("ge", 0.0), ("le", 0.0), ("ge", 0.1), ("twotail", -0.3)])
def test_tests_by_group_as_single_numbers(spark, mode, offset):
    draw = random.Random(3)
    rows = [(i, n, draw.randint(0, n), m, draw.randint(0, m)) for i in range(60) for n, m in [(draw.randint(1, 10 ** draw.randint(1, 6)), draw.randint(1, 5000))]]
    df = spark.createDataFrame(rows, "g long, n_a long, s_a long, n_b long, s_b long")
    a, b = (proportions.share_columns(F.col(f"n_{x}"), F.col(f"s_{x}")) for x in "ab")
    df = df.withColumns({**{f"{k}_a": v for k, v in a.items()}, **{f"{k}_b": v for k, v in b.items()}})
    df = df.withColumns({"d": F.col("p_a") - F.col("p_b"), "se": F.sqrt(F.col("se_a") * F.col("se_a") + F.col("se_b") * F.col("se_b"))})
    for r in df.withColumns(proportions.difference_columns(F.col("d"), F.col("se"), mode, offset=offset)).collect():
        x, y = proportions.proportion(r.n_a, r.s_a), proportions.proportion(r.n_b, r.s_b)
        want = proportions.difference(x, y, mode, offset=offset)
        assert (r.low_a, r.high_a) == pytest.approx((x.low, x.high), rel=1e-12, abs=1e-12)
        if want.se:
            assert (r.p_value, r.low, r.high) == pytest.approx((want.p_value, want.low, want.high), rel=1e-10, abs=1e-300) and r.reject == want.reject
        else:
            assert r.p_value is None and r.reject is None
    with pytest.raises(ValueError, match="mode"):
        proportions.difference_columns(F.lit(0.0), F.lit(1.0), "other")


def test_published_tails(spark):
    """The two published p-values: about 1.995e-20 one-sided at -9.19..., where one less the distribution is 0."""
    z = 9.192
    got = spark.range(1).select(upper_tail(F.lit(z)).alias("q")).first().q
    assert got == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-9) and 1e-20 < got < 3e-20


def test_feat_tests_by_group(spark):
    draw = random.Random(8)
    rows = []
    for m in range(300):
        winner = draw.choice(["BLUE", "RED"])
        for team in ("BLUE", "RED"):
            for minute in range(0, 40, 5):
                k = minute // (4 if team == winner else draw.choice([3, 5, 9]))
                rows.append((f"m{m}", team, minute, k, int(k > 4), k // 3, winner, 13 + m % 3))
    df = spark.createDataFrame(rows, "match_id string, team string, minute long, team_kills long, team_towers long, epic_monsters long, winning_team string, season int")
    got = {r.season: r for r in proportions.feat_tests(df, ["season"]).collect()}
    for season in (13, 14, 15):
        a, b, d = proportions.feat_test(df.where(F.col("season") == season))
        r = got[season]
        assert (r.n_with, r.n_without) == (a.n, b.n) and (r.p_with, r.se_with, r.difference, r.se) == pytest.approx((a.p, a.se, d.p, d.se))
        assert (r.p_value, r.low, r.high) == pytest.approx((d.p_value, d.low, d.high), rel=1e-9)
    assert {r.team for r in proportions.feat_tests(df, ["team", "season"]).collect()} == {"BLUE", "RED"} and proportions.feat_tests(df.limit(0), ["season"]).count() == 0
