import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.functions import shapes


def test_exact_percentiles_match_numpy_with_a_hot_group(frame):
    rng = random.Random(3)
    rows = [("hot", rng.lognormvariate(0, 3) * rng.choice([1, -1])) for _ in range(6000)] + [("ties", float(rng.randrange(4))) for _ in range(900)] + [("one", 2.5), ("zero", 0.0), ("none", None)]
    got = {r.k: r for r in shapes.exact_percentiles(frame(rows, "k string, v double"), ["k"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect()}
    for k in ("hot", "ties", "one", "zero"):
        v = np.array([x for g, x in rows if g == k])
        for p in (10, 50, 99):
            assert math.isclose(got[k][f"p{p}"], np.percentile(v, p), rel_tol=1e-12, abs_tol=1e-12)
        assert got[k].n == len(v)
    assert "none" not in got


def test_exact_percentiles_at_powers_of_two(frame):
    v = [2.0**k * f for k in range(-6, 7) for f in (0.999999999, 1.0, 1.000000001)]
    r = shapes.exact_percentiles(frame([("a", x) for x in v], "k string, v double"), ["k"], "v", {f"q{i}": i / 38 for i in range(39)}).first()
    assert all(math.isclose(r[f"q{i}"], np.percentile(v, 100 * i / 38), rel_tol=1e-12) for i in range(39))


def test_neighbours_cross_slab_borders(frame):
    rows = [("a", f"2024-01-{d:02d} {h:02d}:00:00", float(d * 100 + h)) for d in (1, 2, 5, 9) for h in (0, 7, 23)] + [("b", "2024-01-02 05:00:00", 1.0)]
    got = shapes.neighbours(frame(rows, "k string, t timestamp, v double"), ["k"], "t", ["v"]).orderBy("k", "t").collect()
    v = [r[2] for r in rows[:-1]]
    assert [r.prev_v for r in got[:-1]] == [None, *v[:-1]] and [r.next_v for r in got[:-1]] == [*v[1:], None]
    assert (got[-1].prev_v, got[-1].next_v) == (None, None)


def test_pick_row_treats_nulls_as_one_group_and_is_cut_before_the_shuffle(frame):
    d = frame([("a", None, 1, 5.0), ("a", None, 2, 6.0), ("a", 3.0, 1, 7.0)], "k string, depth double, run int, v double")
    out = shapes.pick_row(d, ["k", "depth"], [F.col("run")])
    assert sorted(r.v for r in out.collect()) == [6.0, 7.0]
    assert [r.v for r in shapes.pick_row(d, ["k"], [F.col("v")], last=False).collect()] == [5.0]
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("day,wy,season,water", [("2023-10-01", 2024, 0, 0), ("2024-02-29", 2024, None, 151), ("2024-03-01", 2024, 151, 152), ("2023-03-01", 2023, 151, 152), ("2024-09-30", 2024, 364, 365)])
def test_water_calendar(frame, day, wy, season, water):
    r = frame([(day,)], "d date").select(c.water_year("d").alias("wy"), c.season_day("d").alias("s"), c.water_day("d").alias("w")).first()
    assert (r.wy, r.s, r.w) == (wy, season, water)


def test_same_day_and_week_of_year(frame):
    r = frame([("2024-02-29",), ("2024-12-31",)], "d date").select(c.same_day_in(F.lit(2023), "d").cast("string").alias("s"), c.week_of_year("d").alias("w"), c.doy366("d").alias("n")).collect()
    assert [tuple(x) for x in r] == [("2023-02-28", 8, 60), ("2023-12-31", 51, 366)]


def test_names(frame):
    d = frame([("RIO PEÑASCO AT OTOWI BRIDGE, NM.",), ("Rio Ruidoso at Hollywood",), ("  ",)], "n string")
    r = d.select(c.slug("n").alias("s"), c.nice_name("n").alias("nice"), c.repair_name("n").alias("fix")).collect()
    assert r[0].s == "rio-penasco-at-otowi-bridge-nm" and r[0].nice == "Rio Peñasco At Otowi Bridge, NM" and r[1].nice == "Rio Ruidoso at Hollywood" and r[2].fix is None
