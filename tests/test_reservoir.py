import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import reservoir as r

D = dt.date


def test_isotonic_fit_follows_a_heavy_point(frame):
    d = frame([("a", i, v, w) for i, (v, w) in enumerate(zip((100.0, 90.0, 95.0, 80.0, 85.0), (1.0, 1.0, 1.0, 1e6, 1.0)))], "k string, i int, v double, w double")
    fit = [x.fit for x in r.isotonic(d, ["k"], "i", "v", "w").orderBy("i").collect()]
    assert all(a >= b - 1e-9 for a, b in zip(fit, fit[1:])) and fit[0] == 100.0 and abs(fit[3] - 80.0) < 1e-3 and fit[1] == fit[2] == 92.5


def test_lookup_clamps_and_forces_a_rising_table(frame):
    p = frame([("a", 0.0, 0.0), ("a", 10.0, 100.0), ("a", 20.0, 90.0), ("a", 30.0, 400.0)], "reservoir string, elevation_ft double, storage_af double")
    d = frame([("a", h) for h in (-5.0, 0.0, 5.0, 15.0, 25.0, 30.0, 99.0)] + [("b", 5.0)], "reservoir string, h double")
    out = [x.table_af for x in r.table_lookup(d, p, "h").orderBy("reservoir", "h").collect()]
    assert out == [0.0, 0.0, 50.0, 100.0, 250.0, 400.0, 400.0, None]


def test_a_new_table_is_a_new_era(frame):
    rows = [("a", y, 100.0 + (i % 50), 1000.0 if y < 2004 else 0.0) for y in range(2000, 2008) for i in range(250)]
    p = frame(rows, "reservoir string, y int, elev double, off double")
    tol = frame([("a", 50.0)], "reservoir string, tolerance double")
    e = {x.y: x.era_id for x in r.segment_eras(p, tol).collect()}
    assert e == {y: 0 if y < 2004 else 1 for y in range(2000, 2008)}
    apart = p.withColumn("elev", F.col("elev") + F.when(F.col("y") >= 2004, 500).otherwise(0))
    assert {x.y: x.era_id for x in r.segment_eras(apart, tol).collect()} == e
    short = p.withColumn("off", F.when(F.col("y") == 2005, 5000.0).otherwise(F.col("off")))
    assert max(x.era_id for x in r.segment_eras(short, tol).collect()) == 3


def test_departure_outside_the_visited_range_follows_the_edge(frame):
    p = frame([("a", 0, 100.0 + i * 0.1, 2.0 * (100.0 + i * 0.1)) for i in range(1000)], "reservoir string, era_id int, elev double, off double")
    out = {x.pool: x for x in r.departure_at(p, frame([("a", "in", 150.0), ("a", "above", 210.0)], "reservoir string, pool string, elev_ft double")).collect()}
    assert out["in"].basis == "local" and out["in"].gap_ft == 0 and abs(out["in"].departure_af - 300.0) < 0.2
    assert out["above"].basis == "line" and abs(out["above"].departure_af - 420.0) < 1e-6 and out["above"].gap_ft > 10


def test_capacity_in_force(frame):
    d = frame([("a", "2000-01-01"), ("a", "2005-06-01"), ("a", "2010-01-01")], "reservoir string, date date")
    e = frame([("a", "2005-01-01", 10.0), ("a", "2009-01-01", 9.0)], "reservoir string, start date, cap double")
    out = [(x.cap, x.before_record) for x in r.in_force(d, e, "start", ["cap"]).orderBy("date").collect()]
    assert out == [(10.0, True), (10.0, False), (9.0, False)]


def test_group_totals_carry_a_lagging_member_seven_days(frame):
    rows = [("big", D(2026, 1, i), 100.0, 1000.0) for i in range(1, 21)] + [("small", D(2026, 1, i), 90.0, 100.0) for i in range(1, 11)]
    st = frame([(k, d.isoformat(), s, c, "high") for k, d, s, c in rows], "reservoir string, date date, stor double, primary_af double, confidence string")
    m = frame([("big", "g"), ("small", "g")], "reservoir string, group string")
    s = r.group_series(st, m)
    one = s.where("date = '2026-01-10'").first()
    assert one.complete and one.trusted and round(100 * one.storage_af / one.capacity_af, 2) == 17.27
    assert r.latest_complete(s).first().as_of == D(2026, 1, 17)
    after = s.where("date = '2026-01-18'").first()
    assert not after.complete and after.storage_af == 100.0
    as_of = r.latest_complete(s)
    assert r.stale_members(st, m, as_of.withColumn("as_of", F.lit("2026-01-26").cast("date"))).first().reservoir == "small"
    assert {(x.reservoir, x.stor) for x in r.member_shares(st, m, as_of).collect()} == {("big", 100.0), ("small", 90.0)}


def test_normal_for_the_date_wraps_the_year(frame):
    rows = [("a", D(y, 12, 30) + dt.timedelta(days=i), float(y)) for y in range(1991, 2011) for i in range(5)]
    st = frame([(k, d.isoformat(), v) for k, d, v in rows], "reservoir string, date date, pct double")
    n = {x.day: x for x in r.normal_for_date(st, "pct").collect()}
    assert {1, 365, 366, 6} <= set(n) and len(n[366].sample) > 80
    few = r.normal_for_date(st.where("year(date) < 2003"), "pct")
    assert few.count() == 0


def test_flood_days_by_role(frame):
    d = frame([("a", "dry_flood", 6.0, 1000.0, None), ("a", "dry_flood", 4.0, 1000.0, None), ("b", "flood_control", 111.0, 300.0, 100.0), ("b", "flood_control", 104.0, 300.0, 100.0), ("c", "supply", 1e9, 1.0, 1.0)],
              "reservoir string, role string, stor double, flood_af double, cons_af double")
    assert [x.flood_day for x in r.flood_days(d).orderBy("reservoir", F.desc("stor")).collect()] == [True, False, True, False, False]
