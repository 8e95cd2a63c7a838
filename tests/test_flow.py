import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.ratings import midrank_in
from tidemark.operators import balance, flow, issues, normals

D = dt.date


def day(text):
    return F.lit(text).cast("date")


def test_complete_weeks_end_on_or_before_the_last_day(frame):
    d = frame([("2026-09-13",), ("2026-09-16",)], "d date")
    out = [r.w.isoformat() for r in d.select(flow.last_complete_week(F.col("d")).alias("w")).collect()]
    assert out == ["2026-09-07", "2026-09-07"]
    assert flow.week_starts(d.limit(1), "d", 3).count() == 3


def test_the_best_copy_is_used_each_day(frame):
    d = frame([("A", "2020-01-01", "usace_cwms", "c", 90.0), ("A", "2020-01-01", "usgs", "u", 100.0), ("A", "2020-01-02", "usace_cwms", "c", 80.0), ("A", "2020-01-03", "codwr", "w", 70.0)],
              "gauge string, date date, source string, site_uid string, cfs double")
    out = [(r.source, r.cfs) for r in flow.pick_copy(d).orderBy("date").collect()]
    assert out == [("usgs", 100.0), ("usace_cwms", 80.0), ("codwr", 70.0)]


def test_a_week_needs_four_days(frame):
    rows = [("A", f"2024-01-0{i}", "usgs", 10.0) for i in (1, 2, 3)] + [("A", f"2024-01-{i:02d}", "usgs" if i < 11 else "codwr", 20.0) for i in range(8, 13)]
    out = flow.gauge_weekly(frame(rows, "gauge string, date date, source string, cfs double")).collect()
    assert [(r.week_start, r.mean_cfs, r.n_days, r.source_used) for r in out] == [(D(2024, 1, 8), 20.0, 5, "usgs")]


def test_segment_mean(frame):
    w = frame([("A", "2024-01-01", 100.0), ("B", "2024-01-01", 300.0), ("C", "2024-01-01", 50.0)], "gauge string, week_start date, mean_cfs double")
    g = frame([("A", "up"), ("B", "up"), ("C", "down")], "gauge string, segment string")
    r = flow.segment_weekly(w, g).where("segment = 'up'").first()
    assert (r.mean_cfs, r.n_gauges, r.min_cfs, r.max_cfs) == (200.0, 2, 100.0, 300.0)


def test_copy_agreement_ignores_low_flow(frame):
    c = [("A", f"2020-01-0{i}", s, f"{s}:1", v) for i, (u, w) in enumerate([(1.0, 0.0), (100.0, 100.0), (200.0, 150.0)], start=1) for s, v in (("usgs", u), ("usace_cwms", w))]
    d = frame(c, "gauge string, date date, source string, site_uid string, cfs double")
    r = flow.copy_agreement(d, flow.pick_copy(d)).first()
    assert (r.overlap_days, r.days_off, r.median_abs_pct_diff) == (3, 1, 12.5)


def test_daily_means_are_stored_or_from_enough_readings_never_mixed(frame):
    rows = [("s", "discharge", "2024-01-10 00:00:00", 5.0, "daily", "mean", "A")]
    rows += [("s", "discharge", f"2024-01-10 {h:02d}:00:00", 99.0, "hourly", "mean", None) for h in range(7, 24)]
    rows += [("s", "discharge", f"2024-01-12 {h:02d}:00:00", float(h), "hourly", "mean", None) for h in range(7, 19)]
    rows += [("s", "discharge", f"2024-01-14 {h:02d}:00:00", 1.0, "hourly", "mean", None) for h in range(7, 18)]
    out = {r.date.day: r.cfs for r in flow.daily_flow(frame(rows, "site_uid string, variable string, datetime_utc timestamp, value double, interval string, statistic string, qualifier string")).collect()}
    assert out == {10: 5.0, 12: 12.5}


def test_isolated_spikes_go_and_limbs_stay(frame):
    s = [("r", "reservoir_storage", "hourly", f"2024-05-01 {h + 7:02d}:00:00", 72874.0 if h == 5 else 0.0) for h in range(12)]
    s += [("q", "reservoir_storage", "hourly", f"2024-05-01 {h + 7:02d}:00:00", 100.0 * h) for h in range(17)]
    out = {r.site_uid: (r.value, r.n) for r in flow.reservoir_daily(frame(s, "site_uid string, variable string, interval string, datetime_utc timestamp, value double")).collect()}
    assert out == {"r": (0.0, 11), "q": (800.0, 17)}


def test_bad_values_are_removed_or_reported(frame):
    d = frame([("A", "2020-05-01", "usgs", 500.0, "A"), ("A", "2020-05-02", "usgs", 500.0, "A:e"), ("A", "2020-05-03", "codwr", 500.0, None), ("A", "2020-05-04", "usgs", 104.0, "A"), ("A", "2020-06-01", "usgs", 1.0, None)],
              "gauge string, date date, source string, cfs double, qualifier string")
    peaks = frame([("A", 2020, 100.0)], "gauge string, wy int, peak double")
    ex = frame([("A", "2020-06-01", "2020-06-03")], "gauge string, first date, last date")
    assert [r.verdict for r in flow.screen_values(d, peaks, ex).orderBy("date").collect()] == ["conflict", "above_peak", "above_peak", "kept", "listed"]


@pytest.mark.parametrize("v,pct", [(5.0, 0.0), (25.0, 50.0), (20.0, 37.5), (50.0, 100.0)])
def test_midrank(frame, v, pct):
    r = frame([([10.0, 20.0, 30.0, 40.0], v)], "base array<double>, v double").select(midrank_in(F.col("base"), F.col("v")).alias("p")).first()
    assert r.p == pct


def test_flow_against_the_same_week_of_other_years(frame):
    # the Monday in days 57 to 63 of each year is week 8
    mondays = [next(d for n in range(56, 63) if (d := D(y, 1, 1) + dt.timedelta(days=n)).weekday() == 0) for y in range(1991, 2021)]
    rows = [("A", d, float(d.year - 1990)) for d in mondays] + [("A", D(2026, 3, 2), 3.5)]
    w = frame([(g, d.isoformat(), v) for g, d, v in rows], "gauge string, week_start date, mean_cfs double")
    out = normals.flow_vs_normal(w, frame([("A", "s")], "gauge string, segment string"), day("2026-03-08"), 1).collect()
    assert len(out) == 1 and out[0].basis == "baseline" and out[0].n_base == 30 and out[0].pct == 10.0 and out[0].cls == "below normal"


def test_drying_leaves_out_gauges_that_are_always_dry(frame):
    rows = [(g, (D(2020, 1, 1) + dt.timedelta(days=i)).isoformat(), 0.0 if g == "dry" or i < 10 else 5.0) for g in ("dry", "wet") for i in range(100)]
    d = frame(rows, "gauge string, date date, cfs double")
    g = frame([("dry", "s"), ("wet", "s")], "gauge string, segment string")
    r = normals.drying(d, g).first()
    assert (r.any_dry_days, r.gauge_dry_days, r.days_with_data, r.n_gauges) == (10, 10, 100, 1)
    assert [x.gauge for x in normals.normally_dry(d, g).collect()] == ["dry"]


def test_periods_need_coverage_and_enough_years(frame):
    rows = [("A", (D(y, 1, 1) + dt.timedelta(days=i)).isoformat(), float(y)) for y in range(1990, 2022) for i in range(0, 120, 1)]
    d = frame(rows, "gauge string, date date, cfs double")
    g = frame([("A", "s")], "gauge string, segment string")
    out = {r.days: (r.pct, r.cls) for r in normals.flow_periods(d, g, day("2021-04-20"), (30, 90, 365)).collect()}
    assert out == {30: (100.0, "much above normal"), 90: (100.0, "much above normal")}


def test_seasons_gaps_and_runs(frame):
    days = [D(y, m, d) for y in (2018, 2019, 2020) for m in range(4, 11) for d in range(1, 29)]
    c = frame([("A", x.isoformat(), 3.0) for x in days], "gauge string, date date, cfs double")
    s = issues.seasonal_months(c)
    assert sorted(r.month for r in s.collect()) == [1, 2, 3, 11, 12]
    assert issues.gaps(c, s).count() == 0 and issues.gaps(c, None).count() == 2
    v = [1, 1, 1, 2, 0, 0, 0, 5, 5]
    r = frame([("A", (D(2020, 1, 1) + dt.timedelta(days=i + (5 if i > 7 else 0))).isoformat(), float(x)) for i, x in enumerate(v)], "gauge string, date date, cfs double")
    assert [(x.days, x.value) for x in issues.runs(r).collect()] == [(3, 1.0)] and [x.days for x in issues.runs(r, "zero").collect()] == [3]


def test_water_balance_closes(frame):
    days = [D(2019, 9, 27) + dt.timedelta(days=i) for i in range(370)]
    stored = {d: 40 * 1.983471 * i for i, d in enumerate(days)}
    rows = [("r", t, role, kind, d.isoformat(), v(d)) for t, role, kind, v in (("a", "inflow", "flow", lambda d: 100.0), ("b", "outflow", "flow", lambda d: 60.0), ("s", "storage", "storage", lambda d: stored[d]), ("x", "reference", "volume", lambda d: 7.0)) for d in days]
    s = frame(rows, "reach string, term string, role string, kind string, date date, value double")
    r = {x.start.isoformat(): x for x in balance.balance(s, s, "water_year").collect()}["2019-10-01"]
    assert r.complete and abs(r.unaccounted_af) < 1e-6 and abs(r.inflow_af - 366 * 100 * 1.983471) < 1e-6 and r.min_coverage == 1.0
    gap = s.where("NOT (term = 'b' AND month(date) = 3)")
    r = {x.start.isoformat(): x for x in balance.balance(gap, s, "water_year").collect()}["2019-10-01"]
    assert not r.complete and r.unaccounted_af is None
    m = balance.balance(s, s, "month").where("start = '2020-02-01'").first()
    assert m.days == 29 and abs(m.unaccounted_af) < 1e-6


def test_state_line_totals_count_only_years_with_every_gauge(frame):
    rows = [(g, (D(y, 6, 1) + dt.timedelta(days=i)).isoformat(), float(y - 2000) * k) for g, k in (("a", 1), ("b", 2)) for y in range(2001, 2013) for i in range(30) if not (g == "b" and y == 2005)]
    other = [("c", (D(y, 6, 1) + dt.timedelta(days=i)).isoformat(), 5.0) for y in range(2001, 2013) for i in range(30)]
    d = frame(rows, "gauge string, date date, cfs double").withColumn("river", F.lit("x")).unionByName(frame(other, "gauge string, date date, cfs double").withColumn("river", F.lit("y")))
    end = day("2012-06-30")
    w = normals.exit_windows(d, end, (10,))
    one = {r.gauge: r for r in normals.exit_ratings(w, end, (1991, 2020), 10, 5).collect()}
    assert one["a"].volume_af == 12 * 10 * 1.983471 and one["a"].n_years == 11 and one["b"].n_years == 10
    tot = {r.river: r for r in normals.exit_total(w, d.select("river", "gauge").distinct(), end, (1991, 2020), 10, 5).collect()}
    assert abs(tot["x"].volume_af - 36 * 10 * 1.983471) < 1e-9 and tot["x"].n_years == 10 and tot["x"].cls == "much above normal"
    # the year the other river's gauge lacks counts here
    assert tot["y"].n_years == 11 and tot["y"].volume_af == 50 * 1.983471
    assert {(r.river, r.gauge, r.stale) for r in normals.exit_set(d).collect()} == {("x", "a", False), ("x", "b", False), ("y", "c", False)}


def test_explorer_does_not_let_the_order_of_a_sum_decide_a_half(spark):
    first = dt.date(2000, 1, 3)
    rows = [("a", first, 29.55, 2), ("b", first, 29.549999999999997, 2), ("c", first, 29.5499, 2)]
    seg = spark.createDataFrame(rows, "segment string, week_start date, mean_cfs double, n_gauges int")
    assert {r.segment: r.v for r in flow.explorer(seg).collect()} == {"a": 29.6, "b": 29.6, "c": 29.5}


def test_means_that_differ_by_the_order_of_their_sum_rank_as_equal(spark):
    monday = lambda y: next(d for d in (dt.date(y, 1, 1) + dt.timedelta(63 + k) for k in range(7)) if d.weekday() == 0)
    weeks, last = [("g", monday(y), 0.3) for y in (1995, 1996, 1997, 1998)], monday(2001)
    w = spark.createDataFrame([*weeks, ("g", last, 0.1 + 0.2)], "gauge string, week_start date, mean_cfs double")
    g = spark.createDataFrame([("g", "s")], "gauge string, segment string")
    end = F.lit("2001-11-04").cast("date")
    rate = lambda **k: {r.week_start: r.pct for r in normals.flow_vs_normal(w, g, end, 52, (1995, 1999), 3, 3, **k).collect()}
    assert rate(places=9)[last] == 50.0 and rate()[last] == 100.0


def test_drying_and_bands_read_their_days_once(frame, spark):
    leaves = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Range (")
    big = spark.range(10).select(F.col("id").cast("string").alias("gauge"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.rand().alias("cfs"))
    g = frame([("1", "s")], "gauge string, segment string")
    assert leaves(normals.drying(big, g)) == 1
    # the weeks that make the bands, and those that are rated
    weeks = big.select("gauge", F.col("date").alias("week_start"), F.col("cfs").alias("mean_cfs"))
    assert leaves(normals.flow_vs_normal(weeks, g, day("2026-03-08"))) == 2


def test_terms_take_the_best_copy_of_a_day(frame):
    """Best source, then site; a stored mean before readings, the finest interval with enough of them, a null mean too; no window over the days."""
    t0 = dt.datetime(2020, 1, 1, 7)
    hours = lambda s, d, n, v: [(s, "discharge", (t0 + dt.timedelta(days=d, hours=i)).isoformat(" "), v, "hourly", "instantaneous") for i in range(n)]
    quarters = lambda s, d, n, v: [(s, "discharge", (t0 + dt.timedelta(days=d, minutes=15 * i)).isoformat(" "), v, "15min", "instantaneous") for i in range(n)]
    daily = lambda s, d, v: (s, "discharge", f"2020-01-0{1 + d} 00:00:00", v, "daily", "mean")
    rows = [daily("codwr:1", 0, 1.0), daily("usgs:2", 0, 2.0), daily("usgs:1", 0, 3.0), *hours("usgs:1", 0, 24, 9.0), *hours("usgs:1", 1, 24, 4.0), *quarters("usgs:1", 1, 96, 5.0), *hours("usgs:1", 2, 24, 6.0),
            *quarters("usgs:1", 2, 40, 7.0), *hours("usgs:1", 3, 11, 8.0), daily("codwr:1", 3, 10.0), daily("usgs:2", 4, None), daily("codwr:1", 4, 11.0)]
    rows += [("codwr:1", "storage", "2020-01-01 05:00:00", v, "hourly", "instantaneous") for v in (1.0, 3.0)]
    d = frame(rows, "site_uid string, variable string, datetime_utc timestamp, value double, interval string, statistic string").withColumn("qualifier", F.lit(None).cast("string"))
    terms = frame([(r, "up", "inflow", "flow", "discharge", s) for r in ("a", "b") for s in ("codwr:1", "usgs:2", "usgs:1") if (r, s) != ("b", "usgs:1")] + [("a", "lake", "storage", "storage", "storage", "codwr:1")],
                  "reach string, term string, role string, kind string, variable string, site_uid string")
    out = balance.read_terms(d, terms)
    got = {(r.reach, r.term, r.date.day): r.value for r in out.collect()}
    assert got == {("a", "up", 1): 3.0, ("a", "up", 2): 5.0, ("a", "up", 3): 6.0, ("a", "up", 4): 10.0, ("a", "up", 5): None, ("a", "lake", 1): 2.0,
                   ("b", "up", 1): 2.0, ("b", "up", 4): 10.0, ("b", "up", 5): None}
    assert {(r.term, r.role, r.kind) for r in out.collect()} == {("up", "inflow", "flow"), ("lake", "storage", "storage")}
    assert "WindowGroupLimit" not in out._jdf.queryExecution().optimizedPlan().toString()
