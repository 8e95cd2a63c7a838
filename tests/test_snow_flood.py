import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import climate, snow, status

D = dt.date
TH = "site_uid string, stage_units string, flow_units string, action_stage double, minor_stage double, moderate_stage double, major_stage double, action_flow double, minor_flow double, moderate_flow double, major_flow double"
RD = "site_uid string, time timestamp, stage double, flow double"


def thresholds(frame):
    return frame([("g", "ft", "cfs", 7.0, 8.5, 10.0, 12.0, None, None, None, None), ("f", None, "kcfs", None, None, None, None, 1.0, 2.0, None, None), ("none", "ft", "cfs", None, None, None, None, None, None, None, None)], TH)


def readings(frame, stages, site="g"):
    return frame([(site, f"2026-05-01 {i:02d}:00:00", float(s), None) for i, s in enumerate(stages)], RD)


def test_a_flood_is_held_for_two_readings(frame):
    r = status.assess(readings(frame, [6, 8, 10.2, 12.5, 14.07, 13, 6]), thresholds(frame)).first()
    assert (r.reached, r.current, r.peak_stage) == ("major", None, 14.07) and r.last_stage == 6.0


def test_a_single_spike_is_no_flood(frame):
    r = status.assess(readings(frame, [6, 20, 6, 6]), thresholds(frame)).first()
    assert (r.reached, r.current, r.peak_stage) == (None, None, 20.0)


def test_flow_levels_are_scaled_and_gauges_without_levels_drop_out(frame):
    d = frame([("f", f"2026-05-01 0{i}:00:00", None, v) for i, v in enumerate((500.0, 2500.0, 2600.0))] + [("none", "2026-05-01 00:00:00", 99.0, None)], RD)
    out = {r.site_uid: (r.reached, r.current, r.peak_flow) for r in status.assess(d, thresholds(frame)).collect()}
    assert out == {"f": ("minor", "minor", 2600.0)}


def test_summary_is_worst_first_and_current_only_when_fresh(frame):
    a = status.assess(readings(frame, [9, 9, 9]).union(readings(frame, [13, 13], "h")), thresholds(frame).union(thresholds(frame).where("site_uid = 'g'").withColumn("site_uid", F.lit("h"))))
    out = [(r.site_uid, r.category, r.current) for r in status.flood_summary(a, F.lit("2026-05-01 08:00:00").cast("timestamp")).collect()]
    assert out == [("h", "major", None), ("g", "minor", "minor")]


def test_new_snow_needs_water(frame):
    rows = [("2024-01-01", 10.0, 2.0), ("2024-01-02", 15.0, 2.5), ("2024-01-03", 17.0, 2.5), ("2024-01-05", 20.0, 3.0), ("2024-01-06", 60.0, 6.0), ("2024-01-07", 60.5, 6.2)]
    d = frame([("s", *r) for r in rows], "site_uid string, date date, depth double, swe double")
    assert [r.new for r in snow.new_snow(d).orderBy("date").collect()] == [None, 5.0, 0.0, None, None, 0.0, 0.0]


def test_window_totals_and_pooled_rating(frame):
    rows = [(s, (D(y - 1, 12, 1) + dt.timedelta(days=i)).isoformat(), float(y - 2000)) for s in ("a", "b") for y in range(2004, 2026) for i in range(31) if not (s == "b" and y == 2010)]
    new = frame(rows, "site_uid string, date date, new double")
    t = snow.window_totals(new, F.lit("2024-12-20").cast("date"), list(range(2004, 2025)))
    now = {(r.site_uid, r.kind): r.total for r in t.where("wy = 2025").collect()}
    assert now == {("a", "new24"): 25.0, ("b", "new24"): 25.0, ("a", "new7"): 175.0, ("b", "new7"): 175.0}
    m = frame([("a", "p"), ("b", "p")], "site_uid string, place string")
    r = {x.kind: x for x in snow.rate_new_snow(t, m, F.lit(2025), (2004, 2024)).collect()}
    assert r["new24"].n == 20 and r["new24"].stations == 2 and r["new24"].pct == 100.0 and r["new24"].cls == "much above normal"


def test_rate_calls_little_snow_little(frame):
    d = frame([(0.01, [0.0] * 30), (5.0, [1.0, 2.0] * 15), (5.0, [1.0] * 3), (None, [1.0] * 30)], "v double, p array<double>")
    out = [(r.cls, r.little, r.usual) for r in snow.rate(d, "v", "p", "swe").collect()]
    assert out == [(None, True, 0.0), ("much above normal", False, 1.5), (None, False, None), (None, False, None)]


def test_bands_do_not_wrap_the_water_year(frame):
    rows = [("u", (D(y, 10, 1) + dt.timedelta(days=i)).isoformat(), float(i)) for y in range(2004, 2010) for i in range(365)]
    b = {r.day: r for r in snow.band(frame(rows, "unit string, date date, value double"), "value", ["unit"]).collect()}
    assert b[0].p50 == 1.5 and b[0].years == 6


def test_window_rain_against_other_years(frame):
    rows = [("u", (D(y, 6, 1) + dt.timedelta(days=i)).isoformat(), 1.0 if y < 2026 else 2.0) for y in range(1991, 2027) for i in range(30)]
    d = frame(rows, "unit string, date date, value double")
    r = climate.window_stats(d, ["unit"], "value", (7, 30, 90)).orderBy("days").collect()
    assert [x.days for x in r] == [7, 30] and r[1].amount == 60.0 and r[1].normal == 30.0 and r[1].percent_of_normal == 200.0 and r[1].years == 30 and r[1].cls == "much above normal"
    few = climate.window_stats(d.where("year(date) > 2005"), ["unit"], "value", (30,)).first()
    assert few.normal is None and few.percentile is None and few.amount == 60.0


def test_drought_weeks_are_complete_and_circular(frame):
    rows = []
    for y in range(2000, 2026):
        for k, base in (("d0", 50), ("d1", 20), ("d2", 5), ("d3", 0), ("d4", 0), ("dsci", y - 2000)):
            rows.append(("nm", D(y, 12, 28).isoformat(), k, float(base), y))
    rows += [("nm", "2026-01-05", k, float(v), 1) for k, v in (("d0", 60), ("d1", 10), ("d2", 0), ("d3", 0), ("d4", 0), ("dsci", 13))] + [("nm", "2026-01-12", "d0", 9.0, 1)]
    w = climate.weekly_drought(frame(rows, "unit string, date date, variable string, value double, order int"), ["unit"])
    assert w.count() == 27
    r = climate.drought_summary(w, ["unit"]).first()
    assert r.as_of == D(2026, 1, 5) and r.worst_category == "D1" and r.sample_years == 26 and abs(r.percentile - 100 * 13.5 / 26) < 1e-9


def test_rules_are_checked_in_one_pass(frame):
    d = frame([("a", 5.0, "much below normal"), ("b", 120.0, "normal"), ("c", None, "normal"), ("d", None, None)], "k string, pct double, cls string")
    out = {(r.subject, r.rule) for r in status.violations(d, F.col("k"), status.rating_rules()).collect()}
    assert out == {("b", "percentile outside 0..100"), ("b", "class does not fit percentile"), ("c", "class without percentile")}


def test_rolling_heat_allows_one_missing_day(frame):
    rows = [("s", "seg", True, (D(y, 6, 1) + dt.timedelta(days=i)).isoformat(), 20.0 + (10.0 if i == 40 else 0.0)) for y in (2018, 2019, 2020) for i in range(100) if i != 41]
    d = frame(rows, "name string, segment string, has_max boolean, date date, value double")
    out = {r.year: r.value for r in status.heat_years(d).collect()}
    assert set(out) == {2018, 2019, 2020} and abs(out[2018] - (20.0 + 10.0 / 6)) < 1e-9


def test_rolling_heat_reads_its_days_once_and_files_no_reading_twice(frame, spark):
    """A window that ends on a day without a reading, in the next year too; days of a sensor pass one aggregate and two shuffles."""
    days = [D(y, 6, 1) + dt.timedelta(days=i) for y in (2018, 2019, 2020) for i in range(70)] + [D(2018, 12, 26) + dt.timedelta(days=i) for i in range(6)] + [D(2019, 1, 5)]
    rows = [("s", "w", x.isoformat(), "daily", stat, 50.0 if x.month == 12 else 20.0) for x in days for stat in ("mean", "max")] + [("t", "w", "2018-06-01", "daily", "mean", 1.0)]
    q = frame(rows, "site_uid string, kind string, date date, interval string, statistic string, value double").withColumn("variable", F.lit("water_temp"))
    sites = frame([("s", "s", "seg"), ("t", "t", "seg")], "site_uid string, name string, segment string")
    d = status.temperature_days(q, sites)
    assert {(r.name, r.has_max): r["count"] for r in d.groupBy("name", "has_max").count().collect()} == {("s", True): len(days), ("t", False): 1}
    out = status.heat_years(d)
    assert {(r.year, r.value, r.metric, r.years) for r in out.collect()} == {(2018, 50.0, "7DADM", 3), (2019, 50.0, "7DADM", 3), (2020, 20.0, "7DADM", 3)}
    big = spark.range(10).select(F.col("id").cast("string").alias("site_uid"), F.lit("water_temp").alias("variable"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.lit("daily").alias("interval"), F.lit("max").alias("statistic"), F.rand().alias("value"))
    plan = status.heat_years(status.temperature_days(big, sites))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and "sequence(" not in plan


def test_temperature_season_needs_enough_earlier_days(frame, spark):
    first = D(2019, 1, 1)
    rows = [("a", "s", (first + dt.timedelta(days=i)).isoformat(), float(i // 365)) for i in range(731)] + [("a", "s", "2021-01-01", 9.0), ("a", "s", "2022-01-02", 9.0)] + [("b", "s", "2019-01-01", 1.0), ("b", "s", "2021-01-01", 1.0)]
    days = frame(rows, "name string, segment string, date date, value double")
    out = {(r.name, r.doy): r for r in status.temperature_season(days, 2021).collect()}
    assert len(out) == 365 and {n for n, _ in out} == {"a"}
    assert (out["a", 1].p10, out["a", 1].p50, out["a", 1].this_year, out["a", 2].this_year) == (0.1, 0.5, 9.0, None)
    big = spark.range(10).select(F.col("id").alias("name"), F.col("id").alias("segment"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.rand().alias("value"))
    assert status.temperature_season(big, 2021)._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
