"""River flow queries."""

from pyspark.sql import functions as F

from tidemark.functions.literals import fixed
from tidemark.operators import flow as f
from tidemark.operators import quality as q
from tidemark.plans.registry import query


@query("flagship_weekly_flow", """
WITH mapped_flow AS (SELECT source, site_uid, datetime_utc, interval, statistic, depth_cm, value * 2.0 AS value, ingest_run_id FROM obs WHERE value <> 13),
 good AS (SELECT * FROM mapped_flow WHERE value <= 96.0),
 dedup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_uid, datetime_utc, interval, statistic, depth_cm ORDER BY ingest_run_id DESC, value DESC) AS rn FROM good) WHERE rn = 1),
 daily AS (SELECT site_uid, min(source) AS source, CAST(datetime_utc AS DATE) AS date, avg(value) AS cfs FROM dedup GROUP BY 1, 3),
 c AS (SELECT 'G' || (CAST(split_part(site_uid, ':', 2) AS BIGINT) // 5) AS gauge, date, source, site_uid, cfs FROM daily),
 best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gauge, date ORDER BY CASE source WHEN 'usgs' THEN 0 WHEN 'usbr_hydrodata' THEN 1 ELSE 5 END, site_uid) AS rn FROM c) WHERE rn = 1),
 wk AS (SELECT gauge, CAST(date_trunc('week', date) AS DATE) AS week_start, avg(cfs) AS m FROM best GROUP BY 1, 2 HAVING count(*) >= 4)
SELECT segment, strftime(week_start, '%Y-%m-%d') AS week_start, round(avg(m), 6) AS mean_cfs, count(*) AS n_gauges, round(min(m), 6) AS min_cfs, round(max(m), 6) AS max_cfs FROM wk JOIN gauges USING (gauge) GROUP BY 1, 2""")
def flagship(t):
    raw = t.obs.select("source", "site_uid", "datetime_utc", F.when(F.col("value") == 13, -9999.0).otherwise(F.col("value")).alias("value"), "qualifier", "source_param", "depth_cm", "ingest_run_id")
    xw = fixed(t.spark, [(s, "00060", "ft3/s", "discharge", 2.0, 0.0, "mean", "daily", "identical", None) for s in ("usgs", "usbr_hydrodata", "codwr")],
               "source string, source_param string, source_unit string, variable string, factor double, offset double, statistic string, interval string, equivalence string, depth_cm double")
    reg = fixed(t.spark, [("discharge", "cfs", 0.0, -0.9, 96.0, False, [-19998.0])],
                "variable string, unit string, valid_min double, noise_floor double, valid_max double, signed boolean, missing_codes array<double>")
    m = q.clean(q.drop_missing_codes(q.guard_nulls(q.apply_crosswalk(raw, xw, reg)), reg), reg)
    day = f.daily_flow(q.dedup_observations(m.drop("qc_flag")))
    src = F.split_part("site_uid", F.lit(":"), F.lit(1))
    gauge = F.concat(F.lit("G"), F.floor(F.split_part("site_uid", F.lit(":"), F.lit(2)).cast("bigint") / 5))
    chosen = f.pick_copy(day.select(gauge.alias("gauge"), "date", src.alias("source"), "site_uid", "cfs"))
    return f.segment_weekly(f.gauge_weekly(chosen), t.gauges.select("gauge", "segment"))


@query("G1_daily_flow", """
WITH r AS (SELECT 'e' || (user_id // 15) AS site_uid, ts, value, CASE WHEN event_id % 10 = 0 AND user_id % 2 = 0 THEN 'daily' WHEN event_id % 3 = 0 THEN '15min' ELSE 'hourly' END AS interval FROM events),
 d AS (SELECT site_uid, CAST(ts AS DATE) AS date, avg(value) AS cfs FROM r WHERE interval = 'daily' AND user_ok(ts) GROUP BY 1, 2),
 s AS (SELECT site_uid, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Denver' AS DATE) AS date, interval, avg(value) AS cfs, count(*) AS n FROM r WHERE interval <> 'daily' GROUP BY 1, 2, 3),
 k AS (SELECT site_uid, date, max_by(cfs, e) AS cfs FROM (SELECT *, CASE interval WHEN '15min' THEN 96 ELSE 24 END AS e FROM s) WHERE n >= 0.1 * e GROUP BY 1, 2)
SELECT site_uid, strftime(date, '%Y-%m-%d') AS date, round(cfs, 6) AS cfs FROM (SELECT * FROM d UNION ALL SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.site_uid = k.site_uid AND d.date = k.date))""".replace(" AND user_ok(ts)", " AND hour(ts) < 3"))
def g1(t):
    e = t.read("events")
    iv = F.when((F.col("event_id") % 10 == 0) & (F.col("user_id") % 2 == 0), "daily").when(F.col("event_id") % 3 == 0, "15min").otherwise("hourly")
    d = e.select(F.concat(F.lit("e"), F.floor(F.col("user_id") / 15)).alias("site_uid"), F.lit("discharge").alias("variable"), F.col("ts").cast("timestamp").alias("datetime_utc"), "value",
                 iv.alias("interval"), F.lit("mean").alias("statistic"), F.lit(None).cast("string").alias("qualifier"))
    d = d.where((F.col("interval") != "daily") | (F.hour("datetime_utc") < 3))
    return f.daily_flow(d, min_share=0.1).select("site_uid", "date", "cfs")


@query("G2_despiked_daily", """
WITH x AS (SELECT *, lag(value) OVER w AS p, lead(value) OVER w AS n FROM subdaily WINDOW w AS (PARTITION BY site_uid, variable ORDER BY datetime_utc)),
 y AS (SELECT *, CASE WHEN variable = 'reservoir_elevation' THEN 5.0 ELSE greatest(50.0, 0.2 * greatest(abs(p), abs(n))) END AS tol FROM x)
SELECT site_uid, variable, strftime(CAST(datetime_utc - INTERVAL 7 HOUR AS DATE), '%Y-%m-%d') AS date, round(avg(value), 6) AS value, count(*) AS n FROM y
WHERE variable NOT IN ('reservoir_storage', 'reservoir_elevation') OR p IS NULL OR n IS NULL OR NOT ((value - p > tol AND value - n > tol) OR (p - value > tol AND n - value > tol)) GROUP BY 1, 2, 3""")
def g2(t):
    return f.reservoir_daily(t.subdaily.drop("event_id"))


@query("G3_station_day", """
WITH r AS (SELECT 'e' || (user_id // 15) AS site_uid, date_trunc('hour', ts) AS ts, value, event_type FROM events)
SELECT site_uid, strftime(d, '%Y-%m-%d') AS date, coalesce(max(CASE WHEN k = 'daily' THEN value END), max(CASE WHEN k = 'hourly' THEN value END)) AS value FROM (
 SELECT site_uid, value, CASE WHEN event_type = 'click' THEN 'daily' ELSE 'hourly' END AS k, CASE WHEN event_type = 'click' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END AS d FROM r WHERE event_type = 'click' OR hour(ts) = 7) GROUP BY 1, 2""")
def g3(t):
    d = t.read("events").select(F.concat(F.lit("e"), F.floor(F.col("user_id") / 15)).alias("site_uid"), F.lit("swe").alias("variable"), F.date_trunc("hour", "ts").cast("timestamp").alias("datetime_utc"), "value",
                                F.when(F.col("event_type") == "click", "daily").otherwise("hourly").alias("interval"))
    return f.station_day(d, "swe")


@query("G4_pick_copy", "SELECT gauge, strftime(date, '%Y-%m-%d') AS date, source, site_uid, round(cfs, 6) AS cfs FROM chosen")
def g4(t):
    return t.chosen


@query("G4_splice", """
SELECT reservoir, strftime(date, '%Y-%m-%d') AS date, value, site_uid FROM (SELECT 'r' || (l_suppkey % 7) AS reservoir, CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS value, 's' || l_suppkey AS site_uid,
 row_number() OVER (PARTITION BY l_suppkey % 7, CAST(l_shipdate AS DATE) ORDER BY l_suppkey % 13, 's' || l_suppkey) AS rn FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)) WHERE rn = 1""")
def g4s(t):
    k = F.col("l_suppkey")
    d = t.read("lineitem").groupBy(F.concat(F.lit("s"), k).alias("site_uid"), F.to_date("l_shipdate").alias("date")).agg(F.max("l_quantity").alias("value"))
    s = t.read("supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("site_uid"), F.concat(F.lit("r"), F.col("s_suppkey") % 7).alias("reservoir"), (F.col("s_suppkey") % 13).alias("place"))
    return f.splice(d, s).select("reservoir", "date", "value", "site_uid")


@query("G5_complete_weeks", """
WITH n AS (SELECT source, CAST(max(datetime_utc) AS DATE) AS d FROM obs GROUP BY 1), e AS (SELECT source, CAST(date_trunc('week', d + 1) AS DATE) - 7 AS m FROM n)
SELECT source, strftime(m - CAST(7 * i AS INTEGER), '%Y-%m-%d') AS week_start FROM e, range(0, 52) g(i)""")
def g5(t):
    last = t.obs.groupBy("source").agg(F.to_date(F.max("datetime_utc")).alias("d"))
    return f.week_starts(last, "d").drop("d")


@query("G6_gauge_weekly", """
WITH c AS (SELECT gauge, CAST(date_trunc('week', date) AS DATE) AS w, source, count(*) AS c FROM chosen GROUP BY 1, 2, 3), m AS (SELECT gauge, w, source FROM (SELECT *, row_number() OVER (PARTITION BY gauge, w ORDER BY c DESC, source) AS rn FROM c) WHERE rn = 1)
SELECT gauge, strftime(w, '%Y-%m-%d') AS week_start, round(mean_cfs, 6) AS mean_cfs, n_days, source AS source_used FROM gauge_weeks JOIN m USING (gauge) WHERE w = week_start""")
def g6(t):
    return t.gauge_weeks


@query("G7_eligible_gauges", "SELECT gauge, count(DISTINCT week_start) AS weeks FROM gauge_weeks GROUP BY 1 HAVING count(DISTINCT week_start) >= 26")
def g7(t):
    return f.eligible_gauges(t.gauge_weeks)


SEG = "seg AS (SELECT segment, week_start, avg(mean_cfs) AS mean_cfs, count(*) AS n_gauges, min(mean_cfs) AS min_cfs, max(mean_cfs) AS max_cfs FROM gauge_weeks JOIN gauges USING (gauge) GROUP BY 1, 2)"


@query("G8_segment_weekly", f"WITH {SEG} SELECT segment, strftime(week_start, '%Y-%m-%d') AS week_start, round(mean_cfs, 6) AS mean_cfs, n_gauges, round(min_cfs, 6) AS min_cfs, round(max_cfs, 6) AS max_cfs FROM seg")
def g8(t):
    return f.segment_weekly(t.gauge_weeks, t.gauges)


@query("G9_top_segments", """
SELECT river, segment, weight, place FROM (SELECT river, segment, count(*) AS weight, row_number() OVER (PARTITION BY river ORDER BY count(*) DESC, segment) AS place FROM gauge_weeks JOIN gauges USING (gauge) GROUP BY 1, 2) WHERE place <= 3""")
def g9(t):
    return f.keep_segments(t.gauge_weeks, t.gauges, 3)


AGAINST = "m AS (SELECT c.gauge, c.date, c.source, c.cfs, k.source AS used_source, k.cfs AS used FROM copies c JOIN chosen k ON k.gauge = c.gauge AND k.date = c.date WHERE c.source <> k.source)"


@query("G10_copy_agreement", f"""
WITH {AGAINST}, p AS (SELECT *, CASE WHEN abs(used) >= 10 THEN abs(cfs - used) / abs(used) * 100 END AS pct FROM m)
SELECT gauge, source, count(*) AS overlap_days, count(*) FILTER (WHERE pct > 10 AND abs(cfs - used) > 5) AS days_off, round(median(pct), 1) AS median_abs_pct_diff FROM p GROUP BY 1, 2""")
def g10(t):
    return f.copy_agreement(t.copies, t.chosen)


SCREEN = """peaks AS (SELECT gauge, year(date) + (month(date) >= 10)::INT AS wy, max(cfs) * 0.8 AS peak FROM copies WHERE source = 'usgs' AND month(date) % 2 = 0 GROUP BY 1, 2),
 excl AS (SELECT gauge, DATE '1997-03-01' AS a, DATE '1997-05-15' AS z FROM gauges WHERE segment IN ('S1', 'S3')),
 scr AS (SELECT c.*, p.wy, p.peak, CASE WHEN EXISTS (SELECT 1 FROM excl e WHERE e.gauge = c.gauge AND c.date BETWEEN e.a AND e.z) THEN 'listed' WHEN c.cfs > 1.05 * p.peak AND NOT (c.source = 'usgs' AND c.qualifier <> 'F') THEN 'above_peak'
  WHEN c.cfs > 1.05 * p.peak THEN 'conflict' ELSE 'kept' END AS verdict FROM copies c LEFT JOIN peaks p ON p.gauge = c.gauge AND p.wy = year(c.date) + (month(c.date) >= 10)::INT)"""


def screened(t):
    c = t.copies.withColumn("qualifier", F.when(F.col("qualifier") == "F", "A:e").otherwise("A"))
    peaks = f.annual_peaks(t.copies.where("source = 'usgs' AND month(date) % 2 = 0")).withColumn("peak", F.col("peak") * 0.8)
    excl = t.gauges.where("segment IN ('S1', 'S3')").select("gauge", F.lit("1997-03-01").cast("date").alias("first"), F.lit("1997-05-15").cast("date").alias("last"))
    return f.screen_values(c, peaks, excl)


@query("G11_screen_values", f"WITH {SCREEN} SELECT gauge, source, verdict, count(*) AS n, round(sum(cfs), 4) AS total FROM scr GROUP BY 1, 2, 3")
def g11(t):
    return screened(t).groupBy("gauge", "source", "verdict").agg(F.count("*").alias("n"), F.round(F.sum("cfs"), 4).alias("total"))


@query("G12_explorer", f"""
WITH {SEG}, b AS (SELECT segment, min(week_start) AS a, max(week_start) AS z FROM seg GROUP BY 1), cal AS (SELECT segment, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week_start FROM b)
SELECT c.segment, strftime(c.week_start, '%Y-%m-%d') AS week_start, round(CAST(mean_cfs AS DECIMAL(18, 6)), 1)::DOUBLE AS v, n_gauges FROM cal c LEFT JOIN seg s ON s.segment = c.segment AND s.week_start = c.week_start""")
def g12(t):
    return f.explorer(f.segment_weekly(t.gauge_weeks, t.gauges))


@query("G13_gauge_inventory", """
WITH s AS (SELECT gauge, string_agg(DISTINCT source, ', ' ORDER BY source) AS copies FROM copies GROUP BY 1), w AS (SELECT gauge, strftime(min(week_start), '%Y-%m-%d') AS first_week, strftime(max(week_start), '%Y-%m-%d') AS last_week, count(*) AS weeks FROM gauge_weeks GROUP BY 1)
SELECT gauge, segment, river, first_week, last_week, weeks, copies, weeks >= 26 AS in_mean FROM gauges JOIN w USING (gauge) JOIN s USING (gauge)""".replace("string_agg(DISTINCT source, ', ' ORDER BY source) AS copies FROM copies", "string_agg(source, ', ' ORDER BY source) AS copies FROM (SELECT DISTINCT gauge, source FROM copies)"))
def g13(t):
    return f.gauge_inventory(t.copies, t.gauge_weeks, t.gauges)


@query("G14_river_report", """
WITH e AS (SELECT gauge FROM gauge_weeks GROUP BY 1 HAVING count(*) >= 26), s AS (SELECT river, segment, week_start, avg(mean_cfs) AS mean_cfs, count(*) AS n_gauges, min(mean_cfs) AS min_cfs, max(mean_cfs) AS max_cfs FROM gauge_weeks JOIN gauges USING (gauge) WHERE gauge IN (SELECT gauge FROM e) GROUP BY 1, 2, 3),
 z AS (SELECT CAST(date_trunc('week', max(date) + 1) AS DATE) - 7 AS m FROM chosen)
SELECT river, segment, strftime(week_start, '%Y-%m-%d') AS week_start, round(mean_cfs, 6) AS mean_cfs, n_gauges, round(min_cfs, 6) AS min_cfs, round(max_cfs, 6) AS max_cfs FROM s, z WHERE week_start BETWEEN m - 7 * 51 AND m""")
def g14(t):
    return f.river_report(t.copies.drop("qualifier"), t.gauges)
