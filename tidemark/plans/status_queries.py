"""Flood, quality, mart and consistency queries."""

from pyspark.sql import functions as F

from tidemark.operators import flow as f
from tidemark.operators import network as n
from tidemark.operators import normals as nm
from tidemark.operators import status as s
from tidemark.plans.network_queries import part_series, snap_reaches
from tidemark.plans.network_queries import stations as reach_stations
from tidemark.plans.normals_queries import CLS, RATED, SEGRATED, rated
from tidemark.plans.registry import query


def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")

THR = """thr AS (SELECT 'nwps:' || s_suppkey AS site_uid, CASE WHEN s_suppkey % 4 = 3 THEN 'm' ELSE 'ft' END AS stage_units, CASE WHEN s_suppkey % 2 = 0 THEN 'cfs' ELSE 'kcfs' END AS flow_units, 20.0 + s_suppkey AS action_stage, CASE WHEN s_suppkey % 3 > 0 THEN 60.0 END AS minor_stage, 120.0 AS moderate_stage, 250.0 AS major_stage,
  CASE WHEN s_suppkey % 2 = 0 THEN 15.0 ELSE 0.015 END AS action_flow, CASE WHEN s_suppkey % 2 = 0 THEN 50.0 ELSE 0.05 END AS minor_flow, CASE WHEN s_suppkey % 2 = 0 THEN 110.0 ELSE 0.11 END AS moderate_flow, CAST(NULL AS DOUBLE) AS major_flow FROM supplier),
 lev AS (SELECT site_uid, CASE WHEN stage_units = 'ft' THEN action_stage END AS a_st, CASE WHEN stage_units = 'ft' THEN minor_stage END AS b_st, CASE WHEN stage_units = 'ft' THEN moderate_stage END AS c_st, CASE WHEN stage_units = 'ft' THEN major_stage END AS d_st,
  CASE WHEN stage_units = 'ft' THEN NULL ELSE action_flow * fx END AS a_fl, CASE WHEN stage_units = 'ft' AND minor_stage IS NOT NULL THEN NULL ELSE minor_flow * fx END AS b_fl, CASE WHEN stage_units = 'ft' THEN NULL ELSE moderate_flow * fx END AS c_fl FROM (SELECT *, CASE flow_units WHEN 'cfs' THEN 1.0 ELSE 1000.0 END AS fx FROM thr)),
 rdg AS (SELECT site_uid, date_trunc('minute', datetime_utc) AS time, max(value) FILTER (WHERE variable = 'stage') AS stage, max(value) FILTER (WHERE variable = 'discharge') AS flow FROM subdaily WHERE variable IN ('stage', 'discharge') AND date_trunc('minute', datetime_utc) >= TIMESTAMP '2024-01-31' - INTERVAL {days} DAY AND site_uid IN (SELECT site_uid FROM thr) GROUP BY 1, 2),
 rk AS (SELECT r.*, CASE WHEN stage >= d_st THEN 4 WHEN stage >= c_st OR flow >= c_fl THEN 3 WHEN stage >= b_st OR flow >= b_fl THEN 2 WHEN stage >= a_st OR flow >= a_fl THEN 1 ELSE 0 END AS rank FROM rdg r JOIN lev USING (site_uid)),
 hd AS (SELECT *, coalesce(least(rank, lag(rank) OVER (PARTITION BY site_uid ORDER BY time)), 0) * (CASE WHEN lag(rank) OVER (PARTITION BY site_uid ORDER BY time) IS NULL THEN 0 ELSE 1 END) AS held FROM rk)"""


def thresholds(t):
    k = F.col("s_suppkey")
    even = k % 2 == 0
    return t.read("supplier").select(
        F.concat(F.lit("nwps:"), k).alias("site_uid"), F.when(k % 4 == 3, "m").otherwise("ft").alias("stage_units"), F.when(even, "cfs").otherwise("kcfs").alias("flow_units"), (20.0 + k).alias("action_stage"),
        F.when(k % 3 > 0, 60.0).alias("minor_stage"), F.lit(120.0).alias("moderate_stage"), F.lit(250.0).alias("major_stage"), F.when(even, 15.0).otherwise(0.015).alias("action_flow"), F.when(even, 50.0).otherwise(0.05).alias("minor_flow"),
        F.when(even, 110.0).otherwise(0.11).alias("moderate_flow"), F.lit(None).cast("double").alias("major_flow"))


def readings(t, days):
    return s.read_window(t.subdaily.withColumn("datetime_utc", F.date_trunc("minute", "datetime_utc")), thresholds(t), now(), days)


@query("J33_flood_levels", f"WITH {THR.format(days=3)} SELECT site_uid, a_st::DOUBLE AS action_st, b_st::DOUBLE AS minor_st, c_st::DOUBLE AS moderate_st, d_st::DOUBLE AS major_st, round(a_fl, 6)::DOUBLE AS action_fl, round(b_fl, 6)::DOUBLE AS minor_fl, round(c_fl, 6)::DOUBLE AS moderate_fl, CAST(NULL AS DOUBLE) AS major_fl FROM lev")
def j33(t):
    return s.flood_levels(thresholds(t))


@query("J33_reading_ranks", f"WITH {THR.format(days=40)} SELECT site_uid, strftime(time, '%Y-%m-%d %H:%M:%S') AS time, stage, flow, CAST(rank AS BIGINT) AS rank, CAST(held AS BIGINT) AS held FROM hd")
def j33r(t):
    return s.ranked_readings(readings(t, 40), thresholds(t))


CAT = "CASE {c} WHEN 1 THEN 'action' WHEN 2 THEN 'minor' WHEN 3 THEN 'moderate' WHEN 4 THEN 'major' END"
ASSESS = """tp AS (SELECT site_uid, max(held) AS top, count(stage) AS ns FROM hd GROUP BY 1), pj AS (SELECT hd.*, top, CASE WHEN ns > 0 THEN stage ELSE flow END AS k FROM hd JOIN tp USING (site_uid)),
 pp AS (SELECT site_uid, min_by((time, stage, flow), (-k, time)) FILTER (WHERE rank >= top AND k IS NOT NULL) AS p, max_by((time, stage, flow), time) AS l, max_by(held, time) AS cur, min(top) AS top FROM pj GROUP BY 1)"""
ASSESS = """tp AS (SELECT site_uid, max(held) AS top, count(stage) AS ns FROM hd GROUP BY 1), pj AS (SELECT hd.*, top, CASE WHEN ns > 0 THEN stage ELSE flow END AS k FROM hd JOIN tp USING (site_uid)),
 pk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_uid ORDER BY k DESC, time) AS rn FROM pj WHERE rank >= top AND k IS NOT NULL) WHERE rn = 1), la AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_uid ORDER BY time DESC) AS rn FROM pj) WHERE rn = 1),
 asd AS (SELECT la.site_uid, la.top, la.held AS cur, CASE WHEN pk.site_uid IS NULL THEN la.time ELSE pk.time END AS pt, CASE WHEN pk.site_uid IS NULL THEN la.stage ELSE pk.stage END AS ps, CASE WHEN pk.site_uid IS NULL THEN la.flow ELSE pk.flow END AS pf, la.time AS lt, la.stage AS ls FROM la LEFT JOIN pk ON pk.site_uid = la.site_uid)"""


@query("J34_assess", f"""WITH {THR.format(days=3)}, {ASSESS} SELECT site_uid, {CAT.format(c='top')} AS reached, {CAT.format(c='cur')} AS current, strftime(pt, '%Y-%m-%d %H:%M:%S') AS peak_time, ps AS peak_stage, pf AS peak_flow, strftime(lt, '%Y-%m-%d %H:%M:%S') AS last_time, ls AS last_stage FROM asd""")
def j34(t):
    return s.assess(readings(t, 3), thresholds(t))


@query("J35_flood_summary", f"""WITH {THR.format(days=20)}, {ASSESS} SELECT site_uid, {CAT.format(c='top')} AS category, CASE WHEN cur >= 2 AND lt >= TIMESTAMP '2024-01-31' - INTERVAL 6 HOUR THEN {CAT.format(c='cur')} END AS current, strftime(pt, '%Y-%m-%d %H:%M:%S') AS peak_time, ps AS peak_stage, pf AS peak_flow,
 strftime(lt, '%Y-%m-%d %H:%M:%S') AS last_time, ls AS last_stage, CAST(top AS BIGINT) AS rank FROM asd WHERE top >= 2""")
def j35(t):
    return s.flood_summary(s.assess(readings(t, 20), thresholds(t)), now())


@query("J35_checked", f"WITH {THR.format(days=3)}, {ASSESS} SELECT count(*) AS checked, strftime(max(lt), '%Y-%m-%d %H:%M:%S') AS latest_reading FROM asd")
def j35c(t):
    return s.flood_checked(s.assess(readings(t, 3), thresholds(t)))


TQ = """td AS (SELECT c.gauge AS name, g.segment, CAST(substr(c.gauge, 2) AS BIGINT) % 2 = 0 AS has_max, c.date, c.cfs AS value FROM chosen c JOIN gauges g ON g.gauge = c.gauge)"""


def sensors(t):
    k = F.substring("gauge", 2, 9).cast("bigint") % 2
    q = t.chosen.select(F.col("gauge").alias("site_uid"), F.lit("water_temp").alias("variable"), "date", F.lit("daily").alias("interval"), F.when(k == 0, "max").otherwise("mean").alias("statistic"), F.col("cfs").alias("value"))
    return s.temperature_days(q, t.gauges.select(F.col("gauge").alias("site_uid"), F.col("gauge").alias("name"), "segment"))


@query("J30_heat_years", f"""WITH {TQ}, su AS (SELECT name, segment, has_max, year(date) AS y FROM td WHERE month(date) IN (6, 7, 8, 9) GROUP BY 1, 2, 3, 4 HAVING count(*) >= 60), en AS (SELECT name, count(*) AS years FROM su GROUP BY 1 HAVING count(*) >= 3),
 sp AS (SELECT name, segment, has_max, min(date) AS a, max(date) AS z FROM td GROUP BY 1, 2, 3), ca AS (SELECT name, segment, has_max, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM sp),
 ro AS (SELECT ca.name, ca.segment, ca.has_max, ca.date, CASE WHEN count(value) OVER w >= 6 THEN avg(value) OVER w END AS r FROM ca LEFT JOIN td ON td.name = ca.name AND td.date = ca.date WINDOW w AS (PARTITION BY ca.name ORDER BY ca.date ROWS 6 PRECEDING))
SELECT ro.name, ro.segment, su.y AS year, round(max(r), 6) AS value, CASE WHEN ro.has_max THEN '7DADM' ELSE '7-day mean' END AS metric, en.years FROM ro JOIN su ON su.name = ro.name AND su.y = year(ro.date) JOIN en ON en.name = ro.name GROUP BY 1, 2, 3, ro.has_max, en.years""")
def j30(t):
    return s.heat_years(sensors(t))


@query("J30_temperature_season", f"""WITH {TQ}, d AS (SELECT *, least(dayofyear(date), 365) AS doy FROM td), e AS (SELECT name FROM d WHERE year(date) < 2001 GROUP BY 1 HAVING count(*) > 365), b AS (SELECT name, segment, doy, quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.9) AS p90 FROM d WHERE year(date) < 2001 AND name IN (SELECT name FROM e) GROUP BY 1, 2, 3),
 c AS (SELECT name, doy, avg(value) AS this_year FROM d WHERE year(date) = 2001 GROUP BY 1, 2) SELECT b.name, segment, b.doy, round(p10, 6) AS p10, round(p50, 6) AS p50, round(p90, 6) AS p90, round(this_year, 6) AS this_year FROM b LEFT JOIN c ON c.name = b.name AND c.doy = b.doy""")
def j30s(t):
    return s.temperature_season(sensors(t), 2001)


SAL = "sl AS (SELECT c.site_uid, g.segment, c.date, CASE WHEN source = 'usgs' THEN 'sensor' ELSE 'samples' END AS kind, c.cfs AS value FROM copies c JOIN gauges g ON g.gauge = c.gauge WHERE source <> 'usbr_hydrodata')"


def salinity(t):
    q = t.copies.where("source <> 'usbr_hydrodata'").select("site_uid", F.lit("specific_conductance").alias("variable"), "date", F.when(F.col("source") == "usgs", "daily").otherwise("irregular").alias("interval"), F.lit("mean").alias("statistic"), F.col("cfs").alias("value"))
    sites = t.copies.select("site_uid", "gauge").distinct().join(t.gauges, "gauge").select("site_uid", "segment")
    return s.salinity_days(q, sites)


@query("J31_salinity_profile", f"WITH {SAL} SELECT segment, year(date) // 10 * 10 AS decade, round(median(value), 6) AS median, count(*) AS n_days FROM sl GROUP BY 1, 2")
def j31(t):
    return s.salinity_profile(salinity(t))


@query("J31_salinity_years", f"WITH {SAL} SELECT segment, year(date) AS year, kind, round(median(value), 6) AS median, count(*) AS n_days FROM sl GROUP BY 1, 2, 3")
def j31y(t):
    return s.salinity_years(salinity(t))


@query("J32_quality_sites", """SELECT f.gnis_id, 's:' || p_partkey AS site_uid, f.huc8_name AS segment, CASE WHEN p_partkey % 3 = 0 THEN 'usgs' ELSE 'codwr' END AS source, 'River ' || p_name || CASE WHEN p_size % 6 = 0 THEN ' Ditch' ELSE ' near Town' END AS name, f.totdasqkm FROM part JOIN flowlines f ON f.comid = p_partkey
WHERE p_size % 9 <> 0 AND f.gnis_id IS NOT NULL AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)""")
def j32(t):
    seg = n.river_segments(snap_reaches(t), reach_stations(t), t.flowlines)
    return s.quality_sites(seg, t.flowlines, part_series(t).withColumn("variable", F.lit("water_temp")))


@query("J32_quality_days", """SELECT 'e' || (user_id // 15) AS site_uid, CASE WHEN event_type = 'click' THEN 'water_temp' ELSE 'specific_conductance' END AS variable, strftime(CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Denver' AS DATE), '%Y-%m-%d') AS date, CASE WHEN event_id % 2 = 0 THEN '15min' ELSE 'irregular' END AS interval,
 CASE WHEN event_id % 3 = 0 THEN 'max' ELSE 'instantaneous' END AS statistic, round(avg(value), 6) AS value FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2, 3, 4, 5""")
def j32d(t):
    site = F.concat(F.lit("e"), F.floor(F.col("user_id") / 15))
    o = t.read("events").select(site.alias("site_uid"), F.when(F.col("event_type") == "click", "water_temp").when(F.col("event_type") == "view", "specific_conductance").otherwise("stage").alias("variable"), F.col("ts").cast("timestamp").alias("datetime_utc"),
                                F.when(F.col("event_id") % 2 == 0, "15min").otherwise("irregular").alias("interval"), F.when(F.col("event_id") % 3 == 0, "max").alias("statistic"), "value")
    sites = o.select("site_uid").distinct()
    return s.quality_days(o, sites)


@query("J36_overview", f"""WITH {RATED}, {SEGRATED}, {TQ}, {SAL}, so AS (SELECT DISTINCT segment FROM gauges), sf AS (SELECT segment, week_start, avg(mean_cfs) AS m FROM gauge_weeks JOIN gauges USING (gauge) GROUP BY 1, 2), fl AS (SELECT segment, max_by(m, week_start) AS flow, max(week_start) AS week, count(*) FILTER (WHERE week_start > w - INTERVAL 364 DAY) AS spark FROM (SELECT *, max(week_start) OVER (PARTITION BY segment) AS w FROM sf) GROUP BY 1),
 rr AS (SELECT segment, max_by(pct, week_start) AS pct, max_by(cls, week_start) AS cls FROM segrated GROUP BY 1), da AS (SELECT gauge FROM chosen GROUP BY 1 HAVING avg((cfs < 0.1)::INT) >= 0.9), dd AS (SELECT segment, date, count(*) FILTER (WHERE cfs < 0.1) AS n FROM chosen JOIN gauges USING (gauge) WHERE gauge NOT IN (SELECT gauge FROM da) GROUP BY 1, 2),
 dy AS (SELECT segment, year(date) AS y, count(*) FILTER (WHERE n > 0) AS k FROM dd GROUP BY 1, 2), dr AS (SELECT segment, max_by(k, y) AS dry, median(k) FILTER (WHERE y BETWEEN 1991 AND 2020) AS dry_median FROM dy GROUP BY 1), tb AS (SELECT name FROM td WHERE year(date) < 2001 GROUP BY 1 HAVING count(*) > 365),
 tc AS (SELECT name, segment, least(dayofyear(date), 365) AS doy, avg(value) AS v FROM td WHERE year(date) = 2001 AND name IN (SELECT name FROM tb) GROUP BY 1, 2, 3), tk AS (SELECT tc.* FROM tc WHERE EXISTS (SELECT 1 FROM td WHERE td.name = tc.name AND year(td.date) < 2001 AND least(dayofyear(td.date), 365) = tc.doy)), tl AS (SELECT segment, max_by(v, (doy, name)) AS temp FROM tk GROUP BY 1),
 sp AS (SELECT segment, year(date) // 10 * 10 AS decade, median(value) AS m FROM sl GROUP BY 1, 2), sc AS (SELECT segment, max_by(m, decade) AS salinity, max(decade) AS salinity_decade FROM sp GROUP BY 1), rm AS (SELECT 'S' || substr(unit, 2) AS segment, date_trunc('month', date) AS month, sum(value) AS total FROM unit_days GROUP BY 1, 2),
 rn AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY month DESC) AS k FROM rm), ra AS (SELECT segment, 100 * sum(total) / sum(total * 1.1) AS precip3_pct FROM rn WHERE k <= 3 GROUP BY 1), dc AS (SELECT segment, max_by(total, month) AS dsci FROM rm GROUP BY 1)
SELECT so.segment, round(flow, 6) AS flow, strftime(week, '%Y-%m-%d') AS week, spark, round(pct, 6) AS pct, cls, dry, dry_median::DOUBLE AS dry_median, round(temp, 6) AS temp, round(salinity, 6) AS salinity, salinity_decade, round(precip3_pct, 6) AS precip3_pct, round(dsci, 6) AS dsci
FROM so LEFT JOIN fl USING (segment) LEFT JOIN rr USING (segment) LEFT JOIN dr USING (segment) LEFT JOIN tl USING (segment) LEFT JOIN sc USING (segment) LEFT JOIN ra USING (segment) LEFT JOIN dc USING (segment)""")
def j36(t):
    # six parts read these: each is worked out once, the later ones from the earlier
    t.keep("copies", "chosen", "gauge_weeks")
    g = t.gauges
    seg = f.segment_weekly(t.gauge_weeks, g.select("gauge", "segment"))
    days = sensors(t)
    rain = t.unit_days.withColumn("segment", F.concat(F.lit("S"), F.substring("unit", 2, 9))).groupBy("segment", F.trunc("date", "month").alias("month")).agg(F.sum("value").alias("total")).withColumn("normal", F.col("total") * 1.1).withColumn("complete", F.lit(True))
    drought = rain.groupBy("segment").agg(F.max_by("total", "month").alias("dsci"))
    out = s.overview(g.select("segment").distinct(), seg, nm.segment_ratings(rated(t)), nm.drying(t.chosen, g), s.latest_temperature(s.temperature_season(days, 2001)), s.salinity_profile(salinity(t)), s.three_month_rain(rain), drought)
    return out.withColumn("spark", F.size("spark"))


@query("J37_period_status", f"""WITH {RATED}, {SEGRATED}, r AS (SELECT gr.river, s.* FROM segrated s JOIN (SELECT DISTINCT river, segment FROM gauges) gr USING (segment) WHERE cls IS NOT NULL), wrk AS (SELECT *, row_number() OVER (PARTITION BY river, week_start ORDER BY pct, segment) AS rn FROM r)
SELECT river, strftime(week_start, '%Y-%m-%d') AS week_start, count(*) AS segments_rated, count(*) FILTER (WHERE contains(cls, 'below')) AS segments_below_normal, max(CASE WHEN rn = 1 THEN segment END) AS worst_segment, max(CASE WHEN rn = 1 THEN cls END) AS worst_class, round(min(pct), 1) AS worst_percentile FROM wrk GROUP BY 1, 2""")
def j37(t):
    r = nm.segment_ratings(rated(t)).join(t.gauges.select("river", "segment").distinct(), "segment")
    return s.period_status(r, ["river", "week_start"])


BAD = f"""q AS (SELECT p_partkey AS id, p_size * 2.2 AS pct, CASE WHEN p_partkey % 10 = 0 THEN 'normal' ELSE {CLS.replace('pct', '(p_size * 2.2)')} END AS cls, p_size * 1.0 AS value, CASE WHEN p_partkey % 8 > 0 THEN 20.0 END AS normal, CASE WHEN p_partkey % 9 = 0 THEN p_size * 6.0 ELSE p_size * 5.0 END AS percent FROM part)"""


@query("J39_rating_rules", f"""WITH {BAD} SELECT CAST(id AS VARCHAR) AS subject, 'percentile outside 0..100' AS rule FROM q WHERE pct > 100 UNION ALL SELECT CAST(id AS VARCHAR), 'class does not fit percentile' FROM q WHERE cls <> {CLS} UNION ALL SELECT CAST(id AS VARCHAR), 'percent is not value over normal' FROM q WHERE abs(percent - 100 * value / normal) > 0.1
UNION ALL SELECT CAST(id AS VARCHAR), 'percent without a normal' FROM q WHERE normal IS NULL""")
def j39(t):
    from tidemark.functions.columns import classify

    k, z = F.col("p_partkey"), F.col("p_size")
    q = t.read("part").select(k.alias("id"), (z * 2.2).alias("pct"), F.when(k % 10 == 0, "normal").otherwise(classify(z * 2.2)).alias("cls"), (z * 1.0).alias("value"), F.when(k % 8 > 0, 20.0).alias("normal"), F.when(k % 9 == 0, z * 6.0).otherwise(z * 5.0).alias("percent"))
    return s.violations(q, F.col("id"), {**s.rating_rules(), **s.percent_rule("percent", "value", "normal")})


@query("J39_sums", """WITH m AS (SELECT o_custkey % 50 AS k, sum(o_totalprice) AS x FROM orders GROUP BY 1), t AS (SELECT o_custkey % 50 AS k, sum(o_totalprice) AS y FROM orders WHERE NOT (o_custkey = 55 AND o_orderkey % 2 = 0) AND o_custkey % 50 <> 7 GROUP BY 1)
SELECT CAST(k AS VARCHAR) AS subject, 'members do not sum to the total' AS rule FROM m FULL OUTER JOIN t USING (k) WHERE coalesce(abs(x - y) > 1, true)""")
def j39s(t):
    o = t.read("orders").withColumn("k", F.col("o_custkey") % 50)
    total = o.where("NOT (o_custkey = 55 AND o_orderkey % 2 = 0) AND k <> 7").groupBy("k").agg(F.sum("o_totalprice").alias("total"))
    return s.sum_violations(o, total, ["k"], "o_totalprice", "total")


@query("J39_membership", """WITH a AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_suppkey % 9 > 0), b AS (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 11 > 0) SELECT CAST(k AS VARCHAR) AS subject, 'unit file is missing' AS rule FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT CAST(k AS VARCHAR), 'unit file is not listed' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def j39m(t):
    a = t.read("lineitem").where("l_suppkey % 9 > 0").select(F.col("l_suppkey").alias("k"))
    b = t.read("supplier").where("s_suppkey % 11 > 0").select(F.col("s_suppkey").alias("k"))
    return s.missing_members(a, b, ["k"], "unit file")


@query("J39_lengths", """SELECT CAST(l_suppkey AS VARCHAR) AS subject, 'series differ in length' AS rule FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1 HAVING min(n) <> max(n)""")
def j39l(t):
    return s.length_violations(t.read("lineitem"), ["l_suppkey"], "l_returnflag").select("subject", "rule")


@query("J39_flood_rules", f"""WITH {THR.format(days=20)}, {ASSESS}, x AS (SELECT site_uid, CASE WHEN ls > 100 THEN 4 ELSE cur END AS c, top, pt, lt FROM asd WHERE top >= 1) SELECT site_uid AS subject, 'current above the peak category' AS rule FROM x WHERE c > top UNION ALL SELECT site_uid, 'peak after the last reading' FROM x WHERE pt > lt - INTERVAL 1 HOUR""")
def j39f(t):
    a = s.assess(readings(t, 20), thresholds(t)).where("reached IS NOT NULL")
    d = a.select("site_uid", F.col("reached").alias("category"), F.when(F.col("last_stage") > 100, "major").otherwise(F.col("current")).alias("current"), "peak_time", (F.col("last_time") - F.expr("INTERVAL 1 HOUR")).alias("last_time"))
    return s.violations(d, F.col("site_uid"), s.flood_rules())


HEAD = f"""{RATED}, {SEGRATED}, rv AS (SELECT DISTINCT river FROM gauges), sg AS (SELECT DISTINCT river, segment FROM gauges), sw AS (SELECT river, segment, week_start, avg(mean_cfs) AS m FROM gauge_weeks JOIN gauges USING (gauge) GROUP BY 1, 2, 3), a AS (SELECT river, min(week_start) AS first_week, max(week_start) AS last_week, avg(m) FILTER (WHERE DATE '2001-11-04' - week_start < 364) AS mean_52 FROM sw GROUP BY 1),
 lr AS (SELECT segment, max_by(cls, week_start) AS cls FROM segrated GROUP BY 1), b AS (SELECT river, count(*) AS rated, count(*) FILTER (WHERE contains(cls, 'below')) AS below FROM lr JOIN sg USING (segment) GROUP BY 1), fx AS (SELECT river, count(*) AS warnings FROM gauges WHERE CAST(substr(gauge, 2) AS BIGINT) % 3 = 0 GROUP BY 1),
 hl AS (SELECT rv.river, first_week, last_week, mean_52, coalesce(rated, 0) AS rated, coalesce(below, 0) AS below, coalesce(warnings, 0) AS warnings, coalesce(DATE '2001-11-04' - last_week <= 90, false) AS reporting FROM rv LEFT JOIN a USING (river) LEFT JOIN b USING (river) LEFT JOIN fx USING (river))"""


def entries(t):
    as_of = F.lit("2001-11-04").cast("date")
    sg = t.gauges.select("river", "segment").distinct()
    last = nm.segment_ratings(rated(t)).groupBy("segment").agg(F.max_by("cls", "week_start").alias("cls")).join(sg, "segment")
    find = t.gauges.withColumn("severity", F.when(F.substring("gauge", 2, 9).cast("bigint") % 3 == 0, "warn").otherwise("info"))
    return s.headline(t.gauges.select("river").distinct(), last, find, f.segment_weekly(t.gauge_weeks, t.gauges, ("river", "segment")), as_of)


@query("J40_headline", f"WITH {HEAD} SELECT river, strftime(first_week, '%Y-%m-%d') AS first_week, strftime(last_week, '%Y-%m-%d') AS last_week, round(mean_52, 6) AS mean_52, rated, below, warnings, reporting FROM hl")
def j40(t):
    return entries(t)


@query("J40_totals", f"WITH {HEAD} SELECT count(*) AS rivers, count(*) FILTER (WHERE rated > 0) AS rated, count(*) FILTER (WHERE below > 0) AS with_a_segment_below, count(*) FILTER (WHERE reporting) AS reporting, CAST(sum(warnings) AS BIGINT) AS warnings FROM hl")
def j40t(t):
    return s.headline_totals(entries(t))


@query("J41_watershed_rivers", """SELECT huc8, string_agg(gnis_name || '=' || slug, '; ' ORDER BY gnis_name, slug) AS rivers FROM (SELECT DISTINCT huc8, gnis_name, replace(lower(gnis_name), ' ', '-') AS slug FROM flowlines WHERE gnis_name IS NOT NULL) GROUP BY 1""")
def j41(t):
    from tidemark.functions.columns import slug

    d = t.flowlines.where("gnis_name IS NOT NULL").select("huc8", slug("gnis_name").alias("slug"), F.col("gnis_name").alias("name"))
    return s.watershed_rivers(d).select("huc8", F.array_join(F.transform("rivers", lambda r: F.concat(r["name"], F.lit("="), r["slug"])), "; ").alias("rivers"))


@query("J42_winters", """WITH w AS (SELECT unit, CAST(date_trunc('week', date) AS DATE) AS date, avg(value) AS value FROM unit_days GROUP BY 1, 2), d AS (SELECT *, year(date) + (month(date) >= 10)::INT AS wy FROM w), k AS (SELECT *, (date - make_date(wy::INT - 1, 10, 1)) // 7 AS week FROM d), m AS (SELECT unit, week, median(value) AS median FROM k WHERE wy BETWEEN 1996 AND 2000 GROUP BY 1, 2),
 y AS (SELECT unit, wy, week, avg(value) AS value FROM k GROUP BY 1, 2, 3), z AS (SELECT *, dense_rank() OVER (PARTITION BY unit ORDER BY wy DESC) AS p FROM y) SELECT z.unit, wy, z.week, round(value, 6) AS value, round(median, 6) AS median FROM z LEFT JOIN m ON m.unit = z.unit AND m.week = z.week WHERE p <= 3""")
def j42(t):
    w = t.unit_days.groupBy("unit", F.to_date(F.date_trunc("week", "date")).alias("date")).agg(F.avg("value").alias("value"))
    return s.winters(w, ["unit"], (1996, 2000))
