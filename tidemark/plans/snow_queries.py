"""Snow queries."""

from pyspark.sql import functions as F

from tidemark.operators import snow as s
from tidemark.plans.normals_queries import CLS
from tidemark.plans.registry import query

BASE = (1996, 2000)


def wday(d):
    return f"(make_date(CASE WHEN month({d}) >= 10 THEN 2003 ELSE 2004 END, month({d})::INT, day({d})::INT) - DATE '2003-10-01')"


def wy(d):
    return f"(year({d}) + (month({d}) >= 10)::INT)"


BAND = f"""bx AS (SELECT unit, {wday('date')} + k AS day, value, k FROM unit_days, range(-3, 4) r(k) WHERE {wy('date')} BETWEEN 1996 AND 2000),
 bnd AS (SELECT unit, day, quantile_cont(value, 0.10) AS p10, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.90) AS p90, count(*) FILTER (WHERE k = 0) AS years FROM bx WHERE day BETWEEN 0 AND 365 GROUP BY 1, 2)"""


def daily(t):
    return t.unit_days.select("unit", "date", "value")


def bands(t):
    return s.band(daily(t), "value", ["unit"], BASE)


@query("J13_band", f"WITH {BAND} SELECT unit, day, round(p10, 6) AS p10, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(p90, 6) AS p90, years FROM bnd")
def j13(t):
    return bands(t)


PM = f"pm AS (SELECT u.unit, u.date, u.value, p50 AS median, CASE WHEN p50 >= 220000 THEN 100 * u.value / p50 END AS pom FROM unit_days u LEFT JOIN bnd b ON b.unit = u.unit AND b.day = {wday('u.date')})"


def rated(t):
    return s.percent_of_median(daily(t), bands(t), "value", ["unit"], 220000.0)


@query("J14_percent_of_median", f"WITH {BAND}, {PM} SELECT unit, strftime(date, '%Y-%m-%d') AS date, round(value, 6) AS value, round(median, 6) AS median, round(pom, 6) AS percent_of_median FROM pm")
def j14(t):
    return rated(t)


PEAK = f"pk AS (SELECT unit, {wy('date')} AS wy, count(*) AS days, max(value) AS peak, min_by(date, (-value, date)) AS pd FROM unit_days GROUP BY 1, 2)"


@query("J14_peaks", f"WITH {PEAK} SELECT unit, wy, days, round(peak, 6) AS peak, strftime(pd, '%Y-%m-%d') AS peak_date FROM pk WHERE days >= 200")
def j14p(t):
    return s.peaks(daily(t), ["unit"], "value", 200)


SEASON = f"{BAND}, {PM}, {PEAK}, sv AS (SELECT unit, {wy('coalesce(max(date) FILTER (WHERE median >= 220000), max(date))')} AS swy FROM pm GROUP BY 1)"


@query("J14_season_rank", f"""WITH {SEASON}, o AS (SELECT pk.unit, peak FROM pk JOIN sv USING (unit) WHERE wy BETWEEN 1996 AND 2000 AND days >= 200 AND wy <> swy), n AS (SELECT pk.* FROM pk JOIN sv ON sv.unit = pk.unit AND wy = swy)
SELECT n.unit, n.wy AS season_wy, round(n.peak, 6) AS peak, strftime(n.pd, '%Y-%m-%d') AS peak_date, count(*) FILTER (WHERE o.peak > n.peak) + 1 AS rank, count(o.peak) + 1 AS "of", round(median(o.peak), 6) AS median_peak, round(CASE WHEN median(o.peak) > 0 THEN 100 * n.peak / median(o.peak) END, 6) AS percent_of_median_peak FROM n LEFT JOIN o ON o.unit = n.unit GROUP BY n.unit, n.wy, n.peak, n.pd""")
def j14s(t):
    seasons = s.season_in_view(rated(t), ["unit"], 220000.0)
    return s.season_rank(daily(t), seasons, ["unit"], "value", BASE, 200)


@query("J14_compare_days", """WITH l AS (SELECT unit, max(date) AS l FROM unit_days GROUP BY 1) SELECT u.unit, l.l - u.date AS days, strftime(u.date, '%Y-%m-%d') AS date, round(value, 6) AS value FROM unit_days u JOIN l ON l.unit = u.unit WHERE l.l - u.date IN (0, 7, 30, 90, 180, 365)""")
def j14c(t):
    as_of = daily(t).groupBy("unit").agg(F.max("date").alias("as_of"))
    return s.compare_days(daily(t), as_of, ["unit"])


@query("J14_season_so_far", f"""WITH {SEASON}, cal AS (SELECT unit, CAST(unnest(generate_series(CAST(make_date(swy::INT - 1, 10, 1) AS TIMESTAMP), CAST(make_date(swy::INT, 9, 30) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM sv)
SELECT c.unit, strftime(c.date, '%Y-%m-%d') AS date, round(u.value, 6) AS value, round(p10, 6) AS p10, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(p90, 6) AS p90 FROM cal c LEFT JOIN bnd b ON b.unit = c.unit AND b.day = {wday('c.date')} LEFT JOIN unit_days u ON u.unit = c.unit AND u.date = c.date""")
def j14f(t):
    return s.season_so_far(daily(t), bands(t), s.season_in_view(rated(t), ["unit"], 220000.0), ["unit"])


INDEX = f"""md AS (SELECT unit, month(date) * 100 + day(date) AS k, median(value) AS m FROM unit_days WHERE {wy('date')} BETWEEN 1996 AND 2000 GROUP BY 1, 2 HAVING count(DISTINCT {wy('date')}) >= 2),
 ix AS (SELECT u.date, count(DISTINCT u.unit) AS sites, 100 * sum(value) / sum(m) AS p FROM unit_days u JOIN md ON md.unit = u.unit AND k = month(u.date) * 100 + day(u.date) GROUP BY 1 HAVING count(DISTINCT u.unit) >= 3 AND sum(m) > 0)"""


def index(t):
    return s.station_index(daily(t).withColumnRenamed("unit", "site_uid"), BASE, 2, 3)


@query("J15_station_index", f"WITH {INDEX} SELECT strftime(date, '%Y-%m-%d') AS date, sites, round(p, 6) AS index_pct FROM ix")
def j15(t):
    return index(t)


@query("J16_crosscheck", f"""WITH {INDEX}, j AS (SELECT u.unit, u.date, u.value AS a, ix.p / 100 AS b FROM unit_days u JOIN ix USING (date) WHERE month(u.date) IN (12, 1, 2, 3, 4)), d AS (SELECT unit, count(*) AS days, corr(a, b) AS c, avg(a - b) AS bias, median(abs(a - b)) AS mad FROM j GROUP BY 1),
 q AS (SELECT unit, {wy('date')} AS w, avg(a) AS a, avg(b) AS b FROM j GROUP BY 1, 2 HAVING count(*) >= 40), e AS (SELECT unit, count(*) AS seasons, corr(a, b) AS sc, avg(abs(a - b)) AS sm FROM q GROUP BY 1)
SELECT unit, days, round(c, 6) AS corr, round(bias, 6) AS bias, round(mad, 6) AS median_abs_diff, seasons, round(sc, 6) AS season_corr, round(sm, 6) AS season_mean_abs_diff FROM d LEFT JOIN e USING (unit)""")
def j16(t):
    p = daily(t).withColumnRenamed("value", "a").join(index(t).select("date", (F.col("index_pct") / 100).alias("b")), "date")
    return s.crosscheck(p, ["unit"], season_days=40)


def sday(d):
    w = wy(d)
    return f"(CASE WHEN month({d}) = 2 AND day({d}) = 29 THEN NULL ELSE {d} - make_date({w}::INT - 1, 10, 1) - CASE WHEN {w} % 4 = 0 AND month({d}) BETWEEN 3 AND 9 THEN 1 ELSE 0 END END)"


POOL = f"po AS (SELECT unit, {sday('date')} + k AS day, floor(value + 0.005) AS value FROM unit_days, range(-3, 4) r(k) WHERE {wy('date')} BETWEEN 1996 AND 2000 AND NOT (month(date) = 2 AND day(date) = 29)), pq AS (SELECT * FROM po WHERE day BETWEEN 0 AND 364)"


def whole(t):
    return daily(t).withColumn("value", F.floor(F.col("value") + 0.005).cast("double"))


def pool(t):
    return s.season_pool(whole(t), ["unit"], "value", BASE)


@query("J17_season_bands", f"""WITH {POOL} SELECT unit, day, count(*) AS n, CASE WHEN count(*) >= 20 THEN round(quantile_cont(value, 0.1), 3) END AS p10, CASE WHEN count(*) >= 20 THEN round(quantile_cont(value, 0.25), 3) END AS p25, CASE WHEN count(*) >= 20 THEN round(quantile_cont(value, 0.5), 3) END AS p50,
 CASE WHEN count(*) >= 20 THEN round(quantile_cont(value, 0.75), 3) END AS p75, CASE WHEN count(*) >= 20 THEN round(quantile_cont(value, 0.9), 3) END AS p90 FROM pq GROUP BY 1, 2""")
def j17(t):
    return s.season_bands(pool(t), ["unit"])


@query("J17_rate", f"""WITH {POOL}, u AS (SELECT unit, date, floor(value + 0.005) AS value, {sday('date')} AS day FROM unit_days WHERE {wy('date')} = 2001), r AS (SELECT u.unit, u.date, u.value, count(p.value) AS n, median(p.value) AS med, 100.0 * (count(*) FILTER (WHERE p.value < u.value) + 0.5 * count(*) FILTER (WHERE p.value = u.value)) / nullif(count(p.value), 0) AS pct
  FROM u LEFT JOIN pq p ON p.unit = u.unit AND p.day = u.day GROUP BY 1, 2, 3)
SELECT unit, strftime(date, '%Y-%m-%d') AS date, round(value, 3) AS now, CASE WHEN n >= 20 THEN round(med, 3) END AS usual, CASE WHEN n >= 20 THEN round(pct, 1) END AS pct, CASE WHEN n >= 20 AND NOT (value < 0.05 AND med < 0.05) THEN {CLS} END AS cls, n >= 20 AND value < 0.05 AND med < 0.05 AS little, n FROM r""")
def j17r(t):
    d = whole(t).where(s.water_year("date") == 2001).withColumn("day", s.season_day("date")).join(pool(t), ["unit", "day"], "left")
    return s.rate(d, "value", "pool", "swe").drop("value", "pool", "day")


NEW = """sn AS (SELECT unit AS site_uid, date, n * 2.0 AS depth, value * 3 / 10000 AS swe FROM unit_days), sp AS (SELECT site_uid, min(date) AS a, max(date) AS z FROM sn GROUP BY 1), ca AS (SELECT site_uid, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM sp),
 sd AS (SELECT ca.site_uid, ca.date, depth - lag(depth) OVER w AS rise, swe - lag(swe) OVER w AS water FROM ca LEFT JOIN sn ON sn.site_uid = ca.site_uid AND sn.date = ca.date WINDOW w AS (PARTITION BY ca.site_uid ORDER BY ca.date)),
 nw AS (SELECT *, CASE WHEN rise IS NOT NULL THEN CASE WHEN rise BETWEEN 1 AND 30 AND coalesce(water >= 0.1, false) THEN rise ELSE 0 END END AS new FROM sd)"""


def new(t):
    return s.new_snow(t.unit_days.select(F.col("unit").alias("site_uid"), "date", (F.col("n") * 2.0).alias("depth"), (F.col("value") * 3 / 10000).alias("swe")))


@query("J18_new_snow", f"WITH {NEW} SELECT site_uid, strftime(date, '%Y-%m-%d') AS date, rise::DOUBLE AS rise, round(water, 6) AS water, new::DOUBLE AS new FROM nw")
def j18(t):
    return new(t).select("site_uid", "date", "rise", "water", "new")


def as_of():
    return F.lit("2001-03-15").cast("date")

TOT = f"""{NEW}, te AS (SELECT w, CASE WHEN w = 2001 THEN DATE '2001-03-15' ELSE make_date(w::INT, 3, 15) END AS e FROM range(1996, 2002) r(w)), tk AS (SELECT w, e, k, CASE k WHEN 'new24' THEN e WHEN 'new7' THEN e - 6 ELSE make_date(w::INT - 1, 10, 1) END AS a FROM te, (VALUES ('new24'), ('new7'), ('newseason')) v(k)),
 tt AS (SELECT site_uid, w AS wy, k AS kind, e AS e, sum(new) AS total FROM tk JOIN nw ON date BETWEEN a AND e AND new IS NOT NULL GROUP BY site_uid, w, k, e, a HAVING count(*) >= 0.3 * (e - a + 1))"""


def totals(t):
    return s.window_totals(new(t), as_of(), list(range(1996, 2001)), 0.3)


@query("J19_window_totals", f"WITH {TOT} SELECT site_uid, wy, kind, strftime(e, '%Y-%m-%d') AS \"end\", total::DOUBLE AS total FROM tt")
def j19(t):
    return totals(t)


@query("J20_pooled_rating", f"""WITH {TOT}, pl AS (SELECT tt.*, 'P' || (CAST(substr(site_uid, 2) AS INTEGER) % 2) AS place FROM tt), n AS (SELECT * FROM pl WHERE wy = 2001), hi AS (SELECT pl.* FROM pl WHERE wy BETWEEN 1996 AND 2000 AND (place, kind, site_uid) IN (SELECT (place, kind, site_uid) FROM n)),
 el AS (SELECT place, kind, site_uid FROM hi GROUP BY 1, 2, 3 HAVING count(*) >= 2), c AS (SELECT place, kind, count(*) AS stations FROM el GROUP BY 1, 2), cu AS (SELECT n.place, n.kind, avg(total) AS m FROM n JOIN el USING (place, kind, site_uid) GROUP BY 1, 2),
 yr AS (SELECT hi.place, hi.kind, wy, avg(total) AS m, count(*) AS k FROM hi JOIN el USING (place, kind, site_uid) GROUP BY 1, 2, 3), po AS (SELECT yr.* FROM yr JOIN c USING (place, kind) WHERE k = stations),
 r AS (SELECT cu.place, cu.kind, c.stations, cu.m AS v, count(po.m) AS n, median(po.m) AS med, 100.0 * (count(*) FILTER (WHERE po.m < cu.m) + 0.5 * count(*) FILTER (WHERE po.m = cu.m)) / nullif(count(po.m), 0) AS pct FROM cu JOIN c USING (place, kind) LEFT JOIN po ON po.place = cu.place AND po.kind = cu.kind GROUP BY 1, 2, 3, 4)
SELECT place, kind, stations, round(v, 3)::DOUBLE AS now, CASE WHEN n >= 2 THEN round(med, 3) END::DOUBLE AS usual, CASE WHEN n >= 2 THEN round(pct, 1) END AS pct, CASE WHEN n >= 2 AND NOT (v < 1 AND med < 1) THEN {CLS} END AS cls, n >= 2 AND coalesce(v < 1 AND med < 1, false) AS little, n FROM r""")
def j20(t):
    members = t.unit_days.select(F.col("unit").alias("site_uid")).distinct().withColumn("place", F.concat(F.lit("P"), F.substring("site_uid", 2, 9).cast("int") % 2))
    return s.rate_new_snow(totals(t), members, F.lit(2001), BASE, 2, 2)


@query("J21_estimate_validation", f"""WITH {NEW}, ru AS (SELECT site_uid, date, 'depth_rise' AS rule, CASE WHEN rise BETWEEN 1 AND 30 THEN rise ELSE 0 END AS est FROM nw WHERE rise IS NOT NULL UNION ALL SELECT site_uid, date, 'chosen', new FROM nw WHERE new IS NOT NULL UNION ALL SELECT site_uid, date, 'water_rise', CASE WHEN water >= 0.1 THEN water * 10 ELSE 0 END FROM nw WHERE water IS NOT NULL),
 sh AS (SELECT ru.*, k FROM ru, range(0, 3) r(k) WHERE rule = 'chosen' OR k = 1), ob AS (SELECT 'H' || substr(gauge, 2) AS site_uid, gauge AS observer, date, floor(cfs / 20) AS o FROM chosen), j AS (SELECT sh.site_uid, observer, rule, k, ob.date, est::DOUBLE AS est, o FROM sh JOIN ob ON ob.site_uid = sh.site_uid AND ob.date = sh.date + CAST(k AS INTEGER) WHERE month(ob.date) IN (11, 12, 1, 2, 3, 4)),
 w AS (SELECT *, CASE WHEN count(*) OVER z = 3 THEN sum(est) OVER z END AS e3, CASE WHEN count(*) OVER z = 3 THEN sum(o) OVER z END AS o3 FROM j WINDOW z AS (PARTITION BY site_uid, observer, rule, k ORDER BY date ROWS 2 PRECEDING))
SELECT site_uid, observer, rule, k AS shift, count(*) AS days, round(sum(o), 6) AS obs_total, round(sum(est), 6) AS est_total, round(corr(est, o), 6) AS corr_day, round(corr(e3, o3), 6) AS corr_3day, count(*) FILTER (WHERE o >= 1 AND est > 0) AS hit, count(*) FILTER (WHERE o >= 1 AND NOT est > 0) AS miss,
 count(*) FILTER (WHERE o < 1 AND est > 0) AS false_alarm, count(*) FILTER (WHERE o >= 1) AS obs_snow_days FROM w GROUP BY 1, 2, 3, 4 HAVING count(*) >= 60 AND count(*) FILTER (WHERE o > 0) >= 20""")
def j21(t):
    n = F.substring("gauge", 2, 9)
    pairs = t.gauges.select(F.concat(F.lit("H"), n).alias("station"), F.col("gauge").alias("observer"))
    obs = t.chosen.select(F.col("gauge").alias("site_uid"), "date", F.floor(F.col("cfs") / 20).cast("double").alias("value"))
    return s.validate_estimates(s.estimate_rules(new(t)), obs, pairs)


@query("J23_reading_near", """SELECT unit, round(max_by(value, date), 6) AS value, strftime(max(date), '%Y-%m-%d') AS date FROM unit_days WHERE DATE '2001-02-20' - date BETWEEN 0 AND 5 GROUP BY 1""")
def j23(t):
    return s.reading_near(daily(t), F.lit("2001-02-20").cast("date"), keys=["unit"])


@query("J23_unit_mart", f"""WITH p AS (SELECT 'P' || (CAST(substr(unit, 2) AS INTEGER) % 2) AS place, * FROM unit_days), r AS (SELECT unit, max_by(value, date) AS v FROM unit_days WHERE DATE '2001-02-20' - date BETWEEN 0 AND 5 GROUP BY 1),
 m AS (SELECT place, count(*) AS stations, avg(v) AS mean_reading FROM (SELECT DISTINCT place, unit FROM p) LEFT JOIN r USING (unit) GROUP BY 1), d AS (SELECT DISTINCT place, date FROM p WHERE NOT (month(date) = 2 AND day(date) = 29))
SELECT m.place AS unit, stations, round(mean_reading, 6) AS mean_reading, CAST(365 AS BIGINT) AS days, count(*) FILTER (WHERE {wy('date')} = 2001) AS this_days, count(*) FILTER (WHERE {wy('date')} = 2000) AS last_days FROM m JOIN d ON d.place = m.place GROUP BY 1, 2, 3""")
def j23m(t):
    stations = t.unit_days.select(F.col("unit").alias("site_uid")).distinct().withColumn("unit", F.concat(F.lit("P"), F.substring("site_uid", 2, 9).cast("int") % 2))
    readings = s.reading_near(daily(t), F.lit("2001-02-20").cast("date"), keys=["unit"]).withColumnRenamed("unit", "site_uid")
    place = daily(t).withColumn("unit", F.concat(F.lit("P"), F.substring("unit", 2, 9).cast("int") % 2)).groupBy("unit", "date").agg(F.avg("value").alias("value"))
    m = s.unit_mart(stations, readings, place, (2000, 2001))
    return m.select("unit", "stations", "mean_reading", F.size("this_season").alias("days"), F.size(F.filter("this_season", lambda v: v.isNotNull())).alias("this_days"), F.size(F.filter("last_season", lambda v: v.isNotNull())).alias("last_days"))
