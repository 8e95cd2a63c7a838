"""Record-finding queries."""

from pyspark.sql import functions as F

from tidemark.operators import flow as f
from tidemark.operators import issues as h
from tidemark.plans.flow_queries import AGAINST, SCREEN, SEG, screened
from tidemark.plans.registry import query


def last_day():
    return F.lit("2001-11-01").cast("date")

THIN = "thin AS (SELECT * FROM chosen WHERE NOT (CAST(substr(gauge, 2) AS BIGINT) % 2 = 0 AND month(date) IN (1, 2)) AND NOT (gauge = 'G3' AND date BETWEEN DATE '1998-02-01' AND DATE '1998-07-20'))"


def thin(t):
    n = F.substring("gauge", 2, 9).cast("bigint")
    return t.chosen.where(~((n % 2 == 0) & F.month("date").isin(1, 2)) & ~((F.col("gauge") == "G3") & F.col("date").between("1998-02-01", "1998-07-20")))


SEASON = """pm AS (SELECT gauge, year(date) AS y, month(date) AS m, count(*) AS n FROM thin GROUP BY 1, 2, 3), act AS (SELECT gauge, y FROM pm GROUP BY 1, 2 HAVING sum(n) >= 30), yrs AS (SELECT gauge, count(*) AS years FROM act GROUP BY 1 HAVING count(*) >= 3),
 fr AS (SELECT g.gauge, k.m AS month, (SELECT count(*) FROM pm JOIN act ON act.gauge = pm.gauge AND act.y = pm.y WHERE pm.gauge = g.gauge AND pm.m = k.m AND pm.n >= 10) / g.years::DOUBLE AS share FROM yrs g, range(1, 13) k(m)),
 season AS (SELECT * FROM fr WHERE share < 0.2 AND gauge IN (SELECT gauge FROM fr WHERE share >= 0.6 GROUP BY 1 HAVING count(*) >= 4))"""


@query("H1_seasonal_months", f"WITH {THIN}, {SEASON} SELECT gauge, month, round(share, 6) AS share FROM season")
def h1(t):
    return h.seasonal_months(thin(t))


@query("H2_gaps", f"""
WITH {THIN}, {SEASON}, g AS (SELECT gauge, date, lag(date) OVER (PARTITION BY gauge ORDER BY date) AS p FROM (SELECT DISTINCT gauge, date FROM thin)), q AS (SELECT gauge, p + 1 AS a, date - 1 AS z, date - p - 1 AS days FROM g WHERE date - p - 1 >= 20)
SELECT gauge, strftime(a, '%Y-%m-%d') AS first_day, strftime(z, '%Y-%m-%d') AS last_day, days FROM q WHERE gauge NOT IN (SELECT gauge FROM season)
 OR (SELECT count(*) FROM range(0, 400) r(i) WHERE a + CAST(i AS INTEGER) <= z AND month(a + CAST(i AS INTEGER)) NOT IN (SELECT month FROM season s WHERE s.gauge = q.gauge)) >= 20""")
def h2(t):
    d = thin(t)
    return h.gaps(d, h.seasonal_months(d), 20)


RUNS = """isl AS (SELECT *, sum(CASE WHEN date - pd = 1 AND cfs = pv THEN 0 ELSE 1 END) OVER (PARTITION BY gauge ORDER BY date) AS k FROM (SELECT *, lag(date) OVER (PARTITION BY gauge ORDER BY date) AS pd, lag(cfs) OVER (PARTITION BY gauge ORDER BY date) AS pv FROM lv)),
 rn AS (SELECT gauge, min(date) AS a, max(date) AS z, count(*) AS days, max(cfs) AS value FROM isl GROUP BY gauge, k HAVING count(*) >= 2)"""
LV = "lv0 AS (SELECT gauge, date, floor(cfs / 20) AS cfs FROM chosen)"


def levels(t):
    return t.chosen.withColumn("cfs", F.floor(F.col("cfs") / 20).cast("double"))


@query("H3_runs", f"WITH {LV}, lv AS (SELECT * FROM lv0 WHERE cfs <> 0), {RUNS} SELECT gauge, strftime(a, '%Y-%m-%d') AS first_day, strftime(z, '%Y-%m-%d') AS last_day, days, value FROM rn")
def h3(t):
    return h.runs(levels(t))


@query("H3_zero_runs", f"WITH {LV}, lv AS (SELECT * FROM lv0 WHERE cfs = 0), {RUNS} SELECT gauge, count(*) AS n_runs, max(days) AS longest FROM rn WHERE days >= 3 GROUP BY 1")
def h3z(t):
    return h.zero_runs(levels(t), 3)


@query("H4_flatlines", f"""WITH {LV}, lv AS (SELECT * FROM lv0 WHERE cfs <> 0), {RUNS} SELECT gauge, count(*) AS n_runs, max(days) AS longest, strftime(max(z), '%Y-%m-%d') AS last_day, false AS below_dam,
 CASE WHEN DATE '2001-11-01' - max(z) < 200 THEN 'warn' ELSE 'info' END AS severity FROM rn WHERE days >= 4 AND value >= 1 GROUP BY 1""")
def h4(t):
    return h.flatlines(levels(t), last_day(), 4, 1.0, 200)


SPIKY = "spiky AS (SELECT gauge, date, CASE WHEN cfs = 50 AND day(date) = 7 THEN 5000.0 ELSE cfs END AS cfs FROM chosen)"


@query("H5_spikes", f"""
WITH {SPIKY}, p AS (SELECT gauge, quantile_cont(cfs, 0.99) AS p99, count(*) AS n FROM spiky GROUP BY 1), w AS (SELECT *, count(*) OVER v AS c, median(cfs) OVER v AS loc FROM spiky WINDOW v AS (PARTITION BY gauge ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
 pk AS (SELECT DISTINCT gauge, year(date) + (month(date) >= 10)::INT AS wy FROM chosen WHERE year(date) % 2 = 0)
SELECT w.gauge, strftime(w.date, '%Y-%m-%d') AS date, w.cfs::DOUBLE AS cfs, round(p99, 6) AS p99, (w.gauge, year(w.date) + (month(w.date) >= 10)::INT) IN (SELECT (gauge, wy) FROM pk) AS has_peak
FROM w JOIN p USING (gauge) WHERE n >= 60 AND cfs > 5 * greatest(p99, 1) AND cfs > 10 * greatest(CASE WHEN c >= 3 THEN loc END, 1) AND cfs > 100""")
def h5(t):
    s = t.chosen.withColumn("cfs", F.when((F.col("cfs") == 50) & (F.dayofmonth("date") == 7), 5000.0).otherwise(F.col("cfs")))
    return h.spikes(s, f.annual_peaks(t.chosen.where("year(date) % 2 = 0")))


CHECKS = f"""{AGAINST}, x AS (SELECT *, cfs / used AS ratio, CASE WHEN abs(cfs - used) > 5 AND abs(cfs - used) / used > 0.10 THEN 1.0 ELSE 0.0 END AS off FROM m WHERE used >= 10),
 us AS (SELECT gauge, source, used_source FROM (SELECT gauge, source, used_source, row_number() OVER (PARTITION BY gauge, source ORDER BY count(*) DESC, used_source) AS rn FROM x GROUP BY 1, 2, 3) WHERE rn = 1),
 chk AS (SELECT gauge, source, count(*) AS days, avg(off) AS share_off, min(date) AS first, max(date) AS last, median(ratio) AS ratio FROM x GROUP BY 1, 2)"""


@query("H6_copy_checks", f"""WITH {CHECKS} SELECT gauge, source, days, round(share_off, 6) AS share_off, strftime(first, '%Y-%m-%d') AS first, strftime(last, '%Y-%m-%d') AS last, used_source, round(ratio, 6) AS ratio FROM chk JOIN us USING (gauge, source)""")
def h6(t):
    return h.copy_checks(t.copies.drop("qualifier"), t.chosen)


@query("H6_copy_findings", f"""
WITH {CHECKS}, n AS (SELECT gauge, source, count(*) AS n_used FROM chosen GROUP BY 1, 2), j AS (SELECT chk.*, used_source, coalesce(n_used, 0) AS n_used FROM chk JOIN us USING (gauge, source) LEFT JOIN n USING (gauge, source) WHERE days >= 30)
SELECT gauge, source, used_source, days, round(ratio, 6) AS ratio, round(share_off, 6) AS share_off, n_used, CAST(NULL AS VARCHAR) AS unit_hint, CASE WHEN ratio NOT BETWEEN 0.9 AND 1.1 THEN 'copy_bias' ELSE 'copy_disagree' END AS kind,
 CASE WHEN ratio NOT BETWEEN 0.9 AND 1.1 AND n_used > 0 THEN 'warn' ELSE 'info' END AS severity FROM j WHERE ratio NOT BETWEEN 0.9 AND 1.1 OR share_off > 0.2""")
def h6f(t):
    return h.copy_findings(h.copy_checks(t.copies.drop("qualifier"), t.chosen), t.chosen)


@query("H7_unit_hint", """
SELECT id, round(ratio, 6) AS ratio, CASE WHEN abs(ln(ratio / 35.3147)) < 0.08 THEN 'm3/s and cfs' WHEN abs(ln(ratio / 0.0283168)) < 0.08 THEN 'cfs as m3/s' WHEN abs(ln(ratio / 1000)) < 0.08 THEN 'cfs as thousands' WHEN abs(ln(ratio / 0.001)) < 0.08 THEN 'thousands as cfs' END AS unit_hint
FROM (SELECT p_partkey AS id, p_size * CASE p_partkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.001 WHEN 2 THEN 0.0001 ELSE 40.0 END::DOUBLE AS ratio FROM part)""")
def h7(t):
    k = F.col("p_partkey") % 4
    d = t.read("part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * F.when(k == 0, 1.0).when(k == 1, 0.001).when(k == 2, 0.0001).otherwise(40.0)).alias("ratio"))
    return h.unit_hint(d)


@query("H8_negative_flow", """
SELECT gauge, count(*) AS days, min(v) AS lowest, strftime(min(date), '%Y-%m-%d') AS first, strftime(max(date), '%Y-%m-%d') AS last FROM (SELECT gauge, date, round(cfs - 1.5, 6) AS v FROM chosen) WHERE v < 0 GROUP BY 1""")
def h8n(t):
    return h.negative_flow(t.chosen.withColumn("cfs", F.col("cfs") - 1.5))


@query("H8_ended_records", """SELECT gauge, strftime(max(date), '%Y-%m-%d') AS last FROM chosen WHERE NOT (CAST(substr(gauge, 2) AS BIGINT) % 2 = 0 AND year(date) = 2001) GROUP BY 1
 HAVING DATE '2001-11-01' - max(date) > 90""")
def h8e(t):
    n = F.substring("gauge", 2, 9).cast("bigint")
    return h.ended_records(t.chosen.where(~((n % 2 == 0) & (F.year("date") == 2001))), last_day())


@query("H8_fallback_share", """
WITH c AS (SELECT gauge, source, count(*) AS c, CASE source WHEN 'usgs' THEN 0 WHEN 'usbr_hydrodata' THEN 1 ELSE 5 END AS r FROM chosen GROUP BY 1, 2), b AS (SELECT gauge, min_by(source, r) AS best_source, 1 - min_by(c, r) / sum(c)::DOUBLE AS other_share FROM c GROUP BY 1)
SELECT gauge, best_source, round(other_share, 6) AS other_share FROM b WHERE other_share > 0.10""")
def h8f(t):
    return h.fallback_share(t.chosen)


@query("H9_peak_conflicts", f"""WITH {SCREEN} SELECT gauge, count(*) AS days, count(DISTINCT wy) AS years, round(max(cfs / greatest(peak, 1)), 6) AS worst_ratio FROM scr WHERE verdict = 'conflict' GROUP BY 1""")
def h9(t):
    return h.peak_conflicts(screened(t))


@query("H10_segment_findings", f"""
WITH sg AS (SELECT segment, week_start, count(*) AS n_gauges FROM gauge_weeks JOIN gauges USING (gauge) WHERE NOT (CAST(substr(gauge, 2) AS BIGINT) % 2 = 0 AND month(week_start) > 4) GROUP BY 1, 2)
SELECT segment, 'single_gauge' AS kind, round(avg((n_gauges = 1)::INT), 6) AS amount FROM sg GROUP BY 1 HAVING avg((n_gauges = 1)::INT) >= 0.5 AND max(n_gauges) > 1
UNION ALL SELECT segment, 'no_yearly', max(c)::DOUBLE FROM (SELECT segment, year(week_start) AS y, count(*) AS c FROM sg GROUP BY 1, 2) GROUP BY 1 HAVING count(*) >= 3 AND max(c) < 53""")
def h10(t):
    n = F.substring("gauge", 2, 9).cast("bigint")
    w = t.gauge_weeks.where(~((n % 2 == 0) & (F.month("week_start") > 4)))
    return h.segment_findings(f.segment_weekly(w, t.gauges), 53)
