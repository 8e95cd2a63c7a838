"""Queries rating flow against other years."""

from pyspark.sql import functions as F

from tidemark.operators import normals as n
from tidemark.plans.registry import query

BASE = (1995, 1999)
CLS = "CASE WHEN pct IS NULL THEN NULL WHEN pct < 10 THEN 'much below normal' WHEN pct < 25 THEN 'below normal' WHEN pct < 76 THEN 'normal' WHEN pct < 91 THEN 'above normal' ELSE 'much above normal' END"


def day(text):
    return F.lit(text).cast("date")


@query("I1_percentile_rank", f"""
WITH v AS (SELECT c_nationkey AS nation, min_by(c_acctbal, c_custkey) AS value FROM customer GROUP BY 1)
SELECT nation, value, round(pct, 6) AS pct, {CLS} AS cls FROM (SELECT nation, value, 100.0 * (count(*) FILTER (WHERE c_acctbal < value) + 0.5 * count(*) FILTER (WHERE c_acctbal = value)) / count(*) AS pct FROM v JOIN customer ON c_nationkey = nation GROUP BY 1, 2)""".replace("SELECT nation, value, round", "SELECT CAST(nation AS BIGINT) AS nation, value, round"))
def i1(t):
    c = t.read("customer")
    v = c.groupBy(F.col("c_nationkey").alias("nation")).agg(F.min_by("c_acctbal", "c_custkey").alias("value"))
    return n.percentile_ranks(c.select(F.col("c_nationkey").alias("nation"), "c_acctbal").join(v, "nation"), ["nation"], "value", "c_acctbal")


RATED = f"""zz AS (SELECT CAST(date_trunc('week', DATE '2001-11-05') AS DATE) - 7 AS e), st AS (SELECT e - 357 AS s, e FROM zz),
 h AS (SELECT gauge, least((dayofyear(week_start) - 1) // 7, 51) AS woy, year(week_start) AS y, mean_cfs AS v FROM gauge_weeks, st WHERE week_start < s),
 nn AS (SELECT gauge, woy, count(*) FILTER (WHERE y BETWEEN 1995 AND 1999) AS nb, count(*) AS na FROM h GROUP BY 1, 2),
 p AS (SELECT h.gauge, h.woy, v, CASE WHEN nb >= 4 THEN 'baseline' ELSE 'whole record' END AS basis FROM h JOIN nn ON nn.gauge = h.gauge AND nn.woy = h.woy WHERE CASE WHEN nb >= 4 THEN y BETWEEN 1995 AND 1999 ELSE na >= 3 END),
 bd AS (SELECT gauge, woy, min(basis) AS basis, count(*) AS n_base, quantile_cont(v, 0.10) AS p10, quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, quantile_cont(v, 0.90) AS p90 FROM p GROUP BY 1, 2),
 w AS (SELECT gauge, s + CAST(7 * i AS INTEGER) AS week_start FROM (SELECT DISTINCT gauge FROM bd), st, range(0, 52) r(i)),
 g AS (SELECT w.gauge, w.week_start, bd.* EXCLUDE (gauge), c.mean_cfs FROM w JOIN bd ON bd.gauge = w.gauge AND bd.woy = least((dayofyear(w.week_start) - 1) // 7, 51) LEFT JOIN gauge_weeks c ON c.gauge = w.gauge AND c.week_start = w.week_start),
 q AS (SELECT g.gauge, g.week_start, 100.0 * (count(*) FILTER (WHERE v < mean_cfs) + 0.5 * count(*) FILTER (WHERE v = mean_cfs)) / count(*) AS pct FROM g JOIN p ON p.gauge = g.gauge AND p.woy = g.woy WHERE mean_cfs IS NOT NULL GROUP BY 1, 2),
 rated AS (SELECT g.*, gauges.segment, q.pct, {CLS} AS cls FROM g JOIN gauges ON gauges.gauge = g.gauge LEFT JOIN q ON q.gauge = g.gauge AND q.week_start = g.week_start)"""


def rated(t, places=None):
    return n.flow_vs_normal(t.gauge_weeks, t.gauges.drop("river"), day("2001-11-04"), 52, BASE, 4, 3, places)


@query("I3_flow_vs_normal", f"""WITH {RATED} SELECT gauge, segment, strftime(week_start, '%Y-%m-%d') AS week_start, CAST(woy AS BIGINT) AS woy, basis, n_base, round(p10, 6) AS p10, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(p90, 6) AS p90,
 round(mean_cfs, 6) AS mean_cfs, round(pct, 6) AS pct, cls FROM rated""")
def i3(t):
    return rated(t)


SEGRATED = f"sr AS (SELECT segment, week_start, median(pct) AS pct, count(*) AS n_gauges FROM rated WHERE pct IS NOT NULL GROUP BY 1, 2), segrated AS (SELECT *, {CLS} AS cls FROM sr)"


# equal means of a week are equal whatever the order of their sum
PLAIN_WEEKS = "gw AS (SELECT gauge, week_start, round(mean_cfs, 9) AS mean_cfs FROM gauge_weeks)"


@query("I3_segment_rating", f"WITH {PLAIN_WEEKS}, {RATED.replace('gauge_weeks', 'gw')}, {SEGRATED} SELECT segment, strftime(week_start, '%Y-%m-%d') AS week_start, round(pct, 6) AS pct, n_gauges, cls FROM segrated")
def i3s(t):
    return n.segment_ratings(rated(t, 9))


DRY = "d AS (SELECT c.gauge, c.date, year(c.date) AS y, c.cfs - CASE WHEN CAST(substr(c.gauge, 2) AS BIGINT) % 7 = 3 THEN 48 ELSE 4 END < 0.1 AS dry, g.segment FROM chosen c JOIN gauges g ON g.gauge = c.gauge)"


def dried(t):
    k = F.substring("gauge", 2, 9).cast("bigint")
    return t.chosen.withColumn("cfs", F.col("cfs") - F.when(k % 7 == 3, 48).otherwise(4))


@query("I4_drying", f"""
WITH {DRY}, a AS (SELECT gauge FROM d GROUP BY 1 HAVING avg(dry::INT) >= 0.9), k AS (SELECT segment, date, y, count(*) FILTER (WHERE dry) AS nd, count(*) AS n FROM d WHERE gauge NOT IN (SELECT gauge FROM a) GROUP BY 1, 2, 3)
SELECT segment, y AS year, count(*) FILTER (WHERE nd > 0) AS any_dry_days, CAST(sum(nd) AS BIGINT) AS gauge_dry_days, count(*) AS days_with_data, max(n) AS n_gauges FROM k GROUP BY 1, 2""")
def i4(t):
    return n.drying(dried(t), t.gauges)


@query("I4_dry_by_gauge", f"WITH {DRY} SELECT gauge, segment, y AS year, count(*) FILTER (WHERE dry) AS dry_days, count(*) AS data_days FROM d GROUP BY 1, 2, 3")
def i4g(t):
    return n.dry_days(dried(t), t.gauges)


@query("I4_normally_dry", f"WITH {DRY} SELECT gauge, segment, round(avg(dry::INT), 6) AS dry_share FROM d GROUP BY 1, 2 HAVING avg(dry::INT) >= 0.9")
def i4n(t):
    return n.normally_dry(dried(t), t.gauges)


def windows(table, key, value, end, ks, cov):
    """SQL for the mean over year windows that start within the record."""
    y, m, d = end.split("-")
    return f"""fst AS (SELECT {key} AS k0, min(date) AS f, year(min(date)) AS fy FROM {table} GROUP BY 1),
 wn AS (SELECT k0, f, yy.y AS year, ks.k AS days, make_date(yy.y::INT, {int(m)}, {int(d)}) AS e FROM fst, range(1990, {int(y) + 1}) yy(y), (VALUES {", ".join(f"({k})" for k in ks)}) ks(k)),
 wm AS (SELECT k0, year, days, e, avg({value}) AS mean, count(*) AS n FROM wn JOIN {table} x ON x.{key} = k0 AND x.date BETWEEN e - CAST(days - 1 AS INTEGER) AND e WHERE e - CAST(days - 1 AS INTEGER) >= f GROUP BY ALL HAVING count(*) >= {cov} * days)"""


def rating(table, keys, value, year, b0, b1, nb, na):
    """SQL rating the value of ``year`` against earlier years."""
    ks = ", ".join(keys + ["days"])
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys + ["days"])
    return f"""cnt AS (SELECT {ks}, count(*) FILTER (WHERE year BETWEEN {b0} AND {b1}) AS nb, count(*) AS na FROM {table} WHERE year < {year} GROUP BY {ks}),
 pool AS (SELECT a.*, CASE WHEN nb >= {nb} THEN 'baseline' ELSE 'whole record' END AS basis FROM {table} a JOIN cnt b ON {on} WHERE a.year < {year} AND CASE WHEN nb >= {nb} THEN a.year BETWEEN {b0} AND {b1} ELSE na >= {na} END),
 cur AS (SELECT * FROM {table} WHERE year = {year}),
 rt0 AS (SELECT {", ".join("b." + k for k in keys + ["days"])}, b.{value} AS value, b.n AS n_days, min(a.basis) AS basis, 100.0 * (count(*) FILTER (WHERE a.{value} < b.{value}) + 0.5 * count(*) FILTER (WHERE a.{value} = b.{value})) / nullif(count(a.{value}), 0) AS pct,
  median(a.{value}) AS median, nullif(count(a.{value}), 0) AS n_years FROM cur b LEFT JOIN pool a ON {on} GROUP BY {", ".join("b." + k for k in keys + ["days"])}, b.{value}, b.n),
 rt AS (SELECT *, {CLS} AS cls FROM rt0)"""


@query("I5_flow_periods", f"""WITH {windows("chosen", "gauge", "cfs", "2001-10-31", (30, 90, 180, 365), 0.5)}, wq AS (SELECT k0 AS gauge, year, days, mean, n FROM wm), {rating("wq", ["gauge"], "mean", 2001, 1995, 1999, 4, 3)},
 s AS (SELECT segment, days, median(pct) AS pct, count(*) AS n_gauges FROM rt JOIN gauges ON gauges.gauge = rt.gauge WHERE pct IS NOT NULL GROUP BY 1, 2) SELECT segment, CAST(days AS BIGINT) AS days, round(pct, 6) AS pct, n_gauges, {CLS} AS cls FROM s""")
def i5(t):
    return n.flow_periods(t.chosen, t.gauges.drop("river"), day("2001-10-31"), baseline=BASE, min_base=4, min_fallback=3, coverage=0.5)


EXITS = "gr AS (SELECT DISTINCT gauge, river FROM gauges), ex AS (SELECT river, gauge, date, cfs FROM chosen JOIN gr USING (gauge) WHERE NOT (gauge = 'G1' AND date > DATE '2001-09-01'))"


def exits(t):
    """Daily flow of every river's gauges; one gauge of the first river stops reporting early."""
    return t.chosen.join(t.gauges.select("gauge", "river").distinct(), "gauge").where(~((F.col("gauge") == "G1") & (F.col("date") > "2001-09-01"))).select("river", "gauge", "date", "cfs")


LAST = "la AS (SELECT river, gauge, max(date) AS l, max(max(date)) OVER (PARTITION BY river) AS nw FROM ex GROUP BY 1, 2), st AS (SELECT *, nw - l > 14 AS stale FROM la)"


@query("I29_exit_set", f"""WITH {EXITS}, {LAST}
SELECT river, gauge, strftime(l, '%Y-%m-%d') AS last_date, stale, strftime(min(l) FILTER (WHERE NOT stale) OVER (PARTITION BY river), '%Y-%m-%d') AS common_end FROM st""")
def i29e(t):
    return n.exit_set(exits(t))


XW = windows("ex", "gauge", "cfs", "2001-08-31", (7, 30, 90), 0.5)


@query("I29_exit_ratings", f"""WITH {EXITS}, {XW}, wq AS (SELECT river, k0 AS gauge, year, days, mean * days * 1.983471 AS volume_af, n FROM wm JOIN gr ON gr.gauge = k0), {rating("wq", ["river", "gauge"], "volume_af", 2001, 1995, 1999, 4, 3)}
SELECT river, gauge, CAST(days AS BIGINT) AS days, round(value, 6) AS volume_af, n_days, basis, round(pct, 6) AS pct, round(median, 6) AS median, n_years, cls, round(CASE WHEN median > 0 THEN 100 * value / median END, 6) AS percent_of_median FROM rt""")
def i29(t):
    d = day("2001-08-31")
    return n.exit_ratings(n.exit_windows(exits(t), d, (7, 30, 90), 0.5), d, BASE, 4, 3)


@query("I29_exit_total", f"""WITH {EXITS}, {XW}, {LAST}, us AS (SELECT river, gauge FROM st WHERE NOT stale), nu AS (SELECT river, count(*) AS u FROM us GROUP BY 1),
 wq AS (SELECT river, days, year, volume_af, n FROM (SELECT river, days, year, sum(mean * days * 1.983471) AS volume_af, count(*) AS n FROM wm JOIN us ON us.gauge = k0 GROUP BY 1, 2, 3) JOIN nu USING (river) WHERE n = u),
 {rating("wq", ["river"], "volume_af", 2001, 1995, 1999, 4, 3)} SELECT river, CAST(days AS BIGINT) AS days, round(value, 3) AS volume_af, basis, round(pct, 6) AS pct, round(median, 3) AS median, n_years, cls, round(CASE WHEN median > 0 THEN 100 * value / median END, 3) AS percent_of_median FROM rt""")
def i29t(t):
    d = day("2001-08-31")
    used = n.exit_set(exits(t)).where("NOT stale").select("river", "gauge")
    r = n.exit_total(n.exit_windows(exits(t), d, (7, 30, 90), 0.5), used, d, BASE, 4, 3)
    return r.select(*[F.round(c, 3).alias(c) if c in ("volume_af", "median", "percent_of_median") else F.col(c) for c in r.columns])


WY = f"""{EXITS}, ff AS (SELECT gauge, min(date) AS f FROM ex GROUP BY 1), wy AS (SELECT river, gauge, year(date) + (month(date) >= 10)::INT AS wy, avg(cfs) AS m, count(*) AS n FROM ex GROUP BY 1, 2, 3 HAVING year(max(date)) + (month(max(date)) >= 10)::INT <= 2001),
 vol AS (SELECT river, gauge, wy, n, CASE WHEN f <= make_date(wy::INT - 1, 10, 1) AND n >= 0.6 * (make_date(wy::INT, 9, 30) - make_date(wy::INT - 1, 10, 1) + 1) THEN m * (make_date(wy::INT, 9, 30) - make_date(wy::INT - 1, 10, 1) + 1) * 1.983471 END AS volume_af FROM wy JOIN ff USING (gauge))"""


@query("I29_water_years", f"WITH {WY} SELECT river, gauge, wy, n, round(volume_af, 4) AS volume_af FROM vol")
def i29w(t):
    return n.water_year_volumes(exits(t), 2001, 0.6).withColumn("volume_af", F.round("volume_af", 4))


@query("I29_water_year_total", f"WITH {WY}, wt AS (SELECT river, count(*) AS want FROM gr GROUP BY 1) SELECT river, wy, round(CASE WHEN count(volume_af) = any_value(want) THEN sum(volume_af) END, 3) AS total_af FROM vol JOIN wt USING (river) GROUP BY 1, 2")
def i29y(t):
    return n.water_year_totals(n.water_year_volumes(exits(t), 2001, 0.6), t.gauges).withColumn("total_af", F.round("total_af", 3))
