"""Grid, precipitation, temperature and drought queries."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import climate as c
from tidemark.operators import grids as g
from tidemark.operators.spatial import box_edges
from tidemark.plans.normals_queries import CLS
from tidemark.plans.registry import query
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import manifest

STEP = 0.25
SUBS = """sub AS (SELECT iy, ix, lon + ((j + 0.5) / {n} - 0.5) * 0.25 AS x, lat + ((i + 0.5) / {n} - 0.5) * 0.25 AS y FROM (SELECT DISTINCT iy, ix, lat, lon FROM grid), range(0, {n}) a(i), range(0, {n}) b(j))"""
W = f"""{SUBS.format(n=8)}, wts AS (SELECT unit, iy, ix, count(*) / 64.0::DOUBLE AS weight FROM sub JOIN boxes ON x > x0 AND x < x1 AND y > y0 AND y < y1 GROUP BY 1, 2, 3)"""


def weights(t):
    return g.cell_weights(t.grid, box_edges(t.boxes), STEP, STEP)


@query("J1_cell_weights", f"WITH {W} SELECT unit, CAST(iy AS BIGINT) AS iy, CAST(ix AS BIGINT) AS ix, weight FROM wts")
def j1(t):
    return weights(t)


@query("J1_polygon_cells", "SELECT unit, round((x1 - x0) * (y1 - y0) / 0.0625, 6)::DOUBLE AS cells FROM boxes")
def j1c(t):
    return g.polygon_cells(box_edges(t.boxes), STEP, STEP)


ZM = f"{W}, zm AS (SELECT unit, date, sum(value * weight) / sum(weight) AS value, count(*) AS cells FROM grid JOIN wts USING (iy, ix) WHERE value IS NOT NULL GROUP BY 1, 2)"


@query("J2_zonal_mean", f"WITH {ZM} SELECT unit, strftime(date, '%Y-%m-%d') AS date, round(value, 6) AS value, cells FROM zm")
def j2(t):
    return g.zonal_mean(t.grid, weights(t))


@query("J3_zonal_rows", f"""WITH {ZM} SELECT unit, strftime(date, '%Y-%m-%d') AS date, 'monthly' AS interval, round(value * 0.0393700787, 4) AS precip_in, strftime(date, '%Y-%m-%d 00:00:00') AS period_start_utc, strftime(date + INTERVAL 1 MONTH, '%Y-%m-%d 00:00:00') AS period_end_utc FROM zm""")
def j3(t):
    return g.zonal_rows(g.zonal_mean(t.grid, weights(t)), "monthly")


@query("J4_grid_coverage", f"""WITH {W}, pc AS (SELECT unit, (x1 - x0) * (y1 - y0) / 0.0625 AS cells FROM boxes), v AS (SELECT unit, sum(weight) AS w FROM grid JOIN wts USING (iy, ix) WHERE date = DATE '1998-03-01' AND value IS NOT NULL GROUP BY 1)
SELECT unit, round(coalesce(w, 0) / cells, 4)::DOUBLE AS grid_fraction, round(coalesce(w, 0) / cells, 4) >= 0.6 AS has_precip FROM pc LEFT JOIN v USING (unit)""")
def j4(t):
    e = box_edges(t.boxes)
    return g.grid_coverage(t.grid.where("date = DATE '1998-03-01'"), weights(t), g.polygon_cells(e, STEP, STEP), 0.6)


@query("J5_stale_years", """SELECT year(o_orderdate) AS year, 'f' || year(o_orderdate) AS file, count(*) AS size, CAST(max(o_orderkey) AS BIGINT) AS mtime FROM orders GROUP BY 1 HAVING year(o_orderdate) % 3 = 0 OR year(o_orderdate) = 2001""")
def j5(t):
    files = t.read("orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("size"), F.max("o_orderkey").alias("mtime")).withColumn("file", F.concat(F.lit("f"), "year"))
    man = files.where("year <> 2001").withColumn("mtime", F.when(F.col("year") % 3 == 0, F.col("mtime") - 1).otherwise(F.col("mtime"))).withColumn("method", F.lit(2))
    return g.stale_years(files, man, F.col("method") == 2)


@query("J5_incremental", f"""WITH {W}, g2 AS (SELECT iy, ix, date, CASE WHEN year(date) % 3 = 0 THEN value * 2 ELSE value END AS value FROM grid)
SELECT unit, CAST(year(date) AS BIGINT) AS year, strftime(date, '%Y-%m-%d') AS date, round(sum(value * weight) / sum(weight), 6) AS value, count(*) AS cells, year(date) % 3 = 0 AS remade FROM g2 JOIN wts USING (iy, ix) WHERE value IS NOT NULL GROUP BY unit, date""")
def j5i(t):
    # a result over all years, then new files for every third year, and the result again
    base = f"{ensure_checkpoint_dir(t.spark)}/incremental-{uuid.uuid4().hex}"
    grid = t.grid.withColumn("year", F.year("date"))
    w = weights(t)
    kinds = T._parse_datatype_string("unit string, date date, value double, cells bigint, year int")
    make = lambda d: g.zonal_mean(d, w).withColumn("year", F.year("date"))
    again = lambda: g.recompute_years(t.spark, f"{base}/in", f"{base}/out", kinds, "v1", make)
    write = lambda d: d.hint("rebalance", F.col("year")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(f"{base}/in")
    write(grid)
    again()
    write(grid.where("year % 3 = 0").withColumn("value", F.col("value") * 2))
    again()
    out = manifest.read(t.spark, f"{base}/out", kinds)
    return out.select("unit", "year", "date", "value", "cells", F.col("_metadata.file_path").contains("version=made-2-").alias("remade"))


@query("J6_select_units", f"""WITH {SUBS.format(n=4)}, st AS (SELECT * FROM sub WHERE x > -108.1 AND x < -107.0 AND y > 33.1 AND y < 34.2), a AS (SELECT unit, count(*) AS n, count(*) FILTER (WHERE x > -108.1 AND x < -107.0 AND y > 33.1 AND y < 34.2) AS i FROM sub JOIN boxes ON x > x0 AND x < x1 AND y > y0 AND y < y1 GROUP BY 1)
SELECT unit, i / n::DOUBLE AS state_fraction, unit = 'W4' AS in_river_reports FROM a WHERE i / n::DOUBLE >= 0.01 OR unit = 'W4'""".replace("i / n::DOUBLE AS state_fraction", "round(i / n::DOUBLE, 6) AS state_fraction"))
def j6(t):
    state = box_edges(t.boxes.where("unit = 'W0'").select(F.lit("NM").alias("unit"), F.lit(-108.1).alias("x0"), F.lit(-107.0).alias("x1"), F.lit(33.1).alias("y0"), F.lit(34.2).alias("y1")))
    used = t.boxes.where("unit = 'W4'").select("unit")
    return g.select_units(t.grid, box_edges(t.boxes), state, used, STEP, STEP)


CM = "cmn AS (SELECT unit, date, avg(value) AS value, count(*) AS cells FROM grid JOIN boxes ON lon > x0 AND lon < x1 AND lat > y0 AND lat < y1 WHERE value IS NOT NULL GROUP BY 1, 2)"


@query("J7_centre_means", f"WITH {CM} SELECT unit, strftime(date, '%Y-%m-%d') AS date, round(value, 6) AS value, cells FROM cmn WHERE NOT (unit = 'W1' AND year(date) < 1999)")
def j7(t):
    done = t.grid.where("year(date) < 1999").select(F.lit("W1").alias("unit"), "date").distinct()
    return g.centre_means(t.grid, box_edges(t.boxes), done)


@query("J8_daily_units", f"WITH {CM} SELECT unit, strftime(date, '%Y-%m-%d') AS date, round(value, 6) AS value, cells FROM cmn WHERE NOT (unit = 'W2' AND year(date) < 1998)")
def j8(t):
    e = box_edges(t.boxes)
    old = t.grid.where("year(date) < 1998").select("date").distinct()
    sig = g.unit_signature(e).withColumn("signature", F.when(F.col("unit") == "W2", F.col("signature")).otherwise("outdated")).where("unit IN ('W1', 'W2')")
    done = old.withColumn("unit", F.explode(F.array(F.lit("W1"), F.lit("W2")))).join(sig, "unit")
    return g.daily_units(t.grid, e, done).drop("signature")


@query("J9_clip_to_box", "SELECT count(*) AS n, round(sum(value), 4) AS total FROM grid WHERE lon BETWEEN -107.4 AND -106.2 AND lat BETWEEN 33.6 AND 35.1")
def j9(t):
    shifted = t.grid.withColumn("lon", F.when(F.col("ix") % 2 == 0, F.col("lon") + 360).otherwise(F.col("lon")))
    return g.clip_to_box(shifted, (-107.4, 33.6, -106.2, 35.1)).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("J10_repair_grid", """WITH r AS (SELECT date, iy // 2 AS a, ix AS b, value, (iy % 2 = 0) = (year(date) % 2 = 0) OR year(date) = 1997 AS keep FROM grid WHERE value IS NOT NULL)
SELECT strftime(date, '%Y-%m-%d') AS date, CAST(a AS BIGINT) AS row_no, CAST(b AS BIGINT) AS col_no, CASE WHEN count(*) = 1 THEN round(max(value), 6) END AS value, count(*) > 1 AS collision FROM r WHERE keep GROUP BY 1, 2, 3""")
def j10(t):
    keep = ((F.col("iy") % 2 == 0) == (F.year("date") % 2 == 0)) | (F.year("date") == 1997)
    d = t.grid.where(keep).select("date", (F.floor(F.col("iy") / 2) * 1.0 + (F.col("iy") % 2) * 0.2).alias("lat"), (F.col("ix") * 1.0).alias("lon"), "value")
    r = g.repair_grid(d, 1.0)
    return r.select("date", F.floor("lat").alias("row_no"), F.floor("lon").alias("col_no"), "value", "collision")


AREA = "pow(6371008.8, 2) * radians(0.25) * abs(sin(radians(lat) + radians(0.25) / 2) - sin(radians(lat) - radians(0.25) / 2))"


@query("J12_day_stats", f"""WITH a AS (SELECT date, {AREA} AS a, value / 1000 AS v FROM grid), s AS (SELECT date, sum(a) AS tot, sum(a) FILTER (WHERE v IS NOT NULL) AS ok, sum(a * v) AS vol, coalesce(sum(a) FILTER (WHERE v * 1000 >= 25), 0) AS cov, max(v) AS deep, coalesce(sum(a) FILTER (WHERE v * 1000 >= 10), 0) AS snow FROM a GROUP BY 1)
SELECT strftime(date, '%Y-%m-%d') AS date, round(vol / ok * 39.3700787, 6) AS swe_in, round(vol / 1233.48184, 0) AS volume_af, round(100 * cov / ok, 6) AS cover_pct, round(100 * ok / tot, 6) AS valid_pct, round(deep * 39.3700787, 6) AS max_swe_in, round(snow / 2589988.11, 4) AS snow_sq_mi FROM s WHERE ok / tot >= 0.9""")
def j12(t):
    d = g.day_stats(t.grid.withColumn("value", F.col("value") / 1000), STEP, STEP)
    return d.withColumn("volume_af", F.round("volume_af")).withColumn("snow_sq_mi", F.round("snow_sq_mi", 4))


SEEDS = "seeds AS (SELECT 'rg' || (s_suppkey % 3) AS range_id, 33.0 + (s_suppkey * 17 % 29) * 0.1 AS lat, -108.0 + (s_suppkey * 13 % 23) * 0.1 AS lon FROM supplier)"


@query("J22_snow_zones", f"""WITH RECURSIVE {SEEDS}, m AS (SELECT iy, ix, lat, lon, avg(value) AS mean FROM grid WHERE month(date) IN (1, 2, 3) GROUP BY 1, 2, 3, 4),
 k AS (SELECT m.iy, m.ix, mean, range_id, sqrt(pow((m.lon - s.lon) * 111.0 * cos(radians(m.lat)), 2) + pow((m.lat - s.lat) * 111.0, 2)) AS km FROM m, seeds s), l AS (SELECT iy, ix, mean, min(km) AS km, min_by(range_id, (km, range_id)) AS range_id FROM k GROUP BY 1, 2, 3),
 z AS (SELECT *, iy * 1000 + ix AS id FROM l WHERE mean >= 24 AND km < 60), e AS (SELECT a.id AS a, b.id AS b FROM z a JOIN z b ON a.range_id = b.range_id AND abs(a.iy - b.iy) + abs(a.ix - b.ix) = 1), r(id, seen) AS (SELECT id, id FROM z UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.seen),
 n AS (SELECT id, count(*) AS patch_cells FROM r GROUP BY 1) SELECT range_id, CAST(iy AS BIGINT) AS iy, CAST(ix AS BIGINT) AS ix, round(mean, 6) AS mean, round(km, 6) AS km, patch_cells FROM z JOIN n USING (id) WHERE patch_cells >= 3""")
def j22(t):
    k = F.col("s_suppkey")
    seeds = t.read("supplier").select(F.concat(F.lit("rg"), k % 3).alias("range_id"), (33.0 + (k * 17 % 29) * 0.1).alias("lat"), (-108.0 + (k * 13 % 23) * 0.1).alias("lon"))
    mean = g.climatology(t.grid, F.month("date").isin(1, 2, 3))
    ranges = seeds.select("range_id").distinct().select("range_id", F.lit(24.0).alias("threshold_in"), F.lit(60.0).alias("radius_km"), F.lit(3).alias("min_cells"))
    return g.snow_zones(mean.select("iy", "ix", "mean"), g.label_cells(mean, seeds, 60.0), ranges)


YEARS = (1995, 2000)
WIN = """wl AS (SELECT max(date) AS l FROM state_days), wk AS (SELECT y, k, make_date(y::INT, month(l)::INT, least(day(l), day(last_day(make_date(y::INT, month(l)::INT, 1))))::INT) AS e FROM wl, range(1995, 2002) a(y), (VALUES (7), (30), (90)) v(k)),
 wx AS (SELECT y, k, e, {agg} AS amount, max(value) AS top, min_by(date, (-value, date)) AS topd FROM wk JOIN state_days ON date BETWEEN e - CAST(k - 1 AS INTEGER) AND e GROUP BY 1, 2, 3 HAVING count(*) = k),
 wr AS (SELECT a.k, a.e, a.amount, a.top, a.topd, count(b.amount) AS years, CASE WHEN count(b.amount) >= 3 THEN avg(b.amount) END AS normal, CASE WHEN count(b.amount) >= 3 THEN 100.0 * (count(*) FILTER (WHERE b.amount < a.amount) + 0.5 * count(*) FILTER (WHERE b.amount = a.amount)) / count(b.amount) END AS pct
  FROM wx a LEFT JOIN wx b ON b.k = a.k AND b.y BETWEEN 1995 AND 2000 WHERE a.y = 2001 GROUP BY 1, 2, 3, 4, 5)"""
WCOLS = f"""'NM' AS unit, CAST(k AS BIGINT) AS days, strftime(e - CAST(k - 1 AS INTEGER), '%Y-%m-%d') AS window_start, strftime(e, '%Y-%m-%d') AS window_end, round(amount, 6) AS amount, round(normal, 6) AS normal, years, round(pct, 6) AS percentile, {CLS} AS cls, round(top, 6) AS highest, strftime(topd, '%Y-%m-%d') AS highest_date"""


@query("J24_window_stats", f"WITH {WIN.format(agg='sum(value)')} SELECT {WCOLS}, round(100 * amount / normal, 6) AS percent_of_normal FROM wr")
def j24(t):
    return c.window_stats(t.state_days, ["unit"], "value", (7, 30, 90), YEARS, 3)


@query("J28_window_means", f"WITH {WIN.format(agg='avg(value)')} SELECT {WCOLS}, round(amount - normal, 6) AS anomaly FROM wr")
def j28w(t):
    return c.window_stats(t.state_days, ["unit"], "value", (7, 30, 90), YEARS, 3, mean=True)


@query("J25_monthly_totals", """WITH m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, sum(value) AS total, count(*) AS days FROM state_days GROUP BY 1), c AS (SELECT *, days = day(last_day(month)) AS complete FROM m),
 b AS (SELECT month(month) AS mm, avg(total) AS n FROM c WHERE complete AND year(month) BETWEEN 1995 AND 2000 GROUP BY 1), p AS (SELECT c.month, sum(s.value) / 6 AS n FROM c JOIN state_days s ON month(s.date) = month(c.month) AND day(s.date) <= c.days AND year(s.date) BETWEEN 1995 AND 2000 WHERE NOT c.complete GROUP BY 1)
SELECT 'NM' AS unit, strftime(c.month, '%Y-%m-%d') AS month, round(total, 6) AS total, days, complete, round(CASE WHEN complete THEN b.n ELSE coalesce(p.n, 0) END, 6) AS normal FROM c LEFT JOIN b ON b.mm = month(c.month) LEFT JOIN p ON p.month = c.month""")
def j25(t):
    return c.monthly_totals(t.state_days, ["unit"], "value", YEARS)


MON = "um AS (SELECT unit, CAST(date_trunc('month', date) AS DATE) AS date, sum(value) AS value FROM unit_days GROUP BY 1, 2)"


def months(t):
    return t.unit_days.groupBy("unit", F.trunc("date", "month").alias("date")).agg(F.sum("value").alias("value"))


@query("J26_monthly_vs_normal", f"""WITH {MON}, n AS (SELECT unit, month(date) AS m, median(value) AS normal FROM um WHERE year(date) BETWEEN 1995 AND 2000 GROUP BY 1, 2)
SELECT um.unit, strftime(date, '%Y-%m-%d') AS date, round(value, 6) AS value, round(normal, 6) AS normal, round(value - normal, 6) AS anomaly FROM um LEFT JOIN n ON n.unit = um.unit AND n.m = month(date)""")
def j26(t):
    return c.monthly_vs_normal(months(t), ["unit"], "median", YEARS)


@query("J27_statewide", """SELECT strftime(date, '%Y-%m-%d') AS date, round(sum(value * w) / sum(w), 6) AS value, count(*) AS units FROM (SELECT *, CAST(substr(unit, 2) AS DOUBLE) AS w FROM unit_days) WHERE w > 0 GROUP BY 1""")
def j27(t):
    w = t.unit_days.select("unit").distinct().withColumn("weight", F.substring("unit", 2, 9).cast("double"))
    return c.statewide(t.unit_days.select("unit", "date", "value"), w)


@query("J28_weighted_mean", f"""WITH {W}, sw AS (SELECT unit, iy, ix, weight * cos(radians(33.0 + iy * 0.25)) AS w FROM wts), tw AS (SELECT unit, sum(w) AS t FROM sw GROUP BY 1), q AS (SELECT unit, date, sum(value * w) AS n, sum(w) FILTER (WHERE value IS NOT NULL) AS d FROM grid JOIN sw USING (iy, ix) GROUP BY 1, 2)
SELECT unit, strftime(date, '%Y-%m-%d') AS date, round(n / d, 6) AS value, round(coalesce(d, 0) / t, 6) AS coverage FROM q JOIN tw USING (unit)""")
def j28(t):
    return c.weighted_mean(t.grid, c.state_weights(weights(t), t.grid))


@query("J28_annual_anomaly", f"""WITH {MON}, n AS (SELECT unit, month(date) AS m, avg(value) AS normal FROM um WHERE year(date) BETWEEN 1995 AND 2000 GROUP BY 1, 2), a AS (SELECT um.unit, date, value, value - normal AS an FROM um LEFT JOIN n ON n.unit = um.unit AND n.m = month(date))
SELECT unit, year(date) AS year, round(avg(value), 6) AS value, round(avg(an), 6) AS anomaly FROM a GROUP BY 1, 2 HAVING count(value) = 12""")
def j28a(t):
    return c.annual_anomaly(c.monthly_vs_normal(months(t), ["unit"], "mean", YEARS), ["unit"])


@query("J28_recent_daily", """WITH cl AS (SELECT unit, dayofyear(make_date(2000, month(date)::INT, day(date)::INT)) AS doy, avg(value) AS m FROM unit_days WHERE year(date) BETWEEN 1995 AND 2000 GROUP BY 1, 2), p AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doy) AS i, count(*) OVER (PARTITION BY unit) AS n FROM cl),
 s AS (SELECT a.unit, a.doy, avg(b.m) AS normal FROM p a JOIN range(-7, 8) r(k) ON true JOIN p b ON b.unit = a.unit AND b.i = (a.i - 1 + k + a.n) % a.n + 1 GROUP BY 1, 2), l AS (SELECT unit, max(date) AS l FROM unit_days GROUP BY 1)
SELECT u.unit, strftime(u.date, '%Y-%m-%d') AS date, round(u.value, 6) AS value, round(normal, 6) AS normal FROM unit_days u JOIN l ON l.unit = u.unit AND l.l - u.date < 365 LEFT JOIN s ON s.unit = u.unit AND s.doy = dayofyear(make_date(2000, month(u.date)::INT, day(u.date)::INT))""")
def j28r(t):
    u = t.unit_days.select("unit", "date", "value")
    return c.recent_daily(u, c.smoothed_normal(u, ["unit"], YEARS), ["unit"])


DRD = """dr AS (SELECT 'H' || (o_custkey % 4) AS unit, CAST(date_trunc('week', o_orderdate) AS DATE) AS date, ['d0','d1','d2','d3','d4','dsci'][o_orderkey % 6 + 1] AS variable, greatest(o_totalprice - 60000 * (o_orderkey % 6), 0) / 5000 AS value, o_orderkey AS ord FROM orders),
 pv AS (SELECT unit, date, max_by(value, ord) FILTER (WHERE variable = 'd0') AS d0, max_by(value, ord) FILTER (WHERE variable = 'd1') AS d1, max_by(value, ord) FILTER (WHERE variable = 'd2') AS d2, max_by(value, ord) FILTER (WHERE variable = 'd3') AS d3, max_by(value, ord) FILTER (WHERE variable = 'd4') AS d4,
  max_by(value, ord) FILTER (WHERE variable = 'dsci') AS dsci FROM dr GROUP BY 1, 2), wd AS (SELECT * FROM pv WHERE d0 IS NOT NULL AND d1 IS NOT NULL AND d2 IS NOT NULL AND d3 IS NOT NULL AND d4 IS NOT NULL AND dsci IS NOT NULL), nw AS (SELECT unit, max(date) AS m FROM wd GROUP BY 1)"""


def weekly(t):
    k = F.col("o_orderkey") % 6
    r = t.read("orders").select(F.concat(F.lit("H"), F.col("o_custkey") % 4).alias("unit"), F.to_date(F.date_trunc("week", "o_orderdate")).alias("date"), F.element_at(F.array(*[F.lit(x) for x in (*c.CATEGORIES, "dsci")]), (k + 1).cast("int")).alias("variable"),
                                (F.greatest(F.col("o_totalprice") - 60000 * k, F.lit(0.0)) / 5000).alias("value"), F.col("o_orderkey").alias("order"))
    return c.weekly_drought(r, ["unit"])


@query("J29_weekly_drought", f"WITH {DRD} SELECT unit, strftime(date, '%Y-%m-%d') AS date, round(d0, 6) AS d0, round(d1, 6) AS d1, round(d2, 6) AS d2, round(d3, 6) AS d3, round(d4, 6) AS d4, round(dsci, 6) AS dsci FROM wd")
def j29(t):
    return weekly(t)


@query("J29_drought_changes", f"""WITH {DRD}, n AS (SELECT wd.* FROM wd JOIN nw ON nw.unit = wd.unit AND m = date) SELECT n.unit, CAST(k AS BIGINT) AS weeks, strftime(b.date, '%Y-%m-%d') AS "from", round(b.dsci, 6) AS dsci_then, round(n.d0 - b.d0, 6) AS change_d0, round(n.d1 - b.d1, 6) AS change_d1, round(n.d2 - b.d2, 6) AS change_d2,
 round(n.d3 - b.d3, 6) AS change_d3, round(n.d4 - b.d4, 6) AS change_d4, round(n.dsci - b.dsci, 6) AS change_dsci FROM n, (VALUES (1), (4), (13), (26), (52)) v(k), wd b WHERE b.unit = n.unit AND b.date = n.date - CAST(7 * k AS INTEGER)""")
def j29c(t):
    return c.drought_changes(weekly(t), ["unit"])


@query("J29_drought_summary", f"""WITH {DRD}, n AS (SELECT wd.* FROM wd JOIN nw ON nw.unit = wd.unit AND m = date), j AS (SELECT n.unit, n.date AS as_of, n.dsci AS now, n.d0, n.d1, n.d2, n.d3, n.d4, w.date, w.dsci, year(w.date) BETWEEN 1995 AND 2001 AND year(w.date) <> year(n.date) AND least(abs(dayofyear(w.date) - dayofyear(n.date)), 365 - abs(dayofyear(w.date) - dayofyear(n.date))) <= 21 AS near FROM n JOIN wd w ON w.unit = n.unit)
SELECT unit, strftime(as_of, '%Y-%m-%d') AS as_of, round(now, 6) AS dsci, CASE WHEN d4 > 0 THEN 'D4' WHEN d3 > 0 THEN 'D3' WHEN d2 > 0 THEN 'D2' WHEN d1 > 0 THEN 'D1' WHEN d0 > 0 THEN 'D0' END AS worst_category, count(*) FILTER (WHERE near) AS sample_weeks, count(DISTINCT year(date)) FILTER (WHERE near) AS sample_years,
 strftime(min(date), '%Y-%m-%d') AS record_start, count(*) AS weeks, round(100.0 * (count(*) FILTER (WHERE near AND dsci < now) + 0.5 * count(*) FILTER (WHERE near AND dsci = now)) / nullif(count(*) FILTER (WHERE near), 0), 6) AS percentile FROM j GROUP BY unit, as_of, now, d0, d1, d2, d3, d4""")
def j29s(t):
    return c.drought_summary(weekly(t), ["unit"], (1995, 2001))


@query("J29_basin_drought", """SELECT huc8, substr(huc8, 1, 4) AS huc4, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date, o_totalprice AS dsci FROM (SELECT DISTINCT huc8 FROM sites WHERE huc8 IS NOT NULL) JOIN orders ON substr(huc8, 1, 4) = '130' || (o_custkey % 4) WHERE o_orderkey % 3 = 0""")
def j29b(t):
    r = t.read("orders").select(F.concat(F.lit("usdm:huc4:130"), F.col("o_custkey") % 4).alias("site_uid"), F.when(F.col("o_orderkey") % 3 == 0, "dsci").otherwise("d0").alias("variable"), F.col("o_orderdate").cast("timestamp").alias("datetime_utc"), F.col("o_totalprice").alias("value"))
    return c.basin_drought(t.sites.where("huc8 IS NOT NULL"), r)


DATES = ("2000-11-01", "2001-02-01", "2001-05-01", "2001-07-15")


@query("J38_past_ratings", f"""WITH ds AS (SELECT * FROM (VALUES (DATE '2000-11-01'), (DATE '2001-02-01'), (DATE '2001-05-01'), (DATE '2001-07-15')) v(d)), l AS (SELECT d, max(date) AS l FROM ds JOIN state_days ON date <= d GROUP BY 1),
 k AS (SELECT d, l, y, make_date(y::INT, month(l)::INT, least(day(l), day(last_day(make_date(y::INT, month(l)::INT, 1))))::INT) AS e FROM l, range(1995, 2002) a(y) WHERE y <= year(l)), x AS (SELECT d, l, y, sum(value) AS v FROM k JOIN state_days ON date BETWEEN e - 29 AND e AND date <= d GROUP BY 1, 2, 3 HAVING count(*) = 30),
 r AS (SELECT a.d, a.l, a.v, CASE WHEN count(b.v) >= 3 THEN 100.0 * (count(*) FILTER (WHERE b.v < a.v) + 0.5 * count(*) FILTER (WHERE b.v = a.v)) / count(b.v) END AS pct FROM x a LEFT JOIN x b ON b.d = a.d AND b.y BETWEEN 1995 AND 1999 WHERE a.y = year(a.l) GROUP BY 1, 2, 3)
SELECT 'NM' AS unit, strftime(d, '%Y-%m-%d') AS stated_on, strftime(l, '%Y-%m-%d') AS window_end, round(v, 6) AS amount, round(pct, 6) AS percentile, {CLS} AS cls FROM r""")
def j38(t):
    return c.past_ratings(t.state_days, DATES, ["unit"], "value", 30, (1995, 1999), 3)
