"""Reservoir and water-balance queries."""

from pyspark.sql import functions as F

from tidemark.functions.literals import fixed
from tidemark.operators import balance as b
from tidemark.operators import reservoir as r
from tidemark.plans.registry import query
from tidemark.session import ensure_checkpoint_dir

DAY = lambda s: F.lit(s).cast("date")


@query("I2_table_lookup", "SELECT reservoir, strftime(date, '%Y-%m-%d') AS date, round(stor, 6) AS stor, round(elev, 6) AS elev, y, round(off, 4) AS off FROM pairs")
def i2(t):
    return t.pairs.withColumn("off", F.round("off", 4))


ERAS = """eras AS (SELECT * FROM (SELECT 'res' || (p_partkey % 6) AS reservoir, DATE '1995-06-01' + CAST((p_partkey % 37) * 61 AS INTEGER) AS start, max(p_size) * 1000.0 AS cap, min(p_type) AS label FROM part GROUP BY 1, 2))"""


def eras(t):
    k = F.col("p_partkey")
    return t.read("part").groupBy(F.concat(F.lit("res"), k % 6).alias("reservoir"), F.date_add(DAY("1995-06-01"), ((k % 37) * 61).cast("int")).alias("start")).agg(
        (F.max("p_size") * 1000.0).alias("cap"), F.min("p_type").alias("label"))


@query("I6_capacity_in_force", f"""
WITH {ERAS}, iv AS (SELECT *, lead(start) OVER w AS nxt, row_number() OVER w AS k FROM eras WINDOW w AS (PARTITION BY reservoir ORDER BY start))
SELECT d.reservoir, strftime(d.date, '%Y-%m-%d') AS date, e.cap::DOUBLE AS cap, e.label, d.date < e.start AS before_record FROM reservoir_days d LEFT JOIN iv e ON e.reservoir = d.reservoir AND (d.date >= e.start OR e.k = 1) AND (e.nxt IS NULL OR d.date < e.nxt)""")
def i6(t):
    return r.in_force(t.reservoir_days.select("reservoir", "date"), eras(t), "start", ["cap", "label"])


LEVELS = """levels AS (SELECT 'res' || (p_partkey % 6) AS reservoir, ['Top of Conservation','Top of Flood','Spillway Crest','Other'][p_partkey % 4 + 1] AS level_name, CASE WHEN p_partkey % 5 < 3 THEN 'Stor' ELSE 'Elev' END AS parameter,
 DATE '1980-01-01' + CAST((p_partkey % 90) * 90 AS INTEGER) AS level_date, CASE WHEN p_partkey % 5 < 3 THEN p_size * 9000.0 ELSE 4040.0 + p_size END::DOUBLE AS value, p_partkey AS seq FROM part)"""


def levels(t):
    k = F.col("p_partkey")
    stor = k % 5 < 3
    return t.read("part").select(
        F.concat(F.lit("res"), k % 6).alias("reservoir"), F.element_at(F.array(*[F.lit(x) for x in ("Top of Conservation", "Top of Flood", "Spillway Crest", "Other")]), (k % 4 + 1).cast("int")).alias("level_name"),
        F.when(stor, "Stor").otherwise("Elev").alias("parameter"), F.date_add(DAY("1980-01-01"), ((k % 90) * 90).cast("int")).alias("level_date"),
        F.when(stor, F.col("p_size") * 9000.0).otherwise(4040.0 + F.col("p_size")).alias("value"), k.alias("seq"))


@query("I7_pool_history", f"""
WITH {LEVELS}, s AS (SELECT * FROM levels WHERE parameter = 'Stor'), m AS (SELECT reservoir, level_name, median(value) AS m FROM s GROUP BY 1, 2), ok AS (SELECT s.* FROM s JOIN m USING (reservoir, level_name) WHERE value > 0.5 * m AND value < 2 * m)
SELECT reservoir, level_name, strftime(level_date, '%Y-%m-%d') AS level_date, max_by(value, seq) AS value FROM ok GROUP BY reservoir, level_name, level_date""")
def i7(t):
    return r.pool_history(levels(t).where("parameter = 'Stor'"), ["reservoir", "level_name"]).select("reservoir", "level_name", "level_date", "value")


LOOK = """(SELECT s0 + (s1 - s0) / (e1 - e0) * (least(greatest({h}, lo), hi) - e0) FROM segments s, (SELECT min(e0) AS lo, max(e0) AS hi FROM segments x WHERE x.reservoir = {r}) b
 WHERE s.reservoir = {r} AND least(greatest({h}, lo), hi) >= e0 AND (least(greatest({h}, lo), hi) < e1 OR (least(greatest({h}, lo), hi) = hi AND e1 = hi)))"""
POOLS = f"""{LEVELS}, nm AS (SELECT *, CASE level_name WHEN 'Top of Conservation' THEN 'conservation' WHEN 'Top of Flood' THEN 'flood' WHEN 'Spillway Crest' THEN 'spillway' END AS pool FROM levels),
 pe AS (SELECT reservoir, pool, max_by(value, (level_date, value)) AS e, max(level_date) AS level_date FROM nm WHERE pool IS NOT NULL AND parameter = 'Elev' GROUP BY 1, 2), ps AS (SELECT reservoir, pool, max_by(value, (level_date, value)) AS s FROM nm WHERE pool IS NOT NULL AND parameter = 'Stor' GROUP BY 1, 2),
 pl AS (SELECT reservoir, pool, e + CASE WHEN pool = 'flood' AND reservoir = 'res2' THEN -1.5 ELSE 0 END AS elev_ft, level_date, s AS level_storage_af, 1 AS place FROM pe LEFT JOIN ps USING (reservoir, pool)
   UNION ALL SELECT 'res3', 'full', 4093.25, NULL, NULL, 0),
 seg2 AS (SELECT s.*, lo, hi FROM segments s JOIN (SELECT reservoir, min(e0) AS lo, max(e0) AS hi FROM segments GROUP BY 1) USING (reservoir)),
 pools AS (SELECT pl.*, s0 + (s1 - s0) / (e1 - e0) * (least(greatest(elev_ft, lo), hi) - e0) AS capacity_current_af FROM pl LEFT JOIN seg2 ON seg2.reservoir = pl.reservoir AND least(greatest(elev_ft, lo), hi) >= e0 AND (least(greatest(elev_ft, lo), hi) < e1 OR (least(greatest(elev_ft, lo), hi) = hi AND e1 = hi)))"""


def pool_rows(t):
    full = t.points.where("reservoir = 'res3'").select("reservoir").distinct().select("reservoir", F.lit(4093.25).alias("elev_ft"))
    shifts = fixed(t.spark, [("res2", "flood", -1.5)], "reservoir string, pool string, shift_ft double")
    return r.pools(levels(t), t.points, full, shifts)


@query("I8_pools", f"WITH {POOLS} SELECT reservoir, pool, elev_ft::DOUBLE AS elev_ft, strftime(level_date, '%Y-%m-%d') AS level_date, level_storage_af, CAST(place AS BIGINT) AS place, round(capacity_current_af, 4)::DOUBLE AS capacity_current_af FROM pools")
def i8(t):
    return pool_rows(t).withColumn("capacity_current_af", F.round("capacity_current_af", 4))


@query("I8_primary_and_flood", f"""
WITH {POOLS}, g AS (SELECT reservoir, max(CASE WHEN pool = 'full' THEN elev_ft END) AS fe, max(CASE WHEN pool = 'full' THEN capacity_current_af END) AS fc, max(CASE WHEN pool = 'conservation' THEN elev_ft END) AS ce, max(CASE WHEN pool = 'conservation' THEN capacity_current_af END) AS cc,
  max(CASE WHEN pool = 'spillway' THEN elev_ft END) AS se, max(CASE WHEN pool = 'spillway' THEN capacity_current_af END) AS sc, max(CASE WHEN pool = 'flood' THEN elev_ft END) AS le, max(CASE WHEN pool = 'flood' THEN capacity_current_af END) AS lc FROM pools GROUP BY 1),
 q AS (SELECT *, CASE reservoir WHEN 'res0' THEN 'dry_flood' WHEN 'res1' THEN 'flood_control' ELSE 'supply' END AS role FROM g),
 v AS (SELECT *, CASE WHEN role = 'dry_flood' THEN CASE WHEN le IS NOT NULL THEN 'flood' END WHEN fe IS NOT NULL THEN 'full' WHEN ce IS NOT NULL THEN 'conservation' WHEN se IS NOT NULL THEN 'spillway' END AS pp FROM q),
 u AS (SELECT *, CASE pp WHEN 'flood' THEN le WHEN 'full' THEN fe WHEN 'conservation' THEN ce WHEN 'spillway' THEN se END AS pe0, CASE pp WHEN 'flood' THEN lc WHEN 'full' THEN fc WHEN 'conservation' THEN cc WHEN 'spillway' THEN sc END AS pc FROM v)
SELECT reservoir, role, pp AS primary_pool, pe0::DOUBLE AS primary_elev_ft, round(pc, 4)::DOUBLE AS primary_af, CASE WHEN role IN ('dry_flood', 'flood_control') OR le > pe0 + 0.5 THEN round(lc, 4)::DOUBLE END AS flood_af FROM u""")
def i8p(t):
    p = pool_rows(t)
    res = F.col("reservoir")
    roles = p.select("reservoir").distinct().withColumn("role", F.when(res == "res0", "dry_flood").when(res == "res1", "flood_control").otherwise("supply"))
    d = r.primary_and_flood(p, roles)
    return d.withColumn("primary_af", F.round("primary_af", 4)).withColumn("flood_af", F.round("flood_af", 4))


@query("I9_table_validation", """
SELECT reservoir, count(*) AS n, round(median(abs(off)), 4) AS median_abs_af, round(quantile_cont(abs(off), 0.95), 4) AS p95_abs_af, round(median(abs(off) / greatest(stor, 1)) * 100, 4) AS median_rel_pct FROM pairs WHERE date >= DATE '2000-06-01' GROUP BY 1 HAVING count(*) >= 20""")
def i9(t):
    eff = t.pairs.select("reservoir").distinct().withColumn("effective_date", DAY("2000-06-01"))
    d = r.table_validation(t.pairs, eff)
    return d.select("reservoir", "n", *[F.round(c, 4).alias(c) for c in ("median_abs_af", "p95_abs_af", "median_rel_pct")])


TOL = """md AS (SELECT reservoir, y, median(off) AS m FROM pairs GROUP BY 1, 2), mad AS (SELECT reservoir, y, median(abs(off - m)) AS mad FROM pairs JOIN md USING (reservoir, y) GROUP BY 1, 2),
 nz AS (SELECT reservoir, median(mad) AS noise FROM mad GROUP BY 1), tol AS (SELECT reservoir, noise, greatest(5.0, 0.001 * 450000.0, {k} * noise) AS tolerance FROM nz)"""


@query("I10_era_tolerance", f"WITH {TOL.format(k='3.0')} SELECT reservoir, round(noise, 4) AS noise, round(tolerance, 4) AS tolerance FROM tol")
def i10(t):
    d = r.era_tolerance(t.pairs, t.pairs.select("reservoir").distinct().withColumn("pool_af", F.lit(450000.0)))
    return d.select("reservoir", F.round("noise", 4).alias("noise"), F.round("tolerance", 4).alias("tolerance"))


STEPPED = "pz AS (SELECT reservoir, date, stor, elev, y, off + CASE WHEN y >= 1998 THEN 9000 ELSE 0 END + CASE WHEN y = 2000 THEN 4000 ELSE 0 END AS off FROM pairs)"
ERASQL = f"""{STEPPED}, sp AS (SELECT reservoir, y, min(elev) AS lo, max(elev) AS hi, median(off) AS ao, count(*) AS days FROM pz GROUP BY 1, 2),
 s2 AS (SELECT *, lag(y) OVER w AS py, greatest(lo, lag(lo) OVER w) AS blo, least(hi, lag(hi) OVER w) AS bhi, lag(ao) OVER w AS pao FROM sp WINDOW w AS (PARTITION BY reservoir ORDER BY y)),
 sb AS (SELECT s2.reservoir, s2.y, median(CASE WHEN p.y = s2.y THEN off END) AS sb, median(CASE WHEN p.y = s2.py THEN off END) AS sa FROM s2 JOIN pz p ON p.reservoir = s2.reservoir AND p.y IN (s2.y, s2.py) AND p.elev BETWEEN blo AND bhi WHERE py IS NOT NULL GROUP BY 1, 2),
 s3 AS (SELECT s2.*, CASE WHEN abs(CASE WHEN bhi - blo >= 1 THEN sb - sa ELSE ao - pao END) > 2000 THEN 1 ELSE 0 END AS nw FROM s2 LEFT JOIN sb ON sb.reservoir = s2.reservoir AND sb.y = s2.y),
 s4 AS (SELECT *, sum(nw) OVER (PARTITION BY reservoir ORDER BY y) AS raw_era FROM s3), s5 AS (SELECT *, sum(days) OVER (PARTITION BY reservoir, raw_era) AS ed FROM s4),
 er AS (SELECT reservoir, y, days, CAST(raw_era AS BIGINT) AS raw_era, CAST(last_value(CASE WHEN ed >= 300 OR raw_era = 0 THEN raw_era END IGNORE NULLS) OVER (PARTITION BY reservoir ORDER BY y) AS BIGINT) AS era_id FROM s5)"""


def stepped(t):
    y = F.col("y")
    return t.pairs.withColumn("off", F.col("off") + F.when(y >= 1998, 9000).otherwise(0) + F.when(y == 2000, 4000).otherwise(0))


def era_years(t):
    tol = t.pairs.select("reservoir").distinct().withColumn("tolerance", F.lit(2000.0))
    return r.segment_eras(stepped(t), tol, 300)


def era_pairs(t):
    """Days with their era, written once: three operators read it."""
    if not hasattr(t, "_era_pairs"):
        ensure_checkpoint_dir(t.spark)
        t._era_pairs = stepped(t).join(era_years(t).select("reservoir", "y", "era_id"), ["reservoir", "y"]).checkpoint()
    return t._era_pairs


@query("I11_segment_eras", f"WITH {ERASQL} SELECT * FROM er")
def i11(t):
    return era_years(t)


DEPART = f"""{ERASQL}, ep AS (SELECT pz.*, era_id FROM pz JOIN er USING (reservoir, y)), qq AS (SELECT reservoir, era_id, quantile_cont(elev, 0.995) AS hi, quantile_cont(elev, 0.005) AS lo, median(off) AS ao FROM ep GROUP BY 1, 2),
 tg AS (SELECT qq.*, pool, h FROM qq, (VALUES ('full', 4120.0), ('conservation', 4060.0), ('dead', 3990.0)) v(pool, h)),
 dd AS (SELECT tg.*, elev, off, abs(elev - h) <= 2 AS l, CASE WHEN h > hi THEN elev >= hi - 20 WHEN h < lo THEN elev <= lo + 20 ELSE abs(elev - h) <= 10 END AS e FROM tg JOIN ep USING (reservoir, era_id)),
 dg AS (SELECT reservoir, era_id, pool, h, hi, lo, ao, count(*) FILTER (WHERE l) AS nl, median(off) FILTER (WHERE l) AS lm, count(*) FILTER (WHERE e) AS ne, stddev_samp(elev) FILTER (WHERE e) AS sd, regr_slope(off, elev) FILTER (WHERE e) AS sl, regr_intercept(off, elev) FILTER (WHERE e) AS ic, median(off) FILTER (WHERE e) AS em FROM dd GROUP BY 1,2,3,4,5,6,7),
 dep AS (SELECT reservoir, era_id, pool, h AS elev_ft, CASE WHEN nl >= 30 THEN lm WHEN ne >= 30 AND sd > 1 THEN sl * h + ic ELSE coalesce(em, ao) END AS departure_af, CASE WHEN nl >= 30 THEN 0 WHEN h > hi THEN h - hi WHEN h < lo THEN lo - h ELSE 0 END AS gap_ft,
  CASE WHEN nl >= 30 THEN 'local' WHEN ne >= 30 AND sd > 1 THEN 'line' ELSE 'median' END AS basis FROM dg)"""


def departures(t):
    pools = F.array(*[F.struct(F.lit(n).alias("pool"), F.lit(h).alias("elev_ft")) for n, h in (("full", 4120.0), ("conservation", 4060.0), ("dead", 3990.0))])
    targets = t.pairs.select("reservoir").distinct().select("reservoir", F.explode(pools).alias("p")).select("reservoir", "p.*")
    return r.departure_at(era_pairs(t), targets)


@query("I12_departure_at", f"WITH {DEPART} SELECT reservoir, era_id, pool, elev_ft::DOUBLE AS elev_ft, round(departure_af, 2) AS departure_af, round(gap_ft, 4) AS gap_ft, basis FROM dep")
def i12(t):
    return departures(t).withColumn("departure_af", F.round("departure_af", 2)).withColumn("gap_ft", F.round("gap_ft", 4))


ISO = """ys AS (SELECT reservoir, y, avg(stor) AS v, count(*)::DOUBLE AS w FROM pairs GROUP BY 1, 2), pf AS (SELECT *, row_number() OVER k AS i, sum(w) OVER k AS cw, sum(v * w) OVER k AS cv FROM ys WINDOW k AS (PARTITION BY reservoir ORDER BY y ROWS UNBOUNDED PRECEDING)),
 ab AS (SELECT a.reservoir, a.i AS ai, b.i AS bi, (b.cv - (a.cv - a.v * a.w)) / (b.cw - (a.cw - a.w)) AS m FROM pf a JOIN pf b ON a.reservoir = b.reservoir AND b.i >= a.i),
 mx AS (SELECT c.reservoir, c.i, ab.ai, max(m) AS mm FROM pf c JOIN ab ON ab.reservoir = c.reservoir AND ai <= c.i AND bi >= c.i GROUP BY 1, 2, 3), ft AS (SELECT reservoir, i, min(mm) AS fit FROM mx GROUP BY 1, 2)"""


@query("I13_isotonic_fit", f"WITH {ISO} SELECT pf.reservoir, y, round(v, 4) AS v, w, round(fit, 4) AS fit FROM pf JOIN ft USING (reservoir, i)")
def i13(t):
    y = t.pairs.groupBy("reservoir", "y").agg(F.avg("stor").alias("v"), F.count("*").cast("double").alias("w"))
    return r.isotonic(y, ["reservoir"], "y", "v", "w").withColumn("v", F.round("v", 4)).withColumn("fit", F.round("fit", 4))


@query("I14_confidence", """
SELECT p_partkey AS id, CASE WHEN p_size % 10 = 0 THEN 'current_table' WHEN gap <= 0 AND sh < 0.5 THEN 'high' WHEN gap <= 10 AND sh < 1 THEN 'high' WHEN gap <= 30 AND sh < 2 THEN 'medium' ELSE 'low' END AS confidence
FROM (SELECT p_partkey, p_size, (p_partkey % 45)::DOUBLE AS gap, coalesce(abs(CASE WHEN p_partkey % 9 > 0 THEN (p_size - 25) * 0.1 END), 0) AS sh FROM part)""")
def i14(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    shift = F.when(k % 9 > 0, (s - 25) * 0.1)
    return t.read("part").select(k.alias("id"), r.confidence(s % 10 == 0, (k % 45).cast("double"), shift).alias("confidence"))


@query("I14_era_capacities", f"""WITH {DEPART}, lt AS (SELECT *, max(date) OVER (PARTITION BY reservoir, era_id) AS last FROM ep), es AS (SELECT reservoir, era_id, abs(median(off)) < 900 AND abs(median(off) FILTER (WHERE date >= last - 365)) < 900 AS cur FROM lt GROUP BY 1, 2),
 rw AS (SELECT d.reservoir, d.pool, d.era_id, cur, round(CASE WHEN cur THEN 0 ELSE gap_ft END, 1) AS gap, 450000.0 + CASE WHEN cur THEN 0 ELSE departure_af END AS v FROM dep d JOIN es USING (reservoir, era_id)), ww AS (SELECT *, CASE WHEN cur THEN 1e6 ELSE 1 / (1 + gap) END AS w FROM rw),
 pf AS (SELECT *, row_number() OVER k AS i, sum(w) OVER k AS cw, sum(v * w) OVER k AS cv FROM ww WINDOW k AS (PARTITION BY reservoir, pool ORDER BY era_id ROWS UNBOUNDED PRECEDING)), ab AS (SELECT a.reservoir, a.pool, a.i AS ai, b.i AS bi, (b.cv - (a.cv - a.v * a.w)) / (b.cw - (a.cw - a.w)) AS m FROM pf a JOIN pf b ON a.reservoir = b.reservoir AND a.pool = b.pool AND b.i >= a.i),
 mx AS (SELECT c.reservoir, c.pool, c.i, ab.ai, max(m) AS mm FROM pf c JOIN ab ON ab.reservoir = c.reservoir AND ab.pool = c.pool AND ai <= c.i AND bi >= c.i GROUP BY 1, 2, 3, 4), ft AS (SELECT reservoir, pool, i, round(min(mm)) AS fit FROM mx GROUP BY 1, 2, 3),
 sh AS (SELECT pf.*, fit, round(CASE WHEN v <> 0 THEN 100 * (fit - v) / v END, 1) AS s FROM pf JOIN ft USING (reservoir, pool, i))
SELECT reservoir, pool, era_id, round(v)::DOUBLE AS raw_af, fit::DOUBLE AS fit_af, gap::DOUBLE AS gap_ft, s::DOUBLE + 0.0 AS shift_pct, CASE WHEN cur THEN 'current_table' WHEN gap <= 0 AND abs(s) < 0.5 THEN 'high' WHEN gap <= 10 AND abs(s) < 1 THEN 'high' WHEN gap <= 30 AND abs(s) < 2 THEN 'medium' ELSE 'low' END AS confidence FROM sh""")
def i14e(t):
    pool = t.pairs.select("reservoir").distinct().withColumn("pool_af", F.lit(450000.0))
    summary = r.era_summary(era_pairs(t), pool)
    pools = F.explode(F.array(F.lit("full"), F.lit("conservation"), F.lit("dead")))
    cap = t.pairs.select("reservoir").distinct().select("reservoir", pools.alias("pool"), F.lit(450000.0).alias("capacity_current_af"))
    return r.era_capacities(departures(t), summary, cap)


FLOOD = """fd AS (SELECT *, CASE role WHEN 'dry_flood' THEN stor > greatest(5.0, 0.0005 * flood_af) WHEN 'flood_control' THEN stor > cons_af + greatest(0.02 * (flood_af - cons_af), 0.05 * cons_af) ELSE false END AS flood_day FROM fills)"""


@query("I15_flood_days", f"WITH {FLOOD} SELECT reservoir, role, count(*) AS n, count(*) FILTER (WHERE flood_day) AS flood_days FROM fd GROUP BY 1, 2")
def i15(t):
    return r.flood_days(t.fills).groupBy("reservoir", "role").agg(F.count("*").alias("n"), F.count_if("flood_day").alias("flood_days"))


def annual_sql(year):
    return f"""{FLOOD}, yy AS (SELECT *, {year} AS year FROM fd), mc AS (SELECT reservoir, year, confidence FROM (SELECT reservoir, year, confidence, row_number() OVER (PARTITION BY reservoir, year ORDER BY count(*) DESC, confidence) AS rn FROM yy GROUP BY 1, 2, 3) WHERE rn = 1),
 an AS (SELECT reservoir, year, count(*) AS n_days, median(primary_af) AS fp, max(stor) AS peak_af, avg(stor) AS mean_af, min(stor) AS low_af, min_by(date, (-stor, date)) AS peak_date, count(*) FILTER (WHERE flood_day) AS days_flood_storage FROM yy GROUP BY 1, 2)"""


@query("I16_annual_table", f"""WITH {annual_sql("year(date)")}, fl AS (SELECT f.reservoir, year(f.date) AS year, CASE WHEN count(*) >= 230 THEN round(sum(cfs) * 1.983471) END AS flow_af, round(max(cfs)) AS peak_flow_cfs, count(*) AS n_days_flow FROM (SELECT 'res' || substr(gauge, 2) AS reservoir, date, cfs FROM chosen) f
   JOIN (SELECT reservoir, min(date) AS s FROM fills GROUP BY 1) USING (reservoir) WHERE f.date >= s GROUP BY 1, 2)
SELECT reservoir, year, n_days, confidence AS capacity_confidence, round(fp)::DOUBLE AS full_pool_af, round(peak_af) AS peak_af, round(mean_af) AS mean_af, round(low_af) AS low_af, strftime(peak_date, '%Y-%m-%d') AS peak_date, days_flood_storage, round(100 * peak_af / fp, 1) AS peak_pct,
 round(100 * mean_af / fp, 1) AS mean_pct, round(100 * low_af / fp, 1) AS low_pct, flow_af, peak_flow_cfs, n_days_flow FROM an JOIN mc USING (reservoir, year) LEFT JOIN fl USING (reservoir, year)""")
def i16(t):
    flows = t.chosen.select(F.concat(F.lit("res"), F.substring("gauge", 2, 9)).alias("reservoir"), "date", "cfs")
    return r.annual_table(r.flood_days(t.fills), flows, flow_min_days=230)


@query("I16_annual_water_year", f"""WITH {annual_sql("year(date) + (month(date) >= 10)::INT")} SELECT reservoir, year, n_days, confidence AS capacity_confidence, round(fp)::DOUBLE AS full_pool_af, round(peak_af) AS peak_af, round(mean_af) AS mean_af, round(low_af) AS low_af,
 strftime(peak_date, '%Y-%m-%d') AS peak_date, days_flood_storage, round(100 * peak_af / fp, 1) AS peak_pct, round(100 * mean_af / fp, 1) AS mean_pct, round(100 * low_af / fp, 1) AS low_pct FROM an JOIN mc USING (reservoir, year)""")
def i16w(t):
    return r.annual_table(r.flood_days(t.fills), by_water_year=True)


NORMAL = """ok AS (SELECT reservoir, date, year(date) AS y, dayofyear(make_date(2000, month(date)::INT, day(date)::INT)) AS doy, stor FROM fills WHERE confidence IN ('high', 'medium') AND year(date) BETWEEN 1996 AND 2000),
 en AS (SELECT reservoir FROM ok GROUP BY 1 HAVING count(DISTINCT y) >= 4), x AS (SELECT reservoir, y, (doy - 1 + k + 366) % 366 + 1 AS day, stor FROM ok, range(-3, 4) r(k) WHERE reservoir IN (SELECT reservoir FROM en)),
 nd AS (SELECT reservoir, day, count(DISTINCT y) AS years, quantile_cont(stor, 0.10) AS p10, quantile_cont(stor, 0.25) AS p25, quantile_cont(stor, 0.5) AS p50, quantile_cont(stor, 0.75) AS p75, quantile_cont(stor, 0.90) AS p90 FROM x GROUP BY 1, 2 HAVING count(DISTINCT y) >= 4)"""


def normal(t):
    return r.normal_for_date(t.fills.where(F.col("confidence").isin("high", "medium")), "stor", (1996, 2000), 4)


@query("I17_normal_for_date", f"WITH {NORMAL} SELECT reservoir, day, years, round(p10, 6) AS p10, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(p90, 6) AS p90 FROM nd")
def i17(t):
    return normal(t).select("reservoir", "day", "years", *[f"p{p}" for p in (10, 25, 50, 75, 90)])


@query("I25_storage_normal", f"""WITH {NORMAL}, l AS (SELECT reservoir, max(date) AS date, max_by(stor, date) AS stor FROM fills GROUP BY 1), j AS (SELECT l.*, p50, p10, p90, years, nd.day FROM l LEFT JOIN nd ON nd.reservoir = l.reservoir AND nd.day = dayofyear(make_date(2000, month(l.date)::INT, day(l.date)::INT))),
 c AS (SELECT j.reservoir, 100.0 * (count(*) FILTER (WHERE x.stor < j.stor) + 0.5 * count(*) FILTER (WHERE x.stor = j.stor)) / count(*) AS pct FROM j JOIN x ON x.reservoir = j.reservoir AND x.day = j.day GROUP BY 1),
 k AS (SELECT *, CASE WHEN pct IS NULL THEN NULL WHEN pct < 10 THEN 'much below normal' WHEN pct < 25 THEN 'below normal' WHEN pct < 76 THEN 'normal' WHEN pct < 91 THEN 'above normal' ELSE 'much above normal' END AS c0 FROM j LEFT JOIN c USING (reservoir))
SELECT reservoir, strftime(date, '%Y-%m-%d') AS date, round(stor, 4) AS stor, round(p50, 4) AS p50, round(pct, 4) AS pct, coalesce(c0 <> 'normal' AND abs(stor - p50) < 60000, false) AS floored, CASE WHEN c0 <> 'normal' AND abs(stor - p50) < 60000 THEN 'normal' ELSE c0 END AS cls FROM k""")
def i25(t):
    latest = t.fills.groupBy("reservoir").agg(F.max("date").alias("date"), F.max_by("stor", "date").alias("stor"))
    d = r.storage_normal(latest, normal(t), "stor", F.lit(60000.0))
    return d.select("reservoir", "date", F.round("stor", 4).alias("stor"), F.round("p50", 4).alias("p50"), F.round("pct", 4).alias("pct"), "floored", "cls")


@query("I18_status", f"""WITH {FLOOD}, l AS (SELECT reservoir, role, max(date) AS date FROM fd GROUP BY 1, 2), a AS (SELECT l.*, max_by(stor, fd.date) AS stor, max_by(primary_af, fd.date) AS primary_af, max_by(confidence, fd.date) AS confidence, max_by(stor, fd.date) FILTER (WHERE fd.date <= l.date - 30) AS stor_30,
  max_by(stor, fd.date) FILTER (WHERE fd.date <= l.date - 365) AS stor_365, count(*) FILTER (WHERE flood_day AND year(fd.date) = 2001) AS flood_days_this_year FROM l JOIN fd ON fd.reservoir = l.reservoir GROUP BY l.reservoir, l.role, l.date)
SELECT reservoir, role, strftime(date, '%Y-%m-%d') AS date, round(stor, 4) AS stor, primary_af::DOUBLE AS primary_af, confidence, round(stor_30, 4) AS stor_30, round(stor_365, 4) AS stor_365, flood_days_this_year, CASE WHEN role = 'dry_flood' THEN 'flood_pool' WHEN confidence IN ('high', 'medium') THEN 'percent' ELSE 'acre_feet' END AS measure,
 round(CASE WHEN confidence IN ('high', 'medium') THEN 100 * stor / primary_af END, 4) AS pct, DATE '2001-08-14' - date > 14 AS stale FROM a""")
def i18(t):
    d = r.status(r.flood_days(t.fills), DAY("2001-08-14"))
    return d.select("reservoir", "role", "date", "primary_af", "confidence", "flood_days_this_year", "measure", "stale", *[F.round(c, 4).alias(c) for c in ("stor", "stor_30", "stor_365", "pct")])


@query("I19_survey_tables", """
WITH s AS (SELECT 'res' || (s_suppkey % 6) AS reservoir, 'a' || s_suppkey AS uid FROM supplier), l AS (SELECT 'a' || (c_custkey % 100) AS a, 'b' || (c_nationkey + c_custkey % 7) AS b FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT 'b' || (c_nationkey), 'a' || (c_custkey % 100) FROM customer WHERE c_custkey % 40 = 1),
 e AS (SELECT reservoir, b AS u FROM l JOIN s ON s.uid = l.a UNION SELECT reservoir, a FROM l JOIN s ON s.uid = l.b UNION SELECT reservoir, uid FROM s)
SELECT reservoir, 'b' || (p_partkey % 40) AS site_uid, p_partkey AS elevation FROM part JOIN e ON e.u = 'b' || (p_partkey % 40)""")
def i19(t):
    s = t.read("supplier").select(F.concat(F.lit("res"), F.col("s_suppkey") % 6).alias("reservoir"), F.concat(F.lit("a"), "s_suppkey").alias("site_uid"))
    c, k = t.read("customer"), F.col("c_custkey")
    a, bb = F.concat(F.lit("a"), k % 100), F.concat(F.lit("b"), F.col("c_nationkey") + k % 7)
    links = c.where(k % 4 == 0).select(a.alias("site_uid_a"), bb.alias("site_uid_b")).union(c.where(k % 40 == 1).select(F.concat(F.lit("b"), "c_nationkey").alias("site_uid_a"), a.alias("site_uid_b")))
    acap = t.read("part").select(F.concat(F.lit("b"), F.col("p_partkey") % 40).alias("site_uid"), F.col("p_partkey").alias("elevation"))
    return r.survey_tables(s, links, acap).select("reservoir", "site_uid", "elevation")


@query("I20_table_adoptions", """
WITH d AS (SELECT reservoir, date, stor, elev, stor - lag(stor) OVER w AS dv, elev - lag(elev) OVER w AS dh, year(date) AS y, floor(elev / 10) AS band FROM reservoir_days WINDOW w AS (PARTITION BY reservoir ORDER BY date)),
 s AS (SELECT reservoir, y, band, median(dv / dh) AS sl FROM d WHERE abs(dh) > 0.02 GROUP BY 1, 2, 3), u AS (SELECT d.reservoir, date, stor, dv - sl * dh AS un FROM d JOIN s ON s.reservoir = d.reservoir AND s.y = d.y AND s.band = d.band)
SELECT reservoir, strftime(date, '%Y-%m-%d') AS date, round(stor, 4) AS stor, round(un, 2) AS unexplained FROM u WHERE abs(un) > 0.008 * stor AND abs(un) > 3000""")
def i20(t):
    d = r.table_adoptions(t.reservoir_days)
    return d.withColumn("stor", F.round("stor", 4)).withColumn("unexplained", F.round("unexplained", 2))


@query("I21_bounded_eras", f"""WITH {ERAS}, p AS (SELECT pairs.*, (SELECT count(*) FROM eras e WHERE e.reservoir = pairs.reservoir AND e.start <= pairs.date) - 1 AS era_id FROM pairs)
SELECT reservoir, era_id, count(*) AS n, round(median(off), 2) AS median_off FROM p WHERE era_id >= 0 GROUP BY 1, 2""")
def i21(t):
    d = r.bounded_eras(t.pairs, eras(t).select("reservoir", "start"))
    return d.groupBy("reservoir", "era_id").agg(F.count("*").alias("n"), F.round(F.median("off"), 2).alias("median_off"))


@query("I22_highlights", f"""WITH a AS (SELECT reservoir, year(date) AS year, max(stor) AS peak_af, avg(stor) AS mean_af FROM fills GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY reservoir ORDER BY peak_af DESC, year) AS high_place, row_number() OVER (PARTITION BY reservoir ORDER BY peak_af, year) AS low_place FROM a),
 m AS (SELECT reservoir, avg(mean_af) AS m FROM a GROUP BY 1) SELECT reservoir, year, round(peak_af) AS peak_af, high_place, low_place, round(m, 2) AS first_ten_af, round(m, 2) AS last_ten_af FROM k JOIN m USING (reservoir) WHERE high_place <= 2 OR low_place <= 2""")
def i22(t):
    a = t.fills.groupBy("reservoir", F.year("date").alias("year")).agg(F.max("stor").alias("peak_af"), F.avg("stor").alias("mean_af"))
    d = r.highlights(a, 2)
    return d.withColumn("peak_af", F.round("peak_af")).withColumn("first_ten_af", F.round("first_ten_af", 2)).withColumn("last_ten_af", F.round("last_ten_af", 2))


@query("I22_overlap_difference", """
WITH d AS (SELECT 'r' || (l_suppkey // 10) AS reservoir, 's' || l_suppkey AS site_uid, l_suppkey % 10 AS place, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3, 4)
SELECT b.reservoir, b.site_uid, count(*) AS days, round(median(abs(b.value - a.value)), 6) AS median_abs FROM d b JOIN d a ON a.reservoir = b.reservoir AND a.date = b.date AND a.place = 0 WHERE b.place > 0 GROUP BY 1, 2""")
def i22o(t):
    k = F.col("l_suppkey")
    d = t.read("lineitem").groupBy(F.concat(F.lit("r"), F.floor(k / 10)).alias("reservoir"), F.concat(F.lit("s"), k).alias("site_uid"), (k % 10).alias("place"), F.to_date("l_shipdate").alias("date")).agg(F.avg("l_quantity").alias("value"))
    return r.overlap_difference(d)


GROUPS = """mem AS (SELECT DISTINCT 'grp' || (substr(reservoir, 4)::INT % 2) AS grp, reservoir FROM fills), gs0 AS (SELECT grp, min(date) AS a, max(date) AS z FROM fills JOIN mem USING (reservoir) GROUP BY 1),
 cal AS (SELECT mem.grp, mem.reservoir, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM mem JOIN gs0 ON gs0.grp = mem.grp),
 ff AS (SELECT c.grp, c.reservoir, c.date, last_value(f.stor IGNORE NULLS) OVER w AS s, last_value(f.primary_af IGNORE NULLS) OVER w AS c, last_value(f.confidence IN ('high', 'medium') IGNORE NULLS) OVER w AS ok FROM cal c LEFT JOIN fills f ON f.reservoir = c.reservoir AND f.date = c.date
   WINDOW w AS (PARTITION BY c.grp, c.reservoir ORDER BY c.date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)),
 gsr AS (SELECT grp, date, sum(s) AS storage_af, sum(c) FILTER (WHERE s IS NOT NULL) AS capacity_af, count(s) AS members, count(s) = (SELECT count(*) FROM mem WHERE mem.grp = ff.grp) AS complete, coalesce(bool_and(coalesce(ok, false)) FILTER (WHERE s IS NOT NULL), false) AS trusted FROM ff GROUP BY 1, 2),
 lc AS (SELECT grp, max(date) AS as_of FROM gsr WHERE complete AND storage_af IS NOT NULL GROUP BY 1)"""


def members(t):
    return t.fills.select(F.concat(F.lit("grp"), F.substring("reservoir", 4, 9).cast("int") % 2).alias("group"), "reservoir").distinct()


def series(t):
    return r.group_series(t.fills, members(t))


@query("I23_group_series", f'WITH {GROUPS} SELECT grp AS "group", strftime(date, \'%Y-%m-%d\') AS date, round(storage_af, 4) AS storage_af, capacity_af::DOUBLE AS capacity_af, members, complete, trusted FROM gsr')
def i23(t):
    return series(t).withColumn("storage_af", F.round("storage_af", 4))


@query("I24_window_change", f"""WITH {GROUPS}, n AS (SELECT g.grp, as_of, storage_af AS s, capacity_af AS c FROM gsr g JOIN lc ON lc.grp = g.grp AND as_of = date), k AS (SELECT n.*, v.d AS days FROM n, (VALUES (7), (30), (90), (180), (365)) v(d))
SELECT k.grp AS "group", CAST(days AS BIGINT) AS days, strftime(g.date, '%Y-%m-%d') AS "from", round(g.storage_af, 4) AS then_af, round(s, 4) AS now_af, round(s - g.storage_af, 4) AS change_af, round(100 * s / c - 100 * g.storage_af / g.capacity_af, 4) AS change_points FROM k JOIN gsr g ON g.grp = k.grp AND g.date = as_of - CAST(days AS INTEGER) AND complete""")
def i24(t):
    s = series(t)
    d = r.window_change(s, r.latest_complete(s))
    return d.select("group", "days", "from", *[F.round(c, 4).alias(c) for c in ("then_af", "now_af", "change_af", "change_points")])


@query("I24_member_shares", f"""WITH {GROUPS}, v AS (SELECT m.grp, f.reservoir, max_by(stor, date) AS s FROM fills f JOIN mem m ON m.reservoir = f.reservoir JOIN lc ON lc.grp = m.grp WHERE date <= as_of GROUP BY 1, 2)
SELECT grp AS "group", reservoir, round(s, 4) AS stor, round(s / sum(s) OVER (PARTITION BY grp), 6) AS share FROM v""")
def i24s(t):
    s = series(t)
    return r.member_shares(t.fills, members(t), r.latest_complete(s)).withColumn("stor", F.round("stor", 4))


@query("I24_stale_members", """SELECT 'grp' || (substr(reservoir, 4)::INT % 2) AS "group", reservoir, strftime(max(date), '%Y-%m-%d') AS last_date FROM fills WHERE NOT (reservoir = 'res4' AND year(date) = 2001) GROUP BY 1, 2 HAVING DATE '2001-08-01' - max(date) > 14""")
def i24m(t):
    d = t.fills.where("NOT (reservoir = 'res4' AND year(date) = 2001)")
    m = members(t)
    return r.stale_members(d, m, m.select("group").distinct().withColumn("as_of", DAY("2001-08-01")))


@query("I26_weekly_history", f"""WITH {GROUPS} SELECT grp AS "group", strftime(date_trunc('week', date), '%Y-%m-%d') AS week_start, strftime(max(date), '%Y-%m-%d') AS date, round(max_by(storage_af, date), 4) AS storage_af FROM gsr WHERE complete GROUP BY 1, 2""")
def i26(t):
    return r.weekly_history(series(t)).withColumn("storage_af", F.round("storage_af", 4))


# gauges on every third reach of the network, reservoirs at some others; evaporation is a share of the storage
REACHES = """gl AS (SELECT gauge, comid FROM (SELECT gauge, 3 * CAST(substr(gauge, 2) AS BIGINT) + 2 AS comid FROM gauges) JOIN flowlines USING (comid)), rl AS (SELECT DISTINCT reservoir, 4 * CAST(substr(reservoir, 4) AS BIGINT) + 5 AS comid FROM fills),
 wk(src, what, cur) AS (SELECT gauge, 'g', comid // 2 FROM gl UNION ALL SELECT reservoir, 'r', comid FROM rl UNION ALL SELECT src, what, cur // 2 FROM wk WHERE cur > 0 AND cur NOT IN (SELECT comid FROM gl)),
 be AS (SELECT src, what, gauge AS reach FROM wk JOIN gl ON comid = cur),
 tm AS (SELECT reach, src AS term, 'inflow' AS role, 'flow' AS kind, src AS gauge, NULL AS reservoir FROM be WHERE what = 'g' UNION ALL SELECT DISTINCT reach, reach, 'outflow', 'flow', reach, NULL FROM be
  UNION ALL SELECT reach, src || '/storage', 'storage', 'storage', NULL, src FROM be WHERE what = 'r' UNION ALL SELECT reach, src || '/evaporation', 'evaporation', 'volume', NULL, src FROM be WHERE what = 'r')"""


def network_terms(t):
    gauges = t.gauges.select("gauge", (3 * F.substring("gauge", 2, 12).cast("bigint") + 2).alias("comid")).distinct()
    lakes = t.fills.select("reservoir", (4 * F.substring("reservoir", 4, 12).cast("bigint") + 5).alias("comid")).distinct()
    return b.network_terms(t.flowlines, gauges, lakes)


@query("I27_reach_terms", f"WITH RECURSIVE {REACHES} SELECT * FROM tm")
def i27t(t):
    return network_terms(t)


@query("I27_water_balance", f"""
WITH RECURSIVE {REACHES}, s AS (SELECT reach, term, tm.role, kind, date, cfs AS v FROM chosen JOIN tm USING (gauge) UNION ALL SELECT reach, term, tm.role, kind, date, CASE kind WHEN 'volume' THEN stor / 5000 ELSE stor END FROM fills JOIN tm USING (reservoir)),
 pr AS (SELECT DISTINCT reach, CAST(date_trunc('month', date) AS DATE) AS a, last_day(date) AS z FROM s),
 fl AS (SELECT reach, term, CAST(date_trunc('month', date) AS DATE) AS a, avg(v) AS m, count(*) AS n FROM s WHERE kind <> 'storage' GROUP BY 1, 2, 3), hd AS (SELECT reach, term, last_day(date) AS z, max_by(v, date) AS v FROM s WHERE kind = 'storage' AND last_day(date) - date <= 3 GROUP BY 1, 2, 3),
 g AS (SELECT pr.reach, pr.a, pr.z, tm.term, tm.role, tm.kind, n / (pr.z - pr.a + 1)::DOUBLE AS cov, CASE WHEN kind = 'storage' THEN c.v - o.v WHEN n / (pr.z - pr.a + 1)::DOUBLE >= 0.5 THEN m * (pr.z - pr.a + 1) * CASE WHEN kind = 'flow' THEN 1.983471 ELSE 1 END END AS x
  FROM pr JOIN tm ON tm.reach = pr.reach LEFT JOIN fl ON fl.reach = pr.reach AND fl.term = tm.term AND fl.a = pr.a LEFT JOIN hd c ON c.reach = pr.reach AND c.term = tm.term AND c.z = pr.z LEFT JOIN hd o ON o.reach = pr.reach AND o.term = tm.term AND o.z = pr.a - 1),
 q AS (SELECT reach, a, z, count(*) FILTER (WHERE x IS NULL) = 0 AS complete, min(coalesce(cov, 0)) FILTER (WHERE kind <> 'storage') AS min_coverage, coalesce(sum(x) FILTER (WHERE role = 'inflow'), 0) AS i, coalesce(sum(x) FILTER (WHERE role = 'outflow'), 0) AS o, coalesce(sum(x) FILTER (WHERE role = 'storage'), 0) AS ds,
  coalesce(sum(x) FILTER (WHERE role = 'evaporation'), 0) AS ev FROM g GROUP BY 1, 2, 3)
SELECT reach, strftime(a, '%Y-%m-%d') AS start, strftime(z, '%Y-%m-%d') AS "end", z - a + 1 AS days, complete, round(min_coverage, 6) AS min_coverage, CASE WHEN complete THEN round(i, 2) END AS inflow_af, CASE WHEN complete THEN round(o, 2) END AS outflow_af, CASE WHEN complete THEN round(ds, 2) END AS storage_change_af,
 CASE WHEN complete THEN round(ev, 2) END AS evaporation_af, CASE WHEN complete THEN round(o + ds + ev, 2) END AS implied_inflow_af, CASE WHEN complete THEN round(i - o - ds - ev, 2) END AS unaccounted_af, CASE WHEN complete AND i > 0 THEN round(100 * (i - o - ds - ev) / i, 2) END AS unaccounted_pct FROM q""")
def i27(t):
    terms = network_terms(t)
    flow = t.chosen.join(terms, "gauge").select("reach", "term", "role", "kind", "date", F.col("cfs").alias("value"))
    lake = t.fills.select("reservoir", "date", "stor").join(terms, "reservoir").select("reach", "term", "role", "kind", "date", F.when(F.col("kind") == "volume", F.col("stor") / 5000).otherwise(F.col("stor")).alias("value"))
    out = b.balance(flow.unionByName(lake), terms, "month", 0.5)
    return out.select(*[F.round(c, 2).alias(c) if c.endswith(("_af", "_pct")) else F.col(c) for c in out.columns])


@query("I28_read_terms", """
SELECT 'reach' AS reach, term, role, kind, strftime(date, '%Y-%m-%d') AS date, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY term, date ORDER BY CASE source WHEN 'usgs' THEN 0 WHEN 'usbr_hydrodata' THEN 1 ELSE 5 END, site_uid) AS rn FROM (
 SELECT CASE l_suppkey % 3 WHEN 0 THEN 'up' WHEN 1 THEN 'down' ELSE 'lake' END AS term, CASE l_suppkey % 3 WHEN 0 THEN 'inflow' WHEN 1 THEN 'outflow' ELSE 'storage' END AS role, CASE l_suppkey % 3 WHEN 2 THEN 'storage' ELSE 'flow' END AS kind, source, site_uid, CAST(datetime_utc AS DATE) AS date, avg(value) AS value
 FROM (SELECT *, CAST(split_part(site_uid, ':', 2) AS BIGINT) AS l_suppkey FROM obs) GROUP BY ALL)) WHERE rn = 1""")
def i28(t):
    k = F.col("s_suppkey") % 3
    copies = t.read("supplier").select(
        F.lit("reach").alias("reach"), F.when(k == 0, "up").when(k == 1, "down").otherwise("lake").alias("term"), F.when(k == 0, "inflow").when(k == 1, "outflow").otherwise("storage").alias("role"),
        F.when(k == 2, "storage").otherwise("flow").alias("kind"), F.when(k == 2, "reservoir_storage").otherwise("discharge").alias("variable"), F.explode(F.array(F.lit("usgs"), F.lit("usbr_hydrodata"), F.lit("codwr"))).alias("p"), "s_suppkey")
    copies = copies.withColumn("site_uid", F.concat_ws(":", "p", "s_suppkey")).drop("p", "s_suppkey")
    n = F.split_part("site_uid", F.lit(":"), F.lit(2)).cast("bigint")
    obs = t.obs.withColumn("variable", F.when(n % 3 == 2, "reservoir_storage").otherwise("discharge"))
    return b.read_terms(obs, copies)
