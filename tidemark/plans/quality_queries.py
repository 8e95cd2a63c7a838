"""Canonicalisation and quality queries."""

from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.plans.registry import query


def now():
    return F.lit("2001-06-30 00:00:00").cast("timestamp")


@query("B1_crosswalk_apply", """
SELECT r.source, r.site_uid, CAST(r.datetime_utc AS VARCHAR) AS datetime_utc, x.variable, g.unit, round(r.value * x.factor + x."offset", 6) AS value,
  coalesce(r.statistic, x.statistic) AS statistic, coalesce(r.interval, x.interval) AS interval, coalesce(r.depth_cm, x.depth_cm)::DOUBLE AS depth_cm, r.ingest_run_id
FROM raw_obs r JOIN crosswalk x ON x.source = r.source AND x.source_param = r.source_param LEFT JOIN registry g ON g.variable = x.variable WHERE x.variable <> ''""")
def b1(t):
    return q.apply_crosswalk(t.raw_obs, t.crosswalk, t.registry).select(
        "source", "site_uid", "datetime_utc", "variable", "unit", "value", "statistic", "interval", "depth_cm", "ingest_run_id")


@query("B2_site_override", """
SELECT m.source, m.variable, g.unit, m.qualifier, count(*) AS n, round(sum(m.value), 4) AS total FROM mapped m LEFT JOIN registry g ON g.variable = m.variable
GROUP BY ALL""")
def b2(t):
    return t.mapped.groupBy("source", "variable", "unit", "qualifier").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("B3_missing_codes", """
SELECT m.source, m.variable, count(*) AS n_left, round(min(m.value), 6) AS lowest FROM mapped m LEFT JOIN registry g ON g.variable = m.variable
WHERE m.value IS NULL OR g.signed OR g.variable IS NULL OR len(list_filter(list_concat([-9999.0, -99999.0], g.missing_codes), lambda c : abs(m.value - c) < 1e-6)) = 0
GROUP BY ALL""")
def b3(t):
    return q.drop_missing_codes(t.mapped, t.registry).groupBy("source", "variable").agg(
        F.count("*").alias("n_left"), F.min("value").alias("lowest"))


@query("B4_date_guard", """
SELECT source, count(*) AS n, count(*) FILTER (WHERE NOT (year(datetime_utc) >= 1996 AND datetime_utc <= TIMESTAMP '2001-06-30' + INTERVAL 2 DAY)) AS dropped
FROM obs GROUP BY 1""")
def b4(t):
    bad = ~q.plausible_date("datetime_utc", now(), min_year=1996)
    return t.obs.groupBy("source").agg(F.count("*").alias("n"), F.count_if(bad).alias("dropped"))


@query("B5_null_guard", """
SELECT source, count(*) AS n FROM raw_obs WHERE value IS NOT NULL AND datetime_utc IS NOT NULL AND site_uid IS NOT NULL GROUP BY 1""")
def b5(t):
    return q.guard_nulls(t.raw_obs.withColumn("variable", F.col("source_param"))).groupBy("source").agg(F.count("*").alias("n"))


FLAG = """CASE WHEN g.valid_min IS NOT NULL AND m.value < g.valid_min THEN CASE WHEN g.noise_floor IS NOT NULL AND m.value >= g.noise_floor THEN 'near_zero' ELSE 'implausible' END
 WHEN g.valid_max IS NOT NULL AND m.value > g.valid_max THEN 'implausible' ELSE 'ok' END"""


@query("B6_qc_flag", f"""
SELECT m.site_uid, m.variable, CAST(m.datetime_utc AS VARCHAR) AS datetime_utc, round(m.value, 6) AS value, {FLAG} AS qc_flag
FROM mapped m LEFT JOIN registry g ON g.variable = m.variable""")
def b6(t):
    return q.qc_flag(t.mapped, t.registry).select("site_uid", "variable", "datetime_utc", "value", "qc_flag")


@query("B7_clean_view", f"""
SELECT m.variable, count(*) AS n, round(avg(m.value), 4) AS mean FROM mapped m LEFT JOIN registry g ON g.variable = m.variable WHERE {FLAG} <> 'implausible' GROUP BY 1""")
def b7(t):
    return q.clean(t.mapped, t.registry).groupBy("variable").agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@query("B8_range_stats", """
SELECT m.variable, g.unit, g.valid_min::DOUBLE AS valid_min, g.noise_floor::DOUBLE AS noise_floor, g.valid_max::DOUBLE AS valid_max, count(*) AS n, round(min(m.value), 6) AS lo, round(max(m.value), 6) AS hi,
  count(*) FILTER (WHERE g.valid_min IS NOT NULL AND m.value < g.valid_min AND NOT (g.noise_floor IS NOT NULL AND m.value >= g.noise_floor)) AS below,
  count(*) FILTER (WHERE g.valid_min IS NOT NULL AND m.value < g.valid_min AND g.noise_floor IS NOT NULL AND m.value >= g.noise_floor) AS near_zero,
  count(*) FILTER (WHERE g.valid_max IS NOT NULL AND m.value > g.valid_max) AS above, count(*) FILTER (WHERE m.value < 0) AS negative
FROM mapped m LEFT JOIN registry g ON g.variable = m.variable WHERE m.value IS NOT NULL GROUP BY ALL""")
def b8(t):
    return q.range_stats(t.mapped, t.registry)


@query("B9_registry_check", """
WITH reg AS (SELECT 'v' || p_partkey AS variable, CASE WHEN p_size = 7 THEN 'furlong' ELSE 'cfs' END AS unit, CASE WHEN p_size % 3 > 0 THEN p_size * 1.0 END AS valid_min,
   CASE WHEN p_size % 4 = 0 THEN p_size * 1.0 + (p_partkey % 3) - 1 END AS noise_floor, 30.0 AS valid_max FROM part),
 xw AS (SELECT DISTINCT 'src' || (l_suppkey % 7) AS source, 'P' || l_linenumber AS source_param, 'v' || (l_partkey + 10) AS variable FROM lineitem)
SELECT variable AS subject, 'unit not declared' AS problem FROM reg WHERE unit <> 'cfs'
UNION ALL SELECT variable, 'noise floor needs a lower bound' FROM reg WHERE noise_floor IS NOT NULL AND valid_min IS NULL
UNION ALL SELECT variable, 'noise floor above the lower bound' FROM reg WHERE noise_floor > valid_min
UNION ALL SELECT variable, 'lower bound above upper bound' FROM reg WHERE valid_min > valid_max
UNION ALL SELECT source || '/' || source_param, 'maps to an unknown variable' FROM xw WHERE variable NOT IN (SELECT variable FROM reg)""")
def b9(t):
    size, key = F.col("p_size"), F.col("p_partkey")
    reg = t.read("part").select(
        F.concat(F.lit("v"), key).alias("variable"), F.when(size == 7, "furlong").otherwise("cfs").alias("unit"),
        F.when(size % 3 > 0, size * 1.0).alias("valid_min"), F.when(size % 4 == 0, size * 1.0 + (key % 3) - 1).alias("noise_floor"),
        F.lit(30.0).alias("valid_max"))
    xw = t.read("lineitem").select(F.concat(F.lit("src"), F.col("l_suppkey") % 7).alias("source"), F.concat(F.lit("P"), "l_linenumber").alias("source_param"),
                                   F.concat(F.lit("v"), F.col("l_partkey") + 10).alias("variable")).distinct()
    return q.registry_problems(reg, xw, ["cfs"])


@query("B10_coordinate_repair", """
SELECT site_uid, CASE WHEN NOT (coalesce(lat = 0 AND lon = 0, false)) THEN lat END AS lat,
 CASE WHEN lat = 0 AND lon = 0 THEN NULL WHEN lon > 0 AND lat BETWEEN 24 AND 50 AND -lon BETWEEN -125 AND -66 THEN -lon ELSE lon END AS lon,
 CASE WHEN lat = 0 AND lon = 0 THEN 'zero_zero' WHEN lon > 0 AND lat BETWEEN 24 AND 50 AND -lon BETWEEN -125 AND -66 THEN 'sign_flipped' END AS coordinate_fix,
 CASE WHEN lat = 0 AND lon = 0 THEN 'latitude and longitude were both 0; location treated as missing' WHEN lon > 0 AND lat BETWEEN 24 AND 50 AND -lon BETWEEN -125 AND -66 THEN 'longitude was positive; sign flipped' END AS note
FROM (SELECT site_uid, round(lat, 6) AS lat, round(lon, 6) AS lon FROM sites)""")
def b10(t):
    s = t.sites.withColumn("raw_metadata", F.to_json(F.struct(F.col("name").alias("station"))))
    return q.repair_coordinates(s).select("site_uid", "lat", "lon", "coordinate_fix", F.get_json_object("raw_metadata", "$.coordinate_fix").alias("note"))


@query("B11_site_upsert", """
SELECT site_uid, source, native_id, CASE WHEN s_suppkey % 3 = 0 THEN upper(name) ELSE name END AS name FROM sites""")
def b11(t):
    old = t.sites.select("source", "native_id", "name")
    new = t.sites.where("s_suppkey % 3 = 0").select("source", "native_id", F.upper("name").alias("name"))
    return q.upsert_sites(old, new).select("site_uid", "source", "native_id", "name")


@query("B12_basin_from_huc", """
SELECT site_uid, huc, CASE substr(huc, 1, 4) WHEN '1301' THEN 'Rio Grande Headwaters' WHEN '1302' THEN 'Rio Grande-Elephant Butte' WHEN '1306' THEN 'Upper Pecos' WHEN '1408' THEN 'San Juan'
   ELSE CASE substr(huc, 1, 2) WHEN '13' THEN 'Rio Grande' WHEN '14' THEN 'Upper Colorado' WHEN '15' THEN 'Lower Colorado' WHEN '11' THEN 'Arkansas-White-Red' WHEN '12' THEN 'Texas-Gulf' END END AS basin
FROM (SELECT site_uid, CASE s_suppkey % 6 WHEN 0 THEN '13010001' WHEN 1 THEN '13060003' WHEN 2 THEN '14080101' WHEN 3 THEN '13990000' WHEN 4 THEN '99000000' ELSE '14990000' END AS huc FROM sites)""")
def b12(t):
    k = F.col("s_suppkey") % 6
    huc = (F.when(k == 0, "13010001").when(k == 1, "13060003").when(k == 2, "14080101").when(k == 3, "13990000").when(k == 4, "99000000").otherwise("14990000"))
    return q.with_basin(t.sites.select("site_uid", huc.alias("huc")), "huc")


@query("B13_coordinate_fallback", """
SELECT c_custkey AS id, round(CASE WHEN c_custkey % 3 = 0 THEN 33.5 + c_nationkey * 0.01
  ELSE (33 + c_nationkey % 4) + (c_custkey % 60) / 60.0 + (c_custkey % 50 + 0.5) / 3600.0 END::DOUBLE, 6) AS lat,
  CASE WHEN c_custkey % 3 = 0 THEN 'decimal' ELSE 'dms' END AS basis FROM customer""")
def b13(t):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    c = t.read("customer").select(
        k.alias("id"), F.when(k % 3 == 0, 33.5 + n * 0.01).alias("lat_dd"), F.when(k % 3 == 0, F.lit(-106.0)).alias("lon_dd"),
        F.concat(33 + n % 4, F.lit("d "), k % 60, F.lit("' "), k % 50, F.lit('.5" N')).alias("lat_dms"),
        F.concat(F.lit("106d 10' "), k % 50, F.lit('.5" W')).alias("lon_dms"), F.lit(None).cast("double").alias("easting"), F.lit(None).cast("double").alias("northing"))
    return q.station_coordinates(c).select("id", "lat", "basis")


@query("B14_clean_years", """
SELECT year_dropped, count(*) AS n, CAST(min(ts) AS VARCHAR) AS first FROM (SELECT NOT (year(l_shipdate) BETWEEN 1996 AND 2000) AS year_dropped,
  CASE WHEN year(l_shipdate) BETWEEN 1996 AND 2000 THEN l_shipdate END AS ts FROM lineitem) GROUP BY 1""")
def b14(t):
    return q.clean_years(t.obs, "datetime_utc", 1996, 2000).groupBy("year_dropped").agg(F.count("*").alias("n"), F.min("datetime_utc").alias("first"))


@query("B15_flags_to_qualifier", """
SELECT qualifier, count(*) AS n FROM (SELECT nullif(concat_ws('|', CASE WHEN l_tax > 0.05 THEN 'dry' END, CASE WHEN l_discount > 0.05 THEN 'no_measurement' END), '') AS qualifier
FROM lineitem WHERE l_quantity <= 40) GROUP BY 1""")
def b15(t):
    d = t.read("lineitem").select("l_orderkey", (F.col("l_tax") > 0.05).alias("dry"), (F.col("l_discount") > 0.05).alias("no_measurement"),
                                  (F.col("l_quantity") > 40).alias("invalid"))
    return q.join_flags(d, ["dry", "no_measurement"], "invalid").groupBy("qualifier").agg(F.count("*").alias("n"))
