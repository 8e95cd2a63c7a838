"""Entity-resolution queries."""

from pyspark.sql import functions as F

from tidemark.functions.literals import fixed
from tidemark.operators import resolve as d
from tidemark.plans.registry import query


def no_distance():
    return F.lit(None).cast("double")


def with_meta(t):
    k, m5 = F.col("s_suppkey"), F.col("s_suppkey") % 5
    n = (80000000 + k - m5).cast("string")
    meta = (F.when(m5 == 1, F.format_string('{"station": {"usgs_no": "USGS-%s", "kind": 3}}', n)).when(m5 == 2, F.format_string('{"USGS_ids": ["%s", "bad id"], "x": 1}', n))
             .otherwise(F.format_string('{"other": "%s"}', n)))
    return t.sites.withColumn("raw_metadata", meta)


META = """SELECT site_uid AS site_uid_a, 'usgs:' || (80000000 + s_suppkey - s_suppkey % 5) AS site_uid_b, 'same_sensor' AS link_type, 'usgs id in provider metadata' AS evidence, CAST(NULL AS DOUBLE) AS distance_m, 0.95::DOUBLE AS confidence FROM sites WHERE s_suppkey % 5 IN (1, 2)"""


@query("D1_metadata_links", META)
def d1(t):
    return d.metadata_links(with_meta(t))


# shapes of metadata with an id at other depths: nested lists, objects under the key, a key inside a text, numbers, no JSON at all
NESTED = [
    '{"usgs_ids": ["a", ["%s"]]}', '{"note": "x \\"usgs\\": %s"}', '{"usgs": {"id": "%s"}}', '{"a": [{"b": [[{"My_USGS_no": %s}]]}]}', '{"usgs": {"x": 1, "usgsSite": [" USGS-%s "]}}',
    '{"usgs": "%s", "broken": ', '{"usgs_ids": [true, 1.5, null, {"usgs": [[[["%s"]]]]}]}', '{"USGS": "%s.5", "other_usgs": "id %s"}', '["usgs", "%s"]']


def nested_meta(t):
    """The sites with metadata of those shapes in turn."""
    m5, n = F.col("s_suppkey") % 5, (80000000 + F.col("s_suppkey") - F.col("s_suppkey") % 5).cast("string")
    shape = F.floor(F.col("s_suppkey") / 5) % len(NESTED)
    meta = F.lit(None).cast("string")
    for k, text in enumerate(NESTED):
        meta = F.when(shape == k, F.replace(F.lit(text), F.lit("%s"), n)).otherwise(meta)
    return t.sites.withColumn("raw_metadata", meta).where(m5 != 3)


SHAPES_SQL = "CASE s_suppkey // 5 % {} {} END".format(len(NESTED), " ".join("WHEN {} THEN replace('{}', '%s', CAST(80000000 + s_suppkey - s_suppkey % 5 AS VARCHAR))".format(k, x) for k, x in enumerate(NESTED)))


@query("D1_nested_metadata", fr"""WITH m AS (SELECT site_uid, source, {SHAPES_SQL} AS j FROM sites WHERE s_suppkey % 5 <> 3),
 v AS (SELECT m.site_uid, m.source, regexp_extract(x.fullkey, '[.]"?([^."\[\]]+)"?(?:\[[0-9]+\])*$', 1) AS k, trim(x.atom ->> '$') AS a FROM (SELECT site_uid, source, CASE WHEN json_valid(j) THEN j ELSE '{{}}' END AS jj FROM m) m, json_tree(m.jj) x WHERE x.type IN ('VARCHAR', 'BIGINT', 'UBIGINT')),
 i AS (SELECT DISTINCT site_uid, source, regexp_extract(a, '^(?:USGS-)?([0-9]{{8,15}})$', 1) AS n FROM v WHERE contains(lower(k), 'usgs') AND source <> 'usgs')
SELECT site_uid AS site_uid_a, 'usgs:' || n AS site_uid_b, CASE WHEN source IN ('usbr_hydrodata', 'codwr', 'usace_cwms') THEN 'same_sensor' ELSE 'same_location_different_sensor' END AS link_type, 'usgs id in provider metadata' AS evidence, CAST(NULL AS DOUBLE) AS distance_m, 0.95::DOUBLE AS confidence
FROM i WHERE n IN (SELECT native_id FROM sites WHERE source = 'usgs')""")
def d1n(t):
    return d.metadata_links(nested_meta(t))


WEATHER = """w AS (SELECT c_custkey // 4 AS g, ['noaa_ghcnh','noaa_ghcnd','noaa_isd','uscrn'][c_custkey % 4 + 1] AS source, CASE c_custkey % 4 WHEN 2 THEN '72' || (c_custkey // 4) || '-' || lpad(CAST(c_custkey // 4 AS VARCHAR), 5, '0') WHEN 3 THEN 'crn' || (c_custkey // 4)
  ELSE CASE WHEN c_custkey // 4 % 3 = 0 THEN 'USC' || (c_custkey // 4) ELSE 'USW000' || lpad(CAST(c_custkey // 4 AS VARCHAR), 5, '0') END END AS nid, c_custkey FROM customer),
 ws AS (SELECT source || ':' || nid AS site_uid, * FROM w),
 wk AS (SELECT site_uid, source, 0 AS r, 'same GHCN station id ' || nid AS e FROM ws WHERE source IN ('noaa_ghcnh', 'noaa_ghcnd')
  UNION ALL SELECT site_uid, source, 1, 'same WBAN ' || lpad(CAST(g AS VARCHAR), 5, '0') FROM ws WHERE nid LIKE 'USW000%' OR source = 'uscrn' OR (source = 'noaa_isd' AND lpad(CAST(g AS VARCHAR), 5, '0') <> '99999')
  UNION ALL SELECT site_uid, source, 2, 'same ICAO K' || lpad(CAST(g % 900 AS VARCHAR), 3, '0') FROM ws WHERE g % 5 = 0)"""


def weather_sites(t):
    k = F.col("c_custkey")
    g, m = F.floor(k / 4), k % 4
    pad = F.lpad(g.cast("string"), 5, "0")
    src = F.when(m == 0, "noaa_ghcnh").when(m == 1, "noaa_ghcnd").when(m == 2, "noaa_isd").otherwise("uscrn")
    nid = F.when(m == 2, F.concat(F.lit("72"), g, F.lit("-"), pad)).when(m == 3, F.concat(F.lit("crn"), g)).otherwise(F.when(g % 3 == 0, F.concat(F.lit("USC"), g)).otherwise(F.concat(F.lit("USW000"), pad)))
    meta = F.to_json(F.struct(F.when(m == 3, g.cast("string")).alias("WBAN"), F.when(g % 5 == 0, F.concat(F.lit("k"), F.lpad((g % 900).cast("string"), 3, "0"))).alias("icao")))
    return t.read("customer").select(F.concat(src, F.lit(":"), nid).alias("site_uid"), src.alias("source"), nid.alias("native_id"), meta.alias("raw_metadata"))


@query("D2_weather_links", f"""WITH {WEATHER}, p AS (SELECT DISTINCT a.site_uid AS x, b.site_uid AS y, a.r, a.e FROM wk a JOIN wk b ON a.r = b.r AND a.e = b.e AND a.site_uid < b.site_uid AND a.source <> b.source)
SELECT x AS site_uid_a, y AS site_uid_b, 'same_sensor' AS link_type, string_agg(e, '; ' ORDER BY r, e) AS evidence, CAST(NULL AS DOUBLE) AS distance_m, CASE WHEN min(r) = 0 THEN 0.98 ELSE 0.95 END::DOUBLE AS confidence FROM p GROUP BY 1, 2""")
def d2(t):
    return d.weather_links(weather_sites(t))


@query("D2_key_stars", f"""WITH {WEATHER}, h AS (SELECT e, min(site_uid) AS m FROM wk GROUP BY 1) SELECT DISTINCT m AS site_uid_a, site_uid AS site_uid_b FROM wk JOIN h USING (e) WHERE m <> site_uid""")
def d2k(t):
    return d.key_stars(d.weather_keys(weather_sites(t)))


OBSERVERS = """cc AS (SELECT 'cocorahs:NM-' || chr(CAST(65 + c_nationkey AS INTEGER)) || 'R-' || (c_custkey % 500) AS uid, 'US1NM' || chr(CAST(65 + c_nationkey AS INTEGER)) || 'R' || lpad(CAST(c_custkey % 500 AS VARCHAR), 4, '0') AS g FROM customer WHERE c_custkey % 2 = 0),
 gh AS (SELECT DISTINCT 'US1NM' || chr(CAST(65 + c_nationkey AS INTEGER)) || 'R' || lpad(CAST(c_custkey % 500 AS VARCHAR), 4, '0') AS g FROM customer WHERE c_custkey % 3 = 0)"""


def observers(t):
    c = t.read("customer")
    code, n = F.chr(F.col("c_nationkey") + 65), F.col("c_custkey") % 500
    nid = F.concat(F.lit("NM-"), code, F.lit("R-"), n)
    o = c.where("c_custkey % 2 = 0").select(F.concat(F.lit("cocorahs:"), nid).alias("site_uid"), F.lit("cocorahs").alias("source"), nid.alias("native_id"), F.lit("").alias("name")).distinct()
    g = F.concat(F.lit("US1NM"), code, F.lit("R"), F.lpad(n.cast("string"), 4, "0"))
    h = c.where("c_custkey % 3 = 0").select(F.concat(F.lit("noaa_ghcnd:"), g).alias("site_uid"), F.lit("noaa_ghcnd").alias("source"), g.alias("native_id"), F.lit("").alias("name")).distinct()
    w = t.read("supplier").where("s_suppkey % 5 = 4").select(F.concat(F.lit("wqp:NM"), "s_suppkey").alias("site_uid"), F.lit("wqp").alias("source"), F.concat(F.lit("NM"), "s_suppkey").alias("native_id"),
                                                               F.concat(F.lit("Rio below USGS "), 80000000 + F.col("s_suppkey") - 4).alias("name"))
    return o.unionByName(h).unionByName(w).unionByName(t.sites.select("site_uid", "source", "native_id", "name"))


GAUGEIDS = f"""{OBSERVERS}, gl AS (SELECT site_uid AS site_uid_a, 'usgs:' || substr(native_id, 6) AS site_uid_b, 'same_sensor' AS link_type, 'WQP id USGS-<number> is the USGS site number' AS evidence, 0.99 AS confidence FROM sites WHERE source = 'wqp'
 UNION ALL SELECT 'wqp:NM' || s_suppkey, 'usgs:' || (80000000 + s_suppkey - 4), 'same_location_different_sensor', 'WQP site name cites USGS ' || (80000000 + s_suppkey - 4), 0.9 FROM supplier WHERE s_suppkey % 5 = 4
 UNION ALL SELECT DISTINCT uid, 'noaa_ghcnd:' || g, 'same_sensor', 'CoCoRaHS ' || substr(uid, 10) || ' is GHCN-Daily ' || g, 0.98 FROM cc JOIN gh USING (g))"""


@query("D3_gauge_id_links", f"WITH {GAUGEIDS} SELECT site_uid_a, site_uid_b, link_type, evidence, CAST(NULL AS DOUBLE) AS distance_m, confidence::DOUBLE AS confidence FROM gl")
def d3(t):
    return d.gauge_id_links(observers(t))


NEAR = """pp AS (SELECT *, CASE site_type WHEN 'stream' THEN 'flow' WHEN 'reservoir' THEN 'reservoir' ELSE 'well' END AS grp FROM sites WHERE lat IS NOT NULL),
 dd AS (SELECT a.site_uid AS site_uid_a, b.site_uid AS site_uid_b, a.grp, 2 * 6371000.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) AS m FROM pp a JOIN pp b ON a.grp = b.grp AND a.site_uid < b.site_uid AND a.source <> b.source
  WHERE NOT (a.source = 'wqp' AND b.source = 'usgs') AND NOT (b.source = 'wqp' AND a.source = 'usgs')),
 nr AS (SELECT site_uid_a, site_uid_b, 'colocated' AS link_type, 'same kind (' || grp || ') within 250 m' AS evidence, round(m, 1) AS distance_m, round(greatest(0.3, 0.9 - m / 250 * 0.5), 2) AS confidence FROM dd WHERE m <= 250)"""


@query("D4_proximity_links", f"WITH {NEAR} SELECT * FROM nr")
def d4(t):
    return d.proximity_links(t.sites)


ANCHORED = f"""ex AS ({META} UNION ALL SELECT site_uid, 'usgs:' || substr(native_id, 6), 'same_sensor', 'id', NULL, 0.99 FROM sites WHERE source = 'wqp'), {NEAR}, al AS (SELECT * FROM ex UNION ALL SELECT * FROM nr),
 an AS (SELECT site_uid_a AS o, min(site_uid_b) AS u FROM ex GROUP BY 1 HAVING count(DISTINCT site_uid_b) = 1),
 st AS (SELECT * FROM ex UNION ALL SELECT n.site_uid_a, n.site_uid_b, CASE WHEN x.u IS NOT NULL AND y.u IS NOT NULL THEN 'same_sensor' ELSE 'colocated' END, CASE WHEN x.u IS NOT NULL AND y.u IS NOT NULL THEN 'both linked to ' || x.u ELSE evidence END, distance_m,
   CASE WHEN x.u IS NOT NULL AND y.u IS NOT NULL THEN 0.95 ELSE confidence END FROM nr n LEFT JOIN an x ON x.o = n.site_uid_a LEFT JOIN an y ON y.o = n.site_uid_b WHERE x.u IS NULL OR y.u IS NULL OR x.u = y.u)"""


def anchored(t):
    own = t.sites.where("source = 'wqp'").select(F.col("site_uid").alias("site_uid_a"), F.concat(F.lit("usgs:"), F.substring("native_id", 6, 20)).alias("site_uid_b"), F.lit("same_sensor").alias("link_type"),
                                                 F.lit("id").alias("evidence"), no_distance().alias("distance_m"), F.lit(0.99).alias("confidence"))
    return d.settle_by_anchor(d.metadata_links(with_meta(t)).unionByName(own).unionByName(d.proximity_links(t.sites)))


@query("D5_settle_by_anchor", f"WITH {ANCHORED} SELECT site_uid_a, site_uid_b, link_type, evidence, distance_m, confidence::DOUBLE AS confidence FROM st")
def d5(t):
    return anchored(t)


@query("D6_manual_links", f"""WITH {NEAR}, mn AS (SELECT site_uid_b AS site_uid_a, site_uid_a AS site_uid_b, 'same_location_different_sensor' AS link_type FROM nr WHERE distance_m < 40)
SELECT site_uid_a, site_uid_b, link_type, 'reviewed' AS evidence, CAST(NULL AS DOUBLE) AS distance_m, 1.0::DOUBLE AS confidence FROM mn UNION ALL SELECT * FROM nr WHERE distance_m >= 40""")
def d6(t):
    near = d.proximity_links(t.sites)
    manual = near.where("distance_m < 40").select(F.col("site_uid_b").alias("site_uid_a"), F.col("site_uid_a").alias("site_uid_b"), F.lit("same_location_different_sensor").alias("link_type"), F.lit("reviewed").alias("evidence"))
    return d.merge_manual(near, manual)


FULL = ANCHORED.replace("'same_sensor', 'id', NULL, 0.99 FROM sites", "'same_sensor', 'WQP id USGS-<number> is the USGS site number', NULL, 0.99 FROM sites")


@query("D6_build_links", f"""WITH {FULL} SELECT site_uid_a, site_uid_b, link_type, evidence, distance_m, confidence::DOUBLE AS confidence FROM st s WHERE link_type <> 'colocated'
 OR NOT EXISTS (SELECT 1 FROM st x WHERE x.link_type <> 'colocated' AND least(x.site_uid_a, x.site_uid_b) = least(s.site_uid_a, s.site_uid_b) AND greatest(x.site_uid_a, x.site_uid_b) = greatest(s.site_uid_a, s.site_uid_b))""")
def d6b(t):
    none = t.sites.limit(0).select(F.lit("a").alias("site_uid_a"), F.lit("b").alias("site_uid_b"), F.lit("c").alias("link_type"), F.lit("d").alias("evidence"))
    return d.build_links(with_meta(t), none)


NAMES = """nm AS (SELECT a.p_partkey AS id, a.p_partkey, a.p_size, 'Rio ' || a.p_name || CASE WHEN a.p_size % 2 = 0 THEN ' bl ' ELSE ' nr ' END || a.p_type || ' Dam' AS name_a, b.p_name || ' River ' || CASE WHEN b.p_size % 3 = 0 THEN 'abv ' ELSE '@' END || b.p_type || CASE WHEN b.p_size % 5 = 0 THEN ' computed' ELSE '' END AS name_b,
  list_distinct(list_concat(string_split(a.p_name, ' '), [lower(a.p_type)])) AS pa, list_distinct(list_concat(list_concat(string_split(b.p_name, ' '), [lower(b.p_type)]), CASE WHEN b.p_size % 5 = 0 THEN ['computed'] ELSE [] END)) AS pb, a.p_size % 2 = 0 AND b.p_size % 3 = 0 AS opp, b.p_size % 5 = 0 AS der
  FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1),
 mt AS (SELECT *, CASE WHEN opp OR der THEN 0.0 ELSE len(list_intersect(pa, pb)) / len(list_distinct(list_concat(pa, pb)))::DOUBLE END::DOUBLE AS name_match, len(list_intersect(pa, pb)) = len(pa) OR len(list_intersect(pa, pb)) = len(pb) AS same_name FROM nm)"""


def name_pairs(t):
    p = t.read("part")
    a = p.select("p_partkey", "p_size", F.concat(F.lit("Rio "), "p_name", F.when(F.col("p_size") % 2 == 0, " bl ").otherwise(" nr "), "p_type", F.lit(" Dam")).alias("name_a"))
    b = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.concat("p_name", F.lit(" River "), F.when(F.col("p_size") % 3 == 0, "abv ").otherwise("@"), "p_type", F.when(F.col("p_size") % 5 == 0, " computed").otherwise("")).alias("name_b"))
    return a.join(b, "p_partkey")


@query("D7_name_match", f"WITH {NAMES} SELECT id, round(name_match, 6) AS name_match, same_name FROM mt")
def d7(t):
    return d.with_name_match(name_pairs(t)).select(F.col("p_partkey").alias("id"), "name_match", "same_name")


PAIRED = """pr AS (SELECT 'usgs:' || s_suppkey AS a, 'codwr:' || s_suppkey AS b FROM supplier), dl AS (SELECT site_uid, CAST(datetime_utc AS DATE) AS date, avg(value) AS v FROM obs GROUP BY 1, 2),
 jj AS (SELECT pr.a, pr.b, x.date, x.v AS x, y.v AS y FROM pr JOIN dl x ON x.site_uid = a JOIN dl y ON y.site_uid = b AND y.date = x.date)"""


def series_pairs(t):
    return t.read("supplier").select(F.concat(F.lit("usgs:"), "s_suppkey").alias("site_uid_a"), F.concat(F.lit("codwr:"), "s_suppkey").alias("site_uid_b"))


@query("D8_series_agreement", f"""WITH {PAIRED} SELECT a AS site_uid_a, b AS site_uid_b, 'discharge' AS variable, count(*) AS days, round(median(abs(x - y) / greatest(abs(x), abs(y), 1e-9)), 6) AS median_rel, round(corr(x, y), 6) AS corr,
 coalesce(count(*) >= 60 AND median(abs(x - y) / greatest(abs(x), abs(y), 1e-9)) <= 0.03 AND corr(x, y) >= 0.99, false) AS agrees FROM jj GROUP BY 1, 2 HAVING count(*) >= 5""")
def d8(t):
    daily = t.obs.groupBy("site_uid", "variable", F.to_date("datetime_utc").alias("date")).agg(F.avg("value").alias("value"))
    return d.series_agreement(daily, series_pairs(t), 5)


@query("D9_link_decision", f"""WITH {NAMES}, q AS (SELECT 'usgs:' || id AS a, (CASE id % 3 WHEN 0 THEN 'wqp' WHEN 1 THEN 'nwps' ELSE 'usgs' END) || ':x' || id AS b, id % 3 AS k, p_size * 3.0 AS metres, name_match, id % 4 = 0 AND p_size * 10 >= 60 AND p_size * 0.0002 <= 0.005 AS ok, id % 6 = 0 AS fd, p_size * 10 AS days, id FROM mt)
SELECT a AS site_uid_a, b AS site_uid_b, metres::DOUBLE AS metres, round(name_match, 6) AS name_match, CASE WHEN ok THEN 'stage' END AS agreed_on, CAST(CASE WHEN ok THEN days END AS BIGINT) AS shared_days, fd AS flow_differs, (id % 4 = 0 AND NOT ok AND days >= 60) OR fd AS series_differ,
 CASE WHEN k = 2 THEN NULL WHEN ok THEN 'same_sensor' WHEN name_match >= 0.66 AND metres <= CASE WHEN k = 0 THEN 100 ELSE 25 END THEN 'same_location_different_sensor' END AS link_type FROM q""")
def d9(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    src = F.when(k % 3 == 0, "wqp").when(k % 3 == 1, "nwps").otherwise("usgs")
    p = name_pairs(t).select("name_a", "name_b", F.concat(F.lit("usgs:"), k).alias("site_uid_a"), F.concat(src, F.lit(":x"), k).alias("site_uid_b"), F.lit("usgs").alias("source_a"), src.alias("source_b"), (s * 3.0).alias("metres"), k, s)
    stage = p.where(k % 4 == 0).select("site_uid_a", "site_uid_b", F.lit("stage").alias("variable"), (s * 10).alias("days"), (s * 0.0002).alias("median_rel"), F.lit(0.995).alias("corr"))
    flow = p.where(k % 6 == 0).select("site_uid_a", "site_uid_b", F.lit("discharge").alias("variable"), F.lit(100).alias("days"), F.lit(0.05).alias("median_rel"), F.lit(0.999).alias("corr"))
    return d.decide(p, d.with_agreement(stage.unionByName(flow)))


@query("D10_well_decision", """
WITH q AS (SELECT 'usgs:' || (90000000 + p_partkey) AS a, CASE WHEN p_partkey % 4 = 0 THEN 'usgs:' || p_partkey WHEN p_partkey % 4 = 1 THEN 'nmbgmr:W-' || (90000000 + p_partkey) ELSE 'nmbgmr:' || p_partkey END AS b, p_size * 0.7 AS metres, CASE WHEN p_partkey % 7 > 0 THEN 30.0 END AS da, 30.0 + (p_size % 3) * 0.25 AS db, p_partkey % 4 AS k FROM part)
SELECT a AS site_uid_a, b AS site_uid_b, CASE WHEN k = 0 OR abs(da - db) > 0.3 THEN NULL WHEN k = 1 AND metres <= 25 THEN 'id' WHEN da IS NOT NULL AND metres <= 10 THEN 'depth' END AS basis,
 CASE WHEN k > 0 AND NOT coalesce(abs(da - db) > 0.3, false) AND ((k = 1 AND metres <= 25) OR (da IS NOT NULL AND metres <= 10)) THEN 'same_location_different_sensor' END AS link_type FROM q""")
def d10(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    b = F.when(k % 4 == 0, F.concat(F.lit("usgs:"), k)).when(k % 4 == 1, F.concat(F.lit("nmbgmr:W-"), 90000000 + k)).otherwise(F.concat(F.lit("nmbgmr:"), k))
    p = t.read("part").select(F.concat(F.lit("usgs:"), 90000000 + k).alias("site_uid_a"), b.alias("site_uid_b"), F.lit("usgs").alias("source_a"), F.when(k % 4 == 0, "usgs").otherwise("nmbgmr").alias("source_b"), (s * 0.7).alias("metres"),
                              F.when(k % 7 > 0, 30.0).alias("depth_a"), (30.0 + (s % 3) * 0.25).alias("depth_b"))
    return d.decide_wells(p).select("site_uid_a", "site_uid_b", "basis", "link_type")


@query("D11_compare_series", f"""WITH {PAIRED} SELECT a AS site_uid_a, b AS site_uid_b, 'discharge' AS variable, count(*) AS overlap_days, strftime(min(date), '%Y-%m-%d') AS first_day, strftime(max(date), '%Y-%m-%d') AS last_day,
 round(avg((abs(x - y) <= greatest(0.005 * abs(x), 0.01))::INT), 3) AS share_equal, round(corr(x, y), 4) AS r, round(median(y / nullif(x, 0)), 3) AS median_ratio FROM jj GROUP BY 1, 2""")
def d11(t):
    return d.compare_series(t.obs, series_pairs(t))


@query("D12_connected_groups", """
WITH RECURSIVE e AS (SELECT s_suppkey AS a, s_suppkey // 3 AS b FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey // 3 <> s_suppkey), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(id, seen) AS (SELECT s_suppkey, s_suppkey FROM supplier UNION SELECT r.id, u.b FROM r JOIN u ON u.a = r.seen)
SELECT 'n' || lpad(CAST(id AS VARCHAR), 9, '0') AS site_uid, min('n' || lpad(CAST(seen AS VARCHAR), 9, '0')) AS "group" FROM r GROUP BY id""")
def d12(t):
    key = lambda c: F.concat(F.lit("n"), F.lpad(c.cast("string"), 9, "0"))
    s, k = t.read("supplier"), F.col("s_suppkey")
    edges = s.where(k % 4 != 0).select(key(k).alias("site_uid_a"), key(F.floor(k / 3)).alias("site_uid_b"))
    return d.connected_groups(s.select(key(k).alias("site_uid")), edges)


@query("D13_governed_ditches", """
WITH g AS (SELECT 'Acequia de ' || p_name || ' ' || (p_partkey % 30) AS name, p_name AS nk, CASE WHEN p_size % 3 = 0 THEN 'Rio ' || p_type WHEN p_size % 3 = 1 THEN 'elsewhere' END AS stream, CASE WHEN p_partkey % 4 > 0 THEN 'county ' || chr(CAST(65 + p_partkey % 5 AS INTEGER)) END AS county, p_type, p_size FROM part),
 m AS (SELECT DISTINCT 'R' || (p_partkey % 3) AS river, p_name AS nk FROM part WHERE p_size > 44), rv AS (SELECT * FROM (VALUES ('R0','rio economy','county a'), ('R0','rio economy','county b'), ('R1','rio small','county c'), ('R2','rio promo','county d')) v(river, base, county)),
 j AS (SELECT rv.river, g.* FROM g JOIN rv ON lower(g.county) = rv.county UNION ALL SELECT b.river, g.* FROM g JOIN (SELECT DISTINCT river, base FROM rv) b ON g.county IS NULL AND lower(g.stream) = b.base), b AS (SELECT DISTINCT river, base FROM rv)
SELECT DISTINCT j.river, j.name, j.nk AS "key", CASE WHEN lower(stream) = b.base THEN 'stream' ELSE 'map' END AS basis FROM j JOIN b ON b.river = j.river WHERE CASE WHEN stream IS NOT NULL THEN lower(stream) = b.base ELSE county IS NOT NULL AND (j.river, j.nk) IN (SELECT (river, nk) FROM m) END""")
def d13(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    p = t.read("part")
    g = p.select(F.concat(F.lit("Acequia de "), "p_name", F.lit(" "), k % 30).alias("name"), F.when(s % 3 == 0, F.concat(F.lit("Rio "), "p_type")).when(s % 3 == 1, "elsewhere").alias("stream"),
                 F.when(k % 4 > 0, F.concat(F.lit("county "), F.chr(65 + k % 5))).alias("county"))
    # the county wording here has no trailing word to strip
    m = p.where("p_size > 44").select(F.concat(F.lit("R"), k % 3).alias("river"), F.concat(F.lit("Acequia del "), "p_name").alias("name"), F.lit("seg").alias("segment"))
    rv = fixed(t.spark, [("R0", "rio economy", "county A"), ("R0", "rio economy", "county B"), ("R1", "rio small", "county C"), ("R2", "rio promo", "county D")], "river string, base string, county string")
    return d.governed_ditches(g, m, rv)
