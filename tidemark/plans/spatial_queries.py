"""Spatial queries."""

import math

from pyspark.sql import functions as F

from tidemark.functions.literals import fixed
from tidemark.operators import spatial as s
from tidemark.plans.registry import query

INSIDE = "lon > x0 AND lon < x1 AND lat > y0 AND lat < y1"


@query("E1_assign_hucs", f"SELECT site_uid, coalesce(huc8, (SELECT min(unit) FROM boxes WHERE {INSIDE})) AS huc8 FROM sites")
def e1(t):
    return s.assign_hucs(t.sites.select("site_uid", "huc8", "lat", "lon"), s.box_edges(t.boxes)).select("site_uid", "huc8")


@query("E2_assign_regions", f"""SELECT site_uid, k AS region_type, unit AS region_id, 'Region ' || unit AS region_name FROM sites JOIN boxes ON {INSIDE}, (VALUES ('county'), ('place')) v(k) WHERE k = 'county' OR unit IN ('W1', 'W2')""")
def e2(t):
    e = s.box_edges(t.boxes).withColumn("region_id", F.col("poly_id")).withColumn("region_name", F.concat(F.lit("Region "), "poly_id")).drop("poly_id")
    layers = e.withColumn("region_type", F.lit("county")).unionByName(e.where("region_id IN ('W1', 'W2')").withColumn("region_type", F.lit("place")))
    return s.assign_regions(t.sites, layers)


PTS = "pts AS (SELECT c_custkey AS id, ((c_custkey * 7919) % 100000)::DOUBLE AS px, ((c_custkey * 104729) % 100000)::DOUBLE AS py, c_nationkey FROM customer)"
LNS = "lns AS (SELECT p_partkey AS line_id, ((p_partkey * 3571) % 100000)::DOUBLE AS x0, ((p_partkey * 7177) % 100000)::DOUBLE AS y0, ((p_partkey * 3571) % 100000 + p_size * 20)::DOUBLE AS x1, ((p_partkey * 7177) % 100000 + p_partkey % 50 * 10)::DOUBLE AS y1, p_name, p_size FROM part)"
DIST = """ds AS (SELECT *, sqrt(pow(px - (x0 + u * (x1 - x0)), 2) + pow(py - (y0 + u * (y1 - y0)), 2)) AS dist FROM (SELECT *, CASE WHEN (x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0) > 0 THEN least(1.0, greatest(0.0, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) ELSE 0.0 END AS u FROM pts, lns))"""


def points(t):
    k = F.col("c_custkey")
    return t.read("customer").select(k.alias("id"), ((k * 7919) % 100000).cast("double").alias("px"), ((k * 104729) % 100000).cast("double").alias("py"), "c_nationkey")


def lines(t):
    k = F.col("p_partkey")
    x, y = (k * 3571) % 100000, (k * 7177) % 100000
    return t.read("part").select(k.alias("line_id"), x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + F.col("p_size") * 20).cast("double").alias("x1"), (y + k % 50 * 10).cast("double").alias("y1"), "p_name", "p_size")


@query("E3_nearest_line", f"WITH {PTS}, {LNS}, {DIST} SELECT id, line_id, round(dist, 6) AS distance_m FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, line_id) AS rn FROM ds WHERE dist <= 500) WHERE rn = 1")
def e3(t):
    return s.nearest_line(points(t), lines(t), "px", "py", ["id"], 500.0)


BOX = "bx AS (SELECT p_partkey AS poly, ((p_partkey * 3571) % 100000 + 0.37)::DOUBLE AS x0, ((p_partkey * 3571) % 100000 + 0.37 + p_size * 40)::DOUBLE AS x1, ((p_partkey * 7177) % 100000 + 0.37)::DOUBLE AS y0, ((p_partkey * 7177) % 100000 + 0.37 + p_size * 30)::DOUBLE AS y1 FROM part)"


def box_rows(t):
    k, z = F.col("p_partkey"), F.col("p_size")
    x, y = (k * 3571) % 100000 + 0.37, (k * 7177) % 100000 + 0.37
    b = t.read("part").select(k.alias("unit"), x.alias("x0"), (x + z * 40).alias("x1"), y.alias("y0"), (y + z * 30).alias("y1"))
    return s.box_edges(b)


# distance to a box's outline from outside it is the distance to the box
MATCH = """wi AS (SELECT id, min(poly) AS poly_id FROM pts JOIN bx ON px > x0 AND px < x1 AND py > y0 AND py < y1 GROUP BY 1), nb AS (SELECT id, poly, sqrt(pow(greatest(x0 - px, 0, px - x1), 2) + pow(greatest(y0 - py, 0, py - y1), 2)) AS dist FROM pts, bx WHERE id NOT IN (SELECT id FROM wi)),
 mm AS (SELECT id, poly_id, 'within' AS match_type, 0.0 AS dist FROM wi UNION ALL SELECT id, poly, 'nearest', dist FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, poly) AS rn FROM nb WHERE dist <= {r}) WHERE rn = 1)"""


@query("E4_within_or_nearest", f"WITH {PTS}, {BOX}, {MATCH.format(r=900)} SELECT id, poly_id, match_type, round(dist, 6)::DOUBLE AS distance_m FROM mm")
def e4(t):
    return s.within_or_nearest(points(t), box_rows(t), "px", "py", ["id"], 900.0, 900.0)


def albers_sql(lon: str, lat: str) -> tuple[str, str]:
    """The projection as SQL text, its constants worked out here."""
    p = s.ALBERS
    e2 = p["f"] * (2 - p["f"])
    e = math.sqrt(e2)
    q = lambda v: (1 - e2) * (v / (1 - e2 * v * v) - math.log((1 - e * v) / (1 + e * v)) / (2 * e))
    m = lambda d: math.cos(math.radians(d)) / math.sqrt(1 - e2 * math.sin(math.radians(d)) ** 2)
    q0, q1, q2 = (q(math.sin(math.radians(p[k]))) for k in ("lat0", "sp1", "sp2"))
    n = (m(p["sp1"]) ** 2 - m(p["sp2"]) ** 2) / (q2 - q1)
    c = m(p["sp1"]) ** 2 + n * q1
    sn = f"sin(radians({lat}))"
    qs = f"({1 - e2!r}::DOUBLE * ({sn} / (1 - {e2!r}::DOUBLE * {sn} * {sn}) - ln((1 - {e!r}::DOUBLE * {sn}) / (1 + {e!r}::DOUBLE * {sn})) / {2 * e!r}::DOUBLE))"
    rho = f"({p['a']!r}::DOUBLE * sqrt({c!r}::DOUBLE - {n!r}::DOUBLE * {qs}) / {n!r}::DOUBLE)"
    rho0 = p["a"] * math.sqrt(c - n * q0) / n
    th = f"({n!r}::DOUBLE * radians({lon} - ({p['lon0']!r})))"
    return f"{rho} * sin({th})", f"{rho0!r}::DOUBLE - {rho} * cos({th})"


X, Y = albers_sql("lon", "lat")


@query("E5_match_dams", f"""WITH dams AS (SELECT c_custkey AS id, -109.0 + (c_custkey % 61) * 0.1 AS lon, 32.0 + (c_custkey % 47) * 0.1 AS lat FROM customer), pts AS (SELECT id, {X} AS px, {Y} AS py FROM dams),
 ctr AS (SELECT p_partkey AS poly, -109.0 + (p_partkey % 59) * 0.1 AS lon, 32.0 + (p_partkey % 53) * 0.1 AS lat, p_size FROM part), bc AS (SELECT poly, p_size, {X} AS cx, {Y} AS cy FROM ctr), bx AS (SELECT poly, cx - p_size * 40 AS x0, cx + p_size * 40 AS x1, cy - p_size * 30 AS y0, cy + p_size * 30 AS y1 FROM bc),
 {MATCH.format(r=3000)} SELECT id AS nid_id, poly_id, match_type, round(dist, 3)::DOUBLE AS distance_m FROM mm""")
def e5(t):
    k = F.col("c_custkey")
    dams = t.read("customer").select(k.alias("nid_id"), (-109.0 + (k % 61) * 0.1).alias("lon"), (32.0 + (k % 47) * 0.1).alias("lat"))
    p, z = F.col("p_partkey"), F.col("p_size")
    cx, cy = s.albers(-109.0 + (p % 59) * 0.1, 32.0 + (p % 53) * 0.1)
    b = t.read("part").select(p.alias("unit"), (cx - z * 40).alias("x0"), (cx + z * 40).alias("x1"), (cy - z * 30).alias("y0"), (cy + z * 30).alias("y1"))
    return s.match_dams(dams, s.box_edges(b)).withColumn("distance_m", F.round("distance_m", 3))


# rivers, ditches and districts with edges far longer than the radii, so that vertices alone do not show what is near
RIVERS = """rv AS (SELECT 'r' || (p_partkey % 5) AS river, x0, y0, x0 + p_size * 200 + 3 AS x1, y0 + (p_partkey % 50 - 25) * 150 + 7 AS y1 FROM (
  SELECT p_partkey, p_size, ((p_partkey * 3571) % 100000 + 0.37)::DOUBLE AS x0, ((p_partkey * 7177) % 100000 + 0.61)::DOUBLE AS y0 FROM part WHERE p_size % 4 = 0))"""
DITCHES = """fs AS (SELECT c_custkey // 2 AS f, CASE WHEN c_custkey // 2 % 6 = 0 THEN ' Unknown' ELSE 'ditch ' || (c_custkey // 2 % 40) END AS name, px AS u0, py AS v0, px + (c_custkey % 40) * 500 + 3 AS u1,
  py + (c_custkey * 7 % 40 - 20) * 500 + 7 AS v1 FROM (SELECT c_custkey, ((c_custkey * 7919) % 100000)::DOUBLE AS px, ((c_custkey * 104729) % 100000)::DOUBLE AS py FROM customer))"""
BASINS = "sg AS (SELECT 'seg' || r_regionkey AS segment, r_regionkey * 17000 + 0.5 AS bx0, r_regionkey * 17000 + 30000.5 AS bx1, r_regionkey * 11000 + 0.5 AS by0, r_regionkey * 11000 + 50000.5 AS by1 FROM region)"
DISTRICTS = """db AS (SELECT s_suppkey AS k, 'District ' || (s_suppkey % 23) AS name, abs(s_acctbal) AS acres, cx AS bx0, cx + 4000 + s_suppkey % 7 * 6000 AS bx1, cy AS by0, cy + 3000 + s_suppkey % 5 * 8000 AS by1
  FROM (SELECT *, ((s_suppkey * 6007) % 90000 + 0.19)::DOUBLE AS cx, ((s_suppkey * 9173) % 90000 + 0.23)::DOUBLE AS cy FROM supplier))"""


def apart_sql(a: tuple, b: tuple) -> str:
    """Distance between two segments as SQL text."""
    side = lambda p, s: f"sign(({s[2]} - {s[0]}) * ({p[1]} - {s[1]}) - ({s[3]} - {s[1]}) * ({p[0]} - {s[0]}))"
    along = lambda p, s: f"least(1.0, greatest(0.0, (({p[0]} - {s[0]}) * ({s[2]} - {s[0]}) + ({p[1]} - {s[1]}) * ({s[3]} - {s[1]})) / (pow({s[2]} - {s[0]}, 2) + pow({s[3]} - {s[1]}, 2))))"
    to = lambda p, s: f"sqrt(pow({p[0]} - ({s[0]} + {along(p, s)} * ({s[2]} - {s[0]})), 2) + pow({p[1]} - ({s[1]} + {along(p, s)} * ({s[3]} - {s[1]})), 2))"
    cross = f"{side(a[:2], b)} * {side(a[2:], b)} < 0 AND {side(b[:2], a)} * {side(b[2:], a)} < 0"
    return f"CASE WHEN {cross} THEN 0.0 ELSE least({to(a[:2], b)}, {to(a[2:], b)}, {to(b[:2], a)}, {to(b[2:], a)}) END"


def in_box_sql(x0: str, y0: str, x1: str, y1: str) -> str:
    """Whether a segment shares a point with the box bx0..by1, by clipping; no segment here is upright or level."""
    t = lambda b, p, q: f"(({b}) - {p}) / ({q} - {p})"
    xs, ys = [t(b, x0, x1) for b in ("bx0", "bx1")], [t(b, y0, y1) for b in ("by0", "by1")]
    return f"greatest(0.0, least({xs[0]}, {xs[1]}), least({ys[0]}, {ys[1]})) <= least(1.0, greatest({xs[0]}, {xs[1]}), greatest({ys[0]}, {ys[1]}))"


ON_RIVER = ("x0", "y0", "x1", "y1")
IN_CORRIDOR = "cr AS (SELECT DISTINCT k, name, acres, river FROM db, rv WHERE " + in_box_sql(*ON_RIVER) + " OR least(" + ", ".join(
    apart_sql(ON_RIVER, e) for e in (("bx0", "by0", "bx1", "by0"), ("bx1", "by0", "bx1", "by1"), ("bx1", "by1", "bx0", "by1"), ("bx0", "by1", "bx0", "by0"))) + ") <= 900)"


def rivers(t):
    k, z = F.col("p_partkey"), F.col("p_size")
    r = t.read("part").where(z % 4 == 0).select(F.concat(F.lit("r"), k % 5).alias("line_id"), ((k * 3571) % 100000 + 0.37).alias("x0"), ((k * 7177) % 100000 + 0.61).alias("y0"), z.alias("z"), k.alias("k"))
    return r.select("line_id", "x0", "y0", (F.col("x0") + F.col("z") * 200 + 3).alias("x1"), (F.col("y0") + (F.col("k") % 50 - 25) * 150 + 7).alias("y1"))


def basins(t):
    k = F.col("r_regionkey")
    b = t.read("region").select(F.concat(F.lit("seg"), k).alias("unit"), (k * 17000 + 0.5).alias("x0"), (k * 17000 + 30000.5).alias("x1"), (k * 11000 + 0.5).alias("y0"), (k * 11000 + 50000.5).alias("y1"))
    return s.box_edges(b).withColumnRenamed("poly_id", "segment")


def corridor(t):
    """Districts (k, name, acres) within 900 m of a river, as areas."""
    k = F.col("s_suppkey")
    d = t.read("supplier").select(k.alias("unit"), F.concat(F.lit("District "), k % 23).alias("name"), F.abs("s_acctbal").alias("acres"), ((k * 6007) % 90000 + 0.19).alias("x0"), ((k * 9173) % 90000 + 0.23).alias("y0"))
    d = d.withColumn("x1", F.col("x0") + 4000 + F.col("unit") % 7 * 6000).withColumn("y1", F.col("y0") + 3000 + F.col("unit") % 5 * 8000)
    edges = s.box_edges(d).withColumnRenamed("poly_id", "feature_id").withColumn("area", F.lit(True))
    near = s.features_within(edges, rivers(t), 900.0, 2000.0)
    return near.join(d.select(F.col("unit").alias("feature_id"), "name", "acres"), "feature_id")


@query("E6_features_near_river", f"""WITH {RIVERS}, {DITCHES}, {BASINS}, nn AS (SELECT DISTINCT f, river FROM fs, rv WHERE {apart_sql(('u0', 'v0', 'u1', 'v1'), ON_RIVER)} <= 1500), mm AS (SELECT DISTINCT f, segment FROM fs, sg WHERE {in_box_sql('u0', 'v0', 'u1', 'v1')}),
 g AS (SELECT river, segment, count(DISTINCT f) AS features, count(DISTINCT name) FILTER (WHERE name <> ' Unknown') AS named FROM nn JOIN mm USING (f) JOIN (SELECT DISTINCT f, name FROM fs) USING (f) GROUP BY 1, 2) SELECT river AS line_id, segment, features, CASE WHEN named > 0 THEN named ELSE features END AS "count" FROM g""")
def e6(t):
    k, c = F.floor(F.col("id") / 2), F.col("id")
    ditches = points(t).select(k.alias("feature_id"), F.when(k % 6 == 0, " Unknown").otherwise(F.concat(F.lit("ditch "), k % 40)).alias("name"), F.lit(False).alias("area"), F.col("px").alias("x0"), F.col("py").alias("y0"),
                               (F.col("px") + c % 40 * 500 + 3).alias("x1"), (F.col("py") + (c * 7 % 40 - 20) * 500 + 7).alias("y1"))
    return s.features_near_river(ditches, rivers(t), basins(t), 1500.0).select("line_id", "segment", "features", F.col("count").cast("bigint").alias("count"))


@query("E6_districts_near_river", f"WITH {RIVERS}, {DISTRICTS}, {IN_CORRIDOR} SELECT river AS line_id, name, round(sum(acres), 2) AS acres FROM cr GROUP BY 1, 2")
def e6c(t):
    return s.district_acres(corridor(t)).withColumn("acres", F.round("acres", 2))


@query("E6_systems_near_river", f"WITH {RIVERS}, {DISTRICTS}, {IN_CORRIDOR} SELECT * FROM (SELECT river AS line_id, name || '/' || k AS name, acres AS area, row_number() OVER (PARTITION BY river ORDER BY acres DESC, name || '/' || k) AS place FROM cr) WHERE place <= 8")
def e6s(t):
    return s.top_by_area(corridor(t).select("line_id", F.concat_ws("/", "name", "feature_id").alias("name"), F.col("acres").alias("area")))


@query("E6_district_acres", "SELECT 'r' || (o_custkey % 7) AS line_id, o_orderpriority AS name, round(sum(o_totalprice), 2) AS acres FROM orders GROUP BY 1, 2")
def e6d(t):
    return s.district_acres(t.read("orders").select(F.concat(F.lit("r"), F.col("o_custkey") % 7).alias("line_id"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("acres"))).withColumn("acres", F.round("acres", 2))


@query("E6_largest_systems", "SELECT * FROM (SELECT 'r' || c_nationkey AS line_id, c_name AS name, c_acctbal AS area, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_name) AS place FROM customer) WHERE place <= 8")
def e6t(t):
    return s.top_by_area(t.read("customer").select(F.concat(F.lit("r"), "c_nationkey").alias("line_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("area")))


@query("E6_use_by_category", """WITH u AS (SELECT 'County ' || (c_nationkey) AS county, c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS irrigation, CASE WHEN c_custkey % 2 = 0 THEN c_custkey::DOUBLE END AS supply FROM customer), x AS (SELECT 'r' || r_regionkey AS line_id, 'county ' || n_nationkey AS county FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT line_id, category, round(sum(af), 4) AS af FROM (SELECT county, 'irrigation' AS category, coalesce(irrigation, 0) AS af FROM u UNION ALL SELECT county, 'supply', coalesce(supply, 0) FROM u) JOIN x ON x.county = lower(u_county(county)) GROUP BY 1, 2 HAVING sum(af) > 0""".replace("lower(u_county(county))", "lower(\"county_1\")").replace("SELECT county, 'irrigation'", "SELECT county AS county_1, 'irrigation'").replace("UNION ALL SELECT county, 'supply'", "UNION ALL SELECT county AS county_1, 'supply'"))
def e6u(t):
    k = F.col("c_custkey")
    u = t.read("customer").select(F.concat(F.lit(" County "), "c_nationkey").alias("county"), F.when(k % 3 > 0, F.col("c_acctbal")).alias("irrigation"), F.when(k % 2 == 0, k.cast("double")).alias("supply"))
    x = t.read("nation").select(F.concat(F.lit("r"), "n_regionkey").alias("line_id"), F.concat(F.lit("county "), "n_nationkey").alias("county"))
    return s.use_by_category(u, x, ["irrigation", "supply"]).withColumn("af", F.round("af", 4))


@query("E7_reservoirs_on_river", """WITH reg AS (SELECT 'r' || (p_partkey % 4) AS line_id, CASE WHEN p_size % 2 = 0 THEN 'Pecos River' ELSE 'Tributary' END AS river, 'Lake ' || p_partkey AS name, 'dam ' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || ' Main' AS dam, p_partkey FROM part WHERE p_partkey % 5 = 0),
 dm AS (SELECT 'r' || (p_partkey % 4) AS line_id, CASE WHEN p_size % 3 > 0 THEN 'PECOS RIVER' ELSE 'Tr-Pecos' END AS river, 'Dam ' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || CASE WHEN p_size = 9 THEN ' Dike' ELSE '' END AS dam_name, p_retailprice AS storage_af FROM part WHERE p_partkey % 3 = 0),
 a AS (SELECT * FROM reg WHERE lower(river) LIKE 'pecos%'), b AS (SELECT * FROM dm WHERE lower(river) LIKE 'pecos%' AND storage_af >= 920 AND dam_name NOT LIKE '%Dike%')
SELECT coalesce(a.line_id, b.line_id) AS line_id, coalesce(a.name, b.dam_name) AS name, coalesce(b.dam_name, a.dam) AS dam, storage_af, CASE WHEN a.line_id IS NOT NULL THEN 'registry' ELSE 'dams' END AS source FROM a FULL OUTER JOIN b ON a.line_id = b.line_id AND starts_with(lower(a.dam), lower(b.dam_name))""")
def e7(t):
    k, z = F.col("p_partkey"), F.col("p_size")
    num = F.lpad(k.cast("string"), 6, "0")
    p = t.read("part")
    reg = p.where(k % 5 == 0).select(F.concat(F.lit("r"), k % 4).alias("line_id"), F.lit("pecos").alias("base"), F.when(z % 2 == 0, "Pecos River").otherwise("Tributary").alias("river"), F.concat(F.lit("Lake "), k).alias("name"), F.concat(F.lit("dam "), num, F.lit(" Main")).alias("dam"))
    dm = p.where(k % 3 == 0).select(F.concat(F.lit("r"), k % 4).alias("line_id"), F.lit("pecos").alias("base"), F.when(z % 3 > 0, "PECOS RIVER").otherwise("Tr-Pecos").alias("river"),
                                    F.concat(F.lit("Dam "), num, F.when(z == 9, " Dike").otherwise("")).alias("dam_name"), F.col("p_retailprice").alias("storage_af"))
    return s.reservoirs_on_river(reg, dm, 920.0)


HAV = "2 * 6371000.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) / 1000"


@query("E8_station_pairs", f"""WITH st AS (SELECT s_suppkey AS id, 33.0 + (s_suppkey * 37 % 97) * 0.03 AS lat, -108.0 + (s_suppkey * 53 % 89) * 0.03 AS lon, (s_suppkey % 9) * 200.0 AS e FROM supplier), ob AS (SELECT c_custkey AS id, 33.0 + (c_custkey * 41 % 101) * 0.03 AS lat, -108.0 + (c_custkey * 59 % 83) * 0.03 AS lon, (c_custkey % 11) * 150.0 AS e FROM customer)
SELECT a.id AS station, b.id AS observer, round({HAV}, 6) AS km FROM st a, ob b WHERE {HAV} <= 12 AND abs(a.e - b.e) <= 450""")
def e8(t):
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    st = t.read("supplier").select(k.alias("site_uid"), (33.0 + (k * 37 % 97) * 0.03).alias("lat"), (-108.0 + (k * 53 % 89) * 0.03).alias("lon"), ((k % 9) * 200.0).alias("elevation_m"))
    ob = t.read("customer").select(c.alias("site_uid"), (33.0 + (c * 41 % 101) * 0.03).alias("lat"), (-108.0 + (c * 59 % 83) * 0.03).alias("lon"), ((c % 11) * 150.0).alias("elevation_m"))
    return s.station_pairs(st, ob)


@query("E9_station_range", """WITH p AS (SELECT site_uid, lat, lon FROM sites WHERE lat IS NOT NULL), q AS (SELECT site_uid, unit, sqrt(pow(greatest(x0 - lon, 0, lon - x1), 2) + pow(greatest(y0 - lat, 0, lat - y1), 2)) AS d FROM p, boxes),
 w AS (SELECT site_uid, min(unit) AS unit FROM q WHERE d = 0 GROUP BY 1) SELECT site_uid, unit AS range_id, 'within' AS match_type FROM w UNION ALL SELECT site_uid, unit, 'nearest' FROM (SELECT *, row_number() OVER (PARTITION BY site_uid ORDER BY d, unit) AS rn FROM q WHERE d <= 0.04 AND site_uid NOT IN (SELECT site_uid FROM w)) WHERE rn = 1""")
def e9(t):
    return s.station_range(t.sites.where("lat IS NOT NULL").select("site_uid", "lat", "lon"), s.box_edges(t.boxes))


@query("E10_river_facts", """WITH f AS (SELECT flowlines.*, totdasqkm / 100 AS lengthkm, comid AS hydroseq, p_size % 6 + 1 AS streamorde FROM flowlines JOIN part ON p_partkey = comid WHERE gnis_id IS NOT NULL), b AS (SELECT gnis_id, sum(lengthkm) AS length_km, min_by(totdasqkm, hydroseq) AS drainage_km2, max(streamorde) AS top FROM f GROUP BY 1),
 j AS (SELECT DISTINCT gnis_id, fromnode FROM f), t AS (SELECT j.gnis_id, f.gnis_name AS nm, max(f.totdasqkm) AS a FROM f JOIN j ON f.tonode = j.fromnode AND f.gnis_id <> j.gnis_id JOIN b ON b.gnis_id = j.gnis_id WHERE f.streamorde >= greatest(3, top - 3) GROUP BY 1, 2),
 tr AS (SELECT gnis_id, string_agg(nm, '; ' ORDER BY k) AS tributaries FROM (SELECT *, row_number() OVER (PARTITION BY gnis_id ORDER BY a DESC, nm) AS k FROM t) WHERE k <= 8 GROUP BY 1),
 tw AS (SELECT gnis_id, string_agg(town, '; ' ORDER BY k) AS towns FROM (SELECT gnis_id, c_name AS town, row_number() OVER (PARTITION BY gnis_id ORDER BY c_acctbal DESC, c_name) AS k FROM (SELECT DISTINCT gnis_id, huc8 FROM f) JOIN customer ON huc8 = 'H' || (c_custkey % 25)) WHERE k <= 6 GROUP BY 1)
SELECT b.gnis_id, round(length_km, 4) AS length_km, drainage_km2, tributaries, towns FROM b LEFT JOIN tr ON tr.gnis_id = b.gnis_id LEFT JOIN tw ON tw.gnis_id = b.gnis_id""")
def e10(t):
    extra = t.read("part").select(F.col("p_partkey").alias("comid"), (F.col("p_size") % 6 + 1).alias("streamorde"))
    f = t.flowlines.join(extra, "comid").withColumn("lengthkm", F.col("totdasqkm") / 100).withColumn("hydroseq", F.col("comid"))
    towns = t.read("customer").select(F.concat(F.lit("H"), F.col("c_custkey") % 25).alias("huc8"), F.col("c_name").alias("town"), F.col("c_acctbal").alias("area"))
    d = s.river_facts(f, towns)
    return d.select("gnis_id", F.round("length_km", 4).alias("length_km"), "drainage_km2", F.array_join("tributaries", "; ").alias("tributaries"), F.array_join("towns", "; ").alias("towns"))


@query("E10_segment_facts", f"""WITH rv0 AS (SELECT 'r' || (p_partkey % 5) AS river, x0, y0, x0 + p_size * 200 + 3 AS x1, y0 + (p_partkey % 50 - 25) * 150 + 7 AS y1 FROM (
  SELECT p_partkey, p_size, ((p_partkey * 3571) % 100000 + 0.37)::DOUBLE AS x0, ((p_partkey * 7177) % 100000 + 0.61)::DOUBLE AS y0 FROM part WHERE p_size % 4 = 0)), {PTS}, {DISTRICTS}, {BASINS}, lns AS (SELECT * FROM rv0), {DIST},
 tw AS (SELECT river, segment, string_agg(town, '; ' ORDER BY area DESC, town) AS towns FROM (SELECT DISTINCT river, segment, 'Town ' || (c_custkey // 3) AS town, abs(c_acctbal) AS area
   FROM (SELECT DISTINCT river, id FROM ds WHERE dist < 600) n JOIN customer ON c_custkey = id JOIN pts USING (id) JOIN sg ON px > bx0 AND px < bx1 AND py > by0 AND py < by1) GROUP BY 1, 2),
 rv AS (SELECT * FROM rv0), big AS (SELECT * FROM db WHERE k % 3 <> 0 AND (bx1 - bx0) * (by1 - by0) / 1e6 > 40), cr AS (SELECT DISTINCT k, name, river FROM (SELECT * FROM big), rv WHERE {in_box_sql(*ON_RIVER)} OR least({", ".join(
    apart_sql(ON_RIVER, e) for e in (("bx0", "by0", "bx1", "by0"), ("bx1", "by0", "bx1", "by1"), ("bx1", "by1", "bx0", "by1"), ("bx0", "by1", "bx0", "by0")))}) <= 250),
 rs AS (SELECT river, segment, string_agg(name, '; ' ORDER BY a DESC, name) AS reservoirs FROM (SELECT river, segment, big.name, max((big.bx1 - big.bx0) * (big.by1 - big.by0) / 1e6) AS a FROM cr JOIN big USING (k) JOIN sg ON big.bx0 <= sg.bx1 AND big.bx1 >= sg.bx0 AND big.by0 <= sg.by1 AND big.by1 >= sg.by0 GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT coalesce(tw.river, rs.river) AS line_id, coalesce(tw.segment, rs.segment) AS segment, coalesce(towns, '') AS towns, coalesce(reservoirs, '') AS reservoirs FROM tw FULL JOIN rs ON tw.river = rs.river AND tw.segment = rs.segment""")
def e10s(t):
    k = F.col("s_suppkey")
    d = t.read("supplier").select(k.alias("unit"), F.concat(F.lit("District "), k % 23).alias("name"), F.when(k % 3 == 0, "Swamp").when(k % 3 == 1, "Reservoir").otherwise("LakePond").alias("ftype"), ((k * 6007) % 90000 + 0.19).alias("x0"), ((k * 9173) % 90000 + 0.23).alias("y0"))
    d = d.withColumn("x1", F.col("x0") + 4000 + F.col("unit") % 7 * 6000).withColumn("y1", F.col("y0") + 3000 + F.col("unit") % 5 * 8000)
    about = d.select(F.col("unit").alias("feature_id"), "name", "ftype", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / 1e6).alias("area_km2"))
    bodies = s.box_edges(d).withColumnRenamed("poly_id", "feature_id").join(about, "feature_id")
    c = F.col("c_custkey")
    towns = points(t).join(t.read("customer").select(c.alias("id"), F.abs("c_acctbal").alias("area")), "id").select(F.concat(F.lit("Town "), F.floor(F.col("id") / 3)).alias("town"), "area", F.col("px").alias("lon"), F.col("py").alias("lat"))
    out = s.segment_facts(rivers(t), basins(t), towns, bodies, 600.0, 250.0, 40.0, 2000.0)
    return out.select("line_id", "segment", F.array_join("towns", "; ").alias("towns"), F.array_join("reservoirs", "; ").alias("reservoirs"))
