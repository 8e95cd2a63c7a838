"""River-network queries."""

from pyspark.sql import functions as F

from tidemark.functions.literals import fixed
from tidemark.operators import maintain as m
from tidemark.operators import network as n
from tidemark.plans.registry import query

DOWN = """dn(comid, cur, steps, name) AS (SELECT comid, tonode, 1, (SELECT gnis_name FROM flowlines f WHERE f.comid = a.tonode) FROM flowlines a WHERE gnis_name IS NULL AND tonode IS NOT NULL
 UNION ALL SELECT dn.comid, f.tonode, steps + 1, (SELECT gnis_name FROM flowlines x WHERE x.comid = f.tonode) FROM dn JOIN flowlines f ON f.comid = dn.cur WHERE dn.name IS NULL AND f.tonode IS NOT NULL AND steps < 40),
 down AS (SELECT f.comid, d.name AS river_name, CAST(d.steps AS BIGINT) AS river_steps FROM flowlines f LEFT JOIN dn d ON d.comid = f.comid AND d.name IS NOT NULL WHERE f.gnis_name IS NULL)"""


@query("F1_downstream_names", f"WITH RECURSIVE {DOWN} SELECT * FROM down")
def f1(t):
    return n.downstream_names(t.flowlines)


@query("F2_name_repair", """SELECT p_partkey AS comid, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name || ' Cañones' END AS name FROM part""")
def f2(t):
    raw = F.when(F.col("p_size") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit(" Ca¿ones ")))
    return t.read("part").select(F.col("p_partkey").alias("comid"), n.repair_name(raw).alias("name"))


RULES = [(1, "rename", "g10", 950.0, None, "Rio Uno", "u1"), (2, "levelpath_unnamed", "s:12", None, ["H1", "H2", "H3", "H4", "H5"], "Rio Dos", "d2"), (3, "rename", "g25", None, ["H5"], "Rio Tres", "t3")]
FIX = """r1 AS (SELECT comid, 1 AS k FROM flowlines WHERE gnis_id = 'g10' AND totdasqkm >= 950), r2 AS (SELECT comid, 2 AS k FROM flowlines WHERE gnis_name IS NULL AND levelpathi = (SELECT levelpathi FROM flowlines WHERE comid = 12) AND huc8 IN ('H1','H2','H3','H4','H5')),
 r3 AS (SELECT comid, 3 AS k FROM flowlines WHERE gnis_id = 'g25' AND huc8 = 'H5'), fk AS (SELECT comid, max(k) AS k FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3) GROUP BY 1),
 fixes AS (SELECT comid, CASE k WHEN 1 THEN 'Rio Uno' WHEN 2 THEN 'Rio Dos' ELSE 'Rio Tres' END AS gnis_name, CASE k WHEN 1 THEN 'u1' WHEN 2 THEN 'd2' ELSE 't3' END AS gnis_id, CASE k WHEN 1 THEN 'rename g10' WHEN 2 THEN 'levelpath_unnamed s:12' ELSE 'rename g25' END AS rule FROM fk)"""


def snapped(t):
    """A station on every seventh reach."""
    return t.flowlines.where("comid % 7 = 5").select(F.concat(F.lit("s:"), "comid").alias("site_uid"), "comid")


def fixes(t):
    rules = fixed(t.spark, RULES, "rule_no int, rule string, match_value string, min_totdasqkm double, huc8 array<string>, new_name string, new_gnis_id string")
    return n.reach_fixes(t.flowlines, snapped(t), rules)


@query("F3_reach_fixes", f"WITH {FIX} SELECT * FROM fixes")
def f3(t):
    return fixes(t)


REACH = f"""{DOWN}, rc AS (SELECT 's:' || f.comid AS site_uid, f.comid, f.gnis_name, coalesce(f.gnis_name, d.river_name) AS river_name, CASE WHEN f.gnis_name IS NOT NULL THEN 0 ELSE d.river_steps END AS river_steps, f.totdasqkm, f.huc8 FROM flowlines f LEFT JOIN down d ON d.comid = f.comid WHERE f.comid % 7 = 5),
 reach AS (SELECT *, CASE WHEN river_name IS NULL THEN NULL WHEN river_steps = 0 THEN 'snap' ELSE 'downstream' END AS river_method FROM rc)"""


def reaches(t):
    return n.site_reaches(snapped(t), t.flowlines, n.downstream_names(t.flowlines))


@query("F4_apply_fixes", f"""WITH RECURSIVE {REACH}, {FIX} SELECT r.site_uid, r.comid, coalesce(x.gnis_name, r.gnis_name) AS gnis_name, coalesce(x.gnis_name, r.river_name) AS river_name, CASE WHEN x.comid IS NOT NULL THEN 0 ELSE river_steps END AS river_steps, totdasqkm, huc8,
 CASE WHEN x.comid IS NOT NULL THEN 'snap' ELSE river_method END AS river_method FROM reach r LEFT JOIN fixes x ON x.comid = r.comid""")
def f4(t):
    return n.apply_reach_fixes(reaches(t), fixes(t))


@query("F4_flowlines_fixed", f"WITH {FIX} SELECT f.comid, coalesce(x.gnis_name, f.gnis_name) AS gnis_name, coalesce(x.gnis_id, f.gnis_id) AS gnis_id FROM flowlines f LEFT JOIN fixes x ON x.comid = f.comid")
def f4f(t):
    return n.apply_fixes(t.flowlines, fixes(t)).select("comid", "gnis_name", "gnis_id")


@query("F5_river_method", f"""WITH RECURSIVE {REACH} SELECT site_uid, comid, river_name, river_method FROM reach UNION ALL SELECT 's:' || comid, NULL, 'Rio Manual', 'manual' FROM flowlines WHERE comid % 14 IN (5, 6)  AND comid % 7 <> 5""")
def f5(t):
    manual = t.flowlines.where("comid % 14 IN (5, 6)").select(F.concat(F.lit("s:"), "comid").alias("site_uid"), F.lit("Rio Manual").alias("river_name"))
    return n.add_manual_rivers(reaches(t), manual).select("site_uid", "comid", "river_name", "river_method")


STATIONS = """stn AS (SELECT 's:' || p_partkey AS site_uid, CASE WHEN p_partkey % 3 = 0 THEN 'usgs' ELSE 'codwr' END AS source, CASE WHEN p_size % 9 = 0 THEN 'well' ELSE 'stream' END AS site_type, CASE WHEN p_size % 4 > 0 THEN 'NM' END AS state,
  'River ' || p_name || CASE WHEN p_size % 6 = 0 THEN ' Ditch' ELSE ' near Town' END AS name, 'Basin' || (p_partkey % 3) AS basin, p_partkey FROM part)"""


def stations(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    return t.read("part").select(F.concat(F.lit("s:"), k).alias("site_uid"), F.when(k % 3 == 0, "usgs").otherwise("codwr").alias("source"), F.when(s % 9 == 0, "well").otherwise("stream").alias("site_type"),
                                 F.when(s % 4 > 0, "NM").alias("state"), F.concat(F.lit("River "), "p_name", F.when(s % 6 == 0, " Ditch").otherwise(" near Town")).alias("name"), F.concat(F.lit("Basin"), k % 3).alias("basin"))


@query("F6_river_segments", f"""WITH RECURSIVE {REACH}, {STATIONS} SELECT r.site_uid, r.comid, river_name, river_method, r.huc8, r.totdasqkm, s.source, s.site_type, s.state, s.name, h.huc8_name FROM reach r JOIN stn s ON s.site_uid = r.site_uid LEFT JOIN (SELECT DISTINCT huc8, huc8_name FROM flowlines) h ON h.huc8 = r.huc8""")
def f6(t):
    return n.river_segments(reaches(t), stations(t), t.flowlines)


SERIES = "srs AS (SELECT 's:' || l_partkey AS site_uid, count(*) AS n_obs FROM lineitem GROUP BY 1)"


def part_series(t):
    obs = t.read("lineitem").select(F.concat(F.lit("s:"), "l_partkey").alias("site_uid"), F.lit("x").alias("source"), F.lit("discharge").alias("variable"), F.lit("daily").alias("interval"), F.lit("mean").alias("statistic"),
                                    F.col("l_shipdate").cast("timestamp").alias("datetime_utc"), F.lit("p").alias("source_param"), F.lit("cfs").alias("unit"))
    return m.site_variables(obs)


def snap_reaches(t):
    """Every station on its own reach; no walk is needed where the reach itself is named."""
    f = t.flowlines
    return f.select(F.concat(F.lit("s:"), "comid").alias("site_uid"), "comid", F.col("gnis_name").alias("river_name"), F.when(F.col("gnis_name").isNotNull(), "snap").alias("river_method"), "huc8", "totdasqkm")


RIVERS = f"""{STATIONS}, {SERIES}, rl AS (SELECT gnis_name, gnis_id, s.site_uid, basin, huc8_name, n_obs FROM flowlines f JOIN stn s ON s.p_partkey = f.comid JOIN srs ON srs.site_uid = s.site_uid WHERE site_type = 'stream' AND gnis_id IS NOT NULL),
 md AS (SELECT gnis_name, gnis_id, min_by(basin, (-c, basin)) AS basin FROM (SELECT gnis_name, gnis_id, basin, count(*) AS c FROM rl GROUP BY 1, 2, 3) GROUP BY 1, 2), mh AS (SELECT gnis_name, gnis_id, min_by(huc8_name, (-c, huc8_name)) AS huc8 FROM (SELECT gnis_name, gnis_id, huc8_name, count(*) AS c FROM rl GROUP BY 1, 2, 3) GROUP BY 1, 2),
 rivers AS (SELECT rl.gnis_id, count(DISTINCT site_uid) AS n, md.basin, mh.huc8, max(n_obs) AS longest, rl.gnis_name AS name FROM rl JOIN md USING (gnis_name, gnis_id) JOIN mh USING (gnis_name, gnis_id) GROUP BY rl.gnis_id, rl.gnis_name, md.basin, mh.huc8 HAVING count(DISTINCT site_uid) >= 2 OR max(n_obs) >= 0.11 * 365.25)"""


def rivers(t):
    seg = n.river_segments(snap_reaches(t), stations(t), t.flowlines)
    return n.list_rivers(seg, t.flowlines, stations(t), part_series(t), 2, 0.11)


@query("F7_list_rivers", f"WITH {RIVERS} SELECT * FROM rivers")
def f7(t):
    return rivers(t)


@query("F8_label_rivers", f"""WITH {RIVERS}, c AS (SELECT name, count(*) AS n0, count(DISTINCT basin) AS b, count(DISTINCT huc8) AS h, count(DISTINCT gnis_id) AS g FROM rivers GROUP BY 1)
SELECT gnis_id, name, CASE WHEN n0 = 1 THEN name WHEN b = n0 THEN name || ' (' || basin || ')' WHEN h = n0 THEN name || ' (' || huc8 || ')' WHEN g = n0 THEN name || ' (' || gnis_id || ')' ELSE name END AS label FROM rivers JOIN c USING (name)""")
def f8(t):
    return n.label_rivers(rivers(t)).select("gnis_id", "name", "label")


@query("F9_read_gauges", f"""WITH {RIVERS} SELECT r.gnis_id, s.site_uid, s.source, s.name, coalesce(CASE WHEN s.p_partkey % 2 = 0 THEN 'CO' END, s.state) AS state, f.totdasqkm, 'snap' AS river_method, f.huc8_name AS segment
FROM rivers r JOIN flowlines f ON f.gnis_id = r.gnis_id JOIN stn s ON s.p_partkey = f.comid JOIN srs ON srs.site_uid = s.site_uid WHERE site_type = 'stream' AND len(list_filter(string_split(lower(r.name), ' '), lambda w : w <> 'river' AND contains(lower(s.name), w))) > 0""")
def f9(t):
    seg = n.river_segments(snap_reaches(t), stations(t), t.flowlines)
    counties = stations(t).select("site_uid", F.when(F.substring("site_uid", 3, 9).cast("bigint") % 2 == 0, "08001").otherwise("99001").alias("county"))
    r = rivers(t).withColumn("label", F.col("name"))
    return n.read_gauges(seg, t.flowlines, r, counties, part_series(t)).drop("label")


@query("F10_order_segments", f"""WITH {RIVERS}, g AS (SELECT f.gnis_id AS river, f.huc8_name AS segment, median(totdasqkm) AS area FROM flowlines f WHERE gnis_id IS NOT NULL GROUP BY 1, 2)
SELECT river, segment, round(area, 6) AS area, row_number() OVER (PARTITION BY river ORDER BY area, segment) AS place FROM g""")
def f10(t):
    g = t.flowlines.where("gnis_id IS NOT NULL").select(F.col("gnis_id").alias("river"), F.col("huc8_name").alias("segment"), "totdasqkm")
    return n.order_segments(g)
