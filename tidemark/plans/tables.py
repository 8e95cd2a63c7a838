"""Adapters that read the given star-schema tables as hydrologic tables.

Every adapter is a projection of whole tables, so its size grows with them. ``CTES`` states the same
adapters in SQL for the checks."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.literals import fixed
from tidemark.session import ensure_checkpoint_dir

CTES: dict[str, str] = {
    # daily readings: fifteen copies (five stations, three publishers) of each gauge
    "obs": """
SELECT CASE l_returnflag WHEN 'A' THEN 'usgs' WHEN 'N' THEN 'usbr_hydrodata' ELSE 'codwr' END AS source,
  (CASE l_returnflag WHEN 'A' THEN 'usgs' WHEN 'N' THEN 'usbr_hydrodata' ELSE 'codwr' END) || ':' || l_suppkey AS site_uid,
  'discharge' AS variable, l_shipdate AS datetime_utc, CAST(NULL AS SMALLINT) AS utc_offset_min, l_quantity AS value,
  'cfs' AS unit, 'daily' AS interval, 'mean' AS statistic, l_linestatus AS qualifier, '00060' AS source_param,
  'ft3/s' AS source_unit, lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-' || l_linenumber AS ingest_run_id,
  CASE WHEN l_linenumber = 7 THEN 10.0 END::DOUBLE AS depth_cm, CAST(year(l_shipdate) AS INTEGER) AS year
FROM lineitem""",
    # provider readings before mapping: a parameter code, a unit, missing codes and odd values
    "raw_obs": """
SELECT CASE l_returnflag WHEN 'A' THEN 'usgs' WHEN 'N' THEN 'nrcs' ELSE 'codwr' END AS source,
  (CASE l_returnflag WHEN 'A' THEN 'usgs' WHEN 'N' THEN 'nrcs' ELSE 'codwr' END) || ':' || l_suppkey AS site_uid,
  'P' || l_linenumber AS source_param, l_shipdate AS datetime_utc,
  CASE WHEN l_quantity = 50 THEN -9999.0 WHEN l_quantity = 49 THEN -0.5 WHEN l_quantity = 48 THEN -99.9
       WHEN l_quantity = 47 THEN NULL ELSE l_quantity * 4 END AS value,
  l_linestatus AS qualifier, CASE WHEN l_tax = 0.08 THEN 'max' END AS statistic, CAST(NULL AS VARCHAR) AS interval,
  CASE WHEN l_tax = 0.0 THEN 5.0 END AS depth_cm,
  lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-' || l_linenumber AS ingest_run_id
FROM lineitem""",
    "crosswalk": """
SELECT * FROM (VALUES
 ('usgs','P1','ft3/s','discharge',1.0,0.0,'mean','daily','identical',NULL),
 ('usgs','P2','ft','stage',1.0,0.0,'mean','daily','identical',NULL),
 ('usgs','P3','degF','air_temp',0.5,-16.0,'mean','daily','equivalent_method',NULL),
 ('usgs','P4','pct','soil_moisture',1.0,0.0,'mean','hourly','identical',20.0),
 ('nrcs','P1','in','swe',1.0,0.0,'instantaneous','daily','identical',NULL),
 ('nrcs','P2','in','snow_depth',1.0,0.0,'instantaneous','daily','identical',NULL),
 ('nrcs','P3','degF','air_temp',0.5,-16.0,'mean','daily','identical',NULL),
 ('nrcs','P5','x','',1.0,0.0,NULL,NULL,'related_not_comparable',NULL),
 ('codwr','P1','ft3/s','discharge',1.0,0.0,'mean','daily','identical',NULL),
 ('codwr','P2','m','stage',3.28084,0.0,'mean','daily','equivalent_method',NULL),
 ('codwr','P6','af','reservoir_storage',1.0,0.0,'instantaneous','daily','related_not_comparable',NULL)
) t(source, source_param, source_unit, variable, factor, "offset", statistic, interval, equivalence, depth_cm)""",
    "overrides": """
SELECT * FROM (VALUES (1,'*','P1','F','diversion'), (2,'usgs:3','P1','','return_flow'), (3,'codwr:5','P2','O','lake_level'))
t(rule_no, site_uid, source_param, qualifier, variable)""",
    "registry": """
SELECT * FROM (VALUES
 ('discharge','cfs',0.0,-0.9,180.0,false,[-999.0]),
 ('stage','ft',NULL,NULL,150.0,true,[-999.0]),
 ('air_temp','degC',-60.0,NULL,60.0,true,[-99.9]),
 ('soil_moisture','pct',0.0,NULL,100.0,false,[-99.9]),
 ('swe','in',0.0,-1.0,150.0,false,[-99.9]),
 ('snow_depth','in',0.0,-2.0,NULL,false,[-99.9]),
 ('diversion','cfs',0.0,NULL,NULL,false,[-99.9]),
 ('return_flow','cfs',NULL,NULL,NULL,true,[]),
 ('reservoir_storage','af',0.0,NULL,NULL,false,[-99.9]))
t(variable, unit, valid_min, noise_floor, valid_max, signed, missing_codes)""",
    "mapped": """
SELECT * FROM (
 SELECT r.source, r.site_uid, r.source_param, r.datetime_utc, r.value * x.factor + x."offset" AS value, r.qualifier,
   coalesce(r.statistic, x.statistic) AS statistic, coalesce(r.interval, x.interval) AS interval,
   coalesce(r.depth_cm, x.depth_cm) AS depth_cm, r.ingest_run_id, x.source_unit,
   coalesce((SELECT max_by(o.variable, o.rule_no) FROM overrides o WHERE o.source_param = r.source_param
      AND (o.site_uid = '*' OR o.site_uid = r.site_uid) AND (o.qualifier = '' OR o.qualifier = r.qualifier)), x.variable) AS variable
 FROM raw_obs r JOIN crosswalk x ON x.source = r.source AND x.source_param = r.source_param WHERE x.variable <> '')""",
    "sites": """
SELECT (CASE s_suppkey % 5 WHEN 0 THEN 'usgs' WHEN 1 THEN 'usbr_hydrodata' WHEN 2 THEN 'codwr' WHEN 3 THEN 'wqp' ELSE 'usace_cwms' END)
   || ':' || CASE WHEN s_suppkey % 5 = 3 THEN 'USGS-' || (80000000 + s_suppkey - 3) ELSE CAST(80000000 + s_suppkey AS VARCHAR) END AS site_uid,
  CASE s_suppkey % 5 WHEN 0 THEN 'usgs' WHEN 1 THEN 'usbr_hydrodata' WHEN 2 THEN 'codwr' WHEN 3 THEN 'wqp' ELSE 'usace_cwms' END AS source,
  CASE WHEN s_suppkey % 5 = 3 THEN 'USGS-' || (80000000 + s_suppkey - 3) ELSE CAST(80000000 + s_suppkey AS VARCHAR) END AS native_id,
  CASE s_suppkey % 4 WHEN 0 THEN 'RIO ' || upper(n_name) || ' BL DAM ' || (s_suppkey // 5) || ', NM' WHEN 1 THEN 'Rio ' || n_name || ' below Dam ' || (s_suppkey // 5)
     WHEN 2 THEN n_name || ' River abv Bridge ' || (s_suppkey // 5) ELSE n_name || ' Creek nr Ft ' || (s_suppkey // 5) END AS name,
  CASE s_suppkey % 7 WHEN 6 THEN 'well' WHEN 5 THEN 'reservoir' ELSE 'stream' END AS site_type,
  CASE WHEN s_nationkey % 3 = 0 THEN 'NM' WHEN s_nationkey % 3 = 1 THEN 'CO' END AS state,
  CASE WHEN s_suppkey % 29 = 0 THEN 0.0 WHEN s_suppkey % 31 = 0 THEN NULL ELSE 33.0 + (s_suppkey // 5 % 40) * 0.1 + (s_suppkey % 5) * 0.0005 END::DOUBLE AS lat,
  CASE WHEN s_suppkey % 29 = 0 THEN 0.0 WHEN s_suppkey % 31 = 0 THEN NULL WHEN s_suppkey % 37 = 0 THEN 106.5
       ELSE -108.0 + (s_suppkey // 5 % 50) * 0.1 + (s_suppkey % 5) * 0.0003 END::DOUBLE AS lon,
  CASE WHEN s_nationkey % 4 <> 3 THEN lpad(CAST(13020000 + s_nationkey * 7 AS VARCHAR), 8, '0') END AS huc8,
  s_suppkey, s_nationkey
FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    # one value per gauge, publisher, station and day
    "copies": """
SELECT 'G' || (l_suppkey // 5) AS gauge, CAST(l_shipdate AS DATE) AS date,
  CASE l_returnflag WHEN 'A' THEN 'usgs' WHEN 'N' THEN 'usbr_hydrodata' ELSE 'codwr' END AS source,
  (CASE l_returnflag WHEN 'A' THEN 'usgs' WHEN 'N' THEN 'usbr_hydrodata' ELSE 'codwr' END) || ':' || l_suppkey AS site_uid,
  avg(l_quantity) AS cfs, min(l_linestatus) AS qualifier
FROM lineitem GROUP BY ALL""",
    "chosen": """
SELECT gauge, date, source, site_uid, cfs FROM (SELECT *, row_number() OVER (PARTITION BY gauge, date ORDER BY
   CASE source WHEN 'usgs' THEN 0 WHEN 'usbr_hydrodata' THEN 1 ELSE 5 END, site_uid) AS rn FROM copies) WHERE rn = 1""",
    "gauges": """
SELECT DISTINCT 'G' || (s_suppkey // 5) AS gauge, 'S' || (s_suppkey // 10) AS segment, 'R' || (s_suppkey // 50) AS river FROM supplier""",
    "gauge_weeks": """
SELECT gauge, week_start, avg(cfs) AS mean_cfs, count(*) AS n_days, (SELECT NULL) AS unused
FROM (SELECT gauge, CAST(date_trunc('week', date) AS DATE) AS week_start, cfs FROM chosen) GROUP BY 1, 2 HAVING count(*) >= 4""",
    # readings through the day, hundreds per station
    "subdaily": """
SELECT 'nwps:' || (user_id // 15) AS site_uid, 'nwps' AS source, CASE WHEN event_type IN ('click', 'view') THEN 'stage' WHEN event_type = 'signup' THEN 'reservoir_storage'
   WHEN event_type = 'error' THEN 'reservoir_elevation' ELSE 'discharge' END AS variable, ts AS datetime_utc, value,
   'hourly' AS interval, event_id FROM events""",
    # reservoir days: storage from order totals, elevation a rising function of storage
    "reservoir_days": """
SELECT 'res' || (o_custkey % 6) AS reservoir, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS stor,
   4000.0 + 100.0 * sqrt(avg(o_totalprice) / 500000.0) AS elev, min(o_orderpriority) AS priority FROM orders GROUP BY 1, 2""",
    # elevation-storage tables of the reservoirs, and reservoir days against them
    "points": """
SELECT 'res' || (p_partkey // 100 % 6) AS reservoir, (4000.0 + p_partkey % 100)::DOUBLE AS elevation_ft, min((p_partkey % 100) * 5000.0 + p_size * 300)::DOUBLE AS storage_af FROM part GROUP BY 1, 2""",
    "segments": """
SELECT reservoir, e0, s0, lead(e0) OVER w AS e1, lead(s0) OVER w AS s1 FROM (SELECT reservoir, elevation_ft AS e0, max(storage_af) OVER (PARTITION BY reservoir ORDER BY elevation_ft) AS s0 FROM points) WINDOW w AS (PARTITION BY reservoir ORDER BY e0)""",
    "pairs": """
SELECT d.reservoir, d.date, d.stor, d.elev, year(d.date) AS y, d.stor - (s0 + (s1 - s0) / (e1 - e0) * (h - e0)) AS off FROM (
 SELECT r.*, least(greatest(elev, lo), hi) AS h, hi FROM reservoir_days r JOIN (SELECT reservoir, min(e0) AS lo, max(e0) AS hi FROM segments GROUP BY 1) USING (reservoir)) d
JOIN segments s ON s.reservoir = d.reservoir AND h >= e0 AND (h < e1 OR (h = hi AND e1 = hi))""",
    "fills": """
SELECT reservoir, date, stor, CASE WHEN year(date) < 1998 THEN 450000.0 ELSE 420000.0 END AS primary_af, CASE WHEN year(date) < 1996 THEN 'low' WHEN priority = '1-URGENT' THEN 'medium' ELSE 'high' END AS confidence,
 CASE reservoir WHEN 'res0' THEN 'dry_flood' WHEN 'res1' THEN 'flood_control' ELSE 'supply' END AS role, 480000.0 AS flood_af, 300000.0 AS cons_af FROM reservoir_days""",
    # stream network: a reach flows to half its number
    "flowlines": """
SELECT p_partkey AS comid, p_partkey AS fromnode, CASE WHEN p_partkey > 0 THEN p_partkey // 2 END AS tonode,
   CASE WHEN p_size % 5 = 0 THEN 'River ' || p_name END AS gnis_name, CASE WHEN p_size % 5 = 0 THEN 'g' || (p_partkey % 40) END AS gnis_id,
   CASE WHEN p_size % 11 = 0 THEN 2 ELSE 1 END AS divergence, p_retailprice AS totdasqkm, p_partkey % 97 AS levelpathi,
   'H' || (p_partkey % 20) AS huc8, 'Basin ' || (p_partkey % 20) AS huc8_name FROM part""",
    # a dense daily series per watershed: every calendar day of the order book
    "unit_days": """
SELECT 'H' || (o_custkey % 6) AS unit, CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS value,
   count(*) AS n FROM orders GROUP BY 1, 2""",
    # the same summed over watersheds: a nearly unbroken daily series
    "state_days": """
SELECT 'NM' AS unit, date, sum(value) AS value FROM unit_days GROUP BY 1, 2""",
    # grid cells: one value per cell and month
    "grid": """
SELECT CAST(l_partkey % 12 AS INTEGER) AS iy, CAST(l_suppkey % 10 AS INTEGER) AS ix, 33.0 + (l_partkey % 12) * 0.25 AS lat, -108.0 + (l_suppkey % 10) * 0.25 AS lon,
   CAST(date_trunc('month', l_shipdate) AS DATE) AS date, avg(CASE WHEN l_quantity <= 48 THEN l_quantity END) AS value
FROM lineitem GROUP BY 1, 2, 3, 4, 5""",
    # axis-aligned watersheds, one per region
    "boxes": """
SELECT 'W' || r_regionkey AS unit, -108.23 + r_regionkey * 0.5 AS x0, -107.57 + r_regionkey * 0.5 AS x1, 33.06 + r_regionkey * 0.3 AS y0, 34.61 + r_regionkey * 0.3 AS y1 FROM region""",
}


class Tables:
    """Lazy handles to the given tables and their hydrologic adapters."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def keep(self, *names: str) -> None:
        """Write adapters to the shared folder, in order, and read them from there: for queries that use one many times."""
        for name in names:
            folder = f"{ensure_checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
            getattr(self, name).write.parquet(folder)
            setattr(self, name, self.spark.read.parquet(folder))

    @staticmethod
    def _publisher(second: str = "usbr_hydrodata"):
        return (F.when(F.col("l_returnflag") == "A", "usgs").when(F.col("l_returnflag") == "N", second)
                 .otherwise("codwr"))

    @staticmethod
    def _run_id():
        return F.concat(F.lpad(F.col("l_orderkey").cast("string"), 10, "0"), F.lit("-"), F.col("l_linenumber"))

    @cached_property
    def obs(self) -> DataFrame:
        src = self._publisher()
        return self.read("lineitem").select(
            src.alias("source"), F.concat(src, F.lit(":"), "l_suppkey").alias("site_uid"),
            F.lit("discharge").alias("variable"), F.col("l_shipdate").cast("timestamp").alias("datetime_utc"),
            F.lit(None).cast("smallint").alias("utc_offset_min"), F.col("l_quantity").alias("value"),
            F.lit("cfs").alias("unit"), F.lit("daily").alias("interval"), F.lit("mean").alias("statistic"),
            F.col("l_linestatus").alias("qualifier"), F.lit("00060").alias("source_param"),
            F.lit("ft3/s").alias("source_unit"), self._run_id().alias("ingest_run_id"),
            F.when(F.col("l_linenumber") == 7, 10.0).alias("depth_cm"), F.year("l_shipdate").alias("year"))

    @cached_property
    def raw_obs(self) -> DataFrame:
        src, q = self._publisher("nrcs"), F.col("l_quantity")
        value = (F.when(q == 50, -9999.0).when(q == 49, -0.5).when(q == 48, -99.9)
                  .when(q == 47, None).otherwise(q * 4))
        return self.read("lineitem").select(
            src.alias("source"), F.concat(src, F.lit(":"), "l_suppkey").alias("site_uid"),
            F.concat(F.lit("P"), "l_linenumber").alias("source_param"), F.col("l_shipdate").cast("timestamp").alias("datetime_utc"),
            value.alias("value"), F.col("l_linestatus").alias("qualifier"),
            F.when(F.col("l_tax") == 0.08, "max").alias("statistic"), F.lit(None).cast("string").alias("interval"),
            F.when(F.col("l_tax") == 0.0, 5.0).alias("depth_cm"), self._run_id().alias("ingest_run_id"))

    @cached_property
    def crosswalk(self) -> DataFrame:
        return fixed(self.spark, [
            ("usgs", "P1", "ft3/s", "discharge", 1.0, 0.0, "mean", "daily", "identical", None),
            ("usgs", "P2", "ft", "stage", 1.0, 0.0, "mean", "daily", "identical", None),
            ("usgs", "P3", "degF", "air_temp", 0.5, -16.0, "mean", "daily", "equivalent_method", None),
            ("usgs", "P4", "pct", "soil_moisture", 1.0, 0.0, "mean", "hourly", "identical", 20.0),
            ("nrcs", "P1", "in", "swe", 1.0, 0.0, "instantaneous", "daily", "identical", None),
            ("nrcs", "P2", "in", "snow_depth", 1.0, 0.0, "instantaneous", "daily", "identical", None),
            ("nrcs", "P3", "degF", "air_temp", 0.5, -16.0, "mean", "daily", "identical", None),
            ("nrcs", "P5", "x", "", 1.0, 0.0, None, None, "related_not_comparable", None),
            ("codwr", "P1", "ft3/s", "discharge", 1.0, 0.0, "mean", "daily", "identical", None),
            ("codwr", "P2", "m", "stage", 3.28084, 0.0, "mean", "daily", "equivalent_method", None),
            ("codwr", "P6", "af", "reservoir_storage", 1.0, 0.0, "instantaneous", "daily", "related_not_comparable", None),
        ], "source string, source_param string, source_unit string, variable string, factor double, offset double, "
           "statistic string, interval string, equivalence string, depth_cm double")

    @cached_property
    def overrides(self) -> DataFrame:
        return fixed(self.spark, [(1, "*", "P1", "F", "diversion"), (2, "usgs:3", "P1", "", "return_flow"),
                                  (3, "codwr:5", "P2", "O", "lake_level")],
                     "rule_no int, site_uid string, source_param string, qualifier string, variable string")

    @cached_property
    def registry(self) -> DataFrame:
        return fixed(self.spark, [
            ("discharge", "cfs", 0.0, -0.9, 180.0, False, [-999.0]),
            ("stage", "ft", None, None, 150.0, True, [-999.0]),
            ("air_temp", "degC", -60.0, None, 60.0, True, [-99.9]),
            ("soil_moisture", "pct", 0.0, None, 100.0, False, [-99.9]),
            ("swe", "in", 0.0, -1.0, 150.0, False, [-99.9]),
            ("snow_depth", "in", 0.0, -2.0, None, False, [-99.9]),
            ("diversion", "cfs", 0.0, None, None, False, [-99.9]),
            ("return_flow", "cfs", None, None, None, True, []),
            ("reservoir_storage", "af", 0.0, None, None, False, [-99.9]),
        ], "variable string, unit string, valid_min double, noise_floor double, valid_max double, signed boolean, "
           "missing_codes array<double>")

    @cached_property
    def mapped(self) -> DataFrame:
        from tidemark.operators.quality import apply_crosswalk, override_variable

        out = apply_crosswalk(self.raw_obs, self.crosswalk, self.registry)
        return override_variable(out, self.overrides, self.registry)

    @cached_property
    def sites(self) -> DataFrame:
        k, m5 = F.col("s_suppkey"), F.col("s_suppkey") % 5
        src = (F.when(m5 == 0, "usgs").when(m5 == 1, "usbr_hydrodata").when(m5 == 2, "codwr").when(m5 == 3, "wqp")
                .otherwise("usace_cwms"))
        native = F.when(m5 == 3, F.concat(F.lit("USGS-"), (80000000 + k - 3))).otherwise((80000000 + k).cast("string"))
        block = F.floor(k / 5)
        name = (F.when(k % 4 == 0, F.concat(F.lit("RIO "), F.upper("n_name"), F.lit(" BL DAM "), block, F.lit(", NM")))
                 .when(k % 4 == 1, F.concat(F.lit("Rio "), "n_name", F.lit(" below Dam "), block))
                 .when(k % 4 == 2, F.concat("n_name", F.lit(" River abv Bridge "), block))
                 .otherwise(F.concat("n_name", F.lit(" Creek nr Ft "), block)))
        zero, gone = k % 29 == 0, k % 31 == 0
        lat = F.when(zero, 0.0).when(gone, None).otherwise(33.0 + (block % 40) * 0.1 + m5 * 0.0005)
        lon = (F.when(zero, 0.0).when(gone, None).when(k % 37 == 0, 106.5)
                .otherwise(-108.0 + (block % 50) * 0.1 + m5 * 0.0003))
        nk = F.col("s_nationkey")
        joined = self.read("supplier").join(self.read("nation"), F.col("n_nationkey") == nk)
        return joined.select(
            F.concat(src, F.lit(":"), native).alias("site_uid"), src.alias("source"), native.alias("native_id"),
            name.alias("name"),
            F.when(k % 7 == 6, "well").when(k % 7 == 5, "reservoir").otherwise("stream").alias("site_type"),
            F.when(nk % 3 == 0, "NM").when(nk % 3 == 1, "CO").alias("state"), lat.alias("lat"), lon.alias("lon"),
            F.when(nk % 4 != 3, F.lpad((13020000 + nk * 7).cast("string"), 8, "0")).alias("huc8"), "s_suppkey", "s_nationkey")

    @cached_property
    def copies(self) -> DataFrame:
        src = self._publisher()
        return (self.read("lineitem").groupBy(
            F.concat(F.lit("G"), F.floor(F.col("l_suppkey") / 5)).alias("gauge"), F.to_date("l_shipdate").alias("date"),
            src.alias("source"), F.concat(src, F.lit(":"), "l_suppkey").alias("site_uid"))
            .agg(F.avg("l_quantity").alias("cfs"), F.min("l_linestatus").alias("qualifier")))

    @cached_property
    def chosen(self) -> DataFrame:
        from tidemark.operators.flow import pick_copy

        return pick_copy(self.copies.drop("qualifier"))

    @cached_property
    def gauges(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.read("supplier").select(
            F.concat(F.lit("G"), F.floor(k / 5)).alias("gauge"), F.concat(F.lit("S"), F.floor(k / 10)).alias("segment"),
            F.concat(F.lit("R"), F.floor(k / 50)).alias("river")).distinct()

    @cached_property
    def gauge_weeks(self) -> DataFrame:
        from tidemark.operators.flow import gauge_weekly

        return gauge_weekly(self.chosen)

    @cached_property
    def subdaily(self) -> DataFrame:
        kind = F.col("event_type")
        return self.read("events").select(
            F.concat(F.lit("nwps:"), F.floor(F.col("user_id") / 15)).alias("site_uid"), F.lit("nwps").alias("source"),
            F.when(kind.isin("click", "view"), "stage").when(kind == "signup", "reservoir_storage")
             .when(kind == "error", "reservoir_elevation").otherwise("discharge").alias("variable"),
            F.col("ts").cast("timestamp").alias("datetime_utc"), "value", F.lit("hourly").alias("interval"), "event_id")

    @cached_property
    def reservoir_days(self) -> DataFrame:
        mean = F.avg("o_totalprice")
        return self.read("orders").groupBy(
            F.concat(F.lit("res"), F.col("o_custkey") % 6).alias("reservoir"), F.to_date("o_orderdate").alias("date")
        ).agg(mean.alias("stor"), (4000.0 + 100.0 * F.sqrt(mean / 500000.0)).alias("elev"),
              F.min("o_orderpriority").alias("priority"))

    @cached_property
    def points(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.read("part").groupBy(F.concat(F.lit("res"), F.floor(k / 100) % 6).alias("reservoir"), (4000.0 + k % 100).alias("elevation_ft")).agg(
            F.min((k % 100) * 5000.0 + F.col("p_size") * 300).alias("storage_af"))

    @cached_property
    def pairs(self) -> DataFrame:
        from tidemark.operators.reservoir import table_lookup

        d = table_lookup(self.reservoir_days, self.points, "elev").where(F.col("table_af").isNotNull())
        return d.select("reservoir", "date", "stor", "elev", F.year("date").alias("y"), (F.col("stor") - F.col("table_af")).alias("off"))

    @cached_property
    def fills(self) -> DataFrame:
        res, y = F.col("reservoir"), F.year("date")
        return self.reservoir_days.select(
            "reservoir", "date", "stor", F.when(y < 1998, 450000.0).otherwise(420000.0).alias("primary_af"),
            F.when(y < 1996, "low").when(F.col("priority") == "1-URGENT", "medium").otherwise("high").alias("confidence"),
            F.when(res == "res0", "dry_flood").when(res == "res1", "flood_control").otherwise("supply").alias("role"),
            F.lit(480000.0).alias("flood_af"), F.lit(300000.0).alias("cons_af"))

    @cached_property
    def flowlines(self) -> DataFrame:
        k = F.col("p_partkey")
        named = F.col("p_size") % 5 == 0
        return self.read("part").select(
            k.alias("comid"), k.alias("fromnode"), F.when(k > 0, F.floor(k / 2)).alias("tonode"),
            F.when(named, F.concat(F.lit("River "), "p_name")).alias("gnis_name"),
            F.when(named, F.concat(F.lit("g"), k % 40)).alias("gnis_id"),
            F.when(F.col("p_size") % 11 == 0, 2).otherwise(1).alias("divergence"),
            F.col("p_retailprice").alias("totdasqkm"), (k % 97).alias("levelpathi"),
            F.concat(F.lit("H"), k % 20).alias("huc8"), F.concat(F.lit("Basin "), k % 20).alias("huc8_name"))

    @cached_property
    def unit_days(self) -> DataFrame:
        return (self.read("orders").groupBy(F.concat(F.lit("H"), F.col("o_custkey") % 6).alias("unit"),
                                            F.to_date("o_orderdate").alias("date"))
                .agg(F.sum("o_totalprice").alias("value"), F.count("*").alias("n")))

    @cached_property
    def state_days(self) -> DataFrame:
        return self.unit_days.groupBy(F.lit("NM").alias("unit"), "date").agg(F.sum("value").alias("value"))

    @cached_property
    def grid(self) -> DataFrame:
        iy, ix = (F.col("l_partkey") % 12).cast("int"), (F.col("l_suppkey") % 10).cast("int")
        return (self.read("lineitem").groupBy(
            iy.alias("iy"), ix.alias("ix"), (33.0 + iy * 0.25).alias("lat"), (-108.0 + ix * 0.25).alias("lon"),
            F.to_date(F.date_trunc("month", "l_shipdate")).alias("date"))
            .agg(F.avg(F.when(F.col("l_quantity") <= 48, F.col("l_quantity"))).alias("value")))

    @cached_property
    def boxes(self) -> DataFrame:
        k = F.col("r_regionkey")
        return self.read("region").select(
            F.concat(F.lit("W"), k).alias("unit"), (-108.23 + k * 0.5).alias("x0"), (-107.57 + k * 0.5).alias("x1"),
            (33.06 + k * 0.3).alias("y0"), (34.61 + k * 0.3).alias("y1"))
