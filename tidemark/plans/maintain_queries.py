"""Archive upkeep queries."""

import uuid

from pyspark.sql import functions as F

from tidemark.functions.literals import fixed
from tidemark.operators import maintain as m
from tidemark.plans.registry import query
from tidemark.schema import STORED
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import manifest
from tidemark.sources.archive import coerce, read_observations

def stored_archive(t, *loads):
    """An archive with a manifest, written in some loads."""
    root = f"{ensure_checkpoint_dir(t.spark)}/archive-{uuid.uuid4().hex}"
    for k, df in enumerate(loads):
        manifest.write(coerce(df, STORED), root, f"load{k}", m.PARTITIONS)
    return root


def rows_by_partition(t, root, job):
    """Rows of each partition in force, and those that lie in files of the job."""
    rows = read_observations(t.spark, root).withColumn("of_job", F.col("_metadata.file_path").contains(f"version={job}/"))
    return rows.groupBy(*m.PARTITIONS).agg(F.count("*").alias("n"), F.count_if("of_job").alias("n_rewritten"))


LATEST = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_uid, variable, datetime_utc, interval, statistic, depth_cm
 ORDER BY ingest_run_id DESC, {tie}) AS rn FROM obs) WHERE rn = 1)"""


@query("C1_compact", """
SELECT site_uid, CAST(datetime_utc AS VARCHAR) AS datetime_utc, depth_cm, value, ingest_run_id FROM (SELECT *, row_number() OVER (PARTITION BY site_uid, variable, datetime_utc,
  interval, statistic, depth_cm ORDER BY ingest_run_id DESC, value DESC) AS rn FROM obs) WHERE rn = 1""")
def c1(t):
    # two loads into the same partitions
    second = F.col("ingest_run_id").endswith("2") | F.col("ingest_run_id").endswith("5")
    root = stored_archive(t, t.obs.where(~second), t.obs.where(second))
    m.compact_archive(t.spark, root, "compact")
    return read_observations(t.spark, root).select("site_uid", "datetime_utc", "depth_cm", "value", "ingest_run_id")


@query("C1_compaction_report", """
SELECT source, variable, CAST(year AS BIGINT) AS year, CAST(sum(c) AS BIGINT) AS rows_before, CAST(sum(c) - count(*) AS BIGINT) AS removed FROM (
 SELECT source, variable, year, site_uid, datetime_utc, interval, statistic, depth_cm, count(*) AS c FROM obs GROUP BY ALL) GROUP BY ALL""")
def c1r(t):
    return m.compaction_report(t.obs)


@query("C2_compact_tables", """
SELECT DISTINCT l_orderkey AS sample, l_quantity AS value, CASE WHEN l_returnflag = 'N' THEN l_linestatus END AS lab FROM lineitem""")
def c2(t):
    li = t.read("lineitem")
    first = li.where("l_returnflag <> 'N'").select(F.col("l_orderkey").alias("sample"), F.col("l_quantity").alias("value"))
    second = li.where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("sample"), F.col("l_quantity").alias("value"), F.col("l_linestatus").alias("lab"))
    return m.compact_tables([first, second, first])


CODE = "(NOT g.signed AND len(list_filter(list_concat([-9999.0, -99999.0], g.missing_codes), lambda c : abs(m.value - c) < 1e-6)) > 0)"


@query("C3_purge_counts", f"""
SELECT m.source, m.variable, count(*) AS removed FROM mapped m JOIN registry g ON g.variable = m.variable WHERE {CODE} GROUP BY ALL""")
def c3(t):
    return m.purge_counts(t.mapped, t.registry)


@query("C3_purge_rewrite", f"""
WITH f AS (SELECT m.*, year(m.datetime_utc) AS y, coalesce({CODE}, false) AS bad FROM mapped m LEFT JOIN registry g ON g.variable = m.variable)
SELECT source, variable, y AS year, count(*) AS rows_kept FROM f WHERE NOT bad AND (source, variable, y) IN (SELECT (source, variable, y) FROM f WHERE bad) GROUP BY ALL""")
def c3w(t):
    return (m.purge(t.mapped.withColumn("year", F.year("datetime_utc")), t.registry).groupBy("source", "variable", "year").agg(F.count("*").alias("rows_kept")))


@query("C4_relabel_series", """
SELECT variable, moved_from, count(*) AS n FROM (SELECT CASE WHEN source_param = '00060' AND qualifier = 'F' AND site_uid = 'usgs:3' THEN 'diversion' WHEN site_uid = 'codwr:5' THEN 'return_flow' ELSE variable END AS variable,
  CASE WHEN (qualifier = 'F' AND site_uid = 'usgs:3') OR site_uid = 'codwr:5' THEN variable END AS moved_from FROM obs) GROUP BY ALL""")
def c4(t):
    rules = fixed(t.spark, [(1, "usgs:3", "00060", "F", "diversion"), (2, "codwr:5", "00060", "", "return_flow")],
                  "rule_no int, site_uid string, source_param string, qualifier string, variable string")
    return m.relabel(t.obs, rules, t.registry).groupBy("variable", "moved_from").agg(F.count("*").alias("n"))


@query("C3_purge_stored", f"""
WITH f AS (SELECT m.*, year(m.datetime_utc) AS y, coalesce({CODE}, false) AS bad FROM mapped m LEFT JOIN registry g ON g.variable = m.variable)
SELECT source, variable, y AS year, count(*) AS n, CAST(sum(CASE WHEN (source, variable, y) IN (SELECT (source, variable, y) FROM f WHERE bad) THEN 1 ELSE 0 END) AS BIGINT) AS n_rewritten FROM f WHERE NOT bad GROUP BY ALL""")
def c3s(t):
    root = stored_archive(t, t.mapped.withColumn("year", F.year("datetime_utc")))
    m.purge_archive(t.spark, root, t.registry, "purge")
    return rows_by_partition(t, root, "purge")


MOVED = """SELECT source, year, CASE WHEN qualifier = 'F' AND site_uid = 'usgs:3' THEN 'diversion' WHEN site_uid = 'codwr:5' THEN 'return_flow' ELSE variable END AS variable, variable AS old FROM obs"""


@query("C4_relabel_stored", f"""WITH r AS ({MOVED}), t AS (SELECT DISTINCT source, old, year FROM r WHERE variable <> old)
SELECT source, variable, CAST(year AS BIGINT) AS year, count(*) AS n, CAST(sum(CASE WHEN (source, old, year) IN (SELECT (source, old, year) FROM t) THEN 1 ELSE 0 END) AS BIGINT) AS n_rewritten FROM r GROUP BY source, variable, year""")
def c4s(t):
    root = stored_archive(t, t.obs)
    rules = fixed(t.spark, [(1, "usgs:3", "00060", "F", "diversion"), (2, "codwr:5", "00060", "", "return_flow")],
                  "rule_no int, site_uid string, source_param string, qualifier string, variable string")
    m.relabel_archive(t.spark, root, rules, t.registry, "relabel")
    return rows_by_partition(t, root, "relabel")


@query("C5_rewrite_ids", """
SELECT regexp_replace(site_uid, ':USGS-', ':') AS site_uid, site_uid LIKE '%:USGS-%' AS changed FROM sites""")
def c5(t):
    return m.rewrite_ids(t.sites.select("site_uid"), "site_uid", ":USGS-", ":")


@query("C6_site_variables", """
SELECT site_uid, source, variable, interval, statistic, CAST(min(datetime_utc) AS VARCHAR) AS first_datetime, CAST(max(datetime_utc) AS VARCHAR) AS last_datetime, count(*) AS n_obs,
 min(source_param) AS source_param, min(unit) AS unit FROM obs GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY site_uid, source, variable, interval, statistic"))
def c6(t):
    return m.site_variables(t.obs)


@query("C7_coverage", "SELECT source, variable, CAST(year AS BIGINT) AS year, count(DISTINCT site_uid) AS n_sites, count(*) AS n_obs FROM obs GROUP BY ALL")
def c7(t):
    return m.coverage(t.obs)


SERIES = "series AS (SELECT site_uid, source, variable, interval, min(datetime_utc) AS first_datetime, max(datetime_utc) AS last_datetime, count(*) AS n_obs FROM obs GROUP BY ALL)"
STATIONS = "stations AS (SELECT p || ':' || s_suppkey AS site_uid, p AS source FROM supplier, (VALUES ('usgs'), ('codwr'), ('nwps')) v(p) WHERE s_suppkey % 10 <> 9)"


def stations(t):
    """Station rows for three publishers, one of which has no readings; some stations are missing."""
    names = fixed(t.spark, [("usgs",), ("codwr",), ("nwps",)], "source string")
    s = t.read("supplier").where("s_suppkey % 10 <> 9").select("s_suppkey")
    each = s.withColumn("source", F.explode(F.array(F.lit("usgs"), F.lit("codwr"), F.lit("nwps"))))
    return each.join(names, "source").select(F.concat_ws(":", "source", "s_suppkey").alias("site_uid"), "source")


@query("C8_source_report", f"""
WITH {SERIES}, {STATIONS} SELECT s.source, count(DISTINCT s.site_uid) AS sites, count(DISTINCT v.variable) AS variables, CAST(coalesce(sum(v.n_obs), 0) AS BIGINT) AS n_obs,
 CAST(min(first_datetime) AS VARCHAR) AS first_datetime, CAST(max(last_datetime) AS VARCHAR) AS last_datetime FROM stations s LEFT JOIN series v ON v.site_uid = s.site_uid GROUP BY 1""")
def c8(t):
    return m.source_report(stations(t), m.site_variables(t.obs))


@query("C8_site_counts", f"""
WITH {STATIONS}, want AS (SELECT * FROM (VALUES ('usgs', 50), ('codwr', 500000), ('iem_dcp', 10)) w(source, minimum)), n AS (SELECT source, count(*) AS actual FROM stations GROUP BY 1)
SELECT source, CAST(minimum AS BIGINT) AS minimum, coalesce(actual, 0) AS actual, CASE WHEN coalesce(actual, 0) >= minimum THEN 'yes' WHEN coalesce(actual, 0) > 0 THEN 'no' ELSE 'not loaded' END AS ok
FROM want LEFT JOIN n USING (source)""")
def c8n(t):
    want = fixed(t.spark, [("usgs", 50), ("codwr", 500000), ("iem_dcp", 10)], "source string, minimum int")
    return m.site_count_check(stations(t), want)


@query("C8_landmarks", f"""
WITH {SERIES}, marks AS (SELECT * FROM (VALUES ('usgs:1','discharge','daily',DATE '1995-03-01',100), ('codwr:2','discharge',NULL,DATE '1990-01-01',5), ('usgs:none','discharge','daily',DATE '1995-01-01',1))
 w(site_uid, variable, interval, first_by, min_rows))
SELECT w.site_uid, w.variable, CAST(first_by AS VARCHAR) AS first_by, CAST(min_rows AS BIGINT) AS min_rows, CAST(CAST(min(first_datetime) AS DATE) AS VARCHAR) AS first_date, CAST(coalesce(sum(n_obs), 0) AS BIGINT) AS n_rows,
 CASE WHEN min(first_datetime) IS NULL THEN 'not loaded' WHEN CAST(min(first_datetime) AS DATE) <= first_by AND sum(n_obs) >= min_rows THEN 'yes' ELSE 'no' END AS ok
FROM marks w LEFT JOIN series s ON s.site_uid = w.site_uid AND s.variable = w.variable AND (w.interval IS NULL OR w.interval = s.interval) GROUP BY w.site_uid, w.variable, first_by, min_rows""")
def c8l(t):
    marks = fixed(t.spark, [("usgs:1", "discharge", "daily", "1995-03-01", 100), ("codwr:2", "discharge", None, "1990-01-01", 5),
                            ("usgs:none", "discharge", "daily", "1995-01-01", 1)],
                  "site_uid string, variable string, interval string, first_by date, min_rows int")
    return m.landmark_check(m.site_variables(t.obs), marks)


FETCHES = """fetches AS (SELECT o_orderkey AS fetch_id, 'src' || (o_custkey % 9) AS source, 'site' || (o_custkey % 300) AS site_uid, 'v' || (o_custkey % 3) AS variable,
 CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'error' ELSE 'empty' END AS status, CAST(floor(o_totalprice) AS BIGINT) AS bytes, o_custkey AS n_rows, o_orderdate AS fetched_at,
 o_orderdate - INTERVAL 3 DAY AS window_end FROM orders)"""


def fetches(t):
    s = F.col("o_orderstatus")
    return t.read("orders").select(
        F.col("o_orderkey").alias("fetch_id"), F.concat(F.lit("src"), F.col("o_custkey") % 9).alias("source"),
        F.concat(F.lit("site"), F.col("o_custkey") % 300).alias("site_uid"), F.concat(F.lit("v"), F.col("o_custkey") % 3).alias("variable"),
        F.when(s == "F", "ok").when(s == "O", "error").otherwise("empty").alias("status"), F.floor("o_totalprice").cast("bigint").alias("bytes"),
        F.col("o_custkey").alias("n_rows"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"),
        (F.col("o_orderdate") - F.expr("INTERVAL 3 DAYS")).cast("timestamp").alias("window_end"))


@query("C9_fetch_stats", f"""WITH {FETCHES} SELECT source, status, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(min(fetched_at) AS VARCHAR) AS first,
 CAST(max(fetched_at) AS VARCHAR) AS last FROM fetches GROUP BY 1, 2""")
def c9(t):
    return m.fetch_stats(fetches(t))


@query("C9_last_window", f"WITH {FETCHES} SELECT source, site_uid, variable, CAST(max(window_end) AS VARCHAR) AS window_end FROM fetches WHERE status = 'ok' GROUP BY 1, 2, 3")
def c9w(t):
    return m.last_window_end(fetches(t))


@query("C9_last_attempt", f"""WITH {FETCHES} SELECT source, site_uid, variable, status, CAST(fetched_at AS VARCHAR) AS fetched_at FROM (SELECT *, row_number() OVER (PARTITION BY source, site_uid, variable
 ORDER BY fetched_at DESC, fetch_id DESC) AS rn FROM fetches) WHERE rn = 1""")
def c9a(t):
    return m.last_attempt(fetches(t))


@query("C10_update_plan", """
WITH runs AS (SELECT CASE l_returnflag WHEN 'A' THEN 'usgs' WHEN 'N' THEN 'usbr_hydrodata' ELSE 'codwr' END AS source, max(l_shipdate) + INTERVAL 20 DAY AS last_run FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
 newest AS (SELECT source, CAST(max(datetime_utc) AS DATE) AS newest FROM obs WHERE datetime_utc <= TIMESTAMP '2002-01-01' + INTERVAL 2 DAY GROUP BY 1),
 policy AS (SELECT * FROM (VALUES ('usgs', false), ('usbr_hydrodata', true), ('codwr', false)) p(source, skip))
SELECT source, CASE WHEN skip THEN 'skip' WHEN last_run IS NULL THEN 'never run' ELSE 'delta' END AS action,
 CASE WHEN NOT skip AND last_run IS NOT NULL THEN CAST((CASE WHEN date_diff('day', newest, CAST(last_run AS DATE)) BETWEEN 1 AND 90 THEN newest ELSE CAST(last_run AS DATE) END) - 2 AS VARCHAR) END AS since,
 CASE WHEN NOT skip AND last_run IS NOT NULL THEN CASE WHEN date_diff('day', newest, CAST(last_run AS DATE)) BETWEEN 1 AND 90 THEN 'newest data' ELSE 'last run' END END AS basis
FROM policy LEFT JOIN runs USING (source) LEFT JOIN newest USING (source)""")
def c10(t):
    runs = (t.obs.where("source <> 'codwr'").select("source", F.lit("fetch").alias("command"), F.lit("ok").alias("status"),
            (F.col("datetime_utc") + F.expr("INTERVAL 20 DAYS")).alias("started_at")))
    policy = fixed(t.spark, [("usgs", False), ("usbr_hydrodata", True), ("codwr", False)], "source string, skip boolean")
    return m.plan_update(policy, m.last_successful_run(runs), m.site_variables(t.obs), F.lit("2002-01-01").cast("timestamp"), 2)


@query("C12_growth_log", """
WITH b AS (SELECT source, count(*) AS n FROM obs WHERE year < 2000 GROUP BY 1), a AS (SELECT source, count(*) AS n FROM (SELECT DISTINCT source, site_uid, datetime_utc, depth_cm FROM obs) GROUP BY 1),
 f AS (SELECT source, count(*) AS n FROM obs GROUP BY 1), j AS (SELECT source, b.n AS rows_before, a.n AS rows_after, f.n AS rows_fetched FROM a JOIN b USING (source) JOIN f USING (source)),
 u AS (SELECT * FROM j UNION ALL SELECT 'all sources', sum(rows_before), sum(rows_after), sum(rows_fetched) FROM j)
SELECT source, CAST(rows_before AS BIGINT) AS rows_before, CAST(rows_after AS BIGINT) AS rows_after, CAST(rows_fetched AS BIGINT) AS rows_fetched, CAST(rows_after - rows_before AS BIGINT) AS net_new,
 CAST(rows_fetched - (rows_after - rows_before) AS BIGINT) AS repeats FROM u""")
def c12(t):
    count = lambda d: d.groupBy("source").agg(F.count("*").alias("n"))
    return m.growth_log(count(t.obs.where("year < 2000")), count(t.obs.select("source", "site_uid", "datetime_utc", "depth_cm").distinct()), count(t.obs))


@query("C13_orphans", f"""WITH {STATIONS} SELECT source, count(DISTINCT site_uid) AS orphans FROM obs o WHERE NOT EXISTS (SELECT 1 FROM stations s WHERE s.site_uid = o.site_uid) GROUP BY 1""")
def c13(t):
    return m.orphan_sites(t.obs, stations(t))


@query("C14_duplicate_keys", """
SELECT source, variable, count(*) AS duplicate_keys, CAST(sum(c - 1) AS BIGINT) AS extra_rows FROM (SELECT source, site_uid, variable, datetime_utc, interval, statistic, depth_cm, count(*) AS c FROM obs GROUP BY ALL)
WHERE c > 1 GROUP BY 1, 2""")
def c14(t):
    return m.duplicate_keys(t.obs)


@query("C15_hygiene", f"""WITH o AS (SELECT DISTINCT source, site_uid, variable FROM mapped)
SELECT 'no_coordinates' AS "check", count(*) AS n FROM sites WHERE lat IS NULL OR lon IS NULL
UNION ALL SELECT 'no_huc_in_state', count(*) FROM sites WHERE lat IS NOT NULL AND huc8 IS NULL AND (state IS NULL OR state = 'NM')
UNION ALL SELECT 'no_huc_elsewhere', count(*) FROM sites WHERE lat IS NOT NULL AND huc8 IS NULL AND state IS NOT NULL AND state <> 'NM'
UNION ALL SELECT 'zero_points', count(*) FROM sites WHERE lat = 0 AND lon = 0
UNION ALL SELECT 'unknown_variables', count(DISTINCT variable) FROM o WHERE variable NOT IN (SELECT variable FROM registry)
UNION ALL SELECT 'orphan_sites', count(DISTINCT site_uid) FROM o WHERE site_uid NOT IN (SELECT site_uid FROM sites)""")
def c15(t):
    return m.hygiene(m.site_variables(t.mapped), t.sites, t.registry)


@query("C16_dictionary", """
SELECT g.variable, g.unit, count(m.variable) AS n_obs, count(DISTINCT (m.site_uid, m.source, m.interval, m.statistic)) FILTER (WHERE m.variable IS NOT NULL) AS n_series
FROM registry g LEFT JOIN mapped m ON m.variable = g.variable GROUP BY 1, 2""")
def c16(t):
    return m.data_dictionary(t.registry, m.site_variables(t.mapped))


@query("C16_equivalence", """SELECT equivalence, count(*) AS n FROM (SELECT x.equivalence FROM raw_obs r JOIN crosswalk x USING (source, source_param)) GROUP BY 1""")
def c16e(t):
    return m.equivalence_summary(t.raw_obs.join(t.crosswalk, ["source", "source_param"]))


@query("C17_adhoc_sql", """
SELECT g.segment, CAST(year(c.date) AS BIGINT) AS year, round(avg(c.cfs), 6) AS mean_cfs, count(DISTINCT c.gauge) AS gauges FROM chosen c JOIN gauges g ON g.gauge = c.gauge GROUP BY 1, 2""")
def c17(t):
    m.register_catalog(t.spark, {"tm_chosen": t.chosen, "tm_gauges": t.gauges})
    return t.spark.sql("""SELECT g.segment, year(c.date) AS year, avg(c.cfs) AS mean_cfs, count(DISTINCT c.gauge) AS gauges
                          FROM tm_chosen c JOIN tm_gauges g ON g.gauge = c.gauge GROUP BY 1, 2""")


def catalog_sql(t, views, text):
    m.register_catalog(t.spark, {f"tm_{k}": v for k, v in views.items()})
    return t.spark.sql(text)


@query("C17_by_river", """
SELECT g.river, c.gauge, count(*) AS days, strftime(max(c.date), '%Y-%m-%d') AS last_day, max(c.cfs)::DOUBLE AS peak FROM chosen c JOIN gauges g ON g.gauge = c.gauge GROUP BY 1, 2""")
def c17r(t):
    return catalog_sql(t, {"chosen": t.chosen, "gauges": t.gauges}, """
        SELECT g.river, c.gauge, count(*) AS days, max(c.date) AS last_day, max(c.cfs) AS peak FROM tm_chosen c JOIN tm_gauges g ON g.gauge = c.gauge GROUP BY 1, 2""")


@query("C17_capacity_join", """
WITH cap AS (SELECT 'res' || (p_partkey % 6) AS reservoir, max(p_size) * 10000.0 AS cap FROM part GROUP BY 1)
SELECT d.reservoir, CAST(year(d.date) AS BIGINT) AS year, round(avg(d.stor), 2) AS mean_af, round(100 * avg(d.stor) / cap.cap, 4)::DOUBLE AS pct FROM reservoir_days d JOIN cap ON cap.reservoir = d.reservoir GROUP BY 1, 2, cap.cap""")
def c17c(t):
    cap = t.read("part").groupBy(F.concat(F.lit("res"), F.col("p_partkey") % 6).alias("reservoir")).agg((F.max("p_size") * 10000.0).alias("cap"))
    return catalog_sql(t, {"reservoir_days": t.reservoir_days, "capacity": cap}, """
        SELECT d.reservoir, year(d.date) AS year, round(avg(d.stor), 2) AS mean_af, round(100 * avg(d.stor) / c.cap, 4) AS pct
        FROM tm_reservoir_days d JOIN tm_capacity c ON c.reservoir = d.reservoir GROUP BY d.reservoir, year(d.date), c.cap""")


# the capacity at a full-pool elevation, between the two rows of a table that bracket it
FULL = """SELECT reservoir, max(CASE WHEN elev <= 4060 THEN stor END) AS s0, max(CASE WHEN elev <= 4060 THEN elev END) AS e0, min(CASE WHEN elev >= 4060 THEN stor END) AS s1, min(CASE WHEN elev >= 4060 THEN elev END) AS e1
 FROM {days} GROUP BY reservoir"""
PCT = """SELECT d.reservoir, max(d.date) AS last_day, round(100 * max_by(d.stor, d.date) / max(f.s0 + (4060 - f.e0) * (f.s1 - f.s0) / (f.e1 - f.e0)), 4) AS pct_full FROM {days} d JOIN f ON f.reservoir = d.reservoir GROUP BY d.reservoir"""


@query("C17_percent_full", f"WITH f AS ({FULL.format(days='reservoir_days')}), p AS ({PCT.format(days='reservoir_days')}) SELECT reservoir, strftime(last_day, '%Y-%m-%d') AS last_day, pct_full FROM p")
def c17p(t):
    return catalog_sql(t, {"reservoir_days": t.reservoir_days}, f"WITH f AS ({FULL.format(days='tm_reservoir_days')}) {PCT.format(days='tm_reservoir_days')}")
