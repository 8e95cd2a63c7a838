"""Reshaping queries: given tables are written into provider shapes by Spark, then parsed back."""

import uuid

from pyspark.sql import functions as F

from tidemark.operators.flow import segment_weekly
from tidemark.plans.registry import query
from tidemark.schema import OBSERVATIONS, STORED
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import archive as a
from tidemark.sources import reshape as r


def shared(t, name):
    """A new folder below the one that all executors share."""
    return f"{ensure_checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("A1_scan_observations", """
SELECT source, CAST(year AS BIGINT) AS year, count(*) AS n, round(sum(value), 4) AS total FROM obs WHERE source = 'usgs' AND year >= 1998 GROUP BY 1, 2""")
def a1(t):
    root = shared(t, "archive")
    a.write_partitioned(a.coerce(t.obs, STORED), root)
    found = a.read_observations(t.spark, root).where("source = 'usgs' AND year >= 1998")
    return found.groupBy("source", "year").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("A2_evolving_table", """
SELECT kind, unit, count(*) AS n FROM (SELECT 'a' AS kind, NULL AS unit FROM orders UNION ALL SELECT 'b', o_orderstatus FROM orders) GROUP BY 1, 2""")
def a2(t):
    o = t.read("orders")
    old, new = o.select(F.lit("a").alias("kind"), "o_orderkey"), o.select("o_orderkey", F.lit("b").alias("kind"), F.col("o_orderstatus").alias("unit"))
    root = shared(t, "group")
    old.write.parquet(f"{root}/old")
    new.write.parquet(f"{root}/new")
    return a.read_table_group(t.spark, [f"{root}/old", f"{root}/new"]).groupBy("kind", "unit").agg(F.count("*").alias("n"))


@query("A3_prepare_write", """
WITH k AS (SELECT *, row_number() OVER (PARTITION BY site_uid, variable, datetime_utc, interval, statistic, depth_cm ORDER BY ingest_run_id DESC, value DESC) AS rn FROM obs
  WHERE datetime_utc <= TIMESTAMP '2000-12-31' + INTERVAL 2 DAY)
SELECT source, variable, CAST(year AS BIGINT) AS year, count(*) AS n, round(sum(value), 4) AS total FROM k WHERE rn = 1 GROUP BY 1, 2, 3""")
def a3(t):
    kept = a.prepare_write(t.obs.drop("year"), t.registry, F.lit("2000-12-31").cast("timestamp"))
    return kept.groupBy("source", "variable", "year").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("A4_coerce", """
SELECT 's' || o_custkey AS site_uid, CAST(NULL AS VARCHAR) AS unit, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS value, CAST(o_custkey AS DOUBLE) AS depth_cm, count(*) AS n
FROM orders GROUP BY ALL""")
def a4(t):
    raw = t.read("orders").select(F.concat(F.lit("s"), "o_custkey").alias("site_uid"), F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("value"),
                                  F.col("o_custkey").cast("string").alias("depth_cm"), F.lit(1).alias("surplus"))
    c = a.coerce(raw, OBSERVATIONS)
    return c.groupBy("site_uid", "unit", "value", "depth_cm").agg(F.count("*").alias("n"))


@query("A5_wide_to_long", """
SELECT l_orderkey AS station, source_param, value, qualifier FROM (
 SELECT l_orderkey, 'qty' AS source_param, CASE WHEN l_quantity > 10 THEN l_quantity END AS value, l_returnflag AS qualifier FROM lineitem
 UNION ALL SELECT l_orderkey, 'tax', l_tax, l_linestatus FROM lineitem UNION ALL SELECT l_orderkey, 'price', l_extendedprice, NULL FROM lineitem) WHERE value IS NOT NULL""")
def a5(t):
    w = t.read("lineitem").select(F.col("l_orderkey").alias("station"), F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("qty"), F.col("l_returnflag").alias("qty_flag"),
                                  F.col("l_tax").alias("tax"), F.col("l_linestatus").alias("tax_flag"), F.col("l_extendedprice").alias("price"))
    return r.unpivot_report(w, ["station"], {"qty": "qty_flag", "tax": "tax_flag", "price": None})


@query("A6_parameter_names", """
SELECT l_orderkey AS id, p AS source_param, s AS statistic, 'daily' AS interval, v AS value FROM (
 SELECT l_orderkey, '00060' AS p, 'mean' AS s, l_quantity AS v FROM lineitem UNION ALL SELECT l_orderkey, '72019', 'max', l_tax FROM lineitem)""")
def a6(t):
    w = t.read("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_quantity").alias("123_00060_00003"), F.col("l_tax").alias("99_72019_00001"), F.col("l_discount").alias("notes"))
    long = w.unpivot(["id"], ["123_00060_00003", "99_72019_00001", "notes"], "name", "value")
    return r.parse_parameter_names(long).select("id", "source_param", "statistic", "interval", "value")


@query("A6_report_codes", """
SELECT code AS qualifier, substr(code, 1, 2) AS source_param, CASE WHEN substr(code, 6, 1) = 'X' THEN 'max' WHEN substr(code, 6, 1) = 'N' THEN 'min'
  WHEN substr(code, 1, 2) IN ('PP', 'PC') AND substr(code, 3, 1) <> 'I' THEN 'total' WHEN substr(code, 1, 2) = 'PC' THEN 'accumulated' ELSE 'instantaneous' END AS statistic,
  CASE substr(code, 3, 1) WHEN 'I' THEN CASE WHEN substr(code, 1, 2) IN ('HG', 'PC') THEN '15min' ELSE 'irregular' END WHEN 'H' THEN 'hourly' WHEN 'D' THEN 'daily' ELSE 'irregular' END AS interval, count(*) AS n
FROM (SELECT (CASE p_size % 4 WHEN 0 THEN 'HG' WHEN 1 THEN 'PP' WHEN 2 THEN 'PC' ELSE 'TA' END) || (CASE p_partkey % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'H' WHEN 2 THEN 'D' ELSE 'Q' END) || 'RG' ||
  (CASE p_partkey % 3 WHEN 0 THEN 'X' WHEN 1 THEN 'N' ELSE 'Z' END) AS code FROM part) GROUP BY ALL""")
def a6r(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    pick = lambda c, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (c + 1).cast("int"))
    code = F.concat(pick(s % 4, "HG", "PP", "PC", "TA"), pick(k % 4, "I", "H", "D", "Q"), F.lit("RG"), pick(k % 3, "X", "N", "Z"))
    d = r.parse_report_codes(t.read("part").select(code.alias("name")))
    return d.groupBy("qualifier", "source_param", "statistic", "interval").agg(F.count("*").alias("n"))


@query("A6_soil_names", """
SELECT statistic, depth_cm, source_unit, count(*) AS n FROM (SELECT CASE p_partkey % 3 WHEN 0 THEN 'max' WHEN 1 THEN 'min' ELSE 'mean' END AS statistic,
 (p_size % 4 + 1) * CASE WHEN p_size % 2 = 0 THEN 2.54 ELSE 1.0 END::DOUBLE AS depth_cm, CASE WHEN p_partkey % 5 = 0 THEN 'C' END AS source_unit FROM part) GROUP BY ALL""")
def a6s(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    name = F.concat(F.when(k % 3 == 0, "Max ").when(k % 3 == 1, "Min ").otherwise("Average "), s % 4 + 1, F.when(s % 2 == 0, "in").otherwise("cm"), F.lit(" Soil Temperature"),
                    F.when(k % 5 == 0, " (C)").otherwise(""))
    return r.parse_soil_names(t.read("part").select(name.alias("name"))).groupBy("statistic", "depth_cm", "source_unit").agg(F.count("*").alias("n"))


@query("A6_meter_names", """
SELECT source_param, source_unit, interval, statistic, count(*) AS n FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'DischargeAvg' WHEN 1 THEN 'DischargeTotal' WHEN 2 THEN 'Discharge' ELSE 'GageHeight' END AS source_param,
  CASE WHEN p_size % 2 = 0 THEN 'cfs' END AS source_unit, CASE p_partkey % 4 WHEN 0 THEN 'daily' WHEN 1 THEN CASE WHEN p_size % 3 = 0 THEN 'monthly' ELSE 'daily' END ELSE 'instant' END AS interval,
  CASE p_partkey % 4 WHEN 0 THEN 'mean' WHEN 1 THEN 'total' ELSE 'instantaneous' END AS statistic FROM part) GROUP BY ALL""")
def a6m(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    name = F.concat(F.when(k % 4 == 0, "Discharge Avg").when(k % 4 == 1, "DischargeTotal").when(k % 4 == 2, "Discharge").otherwise("Gage Height"), F.when(s % 2 == 0, " (cfs)").otherwise(""))
    d = t.read("part").select(name.alias("name"), F.when(s % 3 == 0, "Month").otherwise("Day").alias("time_label"))
    return r.parse_meter_names(d).groupBy("source_param", "source_unit", "interval", "statistic").agg(F.count("*").alias("n"))


@query("A7_hourly_lines", """
SELECT 's' || l_suppkey AS site_uid, CAST(l_shipdate + INTERVAL 5 HOUR AS VARCHAR) AS datetime_utc, source_param, CASE WHEN raw = -1 AND source_param = 'precip1h' THEN 0.0 ELSE raw END AS value,
 CASE WHEN raw = -1 AND source_param = 'precip1h' THEN 'T' END AS qualifier FROM (
 SELECT l_suppkey, l_shipdate, 'temp' AS source_param, CASE WHEN l_linenumber = 3 THEN -9999.0 ELSE l_quantity END AS raw FROM lineitem
 UNION ALL SELECT l_suppkey, l_shipdate, 'precip1h', CASE WHEN l_linenumber = 2 THEN -1.0 ELSE l_linenumber END FROM lineitem) WHERE raw > -9998""")
def a7(t):
    q = F.when(F.col("l_linenumber") == 3, -9999).otherwise(F.col("l_quantity").cast("int"))
    p = F.when(F.col("l_linenumber") == 2, -1).otherwise(F.col("l_linenumber"))
    d = t.read("lineitem").select("l_suppkey", F.format_string("%s %s %s %s   %s  %s", F.year("l_shipdate").cast("string"), F.month("l_shipdate").cast("string"), F.dayofmonth("l_shipdate").cast("string"),
                                                               F.lit("5"), q.cast("string"), p.cast("string")).alias("value"))
    return r.parse_hourly_lines(d, ["temp", "precip1h"], F.concat(F.lit("s"), "l_suppkey"))


@query("A7_month_lines", """
SELECT 'div:' || lpad(CAST(o_custkey % 9000 AS VARCHAR), 4, '0') AS site_uid, '1999-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-01' AS date, 'pcpn' AS source_param, (o_orderkey % 50 + m) * 0.5::DOUBLE AS value
FROM orders, range(1, 13) g(m) WHERE NOT (m = 4 AND o_orderkey % 3 = 0)""")
def a7m(t):
    ident = F.concat(F.lpad((F.col("o_custkey") % 9000).cast("string"), 4, "0"), F.lit("011999"))
    vals = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.when((m == 4) & (F.col("o_orderkey") % 3 == 0), F.lit("-99.90"))
                       .otherwise(((F.col("o_orderkey") % 50 + m) * 0.5).cast("string")))
    lines = t.read("orders").select(F.concat_ws("  ", ident, F.array_join(vals, "   ")).alias("value"))
    return r.parse_month_lines(lines, "pcpn")


@query("A7_fixed_lines", """
SELECT l_suppkey AS site, strftime(l_shipdate, '%Y-%m-%d') AS date, source_param, value FROM (SELECT l_suppkey, l_shipdate, 'FLOW' AS source_param, l_quantity AS value FROM lineitem
 UNION ALL SELECT l_suppkey, l_shipdate, 'STOR', CASE WHEN l_linenumber <> 5 THEN l_extendedprice END FROM lineitem) WHERE value IS NOT NULL""")
def a7f(t):
    stor = F.when(F.col("l_linenumber") == 5, F.lit("M")).otherwise(F.format_string("%.2f", "l_extendedprice"))
    d = t.read("lineitem").select(F.col("l_suppkey").alias("site"), F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lpad(F.format_string("%.1f", "l_quantity"), 10, " "), F.lpad(stor, 10, " ")).alias("value"))
    return r.parse_fixed_lines(d, ["FLOW", "STOR"])


@query("A8_station_json", """
SELECT 'st' || user_id AS station, event_type || ':' || (event_id % 3) AS source_param, 'hourly' AS interval, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS datetime_utc, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value, event_type AS qualifier
FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 <> 0""")
def a8(t):
    k = F.get_json_object("props", "$.k")
    doc = F.format_string('{"station": "st%s", "data": [{"element": "%s", "depth": %s, "duration": "HOURLY", "values": [{"date": "%s", "value": %s, "flag": "%s"}]}]}',
                          F.col("user_id").cast("string"), "event_type", (F.col("event_id") % 3).cast("string"), F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss"),
                          F.when(k.cast("int") % 10 == 0, F.lit("null")).otherwise(k), "event_type")
    return r.parse_station_json(t.read("events").select(doc.alias("value")))


@query("A8_triples", """
SELECT user_id AS site, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS datetime_utc, value, CAST(event_id % 5 AS BIGINT) AS quality FROM events WHERE event_id % 4 <> 0""")
def a8t(t):
    ms = (F.unix_timestamp("ts") * 1000).cast("string")
    v = F.when(F.col("event_id") % 4 == 0, F.lit("null")).otherwise(F.col("value").cast("string"))
    d = t.read("events").select(F.col("user_id").alias("site"), F.format_string('{"units": "cfs", "values": [[%s, %s, %s]]}', ms, v, (F.col("event_id") % 5).cast("string")).alias("value"))
    return r.parse_triples(d, keep=["site"])


@query("A8_data_arrays", """
SELECT 'ds' || user_id AS stream, CAST(event_id AS VARCHAR) AS obs_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS datetime_utc, CAST(user_id AS VARCHAR) AS result FROM events""")
def a8d(t):
    doc = F.format_string('[{"stream": "ds%s", "components": ["id", "phenomenonTime", "result"], "dataArray": [["%s", "%s", "%s"]]}]', F.col("user_id").cast("string"), F.col("event_id").cast("string"),
                          F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("user_id").cast("string"))
    return r.parse_data_arrays(t.read("events").select(doc.alias("value")))


@query("A9_long_tables", """
SELECT 'usgs:' || l_suppkey AS site_uid, CAST(l_shipdate AS VARCHAR) AS datetime_utc, l_quantity AS value, CASE WHEN l_linenumber = 1 THEN '00065' ELSE '00060' END AS source_param, 'mean' AS statistic, 'daily' AS interval,
 CASE WHEN l_linestatus = 'F' THEN l_returnflag || '|F' ELSE l_returnflag END AS qualifier FROM lineitem WHERE l_quantity <> 13""")
def a9(t):
    d = t.read("lineitem").select(F.concat(F.lit("USGS-"), "l_suppkey").alias("loc"), F.col("l_shipdate").cast("string").alias("time"), F.when(F.col("l_quantity") == 13, "-901").otherwise(F.col("l_quantity").cast("string")).alias("value"),
                                  F.col("l_returnflag").alias("status"), F.when(F.col("l_linestatus") == "F", "F").alias("flag"), "l_linenumber")
    return r.long_table(d, "usgs", "loc", "time", "value", F.when(F.col("l_linenumber") == 1, "00065").otherwise("00060"), F.lit("mean"), "daily", ["status", "flag"], [-901.0, -998877.0])


@query("A10_header_blocks", """
SELECT 'usgs:' || (o_orderkey % 1000) AS site_uid, CAST(l_shipdate AS VARCHAR) AS datetime_utc, CASE WHEN o_orderkey % 2 = 0 THEN '00060' ELSE '72019' END AS source_param, CASE WHEN o_orderkey % 2 = 0 THEN 'mean' ELSE 'max' END AS statistic,
 'daily' AS interval, l_quantity AS value, l_returnflag AS qualifier FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def a10(t):
    li = t.read("lineitem").select("l_orderkey", F.concat_ws("\t", F.lit("USGS"), (F.col("l_orderkey") % 1000).cast("string"), F.date_format("l_shipdate", "yyyy-MM-dd"), "l_quantity", "l_returnflag").alias("line"))
    col = F.when(F.col("l_orderkey") % 2 == 0, "1_00060_00003").otherwise("7_72019_00001")
    head = F.concat(F.lit("agency_cd\tsite_no\tdatetime\t"), col, F.lit("\t"), col, F.lit("_cd\n5s\t15s\t20d\t14n\t10s\n"))
    # an order has a handful of lines, so a block can be written as one text; it is read line by line
    blocks = li.groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("body")).select(F.concat(F.lit("# comment\n"), head, "body").alias("value"))
    folder = f"{ensure_checkpoint_dir(t.spark)}/header-lines-{uuid.uuid4().hex}"
    blocks.write.text(folder)
    return r.header_block_values(r.parse_header_lines(r.read_header_lines(t.spark, folder)))


ROUND_HOUR = "date_trunc('hour', ts + INTERVAL 30 MINUTE)"


@query("A11_nearest_hour", f"""
SELECT site_uid, source_param, strftime({ROUND_HOUR}, '%Y-%m-%d %H:%M:%S') AS datetime_utc, value FROM (SELECT user_id // 15 AS site_uid, event_type AS source_param, ts, value,
 row_number() OVER (PARTITION BY user_id // 15, event_type, {ROUND_HOUR} ORDER BY abs(epoch_us(ts) - epoch_us({ROUND_HOUR})), ts) AS rn FROM events) WHERE rn = 1""")
def a11(t):
    d = t.read("events").select(F.floor(F.col("user_id") / 15).alias("site_uid"), F.col("event_type").alias("source_param"), F.col("ts").cast("timestamp").alias("ts"), "value")
    return r.nearest_hour(d).select("site_uid", "source_param", "datetime_utc", "value")


@query("A12_hourly_totals", """
WITH e AS (SELECT user_id // 15 AS site_uid, ts, value, event_type = 'click' AS r, minute(ts) AS m FROM events), c AS (SELECT site_uid, m, count(*) AS c, count(*) FILTER (WHERE r) AS r FROM e GROUP BY 1, 2),
 k AS (SELECT site_uid, m AS rm FROM (SELECT *, row_number() OVER (PARTITION BY site_uid ORDER BY r DESC, m) AS rn FROM c) WHERE rn = 1),
 g AS (SELECT site_uid, value, ts, CAST(ceil((epoch_us(ts) - rm * 60000000) / 3600000000.0) AS BIGINT) + CASE WHEN rm >= 30 THEN 1 ELSE 0 END AS h FROM e JOIN k USING (site_uid))
SELECT site_uid, strftime(make_timestamp(h * 3600000000), '%Y-%m-%d %H:%M:%S') AS datetime_utc, value FROM (SELECT *, row_number() OVER (PARTITION BY site_uid, h ORDER BY ts DESC) AS rn FROM g) WHERE rn = 1""")
def a12(t):
    d = t.read("events").select(F.floor(F.col("user_id") / 15).alias("site_uid"), F.col("ts").cast("timestamp").alias("ts"), "value",
                                F.when(F.col("event_type") == "click", "FM15").otherwise("FM16").alias("report_type"))
    return r.hourly_totals(d).select("site_uid", "datetime_utc", "value")


@query("A13_quality_codes", """
WITH e AS (SELECT CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'precipitation' WHEN 'error' THEN 'wind_direction' WHEN 'signup' THEN 'relative_humidity' ELSE 'snow_depth' END AS p, value,
  ['1','3','s','','f','A','Q','7'][event_id % 8 + 1] AS qc, CASE WHEN event_id % 5 = 0 THEN 'T' END AS mc FROM events)
SELECT p AS source_param, nullif(concat_ws(',', nullif(qc, ''), CASE WHEN mc = 'T' AND p = 'precipitation' THEN 'T' END), '') AS qualifier, count(*) AS n FROM e
WHERE NOT (qc IN ('3', '7') OR (p IN ('temperature', 'wind_direction') AND regexp_full_match(qc, '[A-Za-z]')) OR (p = 'precipitation' AND qc IN ('X','N','Y','K','G','O','Z','A','M','D')) OR (p = 'relative_humidity' AND qc IN ('f','o')))
 AND (p <> 'wind_direction' OR value <= 360) AND (p <> 'precipitation' OR value <= 305) GROUP BY 1, 2""")
def a13(t):
    k = F.col("event_type")
    p = F.when(k == "click", "temperature").when(k == "view", "precipitation").when(k == "error", "wind_direction").when(k == "signup", "relative_humidity").otherwise("snow_depth")
    code = F.element_at(F.array(*[F.lit(x) for x in ("1", "3", "s", "", "f", "A", "Q", "7")]), (F.col("event_id") % 8 + 1).cast("int"))
    d = t.read("events").select(p.alias("source_param"), "value", code.alias("quality_code"), F.when(F.col("event_id") % 5 == 0, "T").alias("measure_code"))
    return r.screen_reports(d).groupBy("source_param", "qualifier").agg(F.count("*").alias("n"))


@query("A14_accumulator", """
SELECT site_uid, variable, count(*) AS n, count(step) AS steps, round(sum(step), 4) AS total FROM (SELECT *, CASE WHEN value - lag(value) OVER w >= 0 THEN value - lag(value) OVER w END AS step FROM subdaily
 WINDOW w AS (PARTITION BY site_uid, variable ORDER BY datetime_utc)) GROUP BY 1, 2""")
def a14(t):
    return r.accumulator_steps(t.subdaily, ["site_uid", "variable"]).groupBy("site_uid", "variable").agg(F.count("*").alias("n"), F.count("step").alias("steps"), F.round(F.sum("step"), 4).alias("total"))


@query("A15_local_to_utc", """
WITH w AS (SELECT o_orderkey AS id, o_orderdate + INTERVAL (o_orderkey % 24) HOUR AS wall FROM orders),
 c AS (SELECT *, ((wall + INTERVAL 6 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Denver' = wall AS summer, ((wall + INTERVAL 7 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Denver' = wall AS winter FROM w)
SELECT id, CASE WHEN summer <> winter THEN CAST(wall + INTERVAL (CASE WHEN summer THEN 6 ELSE 7 END) HOUR AS VARCHAR) END AS datetime_utc,
 CAST(CASE WHEN summer <> winter THEN CASE WHEN summer THEN -360 ELSE -420 END END AS BIGINT) AS utc_offset_min FROM c""")
def a15(t):
    # every hour of the day, so both clock changes of each year are met
    hours = F.make_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    d = t.read("orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderdate").cast("timestamp") + hours).alias("wall"))
    return r.wall_time_to_utc(d, "wall").drop("wall")


@query("A15_zone_codes", """
SELECT o_orderkey AS id, CAST(o_orderdate + INTERVAL (CASE o_custkey % 3 WHEN 0 THEN 420 WHEN 1 THEN 240 ELSE 420 END) MINUTE AS VARCHAR) AS datetime_utc, CAST(CASE o_custkey % 3 WHEN 0 THEN -420 WHEN 1 THEN -240 ELSE -420 END AS BIGINT) AS utc_offset_min FROM orders""")
def a15z(t):
    k = F.col("o_custkey") % 3
    d = t.read("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("wall"), F.when(k == 0, "MST").when(k == 1, "EDT").alias("zone"))
    return r.zoned_to_utc(d, "wall", "zone").drop("wall", "zone")


@query("A16_period_dates", """
SELECT rule, strftime(d, '%Y-%m-%d') AS date, count(*) AS n FROM (SELECT rule, CASE rule WHEN 'minus7' THEN CAST(ts - INTERVAL 7 HOUR AS DATE) WHEN 'zone' THEN CAST(ts - INTERVAL 7 HOUR AS DATE) WHEN 'month' THEN CAST(date_trunc('month', ts) AS DATE)
  WHEN 'water_year' THEN make_date(year(ts)::INT - 1, 10, 1) ELSE CAST(ts AS DATE) END AS d FROM (SELECT ts, ['minus7','zone','month','water_year','plain'][event_id % 5 + 1] AS rule FROM events)) GROUP BY 1, 2""")
def a16(t):
    rule = F.element_at(F.array(*[F.lit(x) for x in ("minus7", "zone", "month", "water_year", "plain")]), (F.col("event_id") % 5 + 1).cast("int"))
    d = t.read("events").select(rule.alias("rule"), F.col("ts").cast("timestamp").alias("ts"))
    return d.withColumn("date", r.period_date(F.col("ts"), F.col("rule"))).groupBy("rule", "date").agg(F.count("*").alias("n"))


@query("A17_infer_interval", """
SELECT site_uid, round(median(gap), 6) AS median_gap, count(*) + 1 AS readings, CASE WHEN count(*) + 1 > 5 AND median(gap) BETWEEN 3000 AND 4200 THEN 'hourly' ELSE 'instant' END AS interval FROM (
 SELECT site_uid, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY site_uid ORDER BY ts)) / 1000000.0::DOUBLE AS gap FROM (SELECT user_id // 12 AS site_uid, ts FROM events)) WHERE gap IS NOT NULL GROUP BY 1""")
def a17(t):
    d = t.read("events").select(F.floor(F.col("user_id") / 12).alias("site_uid"), F.col("ts").cast("timestamp").alias("datetime_utc"))
    return r.infer_interval(d, ["site_uid"])


@query("A18_sample_units", """
WITH s AS (SELECT event_id AS id, CASE event_type WHEN 'click' THEN 'water_temp' WHEN 'view' THEN 'nitrate' WHEN 'error' THEN 'arsenic' ELSE 'chloride' END AS variable, ['Deg F','mg/L','ug/L','mg/l asNO3','ppm'][event_id % 5 + 1] AS unit, value FROM events)
SELECT id, variable, round(CASE WHEN variable = 'water_temp' THEN value * 5 / 9 - 160.0 / 9 WHEN variable = 'nitrate' AND unit = 'ug/L' THEN value * 0.001 WHEN variable = 'nitrate' AND unit = 'mg/l asNO3' THEN value * 0.2259
  WHEN variable = 'chloride' AND unit = 'ug/L' THEN value * 0.001 WHEN variable = 'arsenic' AND unit = 'mg/L' THEN value * 1000.0 ELSE value END, 6) AS value FROM s
WHERE (variable = 'water_temp' AND unit = 'Deg F') OR (variable = 'nitrate' AND unit IN ('mg/L', 'ug/L', 'mg/l asNO3')) OR (variable IN ('arsenic', 'chloride') AND unit IN ('mg/L', 'ug/L'))""")
def a18(t):
    k = F.col("event_type")
    d = t.read("events").select(F.col("event_id").alias("id"), F.when(k == "click", "water_temp").when(k == "view", "nitrate").when(k == "error", "arsenic").otherwise("chloride").alias("variable"),
                                F.element_at(F.array(*[F.lit(x) for x in ("Deg F", "mg/L", "ug/L", "mg/l asNO3", "ppm")]), (F.col("event_id") % 5 + 1).cast("int")).alias("unit"), "value")
    return r.convert_samples(d).select("id", "variable", "value")


@query("A19_censored_results", """
SELECT event_id AS id, CASE event_id % 4 WHEN 3 THEN NULL ELSE round(value, 2) END AS value, CASE event_id % 4 WHEN 0 THEN 'MG/L' WHEN 1 THEN 'mg/L' END AS unit, CASE event_id % 4 WHEN 0 THEN '<' END AS detection_flag, event_id % 4 IN (1, 2) AS is_observation FROM events""")
def a19(t):
    v = F.format_string("%.2f", "value")
    k = F.col("event_id") % 4
    d = t.read("events").select(F.col("event_id").alias("id"), F.when(k == 0, F.concat(F.lit("< MRL "), v, F.lit(" MG/L"))).when(k == 1, F.concat(v, F.lit(" mg/L"))).when(k == 2, v).otherwise("not run").alias("result"))
    p = r.parse_results(d).drop("result")
    ok = r.detects(p).select("id").withColumn("is_observation", F.lit(True))
    return p.join(ok, "id", "left").withColumn("is_observation", F.coalesce("is_observation", F.lit(False)))


@query("A20_renamed_column", "SELECT count(*) FILTER (WHERE p_size > 25) AS n, CAST(sum(p_size) AS BIGINT) AS total, count(*) AS rows_all FROM part")
def a20(t):
    p = t.read("part")
    old, new = p.where("p_partkey % 2 = 0").select(F.col("p_size").alias("depth_wate")), p.where("p_partkey % 2 = 1").select(F.col("p_size").alias("depth_water"))
    both = a.union_by_name([old, new])
    d = both.select(r.either_column(both, "depth_water", "depth_wate").alias("depth_water"), r.either_column(both, "never_there").alias("none"))
    return d.agg(F.count_if(F.col("depth_water") > 25).alias("n"), F.sum("depth_water").alias("total"), F.count("*").alias("rows_all"))


@query("A21_priority_union", """
SELECT id, layer, val FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY layer, val) AS rn FROM (SELECT o_custkey AS id, 0 AS layer, min(o_totalprice) AS val FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
 UNION ALL SELECT o_custkey, 1, min(o_totalprice) FROM orders WHERE o_orderstatus = 'O' GROUP BY 1 UNION ALL SELECT c_custkey, 2, c_acctbal FROM customer)) WHERE rn = 1""".replace("SELECT id, layer, val", "SELECT id, CAST(layer AS BIGINT) AS layer, val"))
def a21(t):
    o = t.read("orders")
    one = lambda s, n: o.where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_totalprice").alias("val")).withColumn("layer", F.lit(n))
    c = t.read("customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("val"), F.lit(2).alias("layer"))
    return r.priority_union([one("F", 0), one("O", 1), c], ["id"])


@query("A22_merge_versions", """
SELECT station, issue_date, n, total FROM (SELECT 'st' || (o_custkey % 50) AS station, strftime(o_orderdate, '%Y-%m-%d') AS issue_date, count(*) AS n, round(sum(o_totalprice), 2) AS total, row_number() OVER (PARTITION BY 'st' || (o_custkey % 50), o_orderdate ORDER BY v DESC) AS rn
 FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS v FROM orders) GROUP BY 'st' || (o_custkey % 50), o_orderdate, v) WHERE rn = 1""")
def a22(t):
    o = t.read("orders").select(F.concat(F.lit("st"), F.col("o_custkey") % 50).alias("station"), F.to_date("o_orderdate").alias("issue_date"), "o_orderstatus", "o_totalprice")
    agg = lambda d: d.groupBy("station", "issue_date").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return r.merge_versions(agg(o.where("o_orderstatus = 'F'")), agg(o.where("o_orderstatus <> 'F'")))


@query("A23_messy_table", """
SELECT CAST(l_suppkey AS VARCHAR) AS site_uid, CAST(l_shipdate AS VARCHAR) AS datetime_utc, source_param, value FROM (SELECT l_suppkey, l_shipdate, 'depth_to_water_ft' AS source_param, l_quantity AS value FROM lineitem UNION ALL SELECT l_suppkey, l_shipdate, 'precip_mm', l_tax FROM lineitem)""")
def a23(t):
    d = t.read("lineitem").select(F.col("l_suppkey").alias("Well_ID"), F.col("l_shipdate").cast("string").alias("Measurement Date"), F.col("l_quantity").cast("string").alias("DTW_ft"), F.col("l_tax").alias("Rainfall"), F.col("l_linestatus").alias("remarks"))
    return r.guessed_observations(d)


@query("A23_tidy_sheet", """
SELECT o_orderstatus AS area, measure, value FROM (SELECT o_orderstatus, 'price' AS measure, o_totalprice AS value FROM orders UNION ALL SELECT o_orderstatus, 'mostly', CASE WHEN o_orderkey % 3 > 0 THEN o_custkey::DOUBLE END FROM orders) WHERE value IS NOT NULL""")
def a23s(t):
    k = F.col("o_orderkey")
    d = t.read("orders").select(F.col("o_orderstatus").alias("area"), F.col("o_totalprice").alias("price"), F.when(k % 3 > 0, F.col("o_custkey").cast("string")).otherwise("none").alias("mostly"),
                                F.when(k % 3 == 0, "1").otherwise("x").alias("seldom"), F.col("o_orderpriority").alias("words"))
    return r.tidy_sheet(d, "area")


@query("A24_water_use", """
SELECT id, county FROM (SELECT c_custkey AS id, CASE WHEN c_nationkey % 3 = 0 THEN 'NM' WHEN c_nationkey % 3 = 1 THEN '' ELSE 'TX' END AS st, CASE WHEN c_custkey % 2 = 0 THEN '35' ELSE '48' END || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS county FROM customer)
WHERE st = 'NM' OR (st = '' AND county LIKE '35%')""")
def a24(t):
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    d = t.read("customer").select(k.alias("id"), F.when(n % 3 == 0, "NM").when(n % 3 == 1, "").otherwise("TX").alias("st"),
                                  F.concat(F.when(k % 2 == 0, "35").otherwise("48"), F.lpad(n.cast("string"), 3, "0")).alias("county"))
    return r.state_rows(d, "st", "county", ["NM", "35"], "35").select("id", "county")


@query("A24_area_series", """
SELECT o_custkey AS model, 'huc12_id' AS area_type, 'h' || (o_orderkey % 90) AS area_id, strftime(o_orderdate, '%Y-%m') AS year_month, o_totalprice AS value FROM orders""")
def a24a(t):
    doc = F.format_string('{"huc12_id": {"h%s": [{"year_month": "%s", "mgd": "%s"}]}}', (F.col("o_orderkey") % 90).cast("string"), F.date_format("o_orderdate", "yyyy-MM"), F.col("o_totalprice").cast("string"))
    return r.area_series(t.read("orders").select(F.col("o_custkey").alias("model"), doc.alias("doc")), "doc", "mgd", ["model"])


@query("A25_rating_points", """
SELECT 'loc' || (o_custkey % 40) AS location, strftime(o_orderdate, '%Y-%m-%d') AS effective_date, 'NGVD29' AS elev_datum, elevation_ft, storage_af FROM (
 SELECT o_custkey, o_orderdate, 4000.0 + o_custkey AS elevation_ft, o_totalprice AS storage_af FROM orders UNION ALL SELECT o_custkey, o_orderdate, 4100.0 + o_custkey, 1000.5::DOUBLE FROM orders WHERE o_orderkey % 2 = 0)""".replace("AS elevation_ft, o_totalprice", "::DOUBLE AS elevation_ft, o_totalprice"))
def a25(t):
    k = F.col("o_custkey")
    vals = F.format_string("[[%s, %s], [%s, %s]]", (4000 + k).cast("string"), F.col("o_totalprice").cast("string"), (4100 + k).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "1000.5").otherwise("9999999"))
    d = t.read("orders").select(F.concat(F.lit("loc"), k % 40, F.lit(".Elev;Stor.Linear")).alias("rating_id"), F.lit("Elev (ft NGVD29)").alias("ind_parameter"),
                                F.date_format("o_orderdate", "yyyy-MM-dd'T00:00:00Z'").alias("effective"), vals.alias("values"))
    return r.rating_points(d).drop("rating_id")


@query("A25_level_units", """
SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'ft' WHEN 1 THEN 'ac-ft' WHEN 2 THEN 'cfs' ELSE 'pct' END AS unit, round(p_retailprice * CASE p_partkey % 4 WHEN 0 THEN 3.28084 WHEN 1 THEN 1 / 1233.48184 WHEN 2 THEN 35.3146667 ELSE 1 END::DOUBLE, 6) AS value FROM part""")
def a25l(t):
    k = F.col("p_partkey")
    d = t.read("part").select(k.alias("id"), F.when(k % 4 == 0, "m").when(k % 4 == 1, "m3").when(k % 4 == 2, "cms").otherwise("pct").alias("unit"), F.col("p_retailprice").alias("value"))
    return r.to_customary(d)


@query("A25_survey_years", """
SELECT p_partkey AS id, CAST(CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN 1950 + p_size ELSE 2000 + p_size % 20 END AS BIGINT) AS survey_year,
 CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN CAST(1950 + p_size AS VARCHAR) ELSE '1988 and ' || (2000 + p_size % 20) END AS survey_label FROM part""")
def a25s(t):
    s = F.col("p_size")
    title = F.when(s % 3 == 0, "Area table").when(s % 3 == 1, F.concat(F.lit("Survey of "), 1950 + s)).otherwise(F.concat(F.lit("Surveys 1988 and "), 2000 + s % 20, F.lit(" combined")))
    return r.survey_years(t.read("part").select(F.col("p_partkey").alias("id"), title.alias("title"))).drop("title")


@query("A26_flood_thresholds", """
SELECT 'nwps:' || p_partkey AS site_uid, 'ft' AS stage_units, 'kcfs' AS flow_units, CASE WHEN p_size % 4 > 0 THEN p_size::DOUBLE END AS action_stage, CAST(NULL AS DOUBLE) AS action_flow, CASE WHEN p_size % 3 > 0 THEN p_size + 2.5 END::DOUBLE AS minor_stage,
 CASE WHEN p_size % 2 > 0 THEN p_size * 10.0 END::DOUBLE AS minor_flow, CAST(NULL AS DOUBLE) AS moderate_stage, CAST(NULL AS DOUBLE) AS moderate_flow, CAST(NULL AS DOUBLE) AS major_stage, CAST(NULL AS DOUBLE) AS major_flow
FROM part WHERE p_size % 4 > 0 OR p_size % 3 > 0 OR p_size % 2 > 0""")
def a26(t):
    s = F.col("p_size")
    num = lambda c, v: F.when(c, v.cast("string")).otherwise("-999")
    doc = F.format_string('{"flood": {"stageUnits": "ft", "flowUnits": "kcfs", "categories": {"action": {"stage": %s}, "minor": {"stage": %s, "flow": %s}, "major": {"stage": -999, "flow": -999}}}}',
                          num(s % 4 > 0, s), num(s % 3 > 0, s + 2.5), num(s % 2 > 0, s * 10))
    return r.flood_thresholds(t.read("part").select(F.concat(F.lit("nwps:"), "p_partkey").alias("site_uid"), doc.alias("value")))


@query("A27_active_stations", """
WITH s AS (SELECT c_custkey AS native_id, CASE WHEN c_custkey % 11 > 0 THEN 1990 + c_nationkey END AS stored_year FROM customer), live AS (SELECT o_custkey AS native_id, max(year(o_orderdate)) AS last_year FROM orders WHERE o_custkey % 5 > 0 GROUP BY 1)
SELECT native_id, CAST(stored_year AS BIGINT) AS stored_year FROM s LEFT JOIN live USING (native_id) WHERE coalesce(last_year, stored_year, 9999) >= 2001""")
def a27(t):
    s = t.read("customer").select(F.col("c_custkey").alias("native_id"), F.when(F.col("c_custkey") % 11 > 0, 1990 + F.col("c_nationkey")).alias("stored_year"))
    live = t.read("orders").where("o_custkey % 5 > 0").groupBy(F.col("o_custkey").alias("native_id")).agg(F.max(F.year("o_orderdate")).alias("last_year"))
    return r.active_stations(s, 2001, live)


@query("A28_drop_retired", """
SELECT count(*) AS kept, (SELECT count(*) FROM lineitem) - count(*) AS dropped FROM lineitem WHERE l_returnflag || '/' || l_suppkey || '/' || l_linenumber NOT IN (SELECT 'A/' || s_suppkey || '/3' FROM supplier WHERE s_nationkey < 5)""")
def a28(t):
    li = t.read("lineitem")
    gone = t.read("supplier").where("s_nationkey < 5").select(F.concat(F.lit("A/"), "s_suppkey", F.lit("/3")).alias("key"))
    kept = r.drop_retired(li, gone, ["l_returnflag", "l_suppkey", "l_linenumber"]).agg(F.count("*").alias("kept"))
    return kept.select("kept", (li.agg(F.count("*")).scalar() - F.col("kept")).alias("dropped"))


@query("A30_scope_filter", """
SELECT site_uid FROM sites WHERE (lon BETWEEN -107.0 - 0.25 AND -105.0 + 0.25 AND lat BETWEEN 33.5 - 0.25 AND 35.0 + 0.25) OR state = 'CO' OR huc8 LIKE '130200%'""")
def a30(t):
    return r.in_scope(t.sites, (-107.0, 33.5, -105.0, 35.0), 0.25, ["CO"], ["130200"]).select("site_uid")


@query("A32_dam_capacity", """
WITH d AS (SELECT 'NM' || (p_partkey % 300) AS nid_id, CASE WHEN p_size % 3 = 0 THEN p_name || ' Dam' ELSE p_name END AS dam_name, CASE WHEN p_size % 2 = 0 THEN p_type END AS river, CASE WHEN p_size % 5 > 0 THEN CAST(p_size AS VARCHAR) ELSE 'n/a' END AS height_ft,
  p_retailprice AS storage_af FROM part WHERE p_partkey % 7 > 0)
SELECT nid_id, dam_name, river, TRY_CAST(height_ft AS DOUBLE) AS height_ft, storage_af FROM (SELECT *, row_number() OVER (PARTITION BY nid_id ORDER BY dam_name LIKE '% Dam' DESC, river IS NOT NULL DESC, coalesce(TRY_CAST(height_ft AS DOUBLE), -1) DESC,
  dam_name DESC, river DESC, height_ft DESC, storage_af DESC) AS rn FROM d) WHERE rn = 1""")
def a32(t):
    s, k = F.col("p_size"), F.col("p_partkey")
    d = t.read("part").select(F.concat(F.lit("NM"), k % 300).alias("nid_id"), F.when(s % 3 == 0, F.concat("p_name", F.lit(" Dam"))).otherwise(F.col("p_name")).alias("dam_name"), F.when(s % 2 == 0, F.col("p_type")).alias("river"),
                              F.when(s % 5 > 0, s.cast("string")).otherwise("n/a").alias("height_ft"), F.col("p_retailprice").cast("string").alias("storage_af"), F.when(k % 7 > 0, "New Mexico").otherwise("Utah").alias("state"))
    return r.dam_capacity(d, ["New Mexico"]).drop("state")


@query("A33_quality_results", """
SELECT id, characteristic, value, unit, detection_flag FROM (SELECT o_orderkey AS id, 'nitrate' AS characteristic, round(o_custkey * 0.01, 2)::DOUBLE AS value, 'mg/L' AS unit, CASE WHEN o_orderstatus = 'F' THEN '<' END AS detection_flag FROM orders
 UNION ALL SELECT o_orderkey, 'arsenic', (o_custkey % 20)::DOUBLE, 'ug/L', NULL FROM orders WHERE o_orderkey % 2 = 0)""")
def a33(t):
    n = F.format_string("%.2f", F.col("o_custkey") * 0.01)
    d = t.read("orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("<"), n)).otherwise(n).alias("no3"), F.when(F.col("o_orderkey") % 2 == 0, (F.col("o_custkey") % 20).cast("string")).alias("as"))
    return r.quality_results(d, ["id"], {"no3": ("nitrate", "mg/L"), "as": ("arsenic", "ug/L")}).select("id", "characteristic", "value", "unit", "detection_flag")


@query("A34_watershed_table", """
SELECT substr(huc, 1, 4) AS huc, min(name) AS name FROM (SELECT '13' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 90 AS VARCHAR), 4, '0') AS huc, c_name AS name, -109 + (c_custkey % 50) * 0.15 AS lon, 31 + (c_custkey % 30) * 0.3 AS lat FROM customer)
WHERE lon BETWEEN -107.0 AND -103.0 AND lat BETWEEN 32.0 AND 37.0 GROUP BY 1""")
def a34(t):
    k = F.col("c_custkey")
    d = t.read("customer").select(F.concat(F.lit("13"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lpad((k % 90).cast("string"), 4, "0")).alias("huc"), F.col("c_name").alias("name"),
                                  (-109 + (k % 50) * 0.15).alias("lon"), (31 + (k % 30) * 0.3).alias("lat"))
    return r.watershed_table(d, (-107.0, 32.0, -103.0, 37.0), 4).select("huc", "name")


@query("A35_diversion_records", """
SELECT site_uid, source_param, count(*) AS n FROM (SELECT 'codwr:' || CASE WHEN l_linenumber < 5 THEN 'ab' || l_suppkey WHEN s_suppkey IS NOT NULL THEN 'ab' || l_suppkey ELSE 'wdid-' || l_suppkey END AS site_uid,
  CASE WHEN l_linenumber < 5 AND l_suppkey % 3 = 0 THEN 'Streamflow:Diversion' ELSE 'Streamflow' END AS source_param FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 2 = 0) GROUP BY 1, 2""")
def a35(t):
    k = F.col("l_suppkey")
    d = t.read("lineitem").select(F.when(F.col("l_linenumber") < 5, F.concat(F.lit("ab"), k)).alias("abbrev"), k.cast("string").alias("wdid"), F.lit("Streamflow").alias("source_param"))
    s = t.read("supplier")
    structures = s.where("s_suppkey % 3 = 0").select(F.concat(F.lit("ab"), "s_suppkey").alias("abbrev"))
    stations = s.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("wdid"), F.concat(F.lit("ab"), "s_suppkey").alias("native_id"))
    return r.diversion_records(d, structures, stations).groupBy("site_uid", "source_param").agg(F.count("*").alias("n"))


def scratch(t, name):
    """A folder of this run in the shared checkpoint area."""
    return f"{ensure_checkpoint_dir(t.spark)}/{name}/{uuid.uuid4().hex}"


@query("A29_reprocess", """SELECT 'hourly' AS kind, CAST(l_suppkey AS VARCHAR) AS site, count(*) AS n, round(sum(l_quantity), 4) AS total FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2 UNION ALL SELECT 'levels', CAST(l_suppkey AS VARCHAR), count(*), round(sum(l_tax), 4) FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1, 2""")
def a29(t):
    root, li = scratch(t, "landing"), t.read("lineitem")
    for kind, rows, value in (("hourly", li.where("l_returnflag = 'A'"), "l_quantity"), ("levels", li.where("l_returnflag <> 'A'"), "l_tax")):
        rows.select(F.concat_ws(" ", "l_suppkey", value)).write.text(f"{root}/kind={kind}")
    parse = lambda d: d.select(F.split_part("value", F.lit(" "), F.lit(1)).alias("site"), F.split_part("value", F.lit(" "), F.lit(2)).try_cast("double").alias("value"))
    return r.reprocess(t.spark, root, {"hourly": parse, "levels": parse}).groupBy("kind", "site").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("A31_publish_marts", """SELECT segment, strftime(week_start, '%Y-%m-%d') AS week_start, round(avg(mean_cfs), 6) AS mean_cfs, count(*) AS n_gauges FROM gauge_weeks JOIN gauges USING (gauge) GROUP BY 1, 2""")
def a31(t):
    mart = segment_weekly(t.gauge_weeks, t.gauges).select("segment", "week_start", "mean_cfs", "n_gauges")
    root = scratch(t, "marts")
    a.publish_json(mart, f"{root}/weekly")
    a.publish_csv(mart.select("segment", "n_gauges"), f"{root}/segments")
    return t.spark.read.schema("segment string, week_start date, mean_cfs double, n_gauges bigint").json(f"{root}/weekly")
