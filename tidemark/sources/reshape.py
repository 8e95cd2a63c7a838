"""Provider file shapes to long observation rows, one dataset-level function per shape.

Input is a DataFrame over a landing folder (``spark.read.csv/json/text/binaryFile``); output is long
rows keyed by ``source_param``, ready for the crosswalk."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import local_to_utc
from tidemark.functions.literals import fixed
from tidemark.functions.shapes import neighbours, pick_row
from tidemark.schema import AF_M3, LOCAL_ZONE

# ---- wide to long -----------------------------------------------------------


def unpivot_report(df: DataFrame, ids: Sequence[str], params: dict[str, str | None]) -> DataFrame:
    """One row per parameter column; ``params`` maps it to its qualifier column, if it has one."""
    cells = F.array(*[F.struct(F.lit(p).alias("source_param"), F.col(f"`{p}`").try_cast("double").alias("value"),
                               (F.col(f"`{q}`").cast("string") if q else F.lit(None).cast("string")).alias("qualifier"))
                      for p, q in params.items()])
    return df.select(*ids, F.explode(cells).alias("c")).select(*ids, "c.*").where(F.col("value").isNotNull())


# Statistic codes in parameter column names; report code durations and extremes.
STAT_CODES = {"00001": "max", "00002": "min", "00003": "mean", "00006": "total", "00008": "median", "00011": "instantaneous"}
DURATION_CODES = {"I": "instant", "H": "hourly", "D": "daily", "M": "monthly", "Q": "irregular", "T": "irregular", "U": "irregular"}
TOTAL_ELEMENTS = ["PP", "PC", "EP", "SF"]
QUARTER_HOUR_ELEMENTS = ["HG", "QR", "HP", "LS", "PC"]


def _lookup(values: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[key]


def parse_parameter_names(long: DataFrame, name: str = "name") -> DataFrame:
    """``NNN_PPPPP_SSSSS`` column names: parameter and statistic code, daily rows."""
    pattern = r"^(\d+)_(\d{5})(?:_(\d{5}))?$"
    return (long.where(F.col(name).rlike(pattern))
            .withColumn("source_param", F.regexp_extract(name, pattern, 2))
            .withColumn("statistic", _lookup(STAT_CODES, F.regexp_extract(name, pattern, 3)))
            .withColumn("interval", F.lit("daily")))


def parse_report_codes(long: DataFrame, name: str = "name") -> DataFrame:
    """Six-letter report codes: element, duration and extreme give parameter, interval and statistic."""
    element, duration, extreme = F.substring(name, 1, 2), F.substring(name, 3, 1), F.substring(name, 6, 1)
    interval = F.coalesce(_lookup(DURATION_CODES, duration), F.lit("irregular"))
    stat = (F.when(extreme == "X", "max").when(extreme == "N", "min")
             .when(element.isin(*TOTAL_ELEMENTS) & (duration != "I"), "total").when(element == "PC", "accumulated")
             .otherwise("instantaneous"))
    interval = (F.when(interval != "instant", interval).when(element.isin(*QUARTER_HOUR_ELEMENTS), "15min").otherwise("irregular"))
    return (long.where(F.length(name) >= 6).withColumn("source_param", element)
            .withColumn("statistic", stat).withColumn("interval", interval).withColumn("qualifier", F.col(name)))


def parse_soil_names(long: DataFrame, name: str = "name") -> DataFrame:
    """``Max 10cm Soil Temperature (C)`` style names: statistic, depth and unit."""
    text = F.lower(F.trim(F.regexp_replace(F.col(name), r"\s*\([^)]*\)\s*$", "")))
    pattern = r"^(max|min|mean|avg|average)?\s*(\d+)\s*(in|cm)\s*soil\s*temp"
    stat = F.regexp_extract(text, pattern, 1)
    depth = F.regexp_extract(text, pattern, 2).cast("double") * F.when(F.regexp_extract(text, pattern, 3) == "in", 2.54).otherwise(1.0)
    return (long.where(text.rlike(pattern))
            .withColumn("statistic", F.when(stat.isin("max", "min"), stat).otherwise("mean")).withColumn("depth_cm", depth)
            .withColumn("source_unit", F.nullif(F.regexp_extract(name, r"\(([^)]*)\)\s*$", 1), F.lit("")))
            .withColumn("source_param", F.lit("soil_temp")).withColumn("interval", F.lit("daily")))


def parse_meter_names(long: DataFrame, name: str = "name", time_label: str = "time_label") -> DataFrame:
    """``DischargeAvg (cfs)`` style meter columns; totals follow the label of the time column."""
    text = F.replace(F.lower(F.col(name)), F.lit(" "), F.lit(""))
    kind = (F.when(text.contains("dischargeavg"), "DischargeAvg").when(text.contains("dischargetotal"), "DischargeTotal")
             .when(text.startswith("discharge"), "Discharge").when(text.contains("gageheight"), "GageHeight"))
    monthly = F.lower(F.col(time_label)).startswith("month")
    return (long.withColumn("source_param", kind).where(F.col("source_param").isNotNull())
            .withColumn("source_unit", F.nullif(F.regexp_extract(name, r"\((.*?)\)", 1), F.lit("")))
            .withColumn("interval", F.when(kind == "DischargeAvg", "daily").when(kind == "DischargeTotal", F.when(monthly, "monthly").otherwise("daily"))
                        .otherwise("instant"))
            .withColumn("statistic", F.when(kind == "DischargeAvg", "mean").when(kind == "DischargeTotal", "total").otherwise("instantaneous")))


# ---- text lines -------------------------------------------------------------


def parse_hourly_lines(lines: DataFrame, fields: Sequence[str], site: Column, text: str = "value") -> DataFrame:
    """Blank-separated hourly lines: year, month, day, hour, then fields; -9999 is missing, -1 rain a trace."""
    part = F.split(F.trim(F.col(text)), r"\s+")
    num = lambda i: F.try_element_at(part, F.lit(i)).try_cast("double")
    ts = F.try_make_timestamp(*[num(i).cast("int") for i in (1, 2, 3, 4)], F.lit(0), F.lit(0.0))
    cells = F.array(*[F.struct(F.lit(f).alias("source_param"), num(i).alias("raw")) for i, f in enumerate(fields, start=5)])
    d = lines.select(site.alias("site_uid"), ts.alias("datetime_utc"), F.explode(cells).alias("c")).select("site_uid", "datetime_utc", "c.*")
    trace = (F.col("source_param") == "precip1h") & (F.col("raw") == -1)
    return (d.where((F.col("raw") > -9998) & F.col("datetime_utc").isNotNull())
            .select("site_uid", "datetime_utc", "source_param", F.when(trace, 0.0).otherwise(F.col("raw")).alias("value"),
                    F.when(trace, "T").alias("qualifier")))


def parse_month_lines(lines: DataFrame, element: str, text: str = "value") -> DataFrame:
    """An identifier (area, element, year) and twelve monthly values; -99 and lower are missing."""
    part = F.split(F.trim(F.col(text)), r"\s+")
    ident = F.element_at(part, 1)
    d = lines.select(F.substring(ident, 1, 4).alias("area"), F.substring(ident, 7, 4).cast("int").alias("year"),
                     F.posexplode(F.slice(part, 2, 12)).alias("m", "v"))
    value = F.col("v").try_cast("double")
    return d.where(value > -99).select(F.concat(F.lit("div:"), "area").alias("site_uid"), F.make_date("year", F.col("m") + 1, F.lit(1)).alias("date"),
                                       F.lit(element).alias("source_param"), value.alias("value"))


def parse_fixed_lines(lines: DataFrame, names: Sequence[str], prefix: int = 10, width: int = 10, text: str = "value") -> DataFrame:
    """A date prefix and right-aligned fields of one width."""
    cells = F.array(*[F.struct(F.lit(n).alias("source_param"), F.trim(F.substring(text, prefix + 1 + i * width, width)).try_cast("double").alias("value"))
                      for i, n in enumerate(names)])
    day = F.trim(F.substring(text, 1, prefix)).try_cast("date")
    keep = [c for c in lines.columns if c != text]
    return (lines.select(*keep, day.alias("date"), F.explode(cells).alias("c")).select(*keep, "date", "c.*")
            .where(F.col("date").isNotNull() & F.col("value").isNotNull()))


BLOCK_START = "\nagency_cd\t"


def read_header_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Text whose column header changes per site, one row per header block.

    The record separator is the header line's own start, so Spark splits large files between blocks
    and no task has to carry a header across a whole file."""
    return spark.read.option("lineSep", BLOCK_START).text(path)


def parse_header_blocks(blocks: DataFrame, text: str = "value") -> DataFrame:
    """Rows of header blocks as ``fields`` maps; comments and the width line are skipped."""
    lines = F.split(F.regexp_replace(F.col(text), r"(?s)^.*?agency_cd\t", ""), "\n")
    head = F.concat(F.array(F.lit("agency_cd")), F.split(F.element_at(lines, 1), "\t"))
    keep = [c for c in blocks.columns if c != text]
    rows = blocks.select(*keep, head.alias("head"), F.explode(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))).alias("line"))
    rows = rows.where((F.col("line") != "") & ~F.col("line").startswith("#") & ~F.col("line").rlike(r"^\d+[sdn](\t\d+[sdn])*$"))
    cells = F.split("line", "\t", -1)
    # the first block of a file starts with comments, whose text never reaches here as a header
    return (rows.where(F.size(cells) == F.size("head")).where(~F.element_at("head", 2).startswith("#"))
            .select(*keep, F.map_from_arrays("head", cells).alias("fields")))


# The first fields that mark a header line, and the line of field widths below one.
HEADER_FIELDS = ["agency_cd", "site_no"]
WIDTH_LINE = r"^\d+[sdn](\t\d+[sdn])*$"
# lines of a split that are put in order together, a power of two, and the parts that the blocks of a split are dealt to
LINES_PER_BLOCK = 16_384
PARTS_PER_SPLIT = 4


def read_header_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text whose column header changes per site, one row a line: file, start of the split it was read in, place in that split, value."""
    d = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return d.withColumn("place", F.monotonically_increasing_id())


def with_header(lines: DataFrame) -> DataFrame:
    """Data lines with the header in force (``head``, an array), whatever splits the two lie in.

    A file is read in splits, and a header may stand many splits before its last line. Splits are cut into blocks of lines. One pass
    over the headers keeps the last one of each block, a row a block; a prefix over a file's blocks carries it on; inside a block lines
    take the last header before them, else the carried one. Blocks are dealt to a number of parts that follows the number of splits, so
    a task holds some MB of lines however long files, sites' blocks and the whole input are. Lines before the first header are dropped,
    as are comments, widths and lines that do not have the header's number of fields."""
    parts = max(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), PARTS_PER_SPLIT * lines.rdd.getNumPartitions())
    block = ["file", "start", "block"]
    first = F.split_part("value", F.lit("\t"), F.lit(1))
    lines = lines.withColumn("block", F.shiftright("place", LINES_PER_BLOCK.bit_length() - 1))
    head = F.when(first.isin(*HEADER_FIELDS), F.col("value"))
    ends = lines.where(head.isNotNull()).groupBy(*block).agg(F.max_by("value", "place").alias("ends"))
    before = Window.partitionBy("file").orderBy("start", "block").rowsBetween(Window.unboundedPreceding, -1)
    carried = lines.select(*block).distinct().join(ends, block, "left").select(*block, F.last("ends", ignorenulls=True).over(before).alias("carried"))
    upto = Window.partitionBy(*block).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    d = lines.where((F.col("value") != "") & ~F.col("value").startswith("#") & ~F.col("value").rlike(WIDTH_LINE)).repartition(parts, *block)
    d = d.withColumn("own", F.last(head, ignorenulls=True).over(upto)).where(head.isNull()).join(carried, block)
    d = d.select(*[c for c in lines.columns if c not in ("start", "place", "block")], F.split(F.coalesce("own", "carried"), "\t").alias("head"))
    return d.where(F.size("head") == F.size(F.split("value", "\t", -1)))


def parse_header_lines(lines: DataFrame) -> DataFrame:
    """Rows of ``read_header_lines`` as ``fields`` maps."""
    return with_header(lines).select("file", F.map_from_arrays("head", F.split("value", "\t", -1)).alias("fields"))


def header_block_values(rows: DataFrame) -> DataFrame:
    """Daily values of header-block rows, each with the qualifier in its ``_cd`` twin."""
    f = F.col("fields")
    d = rows.select(F.concat(F.lit("usgs:"), f["site_no"]).alias("site_uid"), f["datetime"].try_cast("timestamp").alias("datetime_utc"),
                    f.alias("fields"), F.explode(F.map_keys(f)).alias("name"))
    d = parse_parameter_names(d)
    return d.select("site_uid", "datetime_utc", "source_param", "statistic", "interval", F.col("fields")[F.col("name")].try_cast("double").alias("value"),
                    F.col("fields")[F.concat("name", F.lit("_cd"))].alias("qualifier")).where(F.col("value").isNotNull())


# ---- nested JSON ------------------------------------------------------------

STATION_JSON = "station string, data array<struct<element: string, depth: int, duration: string, values: array<struct<date: string, value: double, flag: string>>>>"


def parse_station_json(docs: DataFrame, text: str = "value") -> DataFrame:
    """Stations with element blocks with dated values; a depth becomes part of the parameter."""
    d = docs.select(F.from_json(text, STATION_JSON).alias("s")).select("s.station", F.explode("s.data").alias("b"))
    d = d.select("station", F.col("b.element").alias("element"), F.col("b.depth").alias("depth"), F.col("b.duration").alias("duration"), F.explode("b.values").alias("v"))
    return d.where(F.col("v.value").isNotNull()).select(
        "station", F.concat_ws(":", "element", "depth").alias("source_param"), F.lower("duration").alias("interval"),
        F.col("v.date").try_cast("timestamp").alias("datetime_utc"), F.col("v.value").alias("value"), F.col("v.flag").alias("qualifier"))


def parse_triples(docs: DataFrame, text: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``{"values": [[epoch ms, value, quality], ...]}`` documents."""
    d = docs.select(*keep, F.explode(F.from_json(F.get_json_object(text, "$.values"), "array<array<double>>")).alias("r"))
    at = lambda i: F.try_element_at("r", F.lit(i))
    return d.where(at(2).isNotNull()).select(*keep, F.timestamp_millis(at(1).cast("bigint")).alias("datetime_utc"), at(2).alias("value"), at(3).cast("int").alias("quality"))


def parse_data_arrays(docs: DataFrame, text: str = "value") -> DataFrame:
    """Groups that name their components once and then list rows in that order."""
    group = "array<struct<stream: string, components: array<string>, dataArray: array<array<string>>>>"
    d = docs.select(F.explode(F.from_json(text, group)).alias("g")).select("g.stream", "g.components", F.explode("g.dataArray").alias("r"))
    field = lambda n: F.map_from_arrays("components", "r")[n]
    return d.select("stream", field("id").alias("obs_id"), field("phenomenonTime").try_cast("timestamp").alias("datetime_utc"), field("result").alias("result"))


def long_table(df: DataFrame, prefix: str, site: str, time: str, value: str, param: Column, statistic: Column, interval: str,
               qualifiers: Sequence[str] = (), sentinels: Sequence[float] = ()) -> DataFrame:
    """An already long table: id prefix stripped, flags joined, sentinel values and blanks removed."""
    uid = F.concat(F.lit(prefix + ":"), F.regexp_replace(F.col(site).cast("string"), r"^[A-Z0-9]+-", ""))
    v = F.col(value).try_cast("double")
    flags = F.nullif(F.regexp_replace(F.concat_ws("|", *[F.coalesce(F.col(q).cast("string"), F.lit("")) for q in qualifiers]), r"^\|+|\|+$", ""), F.lit(""))
    out = df.select(uid.alias("site_uid"), F.col(time).try_cast("timestamp").alias("datetime_utc"), v.alias("value"), param.alias("source_param"),
                    statistic.alias("statistic"), F.lit(interval).alias("interval"), flags.alias("qualifier"))
    out = out.where(F.col("value").isNotNull() & F.col("datetime_utc").isNotNull())
    return out.where(~F.col("value").isin(*[float(s) for s in sentinels])) if sentinels else out


# ---- hourly reports ---------------------------------------------------------

# Report quality codes that mean the value must not be used.
BAD_CODES = ["3", "7"]
LETTER_CHECKED = ["temperature", "dew_point_temperature", "station_level_pressure", "sea_level_pressure", "wind_direction", "wind_speed"]
BAD_PRECIP = ["X", "N", "Y", "K", "G", "O", "Z", "A", "M", "D"]
BAD_HUMIDITY = ["f", "o"]
MAX_WIND_DIRECTION = 360.0
MAX_HOURLY_MM = 305.0


def quality_rejects(var: Column, code: Column) -> Column:
    c = F.trim(F.coalesce(code.cast("string"), F.lit("")))
    return (c.isin(*BAD_CODES) | (var.isin(*LETTER_CHECKED) & c.rlike("^[A-Za-z]$")) | ((var == "precipitation") & c.isin(*BAD_PRECIP))
            | ((var == "relative_humidity") & c.isin(*BAD_HUMIDITY)))


def screen_reports(df: DataFrame) -> DataFrame:
    """Drop rejected codes and impossible values; a trace is zero and says so in the qualifier."""
    var = F.col("source_param")
    cap = (F.when(var == "wind_direction", F.col("value") <= MAX_WIND_DIRECTION).when(var == "precipitation", F.col("value") <= MAX_HOURLY_MM)
            .otherwise(F.lit(True)))
    trace = (var == "precipitation") & (F.coalesce("measure_code", F.lit("")) == "T")
    qual = F.nullif(F.concat_ws(",", F.nullif(F.trim(F.col("quality_code")), F.lit("")), F.when(trace, "T")), F.lit(""))
    return df.where(F.col("value").isNotNull() & ~quality_rejects(var, F.col("quality_code")) & cap).withColumn("qualifier", qual)


def _round_hour(ts: str) -> Column:
    """Nearest hour; the half hour goes to the even one, as timestamp rounding does."""
    base = F.date_trunc("hour", ts)
    half = F.col(ts) - base
    up = (half > F.expr("INTERVAL 30 MINUTES")) | ((half == F.expr("INTERVAL 30 MINUTES")) & (F.hour(ts) % 2 == 1))
    return F.when(up, base + F.expr("INTERVAL 1 HOUR")).otherwise(base)


def nearest_hour(df: DataFrame, keys: Sequence[str] = ("site_uid", "source_param"), ts: str = "ts") -> DataFrame:
    """The report closest to each hour, labelled with that hour; ties go to the earlier report."""
    d = df.withColumn("datetime_utc", _round_hour(ts))
    gap = F.abs(F.unix_micros(F.col(ts)) - F.unix_micros("datetime_utc"))
    return pick_row(d, [*keys, "datetime_utc"], [gap, F.col(ts)], last=False)


def hourly_totals(df: DataFrame, keys: Sequence[str] = ("site_uid",), ts: str = "ts") -> DataFrame:
    """Last running total of each reporting hour, from the station's routine minute to the next.

    The routine minute is the commonest minute of routine reports (of all reports where a station
    has none), the smallest on ties."""
    minute = F.minute(ts)
    per = df.groupBy(*keys, minute.alias("m")).agg(F.count("*").alias("c"), F.count_if(F.col("report_type") == "FM15").alias("r"))
    usual = per.groupBy(*keys).agg(F.min_by("m", F.struct(-F.col("r"), F.when(F.col("r") > 0, 0).otherwise(-F.col("c")), F.col("m"))).alias("_routine"))
    d = df.join(usual, list(keys))
    moved = F.unix_micros(F.col(ts)) - F.col("_routine").cast("bigint") * 60_000_000
    hour = F.lit(3_600_000_000)
    label = F.ceil(moved / hour) * hour + F.when(F.col("_routine") >= 30, hour).otherwise(F.lit(0))
    d = d.withColumn("datetime_utc", F.timestamp_micros(label.cast("bigint"))).drop("_routine")
    return pick_row(d, [*keys, "datetime_utc"], [F.col(ts)])


def accumulator_steps(df: DataFrame, keys: Sequence[str], ts: str = "datetime_utc") -> DataFrame:
    """Increase since the series' previous reading; a fall is a reset and gives null."""
    step = F.col("value") - F.col("prev_value")
    return neighbours(df, keys, ts, ["value"]).withColumn("step", F.when(step >= 0, step)).drop("prev_value", "next_value")


# Minutes from UTC by zone abbreviation.
ZONE_MINUTES = {"MST": -420, "MDT": -360, "CST": -360, "CDT": -300, "PST": -480, "PDT": -420, "EST": -300, "EDT": -240, "UTC": 0, "GMT": 0, "Z": 0}


def wall_time_to_utc(df: DataFrame, wall: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """UTC instant and offset of a wall time; hours the clock skips or repeats give null."""
    utc = local_to_utc(wall, zone)
    offset = ((F.unix_timestamp(F.col(wall)) - F.unix_timestamp(utc)) / 60).cast("int")
    return df.select("*", utc.alias("datetime_utc"), offset.alias("utc_offset_min"))


def zoned_to_utc(df: DataFrame, wall: str, zone_code: str, default: int = -420) -> DataFrame:
    """UTC instant from a zone abbreviation on each row."""
    minutes = F.coalesce(_lookup({k: str(v) for k, v in ZONE_MINUTES.items()}, F.col(zone_code)).cast("int"), F.lit(default))
    return df.select("*", F.timestamp_seconds(F.unix_timestamp(F.col(wall)) - minutes * 60).alias("datetime_utc"), minutes.alias("utc_offset_min"))


def period_date(ts: Column, rule: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local date a period stamp stands for: fixed seven-hour shift, zone shift, or the start of a month or water year."""
    return (F.when(rule == "minus7", F.to_date(ts - F.expr("INTERVAL 7 HOURS"))).when(rule == "zone", F.to_date(F.from_utc_timestamp(ts, zone)))
             .when(rule == "month", F.to_date(F.date_trunc("month", ts))).when(rule == "water_year", F.make_date(F.year(ts) - 1, F.lit(10), F.lit(1)))
             .otherwise(F.to_date(ts)))


def infer_interval(df: DataFrame, keys: Sequence[str], ts: str = "datetime_utc", low: int = 3000, high: int = 4200, more_than: int = 5) -> DataFrame:
    """Call a series hourly when its median spacing is 50 to 70 minutes over more than five readings.

    Spacings are whole microseconds counted before the median is taken, so a busy series stays small."""
    from tidemark.functions.shapes import exact_percentiles

    d = df.select(*keys, ts, F.unix_micros(ts).alias("_us"))
    gaps = neighbours(d, keys, ts, ["_us"]).select(*keys, ((F.col("_us") - F.col("prev__us")) / 1e6).alias("gap"))
    mid = exact_percentiles(gaps, keys, "gap", {"median_gap": 0.5})
    return mid.select(*keys, "median_gap", (F.col("n") + 1).alias("readings"),
                      F.when((F.col("n") + 1 > more_than) & F.col("median_gap").between(low, high), "hourly").otherwise("instant").alias("interval"))


# ---- samples ----------------------------------------------------------------

# Accepted units per sampled variable, with factor and offset to the canonical unit.
SAMPLE_UNITS = [
    ("water_temp", "deg c", 1.0, 0.0), ("water_temp", "deg f", 5 / 9, -160 / 9),
    ("specific_conductance", "us/cm", 1.0, 0.0), ("specific_conductance", "umho/cm", 1.0, 0.0), ("specific_conductance", "us/cm @25c", 1.0, 0.0),
    ("specific_conductance", "umho/cm @25c", 1.0, 0.0), ("specific_conductance", "us/cm @25 c", 1.0, 0.0),
    ("ph", "std units", 1.0, 0.0), ("ph", "none", 1.0, 0.0), ("ph", "", 1.0, 0.0), ("ph", "ph units", 1.0, 0.0), ("ph", "std unit", 1.0, 0.0),
    ("dissolved_oxygen", "mg/l", 1.0, 0.0),
    ("turbidity", "ntu", 1.0, 0.0), ("turbidity", "fnu", 1.0, 0.0), ("turbidity", "ntru", 1.0, 0.0), ("turbidity", "nfu", 1.0, 0.0),
    ("nitrate", "mg/l", 1.0, 0.0), ("nitrate", "ug/l", 0.001, 0.0), ("nitrate", "mg/l as n", 1.0, 0.0), ("nitrate", "mg/l asno3", 0.2259, 0.0),
    ("chloride", "mg/l", 1.0, 0.0), ("chloride", "ug/l", 0.001, 0.0), ("sulfate", "mg/l", 1.0, 0.0), ("sulfate", "ug/l", 0.001, 0.0),
    ("fluoride", "mg/l", 1.0, 0.0), ("fluoride", "ug/l", 0.001, 0.0), ("tds", "mg/l", 1.0, 0.0), ("tds", "ug/l", 0.001, 0.0),
    ("arsenic", "ug/l", 1.0, 0.0), ("arsenic", "mg/l", 1000.0, 0.0), ("uranium", "ug/l", 1.0, 0.0), ("uranium", "mg/l", 1000.0, 0.0),
]


def convert_samples(df: DataFrame, units: Sequence[tuple] = tuple(SAMPLE_UNITS)) -> DataFrame:
    """Values in the canonical unit; a unit not accepted for its variable drops the row."""
    rules = fixed(df.sparkSession, list(units), "variable string, _unit string, _factor double, _offset double")
    j = df.withColumn("_unit", F.lower(F.trim(F.coalesce("unit", F.lit(""))))).join(F.broadcast(rules), ["variable", "_unit"])
    return j.withColumn("value", F.col("value") * F.col("_factor") + F.col("_offset")).select(*df.columns)


RESULT_TEXT = r"^\s*([<>]=?)?\s*(?:([A-Z]{2,4})\s+)?(-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)\s*([A-Za-z/%°µ]+(?:/[A-Za-z]+)?)?\s*$"


def parse_results(df: DataFrame, text: str = "result") -> DataFrame:
    """Value, unit and detection flag of results such as ``< MRL 0.0001 MG/L``."""
    part = lambda i: F.nullif(F.regexp_extract(F.col(text), RESULT_TEXT, i), F.lit(""))
    return df.select("*", part(3).try_cast("double").alias("value"), part(4).alias("unit"), part(1).alias("detection_flag"))


def detects(df: DataFrame) -> DataFrame:
    """Rows of a quality table that may become observations."""
    return df.where(F.col("value").isNotNull() & F.col("detection_flag").isNull())


def quality_results(df: DataFrame, ids: Sequence[str], analytes: dict[str, tuple[str, str]], extra: Sequence[str] = ()) -> DataFrame:
    """Results kept beside observations: analyte column -> (characteristic, unit), with the lab fields."""
    cells = F.array(*[F.struct(F.lit(name).alias("characteristic"), F.col(c).cast("string").alias("result_text"), F.lit(u).alias("stated_unit"))
                      for c, (name, u) in analytes.items()])
    d = df.select(*ids, *extra, F.explode(cells).alias("c")).select(*ids, *extra, "c.*").where(F.col("result_text").isNotNull())
    p = parse_results(d, "result_text")
    return p.withColumn("unit", F.coalesce("unit", "stated_unit")).drop("stated_unit")


# ---- tables -----------------------------------------------------------------


def either_column(df: DataFrame, *names: str) -> Column:
    """The first of the names the frame has, later ones filling its gaps; null where it has none."""
    have = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def priority_union(frames: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Rows of several layers, the earlier layer winning per id."""
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn("_layer", F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return pick_row(out, list(key), [F.col("_layer")], last=False).drop("_layer")


FORECAST_KEY = ["station", "element", "period_start", "period_end", "issue_date", "publication_date"]


def merge_versions(old: DataFrame, new: DataFrame, key: Sequence[str] = tuple(FORECAST_KEY)) -> DataFrame:
    """Stored versions plus new ones; the same version published again takes the new values."""
    both = old.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)), allowMissingColumns=True)
    return pick_row(both, [k for k in key if k in both.columns], [F.col("_v")]).drop("_v")


# Name patterns of measured columns in hand-made tables.
COLUMN_PATTERNS = [
    (r"^(air_?temp|airtemp|temp_air|tair)", "air_temp_c"), (r"^(max.*air.*temp|airt_max|tmax)", "air_temp_max_c"),
    (r"^(min.*air.*temp|airt_min|tmin)", "air_temp_min_c"), (r"^(mean.*air.*temp|airt_avg|tavg)", "air_temp_mean_c"),
    (r"^(precip|ppt|rain|rainfall)", "precip_mm"), (r"^(rel.*hum|rh)", "rh_pct"), (r"^(wind.*spe?e?d|ws)", "wind_speed_ms"),
    (r"^(wind.*dir|wd)", "wind_dir_deg"), (r"^(solar|sol_?rad|srad|par)", "solar_wm2"), (r"^(soil.*moist|vwc|sm)", "soil_moisture_pct"),
    (r"^(soil.*temp|st_)", "soil_temp_c"), (r"^(depth.*water|dtw|water_?level)", "depth_to_water_ft"),
]


# Names that are dates or sites where no other pattern fits.
DATE_WORD, NOT_DATE_WORD, SITE_NAME = "date", "update", r"(well|site|point|station).*(id|name|number|no)$|^pointid$"


def guess_columns(names: Sequence[str], patterns: Sequence[tuple[str, str]] = tuple(COLUMN_PATTERNS)) -> dict[str, str | None]:
    """Role of each column from its name: parameter, ``date``, ``site`` or nothing."""
    import re

    out: dict[str, str | None] = {}
    for n in names:
        low = n.strip().lower()
        role = next((p for pat, p in patterns if re.match(pat, low)), None)
        if role is None and DATE_WORD in low and NOT_DATE_WORD not in low:
            role = "date"
        if role is None and re.search(SITE_NAME, low):
            role = "site"
        out[n] = role
    return out


def guessed_observations(df: DataFrame) -> DataFrame:
    roles = guess_columns(df.columns)
    day = next(n for n, r in roles.items() if r == "date")
    site = next((n for n, r in roles.items() if r == "site"), None)
    params = [n for n, r in roles.items() if r not in (None, "date", "site")]
    d = df.select((F.trim(F.col(site).cast("string")) if site else F.lit("unnamed")).alias("site_uid"), F.col(day).try_cast("timestamp").alias("datetime_utc"), *params)
    long = unpivot_report(d, ["site_uid", "datetime_utc"], {p: None for p in params})
    return long.where(F.col("datetime_utc").isNotNull()).withColumn("source_param", _lookup({n: r for n, r in roles.items() if r}, F.col("source_param"))).drop("qualifier")


def tidy_sheet(df: DataFrame, key: str, share: float = 0.5) -> DataFrame:
    """Unpivot the columns of a loose sheet that are mostly numeric, in one plan.

    The numeric share of every column is one aggregate; it is joined back rather than collected."""
    others = [c for c in df.columns if c != key]
    text = df.select(F.col(key).alias("area"), *[F.col(c).cast("string").alias(c) for c in others])
    long = text.unpivot(["area"], others, "measure", "text").withColumn("value", F.col("text").try_cast("double"))
    numeric = long.groupBy("measure").agg((F.count("value") / F.count("*")).alias("s")).where(F.col("s") > share)
    return long.join(numeric, "measure", "left_semi").where(F.col("value").isNotNull()).select("area", "measure", "value")


def state_rows(df: DataFrame, state: str, fips: str, keep: Sequence[str], prefix: str) -> DataFrame:
    """Rows of a state by its code, or by the first digits of the county code where the state is blank."""
    s = F.trim(F.col(state).cast("string"))
    return df.where(s.isin(*keep) | ((F.coalesce(s, F.lit("")) == "") & F.lpad(F.col(fips).cast("string"), 5, "0").startswith(prefix)))


def area_series(docs: DataFrame, text: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """``{area type: {area: [{year_month, value}]}}`` documents as long rows."""
    d = docs.select(*keep, F.explode(F.from_json(text, "map<string,map<string,array<map<string,string>>>>")).alias("area_type", "m"))
    d = d.select(*keep, "area_type", F.explode("m").alias("area_id", "r")).select(*keep, "area_type", "area_id", F.explode("r").alias("r"))
    return d.select(*keep, "area_type", "area_id", F.col("r")["year_month"].alias("year_month"), F.col("r")[value].try_cast("double").alias("value"))


def rating_points(df: DataFrame) -> DataFrame:
    """Elevation and storage pairs of rating documents, top-of-table sentinels removed; datum from the parameter label."""
    d = df.select("rating_id", "ind_parameter", "effective", F.explode(F.from_json("values", "array<array<double>>")).alias("p"))
    datum = F.nullif(F.trim(F.regexp_replace(F.regexp_extract("ind_parameter", r"\((.*)\)", 1), "ft", "")), F.lit(""))
    stor = F.col("p")[1]
    return (d.where((stor >= 0) & (stor < 9.99e7) & ~stor.isin(999999.0, 9999999.0))
            .select(F.split_part("rating_id", F.lit("."), F.lit(1)).alias("location"), "rating_id", F.to_date(F.substring("effective", 1, 10)).alias("effective_date"),
                    datum.alias("elev_datum"), F.col("p")[0].alias("elevation_ft"), stor.alias("storage_af")))


# SI unit to customary unit and factor.
SI_UNITS = [("m", "ft", 3.28084), ("m3", "ac-ft", 1 / AF_M3), ("cms", "cfs", 35.3146667), ("mm", "in", 1 / 25.4)]


def to_customary(df: DataFrame, unit: str = "unit", value: str = "value") -> DataFrame:
    rules = fixed(df.sparkSession, SI_UNITS, "_u string, _en string, _f double")
    j = df.join(F.broadcast(rules), F.col(unit) == F.col("_u"), "left")
    return j.withColumn(value, F.col(value) * F.coalesce("_f", F.lit(1.0))).withColumn(unit, F.coalesce("_en", unit)).drop("_u", "_en", "_f")


def survey_years(df: DataFrame, title: str = "title") -> DataFrame:
    """Last survey year named in a title and the label of all of them."""
    years = F.regexp_extract_all(title, F.lit(r"(1[89]\d\d|20\d\d)"), F.lit(1))
    return df.select("*", F.try_element_at(years, F.lit(-1)).cast("int").alias("survey_year"), F.nullif(F.array_join(years, " and "), F.lit("")).alias("survey_label"))


FLOOD_CATEGORIES = ["action", "minor", "moderate", "major"]


def flood_thresholds(docs: DataFrame, text: str = "value", keep: Sequence[str] = ("site_uid",)) -> DataFrame:
    """Category levels of each gauge by stage and flow; -999 is missing; gauges with none are dropped."""
    level = "struct<stage: double, flow: double>"
    schema = "flood struct<stageUnits: string, flowUnits: string, categories: struct<" + ", ".join(f"{c}: {level}" for c in FLOOD_CATEGORIES) + ">>"
    d = docs.select(*keep, F.from_json(text, schema).alias("d"))
    cols = {f"{c}_{k}": F.col(f"d.flood.categories.{c}.{k}") for c in FLOOD_CATEGORIES for k in ("stage", "flow")}
    cols = {n: F.when(c > -998, c) for n, c in cols.items()}
    return d.where(F.coalesce(*cols.values()).isNotNull()).select(
        *keep, F.col("d.flood.stageUnits").alias("stage_units"), F.col("d.flood.flowUnits").alias("flow_units"), *[c.alias(n) for n, c in cols.items()])


def active_stations(sites: DataFrame, since_year: int, live: DataFrame | None) -> DataFrame:
    """Stations still reporting: by the live inventory, else the stored year (one year's tolerance with no inventory at all).

    ``sites`` has ``stored_year``, null where its metadata could not be read; such a station is kept."""
    if live is None:
        last = F.coalesce(F.col("stored_year") + 1, F.lit(9999))
        return sites.where(last >= since_year)
    j = sites.join(live.select("native_id", F.col("last_year").alias("_live")), "native_id", "left")
    return j.where(F.coalesce("_live", "stored_year", F.lit(9999)) >= since_year).select(*sites.columns)


def drop_retired(meta: DataFrame, retired: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows whose slash-joined key is not retired."""
    keyed = meta.withColumn("_key", F.concat_ws("/", *parts))
    return keyed.join(retired.select(F.col("key").alias("_key")), "_key", "left_anti").drop("_key")


def in_scope(sites: DataFrame, box: tuple[float, float, float, float], buffer: float, states: Sequence[str], hucs: Sequence[str]) -> DataFrame:
    """Sites inside the buffered box, or of a listed state, or in a listed watershed prefix."""
    w, s, e, n = box
    inside = F.col("lon").between(w - buffer, e + buffer) & F.col("lat").between(s - buffer, n + buffer)
    near = F.coalesce(inside, F.lit(False)) | F.coalesce(F.col("state").isin(*states), F.lit(False))
    for h in hucs:
        near = near | F.coalesce(F.col("huc8").startswith(h), F.lit(False))
    return sites.where(near)


def dam_capacity(dams: DataFrame, states: Sequence[str]) -> DataFrame:
    """One record per dam id: a name with the word Dam first, then the most complete, then the highest."""
    names = [c for c in dams.columns if c != "nid_id"]
    filled = sum((F.col(c).isNotNull().cast("int") for c in names), F.lit(0))
    d = dams.where(F.col("state").isin(*states)).withColumn("_filled", filled)
    is_dam = F.coalesce(F.col("dam_name").rlike(r"(?i)\bDam\b"), F.lit(False))
    best = pick_row(d, ["nid_id"], [is_dam, F.col("_filled"), F.coalesce(F.col("height_ft").try_cast("double"), F.lit(-1.0))]).drop("_filled")
    return best.withColumn("height_ft", F.col("height_ft").try_cast("double")).withColumn("storage_af", F.col("storage_af").try_cast("double"))


def watershed_table(rows: DataFrame, box: tuple[float, float, float, float], digits: int = 8) -> DataFrame:
    """Watershed attributes by code, those whose centre lies in the box, one row per code."""
    w, s, e, n = box
    d = rows.where(F.col("lon").between(w, e) & F.col("lat").between(s, n)).withColumn("huc", F.substring("huc", 1, digits))
    return pick_row(d, ["huc"], [F.col("name")], last=False)


def diversion_records(df: DataFrame, structures: DataFrame, stations: DataFrame) -> DataFrame:
    """Flow at a diversion structure becomes a diversion; a structure id becomes its station's id."""
    div = structures.select(F.col("abbrev").alias("_d")).distinct()
    by_id = stations.groupBy("wdid").agg(F.min("native_id").alias("_station"))
    j = df.join(div, df["abbrev"] == div["_d"], "left").join(by_id, "wdid", "left")
    param = F.when(F.col("_d").isNotNull() & (F.col("source_param") == "Streamflow"), "Streamflow:Diversion").otherwise(F.col("source_param"))
    native = F.coalesce("abbrev", "_station", F.concat(F.lit("wdid-"), "wdid"))
    return j.withColumn("source_param", param).withColumn("site_uid", F.concat(F.lit("codwr:"), native)).select(*[c for c in df.columns], "site_uid")


def reprocess(spark: SparkSession, landing: str, parsers: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Parse archived artifacts again: each ``kind=`` folder of a landing area through its own shape."""
    out = None
    for kind, parse in parsers.items():
        rows = parse(spark.read.text(f"{landing}/kind={kind}")).withColumn("kind", F.lit(kind))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
