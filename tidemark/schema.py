"""Table schemas and domain constants of the observation archive."""

from __future__ import annotations

from pyspark.sql import types as T

OBSERVATIONS = T.StructType([
    T.StructField("site_uid", T.StringType()),
    T.StructField("variable", T.StringType()),
    T.StructField("datetime_utc", T.TimestampType()),
    T.StructField("utc_offset_min", T.ShortType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("statistic", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("source_param", T.StringType()),
    T.StructField("source_unit", T.StringType()),
    T.StructField("ingest_run_id", T.StringType()),
    T.StructField("depth_cm", T.DoubleType()),
])

# Partition columns of a stored archive; they appear on read.
STORED = T.StructType(OBSERVATIONS.fields + [
    T.StructField("source", T.StringType()),
    T.StructField("year", T.IntegerType()),
])

OBS_KEY = ["site_uid", "variable", "datetime_utc", "interval", "statistic", "depth_cm"]

SITES = T.StructType([
    T.StructField("site_uid", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("native_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("site_type", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("huc8", T.StringType()),
    T.StructField("basin", T.StringType()),
    T.StructField("raw_metadata", T.StringType()),
])

# Unit factors, earth radii and thresholds that results depend on.
CFS_DAY_AF = 1.983471
MM_TO_IN = 0.0393700787
M_TO_IN = 39.3700787
AF_M3 = 1233.48184
SQ_M_PER_SQ_MI = 2589988.11
EARTH_AREA_KM = 6371.0088
EARTH_M = 6371000.0
MIN_YEAR = 1850
FUTURE_DAYS = 2

# Copy priority, expected sub-daily readings per day, rating class bounds.
SOURCE_PRIORITY = ["usgs", "usbr_hydrodata", "usace_cwms", "nwps", "usbr_albuq", "codwr", "ose_meas"]
READINGS_PER_DAY = {"5min": 288, "15min": 96, "hourly": 24}
RATING_CLASSES = [
    (10, "much below normal"),
    (25, "below normal"),
    (76, "normal"),
    (91, "above normal"),
    (101, "much above normal"),
]
COARSE_INTERVALS = ["daily", "weekly", "monthly", "annual"]
LOCAL_ZONE = "America/Denver"
