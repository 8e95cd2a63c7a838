"""Canonical variables and units, guards, quality flags and site repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import dms_to_degrees, utm_to_degrees
from tidemark.functions.literals import fixed
from tidemark.functions.shapes import pick_row
from tidemark.schema import FUTURE_DAYS, MIN_YEAR, OBS_KEY

# No-data markers that apply to every unsigned variable.
DEFAULT_CODES = (-9999.0, -99999.0)

# Basin names by four-digit, then two-digit watershed code.
BASINS = [
    ("1301", "Rio Grande Headwaters"), ("1302", "Rio Grande-Elephant Butte"), ("1303", "Rio Grande-Mimbres"),
    ("1304", "Rio Grande-Amistad"), ("1305", "Rio Grande Closed Basins"), ("1306", "Upper Pecos"),
    ("1307", "Lower Pecos"), ("1308", "Rio Grande-Amistad (TX)"), ("1408", "San Juan"), ("1502", "Little Colorado"),
    ("1504", "Upper Gila"), ("1508", "Sonora (Animas Valley)"), ("1108", "Upper Canadian"), ("1109", "Lower Canadian"),
    ("1104", "Upper Cimarron"), ("1112", "North Fork Red"), ("1203", "Brazos Headwaters"),
    ("1205", "Colorado Headwaters (TX)"),
    ("13", "Rio Grande"), ("14", "Upper Colorado"), ("15", "Lower Colorado"), ("11", "Arkansas-White-Red"),
    ("12", "Texas-Gulf"),
]


def apply_crosswalk(df: DataFrame, crosswalk: DataFrame, registry: DataFrame, keep_unmapped: bool = False) -> DataFrame:
    """Map (source, source_param) to a canonical variable, unit and value.

    A row's own statistic, interval and depth win over the mapping's. An empty variable means mapped
    to nothing on purpose. The crosswalk is joined without a hint: the planner broadcasts it while
    its measured size allows and shuffles otherwise."""
    have = set(df.columns)
    x = (crosswalk.where(F.col("variable") != "")
         .select(*[F.col(c).alias(f"x_{c}") for c in ("source", "source_param", "variable", "factor", "offset",
                                                     "statistic", "interval", "source_unit", "depth_cm")])
         .join(registry.select(F.col("variable").alias("x_variable"), F.col("unit").alias("x_unit")), "x_variable", "left"))
    j = df.join(x, (df["source"] == x["x_source"]) & (df["source_param"] == x["x_source_param"]),
                "left" if keep_unmapped else "inner")
    own = lambda c, kind="string": (F.coalesce(F.col(c), F.col(f"x_{c}")) if c in have else F.col(f"x_{c}"))
    new = {
        "variable": F.col("x_variable"), "unit": F.col("x_unit"),
        "value": F.col("value").cast("double") * F.coalesce(F.col("x_factor"), F.lit(1.0)) + F.coalesce(F.col("x_offset"), F.lit(0.0)),
        "statistic": own("statistic"), "interval": own("interval"), "depth_cm": own("depth_cm"),
        "source_unit": F.col("source_unit") if "source_unit" in have else F.col("x_source_unit"),
    }
    return j.select(*[F.col(c) for c in df.columns if c not in new], *[e.alias(n) for n, e in new.items()])


def override_variable(df: DataFrame, rules: DataFrame, registry: DataFrame) -> DataFrame:
    """Change the variable of listed series: by site or any site, parameter and optional qualifier.

    Rules are ordered and the last that fits wins. Each of the four rule kinds is one equi-join on a
    unique key, so neither rows nor rules multiply."""
    out = df
    hits = []
    for any_site in (True, False):
        for any_qual in (True, False):
            tag = f"_r{int(any_site)}{int(any_qual)}"
            kind = rules.where(((F.col("site_uid") == "*") == any_site) & ((F.coalesce("qualifier", F.lit("")) == "") == any_qual))
            keys = ["source_param"] + ([] if any_site else ["site_uid"]) + ([] if any_qual else ["qualifier"])
            best = kind.groupBy(*keys).agg(F.max(F.struct("rule_no", "variable")).alias(tag))
            out = out.join(best, keys, "left")
            hits.append(F.col(tag))
    winner = F.greatest(*hits)["variable"]
    changed = F.col("variable").isNotNull() & winner.isNotNull()
    out = out.withColumn("_new", F.when(changed, winner))
    units = registry.select(F.col("variable").alias("_new"), F.col("unit").alias("_unit"))
    out = out.join(units, "_new", "left")
    fresh = {"variable": F.coalesce("_new", "variable")}
    if "unit" in df.columns:
        fresh["unit"] = F.when(F.col("_new").isNotNull(), F.col("_unit")).otherwise(F.col("unit"))
    return out.select(*[fresh.get(c, F.col(c)).alias(c) for c in df.columns])


def _codes(registry: DataFrame, defaults: Sequence[float]) -> DataFrame:
    every = F.array(*[F.lit(float(c)) for c in defaults])
    return (registry.where(~F.coalesce("signed", F.lit(False)))
            .select(F.col("variable").alias("_mv"), F.array_union(every, F.coalesce("missing_codes", F.array().cast("array<double>"))).alias("_codes")))


def with_missing_code(df: DataFrame, registry: DataFrame, defaults: Sequence[float] = DEFAULT_CODES) -> DataFrame:
    """Add ``is_missing_code``: the value is a no-data marker of its variable (tolerance 1e-6)."""
    codes = _codes(registry, defaults)
    j = df.join(codes, df["variable"] == codes["_mv"], "left")
    hit = F.coalesce(F.exists("_codes", lambda c: F.abs(F.col("value") - c) < 1e-6), F.lit(False))
    return j.select(*[df[c] for c in df.columns], hit.alias("is_missing_code"))


def drop_missing_codes(df: DataFrame, registry: DataFrame, defaults: Sequence[float] = DEFAULT_CODES) -> DataFrame:
    return with_missing_code(df, registry, defaults).where(~F.col("is_missing_code")).drop("is_missing_code")


def plausible_date(ts: str, now: Column, min_year: int = MIN_YEAR, slack_days: int = FUTURE_DAYS) -> Column:
    """Not before ``min_year`` and at most a couple of days ahead of ``now``."""
    return (F.year(ts) >= min_year) & (F.col(ts) <= now + F.expr(f"INTERVAL {slack_days} DAYS"))


def guard_dates(df: DataFrame, now: Column) -> DataFrame:
    return df.where(plausible_date("datetime_utc", now))


def guard_nulls(df: DataFrame) -> DataFrame:
    """Rows with an instant, a site, a variable and a value."""
    return df.dropna(subset=["datetime_utc", "site_uid", "variable", "value"])


def _bounds(df: DataFrame, registry: DataFrame) -> DataFrame:
    b = registry.select(F.col("variable").alias("_bv"), F.col("unit").alias("reg_unit"), "valid_min", "noise_floor", "valid_max")
    return df.join(b, df["variable"] == b["_bv"], "left").drop("_bv")


def _below() -> Column:
    return F.coalesce(F.col("value") < F.col("valid_min"), F.lit(False))


def _in_noise() -> Column:
    return _below() & F.coalesce(F.col("value") >= F.col("noise_floor"), F.lit(False))


def _above() -> Column:
    return F.coalesce(F.col("value") > F.col("valid_max"), F.lit(False))


def qc_flag(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Every row with ``qc_flag``: implausible, near_zero or ok. Values are never altered."""
    flag = (F.when(_in_noise(), "near_zero").when(_below() | _above(), "implausible").otherwise("ok"))
    return (_bounds(df, registry).withColumn("qc_flag", flag)
            .drop("reg_unit", "valid_min", "noise_floor", "valid_max"))


def clean(df: DataFrame, registry: DataFrame) -> DataFrame:
    return qc_flag(df, registry).where(F.col("qc_flag") != "implausible")


def range_stats(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Per variable: rows, extremes, and how many fall below, in the noise band, above or negative."""
    b = _bounds(df.where(F.col("value").isNotNull()), registry)
    return b.groupBy("variable", F.col("reg_unit").alias("unit"), "valid_min", "noise_floor", "valid_max").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.count_if(_below() & ~_in_noise()).alias("below"), F.count_if(_in_noise()).alias("near_zero"),
        F.count_if(_above()).alias("above"), F.count_if(F.col("value") < 0).alias("negative"))


def registry_problems(registry: DataFrame, crosswalk: DataFrame, units: Sequence[str]) -> DataFrame:
    """Violations in the variable registry and the crosswalk, one row each."""
    def broken(cond: Column, what: str) -> DataFrame:
        return registry.where(cond).select(F.col("variable").alias("subject"), F.lit(what).alias("problem"))

    rules = [
        (~F.col("unit").isin(*units), "unit not declared"),
        (F.col("noise_floor").isNotNull() & F.col("valid_min").isNull(), "noise floor needs a lower bound"),
        (F.col("noise_floor") > F.col("valid_min"), "noise floor above the lower bound"),
        (F.col("valid_min") > F.col("valid_max"), "lower bound above upper bound"),
    ]
    out = broken(*rules[0])
    for r in rules[1:]:
        out = out.unionByName(broken(*r))
    stray = (crosswalk.where(F.col("variable") != "").join(registry, "variable", "left_anti")
             .select(F.concat_ws("/", "source", "source_param").alias("subject"), F.lit("maps to an unknown variable").alias("problem")))
    return out.unionByName(stray)


# The contiguous states, south, north, west and east.
CONUS = (24.0, 50.0, -125.0, -66.0)


def _with_note(meta: Column, note: Column) -> Column:
    """Append a member to a JSON object's text, leaving its other members as they were written."""
    body = F.rtrim(F.regexp_replace(F.trim(meta), r"\}$", ""))
    usable = F.coalesce(F.trim(meta).rlike(r"(?s)^\{.*\}$"), F.lit(False))
    entry = F.concat(F.lit('"coordinate_fix": "'), note, F.lit('"}'))
    return (F.when(usable & (body != "{"), F.concat(body, F.lit(", "), entry)).otherwise(F.concat(F.lit("{"), entry)))


def repair_coordinates(sites: DataFrame) -> DataFrame:
    """Null out points at (0, 0); flip a longitude that lost its minus sign; note either in the metadata."""
    south, north, west, east = CONUS
    zero = F.coalesce((F.abs("lat") < 1e-9) & (F.abs("lon") < 1e-9), F.lit(False))
    flip = F.coalesce((F.col("lon") > 0) & F.col("lat").between(south, north) & (-F.col("lon")).between(west, east), F.lit(False))
    meta = F.col("raw_metadata") if "raw_metadata" in sites.columns else F.lit(None).cast("string")
    fix = F.when(zero, "zero_zero").when(flip, "sign_flipped")
    note = (F.when(zero, "latitude and longitude were both 0; location treated as missing")
             .when(flip, "longitude was positive; sign flipped"))
    keep = [c for c in sites.columns if c not in ("lat", "lon", "raw_metadata")]
    return sites.select(*keep, F.when(~zero, F.col("lat")).alias("lat"),
                        F.when(zero, None).when(flip, -F.col("lon")).otherwise(F.col("lon")).alias("lon"),
                        F.when(fix.isNotNull(), _with_note(meta, note)).otherwise(meta).alias("raw_metadata"),
                        fix.alias("coordinate_fix"))


def upsert_sites(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per site, the newest write winning; the uid is source and native id."""
    both = (old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)), allowMissingColumns=True)
            .withColumn("site_uid", F.concat_ws(":", "source", "native_id")))
    return pick_row(both, ["site_uid"], [F.col("_age")]).drop("_age")


def with_basin(sites: DataFrame, huc: str = "huc8") -> DataFrame:
    """Basin name from the longest known watershed prefix, four digits then two."""
    named = fixed(sites.sparkSession, BASINS, "prefix string, basin_name string")
    four = named.select(F.col("prefix").alias("_p4"), F.col("basin_name").alias("_b4"))
    two = named.select(F.col("prefix").alias("_p2"), F.col("basin_name").alias("_b2"))
    j = (sites.join(F.broadcast(four), F.substring(sites[huc], 1, 4) == F.col("_p4"), "left")
         .join(F.broadcast(two), F.substring(sites[huc], 1, 2) == F.col("_p2"), "left"))
    return j.select(*[sites[c] for c in sites.columns if c != "basin"], F.coalesce("_b4", "_b2").alias("basin"))


def station_coordinates(meters: DataFrame, meridian: float = -105.0) -> DataFrame:
    """lat/lon from decimal degrees, else degrees-minutes-seconds text, else UTM eastings."""
    dlat, dlon = dms_to_degrees("lat_dms"), dms_to_degrees("lon_dms")
    ulat, ulon = utm_to_degrees("easting", "northing", meridian)
    dec = F.col("lat_dd").isNotNull() & F.col("lon_dd").isNotNull()
    dms = dlat.isNotNull() & dlon.isNotNull()
    pick = lambda a, b, c: F.when(dec, a).when(dms, b).otherwise(c)
    basis = F.when(dec, "decimal").when(dms, "dms").when(F.col("easting").isNotNull() & F.col("northing").isNotNull(), "utm")
    return meters.select("*", pick(F.col("lat_dd"), dlat, ulat).alias("lat"),
                         pick(F.col("lon_dd"), dlon, ulon).alias("lon"), basis.alias("basis"))


def match_coordinates(stations: DataFrame, meters: DataFrame) -> DataFrame:
    """Give stations the coordinates of the meter with their id, else of the only meter with their name."""
    plain = lambda c: F.regexp_replace(F.lower(F.col(c)), "[^a-z0-9]", "")
    located = meters.where(F.col("lat").isNotNull())
    by_id = (located.where(F.col("station_id").isNotNull()).groupBy("station_id")
             .agg(F.max(F.struct("lat", "lon")).alias("_i")))
    by_name = (located.where(F.col("station_id").isNull()).groupBy(plain("name").alias("_key"))
               .agg(F.count("*").alias("_n"), F.max(F.struct("lat", "lon")).alias("_m")).where("_n = 1"))
    j = (stations.join(by_id, "station_id", "left").withColumn("_key", plain("name")).join(by_name, "_key", "left"))
    where = F.coalesce("_i", "_m")
    return j.select(*stations.columns, where["lat"].alias("lat"), where["lon"].alias("lon"),
                    F.when(F.col("_i").isNotNull(), "id").when(F.col("_m").isNotNull(), "name").alias("matched_by"))


def clean_years(df: DataFrame, ts: str, lo: int, hi: int) -> DataFrame:
    """Null instants whose year is absurd, and flag them."""
    bad = F.coalesce(~F.year(ts).between(lo, hi), F.lit(False))
    return df.withColumn("year_dropped", bad).withColumn(ts, F.when(~F.col("year_dropped"), F.col(ts)))


def join_flags(df: DataFrame, flags: Sequence[str], drop_if: str) -> DataFrame:
    """Remove readings whose ``drop_if`` flag is set; name the other set flags in the qualifier."""
    named = F.concat_ws("|", *[F.when(F.coalesce(F.col(f), F.lit(False)), f) for f in flags])
    return (df.where(~F.coalesce(F.col(drop_if), F.lit(False)))
            .withColumn("qualifier", F.nullif(named, F.lit(""))).drop(*flags, drop_if))


def dedup_observations(df: DataFrame, keep: Sequence[Column] | None = None) -> DataFrame:
    """One row per observation key (null depth equals null depth), the newest run winning.

    The instant leads the key: sorting starts from an eight-byte value that tells rows apart, where
    site names of one source share their first letters."""
    key = ["datetime_utc", *[k for k in OBS_KEY if k != "datetime_utc"]]
    return pick_row(df, key, list(keep or [F.col("ingest_run_id")]))
