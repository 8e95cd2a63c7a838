"""Flood status, water quality, overview marts, inverse maps and consistency checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import classify, water_year
from tidemark.functions.shapes import exact_percentiles, neighbours
from tidemark.operators.network import NON_RIVER
from tidemark.schema import LOCAL_ZONE

FLOOD = ["action", "minor", "moderate", "major"]


# ---- flooding ---------------------------------------------------------------


def flood_levels(thresholds: DataFrame) -> DataFrame:
    """Level and kind of each category: stage in feet where the gauge has it, else flow in cfs."""
    factor = F.when(F.col("flow_units") == "cfs", 1.0).when(F.col("flow_units") == "kcfs", 1000.0)
    by_stage = F.coalesce(F.col("stage_units"), F.lit("ft")) == "ft"
    out = [F.col("site_uid")]
    for c in FLOOD:
        use = F.col(f"{c}_stage").isNotNull() & by_stage
        out += [F.when(use, F.col(f"{c}_stage")).alias(f"{c}_st"), F.when(~use, F.col(f"{c}_flow") * factor).alias(f"{c}_fl")]
    return thresholds.select(*out).where(F.coalesce(*[F.col(f"{c}_{k}") for c in FLOOD for k in ("st", "fl")]).isNotNull())


def reading_rank() -> Column:
    """0 below every category, else the place of the highest one a reading meets."""
    met = lambda c: F.coalesce(F.col("stage") >= F.col(f"{c}_st"), F.lit(False)) | F.coalesce(F.col("flow") >= F.col(f"{c}_fl"), F.lit(False))
    out = F.lit(0)
    for i, c in enumerate(FLOOD, start=1):
        out = F.when(met(c), i).otherwise(out)
    return out


def category(rank: Column) -> Column:
    return F.when(rank > 0, F.element_at(F.array(*[F.lit(c) for c in FLOOD]), F.greatest(rank, F.lit(1))))


def read_window(obs: DataFrame, thresholds: DataFrame, now: Column, days: int = 3) -> DataFrame:
    """Stage and flow of each gauge per instant over the last days."""
    o = obs.where(F.col("variable").isin("stage", "discharge") & (F.col("datetime_utc") >= now - F.expr(f"INTERVAL {days} DAYS")))
    o = o.join(thresholds.select("site_uid"), "site_uid", "left_semi")
    v = lambda k: F.max(F.when(F.col("variable") == k, F.col("value")))
    return o.groupBy("site_uid", F.col("datetime_utc").alias("time")).agg(v("stage").alias("stage"), v("discharge").alias("flow"))


def ranked_readings(readings: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Readings with their rank and the rank held over this one and the one before."""
    r = readings.join(flood_levels(thresholds), "site_uid").select("site_uid", "time", "stage", "flow", reading_rank().alias("rank"))
    n = neighbours(r, ["site_uid"], "time", ["rank"])
    return n.withColumn("held", F.coalesce(F.least("rank", "prev_rank"), F.lit(0)) * F.col("prev_rank").isNotNull().cast("int")).drop("prev_rank", "next_rank")


def assess(readings: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Per gauge: highest category held two readings in a row, the peak within it, and the current one."""
    d = ranked_readings(readings, thresholds)
    top = d.groupBy("site_uid").agg(F.max("held").alias("top"), F.count("stage").alias("n_stage"))
    j = d.join(top, "site_uid")
    key = F.when(F.col("n_stage") > 0, F.col("stage")).otherwise(F.col("flow"))
    pool = (F.col("rank") >= F.col("top")) & key.isNotNull()
    at = F.struct(F.col("time"), F.col("stage"), F.col("flow"))
    g = j.groupBy("site_uid", "top").agg(
        F.min_by(F.when(pool, at), F.when(pool, F.struct(-key, F.col("time")))).alias("p"), F.max_by(at, "time").alias("l"), F.max_by("held", "time").alias("cur"))
    p = F.coalesce("p", "l")
    return g.select("site_uid", category(F.col("top")).alias("reached"), category(F.col("cur")).alias("current"), p["time"].alias("peak_time"), p["stage"].alias("peak_stage"), p["flow"].alias("peak_flow"),
                    F.col("l.time").alias("last_time"), F.col("l.stage").alias("last_stage"))


def flood_summary(assessed: DataFrame, now: Column, fresh_hours: int = 6) -> DataFrame:
    """Gauges that reached flooding, worst first; a category is current only from a fresh reading."""
    flooding = F.col("reached").isin("minor", "moderate", "major")
    order = F.array_position(F.array(*[F.lit(c) for c in FLOOD]), F.col("reached"))
    fresh = F.col("last_time") >= now - F.expr(f"INTERVAL {fresh_hours} HOURS")
    d = assessed.where(flooding).withColumn("rank", order)
    return d.select("site_uid", F.col("reached").alias("category"), F.when(F.col("current").isin("minor", "moderate", "major") & fresh, F.col("current")).alias("current"), "peak_time", "peak_stage", "peak_flow",
                    "last_time", "last_stage", "rank").orderBy(F.desc("rank"), "peak_time", "site_uid")


def flood_checked(assessed: DataFrame) -> DataFrame:
    return assessed.agg(F.count("*").alias("checked"), F.max("last_time").alias("latest_reading"))


# ---- water quality ----------------------------------------------------------


def quality_sites(segments: DataFrame, flowlines: DataFrame, series: DataFrame) -> DataFrame:
    """Stream sites on named reaches with temperature or salinity, other than ditches and ponds."""
    has = series.where(F.col("variable").isin("water_temp", "specific_conductance")).select("site_uid").distinct()
    f = flowlines.where(F.coalesce(F.trim("gnis_id"), F.lit("")) != "").select("comid", "gnis_id")
    s = segments.where((F.col("river_method") == "snap") & (F.col("site_type") == "stream") & F.col("huc8_name").isNotNull())
    return s.join(f, "comid").join(has, "site_uid", "left_semi").where(~F.lower(F.trim("name")).rlike(NON_RIVER)).select("gnis_id", "site_uid", F.col("huc8_name").alias("segment"), "source", "name", "totdasqkm")


def quality_days(obs: DataFrame, sites: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Mean per site, variable, local day, interval and statistic."""
    o = obs.where(F.col("variable").isin("water_temp", "specific_conductance") & F.col("interval").isin("daily", "irregular", "instantaneous", "15min"))
    o = o.join(sites.select("site_uid").distinct(), "site_uid", "left_semi")
    return o.groupBy("site_uid", "variable", F.to_date(F.from_utc_timestamp("datetime_utc", zone)).alias("date"), "interval", F.coalesce("statistic", F.lit("instantaneous")).alias("statistic")).agg(F.avg("value").alias("value"))


def temperature_days(q: DataFrame, sites: DataFrame) -> DataFrame:
    """One value per sensor and day: the daily maximum where the sensor has any, else the mean."""
    d = q.where((F.col("variable") == "water_temp") & (F.col("interval") == "daily")).join(sites.select("site_uid", "name", "segment"), "site_uid")
    of = lambda k: [F.avg(F.when(F.col("statistic") == k, F.col("value"))).alias(k), F.count_if(F.col("statistic") == k).alias(f"n_{k}")]
    # one row a sensor and day first, so the readings are read once and the window over a sensor is bounded by the calendar
    d = d.groupBy("name", "segment", "date").agg(*of("max"), *of("mean"))
    d = d.withColumn("has_max", F.max(F.col("n_max") > 0).over(Window.partitionBy("name", "segment")))
    pick = lambda pre: F.when(F.col("has_max"), F.col(f"{pre}max")).otherwise(F.col(f"{pre}mean"))
    return d.where(pick("n_") > 0).select("name", "segment", "has_max", "date", pick("").alias("value"))


def heat_years(days: DataFrame, min_summer: int = 60, min_years: int = 3, span: int = 7, min_in_span: int = 6) -> DataFrame:
    """Yearly maximum of the seven-day mean, for sensors with enough years of summer days.

    A sensor has one value a day, so its windows run over its own days in order, and nothing is filed under several days. A window
    may end on days without a reading: those that follow a reading are taken with it, up to the next one. Summer days and maxima of
    a year are one aggregate behind the same shuffle."""
    k = ["name", "segment", "has_max"]
    summer = F.month("date").isin(6, 7, 8, 9) & F.col("value").isNotNull()
    of_sensor = Window.partitionBy(*k).orderBy(F.unix_date("date"))
    ahead = F.date_diff(F.lead("date").over(of_sensor), "date")
    ends = []
    for j in range(span - min_in_span + 1):
        w = of_sensor.rangeBetween(j - span + 1, 0)
        roll = F.when(F.count("value").over(w) >= min_in_span, F.avg("value").over(w))
        end = F.struct(F.year(F.date_add("date", j)).alias("year"), (summer if j == 0 else F.lit(False)).alias("summer"), roll.alias("roll"))
        # the day of the next row is that row's own end, and no window ends behind the last row
        ends.append(end if j == 0 else F.when(ahead > j, end))
    w = days.select(*k, F.array_compact(F.array(*ends)).alias("e")).select(*k, F.explode("e").alias("e"))
    y = w.groupBy(*k, F.col("e.year").alias("year")).agg(F.count_if("e.summer").alias("n"), F.max("e.roll").alias("value"))
    good = F.col("n") >= min_summer
    y = y.withColumn("years", F.count_if(good).over(Window.partitionBy(*k))).where(good & (F.col("years") >= min_years) & F.col("value").isNotNull())
    return y.select("name", "segment", "year", "value", F.when(F.col("has_max"), "7DADM").otherwise("7-day mean").alias("metric"), "years")


def temperature_season(days: DataFrame, this_year: int, min_days: int = 365) -> DataFrame:
    """Percentiles by day of year of earlier years beside this year's value."""
    k = ["name", "segment"]
    d = days.withColumn("doy", F.least(F.dayofyear("date"), F.lit(365)))
    past, now = F.year("date") < this_year, F.year("date") == this_year
    # earlier years and this one in one aggregate: the days are read once
    g = d.groupBy(*k, "doy").agg(F.percentile(F.when(past, F.col("value")), F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("q"), F.count_if(past).alias("days"),
                                 F.count(F.when(past, F.col("value"))).alias("n"), F.avg(F.when(now, F.col("value"))).alias("this_year"))
    b = g.withColumn("n", F.sum("n").over(Window.partitionBy(*k))).where((F.col("n") > min_days) & (F.col("days") > 0))
    return b.select(*k, "doy", F.col("q")[0].alias("p10"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p90"), "this_year")


def salinity_days(q: DataFrame, sites: DataFrame) -> DataFrame:
    """One value per site, day and kind: a sensor's daily mean or the day's samples."""
    d = q.where(F.col("variable") == "specific_conductance")
    kind = F.when((F.col("interval") == "daily") & (F.col("statistic") == "mean"), "sensor").when(F.col("interval") != "daily", "samples")
    d = d.withColumn("kind", kind).where(F.col("kind").isNotNull()).join(sites.select("site_uid", "segment"), "site_uid")
    return d.groupBy("site_uid", "segment", "date", "kind").agg(F.avg("value").alias("value"))


def salinity_profile(days: DataFrame) -> DataFrame:
    """Median by segment and decade. A segment may hold any number of sites, so the median is exact by bins."""
    d = days.withColumn("decade", F.floor(F.year("date") / 10) * 10)
    return exact_percentiles(d, ["segment", "decade"], "value", {"median": 0.5}).withColumnRenamed("n", "n_days")


def salinity_years(days: DataFrame) -> DataFrame:
    return exact_percentiles(days.withColumn("year", F.year("date")), ["segment", "year", "kind"], "value", {"median": 0.5}).withColumnRenamed("n", "n_days")


# ---- marts ------------------------------------------------------------------


def period_status(rated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Segments rated, how many below normal, and the worst one."""
    r = rated.where(F.col("cls").isNotNull() & F.col("pct").isNotNull())
    g = r.groupBy(*keys).agg(F.count("*").alias("segments_rated"), F.count_if(F.col("cls").contains("below")).alias("segments_below_normal"), F.min_by(F.struct("segment", "cls", "pct"), F.struct("pct", "segment")).alias("w"))
    return g.select(*keys, "segments_rated", "segments_below_normal", F.col("w.segment").alias("worst_segment"), F.col("w.cls").alias("worst_class"), F.round("w.pct", 1).alias("worst_percentile"))


def overview(segments: DataFrame, flow: DataFrame, ratings: DataFrame, dry: DataFrame, temperature: DataFrame, salinity: DataFrame, rain: DataFrame, drought: DataFrame) -> DataFrame:
    """One row per segment: latest flow and class, the year's weeks, dry days, temperature, salinity, rain, drought."""
    f = flow.groupBy("segment").agg(F.max_by("mean_cfs", "week_start").alias("flow"), F.max("week_start").alias("week"))
    year = flow.join(f.select("segment", "week"), "segment").where(F.col("week_start") > F.date_sub("week", 364))
    f = f.join(year.groupBy("segment").agg(F.array_sort(F.collect_list(F.struct("week_start", "mean_cfs"))).alias("spark")), "segment")
    r = ratings.groupBy("segment").agg(F.max_by("pct", "week_start").alias("pct"), F.max_by("cls", "week_start").alias("cls"))
    d = dry.groupBy("segment").agg(F.max_by("any_dry_days", "year").alias("dry"), F.median(F.when(F.col("year").between(1991, 2020), F.col("any_dry_days"))).alias("dry_median"))
    s = salinity.groupBy("segment").agg(F.max_by(F.struct("median", "decade"), "decade").alias("sc"))
    out = segments
    for part in (f, r, d, temperature, s, rain, drought):
        out = out.join(part, "segment", "left")
    return out.select("segment", "flow", "week", F.transform("spark", lambda w: w["mean_cfs"]).alias("spark"), "pct", "cls", "dry", "dry_median", "temp", F.col("sc.median").alias("salinity"), F.col("sc.decade").alias("salinity_decade"), "precip3_pct", "dsci")


def latest_temperature(season: DataFrame) -> DataFrame:
    """Newest value of this year on each segment's sensor with most days."""
    return season.where(F.col("this_year").isNotNull()).groupBy("segment").agg(F.max_by("this_year", F.struct("doy", "name")).alias("temp"))


def three_month_rain(months: DataFrame, key: str = "segment") -> DataFrame:
    """Rain of the last three complete months as a percent of their normals: a ratio of sums."""
    w = Window.partitionBy(key).orderBy(F.desc("month"))
    m = months.where("complete").withColumn("k", F.row_number().over(w)).where(F.col("k") <= 3).groupBy(key).agg(F.sum("total").alias("t"), F.sum("normal").alias("n"))
    return m.select(key, F.when(F.col("n") > 0, 100 * F.col("t") / F.col("n")).alias("precip3_pct"))


def headline(rivers: DataFrame, rated: DataFrame, findings: DataFrame, weeks: DataFrame, as_of: Column, reporting_days: int = 90) -> DataFrame:
    """Per river: span, mean of the last 52 weeks, whether it still reports, rated and below-normal segments, warnings."""
    w = weeks.groupBy("river").agg(F.min("week_start").alias("first_week"), F.max("week_start").alias("last_week"), F.avg(F.when(F.date_diff(as_of, "week_start") < 364, F.col("mean_cfs"))).alias("mean_52"))
    r = rated.groupBy("river").agg(F.count("*").alias("rated"), F.count_if(F.col("cls").contains("below")).alias("below"))
    f = findings.groupBy("river").agg(F.count_if(F.col("severity") == "warn").alias("warnings"))
    j = rivers.join(w, "river", "left").join(r, "river", "left").join(f, "river", "left").fillna(0, ["rated", "below", "warnings"])
    return j.withColumn("reporting", F.coalesce(F.date_diff(as_of, F.col("last_week")) <= reporting_days, F.lit(False)))


def headline_totals(entries: DataFrame) -> DataFrame:
    return entries.agg(F.count("*").alias("rivers"), F.count_if(F.col("rated") > 0).alias("rated"), F.count_if(F.col("below") > 0).alias("with_a_segment_below"), F.count_if("reporting").alias("reporting"), F.sum("warnings").alias("warnings"))


def watershed_rivers(segments: DataFrame) -> DataFrame:
    """Rivers whose segments sit in each watershed."""
    s = segments.where(F.col("huc8").isNotNull()).select("huc8", "slug", "name").distinct()
    return s.groupBy("huc8").agg(F.array_sort(F.collect_set(F.struct("name", "slug"))).alias("rivers"))


def winters(weekly: DataFrame, keys: Sequence[str], baseline: tuple[int, int] = (2004, 2025), last: int = 3) -> DataFrame:
    """The last winters by week of the water year beside the baseline median of the week."""
    d = weekly.withColumn("wy", water_year("date")).withColumn("week", F.floor(F.date_diff("date", F.make_date(F.col("wy") - 1, F.lit(10), F.lit(1))) / 7))
    med = d.where(F.col("wy").between(*baseline)).groupBy(*keys, "week").agg(F.median("value").alias("median"))
    place = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.desc("wy")))
    y = d.groupBy(*keys, "wy", "week").agg(F.avg("value").alias("value")).withColumn("place", place).where(F.col("place") <= last).drop("place")
    return y.join(med, [*keys, "week"], "left")


# ---- consistency ------------------------------------------------------------


def violations(df: DataFrame, subject: Column, rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule, every rule checked in a single pass over the table."""
    broken = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(n)) for n, bad in rules.items()]), lambda n: n.isNotNull())
    return df.select(subject.cast("string").alias("subject"), F.explode(broken).alias("rule"))


def rating_rules(pct: str = "pct", cls: str = "cls") -> dict[str, Column]:
    p, c = F.col(pct), F.col(cls)
    return {"percentile outside 0..100": ~p.between(0, 100), "class does not fit percentile": classify(pct) != c, "class without percentile": c.isNotNull() & p.isNull()}


def percent_rule(percent: str, value: str, normal: str, tolerance: float = 0.1) -> dict[str, Column]:
    expect = 100 * F.col(value) / F.col(normal)
    return {"percent is not value over normal": F.abs(F.col(percent) - expect) > tolerance, "percent without a normal": F.col(percent).isNotNull() & F.col(normal).isNull()}


def flood_rules() -> dict[str, Column]:
    at = lambda c: F.coalesce(F.array_position(F.array(*[F.lit(x) for x in FLOOD]), F.col(c)), F.lit(0))
    return {"current above the peak category": at("current") > at("category"), "peak after the last reading": F.col("peak_time") > F.col("last_time")}


def snow_rules() -> dict[str, Column]:
    return {"rated without a usual": F.col("cls").isNotNull() & F.col("usual").isNull(), "little but classed": F.col("little") & F.col("cls").isNotNull(), "percentile without a usual": F.col("pct").isNotNull() & F.col("usual").isNull()}


def sum_violations(members: DataFrame, totals: DataFrame, keys: Sequence[str], value: str, total: str, tolerance: float = 1.0) -> DataFrame:
    """Groups whose members do not add up to the stated total, or that have no total at all."""
    m = members.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    j = m.join(totals.select(*keys, total), list(keys), "full_outer")
    bad = F.coalesce(F.abs(F.col("_sum") - F.col(total)) > tolerance, F.lit(True))
    return j.where(bad).select(F.concat_ws("/", *keys).alias("subject"), F.lit("members do not sum to the total").alias("rule"))


def missing_members(listed: DataFrame, present: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Listed entities that are missing, and present ones that are not listed."""
    a = listed.select(*keys).distinct()
    b = present.select(*keys).distinct()
    gone = a.join(b, list(keys), "left_anti").select(F.concat_ws("/", *keys).alias("subject"), F.lit(f"{what} is missing").alias("rule"))
    extra = b.join(a, list(keys), "left_anti").select(F.concat_ws("/", *keys).alias("subject"), F.lit(f"{what} is not listed").alias("rule"))
    return gone.unionByName(extra)


def length_violations(rows: DataFrame, keys: Sequence[str], series: str) -> DataFrame:
    """Parallel series of one entity that differ in length."""
    n = rows.groupBy(*keys, series).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.min("n").alias("a"), F.max("n").alias("z"))
    return n.where(F.col("a") != F.col("z")).select(F.concat_ws("/", *keys).alias("subject"), F.lit("series differ in length").alias("rule"))
