"""Daily flow per copy, the copy used, weekly means per gauge and segment, and checks between copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import priority_of, water_year, week_start
from tidemark.functions.shapes import neighbours, pick_row
from tidemark.schema import COARSE_INTERVALS, LOCAL_ZONE, READINGS_PER_DAY, SOURCE_PRIORITY


def daily_flow(df: DataFrame, variable: str = "discharge", zone: str = LOCAL_ZONE, min_share: float = 0.5) -> DataFrame:
    """One value per site and day: the stored daily mean, else the mean of enough sub-daily readings.

    Daily rows carry their local date already; sub-daily instants are shifted to the local day. A
    day needs ``min_share`` of the readings its interval promises; with several intervals the finest
    is used. Stored daily values win, and the two are never averaged together. All of it is one
    aggregate with a mean and a count per interval, so the readings are read and shuffled once."""
    is_day = (F.col("interval") == "daily") & (F.col("statistic") == "mean")
    v = df.where((F.col("variable") == variable) & (is_day | F.col("interval").isin(*READINGS_PER_DAY)))
    local = F.when(is_day, F.to_date("datetime_utc")).otherwise(F.to_date(F.from_utc_timestamp("datetime_utc", zone)))
    of = lambda k: F.when(F.col("interval") == k, F.col("value"))
    fine = sorted(READINGS_PER_DAY, key=READINGS_PER_DAY.get, reverse=True)
    g = v.groupBy("site_uid", local.alias("date")).agg(
        F.avg(of("daily")).alias("daily"), F.count_if(is_day).alias("n_daily"), F.min(F.when(is_day, F.col("qualifier"))).alias("qualifier"),
        *[F.avg(of(k)).alias(f"m_{k}") for k in fine], *[F.count_if(F.col("interval") == k).alias(f"n_{k}") for k in fine])
    enough = {k: F.col(f"n_{k}") >= max(min_share * READINGS_PER_DAY[k], 1e-9) for k in fine}
    cfs = F.when(F.col("n_daily") > 0, F.col("daily"))
    keep = F.col("n_daily") > 0
    for k in fine:
        cfs = cfs.when(enough[k], F.col(f"m_{k}"))
        keep = keep | enough[k]
    return g.where(keep).select("site_uid", "date", cfs.alias("cfs"), "qualifier")


def daily_means(df: DataFrame, variable: str = "discharge", zone: str = LOCAL_ZONE, min_share: float = 0.5) -> DataFrame:
    """The means ``daily_flow`` chooses from, one row per site, day and slot: 0 for the stored daily mean, then the intervals with
    enough readings from the finest on. The row with the smallest slot is the day's value.

    One sum and count a row, where ``daily_flow`` keeps one for every interval: for many sites and days this takes a third of the memory."""
    is_day = (F.col("interval") == "daily") & (F.col("statistic") == "mean")
    v = df.where((F.col("variable") == variable) & (is_day | F.col("interval").isin(*READINGS_PER_DAY)))
    local = F.when(is_day, F.to_date("datetime_utc")).otherwise(F.to_date(F.from_utc_timestamp("datetime_utc", zone)))
    fine = sorted(READINGS_PER_DAY, key=READINGS_PER_DAY.get, reverse=True)
    slot, least = F.when(is_day, 0), F.lit(0.0)
    for i, k in enumerate(fine, start=1):
        slot = slot.when(F.col("interval") == k, i)
        least = F.when(F.col("slot") == i, min_share * READINGS_PER_DAY[k]).otherwise(least)
    g = v.groupBy("site_uid", local.alias("date"), slot.alias("slot")).agg(F.avg("value").alias("value"), F.count("*").alias("n"))
    return g.where(F.col("n") >= least).drop("n")


def despike(df: DataFrame) -> DataFrame:
    """Drop a sub-daily storage or elevation reading far from both neighbours on the same side."""
    n = neighbours(df, ["site_uid", "variable"], "datetime_utc", ["value"])
    p, x, v = F.col("prev_value"), F.col("next_value"), F.col("value")
    tol = (F.when(F.col("variable") == "reservoir_elevation", 5.0)
            .otherwise(F.greatest(F.lit(50.0), 0.2 * F.greatest(F.abs(p), F.abs(x)))))
    lone = ((v - p > tol) & (v - x > tol)) | ((p - v > tol) & (x - v > tol))
    watched = (~F.col("interval").isin(*COARSE_INTERVALS)) & F.col("variable").isin("reservoir_storage", "reservoir_elevation")
    return n.where(~(watched & F.coalesce(lone, F.lit(False)))).drop("prev_value", "next_value")


def reservoir_daily(df: DataFrame, shift_hours: int = 7) -> DataFrame:
    """Despiked daily means by local date; sub-daily instants move to standard time."""
    day = (F.when(F.col("interval").isin(*COARSE_INTERVALS), F.to_date("datetime_utc"))
            .otherwise(F.to_date(F.col("datetime_utc") - F.expr(f"INTERVAL {shift_hours} HOURS"))))
    return despike(df).groupBy("site_uid", "variable", day.alias("date")).agg(
        F.avg("value").alias("value"), F.count("*").alias("n"))


def station_day(df: DataFrame, variable: str, hour_utc: int = 7) -> DataFrame:
    """A station's day: its daily row, else the hourly reading at ``hour_utc`` of the next UTC day."""
    v = df.where((F.col("variable") == variable) & F.col("interval").isin("daily", "hourly"))
    hourly = (F.col("interval") == "hourly") & (F.date_trunc("hour", "datetime_utc") == F.col("datetime_utc")) & (
        F.hour("datetime_utc") == hour_utc)
    is_day = F.col("interval") == "daily"
    d = v.where(is_day | hourly).withColumn("date", F.when(is_day, F.to_date("datetime_utc"))
                                            .otherwise(F.date_sub(F.to_date("datetime_utc"), 1)))
    return d.groupBy("site_uid", "date").agg(
        F.coalesce(F.max(F.when(is_day, F.col("value"))), F.max(F.when(hourly, F.col("value")))).alias("value"))


def pick_copy(daily: DataFrame, keys: Sequence[str] = ("gauge", "date"), order: Sequence[str] = SOURCE_PRIORITY) -> DataFrame:
    """One copy per gauge and day: the best source, ties by site id."""
    extra = [F.col("site_uid")] if "site_uid" in daily.columns else []
    # days tell rows apart in a sort better than names do
    by_day = sorted(keys, key=lambda k: k != "date")
    return pick_row(daily, by_day, [priority_of("source", order), *extra], last=False)


def splice(daily: DataFrame, sites: DataFrame, keys: Sequence[str] = ("reservoir", "date")) -> DataFrame:
    """One value per key from the site listed first; ``sites`` has site_uid, the key and ``place``."""
    j = daily.join(sites, "site_uid")
    return pick_row(j, list(keys), [F.col("place"), F.col("site_uid")], last=False)


def last_complete_week(day: Column) -> Column:
    """Monday of the last Monday-to-Sunday week that ends on or before ``day``."""
    sunday = F.date_sub(day, F.weekday(day) + 1)
    return F.when(F.weekday(day) == 6, F.date_sub(day, 6)).otherwise(F.date_sub(sunday, 6)).cast("date")


def week_starts(last_days: DataFrame, day: str, n: int = 52) -> DataFrame:
    """The last ``n`` complete weeks for each row's newest day."""
    end = last_complete_week(F.col(day))
    weeks = F.sequence(F.date_sub(end, 7 * (n - 1)), end, F.expr("INTERVAL 7 DAYS"))
    return last_days.select("*", F.explode(weeks).alias("week_start"))


def _most_used(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent value per key, the smallest on ties, in two combinable aggregates."""
    c = df.groupBy(*keys, value).agg(F.count("*").alias("_c"))
    return c.groupBy(*keys).agg(F.min_by(F.col(value), F.struct(-F.col("_c"), F.col(value))).alias(name), F.sum("_c").alias("_n"))


def gauge_weekly(chosen: DataFrame, min_days: int = 4) -> DataFrame:
    """Weekly mean per gauge with at least ``min_days`` days, and the source used most.

    A gauge has one value a day here, so a group is seven rows at most."""
    g = chosen.groupBy("gauge", week_start("date").alias("week_start")).agg(
        F.avg("cfs").alias("mean_cfs"), F.count("*").alias("n_days"), F.mode("source", True).alias("source_used"))
    return g.where(F.col("n_days") >= min_days)


def eligible_gauges(weeks: DataFrame, min_weeks: int = 26) -> DataFrame:
    return weeks.groupBy("gauge").agg(F.countDistinct("week_start").alias("weeks")).where(F.col("weeks") >= min_weeks)


def segment_weekly(weeks: DataFrame, gauges: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Mean, range and number of the gauges' weekly means per segment."""
    return (weeks.join(gauges, "gauge").groupBy(*keys, "week_start")
            .agg(F.avg("mean_cfs").alias("mean_cfs"), F.count("*").alias("n_gauges"),
                 F.min("mean_cfs").alias("min_cfs"), F.max("mean_cfs").alias("max_cfs")))


def keep_segments(weeks: DataFrame, gauges: DataFrame, limit: int = 8) -> DataFrame:
    """The ``limit`` segments of each river with most gauge-weeks, heaviest first (a report's palette)."""
    w = weeks.join(gauges, "gauge").groupBy("river", "segment").agg(F.count("*").alias("weight"))
    rank = F.row_number().over(Window.partitionBy("river").orderBy(F.desc("weight"), "segment"))
    return w.withColumn("place", rank).where(F.col("place") <= limit)


def copy_agreement(daily: DataFrame, chosen: DataFrame, min_cfs: float = 10.0, off_pct: float = 10.0,
                   off_cfs: float = 5.0) -> DataFrame:
    """Unused copies against the value used: shared days, median percent difference, days off."""
    m = _against_used(daily, chosen)
    gap = F.abs(F.col("cfs") - F.col("used_cfs"))
    pct = F.when(F.abs("used_cfs") >= min_cfs, gap / F.abs("used_cfs") * 100)
    m = m.withColumn("pct", pct).withColumn("off", F.coalesce((F.col("pct") > off_pct) & (gap > off_cfs), F.lit(False)))
    # a copy has one value a station and day, so the calendar bounds its group and the median goes with the counts
    return m.groupBy("gauge", "source").agg(F.count("*").alias("overlap_days"), F.count_if("off").alias("days_off"), F.round(F.percentile("pct", 0.5), 1).alias("median_abs_pct_diff"))


def _against_used(daily: DataFrame, chosen: DataFrame) -> DataFrame:
    used = chosen.select("gauge", "date", F.col("source").alias("used_source"), F.col("cfs").alias("used_cfs"))
    return daily.join(used, ["gauge", "date"]).where(F.col("source") != F.col("used_source"))


def screen_values(daily: DataFrame, peaks: DataFrame, exclusions: DataFrame, factor: float = 1.05) -> DataFrame:
    """Each daily value with a ``verdict``: kept, listed, above_peak, or conflict (kept, for review).

    ``exclusions`` lists gauge, first and last day; ``peaks`` the gauge's annual peak by water year."""
    listed = exclusions.select("gauge", "first", "last")
    x = (daily.join(listed, "gauge", "left_semi").join(listed, "gauge")
         .where(F.col("date").between(F.col("first"), F.col("last"))).select("gauge", "date").distinct().withColumn("hit", F.lit(True)))
    j = (daily.join(x, ["gauge", "date"], "left").withColumn("wy", water_year("date"))
         .join(peaks, ["gauge", "wy"], "left"))
    over = F.coalesce(F.col("cfs") > factor * F.col("peak"), F.lit(False))
    estimated = F.coalesce("qualifier", F.lit("")).rlike(r"(?:^|[:|,])e(?:$|[:|,])")
    approved = (F.col("source") == "usgs") & ~estimated
    verdict = (F.when(F.col("hit"), "listed").when(over & ~approved, "above_peak").when(over, "conflict").otherwise("kept"))
    return j.select(*daily.columns, "wy", "peak", verdict.alias("verdict"))


def annual_peaks(daily: DataFrame) -> DataFrame:
    return daily.groupBy("gauge", water_year("date").alias("wy")).agg(F.max("cfs").alias("peak"))


def explorer(segment_weeks: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Every week of each segment's whole record, null where it has no value.

    A mean is taken to six decimal places before it is rounded to one, so that the order of a sum does not decide a half."""
    span = segment_weeks.groupBy(*keys).agg(F.min("week_start").alias("a"), F.max("week_start").alias("b"))
    weeks = span.select(*keys, F.explode(F.sequence("a", "b", F.expr("INTERVAL 7 DAYS"))).alias("week_start"))
    return weeks.join(segment_weeks.select(*keys, "week_start", F.round(F.col("mean_cfs").cast("decimal(18,6)"), 1).cast("double").alias("v"), "n_gauges"),
                      [*keys, "week_start"], "left")


def gauge_inventory(copies: DataFrame, weeks: DataFrame, gauges: DataFrame, min_weeks: int = 26) -> DataFrame:
    """Per gauge: its copies, first and last week, weeks, and whether it counts in segment means."""
    src = copies.select("gauge", "source").distinct().groupBy("gauge").agg(
        F.array_join(F.sort_array(F.collect_set("source")), ", ").alias("copies"))
    w = weeks.groupBy("gauge").agg(F.min("week_start").alias("first_week"), F.max("week_start").alias("last_week"), F.count("*").alias("weeks"))
    return gauges.join(w, "gauge").join(src, "gauge").withColumn("in_mean", F.col("weeks") >= min_weeks)


def label_gauges(gauges: DataFrame, groups: DataFrame) -> DataFrame:
    """Name and segment of each group of copies, from its best source."""
    j = gauges.join(groups, "site_uid")
    best = pick_copy(j.select("group", "source", "site_uid", "name", "segment"), ["group"])
    return j.select("site_uid", "group", "source").join(best.select("group", F.col("name").alias("gauge"), "segment"), "group")


def river_report(copies: DataFrame, gauges: DataFrame, as_of: Column | None = None, min_days: int = 4, min_weeks: int = 26,
                 weeks_back: int = 52) -> DataFrame:
    """All rivers at once: copies to chosen days, eligible gauge weeks, and the last year of segment weeks."""
    chosen = pick_copy(copies)
    weeks = gauge_weekly(chosen, min_days)
    ok = weeks.join(eligible_gauges(weeks, min_weeks).select("gauge"), "gauge", "left_semi")
    seg = segment_weekly(ok, gauges, ("river", "segment"))
    end = last_complete_week(as_of if as_of is not None else copies.agg(F.max("date")).scalar())
    return seg.where(F.col("week_start").between(F.date_sub(end, 7 * (weeks_back - 1)), end))
