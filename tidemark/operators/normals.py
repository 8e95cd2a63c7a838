"""Flow against other years: weekly bands, periods, drying, and state-line volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import classify, midrank, water_year, water_year_start, week_of_year
from tidemark.functions.ratings import array_percentile, baseline_values, midrank_in, year_windows
from tidemark.operators.flow import last_complete_week
from tidemark.schema import CFS_DAY_AF

BASELINE = (1991, 2020)


def percentile_ranks(df: DataFrame, keys: Sequence[str], value: str, base: str) -> DataFrame:
    """Percentile and class of one value per key against base rows carrying it."""
    g = df.groupBy(*keys, value).agg(midrank(F.col(value), F.col(base)).alias("pct"))
    return g.withColumn("cls", classify("pct"))


def weekly_bands(weeks: DataFrame, before: Column, baseline: tuple[int, int] = BASELINE, min_base: int = 20, min_fallback: int = 10) -> DataFrame:
    """Bands by gauge and week of year from weeks before the rated window.

    The pool of a gauge and week holds at most one or two values a year, so it travels as an array."""
    h = weeks.where(F.col("week_start") < before).withColumn("woy", week_of_year("week_start")).withColumn("year", F.year("week_start"))
    g = h.groupBy("gauge", "woy").agg(F.collect_list(F.struct("year", F.col("mean_cfs").alias("value"))).alias("years"))
    base, basis = baseline_values(F.col("years"), *baseline, min_base, min_fallback)
    g = g.select("gauge", "woy", basis.alias("basis"), base.alias("base")).where(F.col("base").isNotNull())
    return g.select("*", F.size("base").alias("n_base"), *[array_percentile(F.col("base"), p / 100).alias(f"p{p}") for p in (10, 25, 50, 75, 90)])


def flow_vs_normal(weeks: DataFrame, gauges: DataFrame, as_of: Column, n_weeks: int = 52, baseline: tuple[int, int] = BASELINE,
                   min_base: int = 20, min_fallback: int = 10, places: int | None = None) -> DataFrame:
    """Every gauge-week of the last year with its bands and, where reported, percentile and class.

    Means that agree to ``places`` decimal places count as equal, whatever the order they were summed in; as they are unless given."""
    if places is not None:
        weeks = weeks.withColumn("mean_cfs", F.round("mean_cfs", places))
    end = last_complete_week(as_of)
    start = F.date_sub(end, 7 * (n_weeks - 1))
    bands = weekly_bands(weeks, start, baseline, min_base, min_fallback)
    # a band stands for the weeks of its week of year, so bands meet no list of weeks in a join
    wins = F.filter(F.sequence(start, end, F.expr("INTERVAL 7 DAYS")), lambda w: week_of_year(w) == F.col("woy"))
    grid = bands.withColumn("week_start", F.explode(wins))
    g = grid.join(weeks.select("gauge", "week_start", "mean_cfs"), ["gauge", "week_start"], "left").join(gauges, "gauge")
    return g.withColumn("pct", midrank_in(F.col("base"), F.col("mean_cfs"))).withColumn("cls", classify("pct")).drop("base")


def segment_ratings(rated: DataFrame, keys: Sequence[str] = ("segment", "week_start")) -> DataFrame:
    """Median percentile of a segment's gauges and its class."""
    g = rated.where(F.col("pct").isNotNull()).groupBy(*keys).agg(F.median("pct").alias("pct"), F.count("*").alias("n_gauges"))
    return g.withColumn("cls", classify("pct"))


def dry_days(chosen: DataFrame, gauges: DataFrame, dry_cfs: float = 0.1) -> DataFrame:
    d = chosen.join(gauges, "gauge")
    return d.groupBy("gauge", "segment", F.year("date").alias("year")).agg(
        F.count_if(F.col("cfs") < dry_cfs).alias("dry_days"), F.count("*").alias("data_days"))


def normally_dry(chosen: DataFrame, gauges: DataFrame, dry_cfs: float = 0.1, share: float = 0.9) -> DataFrame:
    """Gauges that are dry nearly always; they are left out of segment counts and listed."""
    g = chosen.join(gauges, "gauge").groupBy("gauge", "segment").agg((F.count_if(F.col("cfs") < dry_cfs) / F.count("*")).alias("dry_share"))
    return g.where(F.col("dry_share") >= share)


def drying(chosen: DataFrame, gauges: DataFrame, dry_cfs: float = 0.1, share: float = 0.9) -> DataFrame:
    """Per segment and year: days any gauge was dry, dry gauge-days, days with data, most gauges in a day."""
    # a gauge has one value a day, so its window is bounded by the calendar
    of_gauge = Window.partitionBy("gauge")
    dry = F.col("cfs") < dry_cfs
    d = chosen.withColumn("_share", F.count_if(dry).over(of_gauge) / F.count("*").over(of_gauge)).where(F.col("_share") < share).join(gauges, "gauge")
    day = d.groupBy("segment", "date").agg(F.count_if(F.col("cfs") < dry_cfs).alias("n_dry"), F.count("*").alias("n"))
    return day.groupBy("segment", F.year("date").alias("year")).agg(
        F.count_if(F.col("n_dry") > 0).alias("any_dry_days"), F.sum("n_dry").alias("gauge_dry_days"),
        F.count("*").alias("days_with_data"), F.max("n").alias("n_gauges"))


def window_means(daily: DataFrame, keys: Sequence[str], value: str, end: Column, days: Sequence[int], coverage: float = 0.75) -> DataFrame:
    """Means over year windows that start within the record and have enough days."""
    first = daily.groupBy(*keys).agg(F.min("date").alias("_first"))
    w = year_windows(daily, keys, value, end, days).join(first, list(keys))
    ok = (F.date_sub("window_end", F.col("days") - 1) >= F.col("_first")) & (F.col("n") >= coverage * F.col("days"))
    return w.where(ok).withColumn("mean", F.col("total") / F.col("n")).drop("_first")


def rate_windows(windows: DataFrame, keys: Sequence[str], value: str, end: Column, baseline: tuple[int, int] = BASELINE, min_base: int = 20,
                 min_fallback: int | None = 10) -> DataFrame:
    """The window of ``end``'s year against the same window of earlier years, per key and length."""
    now = F.col("year") == F.year(end)
    g = windows.groupBy(*keys, "days").agg(
        F.max(F.when(now, F.col(value))).alias("value"), F.max(F.when(now, F.col("n"))).alias("n_days"),
        F.collect_list(F.when(~now, F.struct("year", F.col(value).alias("value")))).alias("years"))
    base, basis = baseline_values(F.col("years"), *baseline, min_base, min_fallback)
    g = g.where(F.col("value").isNotNull()).withColumn("base", base).withColumn("basis", basis)
    return (g.withColumn("pct", midrank_in(F.col("base"), F.col("value"))).withColumn("cls", classify("pct"))
            .withColumn("median", array_percentile(F.col("base"), 0.5)).withColumn("n_years", F.size("base")).drop("years", "base"))


def flow_periods(chosen: DataFrame, gauges: DataFrame, end: Column, days: Sequence[int] = (30, 90, 180, 365), baseline: tuple[int, int] = BASELINE,
                 min_base: int = 20, min_fallback: int = 10, coverage: float = 0.75) -> DataFrame:
    """Segment rating of mean flow over the last k days: the median of its gauges' percentiles."""
    w = window_means(chosen, ["gauge"], "cfs", end, days, coverage)
    r = rate_windows(w, ["gauge"], "mean", end, baseline, min_base, min_fallback).where(F.col("pct").isNotNull())
    return segment_ratings(r.join(gauges, "gauge"), ["segment", "days"])


# ---- state-line flow --------------------------------------------------------


def exit_set(daily: DataFrame, stale_days: int = 14) -> DataFrame:
    """Each gauge's newest day, whether it is stale against the newest of its river, and the river's common end day.

    ``daily``: river, gauge, date, cfs, for any number of rivers at once. A river has a handful of exit gauges."""
    of_river = Window.partitionBy("river")
    last = daily.groupBy("river", "gauge").agg(F.max("date").alias("last_date"))
    j = last.withColumn("stale", F.date_diff(F.max("last_date").over(of_river), "last_date") > stale_days)
    return j.withColumn("common_end", F.min(F.when(~F.col("stale"), F.col("last_date"))).over(of_river))


def exit_windows(daily: DataFrame, end: Column, days: Sequence[int] = (7, 30, 90, 180, 365), coverage: float = 0.75) -> DataFrame:
    """Volume in acre-feet of each gauge's window in every year: mean times days times the day factor."""
    w = window_means(daily, ["river", "gauge"], "cfs", end, days, coverage)
    return w.withColumn("volume_af", F.col("mean") * F.col("days") * CFS_DAY_AF)


def with_share_of_median(rated: DataFrame) -> DataFrame:
    return rated.withColumnRenamed("value", "volume_af").withColumn("percent_of_median", F.when(F.col("median") > 0, 100 * F.col("volume_af") / F.col("median")))


def exit_ratings(windows: DataFrame, end: Column, baseline: tuple[int, int] = BASELINE, min_base: int = 20, min_fallback: int = 10) -> DataFrame:
    return with_share_of_median(rate_windows(windows, ["river", "gauge"], "volume_af", end, baseline, min_base, min_fallback))


def exit_total(windows: DataFrame, gauges_used: DataFrame, end: Column, baseline: tuple[int, int] = BASELINE, min_base: int = 20, min_fallback: int = 10) -> DataFrame:
    """The sum over a river's gauges (``gauges_used``: river, gauge); a year counts only when every one has it, and so does this year."""
    used = gauges_used.groupBy("river").agg(F.count("*").alias("used"))
    years = windows.join(gauges_used.select("river", "gauge"), ["river", "gauge"], "left_semi").groupBy("river", "days", "year").agg(F.sum("volume_af").alias("volume_af"), F.count("*").alias("n"))
    whole = years.join(used, "river").where(F.col("n") == F.col("used")).drop("used")
    return with_share_of_median(rate_windows(whole, ["river"], "volume_af", end, baseline, min_base, min_fallback)).drop("n_days")


def water_year_volumes(daily: DataFrame, last_complete: int, coverage: float = 0.9) -> DataFrame:
    """Volume per gauge and complete water year; years below coverage, or begun before the record, are null."""
    first = daily.groupBy("river", "gauge").agg(F.min("date").alias("_first"))
    years = daily.withColumn("wy", water_year("date")).where(F.col("wy") <= last_complete)
    g = years.groupBy("river", "gauge", "wy").agg(F.avg("cfs").alias("m"), F.count("*").alias("n")).join(first, ["river", "gauge"])
    start = F.make_date(F.col("wy") - 1, F.lit(10), F.lit(1))
    length = F.date_diff(F.make_date(F.col("wy"), F.lit(9), F.lit(30)), start) + 1
    ok = (F.col("_first") <= start) & (F.col("n") >= coverage * length)
    return g.select("river", "gauge", "wy", "n", F.when(ok, F.col("m") * length * CFS_DAY_AF).alias("volume_af"))


def water_year_totals(volumes: DataFrame, gauges: DataFrame) -> DataFrame:
    """Sum per river and water year, null unless every gauge of the river (``gauges``: river, gauge) has a volume."""
    want = gauges.select("river", "gauge").distinct().groupBy("river").agg(F.count("*").alias("want"))
    g = volumes.groupBy("river", "wy").agg(F.sum("volume_af").alias("s"), F.count("volume_af").alias("n"))
    return g.join(want, "river").select("river", "wy", F.when(F.col("n") == F.col("want"), F.col("s")).alias("total_af"))


def year_to_date_days(end: Column) -> Column:
    return F.date_diff(end, water_year_start(end)) + 1
