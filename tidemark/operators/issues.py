"""Findings about gauge records, as rows of numbers.

Input is one value per gauge and day. Such a series is bounded by the calendar (some 60,000 days
since 1850), so a window over one gauge is small however much raw data lies behind it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import priority_of, water_year
from tidemark.operators.flow import _against_used, _most_used
from tidemark.schema import SOURCE_PRIORITY

# Ratios that betray a unit mix-up, and names of gauges below dams.
UNIT_RATIOS = [(35.3147, "m3/s and cfs"), (0.0283168, "cfs as m3/s"), (1000.0, "cfs as thousands"), (0.001, "thousands as cfs")]
BELOW_DAM = r"(?i)\b(below|bl|blw|bel)\b.*\b(dam|reservoir|res)\b"


def seasonal_months(chosen: DataFrame, active_days: int = 30, min_years: int = 3, month_days: int = 10, covered: float = 0.6, rare: float = 0.2, min_covered: int = 4) -> DataFrame:
    """Months a gauge reports in few of its active years while most months are well covered."""
    per = chosen.groupBy("gauge", F.year("date").alias("year"), F.month("date").alias("month")).agg(F.count("*").alias("n"))
    active = per.groupBy("gauge", "year").agg(F.sum("n").alias("days")).where(F.col("days") >= active_days).select("gauge", "year")
    years = active.groupBy("gauge").agg(F.count("*").alias("years")).where(F.col("years") >= min_years)
    good = (per.join(active, ["gauge", "year"], "left_semi").where(F.col("n") >= month_days).groupBy("gauge", "month").agg(F.count("*").alias("good")))
    grid = years.select("gauge", "years", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    frac = grid.join(good, ["gauge", "month"], "left").withColumn("share", F.coalesce("good", F.lit(0)) / F.col("years"))
    n_cov = F.count_if(F.col("share") >= covered).over(Window.partitionBy("gauge"))
    return frac.withColumn("n_covered", n_cov).where((F.col("n_covered") >= min_covered) & (F.col("share") < rare)).select("gauge", "month", "share")


def gaps(chosen: DataFrame, seasonal: DataFrame | None = None, min_days: int = 60) -> DataFrame:
    """Runs of missing days of at least ``min_days``, counting only days in the gauge's season."""
    w = Window.partitionBy("gauge").orderBy("date")
    d = chosen.select("gauge", "date").distinct().withColumn("prev", F.lag("date").over(w))
    g = d.select("gauge", F.date_add("prev", 1).alias("first_day"), F.date_sub("date", 1).alias("last_day"), (F.date_diff("date", "prev") - 1).alias("days")).where(F.col("days") >= min_days)
    if seasonal is None:
        return g
    off = seasonal.groupBy("gauge").agg(F.collect_set("month").alias("off"))
    j = g.join(off, "gauge", "left")
    in_season = F.size(F.filter(F.sequence("first_day", "last_day"), lambda x: ~F.array_contains("off", F.month(x))))
    return j.where(F.col("off").isNull() | (in_season >= min_days)).drop("off")


def runs(chosen: DataFrame, kind: str = "same") -> DataFrame:
    """Runs of two or more consecutive days with one non-zero value (``same``) or zero (``zero``)."""
    w = Window.partitionBy("gauge").orderBy("date")
    level = (F.col("cfs") != 0) if kind == "same" else (F.col("cfs") == 0)
    joined = (F.date_diff("date", F.lag("date").over(w)) == 1) & (F.lag("cfs").over(w) == F.col("cfs"))
    d = chosen.where(level).withColumn("new", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1))
    d = d.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    g = d.groupBy("gauge", "island").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count("*").alias("days"), F.max("cfs").alias("value"))
    return g.where(F.col("days") >= 2).drop("island")


def flatlines(chosen: DataFrame, as_of: Column, min_days: int = 30, min_value: float = 1.0, recent_days: int = 3 * 365) -> DataFrame:
    """Long runs at one flow per gauge: how many, the longest, and whether a recent one may be a stuck sensor."""
    r = runs(chosen, "same").where((F.col("days") >= min_days) & (F.col("value") >= min_value))
    g = r.groupBy("gauge").agg(F.count("*").alias("n_runs"), F.max("days").alias("longest"), F.max("last_day").alias("last_day"))
    below = F.col("gauge").rlike(BELOW_DAM)
    recent = ~below & (F.date_diff(as_of, F.col("last_day")) < recent_days)
    return g.select("*", below.alias("below_dam"), F.when(recent, "warn").otherwise("info").alias("severity"))


def zero_runs(chosen: DataFrame, min_days: int = 60) -> DataFrame:
    r = runs(chosen, "zero").where(F.col("days") >= min_days)
    return r.groupBy("gauge").agg(F.count("*").alias("n_runs"), F.max("days").alias("longest"))


def spikes(chosen: DataFrame, peaks: DataFrame | None = None, factor: float = 5.0, local_factor: float = 10.0, floor: float = 100.0, min_rows: int = 60) -> DataFrame:
    """Days far above both the gauge's usual range and its seven-reading median.

    ``peaks`` (gauge, wy, peak) marks years that have an annual peak on record to judge them by."""
    p99 = chosen.groupBy("gauge").agg(F.percentile("cfs", 0.99).alias("p99"), F.count("*").alias("rows"))
    w = Window.partitionBy("gauge").orderBy("date").rowsBetween(-3, 3)
    local = F.when(F.count("cfs").over(w) >= 3, F.percentile("cfs", 0.5).over(w))
    d = chosen.withColumn("local", local).join(p99, "gauge").where(F.col("rows") >= min_rows)
    hit = ((F.col("cfs") > factor * F.greatest("p99", F.lit(1.0))) & (F.col("cfs") > local_factor * F.greatest("local", F.lit(1.0))) & (F.col("cfs") > floor))
    d = d.where(hit).withColumn("wy", water_year("date"))
    if peaks is None:
        return d.select("gauge", "date", "cfs", "p99", F.lit(False).alias("has_peak"))
    known = peaks.select("gauge", "wy").distinct().withColumn("has_peak", F.lit(True))
    return d.join(known, ["gauge", "wy"], "left").select("gauge", "date", "cfs", "p99", F.coalesce("has_peak", F.lit(False)).alias("has_peak"))


def copy_checks(daily: DataFrame, chosen: DataFrame, min_cfs: float = 10.0) -> DataFrame:
    """Whole-record comparison of each unused copy: shared days, median ratio, share off, span."""
    m = _against_used(daily, chosen).where(F.col("used_cfs") >= min_cfs)
    gap = F.abs(F.col("cfs") - F.col("used_cfs"))
    m = m.withColumn("ratio", F.col("cfs") / F.col("used_cfs")).withColumn("off", ((gap > 5) & (gap / F.col("used_cfs") > 0.10)).cast("int"))
    base = m.groupBy("gauge", "source").agg(F.count("*").alias("days"), F.avg("off").alias("share_off"), F.min("date").alias("first"), F.max("date").alias("last"),
                                            F.percentile("ratio", 0.5).alias("ratio"))
    used = _most_used(m, ["gauge", "source"], "used_source", "used_source").drop("_n")
    return base.join(used, ["gauge", "source"])


def unit_hint(df: DataFrame, ratio: str = "ratio", tolerance: float = 0.08) -> DataFrame:
    """Name the unit mix-up a ratio suggests, if any."""
    hint = F.lit(None).cast("string")
    for r, why in reversed(UNIT_RATIOS):
        hint = F.when(F.abs(F.ln(F.col(ratio) / r)) < tolerance, why).otherwise(hint)
    return df.withColumn("unit_hint", hint)


def copy_findings(checks: DataFrame, chosen: DataFrame, min_days: int = 30) -> DataFrame:
    """Bias and disagreement findings; a copy the record never uses only informs."""
    used = chosen.groupBy("gauge", "source").agg(F.count("*").alias("n_used"))
    j = unit_hint(checks.where(F.col("days") >= min_days)).join(used, ["gauge", "source"], "left").withColumn("n_used", F.coalesce("n_used", F.lit(0)))
    j = j.where(~((F.col("n_used") == 0) & (F.col("source") == "nwps")))
    biased = F.col("unit_hint").isNotNull() | ~F.col("ratio").between(0.9, 1.1)
    kind = F.when(biased, "copy_bias").when(F.col("share_off") > 0.2, "copy_disagree")
    sev = F.when(biased & (F.col("n_used") > 0), "warn").otherwise("info")
    return j.select("gauge", "source", "used_source", "days", "ratio", "share_off", "n_used", "unit_hint", kind.alias("kind"), sev.alias("severity")).where(F.col("kind").isNotNull())


def negative_flow(chosen: DataFrame) -> DataFrame:
    return chosen.where(F.col("cfs") < 0).groupBy("gauge").agg(F.count("*").alias("days"), F.min("cfs").alias("lowest"), F.min("date").alias("first"), F.max("date").alias("last"))


def ended_records(chosen: DataFrame, as_of: Column, after_days: int = 90) -> DataFrame:
    g = chosen.groupBy("gauge").agg(F.max("date").alias("last"))
    return g.where(F.date_diff(as_of, F.col("last")) > after_days)


def fallback_share(chosen: DataFrame, limit: float = 0.10, order: Sequence[str] = SOURCE_PRIORITY) -> DataFrame:
    """Gauges where more than ``limit`` of days come from other than their best source."""
    c = chosen.groupBy("gauge", "source").agg(F.count("*").alias("c"))
    g = c.groupBy("gauge").agg(F.sum("c").alias("n"), F.min_by(F.struct("source", "c"), F.struct(priority_of("source", order), F.col("source"))).alias("best"))
    return g.select("gauge", F.col("best.source").alias("best_source"), (1 - F.col("best.c") / F.col("n")).alias("other_share")).where(F.col("other_share") > limit)


def peak_conflicts(screened: DataFrame) -> DataFrame:
    """Approved values above their own annual peak, by gauge: days, years and the worst ratio."""
    return screened.where(F.col("verdict") == "conflict").groupBy("gauge").agg(
        F.count("*").alias("days"), F.countDistinct("wy").alias("years"), F.max(F.col("cfs") / F.greatest("peak", F.lit(1.0))).alias("worst_ratio"))


def segment_findings(seg: DataFrame, min_weeks: int = 45) -> DataFrame:
    """Segments resting on one gauge in half their weeks, and segments without a full year."""
    share = seg.groupBy("segment").agg(F.avg((F.col("n_gauges") == 1).cast("int")).alias("one"), F.max("n_gauges").alias("most"))
    single = share.where((F.col("one") >= 0.5) & (F.col("most") > 1)).select("segment", F.lit("single_gauge").alias("kind"), F.col("one").alias("amount"))
    per_year = seg.groupBy("segment", F.year("week_start").alias("y")).agg(F.count("*").alias("c"))
    years = per_year.groupBy("segment").agg(F.count("*").alias("years"), F.max("c").alias("best"))
    none = years.where((F.col("years") >= 3) & (F.col("best") < min_weeks)).select("segment", F.lit("no_yearly").alias("kind"), F.col("best").cast("double").alias("amount"))
    return single.unionByName(none)
