"""Precipitation, temperature and drought series of watersheds and the state against other years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import classify, doy366
from tidemark.functions.ratings import array_mean, midrank_in, size_of, year_windows
from tidemark.functions.shapes import pick_row

NORMAL_YEARS = (1991, 2020)


def window_stats(daily: DataFrame, keys: Sequence[str], value: str, days: Sequence[int], years: tuple[int, int] = NORMAL_YEARS, min_years: int = 20, mean: bool = False) -> DataFrame:
    """The last k days of each series against the same calendar window of the normal years.

    Only windows with every day count. ``mean`` rates the mean and its anomaly, otherwise the total."""
    last = F.max("date").over(Window.partitionBy(*keys))
    d = daily.withColumn("_last", last)
    w = year_windows(d, [*keys, "_last"], value, F.col("_last"), days).where(F.col("n") == F.col("days"))
    amount = F.col("total") / F.col("n") if mean else F.col("total")
    w = w.withColumn("amount", amount).withColumn("now", F.col("year") == F.year("_last"))
    g = w.groupBy(*keys, "_last", "days").agg(
        F.max(F.when(F.col("now"), F.col("amount"))).alias("amount"), F.max(F.when(F.col("now"), F.col("top"))).alias("highest"), F.max(F.when(F.col("now"), F.col("top_date"))).alias("highest_date"),
        F.collect_list(F.when(F.col("year").between(*years), F.col("amount"))).alias("ref")).where(F.col("amount").isNotNull())
    ok = F.size("ref") >= min_years
    normal = F.when(ok, array_mean(F.col("ref")))
    pct = F.when(ok, midrank_in(F.col("ref"), F.col("amount")))
    out = g.select(*keys, "days", F.date_sub("_last", F.col("days") - 1).alias("window_start"), F.col("_last").alias("window_end"), "amount", normal.alias("normal"), F.size("ref").alias("years"), pct.alias("percentile"),
                   classify(pct).alias("cls"), "highest", "highest_date")
    if mean:
        return out.withColumn("anomaly", F.col("amount") - F.col("normal"))
    return out.withColumn("percent_of_normal", F.when(F.col("normal") > 0, 100 * F.col("amount") / F.col("normal")))


def monthly_totals(daily: DataFrame, keys: Sequence[str], value: str, years: tuple[int, int] = NORMAL_YEARS) -> DataFrame:
    """Totals per month with the mean of that month's complete totals in the normal years; a month in
    progress is compared with the same days of the month in each normal year."""
    d = daily.withColumn("month", F.trunc("date", "month"))
    m = d.groupBy(*keys, "month").agg(F.sum(value).alias("total"), F.count("*").alias("days")).withColumn("complete", F.col("days") == F.dayofmonth(F.last_day("month")))
    base = m.where(F.col("complete") & F.year("month").between(*years)).groupBy(*keys, F.month("month").alias("_m")).agg(F.avg("total").alias("full_normal"))
    part = m.where(~F.col("complete")).select(*keys, "month", F.month("month").alias("_m"), F.col("days").alias("_n"))
    n_years = years[1] - years[0] + 1
    same = (daily.where(F.year("date").between(*years)).select(*keys, F.month("date").alias("_m"), F.dayofmonth("date").alias("_d"), F.col(value).alias("_v")).join(part, [*keys, "_m"]).where(F.col("_d") <= F.col("_n"))
            .groupBy(*keys, "month").agg((F.sum("_v") / n_years).alias("part_normal")))
    j = m.withColumn("_m", F.month("month")).join(base, [*keys, "_m"], "left").join(same, [*keys, "month"], "left")
    return j.select(*keys, "month", "total", "days", "complete", F.when(F.col("complete"), F.col("full_normal")).otherwise(F.coalesce("part_normal", F.lit(0.0))).alias("normal"))


def monthly_vs_normal(df: DataFrame, keys: Sequence[str], center: str = "median", years: tuple[int, int] = NORMAL_YEARS) -> DataFrame:
    """Each month's value with its calendar month's baseline median or mean, and the anomaly."""
    d = df.withColumn("_m", F.month("date"))
    agg = F.median("value") if center == "median" else F.avg("value")
    norm = d.where(F.year("date").between(*years)).groupBy(*keys, "_m").agg(agg.alias("normal"))
    return d.join(norm, [*keys, "_m"], "left").withColumn("anomaly", F.col("value") - F.col("normal")).drop("_m")


def statewide(daily: DataFrame, weights: DataFrame) -> DataFrame:
    """Area-weighted mean over the watersheds reporting each day."""
    j = daily.where(F.col("value").isNotNull()).join(weights.where(F.col("weight") > 0), "unit")
    return j.groupBy("date").agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("value"), F.count("*").alias("units"))


def state_weights(weights: DataFrame, cells: DataFrame) -> DataFrame:
    """Cell shares times the cosine of latitude."""
    return weights.join(cells.select("iy", "ix", "lat").distinct(), ["iy", "ix"]).withColumn("weight", F.col("weight") * F.cos(F.radians("lat"))).drop("lat")


def weighted_mean(grid: DataFrame, weights: DataFrame) -> DataFrame:
    """Mean over valid cells and the share of the weight that had data, per time."""
    j = grid.join(weights, ["iy", "ix"])
    ok = F.col("value").isNotNull()
    total = weights.groupBy("unit").agg(F.sum("weight").alias("all_weight"))
    g = j.groupBy("unit", "date").agg(F.sum(F.when(ok, F.col("value") * F.col("weight"))).alias("num"), F.sum(F.when(ok, F.col("weight"))).alias("den"))
    return g.join(total, "unit").select("unit", "date", (F.col("num") / F.col("den")).alias("value"), (F.coalesce("den", F.lit(0.0)) / F.col("all_weight")).alias("coverage"))


def annual_anomaly(monthly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Means of the twelve months and their anomalies, for complete years."""
    g = monthly.groupBy(*keys, F.year("date").alias("year")).agg(F.count("value").alias("n"), F.avg("value").alias("value"), F.avg("anomaly").alias("anomaly"))
    return g.where(F.col("n") == 12).drop("n")


def smoothed_normal(daily: DataFrame, keys: Sequence[str], years: tuple[int, int] = NORMAL_YEARS, half: int = 7) -> DataFrame:
    """Mean by calendar day over the baseline, smoothed over +-``half`` days and wrapping at the year's end."""
    c = daily.where(F.year("date").between(*years)).groupBy(*keys, doy366("date").alias("doy")).agg(F.avg("value").alias("m"))
    w = Window.partitionBy(*keys).orderBy("doy")
    # positions among the days present, so a missing 29 February does not leave a hole
    p = c.withColumn("i", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy(*keys)))
    x = p.withColumn("off", F.explode(F.sequence(F.lit(-half), F.lit(half)))).withColumn("j", F.pmod(F.col("i") - 1 + F.col("off"), F.col("n")) + 1)
    s = x.groupBy(*keys, F.col("j").alias("i")).agg(F.avg("m").alias("normal"))
    return p.select(*keys, "doy", "i").join(s, [*keys, "i"]).drop("i")


def recent_daily(daily: DataFrame, normal: DataFrame, keys: Sequence[str], days: int = 365) -> DataFrame:
    last = F.max("date").over(Window.partitionBy(*keys))
    d = daily.withColumn("_l", last).where(F.date_diff("_l", "date") < days).withColumn("doy", doy366("date"))
    return d.join(normal, [*keys, "doy"], "left").select(*keys, "date", "value", "normal")


# ---- drought ----------------------------------------------------------------

CATEGORIES = ["d0", "d1", "d2", "d3", "d4"]


def basin_drought(units: DataFrame, readings: DataFrame) -> DataFrame:
    """Severity series of the four-digit basin of each unit."""
    r = readings.where(F.col("variable") == "dsci").select(F.split_part("site_uid", F.lit(":"), F.lit(3)).alias("huc4"), F.to_date("datetime_utc").alias("date"), F.col("value").alias("dsci"))
    return units.select("huc8", F.substring("huc8", 1, 4).alias("huc4")).distinct().join(r, "huc4")


def weekly_drought(readings: DataFrame, keys: Sequence[str], names: Sequence[str] = tuple([*CATEGORIES, "dsci"])) -> DataFrame:
    """One row per week with every category and the index; incomplete weeks are dropped."""
    g = readings.groupBy(*keys, "date").pivot("variable", list(names)).agg(F.max_by("value", "order"))
    return g.dropna(subset=list(names))


def drought_changes(weekly: DataFrame, keys: Sequence[str], weeks: Sequence[int] = (1, 4, 13, 26, 52)) -> DataFrame:
    """The newest week against the weeks k weeks before it."""
    now = pick_row(weekly, list(keys), [F.col("date")])
    n = now.select(*keys, F.col("date").alias("as_of"), *[F.col(c).alias(f"now_{c}") for c in (*CATEGORIES, "dsci")]).withColumn("weeks", F.explode(F.array(*[F.lit(k) for k in weeks])))
    n = n.withColumn("date", F.date_sub("as_of", F.col("weeks") * 7))
    j = n.join(weekly, [*keys, "date"])
    return j.select(*keys, "weeks", F.col("date").alias("from"), F.col("dsci").alias("dsci_then"), *[(F.col(f"now_{c}") - F.col(c)).alias(f"change_{c}") for c in (*CATEGORIES, "dsci")])


def drought_summary(weekly: DataFrame, keys: Sequence[str], baseline: tuple[int, int] = (2000, 2025), around: int = 21) -> DataFrame:
    """Newest week, its worst category, and where its index stands among the same time of other years.

    The same time of year is within ``around`` days on a circle of 365."""
    now = pick_row(weekly, list(keys), [F.col("date")]).select(*keys, F.col("date").alias("as_of"), F.col("dsci").alias("now"), *CATEGORIES)
    j = weekly.select(*keys, "date", "dsci").join(now, list(keys))
    gap = F.abs(F.dayofyear("date") - F.dayofyear("as_of"))
    near = F.year("date").between(*baseline) & (F.year("date") != F.year("as_of")) & (F.least(gap, 365 - gap) <= around)
    g = j.groupBy(*keys, "as_of", "now", *CATEGORIES).agg(F.collect_list(F.when(near, F.col("dsci"))).alias("s"), F.countDistinct(F.when(near, F.year("date"))).alias("sample_years"), F.min("date").alias("record_start"), F.count("*").alias("weeks"))
    worst = F.when(F.lit(False), None)
    for c in reversed(CATEGORIES):
        worst = worst.when(F.col(c) > 0, c.upper())
    return g.select(*keys, "as_of", F.col("now").alias("dsci"), worst.alias("worst_category"), size_of(F.col("s")).alias("sample_weeks"), "sample_years", "record_start", "weeks", midrank_in(F.col("s"), F.col("now")).alias("percentile"))


def past_ratings(daily: DataFrame, dates: Sequence[str], keys: Sequence[str], value: str, days: int, years: tuple[int, int], min_years: int) -> DataFrame:
    """Ratings as they would have read on a short list of past dates: one job over all of them, no loop.

    Every row is filed under the dates by which it was known; the windows then form per date."""
    known = F.filter(F.array(*[F.lit(x).cast("date") for x in dates]), lambda x: F.col("date") <= x)
    d = daily.select(*keys, "date", value, F.explode(known).alias("stated_on"))
    j = d.withColumn("_last", F.max("date").over(Window.partitionBy(*keys, "stated_on")))
    w = year_windows(j, [*keys, "stated_on", "_last"], value, F.col("_last"), [days]).where(F.col("n") == F.col("days"))
    g = w.groupBy(*keys, "stated_on", "_last").agg(F.max(F.when(F.col("year") == F.year("_last"), F.col("total"))).alias("amount"), F.collect_list(F.when(F.col("year").between(*years), F.col("total"))).alias("ref"))
    ok = F.size("ref") >= min_years
    pct = F.when(ok, midrank_in(F.col("ref"), F.col("amount")))
    return g.where(F.col("amount").isNotNull()).select(*keys, "stated_on", F.col("_last").alias("window_end"), "amount", pct.alias("percentile"), classify(pct).alias("cls"))
