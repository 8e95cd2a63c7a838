"""Ratings of a value against other years, over small per-key arrays bounded by the number of years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import classify, same_day_in


def size_of(arr: Column) -> Column:
    return F.coalesce(F.size(arr), F.lit(0))


def array_percentile(arr: Column, p: float) -> Column:
    """Linear-interpolated percentile of an array; null when empty."""
    s = F.array_sort(arr)
    pos = (F.size(arr) - 1) * F.lit(float(p))
    lo, hi = F.floor(pos).cast("int"), F.ceil(pos).cast("int")
    a, z = F.try_element_at(s, lo + 1), F.try_element_at(s, hi + 1)
    return F.when(F.size(arr) > 0, F.when(lo == hi, a).otherwise((hi - pos) * a + (pos - lo) * z))


def array_mean(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x) / F.size(arr))


def midrank_in(arr: Column, v: Column) -> Column:
    """Percent of array values below ``v``, ties half."""
    below = F.size(F.filter(arr, lambda x: x < v))
    equal = F.size(F.filter(arr, lambda x: x == v))
    return F.when((F.size(arr) > 0) & v.isNotNull(), F.lit(100.0) * (below + 0.5 * equal) / F.size(arr))


def baseline_values(years: Column, first: int, last: int, min_base: int, min_fallback: int | None) -> tuple[Column, Column]:
    """From an array of (year, value): the baseline years' values when there are enough, else all
    years' values when those are enough, else null; and a label of which."""
    inside = F.filter(years, lambda y: y["year"].between(first, last))
    value = lambda a: F.transform(a, lambda y: y["value"])
    base = F.when(F.size(inside) >= min_base, value(inside))
    basis = F.when(F.size(inside) >= min_base, F.lit("baseline"))
    if min_fallback is not None:
        base = base.when(F.size(years) >= min_fallback, value(years))
        basis = basis.when(F.size(years) >= min_fallback, F.lit("whole record"))
    return base, basis


def year_windows(df: DataFrame, keys: Sequence[str], value: str, end: Column, days: Sequence[int | Column], date: str = "date") -> DataFrame:
    """Totals over the k days ending on ``end``'s calendar day of every year, for each k.

    Each row names the years whose window holds it, two for windows of up to a year and one more for
    each year beyond, so this is one combinable aggregate: no join of days against windows. Columns: days, year, window_end, total, n, top."""
    ks = F.array(*[k if isinstance(k, Column) else F.lit(k) for k in days])
    d = df.where(F.col(value).isNotNull()).withColumn("_end", end)
    d = d.select(*keys, F.col(date).alias("_d"), F.col(value).alias("_v"), "_end",
                 F.explode(F.sequence(F.year(date), F.year(date) + 1 + F.floor(F.array_max(ks) / 366).cast("int"))).alias("year"), ks.alias("_ks"))
    d = d.withColumn("window_end", same_day_in(F.col("year"), F.col("_end"))).where(F.col("year") <= F.year("_end"))
    gap = F.date_diff("window_end", "_d")
    d = d.where(gap >= 0).withColumn("days", F.explode(F.filter("_ks", lambda k: k > gap)))
    return d.groupBy(*keys, "days", "year", "window_end").agg(
        F.sum("_v").alias("total"), F.count("*").alias("n"), F.max("_v").alias("top"),
        F.min_by("_d", F.struct(-F.col("_v"), F.col("_d"))).alias("top_date"))


def rated(df: DataFrame, value: Column, base: Column) -> DataFrame:
    pct = midrank_in(base, value)
    return df.withColumn("pct", pct).withColumn("cls", classify("pct"))
