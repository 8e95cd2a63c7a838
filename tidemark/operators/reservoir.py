"""Reservoir capacity through time, fill, annual tables, normals and group totals.

Inputs are one value per reservoir and day, so windows over one reservoir are bounded by the
calendar; tables of points, pools and eras are small per reservoir and travel as arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import classify, doy366, water_year
from tidemark.functions.ratings import array_percentile, midrank_in
from tidemark.functions.shapes import calendar, pick_row
from tidemark.schema import CFS_DAY_AF

TRUSTED = ["published_pool", "current_table", "high", "medium"]
POOL_LEVELS = {"conservation": "Top of Conservation", "flood": "Top of Flood", "spillway": "Spillway Crest", "dam": "Top of Dam",
               "entitlement": "Top of Entitlement", "inactive": "Top of Inactive"}


def rating_segments(points: DataFrame) -> DataFrame:
    """Straight segments of each elevation-storage table, storage made non-decreasing."""
    p = points.groupBy("reservoir", "elevation_ft").agg(F.min("storage_af").alias("s"))
    w = Window.partitionBy("reservoir").orderBy("elevation_ft")
    p = p.withColumn("s0", F.max("s").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("e0", F.col("elevation_ft"))
    p = p.withColumn("e1", F.lead("e0").over(w)).withColumn("s1", F.lead("s0").over(w))
    return p.select("reservoir", "e0", "s0", "e1", "s1")


def table_lookup(df: DataFrame, points: DataFrame, elev: str, out: str = "table_af", width_ft: float = 10.0) -> DataFrame:
    """Interpolated storage at an elevation, clamped at the ends: an equi-join on elevation buckets."""
    seg = rating_segments(points)
    ends = seg.groupBy("reservoir").agg(F.min("e0").alias("_lo"), F.max("e0").alias("_hi"))
    pieces = seg.where(F.col("e1").isNotNull()).withColumn("_b", F.explode(F.sequence(F.floor(F.col("e0") / width_ft), F.floor(F.col("e1") / width_ft))))
    d = df.join(ends, "reservoir", "left").withColumn("_h", F.least(F.greatest(F.col(elev), "_lo"), "_hi")).withColumn("_b", F.floor(F.col("_h") / width_ft))
    inside = (F.col("_h") >= F.col("e0")) & ((F.col("_h") < F.col("e1")) | ((F.col("_h") == F.col("_hi")) & (F.col("e1") == F.col("_hi"))))
    j = d.alias("d").join(pieces.alias("p"), (F.col("d.reservoir") == F.col("p.reservoir")) & (F.col("d._b") == F.col("p._b")) & inside, "left")
    value = F.col("p.s0") + (F.col("p.s1") - F.col("p.s0")) / (F.col("p.e1") - F.col("p.e0")) * (F.col("d._h") - F.col("p.e0"))
    return j.select(*[F.col(f"d.{c}") for c in df.columns], value.alias(out))


def in_force(days: DataFrame, eras: DataFrame, start: str, payload: Sequence[str], key: str = "reservoir", date: str = "date") -> DataFrame:
    """Attach the era in force on each day; before the first era, the first one, flagged."""
    pack = F.struct(F.col(start).alias("from"), *[F.col(c) for c in payload])
    packed = eras.groupBy(key).agg(F.array_sort(F.collect_list(pack)).alias("_eras"))
    j = days.join(packed, key, "left")
    on = F.filter("_eras", lambda e: e["from"] <= F.col(date))
    now = F.coalesce(F.try_element_at(on, F.lit(-1)), F.try_element_at(F.col("_eras"), F.lit(1)))
    return j.select(*[j[c] for c in days.columns], *[now[c].alias(c) for c in payload], (F.size(on) == 0).alias("before_record"))


def pool_history(levels: DataFrame, keys: Sequence[str] = ("reservoir", "pool")) -> DataFrame:
    """Published capacities as a step function: entry errors beyond a factor of two of the median go,
    and the last value of a date stays."""
    med = levels.groupBy(*keys).agg(F.median("value").alias("_m"))
    ok = levels.join(med, list(keys)).where((F.col("value") > 0.5 * F.col("_m")) & (F.col("value") < 2 * F.col("_m"))).drop("_m")
    return pick_row(ok, [*keys, "level_date"], [F.col("seq")])


def pools(levels: DataFrame, points: DataFrame, full: DataFrame, shifts: DataFrame) -> DataFrame:
    """Pool elevations per reservoir: the latest named level, shifted to the table's datum, with its
    storage now and as published; a stated full pool comes first."""
    names = F.create_map(*[F.lit(x) for k, v in POOL_LEVELS.items() for x in (v, k)])
    lv = levels.withColumn("pool", names[F.col("level_name")]).where(F.col("pool").isNotNull())
    latest = lv.groupBy("reservoir", "pool").agg(
        F.max(F.when(F.col("parameter") == "Elev", F.struct("level_date", "value"))).alias("e"),
        F.max(F.when(F.col("parameter") == "Stor", F.struct("level_date", "value"))).alias("s")).where(F.col("e").isNotNull())
    j = latest.join(shifts, ["reservoir", "pool"], "left").select(
        "reservoir", "pool", (F.col("e.value") + F.coalesce("shift_ft", F.lit(0.0))).alias("elev_ft"), F.col("e.level_date").alias("level_date"),
        F.col("s.value").alias("level_storage_af"), F.lit(1).alias("place"))
    f = full.select("reservoir", F.lit("full").alias("pool"), "elev_ft", F.lit(None).cast("date").alias("level_date"), F.lit(None).cast("double").alias("level_storage_af"), F.lit(0).alias("place"))
    return table_lookup(f.unionByName(j), points, "elev_ft", "capacity_current_af")


def primary_and_flood(pool_rows: DataFrame, roles: DataFrame) -> DataFrame:
    """The pool a fill is stated against, and the flood pool where it is a different, higher one."""
    one = lambda p: F.max(F.when(F.col("pool") == p, F.struct("pool", "elev_ft", "capacity_current_af")))
    g = pool_rows.groupBy("reservoir").agg(*[one(p).alias(f"_{p}") for p in ("full", "conservation", "spillway", "flood")]).join(roles, "reservoir")
    dry = F.col("role") == "dry_flood"
    primary = F.when(dry, F.col("_flood")).otherwise(F.coalesce("_full", "_conservation", "_spillway"))
    g = g.withColumn("p", primary)
    higher = F.coalesce(F.col("_flood.elev_ft") > F.col("p.elev_ft") + 0.5, F.lit(False))
    keep = dry | (F.col("role") == "flood_control") | higher
    return g.select("reservoir", "role", F.col("p.pool").alias("primary_pool"), F.col("p.elev_ft").alias("primary_elev_ft"), F.col("p.capacity_current_af").alias("primary_af"),
                    F.when(keep, F.col("_flood.capacity_current_af")).alias("flood_af"))


def table_validation(pairs: DataFrame, effective: DataFrame, min_days: int = 20) -> DataFrame:
    """How well the current table reproduces reported storage since it took effect."""
    a = pairs.join(effective, "reservoir").where(F.col("date") >= F.col("effective_date"))
    g = a.groupBy("reservoir").agg(F.count("*").alias("n"), F.median(F.abs("off")).alias("median_abs_af"), F.percentile(F.abs("off"), 0.95).alias("p95_abs_af"),
                                   (F.median(F.abs("off") / F.greatest("stor", F.lit(1.0))) * 100).alias("median_rel_pct"))
    return g.where(F.col("n") >= min_days)


def era_tolerance(pairs: DataFrame, pool: DataFrame) -> DataFrame:
    """Smallest departure step that is a table change: 5 af, 0.1% of the pool, or 3 times the median yearly noise."""
    med = pairs.groupBy("reservoir", "y").agg(F.median("off").alias("_m"))
    mad = pairs.join(med, ["reservoir", "y"]).groupBy("reservoir", "y").agg(F.median(F.abs(F.col("off") - F.col("_m"))).alias("mad"))
    g = mad.groupBy("reservoir").agg(F.median("mad").alias("noise")).join(pool, "reservoir")
    return g.select("reservoir", "noise", F.greatest(F.lit(5.0), 0.001 * F.col("pool_af"), 3.0 * F.col("noise")).alias("tolerance"))


def segment_eras(pairs: DataFrame, tolerance: DataFrame, min_days: int = 400) -> DataFrame:
    """Era of each reservoir-year: a year starts an era when its departure steps by more than the
    tolerance over the elevations it shares with the previous year; short eras join the one before."""
    span = pairs.groupBy("reservoir", "y").agg(F.min("elev").alias("lo"), F.max("elev").alias("hi"), F.median("off").alias("all_off"), F.count("*").alias("days"))
    w = Window.partitionBy("reservoir").orderBy("y")
    span = span.withColumn("py", F.lag("y").over(w)).withColumn("plo", F.lag("lo").over(w)).withColumn("phi", F.lag("hi").over(w)).withColumn("poff", F.lag("all_off").over(w))
    span = span.withColumn("blo", F.greatest("lo", "plo")).withColumn("bhi", F.least("hi", "phi"))
    cmp = span.where("py IS NOT NULL").select("reservoir", F.col("y").alias("cy"), "py", "blo", "bhi", F.explode(F.array("y", "py")).alias("y"))
    both = cmp.join(pairs.select("reservoir", "y", "elev", "off"), ["reservoir", "y"]).where(F.col("elev").between(F.col("blo"), F.col("bhi")))
    shared = both.groupBy("reservoir", F.col("cy").alias("y")).agg(F.median(F.when(F.col("y") == F.col("cy"), F.col("off"))).alias("sb"), F.median(F.when(F.col("y") == F.col("py"), F.col("off"))).alias("sa"))
    s = span.join(shared, ["reservoir", "y"], "left").join(tolerance.select("reservoir", "tolerance"), "reservoir")
    wide = F.coalesce(F.col("bhi") - F.col("blo") >= 1.0, F.lit(False))
    step = F.abs(F.when(wide, F.col("sb") - F.col("sa")).otherwise(F.col("all_off") - F.col("poff")))
    s = s.withColumn("new", F.coalesce(step > F.col("tolerance"), F.lit(False)).cast("int")).withColumn("raw_era", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    size = s.withColumn("era_days", F.sum("days").over(Window.partitionBy("reservoir", "raw_era")))
    stands = F.when((F.col("era_days") >= min_days) | (F.col("raw_era") == 0), F.col("raw_era"))
    return size.select("reservoir", "y", "days", "raw_era", F.last(stands, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("era_id"))


def departure_at(pairs: DataFrame, targets: DataFrame, band_ft: float = 2.0, edge_ft: float = 20.0, near_ft: float = 10.0, enough: int = 30) -> DataFrame:
    """Each era's departure from the current table at a pool elevation and how far that reached.

    Local median when the lake sat there; else a line through the edge band; else a band median."""
    keys = ["reservoir", "era_id"]
    q = pairs.groupBy(*keys).agg(F.percentile("elev", 0.995).alias("hi"), F.percentile("elev", 0.005).alias("lo"), F.median("off").alias("all_off"))
    t = targets.join(q, "reservoir") if "era_id" not in targets.columns else targets.join(q, keys)
    d = t.join(pairs.select(*keys, "elev", "off"), keys)
    h = F.col("elev_ft")
    local = F.abs(F.col("elev") - h) <= band_ft
    edge = (F.when(h > F.col("hi"), F.col("elev") >= F.col("hi") - edge_ft).when(h < F.col("lo"), F.col("elev") <= F.col("lo") + edge_ft)
             .otherwise(F.abs(F.col("elev") - h) <= near_ft))
    e, o = F.when(edge, F.col("elev")), F.when(edge, F.col("off"))
    g = d.groupBy(*keys, "pool", "elev_ft", "hi", "lo", "all_off").agg(
        F.count_if(local).alias("n_local"), F.median(F.when(local, F.col("off"))).alias("local_off"), F.count(e).alias("n_edge"), F.stddev_samp(e).alias("sd"),
        F.regr_slope(o, e).alias("slope"), F.regr_intercept(o, e).alias("icept"), F.median(o).alias("edge_off"))
    near = F.col("n_local") >= enough
    line = (F.col("n_edge") >= enough) & F.coalesce(F.col("sd") > 1, F.lit(False))
    dep = F.when(near, F.col("local_off")).when(line, F.col("slope") * h + F.col("icept")).otherwise(F.coalesce("edge_off", "all_off"))
    gap = F.when(near, 0.0).when(h > F.col("hi"), h - F.col("hi")).when(h < F.col("lo"), F.col("lo") - h).otherwise(0.0)
    return g.select(*keys, "pool", "elev_ft", dep.alias("departure_af"), gap.alias("gap_ft"), F.when(near, "local").when(line, "line").otherwise("median").alias("basis"))


def isotonic(df: DataFrame, keys: Sequence[str], order: str, value: str, weight: str, out: str = "fit") -> DataFrame:
    """Weighted non-increasing fit, by the min-max formula: fit_i = min over a<=i of max over b>=i of mean(a..b).

    One short sequence per key (eras of one reservoir, so a few dozen), paired with itself by its
    prefix sums; the pairs are bounded by the eras and not by the days behind them."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    p = df.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).withColumn("_cw", F.sum(weight).over(w)).withColumn("_cv", F.sum(F.col(value) * F.col(weight)).over(w))
    packed = p.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_cw", "_cv", (F.col("_cw") - F.col(weight)).alias("_pw"), (F.col("_cv") - F.col(value) * F.col(weight)).alias("_pv")))).alias("_s"))
    j = p.join(packed, list(keys))
    s = F.col("_s")
    mean = lambda a, b: (b["_cv"] - a["_pv"]) / (b["_cw"] - a["_pw"])
    best = lambda a: F.array_max(F.transform(F.filter(s, lambda b: b["_i"] >= F.col("_i")), lambda b: mean(a, b)))
    fit = F.array_min(F.transform(F.filter(s, lambda a: a["_i"] <= F.col("_i")), best))
    return j.select(*[j[c] for c in df.columns], fit.alias(out))


def confidence(on_current: Column, gap: Column, shift_pct: Column) -> Column:
    """Label of a derived capacity from how far it was extrapolated and moved by the fit."""
    sh = F.coalesce(F.abs(shift_pct), F.lit(0.0))
    return (F.when(on_current, "current_table").when((gap <= 0) & (sh < 0.5), "high").when((gap <= 10) & (sh < 1), "high").when((gap <= 30) & (sh < 2), "medium").otherwise("low"))


def era_capacities(departures: DataFrame, eras: DataFrame, capacity: DataFrame) -> DataFrame:
    """Capacity of each pool in each era: table value plus departure, fitted non-increasing in time."""
    d = departures.join(eras.select("reservoir", "era_id", "on_current_table"), ["reservoir", "era_id"]).join(capacity, ["reservoir", "pool"])
    flat = F.col("on_current_table")
    d = d.withColumn("gap_ft", F.round(F.when(flat, 0.0).otherwise(F.col("gap_ft")), 1))
    d = d.withColumn("raw_af", F.col("capacity_current_af") + F.when(flat, 0.0).otherwise(F.col("departure_af"))).withColumn("w", F.when(flat, 1e6).otherwise(1.0 / (1.0 + F.col("gap_ft"))))
    fit = isotonic(d, ["reservoir", "pool"], "era_id", "raw_af", "w").withColumn("fit_af", F.round("fit"))
    shift = F.round(F.when(F.col("raw_af") != 0, 100 * (F.col("fit_af") - F.col("raw_af")) / F.col("raw_af")), 1)
    return fit.select("reservoir", "pool", "era_id", F.round("raw_af").alias("raw_af"), "fit_af", "gap_ft", shift.alias("shift_pct"), confidence(flat, F.col("gap_ft"), shift).alias("confidence"))


def era_summary(pairs: DataFrame, pool: DataFrame) -> DataFrame:
    """Span, days, elevation range and median departure per era, and whether it follows the current table."""
    last = F.max("date").over(Window.partitionBy("reservoir", "era_id"))
    d = pairs.withColumn("_late", F.col("date") >= F.date_sub(last, 365))
    g = d.groupBy("reservoir", "era_id").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("n_days"), F.round(F.percentile("elev", 0.005), 1).alias("min_elev_ft"),
                                             F.round(F.percentile("elev", 0.995), 1).alias("max_elev_ft"), F.median("off").alias("med"), F.median(F.when(F.col("_late"), F.col("off"))).alias("late"))
    tol = F.greatest(F.lit(3.0), 0.002 * F.greatest("pool_af", F.lit(1.0)))
    return g.join(pool, "reservoir").withColumn("on_current_table", (F.abs("med") < tol) & (F.abs("late") < tol)).withColumn("median_departure_af", F.round("med")).drop("late", "pool_af", "med")


def flood_days(st: DataFrame) -> DataFrame:
    """Days a dam holds flood water: over a small threshold at a dry dam, over the pool by a margin at
    a flood-control reservoir, never elsewhere. Needs role, stor, flood_af, cons_af."""
    w = Window.partitionBy("reservoir")
    dry = F.greatest(F.lit(5.0), 0.0005 * F.coalesce(F.max("flood_af").over(w), F.lit(0.0)))
    space = F.coalesce("flood_af", F.col("cons_af") * 2)
    margin = F.greatest(0.02 * (space - F.col("cons_af")), 0.05 * F.col("cons_af"))
    day = F.when(F.col("role") == "dry_flood", F.col("stor") > dry).when(F.col("role") == "flood_control", F.col("stor") > F.col("cons_af") + margin)
    return st.withColumn("flood_day", F.coalesce(day, F.lit(False)))


def annual_table(st: DataFrame, flows: DataFrame | None = None, by_water_year: bool = False, flow_min_days: int = 330) -> DataFrame:
    """Per reservoir and year: days, commonest label, peak, mean and low with percents of the pool and
    the peak date; flow volumes only from nearly complete years."""
    year = water_year("date") if by_water_year else F.year("date")
    d = st.withColumn("year", year)
    g = d.groupBy("reservoir", "year").agg(
        F.count("*").alias("n_days"), F.mode("confidence", True).alias("capacity_confidence"), F.median("primary_af").alias("full_pool_af"), F.max("stor").alias("peak_af"),
        F.avg("stor").alias("mean_af"), F.min("stor").alias("low_af"), F.min_by("date", F.struct(-F.col("stor"), F.col("date"))).alias("peak_date"), F.count_if("flood_day").alias("days_flood_storage"))
    for k in ("peak", "mean", "low"):
        g = g.withColumn(f"{k}_pct", F.round(100 * F.col(f"{k}_af") / F.col("full_pool_af"), 1))
    for k in ("full_pool_af", "peak_af", "mean_af", "low_af"):
        g = g.withColumn(k, F.round(k))
    if flows is None:
        return g
    start = st.groupBy("reservoir").agg(F.min("date").alias("_s"))
    fl = flows.join(start, "reservoir").where(F.col("date") >= F.col("_s")).withColumn("year", year)
    vol = fl.groupBy("reservoir", "year").agg(F.round(F.when(F.count("*") >= flow_min_days, F.sum("cfs") * CFS_DAY_AF)).alias("flow_af"), F.round(F.max("cfs")).alias("peak_flow_cfs"), F.count("*").alias("n_days_flow"))
    return g.join(vol, ["reservoir", "year"], "left")


def normal_for_date(st: DataFrame, value: str, baseline: tuple[int, int] = (1991, 2020), min_years: int = 15, half: int = 3, keys: Sequence[str] = ("reservoir",)) -> DataFrame:
    """Percentiles by day of a leap calendar over +-3 days of every baseline year, wrapping at the
    year's end; a day needs values in at least ``min_years`` years."""
    ok = st.where(F.year("date").between(*baseline) & F.col(value).isNotNull()).withColumn("year", F.year("date")).withColumn("doy", doy366("date"))
    enough = ok.groupBy(*keys).agg(F.countDistinct("year").alias("_y")).where(F.col("_y") >= min_years)
    d = ok.join(enough, list(keys), "left_semi").withColumn("off", F.explode(F.sequence(F.lit(-half), F.lit(half)))).withColumn("day", F.pmod(F.col("doy") - 1 + F.col("off"), F.lit(366)) + 1)
    g = d.groupBy(*keys, "day").agg(F.countDistinct("year").alias("years"), F.percentile(value, F.array(*[F.lit(p / 100) for p in (10, 25, 50, 75, 90)])).alias("q"), F.collect_list(value).alias("sample"))
    return g.where(F.col("years") >= min_years).select(*keys, "day", "years", *[F.col("q")[i].alias(f"p{p}") for i, p in enumerate((10, 25, 50, 75, 90))], "sample")


def storage_normal(latest: DataFrame, normal: DataFrame, value: str, floor: Column | None = None, keys: Sequence[str] = ("reservoir",)) -> DataFrame:
    """Percentile and class of the latest value for its date; close to the median counts as normal."""
    j = latest.withColumn("day", doy366("date")).join(normal, [*keys, "day"], "left")
    pct = midrank_in(F.col("sample"), F.col(value))
    j = j.withColumn("pct", pct).withColumn("raw_cls", classify("pct"))
    near = F.lit(False) if floor is None else F.coalesce((F.col("raw_cls") != "normal") & (F.abs(F.col(value) - F.col("p50")) < floor), F.lit(False))
    return j.withColumn("floored", near).withColumn("cls", F.when(near, "normal").otherwise(F.col("raw_cls"))).drop("sample", "raw_cls", "day")


def value_on(st: DataFrame, asof: Column, value: str, keys: Sequence[str] = ("reservoir",)) -> Column:
    """Aggregate: last value on or before a day."""
    return F.max_by(F.when(F.col("date") <= asof, F.col(value)), F.when(F.col("date") <= asof, F.col("date")))


def status(st: DataFrame, as_of: Column, stale_days: int = 14) -> DataFrame:
    """Latest fill per reservoir, change over 30 and 365 days, flood days this year, measure and stale flag."""
    last = F.max("date").over(Window.partitionBy("reservoir"))
    d = st.withColumn("_last", last)
    ago = lambda k: value_on(d, F.date_sub("_last", k), "stor")
    g = d.groupBy("reservoir", "role").agg(
        F.max("date").alias("date"), F.max_by("stor", "date").alias("stor"), F.max_by("primary_af", "date").alias("primary_af"), F.max_by("confidence", "date").alias("confidence"),
        ago(30).alias("stor_30"), ago(365).alias("stor_365"), F.count_if(F.col("flood_day") & (F.year("date") == F.year(as_of))).alias("flood_days_this_year"))
    usable = F.col("confidence").isin(*TRUSTED) & (F.col("primary_af") > 0)
    measure = F.when(F.col("role") == "dry_flood", "flood_pool").when(usable, "percent").otherwise("acre_feet")
    return g.select("*", measure.alias("measure"), F.when(usable, 100 * F.col("stor") / F.col("primary_af")).alias("pct"), (F.date_diff(as_of, F.col("date")) > stale_days).alias("stale"))


def survey_tables(sites: DataFrame, links: DataFrame, acap: DataFrame) -> DataFrame:
    """Survey tables reachable from a reservoir's sites through links in either direction, or their own."""
    a = links.join(sites, links["site_uid_a"] == sites["site_uid"]).select("reservoir", F.col("site_uid_b").alias("uid"))
    b = links.join(sites, links["site_uid_b"] == sites["site_uid"]).select("reservoir", F.col("site_uid_a").alias("uid"))
    ends = a.union(b).union(sites.select("reservoir", F.col("site_uid").alias("uid"))).distinct()
    return acap.join(ends, acap["site_uid"] == ends["uid"]).drop("uid")


def table_adoptions(days: DataFrame, share: float = 0.008, floor_af: float = 3000.0, step_ft: float = 10.0) -> DataFrame:
    """Days on which storage moved by more than elevation explains: the operator adopted a new table."""
    w = Window.partitionBy("reservoir").orderBy("date")
    d = days.withColumn("dv", F.col("stor") - F.lag("stor").over(w)).withColumn("dh", F.col("elev") - F.lag("elev").over(w))
    d = d.withColumn("y", F.year("date")).withColumn("band", F.floor(F.col("elev") / step_ft))
    slope = d.where(F.abs("dh") > 0.02).groupBy("reservoir", "y", "band").agg(F.median(F.col("dv") / F.col("dh")).alias("slope"))
    j = d.join(slope, ["reservoir", "y", "band"]).withColumn("unexplained", F.col("dv") - F.col("slope") * F.col("dh"))
    return j.where((F.abs("unexplained") > share * F.col("stor")) & (F.abs("unexplained") > floor_af)).select("reservoir", "date", "stor", "unexplained")


def bounded_eras(pairs: DataFrame, bounds: DataFrame) -> DataFrame:
    """Era of each day from given start dates."""
    packed = bounds.groupBy("reservoir").agg(F.collect_list("start").alias("_b"))
    j = pairs.join(packed, "reservoir")
    return j.withColumn("era_id", F.size(F.filter("_b", lambda b: b <= F.col("date"))) - 1).drop("_b").where(F.col("era_id") >= 0)


def highlights(annual: DataFrame, top: int = 5) -> DataFrame:
    """Highest and lowest years by peak, and the first and last ten years' means."""
    hi = F.row_number().over(Window.partitionBy("reservoir").orderBy(F.desc("peak_af"), "year"))
    lo = F.row_number().over(Window.partitionBy("reservoir").orderBy("peak_af", "year"))
    a = annual.withColumn("high_place", hi).withColumn("low_place", lo)
    early, late = (F.rank().over(Window.partitionBy("reservoir").orderBy(o)) for o in ("year", F.desc("year")))
    m = annual.withColumn("e", early).withColumn("l", late).groupBy("reservoir").agg(
        F.avg(F.when(F.col("e") <= 10, F.col("mean_af"))).alias("first_ten_af"), F.avg(F.when(F.col("l") <= 10, F.col("mean_af"))).alias("last_ten_af"))
    return a.where((F.col("high_place") <= top) | (F.col("low_place") <= top)).select("reservoir", "year", "peak_af", "high_place", "low_place").join(m, "reservoir")


def overlap_difference(daily: DataFrame) -> DataFrame:
    """Shared days and median difference of a reservoir's first site with each later one."""
    a = daily.where(F.col("place") == 0).select("reservoir", "date", F.col("value").alias("v0"))
    b = daily.where(F.col("place") > 0)
    return b.join(a, ["reservoir", "date"]).groupBy("reservoir", "site_uid").agg(F.count("*").alias("days"), F.median(F.abs(F.col("value") - F.col("v0"))).alias("median_abs"))


# ---- groups of reservoirs ---------------------------------------------------


def group_series(st: DataFrame, members: DataFrame, carry_days: int = 7) -> DataFrame:
    """Daily totals of a group: each member's last reading carried at most ``carry_days``.

    ``members`` maps reservoir to group. Complete means every member counts that day; trusted that
    every counted capacity is usable."""
    d = st.join(members, "reservoir")
    span = d.groupBy("group").agg(F.min("date").alias("a"), F.max("date").alias("z"), F.countDistinct("reservoir").alias("n_members"))
    cal = calendar(members.join(span, "group").select("group", "reservoir", "n_members", "a", "z"), "a", "z")
    j = cal.join(d.select("group", "reservoir", "date", "stor", F.col("primary_af").alias("cap"), F.col("confidence").isin(*TRUSTED).alias("ok")), ["group", "reservoir", "date"], "left")
    w = Window.partitionBy("group", "reservoir").orderBy("date").rowsBetween(-carry_days, 0)
    for c in ("stor", "cap", "ok"):
        j = j.withColumn(c, F.last(c, ignorenulls=True).over(w))
    on = F.col("stor").isNotNull()
    g = j.groupBy("group", "date", "n_members").agg(
        F.sum("stor").alias("storage_af"), F.sum(F.when(on, F.col("cap"))).alias("capacity_af"), F.count("stor").alias("members"),
        F.min(F.when(on, F.coalesce("ok", F.lit(False)))).alias("all_ok"))
    return g.select("group", "date", "storage_af", "capacity_af", "members", (F.col("members") == F.col("n_members")).alias("complete"), F.coalesce("all_ok", F.lit(False)).alias("trusted"))


def latest_complete(series: DataFrame) -> DataFrame:
    return series.where(F.col("complete") & F.col("storage_af").isNotNull()).groupBy("group").agg(F.max("date").alias("as_of"))


def stale_members(st: DataFrame, members: DataFrame, as_of: DataFrame, stale_days: int = 14) -> DataFrame:
    last = st.groupBy("reservoir").agg(F.max("date").alias("last_date")).join(members, "reservoir").join(as_of, "group")
    return last.where(F.date_diff("as_of", "last_date") > stale_days).select("group", "reservoir", "last_date")


def window_change(series: DataFrame, as_of: DataFrame, days: Sequence[int] = (7, 30, 90, 180, 365)) -> DataFrame:
    """Change in storage and percent points over the days ending at ``as_of``, both ends complete."""
    now = series.join(as_of, "group").where(F.col("date") == F.col("as_of")).select("group", "as_of", F.col("storage_af").alias("now_af"), F.col("capacity_af").alias("now_cap"))
    back = now.withColumn("days", F.explode(F.array(*[F.lit(k) for k in days]))).withColumn("date", F.date_sub("as_of", F.col("days")))
    j = back.join(series.where("complete"), ["group", "date"])
    pct, then = 100 * F.col("now_af") / F.col("now_cap"), 100 * F.col("storage_af") / F.col("capacity_af")
    return j.select("group", "days", F.col("date").alias("from"), F.col("storage_af").alias("then_af"), "now_af", (F.col("now_af") - F.col("storage_af")).alias("change_af"), (pct - then).alias("change_points"))


def member_shares(st: DataFrame, members: DataFrame, as_of: DataFrame) -> DataFrame:
    """Each member's storage as of the group's date; a newer reading does not count."""
    d = st.where(F.col("stor").isNotNull()).join(members, "reservoir").join(as_of, "group").where(F.col("date") <= F.col("as_of"))
    g = d.groupBy("group", "reservoir").agg(F.max_by("stor", "date").alias("stor"))
    return g.withColumn("share", F.col("stor") / F.sum("stor").over(Window.partitionBy("group")))


def weekly_history(series: DataFrame) -> DataFrame:
    """Last complete day of each week."""
    wk = F.to_date(F.date_trunc("week", "date"))
    return series.where("complete").groupBy("group", wk.alias("week_start")).agg(F.max("date").alias("date"), F.max_by("storage_af", "date").alias("storage_af"))
