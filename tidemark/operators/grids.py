"""Gridded data as long rows (iy, ix, lat, lon, date, value): weights, zonal means, repair, regions.

A grid's cells are few next to its values; weights per (cell, unit) are computed once from the cells
and joined to the values on the cell key, so values are aggregated before they are shuffled."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.resolve import connected_groups
from tidemark.operators.spatial import points_in_polygons
from tidemark.schema import AF_M3, EARTH_AREA_KM, M_TO_IN, MM_TO_IN, SQ_M_PER_SQ_MI
from tidemark.sources import manifest

COVER_MM, SNOW_MM = 25.0, 10.0
KM_PER_DEG = 111.0


def scan_frame(cells: DataFrame, dlat: float, dlon: float, sub: int) -> dict[str, float]:
    """Where the scan lines of a regular grid lie: ``sub`` lines and ``sub`` columns of centres a cell. Indices rise with coordinates."""
    if dlat <= 0 or dlon <= 0:
        raise ValueError("cell sizes must be positive: rows ascend by latitude, columns by longitude")
    r = cells.agg(F.min("iy").alias("iy"), F.max("iy").alias("iy1"), F.min_by("lat", "iy").alias("lat"), F.min("ix").alias("ix"), F.max("ix").alias("ix1"), F.min_by("lon", "ix").alias("lon")).first()
    if r.iy is None:
        return {}
    high, wide = dlat / sub, dlon / sub
    return {"iy": r.iy, "ix": r.ix, "lines": (r.iy1 - r.iy + 1) * sub, "columns": (r.ix1 - r.ix + 1) * sub, "high": high, "wide": wide,
            "y": r.lat - dlat / 2 + high / 2, "x": r.lon - dlon / 2 + wide / 2}


def scan_spans(edges: DataFrame, frame: dict[str, float]) -> DataFrame:
    """(poly_id, line, a, b): the runs of centres a <= column < b that lie inside each polygon on each scan line.

    An edge is filed under the lines it crosses; on a line the crossings in order open and close the polygon in turn (a running
    parity), so a run costs two crossings however many centres it covers."""
    first, last = F.ceil((F.least("y0", "y1") - frame["y"]) / frame["high"]), F.ceil((F.greatest("y0", "y1") - frame["y"]) / frame["high"]) - 1
    lo, hi = F.greatest(first, F.lit(0)), F.least(last, F.lit(frame["lines"] - 1))
    cut = edges.withColumn("line", F.explode(F.when(lo <= hi, F.sequence(lo, hi))))
    at = F.col("x0") + (frame["y"] + F.col("line") * frame["high"] - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    column = F.least(F.greatest(F.ceil((at - frame["x"]) / frame["wide"]), F.lit(0)), F.lit(frame["columns"]))
    w = Window.partitionBy("poly_id", "line").orderBy("at")
    k = cut.select("poly_id", "line", at.alias("at"), column.alias("a")).withColumn("k", F.row_number().over(w)).withColumn("b", F.lead("a").over(w))
    return k.where((F.col("k") % 2 == 1) & (F.col("a") < F.col("b"))).select("poly_id", "line", "a", "b")


def span_cells(spans: DataFrame, frame: dict[str, float], sub: int) -> DataFrame:
    """(poly_id, iy, ix, n): centres of the spans in each cell.

    A span is at most six steps of a count along its row of cells: up and down at the cells it cuts, and once for all cells it covers
    whole. Steps are summed before they move; their running sum is constant from one step to the next, and only there are cells
    written out."""
    fa, fb = F.expr(f"a div {sub}"), F.expr(f"b div {sub}")
    ra, rb = F.col("a") % sub, F.col("b") % sub
    # centres up to a column, as a step function: what lies before b less what lies before a
    step = lambda at, n: F.struct(at.alias("c"), n.cast("bigint").alias("n"))
    steps = F.array(step(fa, sub - ra), step(fa + 1, ra), step(fb, rb - sub), step(fb + 1, -rb))
    e = spans.select("poly_id", F.expr(f"line div {sub}").alias("row"), F.explode(steps).alias("s")).select("poly_id", "row", "s.*")
    e = e.groupBy("poly_id", "row", "c").agg(F.sum("n").alias("n")).where("n != 0")
    w = Window.partitionBy("poly_id", "row").orderBy("c")
    runs = e.withColumn("n", F.sum("n").over(w)).withColumn("z", F.lead("c").over(w)).where("n > 0")
    each = runs.select("poly_id", (F.col("row") + frame["iy"]).alias("iy"), F.explode(F.sequence("c", F.col("z") - 1)).alias("c"), "n")
    return each.select("poly_id", "iy", (F.col("c") + frame["ix"]).alias("ix"), "n")


def cell_weights(cells: DataFrame, edges: DataFrame, dlat: float, dlon: float, sub: int = 8) -> DataFrame:
    """Share of each cell inside each polygon, by the sub-cell centres that fall in it.

    Scan lines find them: work follows the edges' cells and the runs between crossings, not the centres of the grid."""
    own = cells.select("iy", "ix", "lat", "lon").distinct()
    frame = scan_frame(own, dlat, dlon, sub)
    if not frame:
        return own.select(F.lit("").alias("unit"), "iy", "ix", F.lit(0.0).alias("weight")).limit(0)
    inside = span_cells(scan_spans(edges, frame), frame, sub).join(own.select("iy", "ix"), ["iy", "ix"])
    return inside.select(F.col("poly_id").alias("unit"), "iy", "ix", (F.col("n") / F.lit(float(sub * sub))).alias("weight"))


def polygon_cells(edges: DataFrame, dlat: float, dlon: float) -> DataFrame:
    """Area of each polygon in cell areas, the part outside the grid included."""
    ring = F.sum(F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0"))
    return edges.groupBy(F.col("poly_id").alias("unit")).agg((F.abs(ring) / 2 / (dlat * dlon)).alias("cells"))


def zonal_mean(grid: DataFrame, weights: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    """Weighted mean over the valid cells of each unit per time."""
    g = grid.where(F.col("value").isNotNull() & ~F.isnan("value")).join(weights, ["iy", "ix"])
    return g.groupBy("unit", *keys).agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("value"), F.count("*").alias("cells"))


def zonal_rows(means: DataFrame, interval: str) -> DataFrame:
    """Inches with the UTC bounds a value covers: a daily value ends at noon UTC of its date, a month spans itself."""
    day = F.col("date").cast("timestamp")
    end = day + F.expr("INTERVAL 12 HOURS") if interval == "daily" else F.add_months("date", 1).cast("timestamp")
    start = end - F.expr("INTERVAL 24 HOURS") if interval == "daily" else day
    return means.where(F.col("value").isNotNull()).select("unit", "date", F.lit(interval).alias("interval"), F.round(F.col("value") * MM_TO_IN, 4).alias("precip_in"),
                                                          start.alias("period_start_utc"), end.alias("period_end_utc"))


def grid_coverage(first_day: DataFrame, weights: DataFrame, cells: DataFrame, minimum: float) -> DataFrame:
    """Share of each polygon covered by cells with data, and whether that is enough to state a series."""
    v = first_day.where(F.col("value").isNotNull()).join(weights, ["iy", "ix"]).groupBy("unit").agg(F.sum("weight").alias("w"))
    f = F.round(F.coalesce("w", F.lit(0.0)) / F.col("cells"), 4)
    return cells.join(v, "unit", "left").select("unit", f.alias("grid_fraction"), (f >= minimum).alias("has_precip"))


def stale_years(files: DataFrame, manifest: DataFrame, same_method: Column) -> DataFrame:
    """Years whose file is new or changed since the manifest; all of them when the method or units changed."""
    done = manifest.where(same_method).select("year", "file", "size", "mtime")
    return files.join(done, ["year", "file", "size", "mtime"], "left_anti")


def recompute_years(spark: SparkSession, source: str, root: str, schema: T.StructType, method: str, make: Callable[[DataFrame], DataFrame]) -> list[int]:
    """Bring a result by year (columns of ``schema``, year among them) up to date with the files it is made from; the years remade.

    ``source`` holds Parquet files in ``year=`` folders. Beside the result lies a table of the files it was made from: path, size and
    time of change, and the method. Years with a file that is new, changed or gone are remade by ``make``, all of them under another
    method; only their files are read. The other years' files stay as they are. Results go in force by the manifest first and the
    table of files is written after, so a driver lost in between repeats the same years."""
    now = manifest.files(spark, source).select(F.regexp_extract("path", r"/year=(\d+)/", 1).cast("int").alias("year"), "path", "size", "changed")
    kinds = "year int, path string, size bigint, changed timestamp, method string"
    runs = sorted(int(k) for k in manifest.children(spark, f"{root}/_made") if manifest.exists(spark, f"{root}/_made/{k}/_SUCCESS"))
    seen = spark.read.schema(kinds).parquet(f"{root}/_made/{runs[-1]:08d}") if runs else spark.createDataFrame([], kinds)
    same = seen.where(F.col("method") == method).drop("method")
    # one row a year at most
    stale = sorted(r.year for r in now.exceptAll(same).union(same.exceptAll(now)).union(seen.where(F.col("method") != method).drop("method")).select("year").distinct().collect())
    if not stale:
        return []
    state = now.agg(F.sum(F.xxhash64("path", "size", "changed").cast("decimal(38,0)"))).first()[0] or 0
    version = f"made-{(runs or [0])[-1] + 1}-{abs(int(state)):x}"
    held = [r.year for r in now.select("year").distinct().collect() if r.year in stale]
    rows = make(spark.read.option("basePath", source).parquet(*[f"{source}/year={y}" for y in held])) if held else spark.createDataFrame([], schema)
    manifest.stage(rows.select(*schema.names), root, version, ["year"], [f"year={y}" for y in stale])
    manifest.swap(spark, root, version)
    now.withColumn("method", F.lit(method)).coalesce(1).write.mode("overwrite").parquet(f"{root}/_made/{(runs or [0])[-1] + 1:08d}")
    return stale


def joined_spans(spans: DataFrame) -> DataFrame:
    """(line, a, b): the runs that any of the polygons covers, overlaps joined."""
    w = Window.partitionBy("line").orderBy("a", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = spans.withColumn("new", F.coalesce(F.col("a") > reach, F.lit(True)).cast("int"))
    return d.withColumn("k", F.sum("new").over(w)).groupBy("line", "k").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("k")


def select_units(cells: DataFrame, unit_edges: DataFrame, state_edges: DataFrame, used: DataFrame, dlat: float, dlon: float, min_share: float = 0.01, sub: int = 4) -> DataFrame:
    """Units with at least a share of their area in the state, or used by a river report.

    The runs of a unit meet those of the state on the same scan line; what they share is counted by cell like the unit itself."""
    own = cells.select("iy", "ix", "lat", "lon").distinct()
    frame = scan_frame(own, dlat, dlon, sub)
    r = used.select("unit").distinct().withColumn("in_river_reports", F.lit(True))
    if not frame:
        return r.select("unit", F.lit(0.0).alias("state_fraction"), "in_river_reports")
    units, state = scan_spans(unit_edges, frame), joined_spans(scan_spans(state_edges, frame))
    both = units.join(state.select("line", F.col("a").alias("sa"), F.col("b").alias("sb")), "line")
    both = both.select("poly_id", "line", F.greatest("a", "sa").alias("a"), F.least("b", "sb").alias("b")).where("a < b")
    held = lambda spans: span_cells(spans, frame, sub).join(own.select("iy", "ix"), ["iy", "ix"]).groupBy("poly_id").agg(F.sum("n").alias("n"))
    g = held(units).join(held(both).withColumnRenamed("n", "m"), "poly_id", "left")
    g = g.select(F.col("poly_id").alias("unit"), (F.coalesce("m", F.lit(0)) / F.col("n")).alias("state_fraction"))
    j = g.join(r, "unit", "full_outer").withColumn("state_fraction", F.coalesce("state_fraction", F.lit(0.0))).withColumn("in_river_reports", F.coalesce("in_river_reports", F.lit(False)))
    return j.where((F.col("state_fraction") >= min_share) | F.col("in_river_reports"))


def centre_means(grid: DataFrame, edges: DataFrame, done: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """Plain mean of the cells whose centre lies in each unit, only for the (unit, date) not yet done."""
    cells = grid.select("iy", "ix", "lat", "lon").distinct()
    member = points_in_polygons(cells, edges, "lon", "lat", ["iy", "ix"]).withColumnRenamed("poly_id", "unit")
    g = grid if where is None else grid.where(where)
    j = g.where(F.col("value").isNotNull()).join(member, ["iy", "ix"])
    if done is not None:
        j = j.join(done.select("unit", "date"), ["unit", "date"], "left_anti")
    return j.groupBy("unit", "date").agg(F.avg("value").alias("value"), F.count("*").alias("cells"))


def weekly_snow_day(date: str = "date") -> Column:
    """Mondays from October to June."""
    return (F.weekday(date) == 0) & ~F.month(date).isin(7, 8, 9)


def unit_signature(edges: DataFrame, version: int = 1) -> DataFrame:
    """Fingerprint of each unit's outline, independent of edge order and combinable at any size."""
    h = F.xxhash64("x0", "y0", "x1", "y1").cast("decimal(38,0)")
    g = edges.groupBy(F.col("poly_id").alias("unit")).agg(F.count("*").alias("n"), F.sum(h).alias("s"))
    return g.select("unit", F.sha2(F.concat_ws("|", F.lit(version), "unit", "n", "s"), 256).alias("signature"))


def daily_units(grid: DataFrame, edges: DataFrame, done: DataFrame, version: int = 1) -> DataFrame:
    """Unit means of the days not yet done under each unit's present outline; a redrawn unit is redone."""
    sig = unit_signature(edges, version)
    current = done.join(sig, ["unit", "signature"], "left_semi")
    return centre_means(grid, edges, current).join(sig, "unit")


def clip_to_box(cells: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Cells inside west, south, east, north, whether longitudes run to 180 or to 360."""
    w, s, e, n = box
    lon = F.when(F.col("lon") > 180, F.col("lon") - 360).otherwise(F.col("lon"))
    return cells.where(lon.between(w, e) & F.col("lat").between(s, n))


def coordinate_clusters(grid: DataFrame, axis: str, cell: float, key: str = "date") -> DataFrame:
    """Coordinates of each file's axis within half a cell of each other as one.

    Works on the distinct coordinates of one axis of one file, a few thousand at most."""
    c = grid.select(key, axis).distinct()
    w = Window.partitionBy(key).orderBy(axis)
    brk = F.when(F.col(axis) - F.lag(axis).over(w) <= cell / 2, 0).otherwise(1)
    g = c.withColumn("_b", brk).withColumn("_g", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return g.withColumn(f"new_{axis}", F.round(F.avg(axis).over(Window.partitionBy(key, "_g")), 8)).select(key, axis, F.col(f"new_{axis}"))


def repair_grid(grid: DataFrame, cell: float) -> DataFrame:
    """Values on the repaired coordinates; ``collision`` marks cells two values fell into."""
    j = grid.where(F.col("value").isNotNull()).join(coordinate_clusters(grid, "lat", cell), ["date", "lat"]).join(coordinate_clusters(grid, "lon", cell), ["date", "lon"])
    g = j.groupBy("date", F.col("new_lat").alias("lat"), F.col("new_lon").alias("lon")).agg(F.count("*").alias("n"), F.max("value").alias("value"))
    return g.select("date", "lat", "lon", F.when(F.col("n") == 1, F.col("value")).alias("value"), (F.col("n") > 1).alias("collision"))


def cell_area_m2(lat: str | Column, dlat: float, dlon: float) -> Column:
    """True area of a cell centred on a latitude."""
    la = F.radians(F.col(lat) if isinstance(lat, str) else lat)
    h = F.radians(F.lit(dlat)) / 2
    return F.lit((EARTH_AREA_KM * 1000) ** 2) * F.radians(F.lit(abs(dlon))) * F.abs(F.sin(la + h) - F.sin(la - h))


def day_stats(grid: DataFrame, dlat: float, dlon: float, min_valid: float = 0.9, keys: Sequence[str] = ("date",)) -> DataFrame:
    """Mean snow water, volume, cover, deepest cell and snowy area per day of cells in metres; days with
    too little of the area are left out. ``grid`` holds every cell of the area, null where missing."""
    d = grid.withColumn("a", cell_area_m2("lat", dlat, dlon)).withColumn("ok", F.col("value").isNotNull() & ~F.isnan("value"))
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col("a"))), F.lit(0.0))
    g = d.groupBy(*keys).agg(F.sum("a").alias("tot"), part(F.col("ok")).alias("valid"), F.sum(F.when(F.col("ok"), F.col("value") * F.col("a"))).alias("vol"),
                             part(F.col("ok") & (F.col("value") * 1000 >= COVER_MM)).alias("cov"), F.max(F.when(F.col("ok"), F.col("value"))).alias("deep"), part(F.col("ok") & (F.col("value") * 1000 >= SNOW_MM)).alias("snowy"))
    g = g.where((F.col("tot") > 0) & (F.col("valid") / F.col("tot") >= min_valid))
    return g.select(*keys, (F.col("vol") / F.col("valid") * M_TO_IN).alias("swe_in"), (F.col("vol") / AF_M3).alias("volume_af"), (100 * F.col("cov") / F.col("valid")).alias("cover_pct"),
                    (100 * F.col("valid") / F.col("tot")).alias("valid_pct"), (F.col("deep") * M_TO_IN).alias("max_swe_in"), (F.col("snowy") / SQ_M_PER_SQ_MI).alias("snow_sq_mi"))


def climatology(grid: DataFrame, days: Column) -> DataFrame:
    """Mean of each cell over sampled days."""
    return grid.where(days).groupBy("iy", "ix", "lat", "lon").agg(F.avg("value").alias("mean"))


def label_cells(cells: DataFrame, seeds: DataFrame, reach_km: float) -> DataFrame:
    """Range of the nearest seed of each cell and its distance, for cells any seed reaches.

    A cell further than the widest reach belongs to no range, so seeds are looked up through buckets
    of that reach in place of comparing every cell with every seed."""
    deg = reach_km / KM_PER_DEG
    s = seeds.select("range_id", F.col("lon").alias("sx"), F.col("lat").alias("sy"))
    wide = deg
    # a seed is filed under the buckets east and west that its reach spans at the latitude furthest from the equator it reaches
    shrink = F.cos(F.radians(F.least(F.abs("sy") + deg, F.lit(90.0))))
    reach = F.least(F.ceil(1.0 / F.greatest(shrink, F.lit(1e-9))), F.ceil(F.lit(360.0 / wide))).cast("int")
    s = s.withColumn("dx", F.explode(F.sequence(-reach, reach))).withColumn("dy", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    s = s.select("range_id", "sx", "sy", (F.floor(F.col("sx") / wide) + F.col("dx")).alias("bx"), (F.floor(F.col("sy") / wide) + F.col("dy")).alias("by"))
    c = cells.withColumn("bx", F.floor(F.col("lon") / wide)).withColumn("by", F.floor(F.col("lat") / wide))
    dx, dy = (F.col("lon") - F.col("sx")) * KM_PER_DEG * F.cos(F.radians("lat")), (F.col("lat") - F.col("sy")) * KM_PER_DEG
    d = c.join(s, ["bx", "by"]).withColumn("km", F.sqrt(dx * dx + dy * dy)).where(F.col("km") < reach_km)
    g = d.groupBy("iy", "ix").agg(F.min(F.struct("km", "range_id")).alias("n"))
    return g.select("iy", "ix", F.col("n.range_id").alias("range_id"), F.col("n.km").alias("km"))


def snow_zones(mean: DataFrame, labels: DataFrame, ranges: DataFrame) -> DataFrame:
    """Cells of each range's snowy ground: deep enough, near enough, in patches of enough touching cells."""
    m = mean.join(labels, ["iy", "ix"]).join(ranges, "range_id").where((F.col("mean") >= F.col("threshold_in")) & (F.col("km") < F.col("radius_km")))
    m = m.withColumn("node", F.concat_ws("/", "range_id", "iy", "ix"))
    step = F.explode(F.array(F.struct(F.lit(1).alias("dy"), F.lit(0).alias("dx")), F.struct(F.lit(0).alias("dy"), F.lit(1).alias("dx"))))
    e = m.select("node", "range_id", "iy", "ix", step.alias("d")).select(F.col("node").alias("a"), F.concat_ws("/", "range_id", F.col("iy") + F.col("d.dy"), F.col("ix") + F.col("d.dx")).alias("b"))
    grp = connected_groups(m.select("node"), e, "node", "a", "b")
    big = grp.groupBy("group").agg(F.count("*").alias("patch_cells"))
    j = m.join(grp, "node").join(big, "group").where(F.col("patch_cells") >= F.col("min_cells"))
    return j.select("range_id", "iy", "ix", "mean", "km", "patch_cells")
