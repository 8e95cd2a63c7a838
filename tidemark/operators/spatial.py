"""Spatial joins on plain columns: polygons as edge rows, lines as segment rows, buckets as join keys.

A polygon table has poly_id, x0, y0, x1, y1 (one row per edge, rings closed, holes as further rings);
a line table has line_id and the same four columns. Angles are degrees, projected values metres."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import haversine_m
from tidemark.session import ensure_checkpoint_dir

# The CONUS Albers equal-area projection on the GRS80 ellipsoid.
ALBERS = dict(a=6378137.0, f=1 / 298.257222101, lat0=23.0, lon0=-96.0, sp1=29.5, sp2=45.5)


def albers(lon: str | Column, lat: str | Column) -> tuple[Column, Column]:
    """Projected x and y in metres; closed form, so it stays in generated code."""
    lon, lat = (F.col(c) if isinstance(c, str) else c for c in (lon, lat))
    a, e2 = ALBERS["a"], ALBERS["f"] * (2 - ALBERS["f"])
    e = math.sqrt(e2)

    def q_of(s):
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    m = lambda d: math.cos(math.radians(d)) / math.sqrt(1 - e2 * math.sin(math.radians(d)) ** 2)
    m1, m2 = m(ALBERS["sp1"]), m(ALBERS["sp2"])
    q0, q1, q2 = (q_of(math.sin(math.radians(ALBERS[k]))) for k in ("lat0", "sp1", "sp2"))
    n = (m1 * m1 - m2 * m2) / (q2 - q1)
    c = m1 * m1 + n * q1
    s = F.sin(F.radians(lat))
    q = (1 - e2) * (s / (1 - e2 * s * s) - F.ln((1 - e * s) / (1 + e * s)) / (2 * e))
    rho = a * F.sqrt(c - n * q) / n
    rho0 = a * math.sqrt(c - n * q0) / n
    theta = n * F.radians(lon - ALBERS["lon0"])
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def box_edges(boxes: DataFrame, key: str = "unit") -> DataFrame:
    """Edges of axis-aligned boxes given as x0, x1, y0, y1."""
    c = F.col
    sides = [("x0", "y0", "x1", "y0"), ("x1", "y0", "x1", "y1"), ("x1", "y1", "x0", "y1"), ("x0", "y1", "x0", "y0")]
    arr = F.array(*[F.struct(c(a).alias("x0"), c(b).alias("y0"), c(d).alias("x1"), c(e).alias("y1")) for a, b, d, e in sides])
    return boxes.select(c(key).alias("poly_id"), F.explode(arr).alias("s")).select("poly_id", "s.*")


#: Edges of a polygon for each of its horizontal strips.
STRIP_EDGES = 128


def merged(df: DataFrame) -> DataFrame:
    """A side of a join that is never broadcast: sizes are estimated before rows are filed under buckets, so the planner would take
    millions of them for a few megabytes and send them through the driver."""
    return df.hint("merge")


def points_in_polygons(points: DataFrame, edges: DataFrame, x: str, y: str, ids: Sequence[str], cell: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """(ids, poly_id) for every polygon a point lies in, by counting edges a ray to the right crosses.

    Points and polygons may carry columns ``by``, among the ids; only those that agree in them meet.

    Points meet polygons through the grid cells of the polygon's bounding box, then only the edges of
    that polygon in the point's own horizontal strip; crossing counts combine before the shuffle. A
    polygon has a strip for every ``STRIP_EDGES`` of its edges, so the key (polygon, strip) stays small
    however many vertices a watershed has."""
    box = edges.groupBy("poly_id", *by).agg(
        F.min(F.least("x0", "x1")).alias("bx0"), F.max(F.greatest("x0", "x1")).alias("bx1"), F.min(F.least("y0", "y1")).alias("by0"), F.max(F.greatest("y0", "y1")).alias("by1"),
        F.ceil(F.count("*") / STRIP_EDGES).alias("strips"))
    box = box.withColumn("high", F.greatest((F.col("by1") - F.col("by0")) / F.col("strips"), F.lit(1e-12)))

    def strip_of(at):
        return F.least(F.greatest(F.floor((at - F.col("by0")) / F.col("high")), F.lit(0)), F.col("strips") - 1)

    cells = (box.withColumn("cx", F.explode(F.sequence(F.floor(F.col("bx0") / cell), F.floor(F.col("bx1") / cell))))
             .withColumn("cy", F.explode(F.sequence(F.floor(F.col("by0") / cell), F.floor(F.col("by1") / cell)))))
    p = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*ids, F.col(x).alias("_px"), F.col(y).alias("_py")).withColumn("cx", F.floor(F.col("_px") / cell)).withColumn("cy", F.floor(F.col("_py") / cell))
    cand = p.join(merged(cells), ["cx", "cy", *by]).where(F.col("_px").between(F.col("bx0"), F.col("bx1")) & F.col("_py").between(F.col("by0"), F.col("by1"))).select(*ids, "_px", "_py", "poly_id", strip_of(F.col("_py")).alias("strip"))
    strips = edges.where(F.col("y0") != F.col("y1")).join(merged(box.select("poly_id", *by, "by0", "high", "strips")), ["poly_id", *by])
    strips = strips.withColumn("strip", F.explode(F.sequence(strip_of(F.least("y0", "y1")), strip_of(F.greatest("y0", "y1"))))).select("poly_id", *by, "strip", "x0", "y0", "x1", "y1")
    straddles = (F.col("y0") > F.col("_py")) != (F.col("y1") > F.col("_py"))
    right = F.col("_px") < F.col("x0") + (F.col("_py") - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    hit = cand.join(merged(strips), ["poly_id", *by, "strip"]).where(straddles & right)
    return hit.groupBy(*ids, "poly_id").agg(F.count("*").alias("_k")).where(F.col("_k") % 2 == 1).drop("_k")


def assign_hucs(sites: DataFrame, edges: DataFrame, column: str = "huc8") -> DataFrame:
    """Fill a missing watershed code from the polygon a site lies in; given codes stay."""
    inside = points_in_polygons(sites.where(F.col(column).isNull()), edges, "lon", "lat", ["site_uid"]).groupBy("site_uid").agg(F.min("poly_id").alias("_h"))
    j = sites.join(inside, "site_uid", "left")
    return j.select(*[F.coalesce(column, "_h").alias(column) if c == column else F.col(c) for c in sites.columns])


def assign_regions(sites: DataFrame, layers: DataFrame) -> DataFrame:
    """Every region of every layer a site lies in, long. ``layers``: region_type, region_id, region_name and edges."""
    edges = layers.withColumn("poly_id", F.concat_ws("|", "region_type", "region_id")).select("poly_id", "x0", "y0", "x1", "y1")
    names = layers.select("region_type", "region_id", "region_name").distinct().withColumn("poly_id", F.concat_ws("|", "region_type", "region_id"))
    return points_in_polygons(sites, edges, "lon", "lat", ["site_uid"]).join(names, "poly_id").select("site_uid", "region_type", "region_id", "region_name").distinct()


def segment_distance(px: Column, py: Column) -> Column:
    """Distance from a point to the segment (x0, y0)-(x1, y1)."""
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - F.col("x0")) * dx + (py - F.col("y0")) * dy) / length))).otherwise(0.0)
    ex, ey = px - (F.col("x0") + t * dx), py - (F.col("y0") + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def filed(segments: DataFrame, cell: float, margin: float) -> DataFrame:
    """Segments under the square buckets (_bx, _by) that anything within ``margin`` of them may lie in.

    Column by column of buckets only the segment's part there counts, so a long one costs as many rows as it crosses buckets."""
    seg = segments.withColumn("_bx", F.explode(F.sequence(F.floor((F.least("x0", "x1") - margin) / cell), F.floor((F.greatest("x0", "x1") + margin) / cell))))
    left = F.greatest(F.least("x0", "x1"), F.col("_bx") * cell - margin)
    right = F.least(F.greatest("x0", "x1"), (F.col("_bx") + 1) * cell + margin)
    rise = (F.col("y1") - F.col("y0")) / F.nullif(F.col("x1") - F.col("x0"), F.lit(0.0))
    ya = F.coalesce(F.col("y0") + (left - F.col("x0")) * rise, "y0")
    yb = F.coalesce(F.col("y0") + (right - F.col("x0")) * rise, "y1")
    return seg.withColumn("_by", F.explode(F.sequence(F.floor((F.least(ya, yb) - margin) / cell), F.floor((F.greatest(ya, yb) + margin) / cell))))


def distinct_places(points: DataFrame, x: str, y: str) -> DataFrame:
    return points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y).distinct()


def _place_lines(places: DataFrame, lines: DataFrame, x: str, y: str, radius: float, line: str) -> DataFrame:
    """(x, y, line, distance_m) within ``radius``. A place looks in one bucket only, so no pair is missed and none is met twice from different buckets."""
    seg = filed(lines.select(line, "x0", "y0", "x1", "y1"), radius, radius * (1 + 1e-6))
    p = places.withColumn("_bx", F.floor(F.col(x) / radius)).withColumn("_by", F.floor(F.col(y) / radius))
    d = p.join(merged(seg), ["_bx", "_by"]).withColumn("_d", segment_distance(F.col(x), F.col(y))).where(F.col("_d") <= radius)
    return d.groupBy(x, y, line).agg(F.min("_d").alias("distance_m"))


def near_lines(points: DataFrame, lines: DataFrame, x: str, y: str, ids: Sequence[str], radius: float, line: str = "line_id") -> DataFrame:
    """Smallest distance from each point to each line within ``radius``, in the coordinates' units.

    Distances are computed between distinct places and distinct segments: points that share a place and lines drawn twice cost one."""
    d = _place_lines(distinct_places(points, x, y), lines.select(line, "x0", "y0", "x1", "y1").distinct(), x, y, radius, line)
    back = d.select(F.col(x).alias("_px"), F.col(y).alias("_py"), line, "distance_m")
    p = points.select(*ids, F.col(x).alias("_px"), F.col(y).alias("_py"))
    return p.join(merged(back), ["_px", "_py"]).groupBy(*ids, line).agg(F.min("distance_m").alias("distance_m"))


def with_distance(pairs: DataFrame) -> DataFrame:
    """Add ``_d``, the distance between the segments (x0, y0)-(x1, y1) and (_x0, _y0)-(_x1, _y1) of a row: zero where they cross.

    In steps of small columns: each is used more than once, and one nested expression would outgrow what the JVM compiles."""
    c = F.col

    def along(vx, vy, dx, dy):
        return F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (vx * c(dx) + vy * c(dy)) / F.nullif(c(dx) * c(dx) + c(dy) * c(dy), F.lit(0.0)))), F.lit(0.0))

    def off(vx, vy, t, dx, dy):
        ex, ey = vx - c(t) * c(dx), vy - c(t) * c(dy)
        return ex * ex + ey * ey

    d = pairs.withColumns({"_ax": c("x1") - c("x0"), "_ay": c("y1") - c("y0"), "_bx_": c("_x1") - c("_x0"), "_by_": c("_y1") - c("_y0"), "_wx": c("_x0") - c("x0"), "_wy": c("_y0") - c("y0")})
    starts = ((c("_wx"), c("_wy"), "_ax", "_ay"), (c("_wx") + c("_bx_"), c("_wy") + c("_by_"), "_ax", "_ay"), (-c("_wx"), -c("_wy"), "_bx_", "_by_"), (c("_ax") - c("_wx"), c("_ay") - c("_wy"), "_bx_", "_by_"))
    d = d.withColumns({f"_t{k}": along(*v) for k, v in enumerate(starts)} | {"_turn": F.nullif(c("_ax") * c("_by_") - c("_ay") * c("_bx_"), F.lit(0.0))})
    d = d.withColumns({f"_e{k}": off(v[0], v[1], f"_t{k}", v[2], v[3]) for k, v in enumerate(starts)}
                      | {"_u": (c("_wx") * c("_by_") - c("_wy") * c("_bx_")) / c("_turn"), "_v": (c("_wx") * c("_ay") - c("_wy") * c("_ax")) / c("_turn")})
    crosses = F.coalesce((c("_u") > 0) & (c("_u") < 1) & (c("_v") > 0) & (c("_v") < 1), F.lit(False))
    return d.select(*pairs.columns, F.when(crosses, 0.0).otherwise(F.sqrt(F.least("_e0", "_e1", "_e2", "_e3"))).alias("_d"))


def near_segments(features: DataFrame, lines: DataFrame, ids: Sequence[str], radius: float, line: str = "line_id", cell: float | None = None) -> DataFrame:
    """Smallest distance from each feature (edge rows: ids, x0, y0, x1, y1) to each line within ``radius``.

    Lines are filed with the radius around them, features without: the bucket that holds a feature's nearest point holds the line
    too. A pair may meet in several buckets; the least distance is a combinable aggregate. ``cell`` is the side of a bucket, the
    radius unless given; with radius zero only what touches or crosses is found. Where the ids name the line, a feature meets that line only."""
    cell = cell or radius
    on = [line] if line in ids else []
    own = filed(features.select(*ids, "x0", "y0", "x1", "y1"), cell, cell * 1e-6)
    other = filed(lines.select(line, "x0", "y0", "x1", "y1"), cell, radius * (1 + 1e-6) + cell * 1e-6)
    other = other.select(line, "_bx", "_by", *[F.col(k).alias(f"_{k}") for k in ("x0", "y0", "x1", "y1")])
    apart = lambda a, b: F.greatest(F.least(f"{a}0", f"{a}1") - F.greatest(f"{b}0", f"{b}1"), F.least(f"{b}0", f"{b}1") - F.greatest(f"{a}0", f"{a}1")) <= radius
    d = with_distance(own.join(merged(other), [*on, "_bx", "_by"]).where(apart("x", "_x") & apart("y", "_y")))
    # a filter on the distance of each pair would be pushed into the join as one huge expression; a filter on the least one is not
    return d.groupBy(*dict.fromkeys([*ids, line])).agg(F.min("_d").alias("distance_m")).where(F.col("distance_m") <= radius)


def vertices(edges: DataFrame, *ids: str) -> DataFrame:
    """The distinct ends (ids, vx, vy) of edge or segment rows."""
    ends = F.array(F.struct(F.col("x0").alias("vx"), F.col("y0").alias("vy")), F.struct(F.col("x1").alias("vx"), F.col("y1").alias("vy")))
    return edges.select(*ids, F.explode(ends).alias("v")).select(*ids, "v.*").distinct()


def near_features(features: DataFrame, lines: DataFrame, radius: float, cell: float | None = None, line: str = "line_id") -> DataFrame:
    """(feature_id, line, distance_m) of lines and areas within ``radius`` of a line.

    ``features``: edge rows feature_id, area (whether the edges close an area), x0, y0, x1, y1. An area that holds a vertex of the
    line is at distance zero, however far its outline is."""
    cell = cell or radius
    outline = near_segments(features, lines, ["feature_id"], radius, line, cell)
    areas = features.where("area").select(F.col("feature_id").alias("poly_id"), "x0", "y0", "x1", "y1")
    held = points_in_polygons(vertices(lines.withColumnRenamed(line, "_line"), "_line"), areas, "vx", "vy", ["_line", "vx", "vy"], cell * 16)
    held = held.select(F.col("poly_id").alias("feature_id"), F.col("_line").alias(line), F.lit(0.0).alias("distance_m")).distinct()
    return outline.unionByName(held).groupBy("feature_id", line).agg(F.min("distance_m").alias("distance_m"))


def features_within(features: DataFrame, lines: DataFrame, radius: float, cell: float | None = None, line: str = "line_id") -> DataFrame:
    """(feature_id, line) of the pairs that ``near_features`` finds, without their distances.

    Two that pass through one small cell, as wide as the radius from corner to corner, are within it; that settles the pairs where
    lines or features lie close together from distinct cells alone. Only pairs that share a large bucket and no small cell are held
    against each other edge by edge, and only areas still without a line against its vertices."""
    cell, pair = cell or radius, ["feature_id", line]
    edge = ["x0", "y0", "x1", "y1"]
    small = radius / math.sqrt(2) * (1 - 1e-6)
    lines = lines.select(line, *edge).distinct()
    # where a steep edge crosses into the next column is not known to within a small cell
    firm = (F.col("x0") == F.col("x1")) | (F.abs(F.col("y1") - F.col("y0")) <= 1000 * F.abs(F.col("x1") - F.col("x0")))
    marks = filed(lines.where(firm), small, 0.0).select(line, "_bx", "_by").distinct()
    shapes = features.select(*edge).distinct()
    seen = filed(shapes.where(firm), small, 0.0).join(merged(marks), ["_bx", "_by"]).select(*edge, line).distinct()
    ensure_checkpoint_dir(features.sparkSession)
    sure = features.select("feature_id", *edge).join(merged(seen), edge).select(*pair).distinct().checkpoint()

    buckets = filed(lines, cell, radius * (1 + 1e-6) + cell * 1e-6).select(line, "_bx", "_by").distinct()
    shared = filed(shapes, cell, cell * 1e-6).join(merged(buckets), ["_bx", "_by"]).select(*edge, line).distinct()
    open_ = features.select("feature_id", *edge).join(merged(shared), edge).join(merged(sure), pair, "left_anti").select(*pair, *edge).distinct()
    exact = near_segments(open_, lines, pair, radius, line, cell).select(*pair)
    sure = sure.unionByName(exact).checkpoint()

    wide = cell * 16
    areas = features.where("area").select("feature_id", *edge)
    box = areas.groupBy("feature_id").agg(*[F.floor(f(g(f"{c}0", f"{c}1")) / wide).alias(f"{c}{k}") for c in "xy" for k, f, g in ((0, F.min, F.least), (1, F.max, F.greatest))])
    box = box.withColumn("_bx", F.explode(F.sequence("x0", "x1"))).withColumn("_by", F.explode(F.sequence("y0", "y1"))).select("feature_id", "_bx", "_by")
    ends = vertices(lines, line)
    spots = ends.select(line, F.floor(F.col("vx") / wide).alias("_bx"), F.floor(F.col("vy") / wide).alias("_by")).distinct()
    left = box.join(merged(spots), ["_bx", "_by"]).select(*pair).distinct().join(merged(sure), pair, "left_anti")
    left = areas.join(merged(left), "feature_id").withColumnRenamed("feature_id", "poly_id")
    held = points_in_polygons(ends, left, "vx", "vy", [line, "vx", "vy"], wide, [line])
    return sure.unionByName(held.select(F.col("poly_id").alias("feature_id"), line).distinct())


def meets_polygons(features: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """(feature_id, poly_id) of features that share a point with a polygon: an edge of one meets one of the other, or one holds a
    vertex of the other."""
    touch = near_features(features, polygons, 0.0, cell, "poly_id").select("feature_id", "poly_id")
    inside = points_in_polygons(vertices(features, "feature_id"), polygons, "vx", "vy", ["feature_id", "vx", "vy"], cell * 16).select("feature_id", "poly_id")
    return touch.unionByName(inside).distinct()


def nearest_line(points: DataFrame, lines: DataFrame, x: str, y: str, ids: Sequence[str], radius: float, line: str = "line_id") -> DataFrame:
    """The one nearest line of each point within the radius, the smaller id on ties; decided once for each distinct place."""
    drawn = lines.groupBy("x0", "y0", "x1", "y1").agg(F.min(line).alias(line))
    n = _place_lines(distinct_places(points, x, y), drawn, x, y, radius, line)
    n = n.groupBy(F.col(x).alias("_px"), F.col(y).alias("_py")).agg(F.min(F.struct("distance_m", line)).alias("n"))
    p = points.select(*ids, F.col(x).alias("_px"), F.col(y).alias("_py")).join(merged(n), ["_px", "_py"])
    return p.groupBy(*ids).agg(F.min("n").alias("n")).select(*ids, F.col(f"n.{line}").alias(line), F.col("n.distance_m").alias("distance_m"))


def snap_sites(sites: DataFrame, reaches: DataFrame, max_m: float = 500.0) -> DataFrame:
    """Nearest reach of stream-like sites; permit points only when marked as surface water."""
    permit = F.col("site_uid").startswith("ose_arcgis:pod:")
    surface = F.coalesce("raw_metadata", F.lit("")).contains('"grnd_wtr_s": "S"')
    s = sites.where(F.col("site_type").isin("stream", "canal", "diversion", "return_flow") & F.col("lat").isNotNull() & F.col("lon").isNotNull() & (~permit | surface))
    px, py = albers("lon", "lat")
    n = nearest_line(s.withColumn("px", px).withColumn("py", py), reaches, "px", "py", ["site_uid"], max_m, "comid")
    return n.withColumnRenamed("distance_m", "snap_distance_m")


def within_or_nearest(points: DataFrame, edges: DataFrame, x: str, y: str, ids: Sequence[str], radius: float, cell: float) -> DataFrame:
    """Polygon a point lies in, else the nearest edge within the radius; ``match_type`` says which. Decided once for each distinct place."""
    held = points_in_polygons(distinct_places(points, x, y), edges, x, y, [x, y], cell).groupBy(x, y).agg(F.min("poly_id").alias("poly_id"))
    inside = points.select(*ids, x, y).join(merged(held), [x, y]).groupBy(*ids).agg(F.min("poly_id").alias("poly_id")).withColumn("match_type", F.lit("within")).withColumn("distance_m", F.lit(0.0))
    rest = points.join(merged(inside.select(*ids)), list(ids), "left_anti")
    near = nearest_line(rest, edges, x, y, ids, radius, "poly_id").withColumn("match_type", F.lit("nearest"))
    return inside.unionByName(near)


def match_dams(dams: DataFrame, water_edges: DataFrame, max_m: float = 3000.0) -> DataFrame:
    """Each dam's waterbody: containing it or nearest within ``max_m`` (projected edges)."""
    px, py = albers("lon", "lat")
    return within_or_nearest(dams.withColumn("px", px).withColumn("py", py), water_edges, "px", "py", ["nid_id"], max_m, max_m)


def features_near_river(features: DataFrame, river_lines: DataFrame, segments: DataFrame, radius: float, cell: float | None = None) -> DataFrame:
    """Features within the radius of a river that meet a segment of its watershed: their number and names per (line_id, segment).

    ``features``: edge rows feature_id, name, area, x0, y0, x1, y1; ``segments``: edge rows segment, x0, y0, x1, y1. Only features
    near some river are held against the segments. Where no feature has a name the number of features counts."""
    near = features_within(features, river_lines, radius, cell)
    some = features.join(near.select("feature_id").distinct(), "feature_id", "left_semi")
    meets = meets_polygons(some, segments.withColumnRenamed("segment", "poly_id"), cell or radius).withColumnRenamed("poly_id", "segment")
    named = F.when(F.upper(F.trim("name")) != "UNKNOWN", F.nullif(F.initcap(F.trim("name")), F.lit("")))
    d = near.join(meets, "feature_id").join(features.select("feature_id", "name").distinct(), "feature_id")
    g = d.groupBy("line_id", "segment").agg(F.countDistinct("feature_id").alias("features"), F.sort_array(F.collect_set(named)).alias("names"))
    return g.withColumn("count", F.when(F.size("names") > 0, F.size("names")).otherwise(F.col("features")))


def district_acres(near: DataFrame) -> DataFrame:
    """Summed acres of the districts near each river."""
    return near.groupBy("line_id", "name").agg(F.sum("acres").alias("acres"))


def top_by_area(near: DataFrame, top: int = 8) -> DataFrame:
    """Largest named systems near each river (a short report list)."""
    w = Window.partitionBy("line_id").orderBy(F.desc("area"), "name")
    return near.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)


def use_by_category(use: DataFrame, crossed: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Water use of the counties a river crosses, by category, positive amounts only."""
    j = use.withColumn("county", F.lower(F.trim("county"))).join(crossed.select("line_id", F.lower("county").alias("county")).distinct(), "county")
    long = j.unpivot(["line_id", "county"], list(categories), "category", "af").withColumn("af", F.coalesce(F.col("af").try_cast("double"), F.lit(0.0)))
    return long.groupBy("line_id", "category").agg(F.sum("af").alias("af")).where(F.col("af") > 0)


def reservoirs_on_river(registry: DataFrame, dams_near: DataFrame, min_af: float = 500.0) -> DataFrame:
    """Registered reservoirs whose river starts with the river's base name, joined with the dams near it.

    ``registry``: line_id, base, river, name, dam. ``dams_near``: line_id, base, river, dam_name, storage_af."""
    reg = registry.where(F.startswith(F.lower("river"), F.col("base"))).select("line_id", "name", "dam", F.lower("dam").alias("dam_l"))
    d = dams_near.where(F.startswith(F.lower("river"), F.col("base")) & (F.col("storage_af") >= min_af) & ~F.coalesce(F.col("dam_name").rlike(r"(?i)\bdike\b"), F.lit(False)))
    d = d.select("line_id", "dam_name", "storage_af", F.lower("dam_name").alias("nm"))
    j = reg.join(d, (reg["line_id"] == d["line_id"]) & F.startswith(F.col("dam_l"), F.col("nm")), "full_outer")
    return j.select(F.coalesce(reg["line_id"], d["line_id"]).alias("line_id"), F.coalesce("name", "dam_name").alias("name"), F.coalesce("dam_name", "dam").alias("dam"), "storage_af",
                    F.when(reg["line_id"].isNotNull(), "registry").otherwise("dams").alias("source"))


def station_pairs(a: DataFrame, b: DataFrame, max_km: float = 12.0, max_rise_m: float = 450.0) -> DataFrame:
    """Stations and observers within a distance and a height difference, through cells as high as the distance.

    Distances are computed between distinct places. A place of observers is filed under as many cells east and west as the distance
    spans at its latitude; cells wrap around at the date line. Pairs outgrow the rows they come from, so they are made in a fixed
    number of parts: parts sized by the rows would be few."""
    here = lambda df: df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    stations = here(a).select(F.col("site_uid").alias("station"), F.col("lat").alias("la"), F.col("lon").alias("lo"), F.col("elevation_m").alias("ea"))
    observers = here(b).select(F.col("site_uid").alias("observer"), F.col("lat").alias("lb"), F.col("lon").alias("ob"), F.col("elevation_m").alias("eb"))
    across = int(360.0 * 111.0 // max_km)
    cell = 360.0 / across
    l = (stations.select("la", "lo").distinct()
         .withColumn("cx", F.pmod(F.floor((F.col("lo") + 180) / cell), F.lit(across))).withColumn("cy", F.floor(F.col("la") / cell)))
    shrink = F.cos(F.radians(F.least(F.abs("lb") + max_km / 111.0, F.lit(90.0))))
    reach = F.ceil(F.least(max_km / 111.0 / F.greatest(shrink, F.lit(1e-9)), F.lit(180.0)) / cell)
    ring = F.sequence(-reach, F.least(reach, across - 1 - reach))
    r = (observers.select("lb", "ob").distinct().withColumn("ring", ring)
         .withColumn("dx", F.explode("ring")).withColumn("dy", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
         .withColumn("cx", F.pmod(F.floor((F.col("ob") + 180) / cell) + F.col("dx"), F.lit(across))).withColumn("cy", F.floor(F.col("lb") / cell) + F.col("dy")).drop("ring", "dx", "dy"))
    near = l.join(merged(r), ["cx", "cy"]).withColumn("km", haversine_m("la", "lo", "lb", "ob") / 1000).where(F.col("km") <= max_km).select("la", "lo", "lb", "ob", "km")
    parts = 4 * int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a whole number as key: a join on doubles would shuffle once more, into parts sized by the rows
    at = F.xxhash64(F.col("lb") + 0.0, F.col("ob") + 0.0)
    s = stations.join(merged(near), ["la", "lo"]).withColumn("at", at).repartition(parts, "at")
    o = observers.withColumn("at", at).select("at", "observer", "eb", F.col("lb").alias("lb2"), F.col("ob").alias("ob2")).repartition(parts, "at")
    j = s.join(merged(o), "at").where((F.col("lb") - F.col("lb2") == 0) & (F.col("ob") - F.col("ob2") == 0))
    return j.where(F.abs(F.col("ea") - F.col("eb")) <= max_rise_m).select("station", "observer", "km")


def station_range(stations: DataFrame, range_edges: DataFrame, near_deg: float = 0.04) -> DataFrame:
    """Range a station lies in, else the nearest within ``near_deg``."""
    return within_or_nearest(stations, range_edges, "lon", "lat", ["site_uid"], near_deg, 0.5).select("site_uid", F.col("poly_id").alias("range_id"), "match_type")


def river_facts(flowlines: DataFrame, towns: DataFrame, top: int = 8, top_towns: int = 6) -> DataFrame:
    """Per river: length, drainage at its lowest reach, largest tributaries by junction, and towns in its watersheds.

    ``flowlines`` has gnis_id, gnis_name, lengthkm, hydroseq, totdasqkm, streamorde, fromnode, tonode, huc8."""
    named = flowlines.where(F.coalesce(F.trim("gnis_id"), F.lit("")) != "")
    base = named.groupBy("gnis_id").agg(F.sum("lengthkm").alias("length_km"), F.min_by("totdasqkm", "hydroseq").alias("drainage_km2"), F.max("streamorde").alias("top_order"))
    joints = named.select("gnis_id", F.col("fromnode").alias("tonode")).distinct()
    t = named.select(F.col("gnis_id").alias("t_id"), F.trim("gnis_name").alias("t_name"), "totdasqkm", "streamorde", "tonode")
    j = t.join(joints, "tonode").where(F.col("t_id") != F.col("gnis_id")).join(base.select("gnis_id", "top_order"), "gnis_id").where(F.col("streamorde") >= F.greatest(F.lit(3), F.col("top_order") - 3))
    per = j.groupBy("gnis_id", "t_name").agg(F.max("totdasqkm").alias("a"))
    w = Window.partitionBy("gnis_id").orderBy(F.desc("a"), "t_name")
    trib = per.withColumn("k", F.row_number().over(w)).where(F.col("k") <= top).groupBy("gnis_id").agg(F.array_sort(F.collect_list(F.struct("k", "t_name"))).alias("x")).select("gnis_id", F.transform("x", lambda v: v["t_name"]).alias("tributaries"))
    seg = named.select("gnis_id", "huc8").distinct().join(towns, "huc8")
    tw = Window.partitionBy("gnis_id").orderBy(F.desc("area"), "town")
    tn = seg.withColumn("k", F.row_number().over(tw)).where(F.col("k") <= top_towns).groupBy("gnis_id").agg(F.array_sort(F.collect_list(F.struct("k", "town"))).alias("x")).select("gnis_id", F.transform("x", lambda v: v["town"]).alias("towns"))
    return base.drop("top_order").join(trib, "gnis_id", "left").join(tn, "gnis_id", "left")


def segment_facts(river_lines: DataFrame, segments: DataFrame, towns: DataFrame, waterbodies: DataFrame, town_reach: float = 0.06, touch: float = 0.01,
                  least_area: float = 0.5, cell: float = 0.05) -> DataFrame:
    """Per (line_id, segment): towns beside the river in the segment and reservoirs that touch it there, largest first.

    ``river_lines``: segment rows with line_id; ``segments``: edge rows with segment. ``towns``: town, area, lon, lat, taken if within
    ``town_reach`` of the river and inside the segment. ``waterbodies``: edge rows feature_id, name, ftype, area_km2; reservoirs and
    lakes above ``least_area`` within ``touch`` of the river that share a point with the segment. A segment with neither is left out."""
    near = near_lines(towns, river_lines, "lon", "lat", ["town", "area", "lon", "lat"], town_reach).where(F.col("distance_m") < town_reach)
    polygons = segments.withColumnRenamed("segment", "poly_id")
    places = towns.join(near.select("town", "lon", "lat").distinct(), ["town", "lon", "lat"], "left_semi")
    inside = points_in_polygons(places, polygons, "lon", "lat", ["town", "lon", "lat"], cell * 16)
    beside = near.join(inside, ["town", "lon", "lat"]).groupBy("line_id", F.col("poly_id").alias("segment")).agg(
        F.array_sort(F.collect_set(F.struct((-F.col("area")).alias("k"), F.col("town").alias("name")))).alias("t"))
    big = waterbodies.where(F.col("ftype").isin("Reservoir", "LakePond") & (F.col("area_km2") > least_area)).withColumn("area", F.lit(True))
    close = features_within(big, river_lines, touch, cell)
    held = meets_polygons(big.join(close.select("feature_id").distinct(), "feature_id", "left_semi"), polygons, cell)
    names = big.where(F.trim("name") != "").select("feature_id", F.trim("name").alias("name"), "area_km2").distinct()
    # a name that several bodies bear counts once, at its largest
    lakes = close.join(held, "feature_id").join(names, "feature_id").groupBy("line_id", F.col("poly_id").alias("segment"), "name").agg(F.max("area_km2").alias("a"))
    lakes = lakes.groupBy("line_id", "segment").agg(F.array_sort(F.collect_list(F.struct((-F.col("a")).alias("k"), "name"))).alias("r"))
    plain = lambda c: F.transform(F.coalesce(c, F.array().cast("array<struct<k:double,name:string>>")), lambda v: v["name"])
    return beside.join(lakes, ["line_id", "segment"], "full_outer").select("line_id", "segment", plain("t").alias("towns"), plain("r").alias("reservoirs"))
