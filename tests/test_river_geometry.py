"""Segments, corridors, scan lines, ids in metadata and balances of the network, against brute force."""

import itertools
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import balance, grids, resolve, spatial

SEG = "line_id string, x0 double, y0 double, x1 double, y1 double"
EDGE = "poly_id string, x0 double, y0 double, x1 double, y1 double"


def ring(name, points):
    return [(name, *a, *b) for a, b in zip(points, points[1:] + points[:1], strict=True)]


def to_segment(p, a, b):
    d = (b[0] - a[0], b[1] - a[1])
    n = d[0] ** 2 + d[1] ** 2
    t = max(0.0, min(1.0, ((p[0] - a[0]) * d[0] + (p[1] - a[1]) * d[1]) / n)) if n else 0.0
    return math.hypot(p[0] - a[0] - t * d[0], p[1] - a[1] - t * d[1])


def apart(s, t):
    a, b, c, d = s[:2], s[2:], t[:2], t[2:]
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    if side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0:
        return 0.0
    return min(to_segment(a, c, d), to_segment(b, c, d), to_segment(c, a, b), to_segment(d, a, b))


def holds(edges, p):
    inside = False
    for x0, y0, x1, y1 in edges:
        if (y0 > p[1]) != (y1 > p[1]) and p[0] < x0 + (p[1] - y0) / (y1 - y0) * (x1 - x0):
            inside = not inside
    return inside


# ---- corridors --------------------------------------------------------------


@pytest.mark.parametrize("radius, cell", [(3.0, None), (0.5, 4.0), (0.0, 5.0)])
def test_segments_against_every_pair(frame, radius, cell):
    r = random.Random(int(radius * 10) + 1)
    point = lambda w: (r.uniform(-50, 50), r.uniform(-50, 50)) if r.random() < w else (float(r.randrange(-9, 9)), float(r.randrange(-9, 9)))
    some = lambda n, p: [(f"{p}{i // 3}", *point(0.7), *point(0.7)) for i in range(n)]
    ours, theirs = some(60, "f"), some(60, "l") + [("dot", 3.0, 3.0, 3.0, 3.0)]
    want = {}
    for s, t in itertools.product(ours, theirs):
        d = apart(s[1:], t[1:])
        if d <= radius:
            want[s[0], t[0]] = min(d, want.get((s[0], t[0]), math.inf))
    got = spatial.near_segments(frame(ours, SEG.replace("line_id", "feature_id")), frame(theirs, SEG), ["feature_id"], radius, cell=cell).collect()
    assert {(x.feature_id, x.line_id): pytest.approx(x.distance_m) for x in got} == want and len(want) > 20


def test_a_ditch_that_crosses_far_from_its_ends_and_an_area_around_the_river(frame):
    river = frame([("r", 0.0, 0.0, 0.0, 2.0)], SEG)
    rows = [("ditch", "a b", False, -10000.0, 1.0, 10000.0, 1.0), ("far", "c", False, 2.0, 0.0, 9.0, 0.0)] + [("lake", "UNKNOWN", True, *e[1:]) for e in ring("", [(-500.0, -500.0), (500.0, -500.0), (500.0, 500.0), (-500.0, 500.0)])]
    features = frame(rows, "feature_id string, name string, area boolean, x0 double, y0 double, x1 double, y1 double")
    near = {x.feature_id: x.distance_m for x in spatial.near_features(features, river, 1.5, 100.0).collect()}
    assert near == {"ditch": 0.0, "lake": 0.0}
    # the outline alone does not hold the river
    assert "lake" not in {x.feature_id for x in spatial.near_features(features.withColumn("area", F.lit(False)), river, 1.5, 100.0).collect()}
    segments = frame(ring("east", [(1.0, -9.0), (9.0, -9.0), (9.0, 9.0), (1.0, 9.0)]) + ring("speck", [(100.0, 100.0), (101.0, 100.0), (101.0, 101.0)]), EDGE).withColumnRenamed("poly_id", "segment")
    got = {x.segment: (x.features, x["count"], x.names) for x in spatial.features_near_river(features, river, segments, 1.5, 100.0).collect()}
    # the ditch runs through the eastern segment without a vertex in it; the lake holds both
    assert got == {"east": (2, 1, ["A B"]), "speck": (1, 1, [])}


def test_towns_and_reservoirs_of_a_segment(frame):
    river = frame([("r", 0.0, 0.0, 10.0, 0.0)], SEG)
    segments = frame(ring("a", [(0.0, -5.0), (5.0, -5.0), (5.0, 5.0), (0.0, 5.0)]) + ring("b", [(5.0, -5.0), (10.0, -5.0), (10.0, 5.0), (5.0, 5.0)]), EDGE).withColumnRenamed("poly_id", "segment")
    towns = frame([("small", 1.0, 1.0, 0.01), ("large", 9.0, 2.0, -0.02), ("off", 50.0, 2.0, 3.0), ("east", 3.0, 7.0, 0.05)], "town string, area double, lon double, lat double")
    lake = lambda k, x, y, w, name, kind, km2: [(k, name, kind, km2, *e[1:]) for e in ring("", [(x, y), (x + w, y), (x + w, y + w), (x, y + w)])]
    bodies = frame(lake("1", 4.0, -0.5, 2.0, "Both", "Reservoir", 4.0) + lake("2", 1.0, 0.005, 0.1, "Beside", "LakePond", 9.0) + lake("3", 1.0, 1.0, 1.0, "Away", "Reservoir", 7.0)
                   + lake("4", 2.0, -0.1, 0.2, "Marsh", "SwampMarsh", 7.0) + lake("5", 2.0, -0.1, 0.2, "Pond", "LakePond", 0.4) + lake("6", 8.0, -0.1, 0.2, " ", "LakePond", 3.0),
                   "feature_id string, name string, ftype string, area_km2 double, x0 double, y0 double, x1 double, y1 double")
    got = {x.segment: (x.towns, x.reservoirs) for x in spatial.segment_facts(river, segments, towns, bodies).collect()}
    assert got == {"a": (["large", "small"], ["Beside", "Both"]), "b": (["east"], ["Both"])}


# ---- scan lines -------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_cell_weights_by_scan_line_equal_sub_cell_counts(frame, seed):
    r = random.Random(seed)
    # a concave ring with a hole, a sliver, one around everything and one outside
    star = [(1.3 + (0.3 + r.random()) * math.cos(k * math.pi / 9), 0.9 + (0.3 + r.random()) * math.sin(k * math.pi / 9)) for k in range(18)]
    polygons = {"star": ring("star", star) + ring("star", [(1.25, 0.8), (1.4, 0.83), (1.33, 1.0)]), "sliver": ring("sliver", [(0.01, 0.013), (2.9, 1.57), (2.91, 1.61)]),
                "all": ring("all", [(-9.0, -9.0), (9.0, -9.1), (9.0, 9.0), (-9.0, 9.2)]), "off": ring("off", [(20.0, 20.0), (21.0, 20.0), (21.0, 21.0)])}
    cells = [(iy + 5, ix + 7, 0.25 * iy, 0.25 * ix) for iy in range(8) for ix in range(12) if r.random() < 0.9 or (iy, ix) in ((0, 0), (7, 11))]
    got = grids.cell_weights(frame(cells, "iy int, ix int, lat double, lon double"), frame([e for p in polygons.values() for e in p], EDGE), 0.25, 0.25, 8).collect()
    want = {}
    for iy, ix, lat, lon in cells:
        for name, edges in polygons.items():
            n = sum(holds([e[1:] for e in edges], (lon + ((j + 0.5) / 8 - 0.5) * 0.25, lat + ((i + 0.5) / 8 - 0.5) * 0.25)) for i in range(8) for j in range(8))
            if n:
                want[name, iy, ix] = n / 64
    assert {(x.unit, x.iy, x.ix): x.weight for x in got} == want


def test_units_by_their_share_of_overlapping_state_parts(frame):
    cells = frame([(i, j, 0.5 * i, 0.5 * j) for i in range(8) for j in range(8)], "iy int, ix int, lat double, lon double")
    box = lambda n, a, b, c, d: ring(n, [(a, b), (c, b), (c, d), (a, d)])
    units = frame(box("u", 0.01, 0.01, 2.01, 2.01) + box("v", 2.01, 2.01, 3.51, 3.51) + box("w", 0.01, 2.51, 1.01, 3.01), EDGE)
    state = frame(box("p", -1.0, -1.0, 1.01, 9.0) + box("q", 0.51, -1.0, 1.51, 9.0), EDGE)
    got = {x.unit: (x.state_fraction, x.in_river_reports) for x in grids.select_units(cells, units, state, frame([("v",), ("z",)], "unit string"), 0.5, 0.5).collect()}
    assert got == {"u": (0.75, False), "w": (1.0, False), "v": (0.0, True), "z": (0.0, True)}
    empty = cells.limit(0)
    assert grids.cell_weights(empty, units, 0.5, 0.5).count() == 0 and [x.unit for x in grids.select_units(empty, units, state, frame([("v",)], "unit string"), 0.5, 0.5).collect()] == ["v"]
    with pytest.raises(ValueError):
        grids.cell_weights(cells, units, -0.5, 0.5)


# ---- ids in metadata --------------------------------------------------------


def walked(text):
    try:
        tree = json.loads(text)
    except (TypeError, ValueError):
        return set()
    out = set()

    def visit(node, key):
        if isinstance(node, dict):
            for k, v in node.items():
                visit(v, k)
        elif isinstance(node, list):
            for v in node:
                visit(v, key)
        elif isinstance(node, str | int) and not isinstance(node, bool) and "usgs" in key.lower():
            out.add(str(node).strip())

    visit(tree, "")
    return out


def test_metadata_values_at_any_depth(frame):
    deep = "[" * 40 + '"08313000"' + "]" * 40
    texts = ['{"usgs_ids": ["a", ["08313000"]]}', '{"note": "x \\"usgs\\": 08313000"}', '{"usgs": {"id": "08313000", "USGS-x": [1, 2.5, true, null, {"a": 3, "myUsgs": {"usgs": " 08313000 "}}]}}', f'{{"usgs": {deep}}}',
             '{"usgs": "1', "", None, "[]", '"usgs"', '["usgs", {"k": [{"Usgs": 8313000}]}]', '{"usgs": {}}', '{"a.b[0]": {"usgs.no": ["7"]}}', '{"usgs": 12345678901234567890}']
    got = {}
    for x in resolve.metadata_values(frame([(str(i), t) for i, t in enumerate(texts)], "site_uid string, raw_metadata string"), "usgs").collect():
        got.setdefault(int(x.site_uid), set()).add(x.value.strip())
    want = {i: walked(t) for i, t in enumerate(texts[:-1]) if walked(t)}
    assert {k: v for k, v in got.items() if k < len(texts) - 1} == want
    assert resolve.metadata_values(frame([], "site_uid string, raw_metadata string"), "usgs").count() == 0


def test_metadata_links(frame):
    rows = [("usgs:08313000", "usgs", "08313000", None), ("codwr:1", "codwr", "1", '{"usgs_ids": ["a", ["USGS-08313000", 8313000]]}'), ("ibwc:x", "ibwc", "08313000", "no json"), ("wqp:2", "wqp", "2", '{"note": "\\"usgs\\": 08313000"}')]
    got = resolve.metadata_links(frame(rows, "site_uid string, source string, native_id string, raw_metadata string")).collect()
    assert sorted((x.site_uid_a, x.site_uid_b, x.link_type) for x in got) == [("codwr:1", "usgs:08313000", "same_sensor"), ("ibwc:x", "usgs:08313000", "same_location_different_sensor")]


# ---- balances of the network ------------------------------------------------


def test_reaches_between_gauges(frame):
    # 1 <- 2 <- 3 <- 4 (a fork at 5: 6 is the minor arm), 7 -> 3, 9 -> 9 a loop
    flow = [(1, 1, 0, 1), (2, 2, 1, 1), (3, 3, 2, 1), (4, 4, 3, 1), (5, 5, 4, 1), (6, 4, 8, 2), (7, 7, 3, 1), (8, 8, 2, 1), (9, 9, 9, 1)]
    lines = frame(flow, "comid bigint, fromnode bigint, tonode bigint, divergence int")
    stops = frame([(2,), (4,), (7,)], "comid bigint")
    got = {x.comid: x.stop for x in balance.first_stop_below(lines, stops).collect()}
    assert got == {1: None, 2: None, 3: 2, 4: 2, 5: 4, 6: 2, 7: 2, 8: 2, 9: None}
    gauges = frame([("down", 2), ("up", 4), ("side", 7), ("zz", 4), ("alone", 9)], "gauge string, comid bigint")
    lakes = frame([("lake", 3), ("high", 5), ("at", 2), ("below", 1)], "reservoir string, comid bigint")
    terms = sorted((x.reach, x.term, x.role, x.kind) for x in balance.network_terms(lines, gauges, lakes).collect())
    assert terms == sorted([("down", "up", "inflow", "flow"), ("down", "side", "inflow", "flow"), ("down", "down", "outflow", "flow"), ("up", "up", "outflow", "flow")]
                           + [("down", f"{k}/{r}", r, kind) for k in ("lake", "at") for r, kind in (("storage", "storage"), ("evaporation", "volume"))]
                           + [("up", f"high/{r}", r, kind) for r, kind in (("storage", "storage"), ("evaporation", "volume"))])


def test_first_stop_on_long_ways(frame):
    r = random.Random(4)
    down = {i: i - r.randrange(1, 4) for i in range(1, 900)}
    lines = frame([(i, i, d, 1) for i, d in down.items()], "comid bigint, fromnode bigint, tonode bigint, divergence int")
    stops = {3, 90, 91, 400, 777}

    def walk(i):
        while (i := down.get(i)) is not None and i in down:
            if i in stops:
                return i
        return None

    got = {x.comid: x.stop for x in balance.first_stop_below(lines, frame([(s,) for s in stops], "comid bigint")).collect()}
    assert got == {i: walk(i) for i in down}


def scattered(spark, n, reach, seed, **cols):
    """n segments over a square of 1,000, some upright, some steep, some drawn twice."""
    c = F.col
    at = lambda k: F.pmod(F.xxhash64("id", F.lit(seed + k)), F.lit(100_000)) / 100.0
    d = spark.range(n).select("id", at(1).alias("x0"), at(2).alias("y0"), at(3).alias("u"), at(4).alias("v"))
    d = d.withColumn("x1", F.when(c("id") % 7 == 0, c("x0")).when(c("id") % 7 == 1, c("x0") + 1e-9).otherwise(c("x0") + (c("u") - 500) / 1000 * reach)).withColumn("y1", c("y0") + (c("v") - 500) / 1000 * reach)
    d = d.select(*[F.expr(e).alias(k) for k, e in cols.items()], "x0", "y0", "x1", "y1")
    return d.unionByName(d.limit(5))


def test_features_within_finds_the_pairs_of_near_features(spark):
    lines = scattered(spark, 60, 300, 10, line_id="id % 9")
    ditches = scattered(spark, 120, 200, 20, feature_id="id", area="false")
    boxes = spark.range(60).select((F.col("id") + 1000).alias("unit"), (F.col("id") * 131 % 900 + 0.5).alias("x0"), (F.col("id") * 71 % 900 + 0.5).alias("y0"), F.col("id").alias("k"))
    boxes = boxes.withColumn("x1", F.col("x0") + 5 + F.col("k") * 7).withColumn("y1", F.col("y0") + 9 + F.col("k") % 8 * 40)
    areas = spatial.box_edges(boxes).withColumnRenamed("poly_id", "feature_id").withColumn("area", F.lit(True))
    features = ditches.unionByName(areas)
    for radius, cell in ((3.0, None), (40.0, 25.0)):
        want = {(r.feature_id, r.line_id) for r in spatial.near_features(features, lines, radius, cell).collect()}
        got = [(r.feature_id, r.line_id) for r in spatial.features_within(features, lines, radius, cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_rows_filed_under_buckets_are_not_broadcast(spark):
    points = spark.range(50).select("id", (F.col("id") * 37 % 50).cast("double").alias("px"), (F.col("id") * 11 % 50).cast("double").alias("py"))
    lines = scattered(spark, 20, 300, 30, line_id="id")
    boxes = spatial.box_edges(spark.range(5).select(F.col("id").alias("unit"), F.lit(0.5).alias("x0"), (F.col("id") + 9.5).alias("x1"), F.lit(0.5).alias("y0"), F.lit(20.5).alias("y1")))
    for df in (spatial.nearest_line(points, lines, "px", "py", ["id"], 200.0), spatial.near_lines(points, lines, "px", "py", ["id"], 200.0), spatial.within_or_nearest(points, boxes, "px", "py", ["id"], 5.0, 5.0)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Broadcast" in x]


def test_points_of_one_place_share_its_distances(spark):
    points = spark.createDataFrame([(k, 5.0, 5.0) for k in range(400)] + [(400, None, 5.0)], "id int, px double, py double")
    lines = spark.createDataFrame([(k, 0.0, 8.0, 10.0, 8.0) for k in range(300, 0, -1)], "line_id int, x0 double, y0 double, x1 double, y1 double")
    near = spatial.nearest_line(points, lines, "px", "py", ["id"], 4.0)
    assert {(r.id, r.line_id, r.distance_m) for r in near.collect()} == {(k, 1, 3.0) for k in range(400)}
    sizes = []
    met = spatial._place_lines

    def counted(places, drawn, *a):
        sizes.append((places.count(), drawn.count()))
        return met(places, drawn, *a)

    spatial._place_lines = counted
    try:
        spatial.nearest_line(points, lines, "px", "py", ["id"], 4.0)
    finally:
        spatial._place_lines = met
    assert sizes == [(1, 1)]
