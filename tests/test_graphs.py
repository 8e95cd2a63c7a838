import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import graphs, ratings
from tidemark.operators import grids, spatial


def chain(n, order):
    ids = list(range(n))
    if order == "random":
        random.Random(3).shuffle(ids)
    if order == "far end first":  # the smallest label enters at the far end
        ids = ids[1:] + ids[:1]
    return [(f"n{a:05d}", f"n{b:05d}") for a, b in zip(ids, ids[1:])]


def grid(w, h):
    name = lambda x, y: f"{y}/{x}"
    return [(name(x, y), name(x + dx, y + dy)) for x in range(w) for y in range(h) for dx, dy in ((1, 0), (0, 1)) if x + dx < w and y + dy < h]


@pytest.mark.parametrize("edges", [chain(5000, "random"), chain(5000, "far end first"), grid(150, 40)], ids=["random chain", "adverse chain", "grid"])
def test_components_take_few_rounds(frame, monkeypatch, edges):
    rounds = []
    real = graphs._print
    monkeypatch.setattr(graphs, "_print", lambda e: rounds.append(1) or real(e))
    out = graphs.components(frame(edges, "a string, b string"))
    nodes = {x for e in edges for x in e}
    row = out.agg(F.count("*").alias("n"), F.count_distinct("root").alias("roots"), F.min("root").alias("root")).first()
    assert (row.n, row.roots, row.root) == (len(nodes) - 1, 1, min(nodes))
    assert len(rounds) < 20


def test_components_of_odd_edges(frame):
    out = graphs.components(frame([("b", "b"), (None, "c"), ("d", "e"), ("e", "d"), ("f", "e")], "a string, b string"))
    assert sorted(map(tuple, out.collect())) == [("e", "d"), ("f", "d")]
    assert graphs.components(frame([], "a string, b string")).count() == 0


def test_windows_longer_than_a_year(frame):
    days = frame([("g", "2020-01-15", 1.0), ("g", "2021-06-01", 2.0), ("g", "2022-03-01", 4.0)], "gauge string, date date, cfs double")
    out = ratings.year_windows(days, ["gauge"], "cfs", F.lit("2022-03-01").cast("date"), [30, 800])
    got = {(r.days, r.year): r.total for r in out.collect()}
    assert got[(800, 2022)] == 7.0 and got[(30, 2022)] == 4.0 and got[(800, 2021)] == 1.0


@pytest.mark.parametrize("lat, lon", [(35.0, -106.0), (60.0, 10.0), (75.0, 179.99), (89.95, 0.0)])
def test_pairs_at_any_latitude(frame, lat, lon):
    import math

    r = random.Random(4)
    span = min(0.4 / max(math.cos(math.radians(lat)), 1e-3), 180)
    points = [(f"p{i}", max(-90.0, min(90.0, lat + r.uniform(-0.2, 0.2))), (lon + r.uniform(-span, span) + 180) % 360 - 180, 0.0) for i in range(60)]
    df = frame(points, "site_uid string, lat double, lon double, elevation_m double")

    def km(p, q):
        a, b = math.radians(p[1]), math.radians(q[1])
        h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return 2 * 6371 * math.asin(min(1, math.sqrt(h)))

    want = sorted((p[0], q[0]) for p in points for q in points if km(p, q) <= 12)
    got = sorted((x.station, x.observer) for x in spatial.station_pairs(df, df).collect())
    assert got == want and len(want) > 60


def test_cells_near_the_pole_find_their_seed(frame):
    cells = frame([(0, 0, 70.0, 1.5)], "iy int, ix int, lat double, lon double")
    seeds = frame([("r", 70.0, 0.0)], "range_id string, lat double, lon double")
    assert grids.label_cells(cells, seeds, 60.0).count() == 1


def test_a_long_line_costs_as_many_rows_as_it_crosses_buckets(frame):
    r = random.Random(6)
    ends = [(0.0, 0.0, 900.0, 700.0), (5.0, 900.0, 5.0, 10.0), (10.0, 3.0, 880.0, 3.0), (100.0, 100.0, 100.0, 100.0), (0.0, 0.0, 1.0, 999.0)]
    lines = frame([(f"l{i}", *e) for i, e in enumerate(ends)], "line_id string, x0 double, y0 double, x1 double, y1 double")
    points = [(i, r.uniform(-3, 903), r.uniform(-3, 1003)) for i in range(1500)] + [(2000 + i, x * 9.0, x * 7.0 + 1.2) for i, x in enumerate(range(100))]
    out = spatial.near_lines(frame(points, "id bigint, px double, py double"), lines, "px", "py", ["id"], 2.0)

    def near(p, e):
        dx, dy = e[2] - e[0], e[3] - e[1]
        t = max(0.0, min(1.0, ((p[1] - e[0]) * dx + (p[2] - e[1]) * dy) / (dx * dx + dy * dy or 1)))
        return ((p[1] - e[0] - t * dx) ** 2 + (p[2] - e[1] - t * dy) ** 2) ** 0.5 <= 2.0

    assert sorted((x.id, x.line_id) for x in out.collect()) == sorted((p[0], f"l{i}") for p in points for i, e in enumerate(ends) if near(p, e))


def test_a_polygon_of_many_vertices_is_cut_into_strips(frame):
    import math

    n = 2000
    ring = [(math.cos(2 * math.pi * i / n) * (1 + 0.3 * (i % 2)), math.sin(2 * math.pi * i / n) * (1 + 0.3 * (i % 2))) for i in range(n)]
    edges = frame([("p", *ring[i], *ring[(i + 1) % n]) for i in range(n)], "poly_id string, x0 double, y0 double, x1 double, y1 double")
    points = [(i, -1.2 + 0.11 * (i % 22), -1.2 + 0.11 * (i // 22)) for i in range(484)]
    got = {x.id for x in spatial.points_in_polygons(frame(points, "id bigint, px double, py double"), edges, "px", "py", ["id"]).collect()}

    def inside(x, y):
        k = 0
        for i in range(n):
            (a, b), (c, d) = ring[i], ring[(i + 1) % n]
            if (b > y) != (d > y) and x < a + (y - b) / (d - b) * (c - a):
                k += 1
        return k % 2 == 1

    assert got == {i for i, x, y in points if inside(x, y)}
