import math

from pyspark.sql import functions as F

from tidemark.operators import grids, network, resolve, spatial

SITES = "site_uid string, source string, native_id string, name string, lat double, lon double, site_type string, raw_metadata string"


def test_wells_pair_and_permit_points_never_do(frame):
    s = frame([("usgs:1", "usgs", "1", "w", 35.0, -106.0, "well", None), ("nmwdi:2", "nmwdi", "2", "w", 35.0001, -106.0001, "well", None), ("ose_arcgis:pod:3", "ose_arcgis", "pod:3", "w", 35.0, -106.0, "well", None)], SITES)
    out = resolve.proximity_links(s).collect()
    assert [(x.site_uid_a, x.site_uid_b) for x in out] == [("nmwdi:2", "usgs:1")] and 10 < out[0].distance_m < 20




def test_name_match(frame):
    p = frame([("Pecos River bl Taiban Creek", "PECOS RIVER BELOW TAIBAN CK, NM"), ("Rio X above Dam Foo", "Rio X below Dam Foo"), ("Jemez Dam total", "Jemez Dam"), ("Acequia Larga", "Larga"), ("Left Hand", "Lefthand"), ("Dam", "Dam")], "name_a string, name_b string")
    out = [(x.name_match, x.same_name) for x in resolve.with_name_match(p).collect()]
    assert [o[0] for o in out] == [1.0, 0.0, 0.0, 0.5, 0.0, 0.0] and [o[1] for o in out][3:] == [True, True, False]


def test_series_agreement_rules(frame):
    a = frame([("stage", 66, 0.0, 0.9999), ("stage", 59, 0.0, 1.0), ("discharge", 500, 0.02, 0.995), ("discharge", 500, 0.04, 0.999), ("precip", 900, 0.0, 1.0), ("stage", 70, None, 1.0)], "variable string, days int, median_rel double, corr double")
    assert [x.agrees for x in resolve.with_agreement(a).collect()] == [True, False, True, False, False, False]


def test_copies_form_groups_of_given_sites(frame):
    n = frame([("usgs:1",), ("usbr:9",), ("cwms:x",), ("usgs:2",)], "site_uid string")
    e = frame([("usgs:1", "usbr:9"), ("cwms:x", "usbr:9"), ("usgs:2", "gone:1"), ("gone:1", "usgs:1")], "site_uid_a string, site_uid_b string")
    g = {x.site_uid: x.group for x in resolve.connected_groups(n, e).collect()}
    assert g == {"usgs:1": "cwms:x", "usbr:9": "cwms:x", "cwms:x": "cwms:x", "usgs:2": "usgs:2"}


def test_long_chains_and_hubs_group(frame):
    n = [(f"{i:05d}",) for i in range(400)]
    chain = [(f"{i:05d}", f"{i + 1:05d}") for i in range(199)]
    hub = [("00399", f"{i:05d}") for i in range(200, 399)]
    g = resolve.connected_groups(frame(n, "site_uid string"), frame(chain + hub, "site_uid_a string, site_uid_b string"))
    assert sorted((x.group, x["count"]) for x in g.groupBy("group").count().collect()) == [("00000", 200), ("00200", 200)]


def test_anchor_settles_candidates(frame):
    rows = [("b:1", "usgs:1", "same_sensor"), ("c:1", "usgs:1", "same_sensor"), ("d:1", "usgs:2", "same_sensor"), ("e:1", "usgs:1", "same_sensor"), ("e:1", "usgs:2", "same_sensor"),
            ("b:1", "c:1", "colocated"), ("b:1", "d:1", "colocated"), ("b:1", "e:1", "colocated"), ("b:1", "f:1", "colocated")]
    links = frame([(a, b, t, "e", None, 0.5) for a, b, t in rows], "site_uid_a string, site_uid_b string, link_type string, evidence string, distance_m double, confidence double")
    out = {(x.site_uid_a, x.site_uid_b): x.link_type for x in resolve.settle_by_anchor(links).where("confidence <> 0.5 OR link_type = 'colocated'").collect()}
    assert out == {("b:1", "c:1"): "same_sensor", ("b:1", "e:1"): "colocated", ("b:1", "f:1"): "colocated"}


def test_first_named_reach_downstream(frame):
    # 1 -> 2 -> 3 (named); 4 -> node 40 splits into 5 (minor, named) and 6 (main, unnamed) -> 3; 7 dead end; 8 and 9 a loop
    rows = [(1, None, 10, 20, 1), (2, " ", 20, 30, 1), (3, "Ca¿ones Creek", 30, 99, 1), (4, None, 35, 40, 1), (5, "Minor", 40, 50, 2), (6, None, 40, 30, 1), (7, None, 60, 61, 1), (8, None, 70, 71, 1), (9, None, 71, 70, 1)]
    f = frame(rows, "comid int, gnis_name string, fromnode int, tonode int, divergence int")
    out = {x.comid: (x.river_name, x.river_steps) for x in network.downstream_names(f).collect()}
    assert out == {1: ("Cañones Creek", 2), 2: ("Cañones Creek", 1), 4: ("Cañones Creek", 2), 6: ("Cañones Creek", 1), 7: (None, None), 8: (None, None), 9: (None, None)}


def test_gauge_names(frame):
    d = frame([("Rio Ruidoso at Hollywood", "Rio Ruidoso"), ("Little Tesuque Cr", "Tesuque Creek"), ("Pecos River Trib", "Pecos River"), ("San Antonio Arroyo at Rio Grande confluence", "Rio Grande"), ("Pecos R nr Acme", "Pecos River (Upper)"), ("Acequia Madre", "Rio Pueblo"),
               ("Rio Peñasco at Dayton", "Rio Penasco")], "name string, river string")
    out = d.select(network.opens_with_river("name", "river").alias("strict"), network.carries_river_word("name", "river").alias("loose")).collect()
    assert [x.strict for x in out] == [True, False, False, False, True, False, True]
    assert [x.loose for x in out] == [True, True, True, True, True, False, True]


def test_rivers_of_one_name_get_labels(frame):
    r = frame([("g1", "Rio Hondo", "Taos", "H1"), ("g2", "Rio Hondo", "Pecos", "H2"), ("g3", "Mora", "X", "H1"), ("g4", "Mora", "X", "H3"), ("g5", "Solo", None, None)], "gnis_id string, name string, basin string, huc8 string")
    assert {x.gnis_id: x.label for x in network.label_rivers(r).collect()} == {"g1": "Rio Hondo (Taos)", "g2": "Rio Hondo (Pecos)", "g3": "Mora (H1)", "g4": "Mora (H3)", "g5": "Solo"}


def test_points_in_a_ring_with_a_hole(frame):
    def ring(x0, y0, x1, y1):
        p = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        return [("p", *a, *b) for a, b in zip(p, p[1:])]

    e = frame([tuple(float(v) if i else v for i, v in enumerate(t)) for t in ring(0, 0, 10, 10) + ring(4, 4, 6, 6)] + [("tri", 20.0, 0.0, 30.0, 0.0), ("tri", 30.0, 0.0, 20.0, 10.0), ("tri", 20.0, 10.0, 20.0, 0.0)], "poly_id string, x0 double, y0 double, x1 double, y1 double")
    pts = frame([(1, 1.1, 1.3), (2, 5.1, 5.3), (3, 11.0, 5.0), (4, 21.0, 3.3), (5, 28.0, 8.0)], "id int, x double, y double")
    assert sorted((r.id, r.poly_id) for r in spatial.points_in_polygons(pts, e, "x", "y", ["id"], 3.0).collect()) == [(1, "p"), (4, "tri")]


def test_projection_keeps_distances_near_the_parallels(frame):
    x, y = spatial.albers("lon", "lat")
    r = frame([(-96.0, 23.0), (-106.0, 35.0), (-106.01, 35.0), (-106.0, 35.01)], "lon double, lat double").select(x.alias("x"), y.alias("y")).collect()
    assert abs(r[0].x) < 1e-6 and abs(r[0].y) < 1e-6
    dist = lambda a, b: math.hypot(a.x - b.x, a.y - b.y)
    assert abs(dist(r[1], r[2]) / 913.0 - 1) < 0.015 and abs(dist(r[1], r[3]) / 1109.5 - 1) < 0.015
    # equal area: the two scale errors cancel
    assert abs(dist(r[1], r[2]) * dist(r[1], r[3]) / (913.04 * 1109.44) - 1) < 0.002


def test_snapping_is_limited_and_nearest(frame):
    x, y = spatial.albers(F.lit(-106.0), F.lit(35.0))
    s = frame([("usgs:1", "usgs", "1", "g", 35.0, -106.0, "stream", None), ("usgs:2", "usgs", "2", "g", 35.5, -106.0, "stream", None), ("ose_arcgis:pod:1", "ose_arcgis", "pod:1", "g", 35.0, -106.0, "diversion", None),
               ("ose_arcgis:pod:2", "ose_arcgis", "pod:2", "g", 35.0, -106.0, "diversion", '{"grnd_wtr_s": "S"}')], SITES)
    lines = s.limit(1).select(F.explode(F.array(*[F.struct(F.lit(c).alias("comid"), (x - 1000).alias("x0"), (y + o).alias("y0"), (x + 1000).alias("x1"), (y + o).alias("y1")) for c, o in ((7, 120.0), (8, -90.0))])).alias("s")).select("s.*")
    out = {r.site_uid: (r.comid, round(r.snap_distance_m)) for r in spatial.snap_sites(s, lines).collect()}
    assert out == {"usgs:1": (8, 90), "ose_arcgis:pod:2": (8, 90)}


def test_cell_weights_of_a_box_over_one_and_a_half_cells(frame):
    cells = frame([(0, 0, 35.0, -106.0, "2020-01-01", 10.0), (0, 1, 35.0, -105.0, "2020-01-01", 40.0)], "iy int, ix int, lat double, lon double, date date, value double")
    e = spatial.box_edges(frame([("b", -106.5, -105.0, 34.5, 35.5)], "unit string, x0 double, x1 double, y0 double, y1 double"))
    w = grids.cell_weights(cells, e, 1.0, 1.0)
    assert {x.ix: x.weight for x in w.collect()} == {0: 1.0, 1: 0.5}
    assert grids.polygon_cells(e, 1.0, 1.0).first().cells == 1.5
    assert grids.zonal_mean(cells, w).first().value == 20.0
    assert grids.zonal_mean(cells.withColumn("value", F.when(F.col("ix") == 0, F.col("value"))), w).first().value == 10.0


def test_station_pairs_of_many_at_one_place_lie_in_many_parts(spark):
    a = spark.range(30).select(F.concat(F.lit("s"), "id").alias("site_uid"), (33.0 + F.col("id") % 3 * 0.01).alias("lat"), F.lit(-107.0).alias("lon"), (F.col("id") * 100.0).alias("elevation_m"))
    b = spark.range(40).select(F.concat(F.lit("o"), "id").alias("site_uid"), (33.0 + F.col("id") % 20 * 0.01).alias("lat"), F.lit(-107.0).alias("lon"), F.lit(1000.0).alias("elevation_m"))
    b = b.unionByName(spark.createDataFrame([("none", None, None, 1000.0)], "site_uid string, lat double, lon double, elevation_m double"))
    pairs = spatial.station_pairs(a, b)
    rows = [(r.station, r.observer) for r in pairs.collect()]
    near = lambda i, k: math.radians(abs(i % 3 - k % 20) * 0.01) * 6371 <= 12 and abs(i * 100 - 1000) <= 450
    assert sorted(rows) == sorted((f"s{i}", f"o{k}") for i in range(30) for k in range(40) if near(i, k))
    assert pairs.rdd.getNumPartitions() == 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
