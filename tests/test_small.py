import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import balance, flow, grids, network, normals, resolve, status
from tidemark.sources import archive


def test_table_group_reads_the_union_of_its_columns(frame, spark, tmp_path):
    frame([(1, "a")], "k int, v string").write.parquet(str(tmp_path / "t/p1"))
    frame([(2, "b", 3.0)], "k int, v string, w double").write.parquet(str(tmp_path / "t/p2"))
    out = archive.read_table_group(spark, [str(tmp_path / "t/p1"), str(tmp_path / "t/p2")])
    assert sorted((r.k, r.w) for r in out.collect()) == [(1, None), (2, 3.0)]


def test_column_helpers(frame):
    r = frame([(50.0, 1577836800000)], "f double, ms bigint").select(c.celsius("f").alias("c"), c.epoch_millis("ms").cast("string").alias("t")).first()
    assert (r.c, r.t) == (10.0, "2020-01-01 00:00:00")


def test_groups_take_name_and_segment_from_the_best_source(frame):
    g = frame([("b:1", "codwr", "Colorado name", "x"), ("a:1", "usgs", "USGS name", "y"), ("z:1", "codwr", "Alone", "z")], "site_uid string, source string, name string, segment string")
    grp = frame([("b:1", "a:1"), ("a:1", "a:1"), ("z:1", "z:1")], "site_uid string, group string")
    out = {r.site_uid: (r.gauge, r.segment) for r in flow.label_gauges(g, grp).collect()}
    assert out == {"b:1": ("USGS name", "y"), "a:1": ("USGS name", "y"), "z:1": ("Alone", "z")}


def test_weekly_snow_days(frame):
    d = frame([("2024-01-01",), ("2024-01-02",), ("2024-07-01",), ("2024-06-03",)], "date date")
    assert [r[0] for r in d.select(grids.weekly_snow_day()).collect()] == [True, False, False, True]


def test_unknown_rules_and_snow_rules(frame):
    assert network.unknown_rules(frame([("rename",), ("guess",)], "rule string")).first().rule == "guess"
    d = frame([("a", "normal", None, False, None), ("b", "normal", 1.0, True, 50.0), ("c", None, None, False, 10.0), ("d", "normal", 1.0, False, 50.0)], "k string, cls string, usual double, little boolean, pct double")
    assert {(r.subject, r.rule) for r in status.violations(d, F.col("k"), status.snow_rules()).collect()} == {("a", "rated without a usual"), ("b", "little but classed"), ("c", "percentile without a usual")}


def test_newest_day_and_year_to_date(frame):
    d = frame([("r", "2024-01-02"), ("r", "2024-05-01")], "reach string, date date")
    assert balance.newest_day(d).first().newest == dt.date(2024, 5, 1)
    assert [r[0] for r in frame([("2024-10-01",), ("2024-09-30",)], "d date").select(normals.year_to_date_days(F.col("d"))).collect()] == [1, 366]


def test_ditch_list_prefers_the_governed_spelling(frame):
    m = frame([("r", "ACEQUIA DE LOS CHAVEZ", "s1"), ("r", "Larga Ditch", "s2")], "river string, name string, segment string")
    g = frame([("r", "Acequia de Los Chávez", "chavez"), ("r", "Acequia Nueva", "nueva")], "river string, name string, key string")
    out = {r.key: (r.name, r.segment, r.governed) for r in resolve.ditch_list(g, m).collect()}
    assert out == {"chavez": ("Acequia de Los Chávez", "s1", True), "larga": ("Larga Ditch", "s2", False), "nueva": ("Acequia Nueva", None, True)}
