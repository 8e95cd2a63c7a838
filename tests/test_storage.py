import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.operators import grids, maintain, quality
from tidemark.plans.tables import Tables
from tidemark.schema import STORED
from tidemark.sources import archive, manifest

OBS = "site_uid string, variable string, datetime_utc timestamp, value double, interval string, statistic string, depth_cm double, ingest_run_id string"

def now():
    return F.lit("2024-01-01").cast("timestamp")


@pytest.fixture
def registry(spark):
    return Tables(spark, "").registry


def obs(frame, days, values, run, depth=None):
    return frame([("usgs:1", "discharge", d, float(v), "daily", "mean", depth, run) for d, v in zip(days, values)], OBS)


def test_write_partitions_and_compaction_keep_the_newest_run(frame, spark, registry, tmp_path):
    root, staging = str(tmp_path / "obs"), str(tmp_path / "new")
    archive.append_observations(obs(frame, ["2020-01-01", "2020-01-02", "2021-01-01"], [1, 2, 3], "r1"), registry, now(), root, "r1")
    archive.append_observations(obs(frame, ["2020-01-02", "2020-01-03"], [20, 30], "r2"), registry, now(), root, "r2")
    stored = archive.read_observations(spark, root)
    assert stored.count() == 5
    assert {r.year for r in stored.select("year").distinct().collect()} == {2020, 2021}
    report = maintain.compact_partitions(spark, root, staging)
    assert report.agg(F.sum("removed")).first()[0] == 1
    kept = archive.read_observations(spark, f"{staging}/data").where("year = 2020").orderBy("datetime_utc")
    assert [r.value for r in kept.collect()] == [1.0, 20.0, 30.0]
    # partition columns prune: the scan of one year names it in its partition filters
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2020" in plan
    assert maintain.file_sizes(spark, f"{staging}/data").first().files >= 2


def test_compaction_of_named_partitions_reads_no_others(frame, spark, registry, tmp_path):
    root, staging = str(tmp_path / "obs"), str(tmp_path / "new")
    archive.append_observations(obs(frame, ["2020-01-01", "2021-01-01"], [1, 3], "r1"), registry, now(), root, "r1")
    archive.append_observations(obs(frame, ["2020-01-01", "2021-01-01"], [5, 6], "r2"), registry, now(), root, "r2")
    report = maintain.compact_partitions(spark, root, staging, only=[("usgs", "discharge", 2021)])
    assert [(r.year, r.rows_before, r.removed) for r in report.collect()] == [(2021, 2, 1)]
    assert [r.value for r in archive.read_observations(spark, f"{staging}/data").collect()] == [6.0]


def test_every_depth_survives_and_null_depths_are_one_key(frame, registry):
    d = obs(frame, ["2020-01-01"], [1], "r1", 5.0).union(obs(frame, ["2020-01-01"], [2], "r1", 20.0)).union(obs(frame, ["2020-01-01"], [3], "r1")).union(obs(frame, ["2020-01-01"], [4], "r2"))
    kept = archive.prepare_write(d, registry, now())
    assert sorted(r.value for r in kept.collect()) == [1.0, 2.0, 4.0]
    assert maintain.compact(kept).count() == 3


def test_impossible_and_future_dates_are_not_stored(frame, registry):
    d = obs(frame, ["0990-02-23", "2020-01-01", "2316-05-01", "2024-01-02", "2024-02-01"], [1, 2, 3, 4, 5], "r1")
    assert sorted(r.value for r in archive.prepare_write(d, registry, now()).collect()) == [2.0, 4.0]


def test_missing_codes_follow_the_variable(frame, registry):
    d = frame([("discharge", -999.0), ("discharge", -9999.00000001), ("discharge", -0.5), ("swe", -99.9), ("stage", -9999.0), ("unheard_of", -9999.0)], "variable string, value double")
    kept = {(r.variable, r.value) for r in quality.drop_missing_codes(d, registry).collect()}
    assert kept == {("discharge", -0.5), ("stage", -9999.0), ("unheard_of", -9999.0)}


def test_range_statistics(frame):
    reg = frame([("swe", "in", 0.0, -1.0, 200.0)], "variable string, unit string, valid_min double, noise_floor double, valid_max double")
    d = frame([("swe", v) for v in (5.0, 0.5, -0.4, -0.9, -5.0, 250.0, None)], "variable string, value double")
    r = quality.range_stats(d, reg).first()
    assert (r.n, r.below, r.near_zero, r.above, r.lo, r.hi) == (6, 1, 2, 1, -5.0, 250.0)
    flags = [x.qc_flag for x in quality.qc_flag(d, reg).collect()]
    assert flags == ["ok", "ok", "near_zero", "near_zero", "implausible", "implausible", "ok"]


def test_crosswalk_keeps_a_rows_own_statistic_and_can_keep_unmapped(spark, frame):
    t = Tables(spark, "")
    d = frame([("usgs", "P3", 50.0, "max"), ("usgs", "P3", 50.0, None), ("nrcs", "P5", 1.0, None), ("usgs", "zz", 1.0, None)], "source string, source_param string, value double, statistic string")
    m = quality.apply_crosswalk(d, t.crosswalk, t.registry).collect()
    assert sorted((r.value, r.statistic, r.unit) for r in m) == [(9.0, "max", "degC"), (9.0, "mean", "degC")]
    assert quality.apply_crosswalk(d, t.crosswalk, t.registry, keep_unmapped=True).count() == 4


def test_the_last_override_wins(spark, frame):
    t = Tables(spark, "")
    d = frame([("usgs:3", "P1", "F", "discharge", "cfs"), ("usgs:4", "P1", "F", "discharge", "cfs"), ("usgs:4", "P1", "O", "discharge", "cfs"), ("usgs:3", "P1", "F", None, None)],
              "site_uid string, source_param string, qualifier string, variable string, unit string")
    out = [(r.site_uid, r.variable) for r in quality.override_variable(d, t.overrides, t.registry).collect()]
    assert sorted(out, key=str) == sorted([("usgs:3", "return_flow"), ("usgs:4", "diversion"), ("usgs:4", "discharge"), ("usgs:3", None)], key=str)


def test_coordinates_are_repaired_and_noted(frame):
    s = frame([("a", 0.0, 0.0, '{"k": 1}'), ("b", 35.9, 108.49, None), ("c", 35.9, 12.0, None), ("d", 0.0, -106.0, None), ("e", None, None, None)], "id string, lat double, lon double, raw_metadata string")
    r = {x.id: x for x in quality.repair_coordinates(s).collect()}
    assert r["a"].lat is None and r["a"].lon is None and r["a"].raw_metadata.startswith('{"k": 1, "coordinate_fix"')
    assert r["b"].lon == -108.49 and r["b"].coordinate_fix == "sign_flipped"
    assert r["c"].lon == 12.0 and r["d"].lon == -106.0 and r["e"].coordinate_fix is None


def test_appended_tables_union_by_name_and_report_clashes(frame):
    a = frame([(1, "x"), (1, "x")], "k int, v string")
    b = frame([(1, "x", 2.0)], "k int, v string, w double")
    c = frame([("q",)], "k string")
    good, bad = maintain.compatible_parts([a, b, c])
    assert bad == [2] and maintain.compact_tables(good).count() == 2


def test_coordinate_fallbacks(frame):
    m = frame([("1", "a", 35.8, -105.9, None, None, None, None), ("7", "b", None, None, '35° 36\' 51.918" N', '105° 14\' 39.529" W', None, None), (None, "u", None, None, None, None, 500000.0, 3873043.0), (None, "Gonzales", 36.0, -106.2, None, None, None, None),
               (None, "Gonzales", 36.1, -106.3, None, None, None, None), (None, "Heredia", 32.1, -107.7, None, None, None, None)],
              "station_id string, name string, lat_dd double, lon_dd double, lat_dms string, lon_dms string, easting double, northing double")
    c = quality.station_coordinates(m)
    r = {x.name: x for x in c.collect()}
    assert abs(r["b"].lat - 35.6144) < 1e-3 and r["b"].lon < -105 and r["u"].basis == "utm"
    assert abs(r["u"].lon + 105.0) < 1e-9 and abs(r["u"].lat - 35.0) < 2e-3
    st = frame([("7", "zz"), (None, "gonzales"), (None, "HEREDIA")], "station_id string, name string")
    out = {x.name: x.matched_by for x in quality.match_coordinates(st, c).collect()}
    assert out == {"zz": "id", "gonzales": None, "HEREDIA": "name"}


def test_marts_round_trip(frame, spark, tmp_path):
    d = frame([(1, 2.0), (2, float("nan"))], "k int, v double")
    archive.publish_json(d, str(tmp_path / "j"))
    archive.publish_csv(d, str(tmp_path / "c"))
    back = {r.k: r.asDict().get("v") for r in spark.read.json(str(tmp_path / "j")).collect()}
    assert back == {1: 2.0, 2: None} and spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == 2


# ---- rewriting under a manifest ---------------------------------------------


def loads(frame, root):
    """Two loads: discharge of 2020 in both, 2021 and stage in the first only."""
    def rows(some, run):
        d = frame([(s, v, d, x, "daily", "mean", None, run) for s, v, d, x in some], OBS)
        return archive.coerce(d.withColumn("source", F.split_part("site_uid", F.lit(":"), F.lit(1))).withColumn("year", F.year("datetime_utc")), STORED)

    first = [("usgs:1", "discharge", "2020-01-01", 1.0), ("usgs:1", "discharge", "2020-01-02", -999.0), ("usgs:1", "discharge", "2021-01-01", 3.0), ("nrcs:a b", "stage", "2020-01-01", 4.0)]
    manifest.write(rows(first, "r1"), root, "load1", maintain.PARTITIONS)
    manifest.write(rows([("usgs:1", "discharge", "2020-01-01", 10.0)], "r2"), root, "load2", maintain.PARTITIONS)


def stamps(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/version=*/**/*.parquet", recursive=True)}


def values(spark, root):
    return sorted((r.variable, r.year, r.value) for r in archive.read_observations(spark, root).collect())


def test_compaction_rewrites_partitions_of_several_files_only(frame, spark, tmp_path):
    root = str(tmp_path / "obs")
    loads(frame, root)
    before = stamps(root)
    assert maintain.compact_archive(spark, root, "c1") == ["source=usgs/variable=discharge/year=2020"]
    assert values(spark, root) == [("discharge", 2020, -999.0), ("discharge", 2020, 10.0), ("discharge", 2021, 3.0), ("stage", 2020, 4.0)]
    assert {f: t for f, t in stamps(root).items() if f in before} == before
    # nothing left to do; the job's name can be used again without effect
    assert maintain.compact_archive(spark, root, "c2") == [] and maintain.compact_archive(spark, root, "c1") == ["source=usgs/variable=discharge/year=2020"]
    assert manifest.clean(spark, root) == 2 and len(values(spark, root)) == 4
    assert not any("version=load2" in f for f in stamps(root))


def test_a_driver_lost_before_the_swap(frame, spark, registry, tmp_path, monkeypatch):
    root = str(tmp_path / "obs")
    loads(frame, root)
    before, files = values(spark, root), stamps(root)

    def lost(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(manifest, "swap", lost)
    with pytest.raises(KeyboardInterrupt):
        maintain.purge_archive(spark, root, registry, "p1")
    monkeypatch.undo()
    assert values(spark, root) == before and manifest.pending(spark, root) == ["p1"]
    # cleaning keeps what waits for its swap
    assert manifest.clean(spark, root) == 0
    assert maintain.purge_archive(spark, root, registry, "p1") == ["source=usgs/variable=discharge/year=2020"]
    assert values(spark, root) == [x for x in before if x[2] != -999.0] and manifest.pending(spark, root) == []
    assert not manifest.swap(spark, root, "p1")
    assert {f: t for f, t in stamps(root).items() if f in files} == files


def test_a_version_left_unfinished_is_not_read(frame, spark, tmp_path):
    root = str(tmp_path / "obs")
    loads(frame, root)
    before = values(spark, root)
    manifest.stage(archive.read_observations(spark, root), root, "half", maintain.PARTITIONS, ["source=usgs/variable=discharge/year=2020"])
    os.remove(f"{root}/version=half/_SUCCESS")
    assert not manifest.swap(spark, root, "half") and values(spark, root) == before
    assert manifest.clean(spark, root) == 1 and not os.path.exists(f"{root}/version=half")


def test_relabelled_rows_join_a_partition_that_is_not_rewritten(frame, spark, registry, tmp_path):
    root = str(tmp_path / "obs")
    loads(frame, root)
    rules = frame([(1, "nrcs:a b", None, "", "discharge"), (2, "*", None, "", "swe")], "rule_no int, site_uid string, source_param string, qualifier string, variable string").where("rule_no = 1")
    rules = rules.withColumn("source_param", F.lit("p"))
    d = archive.read_observations(spark, root).withColumn("source_param", F.lit("p"))
    manifest.write(d.where("source = 'nrcs'").withColumn("variable", F.lit("stage")), root, "load3", maintain.PARTITIONS)
    manifest.write(d.where("source = 'nrcs'").withColumn("variable", F.lit("discharge")).withColumn("source_param", F.lit("q")), root, "load4", maintain.PARTITIONS)
    assert maintain.relabel_archive(spark, root, rules, registry, "m1") == ["source=nrcs/variable=stage/year=2020"]
    got = archive.read_observations(spark, root).where("source = 'nrcs'").groupBy("variable").count().collect()
    # the row without a parameter stays, the one with it moves beside the row that was there
    assert {r.variable: r["count"] for r in got} == {"stage": 1, "discharge": 2}
    assert manifest.live(spark, root).where("partition = 'source=nrcs/variable=discharge/year=2020'").count() == 2


def test_readers_of_an_archive_read_only_what_is_in_force(frame, spark, tmp_path):
    root = str(tmp_path / "obs")
    loads(frame, root)
    maintain.compact_archive(spark, root, "c1")
    names = {os.path.basename(os.path.dirname(f)) + ("!" if "version=c1" in f else "") for f in archive.read_observations(spark, root).inputFiles()}
    assert names == {"year=2020!", "year=2021", "year=2020"}
    plan = archive.read_observations(spark, root).where("year = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and archive.read_observations(spark, root).where("year = 2021").count() == 1


def test_only_years_whose_files_changed_are_remade(frame, spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    kinds = frame([], "k string, total double, year int").schema
    sums = lambda d: d.groupBy("k", "year").agg(F.sum("v").alias("total"))
    write = lambda rows: frame(rows, "k string, v double, year int").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(source)
    run = lambda method="m1": grids.recompute_years(spark, source, root, kinds, method, sums)
    totals = lambda: {(r.k, r.year): r.total for r in manifest.read(spark, root, kinds).collect()}
    write([("a", 1.0, 2020), ("a", 2.0, 2021), ("b", 3.0, 2022)])
    assert run() == [2020, 2021, 2022] and run() == []
    before = stamps(root)
    write([("a", 5.0, 2021), ("c", 6.0, 2023)])
    assert run() == [2021, 2023] and totals() == {("a", 2020): 1.0, ("a", 2021): 5.0, ("b", 2022): 3.0, ("c", 2023): 6.0}
    assert {f: t for f, t in stamps(root).items() if f in before} == before
    assert sum("year=2020" in f for f in stamps(root)) == 1
    # a year whose files are gone leaves the result
    shutil.rmtree(f"{source}/year=2022")
    assert run() == [2022] and ("b", 2022) not in totals()
    assert run("m2") == [2020, 2021, 2023] and len(totals()) == 3 and run("m2") == []


def test_compaction_deals_rows_to_parts_that_follow_the_bytes(frame, spark, tmp_path, monkeypatch):
    """One shuffle of the rows, by key, to more parts than the session's where there are more bytes."""
    root, seen, whole = str(tmp_path / "obs"), [], maintain.compact
    loads(frame, root)
    rows = {tuple(x) for x in maintain.compact(archive.read_observations(spark, root)).collect()}
    monkeypatch.setattr(maintain, "BYTES_PER_PART", 100)
    monkeypatch.setattr(maintain, "compact", lambda d: seen.append(whole(d)) or seen[-1])
    maintain.compact_archive(spark, root, "c1")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and seen[0].rdd.getNumPartitions() > 8
    assert {tuple(x) for x in archive.read_observations(spark, root).collect()} == rows
