from pyspark.sql import functions as F

from tidemark.sources import reshape as r


def test_temperature_takes_the_report_nearest_the_hour(frame):
    d = frame([("a", "temperature", "2025-01-01 00:52:00", 5.0), ("a", "temperature", "2025-01-01 01:15:00", 9.0), ("a", "temperature", "2025-01-01 01:52:00", 6.0)], "site_uid string, source_param string, ts timestamp, value double")
    out = [(x.datetime_utc.hour, x.value) for x in r.nearest_hour(d).orderBy("datetime_utc").collect()]
    assert out == [(1, 5.0), (2, 6.0)]


def test_precipitation_takes_the_last_running_total_of_the_period(frame):
    rows = [("14:52", 0.0, "FM15"), ("15:09", 2.0, "FM16"), ("15:28", 5.0, "FM16"), ("15:52", 7.0, "FM15"), ("16:04", 1.0, "FM16"), ("16:52", 1.0, "FM15")]
    d = frame([("a", f"2025-01-09 {t}:00", v, k) for t, v, k in rows], "site_uid string, ts timestamp, value double, report_type string")
    out = [(x.datetime_utc.hour, x.value) for x in r.hourly_totals(d).orderBy("datetime_utc").collect()]
    assert out == [(15, 0.0), (16, 7.0), (17, 1.0)]


def test_quality_codes(frame):
    d = frame([("temperature", c) for c in ("1", "3", "s", None, "f")] + [("precipitation", c) for c in ("A", "Q", "1")] + [("relative_humidity", "f")], "v string, c string")
    out = [x[0] for x in d.select(r.quality_rejects(F.col("v"), F.col("c"))).collect()]
    assert out == [False, True, True, False, True, True, False, False, True]


def test_trace_is_zero_with_a_flag_and_variable_wind_is_dropped(frame):
    d = frame([("precipitation", 0.0, "5", "T"), ("wind_direction", 999.0, None, None), ("wind_direction", 270.0, None, None)], "source_param string, value double, quality_code string, measure_code string")
    assert [(x.value, x.qualifier) for x in r.screen_reports(d).collect()] == [(0.0, "5,T"), (270.0, None)]


HEAD = "# note\nagency_cd\tsite_no\tdatetime\t1_00060_00003\t1_00060_00003_cd\n5s\t15s\t20d\t14n\t10s\nUSGS\t0831\t2020-01-01\t5.0\tA\nUSGS\t0831\t2020-01-02\t6.0\tA:e\n"
SECOND = ("# next block\nagency_cd\tsite_no\tdatetime\t9_72019_00002\t9_72019_00002_cd\t9_72019_00001\t9_72019_00001_cd\n5s\t15s\t20d\t14n\t10s\t14n\t10s\n"
          "USGS\t3148\t2009-08-26\t4.80\tA\t4.90\tA\nUSGS\t3148\t2009-08-27\t\t\t4.95\tA\n")


def test_headers_reach_lines_many_splits_on(spark, tmp_path):
    """A block over many splits, blocks inside one, a file that ends in a header, rows as the plain reader in order gives them."""
    files = {}
    for name, sizes in (("a", [3000, 1, 0, 40]), ("b", [5, 900, 0])):
        text = "# stray comment\nUSGS\tbefore any header\n"
        for k, n in enumerate(sizes):
            extra = "\tx" if k % 2 else ""
            text += f"# site {k}\n#\nagency_cd\tsite_no\tdatetime\tv{k}{extra}\n5s\t15s\t20d\t14n{extra and chr(9) + '3s'}\n"
            text += "".join(f"USGS\t{k:08d}\t2020-01-{1 + i % 28:02d}\t{i}{extra and chr(9) + 'q'}\n" for i in range(n)) + "USGS\tshort\n\n"
        files[name] = text
        (tmp_path / f"{name}.rdb").write_text(text)
    want = []
    for text in files.values():
        head = None
        for line in text.split("\n"):
            part = line.split("\t")
            if part[0] == "agency_cd":
                head = part
            elif head and part[0] == "USGS" and len(part) == len(head):
                want.append(tuple(sorted(zip(head, part, strict=True))))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")
    try:
        lines = r.read_header_lines(spark, str(tmp_path))
        splits = lines.select("file", "start").distinct().count()
        got = r.parse_header_lines(lines).collect()
    finally:
        spark.conf.set(key, before)
    assert splits > 20 and sorted(tuple(sorted(x.fields.items())) for x in got) == sorted(want) and len(want) == 3946


def test_header_blocks_of_different_width(spark, tmp_path):
    (tmp_path / "a.rdb").write_text(HEAD + SECOND)
    rows = r.parse_header_blocks(r.read_header_blocks(spark, str(tmp_path)))
    assert rows.count() == 4
    out = {(x.site_uid, str(x.datetime_utc.date()), x.source_param, x.statistic, x.value, x.qualifier) for x in r.header_block_values(rows).collect()}
    assert out == {("usgs:0831", "2020-01-01", "00060", "mean", 5.0, "A"), ("usgs:0831", "2020-01-02", "00060", "mean", 6.0, "A:e"), ("usgs:3148", "2009-08-26", "72019", "min", 4.8, "A"),
                   ("usgs:3148", "2009-08-26", "72019", "max", 4.9, "A"), ("usgs:3148", "2009-08-27", "72019", "max", 4.95, "A")}


def test_wall_time_skipped_and_repeated_hours_give_null(frame):
    d = frame([("2024-03-10 02:30:00",), ("2024-11-03 01:30:00",), ("2024-07-01 12:00:00",), ("2024-01-01 12:00:00",)], "wall timestamp")
    out = [(None if x.datetime_utc is None else x.datetime_utc.hour, x.utc_offset_min) for x in r.wall_time_to_utc(d, "wall").collect()]
    assert out == [(None, None), (None, None), (18, -360), (19, -420)]


def test_flood_thresholds_drop_undefined_levels(frame):
    full = '{"flood": {"stageUnits": "ft", "flowUnits": "cfs", "categories": {"major": {"stage": 12, "flow": 35000}, "moderate": {"stage": 10, "flow": 21500}, "minor": {"stage": 8.5, "flow": 14400}, "action": {"stage": 7, "flow": 8535}}}}'
    part = '{"flood": {"stageUnits": "ft", "flowUnits": "kcfs", "categories": {"minor": {"stage": 6, "flow": -999}, "major": {"stage": -999, "flow": -999}}}}'
    none = '{"flood": {"categories": {"minor": {"stage": -999, "flow": -999}}}}'
    out = {x.site_uid: x for x in r.flood_thresholds(frame([("a", full), ("b", part), ("c", none), ("d", "{}")], "site_uid string, value string")).collect()}
    assert set(out) == {"a", "b"}
    assert (out["a"].action_stage, out["a"].minor_stage, out["a"].major_flow) == (7, 8.5, 35000)
    assert out["b"].minor_stage == 6 and out["b"].minor_flow is None and out["b"].major_stage is None


def test_active_stations(frame):
    s = frame([("A", 2026), ("B", 2026), ("C", 2019)], "native_id string, stored_year int")
    live = frame([("A", 2027), ("B", 2026), ("C", 2019)], "native_id string, last_year int")
    assert [x.native_id for x in r.active_stations(s, 2027, live).collect()] == ["A"]
    assert sorted(x.native_id for x in r.active_stations(s, 2027, None).collect()) == ["A", "B"]
    odd = frame([("A", 2027), ("B", None), ("C", 2010)], "native_id string, stored_year int")
    assert sorted(x.native_id for x in r.active_stations(odd, 2027, frame([("Z", 2027)], "native_id string, last_year int")).collect()) == ["A", "B"]


def test_forecast_versions(frame):
    old = frame([("s", "e", "a", "b", "i1", "p1", 1.0), ("s", "e", "a", "b", "i2", "p1", 2.0)], "station string, element string, period_start string, period_end string, issue_date string, publication_date string, p50 double")
    new = frame([("s", "e", "a", "b", "i2", "p1", 9.0)], "station string, element string, period_start string, period_end string, issue_date string, publication_date string, p50 double")
    assert sorted((x.issue_date, x.p50) for x in r.merge_versions(old, new).collect()) == [("i1", 1.0), ("i2", 9.0)]


def test_results_text(frame):
    d = r.parse_results(frame([("< MRL 0.0001 MG/L",), ("1.8 mg/L",), ("12",), ("not run",)], "result string"))
    assert [(x.value, x.unit, x.detection_flag) for x in d.collect()] == [(0.0001, "MG/L", "<"), (1.8, "mg/L", None), (12.0, None, None), (None, None, None)]
    assert r.detects(d).count() == 2


def test_reprocess_reads_each_kind(spark, tmp_path):
    for kind, text in (("daily", "0831 1"), ("gw", "0832 2")):
        (tmp_path / f"kind={kind}").mkdir()
        (tmp_path / f"kind={kind}" / "x.txt").write_text(text)
    parse = lambda d: d.select(F.split("value", " ")[0].alias("site"), F.split("value", " ")[1].cast("double").alias("value"))
    out = r.reprocess(spark, str(tmp_path), {"daily": parse, "gw": parse})
    assert sorted((x.kind, x.site, x.value) for x in out.collect()) == [("daily", "0831", 1.0), ("gw", "0832", 2.0)]


def test_lines_of_one_split_are_dealt_to_many_parts(spark, tmp_path, monkeypatch):
    """Headers far above, inside and at the edge of blocks of a single split; no part holds most of its lines."""
    monkeypatch.setattr(r, "LINES_PER_BLOCK", 64)
    text = "".join(f"agency_cd\tsite_no\tv{k}\n5s\t15s\t14n\n" + "".join(f"USGS\t{k}\t{i}\n" for i in range(n)) for k, n in enumerate((300, 0, 62, 1, 2000)))
    (tmp_path / "a.rdb").write_text("USGS\tbefore\t1\n" + text)
    lines = r.read_header_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() == 1
    got = r.parse_header_lines(lines)
    assert sorted((int(k[1:]), int(x.fields["site_no"]), int(x.fields[k])) for x in got.collect() for k in x.fields if k[0] == "v") == [(k, k, i) for k, n in enumerate((300, 0, 62, 1, 2000)) for i in range(n)]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        parts = [x["count"] for x in got.select("*").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(key, before)
    assert sum(parts) == 2363 and max(parts) < 1000
