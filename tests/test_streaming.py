import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import status
from tidemark.operators.maintain import compact
from tidemark.plans import streaming_queries
from tidemark.plans.tables import Tables
from tidemark.streaming import jobs

SCHEMA = T.StructType([T.StructField("site_uid", T.StringType()), T.StructField("variable", T.StringType()), T.StructField("datetime_utc", T.TimestampType()), T.StructField("value", T.DoubleType())])
T0 = dt.datetime(2026, 5, 1)


def land(spark, folder, batches):
    """One file per batch, in order."""
    import time

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/b{i}")
        time.sleep(1.1)
    return jobs.read_files(spark, f"{folder}/*", SCHEMA, files_per_batch=1)


def thresholds(frame):
    from tests.test_snow_flood import TH

    return frame([("g", "ft", "cfs", 7.0, 8.5, 10.0, 12.0, None, None, None, None), ("h", "ft", "cfs", 7.0, 8.5, None, None, 100.0, 200.0, 300.0, 400.0)], TH)


def test_flood_status_replayed_in_batches_equals_batch(spark, frame, tmp_path):
    hours = [6, 8, 10.2, 12.5, 14.07, 13, 6, 9, 9.5]
    rows = [("g", "stage", T0 + dt.timedelta(hours=i), float(s)) for i, s in enumerate(hours)] + [("h", k, T0 + dt.timedelta(hours=i), v) for i in range(6) for k, v in (("stage", 5.0 + i), ("discharge", 60.0 * i))]
    late = [r for r in rows if r[2].hour == 3]
    first, rest = [r for r in rows if r[2].hour < 5 and r not in late], [r for r in rows if r[2].hour >= 5]
    th = thresholds(frame)
    stream = land(spark, str(tmp_path / "in"), [first, rest, late])
    with jobs.typed_state(spark):
        q = jobs.to_batches(jobs.flood_status(stream, th), str(tmp_path / "out"), str(tmp_path / "state"), "update")
        q.awaitTermination()
    got = {r.site_uid: r for r in jobs.latest_status(spark.read.parquet(str(tmp_path / "out"))).collect()}
    wide = spark.createDataFrame(rows, SCHEMA).groupBy("site_uid", F.col("datetime_utc").alias("time")).agg(F.max(F.when(F.col("variable") == "stage", F.col("value"))).alias("stage"), F.max(F.when(F.col("variable") == "discharge", F.col("value"))).alias("flow"))
    want = {r.site_uid: r for r in status.assess(wide, th).collect()}
    for k in ("g", "h"):
        assert (got[k].reached, got[k].current, got[k].peak_time, got[k].last_time) == (want[k].reached, want[k].current, want[k].peak_time, want[k].last_time)
    assert want["g"].reached == "major" and want["g"].current == "minor"


def test_ingest_keeps_late_rows_and_revisions(spark, tmp_path):
    t = Tables(spark, "")
    schema = "source string, site_uid string, source_param string, datetime_utc timestamp, value double, qualifier string, statistic string, interval string, depth_cm double, ingest_run_id string"
    row = lambda d, v, run: ("usgs", "usgs:1", "P1", dt.datetime(2024, 1, d), v, "A", None, None, None, run)
    old = ("usgs", "usgs:1", "P1", dt.datetime(1990, 1, 1), 9.0, "A", None, None, None, "r3")
    for i, rows in enumerate([[row(1, 5.0, "r1"), row(2, -9999.0, "r1"), row(3, 7.0, "r1")], [row(1, 5.0, "r1"), row(1, 6.0, "r2"), old]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/b{i}"))
    stream = jobs.read_files(spark, str(tmp_path / "in/*"), spark.createDataFrame([], schema).schema, files_per_batch=1)
    now = F.lit("2024-06-01").cast("timestamp")
    jobs.ingest_to(stream, t.crosswalk, t.registry, now, str(tmp_path / "out"), str(tmp_path / "report"), str(tmp_path / "state")).awaitTermination()
    out = compact(spark.read.parquet(str(tmp_path / "out")).drop("batch"))
    assert sorted((r.datetime_utc.year, r.datetime_utc.day, r.value) for r in out.collect()) == [(1990, 1, 9.0), (2024, 1, 6.0), (2024, 3, 7.0)]
    counts = spark.read.parquet(str(tmp_path / "report")).orderBy("batch").collect()
    assert [(r.delivered, r.stored, r.dropped) for r in counts] == [(3, 2, 1), (3, 3, 0)]


def test_changes_ignore_drift_inside_a_step(frame):
    steps = {"category": None, "depth": 2.0}
    a = jobs.visible_state(frame([("x", "minor", 10.1), ("y", "major", 4.0), ("z", None, 1.0)], "key string, category string, depth double"), "key", steps)
    b = jobs.visible_state(frame([("x", "minor", 11.9), ("y", "moderate", 4.0), ("w", None, 9.0)], "key string, category string, depth double"), "key", steps)
    assert {(r.key, r.kind) for r in jobs.changes(a, b).collect()} == {("y", "changes"), ("z", "clears"), ("w", "appears")}


def test_publishing_is_limited_and_stale_pages_renew(frame):
    now = F.lit("2026-05-01 12:00:00").cast("timestamp")
    some, none = frame([("a",)], "key string"), frame([("a",)], "key string").limit(0)
    log = lambda *t: frame([(x,) for x in t], "published_at timestamp")
    ask = lambda ch, cur, lg: jobs.publish_choice(ch, cur, lg, now).first().why
    assert ask(some, some, log("2026-05-01 11:00:00")) == "changed"
    assert ask(none, some, log("2026-05-01 11:00:00")) == "unchanged"
    assert ask(none, some, log("2026-05-01 05:00:00")) == "stale" and ask(none, none, log("2026-04-01 05:00:00")) == "unchanged"
    assert ask(some, some, log(*[f"2026-05-01 0{i}:00:00" for i in range(6)])) == "limit"


def test_publications_survive_a_batch_that_runs_again(spark, tmp_path):
    """A limit of two a day, an age of six hours, and the same log when the last batches are run again from their checkpoint."""
    at = lambda h: T0 + dt.timedelta(hours=h)
    schema = "key string, datetime_utc timestamp, value double"
    steps = [[("g", at(0), 1.0)], [("g", at(1), 1.4)], [("g", at(2), 2.5)], [("g", at(3), 9.0)], [("h", at(24), 1.0)], [("g", at(29), 9.5)], [("g", at(31), 9.6)], [("g", at(32), 9.7), ("g", at(32), 9.1)]]
    for i, rows in enumerate(steps):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/b{i}"))
    read = lambda: jobs.read_files(spark, str(tmp_path / "in/*"), spark.createDataFrame([], schema).schema, files_per_batch=1)
    run = lambda: jobs.publish_stream(read(), {"value": 1.0}, str(tmp_path / "store"), str(tmp_path / "state"), limit=2).awaitTermination()
    log = lambda: [(r.why, r.in_period, r.shown) for r in spark.read.parquet(str(tmp_path / "store/log")).orderBy("batch").collect()]
    run()
    want = [("changed", 0, 0), ("unchanged", 1, 0), ("changed", 1, 2), ("limit", 2, 2), ("changed", 0, 4), ("unchanged", 1, 4), ("stale", 1, 6), ("limit", 2, 6)]
    assert log() == want
    # the commits of the last three batches are lost: they run again
    for folder, lost in (("commits", (5, 6, 7)), ("offsets", (6, 7))):
        for i in lost:
            for name in (f"{i}", f".{i}.crc"):
                (tmp_path / "state" / folder / name).unlink()
    run()
    assert log() == want


def test_a_silent_gauge_is_forgotten(spark, frame, tmp_path):
    """A timer fires when the watermark passes the end of a gauge's window; readings of one instant meet in any order and batch."""
    at = lambda h: T0 + dt.timedelta(hours=h)
    batches = [[("g", "stage", at(0), 9.0), ("g", "stage", at(1), 9.0), ("h", "stage", at(0), 5.0)], [("h", "discharge", at(0), 310.0), ("h", "discharge", at(1), 320.0), ("h", "stage", at(1), 8.0)],
               [("h", "stage", at(90), 1.0)], [("h", "stage", at(91), 1.0)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/b{i}"))
    with jobs.typed_state(spark), jobs.state_partitions(spark, 2):
        stream = jobs.flood_status(jobs.read_files(spark, str(tmp_path / "in/*"), SCHEMA, files_per_batch=1), thresholds(frame))
        jobs.to_batches(stream, str(tmp_path / "out"), str(tmp_path / "state"), "update").awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    by_batch = {(r.site_uid, r.batch): r.top for r in out.collect()}
    # moderate by flow once stage and flow of an hour are together; the old flood is out of h's window at the end, g fell silent
    assert by_batch["g", 0] == 2 and by_batch["h", 1] == 3
    assert [(r.site_uid, r.reached) for r in jobs.latest_status(out).collect()] == [("h", None)]
    assert any(k == "g" and top is None for (k, _), top in by_batch.items())


def test_snapshots_are_compared_batch_by_batch(spark, frame, tmp_path):
    status_rows = lambda v: frame([("g", v)], "key string, category string")
    kinds = [[r.kind for r in jobs.track_changes(spark, status_rows(v), "key", {"category": None}, str(tmp_path), i).collect()] for i, v in enumerate(["minor", "minor", "major"])]
    assert kinds == [["appears"], [], ["changes"]]
    assert [r.kind for r in jobs.track_changes(spark, status_rows("major"), "key", {"category": None}, str(tmp_path), 2).collect()] == ["changes"]


def test_replay_of_slices_with_unequal_numbers_of_files(spark, tmp_path):
    """No row is older than the watermark when a slice comes in many files, the newest rows first."""
    hours = spark.range(720).select((F.timestamp_seconds(F.lit(1_704_067_200) - F.col("id") * 3600)).alias("ts"))
    for i, (lo, hi) in enumerate([(540, 560), (560, 600), (600, 640), (640, 680), (680, 700), (700, 720), (0, 540)]):
        hours.where(f"ts >= TIMESTAMP_SECONDS({1_704_067_200 - (hi - 1) * 3600}) AND ts <= TIMESTAMP_SECONDS({1_704_067_200 - lo * 3600})").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    t = Tables(spark, str(tmp_path))
    days = lambda d: d.groupBy(F.window("ts", "1 day").alias("w")).count().select(F.col("w.start").alias("start"), "count")
    out = streaming_queries.replay(t, lambda s: days(s.read("events").withWatermark("ts", "2 days")), "update")
    got = {r.start: r["count"] for r in jobs.newest(out, ["start"]).collect()}
    assert got == {r.start: r["count"] for r in days(t.read("events")).collect()} and sum(got.values()) == 720
    assert out.select("batch").distinct().count() >= 4
