"""Streaming queries: the events and lineitem files replayed as streams, checked against batch SQL."""

import uuid

from pyspark.sql import functions as F

from tidemark.operators.maintain import compact
from tidemark.plans.registry import query
from tidemark.plans.status_queries import ASSESS, CAT, THR, thresholds
from tidemark.plans.tables import Tables
from tidemark.session import ensure_checkpoint_dir
from tidemark.streaming import jobs as k


def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


ORDER = {"events": "ts", "lineitem": "l_shipdate"}


class StreamTables(Tables):
    """The same adapters over file streams, some files to a micro-batch."""

    def __init__(self, spark, sf_dir, landed, arrivals=4):
        super().__init__(spark, sf_dir)
        self.landed, self.arrivals = landed, arrivals

    def read(self, name):
        if name not in ORDER:
            return super().read(name)
        schema = self.spark.read.parquet(f"{self.dir}/{name}.parquet").schema
        files = len(self.spark.read.schema(schema).parquet(f"{self.landed}/{name}/*").inputFiles())
        return k.read_files(self.spark, f"{self.landed}/{name}/*", schema, files_per_batch=max(1, files // self.arrivals))


#: Files of an arrival where one arrival has to be one micro-batch of a single run.
FILES = 4


def arrivals(t, name, folder, order=None, marker_days=0, parts=4, files=None):
    """The whole table as files that arrive in slices of its time, in the given order, one slice a step; a
    slice may come twice. ``files`` fixes the number of files of a slice. ``marker_days`` adds one row that much later, by which a
    watermark passes all others."""
    src, c = t.read(name), ORDER[name]
    order = order or tuple(range(parts))
    at = F.unix_timestamp(F.col(c).cast("timestamp"))
    lo, hi = src.agg(F.min(at), F.max(at)).first()
    if lo is None:
        lo = hi = 0
    part = F.coalesce(F.least(F.floor((at - lo) * parts / (hi - lo + 1)), F.lit(parts - 1)), F.lit(0))
    for i, p in enumerate(order):
        rows = src.where(part == p)
        (rows.repartition(files) if files else rows).write.parquet(f"{folder}/{name}/arrival={i:02d}")
        yield i
    if marker_days:
        late = src.orderBy(c).limit(1).withColumn(c, (F.timestamp_seconds(F.lit(hi + marker_days * 86400))).cast(src.schema[c].dataType))
        late.write.parquet(f"{folder}/{name}/arrival={len(order):02d}")
        yield len(order)


def land(t, name, folder, order=(0, 1, 2, 3)):
    """All arrivals at once, for streams without a watermark."""
    for _ in arrivals(t, name, folder, order):
        pass


def replay(t, build, mode="append", table="events", marker_days=0):
    """Run a stream to its end after each arrival, from the same checkpoint, and return what its sink holds.

    One arrival is one micro-batch, whatever its number of files, so the watermark never moves on inside a slice."""
    spark = t.spark
    base = f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    for _ in arrivals(t, table, f"{base}/in", marker_days=marker_days):
        stream = build(StreamTables(spark, t.dir, f"{base}/in", 1))
        with k.state_partitions(spark):
            k.to_batches(stream, f"{base}/out", f"{base}/state", mode).awaitTermination()
    return spark.read.parquet(f"{base}/out")


def minutes(s):
    return s.subdaily.withColumn("datetime_utc", F.date_trunc("minute", "datetime_utc"))


@query("K1_flood_status", f"""WITH {THR.format(days=4000)
    .replace("rk AS (SELECT r.*,", "nw AS (SELECT site_uid, max(time) AS top_time FROM rdg GROUP BY 1), rk AS (SELECT r.*,")
    .replace("FROM rdg r JOIN lev USING (site_uid))", "FROM rdg r JOIN lev USING (site_uid) JOIN nw USING (site_uid) WHERE time > top_time - INTERVAL 3 DAY AND top_time + INTERVAL 3 DAY > (SELECT max(time) FROM rdg) - INTERVAL 6 HOUR)")},
 {ASSESS} SELECT site_uid, {CAT.format(c='top')} AS reached, {CAT.format(c='cur')} AS current, strftime(pt, '%Y-%m-%d %H:%M:%S') AS peak_time, ps AS peak_stage, pf AS peak_flow, strftime(lt, '%Y-%m-%d %H:%M:%S') AS last_time, ls AS last_stage FROM asd""")
def k1(t):
    # every reading streams by; the state of a gauge holds the three days up to its newest
    th = thresholds(t)
    with k.typed_state(t.spark):
        return k.latest_status(replay(t, lambda s: k.flood_status(minutes(s), th), "update"))


@query("K2_latest_readings", """SELECT site_uid, variable, max_by(value, datetime_utc) AS value, strftime(max(datetime_utc), '%Y-%m-%d %H:%M:%S') AS at FROM subdaily GROUP BY 1, 2 HAVING max(datetime_utc) >= TIMESTAMP '2024-01-31' - INTERVAL 36 HOUR""")
def k2(t):
    return k.fresh_readings(replay(t, lambda s: k.latest_readings(s.subdaily), "update"), now())


@query("K3_changes", """WITH a AS (SELECT site_uid || '/' || variable AS "key", floor(max_by(value, datetime_utc) / 25) AS s FROM subdaily WHERE datetime_utc < TIMESTAMP '2024-01-20' GROUP BY 1), b AS (SELECT site_uid || '/' || variable AS "key", floor(max_by(value, datetime_utc) / 25) AS s FROM subdaily WHERE NOT (site_uid = 'nwps:3' AND variable = 'stage') GROUP BY 1)
SELECT "key", 'value=' || CAST(a.s AS BIGINT) AS was, 'value=' || CAST(b.s AS BIGINT) AS now, CASE WHEN a."key" IS NULL THEN 'appears' WHEN b."key" IS NULL THEN 'clears' ELSE 'changes' END AS kind FROM a FULL OUTER JOIN b USING ("key") WHERE a.s IS DISTINCT FROM b.s""")
def k3(t):
    def prints(d):
        g = d.groupBy("site_uid", "variable").agg(F.max_by("value", "datetime_utc").alias("value")).withColumn("key", F.concat_ws("/", "site_uid", "variable"))
        return k.visible_state(g, "key", {"value": 25.0})

    before = prints(t.subdaily.where("datetime_utc < TIMESTAMP '2024-01-20'"))
    return k.changes(before, prints(t.subdaily.where("NOT (site_uid = 'nwps:3' AND variable = 'stage')")))


@query("K3_track_changes", """SELECT site_uid || '/' || variable AS "key", 'value=' || CAST(floor(max_by(value, datetime_utc) / 25) AS BIGINT) AS now FROM subdaily GROUP BY 1""")
def k3t(t):
    # the last change of each key leads to what its newest reading shows
    base = f"{ensure_checkpoint_dir(t.spark)}/streams/{uuid.uuid4().hex}"
    land(t, "events", f"{base}/in")
    stream = StreamTables(t.spark, t.dir, f"{base}/in").subdaily.select(F.concat_ws("/", "site_uid", "variable").alias("key"), "datetime_utc", "value")
    k.track_stream(stream, {"value": 25.0}, f"{base}/store", f"{base}/state").awaitTermination()
    return k.newest(t.spark.read.parquet(f"{base}/store/changes"), ["key"]).select("key", "now")


SLICES = 12


@query("K3_publications", f"""WITH RECURSIVE s AS (SELECT variable AS "key", datetime_utc AS tm, value, least({SLICES - 1}, (floor(epoch(datetime_utc))::BIGINT - lo) * {SLICES} // (hi - lo + 1)) AS b
  FROM subdaily, (SELECT min(floor(epoch(datetime_utc))::BIGINT) AS lo, max(floor(epoch(datetime_utc))::BIGINT) AS hi FROM subdaily)),
 bs AS (SELECT i AS b FROM range(0, {SLICES}) r(i)), l AS (SELECT bs.b, "key", max(tm) AS tm, max_by(value, (tm, value)) AS v FROM bs JOIN s ON s.b <= bs.b GROUP BY 1, 2),
 f AS (SELECT b, max(tm) AS now, string_agg("key" || '=' || CAST(floor(v / 60) AS BIGINT), ',' ORDER BY "key") AS view FROM l GROUP BY 1),
 p AS (SELECT b, now, view AS shown, now AS last, 1 AS n, 'changed' AS why, CAST(0 AS BIGINT) AS in_period FROM f WHERE b = 0
  UNION ALL SELECT b, now, CASE WHEN w IN ('changed', 'stale') THEN view ELSE shown END, CASE WHEN w IN ('changed', 'stale') THEN now ELSE last END, c + CASE WHEN w IN ('changed', 'stale') THEN 1 ELSE 0 END, w, CAST(c AS BIGINT)
  FROM (SELECT *, CASE WHEN c >= 2 THEN 'limit' WHEN view <> shown THEN 'changed' WHEN floor(epoch(now)) - floor(epoch(last)) > 50 * 3600 THEN 'stale' ELSE 'unchanged' END AS w
    FROM (SELECT f.b, f.now, f.view, p.shown, p.last, CASE WHEN date_trunc('week', f.now) = date_trunc('week', p.now) THEN p.n ELSE 0 END AS c FROM p JOIN f ON f.b = p.b + 1)))
SELECT CAST(b AS BIGINT) AS batch, strftime(now, '%Y-%m-%d %H:%M:%S') AS at, why IN ('changed', 'stale') AS publish, why, in_period FROM p""")
def k3p(t):
    # twelve arrivals over a month, two publications a week at most
    base = f"{ensure_checkpoint_dir(t.spark)}/streams/{uuid.uuid4().hex}"
    for _ in arrivals(t, "events", f"{base}/in", parts=SLICES, files=FILES):
        pass
    one = StreamTables(t.spark, t.dir, f"{base}/in", SLICES)
    stream = one.subdaily.select(F.col("variable").alias("key"), "datetime_utc", "value")
    k.publish_stream(stream, {"value": 60.0}, f"{base}/store", f"{base}/state", 2, "week", 50.0).awaitTermination()
    return t.spark.read.parquet(f"{base}/store/log").select("batch", "at", "publish", "why", "in_period")


@query("K4_stream_ingest", """
WITH m AS (SELECT r.source, x.variable, r.site_uid, r.datetime_utc, r.value * x.factor + x."offset" AS value, coalesce(r.statistic, x.statistic) AS statistic, coalesce(r.interval, x.interval) AS interval, coalesce(r.depth_cm, x.depth_cm) AS depth_cm, r.ingest_run_id
  FROM raw_obs r JOIN crosswalk x ON x.source = r.source AND x.source_param = r.source_param LEFT JOIN registry g ON g.variable = x.variable WHERE x.variable <> '' AND r.value IS NOT NULL
  AND (g.signed OR len(list_filter(list_concat([-9999.0, -99999.0], g.missing_codes), lambda c : abs(r.value * x.factor + x."offset" - c) < 1e-6)) = 0)),
 d AS (SELECT *, row_number() OVER (PARTITION BY site_uid, variable, datetime_utc, interval, statistic, depth_cm ORDER BY ingest_run_id DESC) AS rn FROM m)
SELECT source, variable, count(*) AS n FROM d WHERE rn = 1 GROUP BY 1, 2""")
def k4(t):
    # years arrive out of order, the oldest as a late backfill, and one slice twice
    base = f"{ensure_checkpoint_dir(t.spark)}/streams/{uuid.uuid4().hex}"
    land(t, "lineitem", f"{base}/in", (3, 1, 2, 1, 0))
    stream = StreamTables(t.spark, t.dir, f"{base}/in").raw_obs.drop("source_unit")
    k.ingest_to(stream, t.crosswalk, t.registry, F.lit("2002-01-01").cast("timestamp"), f"{base}/out", f"{base}/report", f"{base}/state").awaitTermination()
    stored = t.spark.read.parquet(f"{base}/out").drop("batch")
    return compact(stored).groupBy("source", "variable").agg(F.count("*").alias("n"))


@query("K5_tumbling_days", """SELECT site_uid, variable, strftime(date_trunc('day', datetime_utc), '%Y-%m-%d %H:%M:%S') AS start, strftime(date_trunc('day', datetime_utc) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS "end", round(avg(value), 6) AS value, count(*) AS n FROM subdaily GROUP BY 1, 2, date_trunc('day', datetime_utc) HAVING count(*) >= 0.2 * 24""")
def k5(t):
    out = replay(t, lambda s: k.tumbling_means(s.subdaily, min_share=0.2), "update")
    return k.newest(out, ["site_uid", "variable", "start", "end"])


@query("K5_sliding_weeks", """SELECT site_uid, variable, strftime(s, '%Y-%m-%d %H:%M:%S') AS start, strftime(s + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS "end", round(sum(value), 3) AS total, count(*) AS n FROM (SELECT *, date_trunc('day', datetime_utc) - INTERVAL 1 DAY * i AS s FROM subdaily, range(0, 7) r(i)) GROUP BY 1, 2, s""")
def k5s(t):
    out = replay(t, lambda s: k.sliding_means(s.subdaily), "update")
    # means of 32 or 64 readings end on a rounding tie, so totals are compared
    newest = k.newest(out, ["site_uid", "variable", "start", "end"])
    return newest.withColumn("total", F.round(F.col("value") * F.col("n"), 3)).drop("value")


SESS = """g AS (SELECT site_uid, datetime_utc, CASE WHEN datetime_utc < lag(datetime_utc) OVER w + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS b FROM subdaily WINDOW w AS (PARTITION BY site_uid ORDER BY datetime_utc)), h AS (SELECT *, sum(b) OVER (PARTITION BY site_uid ORDER BY datetime_utc) AS k FROM g),
 se AS (SELECT site_uid, k, min(datetime_utc) AS a, max(datetime_utc) AS z, count(*) AS n FROM h GROUP BY 1, 2)"""


@query("K5_session_gaps", f"""WITH {SESS}, x AS (SELECT site_uid, z, lead(a) OVER (PARTITION BY site_uid ORDER BY a) AS r FROM se) SELECT site_uid, strftime(z, '%Y-%m-%d %H:%M:%S') AS silent_from, strftime(r, '%Y-%m-%d %H:%M:%S') AS resumed, round((floor(epoch(r)) - floor(epoch(z))) / 3600, 6)::DOUBLE AS hours FROM x WHERE r IS NOT NULL""")
def k5g(t):
    # the marker lets the last sessions end; its own never does
    return k.session_gaps(replay(t, lambda s: k.reporting_sessions(s.subdaily), marker_days=30).drop("batch"))
