"""Structured Streaming jobs: ingest, flood status, latest readings, change detection, windows.

Sinks go through ``foreachBatch`` into a folder named by the batch id and overwritten on replay, so a
batch that is run again after a lost executor or driver leaves one copy of its output."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.quality import apply_crosswalk, drop_missing_codes, guard_dates, guard_nulls
from tidemark.operators.status import category, flood_levels, reading_rank
from tidemark.schema import OBSERVATIONS


def read_files(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """A stream over Parquet files that arrive in a folder."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(folder)


def to_batches(stream: DataFrame, out: str, checkpoint: str, mode: str = "append", shape: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Run over what is available and write each micro-batch to ``out/batch=<id>``.

    State is split once, when a query first starts, by ``spark.sql.shuffle.partitions``; see
    ``state_partitions``."""

    def write(df: DataFrame, batch_id: int) -> None:
        d = shape(df) if shape else df
        d.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None) -> Iterator[None]:
    """Start stateful queries inside with their state in ``n`` parts, the cluster's parallelism by default."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# ---- ingest -----------------------------------------------------------------


def ingest(rows: DataFrame, crosswalk: DataFrame, registry: DataFrame, now: Column) -> DataFrame:
    """Guards and mapping as in batch, for a stream or one of its batches.

    No watermark and no state: a backfill of any age, a late revision and a redelivery are all appended,
    and compaction keeps the newest run of each key."""
    d = apply_crosswalk(rows, crosswalk, registry)
    d = drop_missing_codes(guard_dates(guard_nulls(d), now), registry)
    cols = [f.name for f in OBSERVATIONS if f.name in d.columns]
    return d.select(*cols, F.split_part("site_uid", F.lit(":"), F.lit(1)).alias("source"), F.year("datetime_utc").alias("year"))


def ingest_to(stream: DataFrame, crosswalk: DataFrame, registry: DataFrame, now: Column, out: str, report: str, checkpoint: str) -> StreamingQuery:
    """Append what passes the guards to ``out`` and count delivered, stored and dropped rows of each batch in ``report``."""

    def write(df: DataFrame, batch_id: int) -> None:
        counted = df.agg(F.count("*").alias("delivered"))
        ingest(df, crosswalk, registry, now).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        stored = df.sparkSession.read.parquet(f"{out}/batch={batch_id}").agg(F.count("*").alias("stored"))
        both = counted.crossJoin(stored).withColumn("dropped", F.col("delivered") - F.col("stored"))
        both.write.mode("overwrite").parquet(f"{report}/batch={batch_id}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


# ---- flood status -----------------------------------------------------------

STATUS = "site_uid string, top int, current int, peak_time timestamp, peak_stage double, peak_flow double, last_time timestamp, last_stage double"
STATUS_NAMES = [f.split()[0] for f in STATUS.split(", ")]


@contextmanager
def typed_state(spark: SparkSession) -> Iterator[None]:
    """Start queries inside with the state store that typed state and timers need."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _largest(a: float | None, b: float | None) -> float | None:
    return b if a is None else a if b is None else max(a, b)


def _held_status(readings: dict[int, tuple]) -> tuple:
    """Highest rank held over two readings in a row, the one held now, the peak and the last reading, of {instant: (stage, flow, rank)}."""
    times = sorted(readings)
    pairs = [min(readings[a][2], readings[b][2]) for a, b in zip(times, times[1:], strict=False)]
    top = max(pairs, default=0)
    part = 0 if any(r[0] is not None for r in readings.values()) else 1
    pool = [t for t in times if readings[t][2] >= top and readings[t][part] is not None]
    peak = max(pool, key=lambda t: (readings[t][part], -t)) if pool else times[-1]
    at = lambda us: pd.Timestamp(us, unit="us")
    return top, pairs[-1] if pairs else 0, at(peak), readings[peak][0], readings[peak][1], at(times[-1]), readings[times[-1]][0]


class GaugeWindow(StatefulProcessor):
    """The readings of one gauge over the last days, by instant, and its status whenever some arrive.

    A row of the map is written when an instant is new or gains a value, and removed when it leaves the window. One event-time timer
    stands at the instant at which the newest reading leaves it: a gauge that is silent until then is forgotten, and says so by a row
    without a rank."""

    def __init__(self, days: int):
        self.keep = days * 86_400_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.readings = handle.getMapState("readings", "us bigint", "stage double, flow double, rank int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        arrived: dict[int, tuple] = {}
        for f in rows:
            us = f["time"].astype("datetime64[us]").astype("int64")
            for at, stage, flow, rank in zip(us, f["stage"], f["flow"], f["rank"], strict=True):
                old = arrived.get(at, (None, None, 0))
                arrived[at] = _largest(old[0], None if pd.isna(stage) else stage), _largest(old[1], None if pd.isna(flow) else flow), max(old[2], int(rank))
        held = {k[0]: tuple(v) for k, v in self.readings.iterator()} if self.readings.exists() else {}
        newest = max([*arrived, *held])
        for at in [t for t in held if t <= newest - self.keep]:
            self.readings.removeKey((at,))
            del held[at]
        for at, (stage, flow, rank) in arrived.items():
            if at > newest - self.keep:
                old = held.get(at)
                now = (_largest(old[0], stage), _largest(old[1], flow), max(old[2], rank)) if old else (stage, flow, rank)
                if now != old:
                    self.readings.updateValue((at,), now)
                    held[at] = now
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((newest + self.keep) // 1000)
        yield pd.DataFrame([(key[0], *_held_status(held))], columns=STATUS_NAMES)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.readings.clear()
        yield pd.DataFrame([(key[0], *[None] * 7)], columns=STATUS_NAMES)

    def close(self) -> None:
        pass


def flood_status(stream: DataFrame, thresholds: DataFrame, days: int = 3, lateness: str = "6 hours") -> DataFrame:
    """Flood status per gauge from its stage and flow readings, updated as they arrive.

    State is the gauge's readings of the last ``days`` up to its newest one, so a late reading inside the window changes the answer
    just as it would in batch. To be started inside ``typed_state``."""
    v = lambda k: F.when(F.col("variable") == k, F.col("value"))
    r = stream.where(F.col("variable").isin("stage", "discharge")).select("site_uid", F.col("datetime_utc").alias("time"), v("stage").alias("stage"), v("discharge").alias("flow"))
    r = r.withWatermark("time", lateness).join(flood_levels(thresholds), "site_uid").select("site_uid", "time", "stage", "flow", reading_rank().alias("rank"))
    return r.groupBy("site_uid").transformWithStateInPandas(GaugeWindow(days), STATUS, "Update", "EventTime")


def latest_status(out: DataFrame) -> DataFrame:
    """Newest status of each gauge over the batches written so far; gauges that fell silent are left out."""
    d = out.groupBy("site_uid").agg(F.max_by(F.struct(*[F.col(c) for c in out.columns if c != "site_uid"]), "batch").alias("s")).select("site_uid", "s.*").where("top IS NOT NULL")
    return d.select("site_uid", category(F.col("top")).alias("reached"), category(F.col("current")).alias("current"), "peak_time", "peak_stage", "peak_flow", "last_time", "last_stage")


# ---- latest readings --------------------------------------------------------


def latest_readings(stream: DataFrame, lateness: str = "36 hours") -> DataFrame:
    """Newest value per station and variable, as an updating aggregate."""
    return stream.withWatermark("datetime_utc", lateness).groupBy("site_uid", "variable").agg(F.max_by("value", "datetime_utc").alias("value"), F.max("datetime_utc").alias("at"))


def fresh_readings(out: DataFrame, now: Column, max_age_hours: int = 36) -> DataFrame:
    """Newest update per station and variable, no older than the limit."""
    g = out.groupBy("site_uid", "variable").agg(F.max_by("value", F.struct("at", "batch")).alias("value"), F.max("at").alias("at"))
    return g.where(F.col("at") >= now - F.expr(f"INTERVAL {max_age_hours} HOURS"))


# ---- change detection -------------------------------------------------------


def visible_state(df: DataFrame, key: str, steps: dict[str, float | None]) -> DataFrame:
    """What a reader can see move: values cut to steps, so drift inside a step changes nothing."""
    cells = [F.concat(F.lit(f"{c}="), F.coalesce((F.col(c) if s is None else F.floor(F.col(c) / s)).cast("string"), F.lit("-"))) for c, s in steps.items()]
    return df.select(F.col(key).alias("key"), F.concat_ws("|", *cells).alias("print"))


def changes(shown: DataFrame, current: DataFrame) -> DataFrame:
    """Keys whose fingerprint is new, different or gone."""
    a, b = shown.select("key", F.col("print").alias("was")), current.select("key", F.col("print").alias("now"))
    kind = F.when(F.col("was").isNull(), "appears").when(F.col("now").isNull(), "clears").otherwise("changes")
    return a.join(b, "key", "full_outer").where(~F.col("was").eqNullSafe(F.col("now"))).select("key", "was", "now", kind.alias("kind"))


def publish_choice(changed: DataFrame, current: DataFrame, log: DataFrame, now: Column, limit: int = 6, period: str = "day", max_age_hours: float | None = 6.0) -> DataFrame:
    """One row: whether to publish and why. ``log`` has published_at of every earlier publication, ``limit`` holds for a period.

    The limit comes first; then what changed since the last publication; then, while there is something to show, its age."""
    n = changed.agg(F.count("*")).scalar()
    on = current.agg(F.count("*")).scalar()
    inside = F.date_trunc(period, F.col("published_at")) == F.date_trunc(period, now)
    j = log.agg(F.count_if(inside).alias("in_period"), F.max("published_at").alias("last"))
    age = (F.unix_timestamp(now) - F.unix_timestamp("last")) / 3600
    stale = F.lit(False) if max_age_hours is None else F.coalesce((on > 0) & (age > max_age_hours), F.lit(False))
    why = F.when(F.col("in_period") >= limit, "limit").when(n > 0, "changed").when(stale, "stale").otherwise("unchanged")
    return j.select(why.isin("changed", "stale").alias("publish"), why.alias("why"), "in_period", n.alias("changes"))


def track_changes(spark: SparkSession, status: DataFrame, key: str, steps: dict[str, float | None], store: str, batch_id: int) -> DataFrame:
    """Compare a batch's status with the snapshot of the batch before, keep the new snapshot and the changes.

    Both are folders named by batch, so running a batch again overwrites its own output only."""
    now = visible_state(status, key, steps)
    now.write.mode("overwrite").parquet(f"{store}/snapshot/batch={batch_id}")
    cur = spark.read.parquet(f"{store}/snapshot/batch={batch_id}")
    schema = "key string, print string"
    before = spark.read.parquet(f"{store}/snapshot/batch={batch_id - 1}") if batch_id > 0 else spark.createDataFrame([], schema)
    out = changes(before, cur)
    out.write.mode("overwrite").parquet(f"{store}/changes/batch={batch_id}")
    return out


def track_stream(stream: DataFrame, steps: dict[str, float | None], store: str, checkpoint: str) -> StreamingQuery:
    """Changes of the newest values of a stream (key, datetime_utc, value), batch by batch, in ``store``/changes.

    The newest reading of each key is a folder per batch, made from the one before and the batch; so is the snapshot
    that readers see. A batch that runs again overwrites its own folders."""

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        new = df.select("key", F.col("datetime_utc").alias("at"), "value")
        if batch_id > 0:
            new = new.union(spark.read.schema(new.schema).parquet(f"{store}/latest/batch={batch_id - 1}"))
        newest_rows = new.groupBy("key").agg(F.max("at").alias("at"), F.max_by("value", "at").alias("value"))
        newest_rows.write.mode("overwrite").parquet(f"{store}/latest/batch={batch_id}")
        track_changes(spark, spark.read.parquet(f"{store}/latest/batch={batch_id}"), "key", steps, store, batch_id)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


LOG = "batch bigint, at timestamp, publish boolean, why string, in_period bigint, changes bigint, shown bigint"


def publish_stream(stream: DataFrame, steps: dict[str, float | None], store: str, checkpoint: str, limit: int = 6, period: str = "day", max_age_hours: float | None = 6.0) -> StreamingQuery:
    """Decide batch by batch whether the newest values of a stream (key, datetime_utc, value) are published; the log is ``store``/log.

    State between batches is three tables of one folder a batch: the newest reading of each key, what a reader would see of it, and
    the log, whose row says which batch's view is the published one. The time of a batch is its newest reading's. A batch reads only
    folders of earlier batches and overwrites its own, so running it again after a lost executor or driver decides the same."""

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        new = df.select("key", F.col("datetime_utc").alias("at"), "value")
        if batch_id > 0:
            new = new.union(spark.read.schema(new.schema).parquet(f"{store}/latest/batch={batch_id - 1}"))
        rows = new.groupBy("key").agg(F.max("at").alias("at"), F.max_by("value", F.struct("at", "value")).alias("value"))
        rows.write.mode("overwrite").parquet(f"{store}/latest/batch={batch_id}")
        latest = spark.read.schema(rows.schema).parquet(f"{store}/latest/batch={batch_id}")
        view = visible_state(latest, "key", steps)
        view.write.mode("overwrite").parquet(f"{store}/visible/batch={batch_id}")
        log = spark.createDataFrame([], LOG)
        if batch_id > 0:
            log = spark.read.schema(LOG).parquet(f"{store}/log").where(F.col("batch") < batch_id)
        # the published view and the time of this batch: two values
        shown = log.agg(F.max_by("shown", "batch")).first()[0]
        now = F.lit(latest.agg(F.max("at")).first()[0])
        before = view.limit(0) if shown is None else spark.read.schema(view.schema).parquet(f"{store}/visible/batch={shown}")
        current = spark.read.schema(view.schema).parquet(f"{store}/visible/batch={batch_id}")
        past = log.where("publish").select(F.col("at").alias("published_at"))
        choice = publish_choice(changes(before, current), current, past, now, limit, period, max_age_hours)
        row = choice.select(now.cast("timestamp").alias("at"), "publish", "why", "in_period", "changes", F.when(F.col("publish"), F.lit(batch_id)).otherwise(F.lit(shown)).cast("bigint").alias("shown"))
        row.write.mode("overwrite").parquet(f"{store}/log/batch={batch_id}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


# ---- windows ----------------------------------------------------------------
#
# Windows run in update mode, so state older than the watermark is let go and each batch writes only what
# it changed; ``newest`` keeps the last word on each window. Sessions run in append mode: a session is
# written once, when the watermark has passed its end.


def newest(out: DataFrame, keys: list[str]) -> DataFrame:
    """The last update of each key over the batches written so far."""
    rest = [c for c in out.columns if c not in (*keys, "batch")]
    g = out.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("s"))
    return g.select(*keys, "s.*")


def exact_mean() -> Column:
    """Mean of the readings, summed in decimals so that batches in any order give the same double."""
    return F.avg(F.col("value").cast("decimal(28,10)")).cast("double")


def tumbling_means(stream: DataFrame, every: str = "1 day", lateness: str = "2 days", min_share: float = 0.0, expected: int = 24) -> DataFrame:
    """Mean per site, variable and window with enough readings."""
    g = stream.withWatermark("datetime_utc", lateness).groupBy("site_uid", "variable", F.window("datetime_utc", every).alias("w")).agg(exact_mean().alias("value"), F.count("*").alias("n"))
    return g.where(F.col("n") >= min_share * expected).select("site_uid", "variable", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "value", "n")


def sliding_means(stream: DataFrame, span: str = "7 days", every: str = "1 day", lateness: str = "2 days") -> DataFrame:
    g = stream.withWatermark("datetime_utc", lateness).groupBy("site_uid", "variable", F.window("datetime_utc", span, every).alias("w")).agg(exact_mean().alias("value"), F.count("*").alias("n"))
    return g.select("site_uid", "variable", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "value", "n")


def reporting_sessions(stream: DataFrame, gap: str = "2 hours", lateness: str = "2 days") -> DataFrame:
    """Unbroken stretches of reporting; what lies between two of them is a gap."""
    g = stream.withWatermark("datetime_utc", lateness).groupBy("site_uid", F.session_window("datetime_utc", gap).alias("w")).agg(F.count("*").alias("n"), F.max("datetime_utc").alias("last"))
    return g.select("site_uid", F.col("w.start").alias("start"), "last", "n")


def session_gaps(sessions: DataFrame) -> DataFrame:
    """Silences between a site's sessions."""
    w = Window.partitionBy("site_uid").orderBy("start")
    d = sessions.withColumn("resumed", F.lead("start").over(w)).where(F.col("resumed").isNotNull())
    return d.select("site_uid", F.col("last").alias("silent_from"), "resumed", ((F.unix_timestamp("resumed") - F.unix_timestamp("last")) / 3600).alias("hours"))
