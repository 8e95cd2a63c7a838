"""Reach water balances from daily term series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import priority_of, water_year
from tidemark.operators.flow import daily_means
from tidemark.schema import CFS_DAY_AF, READINGS_PER_DAY, SOURCE_PRIORITY
from tidemark.session import ensure_checkpoint_dir


def first_stop_below(flowlines: DataFrame, stops: DataFrame) -> DataFrame:
    """(comid, stop): for every reach the first reach of ``stops`` (comid) downstream of it on the main path, null where there is none.

    Pointer jumping that ends at a stop: a reach whose pointer has found its stop takes it over, any other takes over the pointer's
    pointer, so rounds are the digits of the longest way. Cycles find none."""
    ensure_checkpoint_dir(flowlines.sparkSession)
    f = flowlines.select("comid", "fromnode", "tonode", F.coalesce(F.col("divergence") == 2, F.lit(False)).alias("minor"))
    first = f.groupBy("fromnode").agg(F.min_by("comid", F.struct("minor", "comid")).alias("ptr")).withColumnRenamed("fromnode", "tonode")
    at = stops.select(F.col("comid").alias("ptr"), F.col("comid").alias("stop")).distinct()
    state = f.join(first, "tonode", "left").join(at, "ptr", "left").select("comid", "ptr", "stop").checkpoint()
    for _ in range(max(1, state.count().bit_length())):
        waiting = F.col("stop").isNull() & F.col("ptr").isNotNull()
        if state.where(waiting).isEmpty():
            break
        ahead = state.select(F.col("comid").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("stop").alias("stop2"))
        j = state.join(ahead, "ptr", "left")
        state = j.select("comid", F.when(waiting, F.col("ptr2")).otherwise(F.col("ptr")).alias("ptr"), F.coalesce("stop", "stop2").alias("stop")).checkpoint()
    return state.select("comid", "stop")


def network_terms(flowlines: DataFrame, gauges: DataFrame, reservoirs: DataFrame) -> DataFrame:
    """The balances the network allows, as terms (reach, term, role, kind, gauge, reservoir).

    ``gauges``: gauge, comid; ``reservoirs``: reservoir, comid. Every gauge with something measured above it closes a reach that bears
    its name: the nearest gauges on all branches above flow in, it flows out, and reservoirs on the way add storage and evaporation. A
    reservoir on a gauge's own reach lies above the gauge. Of several gauges on one reach the smallest counts."""
    held = gauges.groupBy("comid").agg(F.min("gauge").alias("gauge"))
    below = first_stop_below(flowlines, held)
    name = held.select(F.col("comid").alias("stop"), F.col("gauge").alias("reach"))
    text = lambda c: F.lit(c)
    none = F.lit(None).cast("string")
    inflow = held.join(below.where("stop != comid"), "comid").join(name, "stop").select(
        "reach", F.col("gauge").alias("term"), text("inflow").alias("role"), text("flow").alias("kind"), F.col("gauge").cast("string").alias("gauge"), none.alias("reservoir"))
    own = held.select("comid", F.col("comid").alias("own"))
    lakes = reservoirs.join(below, "comid").join(own, "comid", "left").withColumn("stop", F.coalesce("own", "stop")).join(name, "stop")
    part = lambda role, kind: lakes.select("reach", F.concat_ws("/", "reservoir", text(role)).alias("term"), text(role), text(kind), none, F.col("reservoir").cast("string"))
    inner = inflow.unionAll(part("storage", "storage")).unionAll(part("evaporation", "volume"))
    outflow = inner.select("reach").distinct().select("reach", F.col("reach").alias("term"), text("outflow"), text("flow"), F.col("reach").cast("string"), none)
    return inner.unionAll(outflow)


def read_terms(df: DataFrame, terms: DataFrame) -> DataFrame:
    """One value per reach, term and day. Flow terms follow the daily-flow rule, the others average the
    day's values; where a term has several copies the best source is used.

    ``terms`` has reach, term, role, kind, variable and site_uid (one row per copy)."""
    # the order of copies is a matter of the terms, so a term's best copy of a day is a smallest number: an aggregate of plain numbers
    # that is cut down before the shuffle, where a window would sort every day of every copy
    order = Window.partitionBy("reach", "term").orderBy(priority_of(F.split_part("site_uid", F.lit(":"), F.lit(1)), SOURCE_PRIORITY), "site_uid", "variable", "role", "kind")
    ranked = terms.select("reach", "term", "role", "kind", "variable", "site_uid", F.row_number().over(order).cast("bigint").alias("rank"))
    slots = len(READINGS_PER_DAY) + 1
    other = (df.where(F.col("variable") != "discharge").groupBy("site_uid", "variable", F.to_date("datetime_utc").alias("date")).agg(F.avg("value").alias("value")))
    flow = daily_means(df).select("site_uid", F.lit("discharge").alias("variable"), "date", "value", "slot")
    j = flow.unionByName(other.withColumn("slot", F.lit(0))).join(ranked, ["site_uid", "variable"])
    place = F.col("rank") * slots + F.col("slot")
    g = j.groupBy("reach", "term", "date").agg(F.min_by("value", place).alias("value"), F.min("rank").alias("rank"))
    return g.join(ranked.select("reach", "term", "role", "kind", "rank"), ["reach", "term", "rank"]).select("reach", "term", "role", "kind", "date", "value")


def _period(day, by: str):
    if by == "water_year":
        y = water_year(day)
        return F.make_date(y - 1, F.lit(10), F.lit(1)), F.make_date(y, F.lit(9), F.lit(30))
    if by == "month":
        return F.to_date(F.date_trunc("month", day)), F.last_day(day)
    raise ValueError(f"by must be water_year or month, not {by!r}")


def balance(series: DataFrame, terms: DataFrame, by: str = "water_year", min_coverage: float = 0.95, storage_days: int = 3) -> DataFrame:
    """Inflow minus outflow, storage change and evaporation for every period a reach has data in.

    A flow or volume needs ``min_coverage`` of its days and is its mean times all days. A storage edge
    takes the last reading within ``storage_days`` before it. A period is complete when nothing is
    missing; reference terms are reported by the caller and never enter the sum. One row per term and
    period is the largest thing grouped; days are combined before any shuffle of periods."""
    a, b = _period(F.col("date"), by)
    moving = series.where(F.col("kind") != "storage").withColumn("start", a).withColumn("end", b)
    tot = moving.groupBy("reach", "term", "role", "kind", "start", "end").agg(F.avg("value").alias("mean"), F.count("value").alias("n"))
    days = F.date_diff("end", "start") + 1
    tot = tot.withColumn("days", days).withColumn("coverage", F.col("n") / F.col("days")).withColumn(
        "af", F.when(F.col("coverage") >= min_coverage, F.col("mean") * F.col("days") * F.when(F.col("kind") == "flow", CFS_DAY_AF).otherwise(1.0)))
    # a storage day serves the edge of its own period's end, as closing reading here and opening reading next
    edge = series.where(F.col("kind") == "storage").withColumn("end", b).where(F.date_diff("end", "date") <= storage_days)
    held = edge.groupBy("reach", "term", "end").agg(F.max_by("value", "date").alias("v"))
    periods = series.select("reach", a.alias("start"), b.alias("end")).distinct()
    defined = terms.select("reach", "term", "role", "kind").distinct()
    grid = periods.join(defined, "reach")
    closing = held.select("reach", "term", "end", F.col("v").alias("close_v"))
    opening = held.select("reach", "term", F.date_add("end", 1).alias("start"), F.col("v").alias("open_v"))
    g = (grid.join(tot.select("reach", "term", "start", "coverage", "af"), ["reach", "term", "start"], "left")
         .join(closing, ["reach", "term", "end"], "left").join(opening, ["reach", "term", "start"], "left"))
    stored = F.col("kind") == "storage"
    g = g.withColumn("x", F.when(stored, F.col("close_v") - F.col("open_v")).otherwise(F.col("af")))
    used = F.col("role") != "reference"
    part = lambda r: F.sum(F.when(F.col("role") == r, F.col("x")))
    out = g.groupBy("reach", "start", "end").agg(
        F.count_if(used & F.col("x").isNull()).alias("missing"), F.min(F.when(used & ~stored, F.coalesce("coverage", F.lit(0.0)))).alias("min_coverage"),
        *[F.coalesce(part(r), F.lit(0.0)).alias(n) for r, n in (("inflow", "inflow_af"), ("outflow", "outflow_af"), ("storage", "storage_change_af"), ("evaporation", "evaporation_af"))])
    done = F.col("missing") == 0
    gap = F.col("inflow_af") - F.col("outflow_af") - F.col("storage_change_af") - F.col("evaporation_af")
    return out.select("reach", "start", "end", (F.date_diff("end", "start") + 1).alias("days"), done.alias("complete"), "min_coverage",
                      *[F.when(done, F.col(c)).alias(c) for c in ("inflow_af", "outflow_af", "storage_change_af", "evaporation_af")],
                      F.when(done, F.col("outflow_af") + F.col("storage_change_af") + F.col("evaporation_af")).alias("implied_inflow_af"), F.when(done, gap).alias("unaccounted_af"),
                      F.when(done & (F.col("inflow_af") > 0), 100 * gap / F.col("inflow_af")).alias("unaccounted_pct"))


def newest_day(series: DataFrame, keys: Sequence[str] = ("reach",)) -> DataFrame:
    return series.groupBy(*keys).agg(F.max("date").alias("newest"))
