"""Archive upkeep: compaction, purges, relabelling, coverage, provenance and consistency counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.shapes import pick_row
from tidemark.operators.quality import dedup_observations, drop_missing_codes, override_variable, with_missing_code
from tidemark.schema import OBS_KEY, STORED
from tidemark.sources import manifest


def compact(df: DataFrame) -> DataFrame:
    """Rows that survive compaction: per key the newest ingest run."""
    return dedup_observations(df)


def compaction_report(df: DataFrame) -> DataFrame:
    """Rows before and removed per stored partition."""
    keys = df.groupBy("source", "year", *OBS_KEY).agg(F.count("*").alias("c"))
    return keys.groupBy("source", "variable", "year").agg(
        F.sum("c").alias("rows_before"), (F.sum("c") - F.count("*")).alias("removed"))


def compact_partitions(spark: SparkSession, root: str, staging: str, only: Sequence[tuple[str, str, int]] | None = None) -> DataFrame:
    """Compact a stored archive, or the (source, variable, year) partitions in ``only``, into ``staging``/data; the caller swaps
    those folders afterwards.

    Only the named partitions are read. The path being read is never overwritten, so a lost executor or a failed job leaves it
    intact. The report of rows before and removed is written to ``staging``/report, and so outlives the swap."""
    from tidemark.sources.archive import read_observations, write_partitioned

    d = read_observations(spark, root)
    if only is not None:
        wanted = spark.createDataFrame(list(only), "source string, variable string, year int")
        d = d.join(F.broadcast(wanted), ["source", "variable", "year"], "left_semi").select(*d.columns)
    compaction_report(d).write.mode("overwrite").parquet(f"{staging}/report")
    write_partitioned(compact(d), f"{staging}/data", "overwrite")
    return spark.read.parquet(f"{staging}/report")


PARTITIONS = ["source", "variable", "year"]
# stored bytes that one task of a compaction puts in order
BYTES_PER_PART = 8 << 20


def compact_archive(spark: SparkSession, root: str, job: str) -> list[str]:
    """Compact the partitions of an archive with a manifest that are read from more than one file, and put the result in force.

    Rows are dealt by key to a number of parts that follows the bytes to be rewritten, so what a task sorts does not grow with the
    archive; few keys are stored twice, so they are not sorted before the shuffle as well. A key's rows meet in one task: as many as
    loads that held it. ``job`` names the version; a job that was lost is run again under its name and goes on where it stopped."""
    listed = manifest.files(spark, root).select(manifest.partition_of(F.col("path")).alias("partition"), F.regexp_extract("path", "/version=([^/]+)/", 1).alias("version"), "size")
    many = listed.join(manifest.live(spark, root), ["partition", "version"], "left_semi").groupBy("partition").agg(F.count("*").alias("count"), F.sum("size").alias("size")).where("count > 1")
    size = many.agg(F.sum("size")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BYTES_PER_PART))
    # without the depth, a double that windows normalise: rows dealt by it as it is would be dealt a second time
    place = [k for k in OBS_KEY if k != "depth_cm"]
    return manifest.rewrite(spark, root, STORED, job, many, lambda d: compact(d.repartition(parts, *place)), PARTITIONS)


def purge_archive(spark: SparkSession, root: str, registry: DataFrame, job: str) -> list[str]:
    """Remove no-data markers from a stored archive; only partitions that hold one are rewritten."""
    stored = manifest.read(spark, root, STORED).withColumn("partition", manifest.held_in())
    marked = with_missing_code(stored, registry).where("is_missing_code")
    return manifest.rewrite(spark, root, STORED, job, marked, lambda d: drop_missing_codes(d, registry), PARTITIONS)


def relabel_archive(spark: SparkSession, root: str, rules: DataFrame, registry: DataFrame, job: str) -> list[str]:
    """Move series of a stored archive to the variable the rules name: the partitions they leave are rewritten, those they enter
    gain a version."""
    stored = manifest.read(spark, root, STORED).withColumn("partition", manifest.held_in())
    moved = relabel(stored, rules, registry).where("moved_from IS NOT NULL")
    return manifest.rewrite(spark, root, STORED, job, moved, lambda d: relabel(d, rules, registry).select(*STORED.names), PARTITIONS)


def compact_tables(parts: Sequence[DataFrame]) -> DataFrame:
    """Union appended parts by name and drop exact duplicates."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.distinct()


def compatible_parts(parts: Sequence[DataFrame]) -> tuple[list[DataFrame], list[int]]:
    """Parts whose shared columns keep the first part's types, and the positions of the others."""
    types = dict(parts[0].dtypes)
    good, bad = [], []
    for i, p in enumerate(parts):
        if all(types.setdefault(n, t) == t for n, t in p.dtypes):
            good.append(p)
        else:
            bad.append(i)
    return good, bad


def purge_counts(df: DataFrame, registry: DataFrame) -> DataFrame:
    """No-data markers still stored, by source and variable (the dry run of ``purge``)."""
    return (with_missing_code(df, registry).where("is_missing_code").groupBy("source", "variable")
            .agg(F.count("*").alias("removed")))


def purge(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of only those partitions that hold a marker, without the markers: what a rewrite stores."""
    marked = with_missing_code(df, registry)
    part = ["source", "variable", "year"]
    touched = marked.where("is_missing_code").select(*part).distinct()
    return marked.join(touched, part, "left_semi").where(~F.col("is_missing_code")).drop("is_missing_code")


def relabel(df: DataFrame, rules: DataFrame, registry: DataFrame) -> DataFrame:
    """Move series to the variable the rules name; ``moved_from`` says what changed."""
    tagged = df.withColumn("moved_from", F.col("variable"))
    out = override_variable(tagged, rules, registry)
    return out.withColumn("moved_from", F.when(F.col("moved_from") != F.col("variable"), F.col("moved_from")))


def rewrite_ids(df: DataFrame, column: str, pattern: str, to: str) -> DataFrame:
    """Rewrite an id by pattern and mark the rows that changed."""
    new = F.regexp_replace(F.col(column), pattern, to)
    return df.withColumn("changed", F.coalesce(new != F.col(column), F.lit(False))).withColumn(column, new)


def site_variables(df: DataFrame) -> DataFrame:
    """First, last and count per series; parameter and unit are the smallest seen."""
    return df.groupBy("site_uid", "source", "variable", "interval", "statistic").agg(
        F.min("datetime_utc").alias("first_datetime"), F.max("datetime_utc").alias("last_datetime"),
        F.count("*").alias("n_obs"), F.min("source_param").alias("source_param"), F.min("unit").alias("unit"))


def coverage(df: DataFrame) -> DataFrame:
    """Sites and rows per source, variable and year. Sites are made distinct by a keyed aggregate."""
    per_site = df.groupBy("source", "variable", "year", "site_uid").agg(F.count("*").alias("c"))
    return per_site.groupBy("source", "variable", "year").agg(F.count("*").alias("n_sites"), F.sum("c").alias("n_obs"))


def source_report(sites: DataFrame, series: DataFrame) -> DataFrame:
    """Per source: sites, variables, rows and time span, sources without data included."""
    s = series.select("site_uid", "variable", "n_obs", "first_datetime", "last_datetime")
    return sites.select("site_uid", "source").join(s, "site_uid", "left").groupBy("source").agg(
        F.countDistinct("site_uid").alias("sites"), F.countDistinct("variable").alias("variables"),
        F.coalesce(F.sum("n_obs"), F.lit(0)).alias("n_obs"), F.min("first_datetime").alias("first_datetime"),
        F.max("last_datetime").alias("last_datetime"))


def site_count_check(sites: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected minimum sites per source against what is there."""
    n = sites.groupBy("source").agg(F.count("*").alias("actual"))
    actual = F.coalesce("actual", F.lit(0))
    return expected.join(n, "source", "left").select(
        "source", "minimum", actual.alias("actual"),
        F.when(actual >= F.col("minimum"), "yes").when(actual > 0, "no").otherwise("not loaded").alias("ok"))


def landmark_check(series: DataFrame, landmarks: DataFrame) -> DataFrame:
    """Known records: earliest date no later than, and rows at least, what is on file."""
    m = landmarks.alias("m").join(
        series.alias("s"), (F.col("s.site_uid") == F.col("m.site_uid")) & (F.col("s.variable") == F.col("m.variable"))
        & (F.col("m.interval").isNull() | (F.col("m.interval") == F.col("s.interval"))), "left")
    g = m.groupBy("m.site_uid", "m.variable", "m.first_by", "m.min_rows").agg(
        F.to_date(F.min("s.first_datetime")).alias("first_date"), F.coalesce(F.sum("s.n_obs"), F.lit(0)).alias("n_rows"))
    ok = (F.when(F.col("first_date").isNull(), "not loaded")
           .when((F.col("first_date") <= F.col("first_by")) & (F.col("n_rows") >= F.col("min_rows")), "yes").otherwise("no"))
    return g.withColumn("ok", ok)


# ---- provenance of requests -------------------------------------------------

def fetch_stats(fetches: DataFrame) -> DataFrame:
    return fetches.groupBy("source", "status").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.min("fetched_at").alias("first"),
        F.max("fetched_at").alias("last"))


def last_successful_run(runs: DataFrame) -> DataFrame:
    good = (F.col("command") == "fetch") & F.col("status").isin("ok", "partial")
    return runs.where(good).groupBy("source").agg(F.max("started_at").alias("last_run"))


def last_window_end(fetches: DataFrame) -> DataFrame:
    return (fetches.where("status = 'ok'").groupBy("source", "site_uid", "variable")
            .agg(F.max("window_end").alias("window_end")))


def last_attempt(fetches: DataFrame) -> DataFrame:
    """The newest request of each series, whatever its outcome."""
    newest = F.max(F.struct("fetched_at", "fetch_id", "status"))
    return (fetches.groupBy("source", "site_uid", "variable").agg(newest.alias("r"))
            .select("source", "site_uid", "variable", F.col("r.status").alias("status"), F.col("r.fetched_at").alias("fetched_at")))


def plan_update(policy: DataFrame, last_runs: DataFrame, series: DataFrame, now: Column, margin_days: int,
                trust_days: int = 90) -> DataFrame:
    """Since-date per source: the earlier of the last run and the newest data, less a margin.

    Newest data counts only within ``trust_days`` before the run; skipped and never-run sources stay."""
    newest = (series.where(F.col("last_datetime") <= now + F.expr("INTERVAL 2 DAYS")).groupBy("source")
              .agg(F.to_date(F.max("last_datetime")).alias("newest")))
    j = policy.join(last_runs, "source", "left").join(newest, "source", "left")
    ran = F.to_date("last_run")
    behind = F.date_diff(ran, F.col("newest"))
    by_data = F.coalesce((behind > 0) & (behind <= trust_days), F.lit(False))
    action = F.when(F.col("skip"), "skip").when(ran.isNull(), "never run").otherwise("delta")
    since = F.date_sub(F.when(by_data, F.col("newest")).otherwise(ran), margin_days)
    return j.select("source", action.alias("action"), F.when(action == "delta", since).alias("since"),
                    F.when(action == "delta", F.when(by_data, "newest data").otherwise("last run")).alias("basis"))


def growth_log(before: DataFrame, after: DataFrame, fetched: DataFrame) -> DataFrame:
    """Per source and in total: rows before and after, rows fetched, net new and repeats."""
    j = (after.withColumnRenamed("n", "rows_after").join(before.withColumnRenamed("n", "rows_before"), "source", "full_outer")
         .join(fetched.withColumnRenamed("n", "rows_fetched"), "source", "full_outer").fillna(0))
    agg = [F.sum(c).alias(c) for c in ("rows_before", "rows_after", "rows_fetched")]
    total = j.rollup("source").agg(F.grouping("source").alias("is_total"), *agg)
    net = F.col("rows_after") - F.col("rows_before")
    return total.select(F.when(F.col("is_total") == 1, "all sources").otherwise(F.col("source")).alias("source"),
                        "rows_before", "rows_after", "rows_fetched", net.alias("net_new"),
                        (F.col("rows_fetched") - net).alias("repeats"))


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes of a stored table from file metadata only."""
    f = spark.read.parquet(root).select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("b")).distinct()
    return f.agg(F.count("*").alias("files"), F.sum("b").alias("bytes"))


# ---- consistency ------------------------------------------------------------

def orphan_sites(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Sites with observations but no site row, by source. Made distinct before joining."""
    seen = df.select("source", "site_uid").distinct()
    return seen.join(sites.select("site_uid"), "site_uid", "left_anti").groupBy("source").agg(F.count("*").alias("orphans"))


def duplicate_keys(df: DataFrame, key: Sequence[str] = tuple(OBS_KEY)) -> DataFrame:
    """How many keys occur more than once, by source and variable. The grouping spills; no per-partition loop."""
    k = list(dict.fromkeys(["source", "variable", *key]))
    return (df.groupBy(*k).agg(F.count("*").alias("c")).where("c > 1").groupBy("source", "variable")
            .agg(F.count("*").alias("duplicate_keys"), F.sum(F.col("c") - 1).alias("extra_rows")))


def hygiene(df: DataFrame, sites: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per check: unknown variables, missing coordinates, missing watershed, zero points, orphans.

    ``df`` is the table of ``site_variables``, which has each series once, so the observations are not read again."""
    located = F.col("lat").isNotNull() & F.col("huc8").isNull()
    home = F.col("state").isNull() | (F.col("state") == "NM")
    s = sites.agg(
        F.count_if(F.col("lat").isNull() | F.col("lon").isNull()).alias("no_coordinates"),
        F.count_if(located & home).alias("no_huc_in_state"), F.count_if(located & ~home).alias("no_huc_elsewhere"),
        F.count_if((F.col("lat") == 0) & (F.col("lon") == 0)).alias("zero_points"))
    s = s.unpivot([], ["no_coordinates", "no_huc_in_state", "no_huc_elsewhere", "zero_points"], "check", "n")
    unknown = (df.select("variable").distinct().join(registry, "variable", "left_anti")
               .agg(F.count("*").alias("n")).select(F.lit("unknown_variables").alias("check"), "n"))
    orphans = orphan_sites(df, sites).agg(F.coalesce(F.sum("orphans"), F.lit(0)).alias("n")).select(F.lit("orphan_sites").alias("check"), "n")
    return s.unionByName(unknown).unionByName(orphans)


def equivalence_summary(crosswalk: DataFrame) -> DataFrame:
    return crosswalk.groupBy("equivalence").agg(F.count("*").alias("n"))


def data_dictionary(registry: DataFrame, series: DataFrame) -> DataFrame:
    """Every registered variable with how much of it the archive holds."""
    held = series.groupBy("variable").agg(F.sum("n_obs").alias("n_obs"), F.count("*").alias("n_series"))
    return registry.join(held, "variable", "left").select(
        "variable", "unit", F.coalesce("n_obs", F.lit(0)).alias("n_obs"), F.coalesce("n_series", F.lit(0)).alias("n_series"))


def register_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Expose tables to ad-hoc SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def newest(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    return pick_row(df, keys, [F.col(by)])
