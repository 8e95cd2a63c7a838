"""URL filters as a temporal list join, in DataFrame expressions alone.

Dated list entries become validity intervals; an as-of join holds every capture against the entries active when it was fetched.
An entry names a host (and so its subdomains) or a host with leading path segments. A capture offers all keys that could name it, so
the join is one of equal keys; both sides also carry the month, which cuts the intervals of a pattern that changes often and
the captures of a host that holds a third of all pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def segments_of(url: Column) -> Column:
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def keys_of(url: Column) -> Column:
    """The host, its parent domains, and the host with each run of leading path segments."""
    host, labels, parts = host_of(url), F.split(host_of(url), r"\."), segments_of(url)
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    none = F.array().cast("array<string>")
    prefixes = F.when(F.size(parts) > 0, F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")))).otherwise(none)
    return F.when(host != "", F.array_distinct(F.concat(domains, prefixes))).otherwise(none)


def validity(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) from dated entries (list, pattern, action, dated); open intervals end in null.

    ``add`` opens an interval and ``remove`` ends it; of both on one day the removal holds. Repeated entries change nothing; rows
    with a null or another action are left out."""
    days = entries.where("list is not null and pattern is not null and dated is not null and action in ('add', 'remove')").groupBy("list", "pattern", "dated").agg(
        F.max(F.col("action") == "remove").alias("off"))
    w = Window.partitionBy("list", "pattern").orderBy("dated")
    turns = days.withColumn("was_off", F.lag("off").over(w)).where("was_off is null or was_off != off")
    spans = turns.withColumn("valid_to", F.lead("dated").over(w)).where("not off")
    return spans.select("list", "pattern", F.col("dated").alias("valid_from"), "valid_to")


def month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (url, fetched) with host, blocked, n_entries, lists (sorted, comma-joined) and pattern (the longest that holds).

    An entry holds from its day on until the day before its removal. Captures with a null url, no host or a null day are not blocked.
    Repeated rows keep their rows and get one verdict; other columns pass through, those named like a result are replaced."""
    results = ["host", "blocked", "n_entries", "lists", "pattern"]
    rows = captures.select(*[c for c in captures.columns if c.lower() not in results])
    seen = rows.where("url is not null and fetched is not null").select("url", "fetched").distinct()
    last = seen.agg(F.max("fetched")).first()[0]
    spans = validity(entries).where(F.col("valid_from") <= F.lit(last).cast("date"))
    until = F.least(F.coalesce("valid_to", F.lit(last)), F.lit(last)).cast("date")
    spans = spans.withColumn("month", F.explode(F.sequence(month(F.col("valid_from")), month(until))))
    offered = seen.select("url", "fetched", F.explode(keys_of(F.col("url"))).alias("pattern"), month(F.col("fetched")).alias("month"))
    active = (F.col("valid_from") <= F.col("fetched")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    held = offered.join(spans, ["pattern", "month"]).where(active)
    verdict = held.groupBy("url", "fetched").agg(
        F.count("*").alias("n_entries"), F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"),
        F.max(F.struct(F.length("pattern").alias("n"), "pattern"))["pattern"].alias("pattern"))
    out = rows.join(verdict, ["url", "fetched"], "left")
    return out.select(*rows.columns, host_of(F.col("url")).alias("host"), F.col("n_entries").isNotNull().alias("blocked"), F.coalesce("n_entries", F.lit(0)).alias("n_entries"),
                      F.coalesce("lists", F.lit("")).alias("lists"), "pattern")
