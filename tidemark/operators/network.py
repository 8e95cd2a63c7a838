"""River network: names downstream, reviewed renames, rivers, their gauges and segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import plain, repair_name
from tidemark.session import ensure_checkpoint_dir


def downstream_names(flowlines: DataFrame, max_steps: int | None = None) -> DataFrame:
    """First named reach downstream of every unnamed reach and the steps to it.

    Pointer jumping: each round a reach takes over its pointer's pointer, so the walk doubles and
    needs as many rounds as the number of reaches has binary digits, at most. Main path at
    divergences; cycles and dead ends give null, and so do longer walks where ``max_steps`` is given."""
    spark = flowlines.sparkSession
    ensure_checkpoint_dir(spark)
    f = flowlines.select("comid", "fromnode", "tonode", repair_name("gnis_name").alias("own"), F.coalesce(F.col("divergence") == 2, F.lit(False)).alias("minor"))
    first = f.groupBy("fromnode").agg(F.min_by(F.struct("comid", "own"), F.struct("minor", "comid")).alias("n")).select(F.col("fromnode").alias("tonode"), F.col("n.comid").alias("ptr"), F.col("n.own").alias("name"))
    state = f.select("comid", "tonode", "own").join(first, "tonode", "left").select("comid", "own", "ptr", "name", F.when(F.col("ptr").isNotNull(), 1).alias("steps")).checkpoint()
    for _ in range(max(1, (max_steps or state.count()).bit_length())):
        waiting = F.col("name").isNull() & F.col("ptr").isNotNull()
        if state.where(waiting & F.col("own").isNull()).limit(1).count() == 0:
            break
        nxt = state.select(F.col("comid").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("name").alias("name2"), F.col("steps").alias("steps2"))
        j = state.join(nxt, "ptr", "left")
        state = j.select("comid", "own", F.when(waiting, F.col("ptr2")).otherwise(F.col("ptr")).alias("ptr"), F.when(waiting, F.col("name2")).otherwise(F.col("name")).alias("name"),
                         F.when(waiting, F.col("steps") + F.col("steps2")).otherwise(F.col("steps")).alias("steps")).checkpoint()
    found = F.col("name").isNotNull() & (F.lit(max_steps is None) | (F.col("steps") <= F.lit(max_steps)))
    return state.where(F.col("own").isNull()).select("comid", F.when(found, F.col("name")).alias("river_name"), F.when(found, F.col("steps")).alias("river_steps"))


def reach_fixes(flowlines: DataFrame, reaches: DataFrame, rules: DataFrame) -> DataFrame:
    """Reviewed renames by rule, the last rule winning per reach.

    ``rename`` matches a name id above a drainage area; ``levelpath_unnamed`` names the unnamed
    reaches on a site's level path. Either may be limited to listed watersheds (``huc8`` array)."""
    f = flowlines.withColumn("_unnamed", repair_name("gnis_name").isNull()).withColumn("_gid", F.trim(F.col("gnis_id").cast("string")))
    r = rules.select("rule_no", "rule", F.col("match_value").alias("mv"), "min_totdasqkm", F.col("huc8").alias("hucs"), "new_name", "new_gnis_id")
    ren = f.join(r.where(F.col("rule") == "rename"), (F.col("_gid") == F.col("mv")) & (F.col("min_totdasqkm").isNull() | (F.col("totdasqkm") >= F.col("min_totdasqkm"))))
    path = (r.where(F.col("rule") == "levelpath_unnamed").join(reaches.groupBy(F.col("site_uid").alias("mv")).agg(F.min("comid").alias("c")), "mv")
            .join(flowlines.select(F.col("comid").alias("c"), F.col("levelpathi").alias("lp")), "c").drop("c"))
    lev = f.where("_unnamed").join(path, F.col("levelpathi") == F.col("lp")).drop("lp")
    both = ren.unionByName(lev)
    both = both.where(F.col("hucs").isNull() | F.array_contains("hucs", F.col("huc8")))
    g = both.groupBy("comid").agg(F.max(F.struct("rule_no", "new_name", "new_gnis_id", F.concat_ws(" ", "rule", "mv").alias("why"))).alias("x"))
    return g.select("comid", F.col("x.new_name").alias("gnis_name"), F.col("x.new_gnis_id").alias("gnis_id"), F.col("x.why").alias("rule"))


def unknown_rules(rules: DataFrame) -> DataFrame:
    return rules.where(~F.col("rule").isin("rename", "levelpath_unnamed"))


def apply_fixes(flowlines: DataFrame, fixes: DataFrame) -> DataFrame:
    x = fixes.select("comid", F.col("gnis_name").alias("_n"), F.col("gnis_id").alias("_g"))
    j = flowlines.join(x, "comid", "left")
    new = {"gnis_name": F.coalesce("_n", "gnis_name"), "gnis_id": F.coalesce("_g", "gnis_id")}
    return j.select(*[new.get(c, F.col(c)).alias(c) for c in flowlines.columns])


def site_reaches(snapped: DataFrame, flowlines: DataFrame, downstream: DataFrame) -> DataFrame:
    """Snapped sites with the reach's own name, else the first one downstream, and how it was found."""
    f = flowlines.select("comid", repair_name("gnis_name").alias("gnis_name"), "totdasqkm", "huc8")
    j = snapped.select("site_uid", "comid").join(f, "comid", "left").join(downstream, "comid", "left")
    own = F.col("gnis_name").isNotNull()
    name, steps = F.coalesce("gnis_name", "river_name"), F.when(own, 0).otherwise(F.col("river_steps"))
    return j.select("site_uid", "comid", "gnis_name", name.alias("river_name"), steps.cast("bigint").alias("river_steps"), "totdasqkm", "huc8", method_of(name, steps).alias("river_method"))


def method_of(name: Column, steps: Column) -> Column:
    return F.when(name.isNull(), None).when(steps == 0, "snap").otherwise("downstream")


def apply_reach_fixes(reaches: DataFrame, fixes: DataFrame) -> DataFrame:
    """Sites on a renamed reach are on that river."""
    x = fixes.select("comid", F.col("gnis_name").alias("_n"))
    j = reaches.join(x, "comid", "left")
    hit = F.col("_n").isNotNull()
    new = {"gnis_name": F.coalesce("_n", "gnis_name"), "river_name": F.coalesce("_n", "river_name"), "river_steps": F.when(hit, F.lit(0).cast("bigint")).otherwise(F.col("river_steps")),
           "river_method": F.when(hit, "snap").otherwise(F.col("river_method"))}
    return j.select(*[new.get(c, F.col(c)).alias(c) for c in reaches.columns])


def add_manual_rivers(reaches: DataFrame, manual: DataFrame) -> DataFrame:
    """Hand-listed sites that have no reach."""
    m = manual.join(reaches.select("site_uid"), "site_uid", "left_anti").select("site_uid", "river_name", F.lit("manual").alias("river_method"))
    return reaches.unionByName(m, allowMissingColumns=True)


def river_segments(reaches: DataFrame, sites: DataFrame, flowlines: DataFrame) -> DataFrame:
    names = flowlines.select("huc8", "huc8_name").distinct()
    return (reaches.select("site_uid", "comid", "river_name", "river_method", "huc8", "totdasqkm").join(sites.select("site_uid", "source", "site_type", "state", "name"), "site_uid").join(names, "huc8", "left"))


def list_rivers(segments: DataFrame, flowlines: DataFrame, sites: DataFrame, series: DataFrame, min_sites: int = 2, min_years: float | None = None) -> DataFrame:
    """Rivers with enough daily-flow stream sites, or fewer but a long record; with the commonest basin and watershed."""
    s = segments.where((F.col("river_method") == "snap") & (F.col("site_type") == "stream"))
    f = flowlines.where(F.coalesce(F.trim("gnis_id"), F.lit("")) != "").select("comid", "gnis_name", "gnis_id")
    d = series.where((F.col("variable") == "discharge") & (F.col("interval") == "daily")).groupBy("site_uid").agg(F.max("n_obs").alias("n_obs"))
    j = s.join(f, "comid").join(sites.select("site_uid", "basin"), "site_uid").join(d, "site_uid")
    g = j.groupBy("gnis_name", "gnis_id").agg(F.countDistinct("site_uid").alias("n"), F.mode("basin", True).alias("basin"), F.mode("huc8_name", True).alias("huc8"), F.max("n_obs").alias("longest"))
    keep = F.col("n") >= min_sites
    if min_years:
        keep = keep | (F.col("longest") >= min_years * 365.25)
    return g.where(keep).withColumn("name", repair_name("gnis_name")).drop("gnis_name")


def label_rivers(rivers: DataFrame) -> DataFrame:
    """A distinguishing label for rivers that share a name: basin, else watershed, else id, where all differ."""
    by = rivers.groupBy("name").agg(F.count("*").alias("_n"), *[F.countDistinct(c).alias(f"_{c}") for c in ("basin", "huc8", "gnis_id")])
    j = rivers.join(by, "name")
    tag = (F.when(F.col("_n") == 1, None).when(F.col("_basin") == F.col("_n"), F.col("basin")).when(F.col("_huc8") == F.col("_n"), F.col("huc8")).when(F.col("_gnis_id") == F.col("_n"), F.col("gnis_id")))
    label = F.when(tag.isNotNull(), F.concat("name", F.lit(" ("), tag, F.lit(")"))).otherwise(F.col("name"))
    return j.withColumn("label", label).drop("_n", "_basin", "_huc8", "_gnis_id")


# Words and patterns of gauge names, and state codes.
GENERIC_WORDS = ["river", "creek", "rio", "arroyo", "fork", "north", "south", "east", "west", "middle", "branch", "wash", "de", "del", "los", "las", "la", "el", "the", "canyon", "draw", "little", "rito", "canada"]
NON_RIVER = (r"(?i)^(acequia|ditch|canal|lateral)\b|#|\b(dump|pond)\b|\bconveyance channel\b|^(?!.*\b(bl|below|blw|abv|above|nr|near|at|in)\b).*\breservoir$")
STREAM_TYPES = ["river", "r", "rvr", "rv", "creek", "cr", "ck", "c", "arroyo", "arr", "wash", "canyon"]
PLACE_WORDS = ["at", "near", "nr", "n", "above", "abv", "ab", "below", "bl", "blw", "bel", "in", "from", "to"]
STATE_FIPS = {"35": "NM", "08": "CO", "48": "TX", "04": "AZ", "40": "OK", "49": "UT"}


def _lits(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def carries_river_word(name: str, river: str) -> Column:
    """A distinctive word of the river stands in the name, which is no ditch, pond or reservoir; a river of generic words fits all."""
    at = F.trim(plain(name))
    own = F.array_except(F.regexp_extract_all(plain(river), F.lit(r"([a-z]+)"), F.lit(1)), _lits(GENERIC_WORDS))
    return ~at.rlike(NON_RIVER) & F.coalesce(F.reduce(own, F.lit(False), lambda had, w: had | F.contains(at, w)) | (F.size(own) == 0), F.lit(False))


def opens_with_river(name: str, river: str) -> Column:
    """The name starts with the river's words, its kind of stream left out, and goes on with a place word, a number or nothing."""
    spaced = lambda c: F.concat(F.array_join(F.regexp_extract_all(c, F.lit(r"([a-z0-9]+)"), F.lit(1)), " "), F.lit(" "))
    kinds = "|".join(STREAM_TYPES)
    gauge = spaced(F.replace(F.regexp_replace(plain(name), r"\(.*?\)", " "), F.lit("@"), F.lit(" at ")))
    words = F.regexp_replace(spaced(F.split_part(plain(river), F.lit(" ("), F.lit(1))), rf"(?<=. )(?:{kinds}) $", "")
    rest = F.substring(gauge, F.length(words) + 1, F.length(gauge))
    return (words != " ") & F.startswith(gauge, words) & rest.rlike(rf"^(?:(?:{kinds}) )?+(?:$|(?:{'|'.join(PLACE_WORDS)}) |\d+ )")


def read_gauges(segments: DataFrame, flowlines: DataFrame, rivers: DataFrame, counties: DataFrame, series: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """Flow gauges of every river at once: on its reaches, or on an unnamed reach whose first named river
    downstream it is, in a watershed the river crosses and with a name that says so.

    ``counties`` gives site_uid and county code; the state comes from it before the agency's field."""
    flow = series.where(F.col("variable") == "discharge").select("site_uid").distinct()
    st = F.create_map(*[F.lit(x) for kv in STATE_FIPS.items() for x in kv])
    c = counties.groupBy("site_uid").agg(F.min(st[F.substring("county", 1, 2)]).alias("_st"))
    s = (segments.where((F.col("site_type") == "stream") & F.col("huc8_name").isNotNull()).join(flow, "site_uid", "left_semi").join(c, "site_uid", "left").withColumn("state", F.coalesce("_st", "state")))
    if states:
        s = s.where(F.coalesce("state", F.lit("NM")).isin(*states))
    r = rivers.select("gnis_id", F.col("name").alias("river"), "label")
    f = flowlines.select("comid", "gnis_id", F.col("huc8").alias("_h"))
    on = s.where(F.col("river_method") == "snap").join(f.select("comid", "gnis_id"), "comid").join(r, "gnis_id").where(carries_river_word("name", "river"))
    crossed = f.join(r, "gnis_id").select("gnis_id", "river", "label", F.col("_h").alias("huc8")).distinct()
    below = s.where(F.col("river_method") == "downstream").join(crossed, (s["river_name"] == crossed["river"]) & (s["huc8"] == crossed["huc8"])).where(opens_with_river("name", "river"))
    cols = ["gnis_id", "label", "site_uid", "source", "name", "state", "totdasqkm", "river_method"]
    pick = lambda d, h: d.select(*cols, h.alias("segment"))
    return pick(on, F.col("huc8_name")).unionByName(pick(below, F.col("huc8_name")))


def order_segments(gauges: DataFrame, keys: Sequence[str] = ("river",)) -> DataFrame:
    """Segments upstream to downstream: by the median drainage area of their gauges."""
    g = gauges.groupBy(*keys, "segment").agg(F.median("totdasqkm").alias("area"))
    return g.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("area", "segment")))
