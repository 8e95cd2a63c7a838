"""Which sites are the same place or sensor: links by id, distance, name and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import haversine_m, plain
from tidemark.functions.graphs import components
from tidemark.functions.shapes import pick_row
from tidemark.session import ensure_checkpoint_dir

LINK = ["site_uid_a", "site_uid_b", "link_type", "evidence", "distance_m", "confidence"]

# Sources whose native id is a USGS number, sources that republish the USGS record,
# site types that may be one place, and sampling programmes.
NATIVE_IS_USGS = ["ibwc", "nwps_usgs"]
MIRRORS_USGS = ["usbr_hydrodata", "nrcs", "usace_cwms", "codwr", "iem_dcp", "nwps"]
KIND_GROUPS = {"stream": "flow", "canal": "flow", "diversion": "flow", "return_flow": "flow", "reservoir": "reservoir", "lake": "reservoir",
               "well": "well", "spring": "spring", "snow": "met", "met": "met"}
SAMPLING_SOURCES = ["wqp", "nmed_st2"]
# The published wording of evidence.
BY_METADATA, BY_ANCHOR = "usgs id in provider metadata", "both linked to "
BY_WEATHER_KEY = {"ghcn": "same GHCN station id ", "wban": "same WBAN ", "icao": "same ICAO "}
USGS_ID = r"^(?:USGS-)?(\d{8,15})$"


def _links(df: DataFrame) -> DataFrame:
    return df.select(*LINK)


def metadata_values(sites: DataFrame, key_holds: str) -> DataFrame:
    """(site_uid, value): the texts and whole numbers in ``raw_metadata`` whose nearest key holds ``key_holds``, at any depth.

    The metadata are parsed once into variants and opened level by level: members of an object bring their own key, members of a list
    keep that of the list. Each level is checkpointed with what is still nested only, so a level costs what lies below it; levels end
    when nothing is nested any more. Metadata that are no JSON give nothing; a key inside a text is part of the text."""
    ensure_checkpoint_dir(sites.sparkSession)
    spark = sites.sparkSession
    level = sites.where(F.contains(F.lower("raw_metadata"), F.lit(key_holds))).select(
        "site_uid", F.lit("").alias("key"), F.try_parse_json("raw_metadata").alias("node")).where("node IS NOT NULL")
    found = None
    while True:
        inner = spark.tvf.variant_explode(F.col("node").outer()).select(F.col("key").alias("own"), F.col("value").alias("inner"))
        opened = level.lateralJoin(inner).select("site_uid", F.coalesce("own", "key").alias("key"), F.col("inner").alias("node"), F.schema_of_variant("inner").alias("kind"))
        opened = opened.checkpoint()
        plain = opened.where(F.col("kind").isin("STRING", "BIGINT") & F.contains(F.lower("key"), F.lit(key_holds)))
        plain = plain.select("site_uid", F.try_variant_get("node", "$", "string").alias("value"))
        found = plain if found is None else found.unionAll(plain)
        level = opened.where(F.startswith("kind", F.lit("OBJECT")) | F.startswith("kind", F.lit("ARRAY"))).select("site_uid", "key", "node")
        if level.isEmpty():
            return found


def metadata_links(sites: DataFrame) -> DataFrame:
    """Exact links by a USGS number found under any metadata key that mentions USGS, at any depth, or in the native id of some feeds."""
    own = sites.where(F.col("source").isin(*NATIVE_IS_USGS)).select("site_uid", F.col("native_id").alias("value"))
    values = metadata_values(sites.where(F.col("source") != "usgs"), "usgs").unionByName(own)
    ids = values.select("site_uid", F.regexp_extract(F.trim("value"), USGS_ID, 1).alias("n")).where("n != ''").distinct()
    known = sites.where(F.col("source") == "usgs").select(F.col("native_id").alias("n"))
    j = sites.where(F.col("source") != "usgs").select("site_uid", "source").join(ids, "site_uid").join(known, "n", "left_semi")
    return _links(j.select(F.col("site_uid").alias("site_uid_a"), F.concat(F.lit("usgs:"), "n").alias("site_uid_b"),
                           F.when(F.col("source").isin(*MIRRORS_USGS), "same_sensor").otherwise("same_location_different_sensor").alias("link_type"),
                           F.lit(BY_METADATA).alias("evidence"), F.lit(None).cast("double").alias("distance_m"), F.lit(0.95).alias("confidence")))


def weather_keys(sites: DataFrame) -> DataFrame:
    """The ids a weather site can be matched on: station id, WBAN number and airport code. A WBAN of 99999 in an ISD id stands for none."""
    meta = lambda k: F.get_json_object("raw_metadata", f"$.{k}")
    src, nid = F.col("source"), F.col("native_id")
    ghcn = F.when(src.isin("noaa_ghcnh", "noaa_ghcnd"), nid)
    isd = F.split_part(nid, F.lit("-"), F.lit(2))
    crn = F.coalesce(meta("WBAN"), nid)
    wban = (F.when(src.isin("noaa_ghcnh", "noaa_ghcnd"), F.nullif(F.regexp_extract(nid, r"^USW000(\d{5})$", 1), F.lit("")))
             .when((src == "noaa_isd") & ~isd.isin("", "99999"), isd).when((src == "uscrn") & crn.rlike(r"^\d+$"), F.lpad(crn, 5, "0")))
    icao = F.upper(F.trim(meta("icao")))
    keys = F.array(F.struct(F.lit(0).alias("rank"), F.lit("ghcn").alias("kind"), ghcn.alias("key")), F.struct(F.lit(1).alias("rank"), F.lit("wban").alias("kind"), wban.alias("key")),
                   F.struct(F.lit(2).alias("rank"), F.lit("icao").alias("kind"), F.when(F.length(icao) == 4, icao).alias("key")))
    d = sites.where(src.isin("noaa_ghcnh", "noaa_ghcnd", "noaa_isd", "uscrn")).select("site_uid", "source", F.explode(keys).alias("k"))
    return d.select("site_uid", "source", "k.*").where(F.col("key").isNotNull())


def key_stars(keys: DataFrame) -> DataFrame:
    """Grouping edges from every member of a key to the key's smallest site: one row per member.

    This is what connected groups need; the pairwise links below are the published product."""
    hub = keys.groupBy("kind", "key").agg(F.min("site_uid").alias("site_uid_a"))
    return keys.join(hub, ["kind", "key"]).where(F.col("site_uid") != F.col("site_uid_a")).select("site_uid_a", F.col("site_uid").alias("site_uid_b")).distinct()


def weather_links(sites: DataFrame) -> DataFrame:
    """Links between different feeds that share an id, one row per pair with all the evidence.

    Every key carries the keys of its site before and after it, so a pair is written once, at the first key it shares, with the
    evidence of the later ones: keys are shuffled, pairs are not. A ``site_uid`` is of one source."""
    names = F.when(F.col("kind") == "ghcn", BY_WEATHER_KEY["ghcn"]).when(F.col("kind") == "wban", BY_WEATHER_KEY["wban"]).otherwise(BY_WEATHER_KEY["icao"])
    key = F.struct("rank", F.concat(names, "key").alias("evidence"))
    held = weather_keys(sites).groupBy("site_uid", "source").agg(F.array_sort(F.collect_set(key)).alias("held"))
    k = held.select("site_uid", "source", F.col("held.evidence").alias("all"), F.posexplode("held").alias("at", "key"))
    k = k.select("site_uid", "source", "key.*", F.slice("all", 1, F.col("at")).alias("before"), F.slice("all", F.col("at") + 2, F.size("all")).alias("after"))
    a, b = k.alias("a"), k.hint("merge").alias("b")
    on = (F.col("a.rank") == F.col("b.rank")) & (F.col("a.evidence") == F.col("b.evidence")) & (F.col("a.site_uid") < F.col("b.site_uid")) & (F.col("a.source") != F.col("b.source")) & ~F.arrays_overlap("a.before", "b.before")
    return a.join(b, on).select(F.col("a.site_uid").alias("site_uid_a"), F.col("b.site_uid").alias("site_uid_b"), F.lit("same_sensor").alias("link_type"),
                                F.concat_ws("; ", "a.evidence", F.array_intersect("a.after", "b.after")).alias("evidence"), F.lit(None).cast("double").alias("distance_m"),
                                F.when(F.col("a.rank") == 0, 0.98).otherwise(0.95).alias("confidence"))


def gauge_id_links(sites: DataFrame) -> DataFrame:
    """Links by transformed ids: a sample id that is a USGS number, one USGS number cited in a name, an observer id that is a climate station's."""
    by = lambda s: sites.where(F.col("source") == s)
    usgs = by("usgs").select(F.col("native_id").alias("n"))
    none = F.lit(None).cast("double").alias("distance_m")
    w = by("wqp").withColumn("is_usgs", F.col("native_id").startswith("USGS-"))
    one = w.where("is_usgs").withColumn("n", F.substring("native_id", 6, 20)).join(usgs, "n", "left_semi").select(
        F.col("site_uid").alias("site_uid_a"), F.concat(F.lit("usgs:"), "n").alias("site_uid_b"), F.lit("same_sensor").alias("link_type"),
        F.lit("WQP id USGS-<number> is the USGS site number").alias("evidence"), none, F.lit(0.99).alias("confidence"))
    cited = F.explode(F.array_distinct(F.regexp_extract_all("name", F.lit(r"(?<![0-9])(\d{8,15})(?![0-9])"), F.lit(1))))
    c = w.where("NOT is_usgs").select("site_uid", cited.alias("n")).join(usgs, "n", "left_semi").groupBy("site_uid").agg(F.count("*").alias("k"), F.min("n").alias("n")).where("k = 1")
    two = c.select(F.col("site_uid").alias("site_uid_a"), F.concat(F.lit("usgs:"), "n").alias("site_uid_b"), F.lit("same_location_different_sensor").alias("link_type"),
                   F.concat(F.lit("WQP site name cites USGS "), "n").alias("evidence"), none, F.lit(0.9).alias("confidence"))
    p = r"^([A-Z]{2})-([A-Z]{2})-(\d+)$"
    gid = F.concat(F.lit("US1"), F.regexp_extract("native_id", p, 1), F.regexp_extract("native_id", p, 2), F.lpad(F.regexp_extract("native_id", p, 3).try_cast("int").cast("string"), 4, "0"))
    o = by("cocorahs").where(F.col("native_id").rlike(p)).withColumn("g", gid).join(by("noaa_ghcnd").select(F.col("native_id").alias("g")), "g", "left_semi").withColumn("other", F.concat(F.lit("noaa_ghcnd:"), "g"))
    three = o.select(F.least("site_uid", "other").alias("site_uid_a"), F.greatest("site_uid", "other").alias("site_uid_b"), F.lit("same_sensor").alias("link_type"),
                     F.concat(F.lit("CoCoRaHS "), "native_id", F.lit(" is GHCN-Daily "), "g").alias("evidence"), none, F.lit(0.98).alias("confidence"))
    return one.unionByName(two).unionByName(three)


def _places(sites: DataFrame, cell: float) -> tuple[DataFrame, DataFrame]:
    kinds = F.create_map(*[F.lit(x) for kv in KIND_GROUPS.items() for x in kv])
    pts = sites.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).withColumn("grp", kinds[F.col("site_type")]).where(F.col("grp").isNotNull())
    pts = pts.where(~((F.col("source") == "ose_arcgis") & F.col("native_id").startswith("pod:")))
    # normalised so that a place is one key however its coordinates were written
    pts = pts.withColumn("lat", F.col("lat") + 0.0).withColumn("lon", F.col("lon") + 0.0)
    places = pts.select("grp", "lat", "lon").distinct().withColumn("gx", F.floor(F.col("lon") / cell)).withColumn("gy", F.floor(F.col("lat") / cell))
    return pts, places


def near_places(sites: DataFrame, radius_m: float = 250.0) -> tuple[DataFrame, DataFrame]:
    """Sites, and pairs of distinct places of one kind within the radius (a place with itself included).

    Distances are computed between places, not sites, so a thousand sites written to one default
    coordinate cost one place. Cells are just larger than the radius at these latitudes."""
    cell = 0.01 * radius_m / 250.0
    pts, places = _places(sites, cell)
    ring = F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x in (-1, 0, 1) for y in (-1, 0, 1)])
    near = places.select(F.col("grp").alias("g2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), "gx", "gy", F.explode(ring).alias("r"))
    near = near.select("g2", "lat2", "lon2", (F.col("gx") + F.col("r.dx")).alias("cx"), (F.col("gy") + F.col("r.dy")).alias("cy"))
    j = places.join(near, (places["grp"] == near["g2"]) & (places["gx"] == near["cx"]) & (places["gy"] == near["cy"]))
    d = haversine_m("lat", "lon", "lat2", "lon2")
    return pts, j.withColumn("metres", d).where(F.col("metres") <= radius_m).select("grp", "lat", "lon", "lat2", "lon2", "metres")


def proximity_links(sites: DataFrame, radius_m: float = 250.0) -> DataFrame:
    """Candidate pairs of one kind from different sources within the radius.

    Permit points never pair, and a sampling site that is a USGS site never pairs with another one."""
    pts, near = near_places(sites, radius_m)
    a = pts.select("grp", "lat", "lon", F.col("site_uid").alias("site_uid_a"), F.col("source").alias("sa"), F.col("native_id").alias("na"))
    b = pts.select("grp", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), F.col("site_uid").alias("site_uid_b"), F.col("source").alias("sb"), F.col("native_id").alias("nb"))
    j = near.join(a, ["grp", "lat", "lon"]).join(b, ["grp", "lat2", "lon2"]).where((F.col("site_uid_a") < F.col("site_uid_b")) & (F.col("sa") != F.col("sb")))
    own = lambda x, n, y: (F.col(x) == "wqp") & F.col(n).startswith("USGS-") & (F.col(y) == "usgs")
    j = j.where(~own("sa", "na", "sb") & ~own("sb", "nb", "sa"))
    conf = F.round(F.greatest(F.lit(0.3), 0.9 - F.col("metres") / radius_m * 0.5), 2)
    return _links(j.select("site_uid_a", "site_uid_b", F.lit("colocated").alias("link_type"), F.concat(F.lit("same kind ("), "grp", F.lit(f") within {radius_m:.0f} m")).alias("evidence"),
                           F.round("metres", 1).alias("distance_m"), conf.alias("confidence")))


def settle_by_anchor(links: DataFrame) -> DataFrame:
    """Settle candidates by the USGS site each end is exactly linked to.

    The same single anchor promotes the pair; two different ones drop it; several settle nothing."""
    exact = links.where(F.col("link_type") != "colocated")
    ua, ub = F.col("site_uid_a").startswith("usgs:"), F.col("site_uid_b").startswith("usgs:")
    e = exact.where(ua != ub).select(F.when(ua, F.col("site_uid_b")).otherwise(F.col("site_uid_a")).alias("o"), F.when(ua, F.col("site_uid_a")).otherwise(F.col("site_uid_b")).alias("u"), "link_type")
    per = e.groupBy("o", "u").agg(F.max("link_type").alias("kind"))
    anchor = per.groupBy("o").agg(F.count("*").alias("n"), F.min("u").alias("u"), F.min("kind").alias("kind")).where("n = 1")
    cand = links.where(F.col("link_type") == "colocated")
    j = (cand.join(anchor.select(F.col("o").alias("site_uid_a"), F.col("u").alias("xa"), F.col("kind").alias("ka")), "site_uid_a", "left")
         .join(anchor.select(F.col("o").alias("site_uid_b"), F.col("u").alias("xb"), F.col("kind").alias("kb")), "site_uid_b", "left"))
    both = F.col("xa").isNotNull() & F.col("xb").isNotNull()
    j = j.where(~both | (F.col("xa") == F.col("xb")))
    same = (F.col("ka") == "same_sensor") & (F.col("kb") == "same_sensor")
    settled = j.select("site_uid_a", "site_uid_b", F.when(both, F.when(same, "same_sensor").otherwise("same_location_different_sensor")).otherwise(F.col("link_type")).alias("link_type"),
                       F.when(both, F.concat(F.lit(BY_ANCHOR), "xa")).otherwise(F.col("evidence")).alias("evidence"), "distance_m", F.when(both, 0.95).otherwise(F.col("confidence")).alias("confidence"))
    return exact.unionByName(settled)


def merge_manual(links: DataFrame, manual: DataFrame) -> DataFrame:
    """Add hand-made links at full confidence, drop candidates settled either way round, one row per pair and type."""
    m = manual.select("site_uid_a", "site_uid_b", "link_type", F.coalesce("evidence", F.lit("manual")).alias("evidence"), F.lit(None).cast("double").alias("distance_m"), F.lit(1.0).alias("confidence"))
    allof = links.withColumn("_o", F.lit(0)).unionByName(m.withColumn("_o", F.lit(1))).withColumn("_x", F.least("site_uid_a", "site_uid_b")).withColumn("_y", F.greatest("site_uid_a", "site_uid_b"))
    cand = F.col("link_type") == "colocated"
    done = allof.where(~cand).select("_x", "_y").distinct()
    kept = allof.where(~cand).unionByName(allof.where(cand).join(done, ["_x", "_y"], "left_anti").select(*allof.columns))
    return _links(pick_row(kept.drop("_x", "_y"), ["site_uid_a", "site_uid_b", "link_type"], [F.col("_o")], last=False))


def build_links(sites: DataFrame, manual: DataFrame, radius_m: float = 250.0) -> DataFrame:
    """All links: exact ids, candidates not already exact, anchors, then hand-made rows."""
    ensure_checkpoint_dir(sites.sparkSession)
    wl = weather_links(sites).unionByName(gauge_id_links(sites)).checkpoint()
    near = proximity_links(sites, radius_m)
    pair = [F.least("site_uid_a", "site_uid_b").alias("_x"), F.greatest("site_uid_a", "site_uid_b").alias("_y")]
    near = near.select("*", *pair).join(wl.select(*pair).distinct(), ["_x", "_y"], "left_anti").drop("_x", "_y")
    # the candidate list is read by several steps: write it once
    found = metadata_links(sites).unionByName(wl).unionByName(near).checkpoint()
    return merge_manual(settle_by_anchor(found).checkpoint(), manual)


# ---- names ------------------------------------------------------------------

# Abbreviations, words that do not name a place, derived-series words, and directions.
ABBREVIATIONS = {"nr": "near", "bl": "below", "blw": "below", "abv": "above", "ab": "above", "r": "river", "riv": "river", "cr": "creek", "crk": "creek", "ck": "creek",
                 "res": "reservoir", "rsvr": "reservoir", "ds": "downstream", "us": "upstream", "fldwy": "floodway", "cn": "canal", "mt": "mount", "mtn": "mountain",
                 "spgs": "springs", "spg": "springs", "cty": "city", "ft": "fort", "st": "saint", "rd": "road", "br": "bridge", "bdg": "bridge", "hwy": "highway"}
GENERIC = ["near", "at", "below", "above", "downstream", "upstream", "of", "the", "in", "on", "to", "and", "from", "nm", "co", "tx", "az", "ut", "river", "creek", "rio", "reservoir", "lake", "dam",
           "canal", "ditch", "diversion", "gage", "gauge", "station", "usgs", "wqp", "flow", "nmed", "site", "sampling", "stream", "channel"]
DERIVED = ["plus", "minus", "pumpage", "computed", "adjusted", "combined", "total", "net"]
DOWN, UP = ["below", "downstream"], ["above", "upstream"]


def _array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def name_words(name: str | Column) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    text = F.regexp_replace(F.replace(F.lower(c), F.lit("@"), F.lit(" at ")), "[^a-z0-9 ]", " ")
    table = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    return F.transform(F.filter(F.split(text, " +"), lambda w: w != ""), lambda w: F.coalesce(table[w], w))


def place_words(words: Column) -> Column:
    return F.array_distinct(F.filter(words, lambda w: ~F.array_contains(_array(GENERIC), w) & ~w.rlike(r"^\d+$") & (F.length(w) > 1)))


def with_name_match(pairs: DataFrame, a: str = "name_a", b: str = "name_b") -> DataFrame:
    """Share of place words two names have in common: zero when they point opposite ways along the
    river or only one is a computed series. ``same_name`` is the containment test."""
    d = pairs.withColumn("_wa", name_words(a)).withColumn("_wb", name_words(b))
    d = d.withColumn("_pa", place_words(F.col("_wa"))).withColumn("_pb", place_words(F.col("_wb")))
    has = lambda w, values: F.arrays_overlap(F.col(w), _array(values))
    opposed = (has("_wa", DOWN) & has("_wb", UP)) | (has("_wa", UP) & has("_wb", DOWN))
    empty = (F.size("_pa") == 0) | (F.size("_pb") == 0)
    common, every = F.size(F.array_intersect("_pa", "_pb")), F.size(F.array_union("_pa", "_pb"))
    match = F.when(opposed | (has("_wa", DERIVED) != has("_wb", DERIVED)) | empty, 0.0).otherwise(common / every)
    joined = lambda c: F.array_join(c, "")
    same = ~empty & ((common == F.size("_pa")) | (common == F.size("_pb")) | (joined(F.array_sort("_pa")) == joined(F.array_sort("_pb"))) | (joined("_wa") == joined("_wb")))
    return d.withColumn("name_match", match).withColumn("same_name", same).drop("_wa", "_wb", "_pa", "_pb")


# ---- series -----------------------------------------------------------------

TOLERANCE = {"stage": 0.005, "reservoir_elevation": 0.005, "reservoir_storage": 0.005, "discharge": 0.03}


def series_agreement(daily: DataFrame, pairs: DataFrame, min_shared: int = 20) -> DataFrame:
    """Shared days, median relative difference and correlation of each pair's daily series.

    ``daily`` has site_uid, variable, date, value; it is aggregated to days before the join."""
    a = daily.select(F.col("site_uid").alias("site_uid_a"), "variable", "date", F.col("value").alias("x"))
    b = daily.select(F.col("site_uid").alias("site_uid_b"), "variable", "date", F.col("value").alias("y"))
    j = pairs.select("site_uid_a", "site_uid_b").join(a, "site_uid_a").join(b, ["site_uid_b", "variable", "date"])
    rel = F.abs(F.col("x") - F.col("y")) / F.greatest(F.abs("x"), F.abs("y"), F.lit(1e-9))
    g = j.groupBy("site_uid_a", "site_uid_b", "variable").agg(F.count("*").alias("days"), F.median(rel).alias("median_rel"), F.corr("x", "y").alias("corr"))
    return with_agreement(g.where(F.col("days") >= min_shared))


def with_agreement(df: DataFrame, min_days: int = 60, min_corr: float = 0.99) -> DataFrame:
    tol = F.create_map(*[F.lit(x) for kv in TOLERANCE.items() for x in kv])[F.col("variable")]
    ok = (F.col("days") >= min_days) & (F.col("median_rel") <= tol) & (F.col("corr") >= min_corr)
    return df.withColumn("agrees", F.coalesce(ok, F.lit(False)))


def decide(pairs: DataFrame, agreements: DataFrame, match: float = 0.66, near_m: float = 100.0, gauge_near_m: float = 25.0, min_days: int = 60) -> DataFrame:
    """Link type of each pair, or none: same series; else same station number, name and spot; else one place by name and distance.

    ``pairs`` has site ids, sources, names, metres; numbers behind the decision are kept as columns."""
    g = agreements.groupBy("site_uid_a", "site_uid_b").agg(
        F.max(F.when(F.col("agrees"), F.struct("days", "variable", "median_rel", "corr"))).alias("best"), F.max((F.col("variable") == "discharge") & ~F.col("agrees")).alias("flow_differs"),
        F.max(~F.col("agrees") & (F.col("days") >= min_days)).alias("series_differ"))
    d = with_name_match(pairs).join(g, ["site_uid_a", "site_uid_b"], "left")
    sampling = F.col("source_a").isin(*SAMPLING_SOURCES) | F.col("source_b").isin(*SAMPLING_SOURCES)
    native = lambda c: F.substring_index(F.col(c), ":", -1)
    number = lambda lst, meas: F.split_part(lst, F.lit(":"), F.lit(3)) == native(meas)
    station = (((F.col("source_a") == "ose_arcgis") & (F.col("source_b") == "ose_meas") & F.col("site_uid_a").contains(":rtm:") & number("site_uid_a", "site_uid_b"))
               | ((F.col("source_b") == "ose_arcgis") & (F.col("source_a") == "ose_meas") & F.col("site_uid_b").contains(":rtm:") & number("site_uid_b", "site_uid_a")))
    close = F.col("metres") <= F.when(sampling, near_m).otherwise(gauge_near_m)
    kind = (F.when(F.col("source_a") == F.col("source_b"), None).when(F.col("best").isNotNull(), "same_sensor").when(station & (F.col("metres") <= 10) & F.col("same_name"), "same_sensor")
             .when((F.col("name_match") >= match) & close, "same_location_different_sensor"))
    return d.select("site_uid_a", "site_uid_b", "metres", "name_match", F.col("best.variable").alias("agreed_on"), F.col("best.days").alias("shared_days"), F.coalesce("flow_differs", F.lit(False)).alias("flow_differs"),
                    F.coalesce("series_differ", F.lit(False)).alias("series_differ"), kind.alias("link_type"))


def decide_wells(pairs: DataFrame, depth_tol_m: float = 0.3, near_m: float = 10.0, id_near_m: float = 25.0) -> DataFrame:
    """Same well by depth and distance, or by a USGS number ending the other's id; never the same sensor."""
    a, b = F.substring_index("site_uid_a", ":", -1), F.substring_index("site_uid_b", ":", -1)
    known = F.col("depth_a").isNotNull() & F.col("depth_b").isNotNull()
    apart = F.coalesce(F.abs(F.col("depth_a") - F.col("depth_b")) > depth_tol_m, F.lit(False))
    carries = lambda s, n, o: (F.col(s) == "usgs") & n.rlike(r"^\d{8,}$") & F.endswith(o, F.concat(F.lit("-"), n))
    by_id = (carries("source_a", a, b) | carries("source_b", b, a)) & (F.col("metres") <= id_near_m)
    hit = (F.col("source_a") != F.col("source_b")) & ~apart & (by_id | (known & (F.col("metres") <= near_m)))
    return pairs.withColumn("basis", F.when(hit & by_id, "id").when(hit, "depth")).withColumn("link_type", F.when(hit, "same_location_different_sensor"))


def compare_series(obs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Bulk comparison of linked pairs: stored daily values where a site has them, else means of finer
    readings; share of equal days, correlation and median ratio."""
    ends = pairs.select(F.col("site_uid_a").alias("site_uid")).union(pairs.select("site_uid_b")).distinct()
    o = obs.where(F.col("value").isNotNull()).join(ends, "site_uid", "left_semi").withColumn("is_day", F.col("interval") == "daily")
    day = o.groupBy("site_uid", "variable", F.to_date("datetime_utc").alias("date")).agg(
        F.avg(F.when(F.col("is_day"), F.col("value"))).alias("d"), F.avg("value").alias("v"))
    has = F.max(F.col("d").isNotNull()).over(Window.partitionBy("site_uid", "variable"))
    day = day.withColumn("has", has).withColumn("value", F.when(F.col("has"), F.col("d")).otherwise(F.col("v"))).where(F.col("value").isNotNull()).select("site_uid", "variable", "date", "value")
    a = day.select(F.col("site_uid").alias("site_uid_a"), "variable", "date", F.col("value").alias("x"))
    b = day.select(F.col("site_uid").alias("site_uid_b"), "variable", "date", F.col("value").alias("y"))
    j = pairs.select("site_uid_a", "site_uid_b").join(a, "site_uid_a").join(b, ["site_uid_b", "variable", "date"])
    equal = F.abs(F.col("x") - F.col("y")) <= F.greatest(0.005 * F.abs("x"), F.lit(0.01))
    return j.groupBy("site_uid_a", "site_uid_b", "variable").agg(
        F.count("*").alias("overlap_days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.round(F.avg(equal.cast("int")), 3).alias("share_equal"),
        F.round(F.corr("x", "y"), 4).alias("r"), F.round(F.median(F.col("y") / F.nullif(F.col("x"), F.lit(0.0))), 3).alias("median_ratio"))


# ---- groups -----------------------------------------------------------------


def connected_groups(nodes: DataFrame, edges: DataFrame, node: str = "site_uid", a: str = "site_uid_a", b: str = "site_uid_b") -> DataFrame:
    """Group of each node: the smallest node it is connected to, edges among given nodes only.

    Long chains, grids and hubs take a few rounds each, in any order of ids; see ``graphs.components``."""
    ids = nodes.select(F.col(node).alias("id")).distinct()
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    e = e.join(ids.withColumnRenamed("id", "a"), "a", "left_semi").join(ids.withColumnRenamed("id", "b"), "b", "left_semi")
    return ids.join(components(e), "id", "left").select(F.col("id").alias(node), F.coalesce("root", "id").alias("group"))


# Words left out when ditch names are compared.
DITCH_WORDS = ["acequia", "de", "del", "la", "las", "los", "el", "y", "community", "ditch"]


def ditch_key(name: str | Column) -> Column:
    c = plain(name)
    words = F.filter(F.split(F.regexp_replace(c, "[^a-z ]", " "), " +"), lambda w: (w != "") & ~F.array_contains(_array(DITCH_WORDS), w))
    return F.array_join(words, " ")


def governed_ditches(governed: DataFrame, mapped: DataFrame, rivers: DataFrame) -> DataFrame:
    """Governance-list ditches on each river: the list names the river as their stream, or the name is
    mapped along it; either way in a county the river crosses.

    ``governed``: name, stream, county. ``mapped``: river, name. ``rivers``: river, base, county."""
    g = governed.withColumn("key", ditch_key("name")).withColumn("stream_key", ditch_key(F.regexp_replace(F.coalesce("stream", F.lit("")), "(?i) river$", ""))).withColumn(
        "county_key", F.trim(F.replace(F.lower(F.coalesce("county", F.lit(""))), F.lit(" county"), F.lit(""))))
    cross = rivers.select("river", "base", F.lower("county").alias("county_key")).distinct()
    # a listed ditch meets a river through a shared county, or has none and meets it by stream alone
    by_county = g.where(F.col("county_key") != "").join(cross, "county_key")
    base = rivers.select("river", "base").distinct()
    by_stream = g.where((F.col("county_key") == "") & (F.col("stream_key") != "")).join(base, F.col("stream_key") == F.col("base"))
    both = by_county.unionByName(by_stream, allowMissingColumns=True)
    m = mapped.select("river", ditch_key("name").alias("key")).distinct().withColumn("is_mapped", F.lit(True))
    j = both.join(m, ["river", "key"], "left")
    on_stream = (F.col("stream_key") != "") & ((F.col("stream_key") == F.col("base")) | F.startswith(F.col("stream_key"), F.concat("base", F.lit(" "))))
    keep = F.when(F.col("stream_key") != "", on_stream).otherwise(F.coalesce("is_mapped", F.lit(False)) & (F.col("county_key") != ""))
    return j.where(keep).select("river", "name", "key", F.when(on_stream, "stream").otherwise("map").alias("basis")).distinct()


def ditch_list(governed: DataFrame, mapped: DataFrame) -> DataFrame:
    """Ditches of each river once per normalised name, the governed spelling winning."""
    m = mapped.select("river", ditch_key("name").alias("key"), "segment", F.col("name").alias("mapped_name"))
    m = pick_row(m, ["river", "key"], [F.col("segment")], last=False)
    g = governed.groupBy("river", "key").agg(F.min("name").alias("governed_name"))
    return m.join(g, ["river", "key"], "full_outer").select("river", "key", F.coalesce("governed_name", "mapped_name").alias("name"), "segment", F.col("governed_name").isNotNull().alias("governed"))
