"""Column expressions shared by the operators. All stay inside Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import EARTH_M, RATING_CLASSES


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- calendar -------------------------------------------------------------

def water_year(d: str | Column) -> Column:
    """October to September, named for the year it ends in."""
    d = col(d)
    return F.year(d) + (F.month(d) >= 10).cast("int")


def water_year_start(d: str | Column) -> Column:
    return F.make_date(water_year(d) - 1, F.lit(10), F.lit(1))


def same_day_in(year: Column, d: str | Column) -> Column:
    """The month and day of ``d`` in another year, the 29th of February becoming the 28th."""
    d = col(d)
    first = F.make_date(year, F.month(d), F.lit(1))
    return F.make_date(year, F.month(d), F.least(F.dayofmonth(d), F.dayofmonth(F.last_day(first))))


def week_start(d: str | Column) -> Column:
    return F.to_date(F.date_trunc("week", col(d)))


def week_of_year(d: str | Column) -> Column:
    """0..51; the short last week folds into week 51."""
    return F.least(F.floor((F.dayofyear(col(d)) - 1) / 7).cast("int"), F.lit(51))


def doy366(d: str | Column) -> Column:
    """Day number in a leap calendar, so the first of March is always 61."""
    d = col(d)
    return F.dayofyear(F.make_date(F.lit(2000), F.month(d), F.dayofmonth(d)))


def month_day(d: str | Column) -> Column:
    d = col(d)
    return F.month(d) * 100 + F.dayofmonth(d)


def water_day(d: str | Column) -> Column:
    """0..365 position of a calendar day in water-year order on a leap calendar."""
    d = col(d)
    anchor = F.make_date(
        F.when(F.month(d) >= 10, F.lit(2003)).otherwise(F.lit(2004)), F.month(d), F.dayofmonth(d))
    return F.date_diff(anchor, F.lit("2003-10-01").cast("date"))


def season_day(d: str | Column) -> Column:
    """0..364 day of the water year without the 29th of February, which gives null."""
    d = col(d)
    raw = F.date_diff(d, water_year_start(d))
    leap = F.dayofmonth(F.last_day(F.make_date(water_year(d), F.lit(2), F.lit(1)))) == 29
    shifted = raw - (leap & F.month(d).between(3, 9)).cast("int")
    return F.when((F.month(d) == 2) & (F.dayofmonth(d) == 29), None).otherwise(shifted)


def local_to_utc(wall: str | Column, zone: str) -> Column:
    """UTC instant of a local wall time; null where the clock skips or repeats that hour."""
    wall = col(wall)
    utc = F.to_utc_timestamp(wall, zone)
    exists = F.from_utc_timestamp(utc, zone) == wall
    hour = F.expr("INTERVAL 1 HOUR")
    repeated = (F.from_utc_timestamp(utc + hour, zone) == wall) | (
        F.from_utc_timestamp(utc - hour, zone) == wall)
    return F.when(exists & ~repeated, utc)


def epoch_millis(ms: str | Column) -> Column:
    return F.timestamp_millis(col(ms).cast("bigint"))


# ---- numbers --------------------------------------------------------------

def celsius(f: str | Column) -> Column:
    return (col(f) - 32.0) * 5.0 / 9.0


def classify(pct: str | Column) -> Column:
    """Five-class label of a percentile; null in, null out."""
    pct = col(pct)
    out = F.when(pct.isNull() | F.isnan(pct), None)
    for upper, label in RATING_CLASSES:
        out = out.when(pct < upper, label)
    return out.otherwise(RATING_CLASSES[-1][1])


def midrank(value: str | Column, base: str | Column, use: Column | None = None) -> Column:
    """Aggregate: share of the base values below ``value``, ties counting half, in percent."""
    value, base = col(value), col(base)
    ok = base.isNotNull() if use is None else (use & base.isNotNull())
    n = F.count_if(ok)
    below = F.count_if(ok & (base < value))
    equal = F.count_if(ok & (base == value))
    return F.when(n > 0, F.lit(100.0) * (below + 0.5 * equal) / n)


def haversine_m(lat1, lon1, lat2, lon2, radius: float = EARTH_M) -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(h))


def dms_to_degrees(text: str | Column) -> Column:
    """Decimal degrees from degrees, minutes, seconds and a compass letter; south and west negative."""
    pattern = r"^\s*(\d+)\D+(\d+)\D+([\d.]+)\D*([NSEW])"
    part = lambda i: F.regexp_extract(col(text), pattern, i)
    size = part(1).try_cast("double") + part(2).try_cast("double") / 60 + part(3).try_cast("double") / 3600
    return F.when(part(4).isin("S", "W"), -size).otherwise(size)


def utm_to_degrees(easting: str | Column, northing: str | Column, meridian: float) -> tuple[Column, Column]:
    """Latitude and longitude of a northern UTM point on the GRS80 ellipsoid (series inverse)."""
    a, f, k0 = 6378137.0, 1 / 298.257222101, 0.9996
    n = f / (2 - f)
    scale = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi, eta = col(northing) / (k0 * scale), (col(easting) - 500000.0) / (k0 * scale)
    xi2, eta2 = xi, eta
    for j, b in enumerate(beta, start=1):
        xi2 = xi2 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta2 = eta2 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi2) / F.cosh(eta2))
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = F.lit(meridian) + F.degrees(F.atan2(F.sinh(eta2), F.cos(xi2)))
    return F.degrees(lat), lon


# ---- text -----------------------------------------------------------------

# Accented letters and the plain letters they reduce to.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
UNACCENTED = "aaaaaaeeeeiiiiooooouuuuncyyAAAAAAEEEEIIIIOOOOOUUUUNCY"


def plain(text: str | Column) -> Column:
    """Lower case without accents or other non-ASCII characters."""
    flat = F.translate(col(text), ACCENTED, UNACCENTED)
    return F.lower(F.regexp_replace(flat, r"[^\x00-\x7F]", ""))


def slug(text: str | Column) -> Column:
    return F.regexp_replace(F.regexp_replace(plain(text), r"[^a-z0-9]+", "-"), r"^-|-$", "")


def nice_name(text: str | Column) -> Column:
    """Title case for names written all in capitals, keeping a trailing state code upper case."""
    name = F.regexp_replace(F.trim(col(text)), r"\.+$", "")
    titled = F.initcap(F.lower(name))
    for code in ("NM", "CO", "TX", "AZ", "OK", "UT"):
        titled = F.regexp_replace(titled, rf", {code.title()}\b", f", {code}")
    return F.when(F.upper(name) == name, titled).otherwise(name)


def repair_name(text: str | Column) -> Column:
    """Blank becomes null; an inverted question mark inside a word was once an n with tilde."""
    fixed = F.regexp_replace(F.trim(col(text)), "(?<=\\w)\u00bf(?=\\w)", "\u00f1")
    return F.nullif(fixed, F.lit(""))


def priority_of(source: str | Column, order: Sequence[str]) -> Column:
    """Position of a value in an ordered list, unknown values last."""
    pos = F.array_position(F.array(*[F.lit(s) for s in order]), col(source))
    return F.when(pos > 0, pos - 1).otherwise(F.lit(len(order))).cast("int")
