"""Spherical geometry, coordinate parsing and tangent-plane projection as Column expressions.

Angles are degrees, separations arcseconds. Nulls propagate; NaN is turned into null at ingestion
(see ``sources``) and never appears here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ARCSEC = 3600.0


def wrap_deg(delta: Column) -> Column:
    """An RA difference brought into [-180, 180)."""
    return F.pmod(delta + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def _trig(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> tuple[Column, ...]:
    da = F.radians(ra2 - ra1)
    d1, d2 = F.radians(dec1), F.radians(dec2)
    return F.sin(da), F.cos(da), F.sin(d1), F.cos(d1), F.sin(d2), F.cos(d2)


def separation_arcsec(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle separation in the form that is exact for tiny and for antipodal angles."""
    sa, ca, s1, c1, s2, c2 = _trig(ra1, dec1, ra2, dec2)
    return F.degrees(F.atan2(F.hypot(c2 * sa, c1 * s2 - s1 * c2 * ca), s1 * s2 + c1 * c2 * ca)) * ARCSEC


def position_angle_deg(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Direction from the first position to the second, east of north, in [0, 360)."""
    sa, ca, s1, c1, s2, c2 = _trig(ra1, dec1, ra2, dec2)
    return F.pmod(F.degrees(F.atan2(sa * c2, c1 * s2 - s1 * c2 * ca)), F.lit(360.0))


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def tan_pix2sky(x: Column, y: Column, crpix1, crpix2, crval1, crval2, cd11, cd12, cd21, cd22) -> tuple[Column, Column]:
    """(ra, dec) of zero-based pixel positions on a tangent plane; the wcs terms are columns or numbers."""
    c = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    dx, dy = x + F.lit(1.0) - c(crpix1), y + F.lit(1.0) - c(crpix2)
    xi, eta = F.radians(c(cd11) * dx + c(cd12) * dy), F.radians(c(cd21) * dx + c(cd22) * dy)
    d0 = F.radians(c(crval2))
    down = F.cos(d0) - eta * F.sin(d0)
    ra = F.pmod(c(crval1) + F.degrees(F.atan2(xi, down)), F.lit(360.0))
    return ra, F.degrees(F.atan2(F.sin(d0) + eta * F.cos(d0), F.hypot(xi, down)))


def tan_sky2pix(ra: Column, dec: Column, crpix1, crpix2, crval1, crval2, cd11, cd12, cd21, cd22) -> tuple[Column, Column]:
    """Zero-based pixel positions of sky positions, the inverse of :func:`tan_pix2sky`."""
    c = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    da, d, d0 = F.radians(ra - c(crval1)), F.radians(dec), F.radians(c(crval2))
    depth = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(da)
    xi = F.degrees(F.try_divide(F.cos(d) * F.sin(da), depth))
    eta = F.degrees(F.try_divide(F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(da), depth))
    det = c(cd11) * c(cd22) - c(cd12) * c(cd21)
    return F.try_divide(c(cd22) * xi - c(cd12) * eta, det) + c(crpix1) - 1.0, F.try_divide(c(cd11) * eta - c(cd21) * xi, det) + c(crpix2) - 1.0


def parse_coordinate(value: Column, is_ra: bool = False) -> Column:
    """Degrees of a header value: a number as it stands, else sexagesimal with ':' or spaces.

    Sexagesimal right ascension counts hours unless its first field is 24 or more. Null where it
    can't be read.
    """
    s = F.trim(value)
    fields = F.transform(F.split(F.when(s.contains(":"), s).otherwise(F.regexp_replace(s, " +", ":")), ":"), lambda p: p.try_cast("double"))
    at = lambda i: F.coalesce(F.get(fields, F.lit(i)), F.when(F.size(fields) <= i, F.lit(0.0)))
    size = F.abs(at(0)) + at(1) / 60.0 + at(2) / 3600.0
    if is_ra:
        size = F.when(F.abs(at(0)) < 24.0, size * 15.0).otherwise(size)
    sexagesimal = F.when(s.startswith("-"), -size).otherwise(size)
    return F.when(s == "", F.lit(None).cast("double")).when(s.contains(":") | s.contains(" "), sexagesimal).otherwise(s.try_cast("double"))


def sexagesimal_to_degrees(value: Column, hours: bool) -> Column:
    """Degrees of a service's sexagesimal string, times 15 for hours."""
    fields = F.split(F.regexp_replace(F.trim(value), "[: ]+", " "), " ")
    part = lambda i: F.coalesce(F.get(fields, F.lit(i)).try_cast("double"), F.lit(0.0))
    size = F.abs(part(0)) + part(1) / 60.0 + part(2) / 3600.0
    signed = F.when(F.trim(value).startswith("-"), -size).otherwise(size)
    return signed * 15.0 if hours else signed


def sexagesimal_text(degrees: Column, hours: bool) -> Column:
    """hh-mm-ss.ss of a right ascension, or Mdd-mm-ss.s style text of a declination for url queries."""
    unit, digits = (F.abs(degrees) / 15.0, 100) if hours else (F.abs(degrees), 10)
    ticks = F.round(unit * 3600.0 * digits).cast("long")
    second = ticks % (60 * digits)
    minute = F.floor(ticks / (60 * digits)) % 60
    whole = F.floor(ticks / (3600 * digits))
    text = F.format_string("%02d-%02d-%02d." + ("%02d" if hours else "%d"), whole, minute, F.floor(second / digits), second % digits)
    return F.when(degrees < 0, F.concat(F.lit("M"), text)).otherwise(text)
