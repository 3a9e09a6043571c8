"""Sky and spacecraft geometry as column expressions; vectors are (x, y, z) column triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.schemas import DETECTORS, GALACTIC_MATRIX

Vec = tuple[Column, Column, Column]


def from_radec(ra: Column, dec: Column) -> Vec:
    r, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(r), F.cos(d) * F.sin(r), F.sin(d)


def from_spherical(az: Column, zen: Column) -> Vec:
    a, z = F.radians(az), F.radians(zen)
    return F.sin(z) * F.cos(a), F.sin(z) * F.sin(a), F.cos(z)


def dot(a: Vec, b: Vec) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vec, b: Vec) -> Vec:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def clip1(c: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))


def angle(a: Vec, b: Vec) -> Column:
    return F.degrees(F.acos(clip1(dot(a, b) / (norm(a) * norm(b)))))


def rotate(v: Vec, angle_deg: Column, axis: Vec) -> Vec:
    """Turn ``v`` about ``axis`` (need not be unit length)."""
    n = norm(axis)
    k = tuple(c / n for c in axis)
    ang = F.radians(angle_deg)
    c, s = F.cos(ang), F.sin(ang)
    kv, along = cross(k, v), dot(k, v)
    return tuple(v[i] * c + kv[i] * s + k[i] * along * (F.lit(1.0) - c) for i in range(3))


def wrap360(deg: Column) -> Column:
    return F.when(deg < 0, deg + F.lit(360.0)).otherwise(deg)


def to_radec(v: Vec) -> tuple[Column, Column]:
    return wrap360(F.degrees(F.atan2(v[1], v[0]))), F.degrees(F.asin(clip1(v[2])))


def spacecraft_to_sky(ra_x, dec_x, ra_z, dec_z, theta, phi) -> tuple[Column, Column]:
    """(ra, dec) of a direction given by zenith ``theta`` and azimuth ``phi`` of the spacecraft.

    Turning X about Z by phi and then Z about the resulting Y by theta lands on
    cos(t) Z + sin(t) (cos(p) X' + sin(p) Z x X') with X' the part of X normal to Z, normalised;
    written out that way each axis enters once.
    """
    x, z = from_radec(ra_x, dec_x), from_radec(ra_z, dec_z)
    along = dot(x, z)
    scale = F.sin(F.radians(theta)) / F.sqrt(F.lit(1.0) - along * along)
    a, b, c = F.cos(F.radians(phi)) * scale, F.sin(F.radians(phi)) * scale, F.cos(F.radians(theta))
    y = cross(z, x)
    return to_radec(tuple(z[i] * (c - along * a) + x[i] * a + y[i] * b for i in range(3)))


def sky_to_spacecraft(ra_x, dec_x, ra_z, dec_z, ra, dec) -> tuple[Column, Column]:
    """(theta, phi) of a sky position."""
    v, x, z = from_radec(ra, dec), from_radec(ra_x, dec_x), from_radec(ra_z, dec_z)
    y = cross(z, x)
    return angle(v, z), wrap360(F.degrees(F.atan2(dot(y, v), dot(x, v))))


def separation(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle distance in degrees, stable at all separations."""
    d1, d2, dl = F.radians(dec1), F.radians(dec2), F.radians(ra2 - ra1)
    a = F.cos(d2) * F.sin(dl)
    b = F.cos(d1) * F.sin(d2) - F.sin(d1) * F.cos(d2) * F.cos(dl)
    c = F.sin(d1) * F.sin(d2) + F.cos(d1) * F.cos(d2) * F.cos(dl)
    return F.degrees(F.atan2(F.sqrt(a * a + b * b), c))


def separation_haversine(ra1, dec1, ra2, dec2) -> Column:
    sl = F.sin(F.radians(dec2 - dec1) / F.lit(2.0))
    sr = F.sin(F.radians(ra2 - ra1) / F.lit(2.0))
    a = sl * sl + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * sr * sr
    return F.degrees(F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def quaternion_to_body(v: Vec, q1, q2, q3, q4) -> Vec:
    """Sky vector in the spacecraft frame of an attitude quaternion (scalar last)."""
    two = F.lit(2.0)
    rows = (
        (q1 * q1 - q2 * q2 - q3 * q3 + q4 * q4, two * (q1 * q2 + q3 * q4), two * (q1 * q3 - q2 * q4)),
        (two * (q1 * q2 - q3 * q4), q2 * q2 - q1 * q1 - q3 * q3 + q4 * q4, two * (q2 * q3 + q1 * q4)),
        (two * (q1 * q3 + q2 * q4), two * (q2 * q3 - q1 * q4), q3 * q3 - q1 * q1 - q2 * q2 + q4 * q4),
    )
    return tuple(dot(r, v) for r in rows)


def galactic(ra: Column, dec: Column) -> tuple[Column, Column]:
    """(l, b) in degrees; NULL in, NULL out."""
    v = from_radec(ra, dec)
    g = tuple(dot(tuple(F.lit(m) for m in row), v) for row in GALACTIC_MATRIX)
    return to_radec(g)


def with_detectors(df: DataFrame, extra: list[tuple[str, float, float]] | None = None) -> DataFrame:
    """One row per (input row, detector): a literal array exploded in place, no join."""
    rows = [
        F.struct(F.lit(n).alias("det"), F.lit(a).alias("az"), F.lit(z).alias("zen"), F.lit(n[0]).alias("kind"))
        for n, a, z in DETECTORS + (extra or [])
    ]
    return df.select("*", F.inline(F.array(*rows)))
