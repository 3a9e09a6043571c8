"""Queries over geometry and pointing."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.functions import geometry as G
from burstframe.operators import pointing as P
from burstframe.plans.registry import query, r6
from burstframe.schemas import DETECTORS, GALACTIC_MATRIX
from burstframe.sources import views as V

# Spacecraft axes per burst: Z from the key, X on the equator 90 degrees away, so they are orthogonal.
V.DUCK_VIEWS["pointings"] = (("bursts",), """
    SELECT burst_id, ra, dec, (burst_id * 61.803e0 + 90) % 360e0 AS ra_scx, 0e0 AS dec_scx,
           (burst_id * 61.803e0) % 360e0 AS ra_scz, (burst_id % 171) - 85e0 AS dec_scz,
           sin(burst_id * 0.7e0) / 2 AS q1, cos(burst_id * 0.7e0) / 2 AS q2, sin(burst_id * 0.3e0) * sqrt(0.75e0) AS q3,
           cos(burst_id * 0.3e0) * sqrt(0.75e0) AS q4 FROM bursts""")


def pointings(spark, d):
    k = F.col("burst_id").cast("double")
    return V.bursts(spark, d).select(
        "burst_id", "ra", "dec", ((k * 61.803 + 90) % 360.0).alias("ra_scx"), F.lit(0.0).alias("dec_scx"),
        (k * 61.803 % 360.0).alias("ra_scz"), (F.col("burst_id") % 171 - 85.0).alias("dec_scz"),
        (F.sin(k * 0.7) / 2).alias("q1"), (F.cos(k * 0.7) / 2).alias("q2"),
        (F.sin(k * 0.3) * F.sqrt(F.lit(0.75))).alias("q3"), (F.cos(k * 0.3) * F.sqrt(F.lit(0.75))).alias("q4"))


# -- small SQL text builders: vectors are triples of expressions
def s_radec(ra, dec):
    return (f"(cos(radians({dec})) * cos(radians({ra})))", f"(cos(radians({dec})) * sin(radians({ra})))",
            f"sin(radians({dec}))")


def s_dot(a, b):
    return "(" + " + ".join(f"{p} * {q}" for p, q in zip(a, b)) + ")"


def s_cross(a, b):
    return (f"({a[1]} * {b[2]} - {a[2]} * {b[1]})", f"({a[2]} * {b[0]} - {a[0]} * {b[2]})",
            f"({a[0]} * {b[1]} - {a[1]} * {b[0]})")


def s_angle(a, b):
    return f"degrees(acos(greatest(-1, least(1, {s_dot(a, b)} / sqrt({s_dot(a, a)} * {s_dot(b, b)})))))"


def s_sep(ra1, dec1, ra2, dec2):
    d1, d2, dl = f"radians({dec1})", f"radians({dec2})", f"radians({ra2} - {ra1})"
    return (f"degrees(atan2(sqrt(pow(cos({d2}) * sin({dl}), 2) + pow(cos({d1}) * sin({d2}) - sin({d1}) * cos({d2}) * "
            f"cos({dl}), 2)), sin({d1}) * sin({d2}) + cos({d1}) * cos({d2}) * cos({dl})))")


def s_wrap(e):
    return f"CASE WHEN {e} < 0 THEN {e} + 360 ELSE {e} END"


DET_VALUES = ", ".join(f"('{n}', {a!r}::DOUBLE, {z!r}::DOUBLE)" for n, a, z in DETECTORS)
Z, X, S = s_radec("ra_scz", "dec_scz"), s_radec("ra_scx", "dec_scx"), s_radec("ra", "dec")
# a body direction (theta, phi) in sky axes when X and Z are orthogonal: sin(t)cos(p) X + sin(t)sin(p) Y + cos(t) Z
BODY_SKY = [f"(sin(radians(zen)) * cos(radians(az)) * x{i} + sin(radians(zen)) * sin(radians(az)) * y{i} "
            f"+ cos(radians(zen)) * z{i})" for i in range(3)]
AXES = ", ".join(f"{X[i]} AS x{i}, {s_cross(Z, X)[i]} AS y{i}, {Z[i]} AS z{i}" for i in range(3))


@query("vector_algebra", "pointings", f"""
SELECT burst_id, round({s_dot(X, S)}, 6) + 0e0 AS dot_xs, round({s_cross(Z, S)[0]}, 6) + 0e0 AS cross_x,
       round({s_cross(Z, S)[2]}, 6) + 0e0 AS cross_z, round({s_angle(Z, S)}, 5) AS z_angle,
       round(sin(radians(55e0)) * cos(radians(dec)), 6) + 0e0 AS sph_x FROM pointings""")
def _(spark, d):
    c = F.col
    p = pointings(spark, d)
    x, z, s = (G.from_radec(c(a), c(b)) for a, b in (("ra_scx", "dec_scx"), ("ra_scz", "dec_scz"), ("ra", "dec")))
    zero = F.lit(0.0)
    return p.select(
        "burst_id", (r6(G.dot(x, s)) + zero).alias("dot_xs"), (r6(G.cross(z, s)[0]) + zero).alias("cross_x"),
        (r6(G.cross(z, s)[2]) + zero).alias("cross_z"), r6(G.angle(z, s), 5).alias("z_angle"),
        (r6(G.from_spherical(c("dec"), F.lit(55.0))[0]) + zero).alias("sph_x"))


@query("spacecraft_to_sky", "pointings", f"""
WITH a AS (SELECT burst_id, ra AS az, dec + 90 AS zen, {AXES} FROM pointings)
SELECT burst_id, round({s_wrap(f"degrees(atan2({BODY_SKY[1]}, {BODY_SKY[0]}))")}, 5) AS sky_ra,
       round(degrees(asin(greatest(-1, least(1, {BODY_SKY[2]})))), 5) AS sky_dec FROM a""")
def _(spark, d):
    c = F.col
    ra, dec = G.spacecraft_to_sky(c("ra_scx"), c("dec_scx"), c("ra_scz"), c("dec_scz"), c("dec") + 90.0, c("ra"))
    return pointings(spark, d).select("burst_id", r6(ra, 5).alias("sky_ra"), r6(dec, 5).alias("sky_dec"))


@query("sky_to_spacecraft", "pointings", f"""
SELECT burst_id, round({s_angle(Z, S)}, 5) AS theta,
       round({s_wrap(f"degrees(atan2({s_dot(s_cross(Z, X), S)}, {s_dot(X, S)}))")}, 5) AS phi FROM pointings""")
def _(spark, d):
    c = F.col
    th, ph = G.sky_to_spacecraft(c("ra_scx"), c("dec_scx"), c("ra_scz"), c("dec_scz"), c("ra"), c("dec"))
    return pointings(spark, d).select("burst_id", r6(th, 5).alias("theta"), r6(ph, 5).alias("phi"))


DET_SKY = f"""
WITH a AS (SELECT *, {AXES} FROM pointings),
b AS (SELECT a.*, det, az, zen FROM a, (VALUES {DET_VALUES}) v(det, az, zen)),
e AS (SELECT *, degrees(atan2({BODY_SKY[1]}, {BODY_SKY[0]})) AS dra,
        degrees(asin(greatest(-1, least(1, {BODY_SKY[2]})))) AS ddec FROM b),
ang AS (SELECT *, {s_sep("ra", "dec", "dra", "ddec")} AS angle FROM e)"""


@query("detector_angles", "pointings", f"{DET_SKY} SELECT burst_id, det, round(angle, 5) AS angle FROM ang")
def _(spark, d):
    return P.detector_angles(pointings(spark, d)).select("burst_id", "det", r6("angle", 5).alias("angle"))


@query("angular_distance", "pointings", f"""
SELECT burst_id, round({s_sep("ra", "dec", "ra_scz", "dec_scz")}, 5) AS separation,
  round(degrees(2 * atan2(sqrt(h), sqrt(1 - h))), 5) AS haversine FROM
  (SELECT *, pow(sin(radians(dec_scz - dec) / 2), 2)
     + cos(radians(dec)) * cos(radians(dec_scz)) * pow(sin(radians(ra_scz - ra) / 2), 2) AS h FROM pointings)""")
def _(spark, d):
    args = [F.col(x) for x in ("ra", "dec", "ra_scz", "dec_scz")]
    return pointings(spark, d).select("burst_id", r6(G.separation(*args), 5).alias("separation"),
                                      r6(G.separation_haversine(*args), 5).alias("haversine"))


QUAT_SQL = f"""
WITH q AS (SELECT *, {S[0]} AS sx, {S[1]} AS sy, {S[2]} AS sz FROM pointings),
b AS (SELECT burst_id, (q1*q1 - q2*q2 - q3*q3 + q4*q4) * sx + 2*(q1*q2 + q3*q4) * sy + 2*(q1*q3 - q2*q4) * sz AS vx,
        2*(q1*q2 - q3*q4) * sx + (-q1*q1 + q2*q2 - q3*q3 + q4*q4) * sy + 2*(q2*q3 + q1*q4) * sz AS vy,
        2*(q1*q3 + q2*q4) * sx + 2*(q2*q3 - q1*q4) * sy + (-q1*q1 - q2*q2 + q3*q3 + q4*q4) * sz AS vz FROM q),
w AS (SELECT burst_id, det, zen, vx, vy, vz, sin(radians(zen)) * cos(radians(az)) AS dx,
        sin(radians(zen)) * sin(radians(az)) AS dy, cos(radians(zen)) AS dz FROM b, (VALUES {DET_VALUES}) v(det, az, zen))
SELECT burst_id, det, round({s_angle(("vx", "vy", "vz"), ("dx", "dy", "dz"))}, 5) AS angle FROM w"""


@query("detector_angles_quaternion", "pointings", QUAT_SQL)
def _(spark, d):
    return P.detector_angles_quaternion(pointings(spark, d)).select("burst_id", "det", r6("angle", 5).alias("angle"))


@query("detector_angles_approximate", "pointings", f"""
SELECT burst_id, det, round(abs({s_sep("ra", "dec", "ra_scz", "dec_scz")} - zen), 5) AS angle
FROM pointings, (VALUES {DET_VALUES}) v(det, az, zen)""")
def _(spark, d):
    return P.detector_angles_approximate(pointings(spark, d)).select("burst_id", "det", r6("angle", 5).alias("angle"))


@query("detector_selection", "pointings", f"""
{DET_SKY},
k AS (SELECT *, row_number() OVER (PARTITION BY burst_id, det[1] ORDER BY angle, det) AS rank FROM ang)
SELECT burst_id, det, det[1] AS kind, rank, round(angle, 5) AS angle, angle <= 60 AS within_max_angle FROM k
WHERE (det[1] = 'n' AND rank <= 3) OR (det[1] = 'b' AND rank <= 1)""")
def _(spark, d):
    p = pointings(spark, d).drop("q1", "q2", "q3", "q4")
    for q in ("q1", "q2", "q3", "q4"):
        p = p.withColumn(q, F.lit(None).cast("double"))
    sel = P.select_detectors(P.best_angles(p), "burst_id")
    return sel.select("burst_id", "det", "kind", F.col("rank").cast("long").alias("rank"), r6("angle", 5).alias("angle"),
                      "within_max_angle")


@query("detector_fallback_by_name", "photons", """
WITH m AS (SELECT DISTINCT burst_id, CASE WHEN energy < 100 THEN 'b' ELSE 'n' END || (floor(energy)::BIGINT % 10) AS det
           FROM photons),
r AS (SELECT *, row_number() OVER (PARTITION BY burst_id, det[1] ORDER BY det) AS rank FROM m)
SELECT burst_id, det, det[1] AS kind, rank, 0e0 AS angle FROM r
WHERE (det[1] = 'n' AND rank <= 3) OR (det[1] = 'b' AND rank <= 1)""")
def _(spark, d):
    det = F.concat(F.when(F.col("energy") < 100, "b").otherwise("n"), (F.floor("energy") % 10).cast("string"))
    out = P.fallback_detectors(V.photons(spark, d).select("burst_id", det.alias("det")), "burst_id")
    return out.withColumn("rank", F.col("rank").cast("long"))


GAL = [s_dot([f"({m!r}::DOUBLE)" for m in row], S) for row in GALACTIC_MATRIX]


@query("galactic_coordinates", "pointings", f"""
SELECT burst_id, round({s_wrap(f"degrees(atan2({GAL[1]}, {GAL[0]}))")}, 5) AS l,
       round(degrees(asin(greatest(-1, least(1, {GAL[2]})))), 5) AS b FROM pointings""")
def _(spark, d):
    gl, gb = G.galactic(F.col("ra"), F.col("dec"))
    return pointings(spark, d).select("burst_id", r6(gl, 5).alias("l"), r6(gb, 5).alias("b"))


@query("box_search", "bursts", """
SELECT burst_id, round(ra, 9) AS ra, round(dec, 9) AS dec FROM bursts WHERE ra BETWEEN 100 - 30 AND 100 + 30 AND dec BETWEEN 20 - 30 AND 20 + 30""")
def _(spark, d):
    return P.box_search(V.bursts(spark, d), 100.0, 20.0, 30.0).select("burst_id", r6("ra", 9).alias("ra"), r6("dec", 9).alias("dec"))


@query("cone_search", "bursts", f"""
SELECT burst_id, round(s, 5) AS separation FROM (SELECT burst_id, {s_sep("350e0", "20e0", "ra", "dec")} AS s FROM bursts)
WHERE s <= 25""")
def _(spark, d):
    return P.cone_search(V.bursts(spark, d), 350.0, 20.0, 25.0).select("burst_id", r6("separation", 5).alias("separation"))
