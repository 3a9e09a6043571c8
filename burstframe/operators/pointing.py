"""Detector angles, detector choice and sky searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burstframe.functions import geometry as G


def detector_angles(df: DataFrame) -> DataFrame:
    """Angle of each detector axis to the source; needs ra, dec, ra_scx, dec_scx, ra_scz, dec_scz."""
    wide = G.with_detectors(df)
    c = F.col
    det_ra, det_dec = G.spacecraft_to_sky(c("ra_scx"), c("dec_scx"), c("ra_scz"), c("dec_scz"), c("zen"), c("az"))
    return wide.withColumn("det_ra", det_ra).withColumn("det_dec", det_dec).withColumn(
        "angle", G.separation(c("ra"), c("dec"), c("det_ra"), c("det_dec")))


def detector_angles_quaternion(df: DataFrame) -> DataFrame:
    """Same from an attitude quaternion q1..q4."""
    c = F.col
    src = G.quaternion_to_body(G.from_radec(c("ra"), c("dec")), c("q1"), c("q2"), c("q3"), c("q4"))
    body = df.select("*", *[v.alias(n) for v, n in zip(src, ("_sx", "_sy", "_sz"))])
    wide = G.with_detectors(body)
    return wide.withColumn(
        "angle", G.angle((c("_sx"), c("_sy"), c("_sz")), G.from_spherical(c("az"), c("zen")))
    ).drop("_sx", "_sy", "_sz")


def detector_angles_approximate(df: DataFrame) -> DataFrame:
    """|angle to the Z axis - zenith of the detector|."""
    z = df.withColumn("_za", G.separation(F.col("ra"), F.col("dec"), F.col("ra_scz"), F.col("dec_scz")))
    return G.with_detectors(z).withColumn("angle", F.abs(F.col("_za") - F.col("zen"))).drop("_za")


def unknown_detectors(names: DataFrame, col: str = "det") -> DataFrame:
    """Names that are no detector."""
    from burstframe.schemas import DETECTORS

    return names.filter(~F.col(col).isin([d[0] for d in DETECTORS]))


def best_angles(df: DataFrame) -> DataFrame:
    """Angle by the best method a row has data for: quaternion, two axes, Z axis only."""
    c = F.col
    wide = G.with_detectors(df)
    src = G.quaternion_to_body(G.from_radec(c("ra"), c("dec")), c("q1"), c("q2"), c("q3"), c("q4"))
    by_q = G.angle(src, G.from_spherical(c("az"), c("zen")))
    dra, ddec = G.spacecraft_to_sky(c("ra_scx"), c("dec_scx"), c("ra_scz"), c("dec_scz"), c("zen"), c("az"))
    staged = wide.withColumns({"_dra": dra, "_ddec": ddec, "_q": by_q})
    by_axes = G.separation(c("ra"), c("dec"), c("_dra"), c("_ddec"))
    by_z = F.abs(G.separation(c("ra"), c("dec"), c("ra_scz"), c("dec_scz")) - c("zen"))
    method = (F.when(c("q4").isNotNull(), "quaternion").when(c("ra_scx").isNotNull(), "axes")
              .when(c("ra_scz").isNotNull(), "approximate"))
    return staged.withColumn("method", method).withColumn(
        "angle", F.when(c("method") == "quaternion", c("_q")).when(c("method") == "axes", by_axes)
        .when(c("method") == "approximate", by_z)).drop("_dra", "_ddec", "_q")


def select_detectors(
    angles: DataFrame, key: str, n_nai: int = 3, n_bgo: int = 1, max_angle: float = 60.0
) -> DataFrame:
    """The closest n of each kind (14 rows per burst, so the window stays tiny)."""
    w = Window.partitionBy(key, "kind").orderBy("angle", "det")
    ranked = angles.withColumn("rank", F.row_number().over(w))
    return ranked.filter(
        ((F.col("kind") == "n") & (F.col("rank") <= n_nai)) | ((F.col("kind") == "b") & (F.col("rank") <= n_bgo))
    ).withColumn("within_max_angle", F.col("angle") <= max_angle)


def fallback_detectors(available: DataFrame, key: str, det: str = "det", n_nai: int = 3, n_bgo: int = 1) -> DataFrame:
    """First detectors by name among those with data; at most 14 names per burst after distinct."""
    kind = F.substring(F.col(det), 1, 1)
    names = available.select(key, F.col(det).alias("det")).distinct().withColumn("kind", kind).filter(
        F.col("kind").isin("n", "b"))
    w = Window.partitionBy(key, "kind").orderBy("det")
    return names.withColumn("rank", F.row_number().over(w)).filter(
        ((F.col("kind") == "n") & (F.col("rank") <= n_nai)) | ((F.col("kind") == "b") & (F.col("rank") <= n_bgo))
    ).select(key, "det", "kind", "rank", F.lit(0.0).alias("angle"))


def box_search(df: DataFrame, ra: float, dec: float, radius: float) -> DataFrame:
    """Plain coordinate box (no wrap at 0/360, no cos(dec)); newest first."""
    return df.filter(
        F.col("ra").between(ra - radius, ra + radius) & F.col("dec").between(dec - radius, dec + radius)
    ).orderBy(F.col("trigger_time").desc_nulls_last())


def cone_search(df: DataFrame, ra: float, dec: float, radius: float) -> DataFrame:
    """Great-circle cone; the declination strip is pushed to the scan, RA wraps correctly."""
    import math

    strip = F.col("dec").between(dec - radius, dec + radius)
    edge = abs(dec) + radius
    if edge < 90:
        half = math.degrees(math.asin(min(1.0, math.sin(math.radians(radius)) / math.cos(math.radians(dec)))))
        lo, hi = (ra - half) % 360, (ra + half) % 360
        inside = F.col("ra").between(lo, hi) if lo <= hi else (F.col("ra") >= lo) | (F.col("ra") <= hi)
        strip = strip & inside if half < 180 else strip
    dist = G.separation(F.lit(ra), F.lit(dec), F.col("ra"), F.col("dec"))
    return df.filter(strip).withColumn("separation", dist).filter(F.col("separation") <= radius)
