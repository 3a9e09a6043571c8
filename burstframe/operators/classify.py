"""Rule-based classes and progenitor markers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.operators.series import attach


def by_duration(t90: Column, ultra_long: float = 10000.0) -> Column:
    return F.when(t90 < 2, "Short").when(t90 < ultra_long, "Long").when(t90.isNotNull(), "Ultra-long")


def by_hardness(hr: Column, t90: Column) -> Column:
    """Same classes as by_duration for every hardness; NULL hardness or duration gives NULL."""
    return F.when(hr.isNotNull(), by_duration(t90))


def extended_emission(lc: DataFrame, keys: Sequence[str], pos: str = "bin_idx") -> DataFrame:
    """Weak but positive last third after a brighter first third; ``pos`` is the 0-based row position."""
    n = lc.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = attach(lc, n, keys)
    a, b = F.floor(F.col("_n") / 3), F.floor(F.col("_n") * 2 / 3)
    p = F.col(pos)
    m = rows.groupBy(*keys).agg(
        F.avg(F.when(p < a, F.col("rate"))).alias("_e"), F.avg(F.when((p >= a) & (p < b), F.col("rate"))).alias("_m"),
        F.avg(F.when(p >= b, F.col("rate"))).alias("_l"), F.max("_n").alias("_n"))
    ratio = F.try_divide(F.col("_l"), F.col("_e"))
    size = (F.col("_n") >= 5) & (F.floor(F.col("_n") / 3) >= 2) & (F.floor(F.col("_n") * 2 / 3) >= 3)
    flag = size & (F.col("_e") > 0) & (F.col("_l") > 0) & (ratio > 0.01) & (ratio < 0.3) & (F.col("_m") < F.col("_e"))
    return m.select(*keys, F.coalesce(flag, F.lit(False)).alias("has_extended_emission"))


def _opt(df: DataFrame, name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)


def _points(*rules: tuple[Column, int]) -> Column:
    return sum((F.when(c, F.lit(w)).otherwise(F.lit(0)) for c, w in rules), F.lit(0))


def full_classification(df: DataFrame) -> DataFrame:
    """Classes, associations, candidates, confidence and the best progenitor, one projection per step.

    Collapsar and merger markers use the supernova and kilonova *input* fields, not the derived flags.
    """
    cls = F.coalesce(by_duration(F.col("t90")), F.lit("Unknown"))
    hr = by_hardness(_opt(df, "hardness_ratio", None).cast("double"), F.col("t90"))
    base = df.withColumn("duration_class", cls).withColumn("hardness_class", F.coalesce(hr, F.col("duration_class")))
    long_, short = F.col("duration_class") == "Long", F.col("duration_class") == "Short"
    epeak, z = _opt(df, "epeak_rest", 300.0), _opt(df, "redshift", 10.0)
    plateau, extended = _opt(df, "has_plateau", False), _opt(df, "has_extended_emission", False)
    sn_in, kn_in = _opt(df, "supernova_association", False), _opt(df, "kilonova_association", False)
    steps = base.withColumns({
        "supernova_markers": _points((long_, 1), (plateau, 1), (epeak < 200, 1), (z < 2.0, 1)) >= 2,
        "kilonova_markers": _points((short, 1), (extended, 1), (epeak < 100, 1), (_opt(df, "weak_afterglow", False), 1)) >= 2,
        "magnetar_candidate": _points((plateau, 2), (_opt(df, "decay_index", 1.0) < 0.5, 1),
                                      (_opt(df, "has_energy_injection", False), 1), (~long_, -1)) >= 2,
        "collapsar": _points((long_, 2), (sn_in, 2), (z < 3.0, 1), (epeak < 150, 1)) >= 2,
        "compact_merger": _points((short, 2), (kn_in, 2), (extended, 1), (short & (epeak > 200), 1)) >= 2,
    })
    measured = F.col("has_extended_emission").isNotNull() if "has_extended_emission" in df.columns else F.lit(False)
    return steps.withColumn("confidence", confidence((F.col("duration_class") != "Unknown") | measured, [
        F.col(c) for c in ("supernova_markers", "kilonova_markers", "magnetar_candidate", "collapsar",
                           "compact_merger")])).withColumn("best_progenitor", best_progenitor())


def confidence(evidence: Column, markers: Sequence[Column]) -> Column:
    """1 where there is any evidence, scaled by how many of the progenitor markers agree."""
    known = F.when(evidence, F.lit(1.0)).otherwise(F.lit(0.0))
    n = _points(*[(m, 1) for m in markers])
    return F.least(F.lit(1.0), known * F.when(n > 1, F.lit(0.8)).when(n == 1, F.lit(1.1)).otherwise(F.lit(0.6)))


def best_progenitor() -> Column:
    return (
        F.when(F.col("compact_merger"), "Compact object merger (NS-NS or NS-BH)")
        .when(F.col("magnetar_candidate"), "Magnetar-powered jet")
        .when(F.col("collapsar"), "Massive star core collapse")
        .when(F.col("duration_class") == "Short", "Compact object merger (likely)")
        .when(F.col("duration_class") == "Long", "Massive star core collapse (likely)")
        .otherwise("Unknown"))
