"""Analysis stages over all bursts at once.

A stage is a function from named tables to named tables.  Stages are picked by name, run in their
fixed order, and a stage whose inputs are absent is skipped; what one burst lacks shows up as NULLs or
rejected rows, not as an exception for the others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstframe.functions import relations as R
from burstframe.functions import spectral_models as M
from burstframe.operators import afterglow as A
from burstframe.operators import catalog as C
from burstframe.operators import circulars as N
from burstframe.operators import classify as K
from burstframe.operators import lightcurve as L
from burstframe.operators import population as P
from burstframe.operators import spectra as S
from burstframe.operators import temporal as T
from burstframe.operators.reuse import keep
from burstframe.operators.series import attach
from burstframe.schemas import TYPICAL_RANGES

Tables = dict[str, DataFrame]
KEY = "burst_id"


def acquisition(t: Tables) -> Tables:
    """Counts of what is available per burst; circular fields and messenger matches where given."""
    out: Tables = {}
    meta = t["bursts"].select(KEY)
    for name in ("photons", "spectra", "afterglow_points", "observations"):
        if name in t:
            n = t[name].groupBy(KEY).agg(F.count(F.lit(1)).alias(f"n_{name}"))
            meta = attach(meta, n, [KEY], "left").withColumn(f"n_{name}", F.coalesce(f"n_{name}", F.lit(0)))
    if "archive" in t:
        out["burst_info"] = N.burst_info(t["archive"])
    if "alerts" in t and "trigger_points" in t:
        out["messenger_matches"] = P.cross_match(t["trigger_points"], t["alerts"], 10.0, 15.0)
    out["metadata"] = meta
    return out


def temporal(t: Tables) -> Tables:
    """Light curves, per-series properties, pulses and hardness."""
    lc = keep(L.bin_events(t["photons"], [KEY, "band"]))
    keys = [KEY, "band"]
    props = T.duration(lc, 0.9, keys, prefix="t90_")
    for part in (T.duration(lc, 0.5, keys, prefix="t50_"), L.find_peak(lc, keys), T.variability(lc, keys), L.fluence(lc, None, keys)):
        props = attach(props, part, keys)
    out = {"light_curves": lc, "temporal_properties": props, "pulses": T.detect_pulses(lc, keys)}
    if "hardness_bands" in t:
        soft, hard = (t["hardness_bands"].first()[c] for c in ("soft", "hard"))
        out["hardness_ratios"] = T.hardness_ratio(lc, hard, soft)
    return out


RANGES = ((15.0, 150.0), (50.0, 300.0), (100.0, 1000.0))


def spectral(t: Tables, models: Sequence[str] = ("Band", "CPL", "PL")) -> Tables:
    """Fits of the models, the best one, fluxes, and luminosities where a redshift is known."""
    fits = keep(S.fit_spectra(keep(t["spectra"]), models, [KEY]))
    best = keep(S.choose_model(fits, KEY))
    p = {n: F.col("params")[n] for n in ("alpha", "beta", "epeak", "index", "norm")}
    ranges = F.array(*[F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi")) for a, b in RANGES])
    flux = best.select(KEY, "model", "params", "fit_success", F.inline(ranges))
    flux = flux.select(KEY, "model", "lo", "hi", M.flux(F.col("model"), p, F.col("fit_success"), F.col("lo"), F.col("hi"), True).alias("energy_flux"))
    z = attach(best, t["bursts"].select(KEY, "redshift"), [KEY], "left")
    derived = z.select(
        KEY, "model", "redshift", F.coalesce(p["epeak"], p["index"]).alias("shape"),
        M.flux(F.col("model"), p, F.col("fit_success"), F.lit(10.0), F.lit(10000.0), True).alias("energy_flux"),
        M.luminosity_distance(F.col("redshift")).alias("dl"), (p["epeak"] * (F.col("redshift") + 1)).alias("epeak_rest"))
    derived = derived.withColumns({
        "eiso": M.isotropic_energy(F.col("energy_flux"), F.col("dl")),
        "lpeak": M.peak_luminosity(F.col("energy_flux"), F.col("redshift"), F.col("dl"))})
    return {"spectral_fits": fits, "model_comparison": best, "energy_fluxes": flux, "derived_quantities": derived}


def afterglow(t: Tables) -> Tables:
    """Decay fits, plateau, jet break, reverse shock and closure relations."""
    rows = A.numbered(t["afterglow_points"], [KEY])
    decay = keep(A.power_law_decay(t["afterglow_points"], [KEY]))
    params = decay.select(KEY, "decay_index", "chi_sq", "dof", "fit_success")
    for part in (A.detect_plateau(rows, [KEY]), A.detect_jet_break(rows, [KEY]), A.reverse_shock(rows, [KEY]).drop("decay_index")):
        params = attach(params, part, [KEY], "left")
    beta = F.lit(1.0)
    closure = decay.filter("fit_success").select(KEY, F.inline(R.closure(F.col("decay_index"), beta)))
    return {"decay_models": decay, "afterglow_params": keep(params), "closure_relations": closure}


def classification(t: Tables) -> Tables:
    """Class, progenitor and relation checks from whatever the earlier stages gave."""
    src = t["bursts"]
    if "afterglow_params" in t:
        src = attach(src, t["afterglow_params"].select(KEY, "decay_index", "has_plateau"), [KEY], "left")
    if "epeak" in src.columns and "redshift" in src.columns:
        src = src.withColumn("epeak_rest", F.col("epeak") * (F.coalesce("redshift", F.lit(0.0)) + 1))
    if "hr_ratio" in src.columns:
        src = src.withColumnRenamed("hr_ratio", "hardness_ratio")
    full = keep(K.full_classification(src))
    keep_cols = ["duration_class", "hardness_class", "supernova_markers", "kilonova_markers", "magnetar_candidate", "collapsar",
                 "compact_merger", "confidence", "best_progenitor"]
    checks = R.all_relations(src)
    names = [n for n in ("amati", "yonetoku", "ghirlanda", "lag_luminosity", "variability_luminosity") if n in checks.columns]
    return {"classification": full.select(KEY, *keep_cols), "correlations": checks.select(KEY, *names)}


RECORDS = ("metadata", "temporal_properties", "pulses", "model_comparison", "derived_quantities", "afterglow_params", "closure_relations",
           "classification", "correlations")


def summary(t: Tables) -> Tables:
    """One record per burst: which tables hold it, one-row results nested, long ones as counts; population position."""
    out = t["bursts"].select(KEY)
    for name in RECORDS:
        if name not in t:
            continue
        df = t[name]
        if name in ("temporal_properties", "pulses", "closure_relations"):
            part = df.groupBy(KEY).agg(F.count(F.lit(1)).alias(f"n_{name}"))
        else:
            values = [c for c in df.columns if c != KEY] or [F.lit(True).alias("present")]  # an empty struct cannot be written
            part = df.select(KEY, F.struct(*values).alias(name))
        out = attach(out, part, [KEY], "left")
    res = {"analysis_results": out}
    numeric = [c for c in ("t90", "epeak", "eiso", "lpeak", "redshift") if c in t["bursts"].columns]
    if numeric:
        res["population_comparison"] = P.population_position(t["bursts"], KEY, numeric)
        res["anomalies"] = P.range_anomalies(t["bursts"], KEY, TYPICAL_RANGES)
    return res


# name -> (function, required inputs), in running order
STAGES: dict[str, tuple[Callable[[Tables], Tables], tuple[str, ...]]] = {
    "acquisition": (acquisition, ("bursts",)),
    "temporal": (temporal, ("photons",)),
    "spectral": (spectral, ("spectra", "bursts")),
    "afterglow": (afterglow, ("afterglow_points",)),
    "classification": (classification, ("bursts",)),
    "summary": (summary, ("bursts",)),
}


def run(
    spark: SparkSession, tables: Tables, stages: Sequence[str] | None = None, skip: Sequence[str] = (), work_list: DataFrame | None = None,
    continue_on_error: bool = True,
) -> tuple[Tables, DataFrame]:
    """(all tables, one status row per stage).  ``work_list`` restricts every input to the named bursts."""
    chosen = list(STAGES) if stages is None else list(stages)
    unknown = [s for s in [*chosen, *skip] if s not in STAGES]
    if unknown:
        raise ValueError(f"unknown stages: {unknown}")
    t = dict(tables)
    if work_list is not None:
        ids = work_list.select(KEY).distinct()
        t = {n: d.join(ids, KEY, "left_semi") if KEY in d.columns else d for n, d in t.items()}
    status = []
    for name, (fn, needed) in STAGES.items():
        missing = [n for n in needed if n not in t]
        if name not in chosen or name in skip:
            status.append((name, "skipped", "not requested"))
        elif missing:
            status.append((name, "skipped", "missing input: " + ", ".join(missing)))
        else:
            try:
                t.update({n: keep(d) for n, d in fn(t).items()})  # completed means written
                status.append((name, "completed", ""))
            except Exception as e:
                if not continue_on_error:
                    raise
                status.append((name, "failed", f"{type(e).__name__}: {e}"))
    return t, spark.createDataFrame(status, "stage string, status string, note string")


def run_from(spark: SparkSession, tables: Tables, stage: str, earlier: Tables) -> tuple[Tables, DataFrame]:
    """Continue at ``stage`` with the tables of an earlier run."""
    names = list(STAGES)
    return run(spark, {**tables, **earlier}, names[names.index(stage):])


def batch_status(bursts: DataFrame, tables: Tables) -> DataFrame:
    """Successful and failed bursts: successful means every result table that was built holds the burst."""
    built = {n: tables[n] for n in ("temporal_properties", "model_comparison", "afterglow_params", "classification") if n in tables}
    per = C.completion_status(bursts, built, KEY)
    ok = F.forall(F.map_values("stages"), lambda v: v)
    return per.groupBy(F.when(ok, "successful").otherwise("failed").alias("status")).agg(F.count(F.lit(1)).alias("count"))
