"""Time headline queries; prints one JSON line.

Each query runs with nothing kept from earlier ones; kept tables land in a fresh folder.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "event_binning", "event_binning_fixed_grid", "rebin_consecutive", "background_subtraction", "smooth_quadratic",
    "merge_bands_regridded", "duration_t90", "variability", "autocorrelation", "pulse_detection", "hardness_ratio_evolution",
    "discrete_cross_correlation", "burst_duration_and_class", "net_count_durations", "polynomial_background", "detector_selection",
    "power_law_decay_grid", "jet_break_detection", "power_law_spectrum_grid", "energy_and_photon_flux", "full_classification",
    "epeak_eiso_least_squares", "population_comparison", "gravitational_wave_cross_match", "burst_info", "trigger_resolution",
    "json_recovery", "bayesian_blocks_measured", "broken_power_law_fit", "band_spectrum_fit", "spectral_lag_peak_fit", "mixture_fit_full",
]


def main() -> None:
    from burstframe import build_session
    from burstframe.operators.reuse import discard
    from burstframe.plans import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(2 * int(cpus)), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["burst_count"](spark, sf_dir).collect()  # start the session's threads before the clock
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        discard(spark)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
