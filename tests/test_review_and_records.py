"""Reviews recompute what changed only; typed circulars name what does not fit; merged records keep every entry."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstframe.operators import circulars as C
from burstframe.operators import intervals as I

K = ["burst_id", "band"]
LC = "burst_id string, band string, bin_idx long, t double, rate double, rate_err double, counts long, binsize double"


@pytest.fixture(scope="module")
def curves(spark):
    rng = np.random.default_rng(2)
    rows = []
    for burst in ("new", "start", "no", "same", "quiet"):
        t = np.arange(-40, 60, 0.5)
        mean = 20 + 0.1 * t + (0 if burst == "quiet" else 200 * ((t > 0) & (t < 8)))
        for i, (x, n) in enumerate(zip(t, rng.poisson(mean))):
            rows.append((burst, "x", i, float(x), float(n / 0.5), float(np.sqrt(max(n, 1)) / 0.5), int(n), 0.5))
    return spark.createDataFrame(rows, LC).cache()


def test_review_equals_a_run_with_the_overrides(spark, curves):
    ov = spark.createDataFrame([("new", "x", -2.0, 12.0, True), ("start", "x", -1.0, None, None), ("no", "x", 1.0, 2.0, False), ("same", "x", None, None, True)],
                               "burst_id string, band string, tstart double, tstop double, accept boolean").cache()
    plain = I.detector_analysis(curves, K).cache()
    got = {r["burst_id"]: r.asDict() for r in I.review_analysis(curves, plain, ov, K).collect()}
    old = {r["burst_id"]: r.asDict() for r in plain.collect()}
    whole = {r["burst_id"]: r.asDict() for r in I.detector_analysis(curves, K, ov.where("coalesce(accept, true)")).collect()}
    assert set(got) == set(old)
    for burst in ("new", "start"):
        assert got[burst]["method"] == "user_adjusted" and "adjusted" in got[burst]["note"]
        for c in ("tstart", "tstop", "poly_order", "coefficients", "t90", "t90_start", "t50", "chi2_red"):
            assert got[burst][c] == pytest.approx(whole[burst][c])
    assert (got["new"]["tstart"], got["new"]["tstop"]) == (-2.0, 12.0) and got["start"]["tstop"] == old["start"]["tstop"]
    for burst, word in (("no", "rejected"), ("same", "accepted"), ("quiet", "")):
        assert {c: v for c, v in got[burst].items() if c != "note"} == {c: v for c, v in old[burst].items() if c != "note"}
        assert word in got[burst]["note"]
    none = I.review_analysis(curves, plain, ov.limit(0), K)
    assert {r["burst_id"]: r["t90"] for r in none.collect()} == {b: r["t90"] for b, r in old.items()}


def test_typed_circulars(spark):
    rows = [(1, '{"grb_name": "GRB1", "redshift": {"z": "0.5", "z_uncertainty": "?"}, "t90": null, "extra": 1}'), (2, '{"flux_measurements": [{"flux_value": 1}, 7, null, {"flux_value": []}]}'),
            (3, "[]"), (4, None), (5, "{}"), (6, '{"instruments": "XRT", "coordinates": {"ra_degrees": 1.5}}')]
    df = spark.createDataFrame(rows, "id int, text string").withColumn("parsed", F.try_parse_json("text")).withColumn("redshift", F.lit("clash"))
    got = {r["id"]: r for r in C.typed_circulars(df).drop("parsed").collect()}
    assert got[1]["grb_name"] == "GRB1" and got[1]["redshift"]["z"] == 0.5 and got[1]["problems"] == ["redshift.z_uncertainty"]
    assert [m and m["flux_value"] for m in got[2]["flux_measurements"]] == [1.0, None, None, None]
    assert got[2]["problems"] == ["flux_measurements[1]", "flux_measurements[3].flux_value"]
    assert got[3]["problems"] == [""] and got[4]["problems"] == [] and got[5]["problems"] == [] and got[5]["redshift"] is None
    assert got[6]["problems"] == ["instruments"] and got[6]["coordinates"]["ra_degrees"] == 1.5


def test_merged_record_in_parts(spark):
    flux = lambda *v: [(float(x), 1.0) for x in v]
    rows = [("a", 2, 9.0, flux(4, 5), ["Z", "B"], ["f"]), ("a", 1, None, flux(1, 2, 3), ["B", None], ["g", "f"]), ("b", 1, 3.0, None, None, []), (None, 1, 1.0, flux(7), ["Q"], ["h"])]
    df = spark.createDataFrame(rows, "burst_id string, seq int, t90 double, flux_measurements array<struct<flux_value double, time double>>, instruments array<string>, key_findings array<string>")
    one = {r["burst_id"]: r for r in C.burst_record(df.where("burst_id IS NOT NULL")).collect()}
    assert [m["flux_value"] for m in one["a"]["flux_measurements"]] == [1, 2, 3, 4, 5] and one["a"]["t90"] is None and one["a"]["sources_count"] == 2
    assert one["a"]["instruments"] == ["B", "Z"] and one["a"]["key_findings"] == ["f", "g"]
    assert one["b"]["flux_measurements"] == [] and one["b"]["t90"] == 3.0 and one["b"]["instruments"] == []
    parts = sorted((r for r in C.burst_record(df, size=2).where("burst_id = 'a'").collect()), key=lambda r: r["part"])
    assert [[m["flux_value"] for m in r["flux_measurements"]] for r in parts] == [[1, 2], [3, 4], [5]] and parts[0]["instruments"] == ["B", "Z"] and parts[1]["instruments"] == []
    assert C.burst_record(df.limit(0)).count() == 0
