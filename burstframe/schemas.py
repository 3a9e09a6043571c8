"""Table schemas and fixed dimension values."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(), "d": T.DoubleType(), "l": T.LongType(), "i": T.IntegerType(), "b": T.BooleanType(),
    "ts": T.TimestampType(), "m": T.MapType(T.StringType(), T.DoubleType()), "as": T.ArrayType(T.StringType()),
    "ad": T.ArrayType(T.DoubleType()),
}


def _struct(spec: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split(":") for f in spec.split())])


BURSTS = _struct(
    "burst_name:s trigger_time:d ra:d dec:d error_radius:d redshift:d redshift_err:d t90:d t90_err:d classification:s "
    "discovery_mission:s galactic_lat:d galactic_lon:d notes:s created_at:ts updated_at:ts")
OBSERVATIONS = _struct(
    "obs_id:l burst_name:s mission:s instrument:s start_time:d end_time:d exposure:d energy_min:d energy_max:d "
    "data_path:s data_url:s created_at:ts")
PHOTONS = _struct("burst_id:s detector:s t:d energy:d")
LIGHTCURVES = _struct(
    "burst_id:s band:s bin_idx:l t:d rate:d rate_err:d counts:l energy_min:d energy_max:d binsize:d mission:s "
    "instrument:s time_ref:d bg_rate:d bg_rate_err:d")
LIGHTCURVE_SUMMARY = _struct(
    "burst_name:s instrument:s band:s time_start:d time_end:d rate:d rate_err:d bg_rate:d bg_rate_err:d binsize:d")
SPECTRA = _struct(
    "burst_id:s channel:i energy:d energy_err:d counts:d counts_err:d exposure:d area:d backscale:d quality:i "
    "response_file:s background_file:s")
SPECTRAL_FITS = _struct(
    "burst_id:s model:s params:m errors:m energy_flux:d photon_flux:d cstat:d dof:i aic:d bic:d fit_quality:s "
    "fit_success:b")
AFTERGLOW_POINTS = _struct("burst_id:s band:s t:d flux:d flux_err:d")
AFTERGLOW_PARAMS = _struct(
    "burst_id:s band:s decay_index:d decay_index_err:d break_time:d break_time_err:d post_break_index:d "
    "post_break_index_err:d plateau_flux:d plateau_duration:d has_plateau:b has_jet_break:b jet_angle:d "
    "closure_relation:s")
CIRCULARS = _struct(
    "circular_number:l burst_name:s title:s authors:s date:s raw_text:s parsed_data:s extracted_redshift:d "
    "extracted_t90:d extracted_ra:d extracted_dec:d interpretation:s")
FLUX_MEASUREMENTS = _struct(
    "burst_name:s time_mjd:d instrument:s wavelength_angstrom:d energy_kev:d flux:d flux_err:d flux_units:s "
    "reference:s is_upper_limit:b")
XRT_FLUX = _struct(
    "burst_id:s t:d t_err_pos:d t_err_neg:d flux_density:d flux_density_err_pos:d flux_density_err_neg:d "
    "photon_index:d photon_index_err_pos:d photon_index_err_neg:d reference_energy:d")
BURST_INFO = _struct(
    "burst_name:s fermi_trigger_id:s fermi_bn_id:s swift_trigger_id:s ra:d dec:d ra_str:s dec_str:s redshift:d t90:d "
    "classification:s missions:as num_circulars:l")

TABLES = {
    "bursts": BURSTS, "observations": OBSERVATIONS, "lightcurve_summary": LIGHTCURVE_SUMMARY,
    "spectral_fits": SPECTRAL_FITS, "afterglow_params": AFTERGLOW_PARAMS, "circulars": CIRCULARS,
    "flux_measurements": FLUX_MEASUREMENTS,
}
UNIQUE_KEYS = {"bursts": ["burst_name"], "circulars": ["circular_number"]}

# Fields of a parsed circular, as the JSON contract states them.
FLUX_ROW = T.StructType([
    T.StructField("time_seconds_since_trigger", T.DoubleType()), T.StructField("wavelength_microns", T.DoubleType()),
    T.StructField("frequency_hz", T.DoubleType()), T.StructField("energy_band_kev", T.StringType()),
    T.StructField("flux_value", T.DoubleType()), T.StructField("flux_error", T.DoubleType()), T.StructField("units", T.StringType()),
    T.StructField("instrument", T.StringType()), T.StructField("observation_type", T.StringType()),
])
PARSED_CIRCULAR = T.StructType([
    T.StructField("grb_name", T.StringType()),
    T.StructField("trigger_time", T.StringType()),
    T.StructField("coordinates", T.StructType([
        T.StructField("ra_degrees", T.DoubleType()), T.StructField("dec_degrees", T.DoubleType()),
        T.StructField("ra_hms", T.StringType()), T.StructField("dec_dms", T.StringType()),
        T.StructField("positional_uncertainty_arcmin", T.DoubleType())])),
    T.StructField("redshift", T.StructType([
        T.StructField("z", T.DoubleType()), T.StructField("z_uncertainty", T.DoubleType()), T.StructField("measurement_type", T.StringType())])),
    T.StructField("t90", T.StructType([T.StructField("value_seconds", T.DoubleType()), T.StructField("uncertainty_seconds", T.DoubleType())])),
    T.StructField("spectral_parameters", T.StructType([
        T.StructField("epeak_kev", T.DoubleType()), T.StructField("epeak_uncertainty", T.DoubleType()),
        T.StructField("photon_index_alpha", T.DoubleType()), T.StructField("alpha_uncertainty", T.DoubleType()),
        T.StructField("high_energy_index_beta", T.DoubleType()), T.StructField("beta_uncertainty", T.DoubleType()),
        T.StructField("fit_method", T.StringType())])),
    T.StructField("flux_measurements", T.ArrayType(FLUX_ROW)),
    T.StructField("instruments", T.ArrayType(T.StringType())),
    T.StructField("key_findings", T.ArrayType(T.StringType())),
    T.StructField("source_references", T.ArrayType(T.StringType())),
])

# ---- fixed values -------------------------------------------------------------------------

# Detector axes in spacecraft coordinates: name, azimuth, zenith (degrees), as published for the monitor.
DETECTORS = [
    ("n0", 45.89, 20.58), ("n1", 45.11, 45.31), ("n2", 58.44, 90.21), ("n3", 314.87, 45.24),
    ("n4", 303.15, 90.27), ("n5", 3.35, 89.79), ("n6", 224.93, 20.43), ("n7", 224.62, 46.18),
    ("n8", 236.61, 89.97), ("n9", 135.19, 45.55), ("na", 123.73, 90.42), ("nb", 183.74, 90.32),
    ("b0", 0.0, 90.0), ("b1", 180.0, 90.0),
]

# Energy bands (keV).
SWIFT_BANDS = [("15-25", 15.0, 25.0), ("25-50", 25.0, 50.0), ("50-100", 50.0, 100.0), ("100-350", 100.0, 350.0)]

# Typical parameter ranges.
TYPICAL_RANGES = [
    ("redshift", 0.0, 20.0), ("t90", 0.01, 10000.0), ("epeak", 10.0, 10000.0), ("alpha", -2.0, 0.0),
    ("beta", -5.0, 0.0), ("decay_index", -3.0, 2.0), ("break_time", 0.1, 1e6),
]

# Accepted names: value, enum name.
MISSIONS = [
    ("Swift", "SWIFT"), ("Fermi", "FERMI"), ("INTEGRAL", "INTEGRAL"), ("MAXI", "MAXI"), ("HXMT", "HXMT"),
    ("AGILE", "AGILE"), ("Suzaku", "SUZAKU"), ("XMM-Newton", "XMM"), ("Chandra", "CHANDRA"), ("RXTE", "RXTE"),
]
BURST_CLASSES = [("Short", "SHORT"), ("Long", "LONG"), ("Ultra-long", "ULTRA_LONG"), ("Special", "SPECIAL")]
SPECTRAL_MODELS = [
    ("Band", "BAND"), ("CPL", "CPL"), ("PL", "PL"), ("BBody", "BBODY"), ("SBPL", "SBPL"), ("BknPower", "BKNPOWER"),
    ("Comptonized", "COMPTONIZED"),
]

# Catalog columns and units: ICRS to Galactic rotation (published J2000 matrix).
GALACTIC_MATRIX = [
    (-0.0548755604162154, -0.8734370902348850, -0.4838350155487132),
    (0.4941094278755837, -0.4448296299600112, 0.7469822444972189),
    (-0.8676661490190047, -0.1980763734312015, 0.4559837761750669),
]
