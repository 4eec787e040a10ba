"""Table catalogue: column schemas, time columns and default parameters.

Every table starts with ``deployment_id``. Layer A tables read from log text also carry the arrival-order
key ``chunk`` (one bounded input split, orderable) and ``pos`` (position inside it), see ``ordering``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEY = "deployment_id"

TABLES: dict[str, str] = {
    "rga": "ts TIMESTAMP_NTZ, mass BIGINT, current DOUBLE",
    "valve": "ts TIMESTAMP_NTZ, chamber STRING, flush_state STRING",
    "scalup": (
        "ts TIMESTAMP_NTZ, ts_scalup TIMESTAMP_NTZ, temp_degc DOUBLE, sal_psu DOUBLE, pressure_mbar DOUBLE, "
        "oxygen_mgl DOUBLE, ph DOUBLE, field_mask BIGINT"
    ),
    "status": (
        "ts TIMESTAMP_NTZ, turbo_error DOUBLE, turbo_speed_hz DOUBLE, turbo_power_w DOUBLE, turbo_voltage DOUBLE, "
        "turbo_etemp_c DOUBLE, turbo_btemp_c DOUBLE, turbo_mtemp_c DOUBLE, rga_filament DOUBLE, "
        "raw_total_pressure_current DOUBLE, pump_rpm DOUBLE, payload_raw STRING"
    ),
    "system_health": "ts TIMESTAMP_NTZ, voltage_v DOUBLE, current_a DOUBLE, teensy_temp_c DOUBLE",
    "par": (
        "ts TIMESTAMP_NTZ, scan_no BIGINT, par_raw DOUBLE, par_umol_m2_s DOUBLE, serial_number STRING, "
        "sensor_number BIGINT, cal_date DATE, interval_s DOUBLE"
    ),
    "hobo_oxygen": "ts TIMESTAMP_NTZ, location STRING, oxygen_mgl DOUBLE, temp_degc DOUBLE, serial_number STRING",
}

CALIBRATION_SCHEMA = (
    "sensor_number BIGINT, serial_number STRING, cal_date DATE, interval_s DOUBLE, slope DOUBLE, "
    "intercept DOUBLE, notes STRING"
)

DEPLOYMENT_SCHEMA = (
    "deployment_id STRING, site STRING, lat DOUBLE, lon DOUBLE, start TIMESTAMP_NTZ, end TIMESTAMP_NTZ, "
    "test BOOLEAN, c1 STRING, c2 STRING, comments STRING"
)

# Time column of each table: scan and cycle averages use `timestamp`, fluxes and metabolism are placed by
# `experiment_start`, the curve fits have none.
TIME_COLUMN: dict[str, str | None] = {
    **{name: "ts" for name in TABLES},
    "rga_scans": "timestamp",
    "chamber_cycles": "timestamp",
    "fluxes": "experiment_start",
    "metabolism": "experiment_start",
    "pi_fit": None,
}

# Instrument constants and default parameters.
AMPS_PER_COUNT = 1e-16
ARGON = 40
SCALUP_AVERAGES = {
    "temp_degC": "temp_degc",
    "sal_PSU": "sal_psu",
    "pressure_mbar": "pressure_mbar",
    "oxygen_mgL": "oxygen_mgl",
    "pH": "ph",
}
DEFAULTS: dict[str, float] = {
    "chamber_area_m2": 0.30,
    "chamber_volume_l": 30.0,
    "settle_offset_s": 60.0,
    "partial_pressure_sensitivity_a_per_torr": 8.01e-5,
    "total_pressure_sensitivity_a_per_torr": 1.34e-5,
    "n2_ar_sensitivity_ratio": 1.0,
    "par_time_offset_h": 0.0,
    "dark_par_threshold_umol_m2_s": 20.0,
    "min_par_coverage": 0.9,
    "metabolism_min_r2": 0.0,
    "chamber_par_transmittance": 1.0,
}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A typed table without rows: an input that is absent never makes a table disappear."""
    return spark.createDataFrame([], f"{KEY} STRING, {TABLES[name]}, chunk STRING, pos BIGINT")
