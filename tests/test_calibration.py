from datetime import date, datetime

from abyssal.sources.loggers import select_calibration

FILES = "deployment_id STRING, file_path STRING, serial_number STRING, first_ts TIMESTAMP_NTZ"
CALS = "sensor_number BIGINT, serial_number STRING, cal_date DATE, interval_s DOUBLE, slope DOUBLE, intercept DOUBLE"


def test_files_take_the_latest_calibration_without_meeting_all_of_their_logger(spark):
    files = [("d", f"f{i}", "S", datetime(2024, 1, 1 + i, 0, 0)) for i in range(4)] + [("d", "other", "T", datetime(2024, 1, 9)), ("d", "none", None, datetime(2024, 1, 9))]
    cals = [(1, "S", None, None, 0.1, 0.0), (2, "S", None, None, 0.2, 0.0), (9, "S", date(2024, 1, 2), None, 0.3, 0.0), (8, "S", date(2024, 1, 2), None, 0.4, 0.0),
            (3, "S", date(2024, 1, 4), 60.0, 0.5, 1.0), (4, None, date(2024, 1, 1), None, 0.6, 0.0), (5, "U", None, None, 0.7, 0.0)]
    out = select_calibration(spark.createDataFrame(files, FILES), spark.createDataFrame(cals, CALS))
    got = {r.file_path: (r.sensor_number, r.cal_date, r.cal_interval_s, r.slope) for r in out.collect()}
    assert got == {"f0": (2, None, None, 0.2), "f1": (9, date(2024, 1, 2), None, 0.3), "f2": (9, date(2024, 1, 2), None, 0.3), "f3": (3, date(2024, 1, 4), 60.0, 0.5)}
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert all("__slice" in line for line in joins), joins
