"""Fixed values and table contracts.

The constants below must equal the reference's for equal results; they
are stated plainly, in their natural order, and not derived.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------
# Inclusive valid ranges per sensor role (lower, upper).
SENSOR_RANGES = {
    "temperature": (0.0, 150.0),
    "pressure": (0.0, 10.0),
    "vibration": (0.0, 100.0),
}
# Name fragments that identify the sensor roles, in processing order.
SENSOR_ROLE_FRAGMENTS = {
    "temperature": "temp",
    "pressure": "press",
    "vibration": "vibr",
}
# Other name fragments that give a column its role (substring matches).
TIME_FRAGMENTS = ("time", "date")
KEY_FRAGMENTS = ("machine", "line")
IDENTIFIER_FRAGMENTS = ("machine", "line", "sensor")
STATUS_FRAGMENT = "status"
RESULT_FRAGMENT = "result"
DEFECT_FRAGMENTS = ("defect", "fault")
POWER_FRAGMENT = "power"
EXCLUDED_FRAGMENT = "quality"
# Exact column names with a fixed meaning.
RECORD_ID_COLUMN = "record_id"
FLAG_COLUMN = "data_quality"
# Sensor error codes that mean "no reading".
ERROR_CODES = (-999.0, -1.0)
# Data-quality flags.
FLAG_GOOD, FLAG_ESTIMATED, FLAG_INVALID = "good", "estimated", "invalid"
# Inspection outcomes.
STATUS_PASS, STATUS_FAIL, STATUS_NOT_CHECKED = "pass", "fail", "not_checked"
# Record id format: prefix and zero-padded position.
RECORD_ID_FORMAT = "REC_%08d"
# Suffix for colliding right-hand join columns.
QUALITY_SUFFIX = "_quality"
# Default alert threshold (percent) for high defect hours.
DEFECT_ALERT_THRESHOLD = 5.0
# Strings read as missing in CSV input (pandas default NA list).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Target column order of the written readings table.
READINGS_COLUMNS = (
    "record_id", "timestamp", "line_id", "machine_id",
    "temperature", "pressure", "vibration", "power", "data_quality",
)
# Table names.
READINGS_TABLE, CHECKS_TABLE, SUMMARY_TABLE = (
    "sensor_readings", "quality_checks", "hourly_summary")
# -----------------------------------------------------------------------

# Spellings of times in text, rewritten in this order to those that TIME_FORMATS read.
TIME_SPELLINGS = (
    (r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?", "$1"),   # month names to three letters
    (r"(:\d{2}),(\d)", "$1.$2"),                                                  # decimal comma
    (r"[, ]+", " "),
    (r"^(\d{4})/(\d{1,2})/", "$1-$2-"),                                           # year first, slashes
    (r"^(\d{1,2})[-.](\d{1,2})[-.](\d{4})", "$1/$2/$3"),                          # year last, hyphens or points
    (r"^(\d{1,2})-([A-Za-z]{3})-", "$1 $2 "),
    (r"(\d)T(\d)", "$1 $2"),
    (r"(?i) ?(am|pm)$", " $1"),
    (r" ?(UTC|GMT|Z)$", "Z"),
    (r"(:\d{2}(?:\.\d+)?) ?([+-]\d{2}):?(\d{2})$", "$1$2:$3"),                   # offsets as +hh:mm
)
_DATES = ("yyyy-M-d", "M/d/yyyy", "d/M/yyyy", "MMM d yyyy", "d MMM yyyy")     # month first where both could be
TIME_FORMATS = (*(f"{d}[ H:mm[:ss[.SSSSSSSSS]]][XXX]" for d in _DATES),
                *(f"{d} h:mm[:ss[.SSSSSSSSS]] a" for d in _DATES))

READINGS_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("line_id", T.StringType()),
    T.StructField("machine_id", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("vibration", T.DoubleType()),
    T.StructField("power", T.DoubleType()),
    T.StructField("data_quality", T.StringType()),
])

CHECKS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("line_id", T.StringType()),
    T.StructField("machine_id", T.StringType()),
    T.StructField("result", T.StringType()),
    T.StructField("defect_type", T.StringType()),
])

SUMMARY_STATS = ("avg", "min", "max", "std")
SUMMARY_SENSORS = ("temperature", "pressure", "vibration", "power")

SUMMARY_SCHEMA = T.StructType(
    [T.StructField("hour", T.TimestampNTZType()),
     T.StructField("line_id", T.StringType()),
     T.StructField("machine_id", T.StringType())]
    + [T.StructField(f"{stat}_{sensor}", T.DoubleType())
       for sensor in SUMMARY_SENSORS for stat in SUMMARY_STATS]
    + [T.StructField("total_checks", T.LongType()),
       T.StructField("defect_count", T.LongType()),
       T.StructField("defect_rate", T.DoubleType())]
)

TABLE_SCHEMAS = {
    READINGS_TABLE: READINGS_SCHEMA,
    CHECKS_TABLE: CHECKS_SCHEMA,
    SUMMARY_TABLE: SUMMARY_SCHEMA,
}
