"""Explicit schemas of every relation the library reads or writes.

Nothing is inferred: a snapshot whose station carries a single class would
otherwise be read as a struct instead of an array.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The wire names of the sensor feed and its vehicle classes.
CLASSES = (1, 2, 3, 4, 5)
CLASS_MEASURES = (
    "verkeersintensiteit",
    "voertuigsnelheid_rekenkundig",
    "voertuigsnelheid_harmonisch",
)
HEADER_FIELDS = (
    "beschrijvende_id",
    "unieke_id",
    "lve_nr",
    "tijd_waarneming",
    "tijd_laatst_gewijzigd",
    "actueel_publicatie",
    "beschikbaar",
    "defect",
    "geldig",
)
AGGREGATE_FIELDS = ("bezettingsgraad", "beschikbaarheidsgraad", "onrustigheid")
STATION_FIELDS = (
    "beschrijvende_id",
    "volledige_naam",
    "Ident_8",
    "lve_nr",
    "Kmp_Rsys",
    "Rijstrook",
    "X_coord_EPSG_31370",
    "Y_coord_EPSG_31370",
    "lengtegraad_EPSG_4326",
    "breedtegraad_EPSG_4326",
)

# Harmonic speeds that mean "nothing measured" / "not usable".
NO_VEHICLE = "252"
UNUSABLE = ("252", "254")

# Tags of the three result variants.
SPEED_DIFFERENTIAL = "SPEED_DIFFERENTIAL"
TRAFFIC_JAM = "TRAFFIC_JAM"
SPEED_AVG = "SPEED_AVG"
OUTPUT_TYPES = (SPEED_DIFFERENTIAL, TRAFFIC_JAM, SPEED_AVG)

# Texts of the two notifications.
NEW_JAM_MESSAGE = "New traffic jam at location: %s"
JAM_GONE_MESSAGE = "The traffic jam at location: %s is gone!"

# English names for those who prefer them over the wire names.
ENGLISH_NAMES = {
    "unieke_id": "sensor_id",
    "beschrijvende_id": "sensor_code",
    "lve_nr": "lve_no",
    "tijd_waarneming": "observed_at",
    "tijd_laatst_gewijzigd": "modified_at",
    "actueel_publicatie": "is_current",
    "beschikbaar": "available",
    "geldig": "valid",
    "verkeersintensiteit": "intensity",
    "voertuigsnelheid_rekenkundig": "speed_mean",
    "voertuigsnelheid_harmonisch": "speed_harm",
    "rekendata_bezettingsgraad": "occupancy",
    "rekendata_beschikbaarheidsgraad": "availability_pct",
    "rekendata_onrustigheid": "turbulence",
}


def _strings(names) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def class_columns(cls: int) -> list[str]:
    """The three flat columns of one vehicle class."""
    return [f"{m}_klasse{cls}" for m in CLASS_MEASURES]


FLAT_EVENT_COLUMNS = (
    list(HEADER_FIELDS)
    + [c for cls in CLASSES for c in class_columns(cls)]
    + [f"rekendata_{a}" for a in AGGREGATE_FIELDS]
)

FLAT_EVENT = T.StructType(_strings(FLAT_EVENT_COLUMNS))

# One station of a snapshot, as it stands in the XML or JSON document.
SNAPSHOT_STATION = T.StructType(
    _strings(["@beschrijvende_id", "@unieke_id"])
    + _strings(HEADER_FIELDS[2:])
    + [
        T.StructField("meetdata", T.ArrayType(T.StructType(
            _strings(["@klasse_id", *CLASS_MEASURES])))),
        T.StructField("rekendata", T.StructType(_strings(AGGREGATE_FIELDS))),
    ]
)

SNAPSHOT_DOCUMENT = T.StructType([
    T.StructField("miv", T.StructType([
        T.StructField("tijd_publicatie", T.StringType()),
        T.StructField("tijd_laatste_config_wijziging", T.StringType()),
        T.StructField("meetpunt", T.ArrayType(SNAPSHOT_STATION)),
    ])),
])

STATION_CONFIG = T.StructType(_strings(["@unieke_id", *STATION_FIELDS]))

# The analytics input: 18 columns, classes 2 and 5 only. The observation time
# is a long, so that it does not overflow in 2038.
_INPUT_TEXT_LENGTH = {"beschrijvende_id": 8, "tijd_laatst_gewijzigd": 32}
INPUT_COLUMNS = (
    list(HEADER_FIELDS)
    + class_columns(2)
    + class_columns(5)
    + [f"rekendata_{a}" for a in AGGREGATE_FIELDS]
)
INPUT_TEXT_LENGTH = _INPUT_TEXT_LENGTH
INPUT_ROW = T.StructType([
    T.StructField(
        c,
        T.StringType() if c in _INPUT_TEXT_LENGTH
        else T.LongType() if c == "tijd_waarneming"
        else T.IntegerType(),
    )
    for c in INPUT_COLUMNS
])

LOCATION = T.StructType([
    T.StructField("locatieId", T.StringType()),
    T.StructField("locatie", T.StringType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
])

RESULT = T.StructType([
    T.StructField("outputType", T.StringType()),
    T.StructField("uniqueId", T.IntegerType()),
    T.StructField("previousSpeed", T.IntegerType()),
    T.StructField("currentSpeed", T.IntegerType()),
    T.StructField("avgSpeed3Minutes", T.IntegerType()),
    T.StructField("avgSpeed10Minutes", T.IntegerType()),
    T.StructField("speedDiffIndicator", T.IntegerType()),
    T.StructField("trafficJamIndicator", T.IntegerType()),
    T.StructField("bezettingsgraad", T.IntegerType()),
    T.StructField("recordTimestamp", T.LongType()),
    T.StructField("location", T.StringType()),
    T.StructField("originalRecordTimestamp", T.TimestampType()),
])
RESULT_COLUMNS = RESULT.fieldNames()

STATE_KEYS = ["uniqueId", "outputType"]
STATE = T.StructType([
    T.StructField("uniqueId", T.StringType()),
    T.StructField("outputType", T.StringType()),
    T.StructField("recordTimestamp", T.StringType()),
    T.StructField("outputType_recordTimestamp", T.StringType()),
    T.StructField("currentSpeed", T.IntegerType()),
    T.StructField("previousSpeed", T.IntegerType()),
    T.StructField("avgSpeed3Minutes", T.IntegerType()),
    T.StructField("avgSpeed10Minutes", T.IntegerType()),
    T.StructField("speedDiffIndicator", T.IntegerType()),
    T.StructField("trafficJamIndicator", T.IntegerType()),
    T.StructField("bezettingsgraad", T.IntegerType()),
    T.StructField("loc", T.StringType()),
])

ALERT_KEYS = ["uniqueId"]
ALERT = T.StructType(_strings(["uniqueId", "alertIndicator", "loc"]))

NOTIFICATION = T.StructType([
    T.StructField("message", T.StringType()),
    T.StructField("incoming", T.BooleanType()),
])
