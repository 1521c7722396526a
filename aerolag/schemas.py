"""Declared columns of the input tables and of the encoded training row."""

from __future__ import annotations

from pyspark.sql import types as T

# Column -> type a CSV cell is read as. CSV text that does not fit becomes null.
FLIGHTS = {
    "FL_DATE": "date",
    "OP_CARRIER": "string",
    "OP_CARRIER_FL_NUM": "int",
    "ORIGIN": "string",
    "DEST": "string",
    "CRS_DEP_TIME": "int",
    "DEP_DELAY": "double",
    "CRS_ARR_TIME": "int",
    "ARR_TIME": "int",
    "ARR_DELAY": "double",
    "CANCELLED": "int",
    "DIVERTED": "int",
    "ACTUAL_ELAPSED_TIME": "double",
    "AIR_TIME": "double",
    "TAXI_IN": "double",
    "TAXI_OUT": "double",
    "DISTANCE": "double",
    "CARRIER_DELAY": "double",
    "WEATHER_DELAY": "double",
    "NAS_DELAY": "double",
    "SECURITY_DELAY": "double",
    "LATE_AIRCRAFT_DELAY": "double",
}

AIRPORTS = {
    name: "string"
    for name in ("local_region", "municipality", "local_code", "iata_code", "ident", "name")
}

AIRPORTS_STATIONS = {
    name: "string" for name in ("ORIGIN", "STATE", "CITY", "NAME", "STATION")
}

CARRIERS = {"OP_CARRIER": "string", "CATEGORY": "string"}

# The station file has no header: names go by position.
STATIONS = T.StructType(
    [
        T.StructField("STATION", T.StringType()),
        T.StructField("LAT", T.DoubleType()),
        T.StructField("LON", T.DoubleType()),
    ]
)

# The encoded training row: eight attributes in this order, then the label.
ATTRIBUTES = [
    "CARRIER_TYPE",
    "ORIG_AREA",
    "DEST_AREA",
    "DEP_DELAY_CAT",
    "ORIG_SCHEDULE",
    "DEST_SCHEDULE",
    "ORIG_WEATHER",
    "DEST_WEATHER",
]
LABEL = "ARR_DELAY_CAT"
TRAINING_ROW = T.StructType(
    [T.StructField(name, T.IntegerType()) for name in [*ATTRIBUTES, LABEL]]
)
