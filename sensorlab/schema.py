"""Fixed schemas, series keys and column names."""

from pyspark.sql import types as T

KEYS = ["zone", "device_id", "house"]
TIME = "time"
MEASURES = ["temperature", "humidity"]
SENTINEL = -1.0

READINGS = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("zone", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("house", T.StringType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
])

FEED = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("time", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("house", T.StringType()),
        T.StructField("measures", T.DoubleType()),
    ]))),
])

# Weather column names as delivered -> names used by the operators.
WEATHER_NAMES = {
    "GHI_corr_Avg": "GHI",
    "DNI_corr_Avg": "DNI",
    "DHI_corr_Avg": "DHI",
    "Tair_Avg": "Tair",
    "RH_Avg": "RH",
    "BP_CS100_Avg": "BP",
    "WS_Avg": "WS",
    "WD_Avg": "WD",
}

WEATHER = ["GHI", "DNI", "DHI", "Tair", "RH", "BP", "WS", "WD", "WD_Std", "WSgust_Max", "Rain_mm_Tot"]

# Weight of each scaled feature in the analog-period search.
ANALOG_WEIGHTS = {
    "GHI": 2.0,
    "DNI": 1.5,
    "DHI": 1.5,
    "Tair": 2.0,
    "RH": 1.8,
    "BP": 0.8,
    "WS": 1.5,
    "WD": 0.7,
    "Rain_mm_Tot": 1.7,
    "hour": 3.0,
    "day_of_week": 1.5,
    "is_weekend": 1.0,
}
