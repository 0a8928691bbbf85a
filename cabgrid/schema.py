"""Trip schema and the fixed values the queries must share with the original
program (grid geometry, bounding box, line layout, message texts)."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the original program's for equal results)
# ---------------------------------------------------------------------------
# Centre of grid cell 1.1 (north-west corner of the grid), degrees.
ORIGIN_LON = -74.913585
ORIGIN_LAT = 41.474937
# One 500 m cell expressed in degrees of longitude / latitude.
CELL_STEP_LON = 0.005986
CELL_STEP_LAT = 0.004491556
# Inclusive bounding box; trips with either end outside are dropped.
LON_MIN = -74.916578
LON_MAX = -73.120784
LAT_MIN = 40.129716
LAT_MAX = 41.477183
# Timestamp text format of the input lines.
LINE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Minimum number of comma-separated fields in an input line.
LINE_MIN_FIELDS = 17
# Field positions in an input line (0-based).
LINE_FIELDS = {
    "medallion": 0,
    "pickup_dt": 2,
    "dropoff_dt": 3,
    "trip_time": 4,
    "trip_distance": 5,
    "pickup_long": 6,
    "pickup_lat": 7,
    "dropoff_long": 8,
    "dropoff_lat": 9,
    "fare_amount": 11,
    "tip_amount": 14,
    "total_amount": 16,
}
# Message texts.
IDLE_MESSAGE = "Idle time alert: {} minutes idle"
CONGESTED_MESSAGE = "Alert, area {} is congested"
NOT_CONGESTED_MESSAGE = "No congested Areas"
# Default thresholds.
IDLE_THRESHOLD_MINUTES = 10
TOP_K = 10
# ---------------------------------------------------------------------------

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("medallion", T.StringType()),
        T.StructField("pickup_dt", T.TimestampNTZType()),
        T.StructField("dropoff_dt", T.TimestampNTZType()),
        T.StructField("trip_time", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_long", T.DoubleType()),
        T.StructField("pickup_lat", T.DoubleType()),
        T.StructField("dropoff_long", T.DoubleType()),
        T.StructField("dropoff_lat", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

TRIP_COLUMNS = [f.name for f in TRIP_SCHEMA.fields]
