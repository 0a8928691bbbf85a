"""Questions as parameterised SQL text over a table of trips as they come (before
cleaning), with the grid and the messages as SQL functions. ``{trips}`` is the table,
``:name`` a parameter."""

from pyspark.sql import DataFrame

from cabgrid.functions.sql import register_sql_functions
from cabgrid.schema import IDLE_THRESHOLD_MINUTES, TOP_K

_CLEAN = """clean AS (
  SELECT medallion, pickup_dt, dropoff_dt, fare_amount, tip_amount,
         cab_cell(pickup_long, pickup_lat) AS pickup_cell, cab_cell(dropoff_long, dropoff_lat) AS dropoff_cell
  FROM {trips}
  WHERE cab_inside(pickup_long, pickup_lat) AND cab_inside(dropoff_long, dropoff_lat)
)"""

TOP_ROUTES_SQL = f"""WITH {_CLEAN}
SELECT pickup_cell, dropoff_cell, w.start AS window_start, num_trips
FROM (
  SELECT pickup_cell, dropoff_cell, window(pickup_dt, '30 minutes') AS w, count(fare_amount) AS num_trips
  FROM clean
  GROUP BY pickup_cell, dropoff_cell, window(pickup_dt, '30 minutes')
)
ORDER BY num_trips DESC, window_start, pickup_cell, dropoff_cell
LIMIT :k"""

IDLE_SQL = f"""WITH {_CLEAN},
idle AS (
  SELECT medallion, pickup_dt, cab_wrapped_minutes(timestampdiff(SECOND, dropoff_dt, pickup_dt)) AS minutes FROM clean
),
mean AS (
  SELECT medallion, window(pickup_dt, '1 hour') AS w, avg(minutes) AS avg_idle_minutes
  FROM idle
  WHERE minutes > 0
  GROUP BY medallion, window(pickup_dt, '1 hour')
)
SELECT medallion, w.start AS window_start, avg_idle_minutes, cab_idle_message(avg_idle_minutes) AS alert_message
FROM mean
WHERE avg_idle_minutes > :threshold"""

PLEASANT_DRIVERS_SQL = f"""WITH {_CLEAN}
SELECT medallion, w.start AS day, total_tip_amount
FROM (
  SELECT medallion, window(pickup_dt, '1 day') AS w, sum(tip_amount) AS total_tip_amount
  FROM clean
  GROUP BY medallion, window(pickup_dt, '1 day')
)
ORDER BY total_tip_amount DESC, day, medallion
LIMIT :k"""


def ask(text: str, trips: DataFrame, **parameters: object) -> DataFrame:
    """The answer of SQL text over ``trips`` (raw trips) with the given parameters."""
    spark = trips.sparkSession
    register_sql_functions(spark)
    return spark.sql(text, args=parameters, trips=trips)


def top_routes_sql(trips: DataFrame, k: int = TOP_K) -> DataFrame:
    """Same answer as ``top_routes`` of the cleaned trips."""
    return ask(TOP_ROUTES_SQL, trips, k=k)


def idle_compat_sql(trips: DataFrame, threshold: float = IDLE_THRESHOLD_MINUTES) -> DataFrame:
    """Same answer as ``idle_compat`` of the cleaned trips."""
    return ask(IDLE_SQL, trips, threshold=float(threshold))


def pleasant_drivers_sql(trips: DataFrame, k: int = TOP_K) -> DataFrame:
    """Same answer as ``pleasant_drivers`` of the cleaned trips."""
    return ask(PLEASANT_DRIVERS_SQL, trips, k=k)
