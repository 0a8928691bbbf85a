"""Independent SQL (DuckDB dialect) for every query in the catalog.

The trip derivation is repeated here in plain SQL, with the same literals, so
the oracle shares no code with the Spark side. Time buckets use
``time_bucket``, neighbours use window functions, and message numbers are
rendered from scaled integers exactly as the Spark side does.
"""

# Fixed values, as in schema.py (``e0`` makes DuckDB read them as doubles).
_TRIPS = """
base AS (
  SELECT event_id,
         concat('M', CAST(CAST(floor(user_id / 5e0) AS BIGINT) AS VARCHAR)) AS medallion,
         date_trunc('second', ts) AS pickup_dt,
         CAST(300 + (event_id * 7919) % 2400 AS INTEGER) AS trip_time,
         (event_id % 37) * 0.5e0 AS trip_distance,
         CASE WHEN event_id % 50 = 7 THEN 0e0
              ELSE -74.913585e0 + (100 + (event_id * 31) % 3) * 0.005986e0 + 0.001e0 END AS pickup_long,
         CASE WHEN event_id % 50 = 7 THEN 0e0
              ELSE 41.474937e0 - (150 + (event_id * 17) % 2) * 0.004491556e0 - 0.001e0 END AS pickup_lat,
         CASE WHEN event_id % 50 = 13 THEN -80e0
              ELSE -74.913585e0 + (100 + (event_id * 13) % 3) * 0.005986e0 - 0.001e0 END AS dropoff_long,
         41.474937e0 - (150 + (event_id * 7) % 2) * 0.004491556e0 + 0.001e0 AS dropoff_lat,
         floor(value * 4e0) / 4e0 + 2.5e0 AS fare_amount,
         (event_id % 11) * 0.25e0 AS tip_amount
  FROM events
),
trips_raw AS (
  SELECT event_id, medallion, pickup_dt, pickup_dt + to_seconds(trip_time) AS dropoff_dt,
         trip_time, trip_distance, pickup_long, pickup_lat, dropoff_long, dropoff_lat,
         fare_amount, tip_amount, fare_amount + tip_amount AS total_amount
  FROM base
),
trips AS (
  SELECT *,
         concat_ws('.', CAST(1 + floor(0.5e0 + (pickup_long + 74.913585e0) / 0.005986e0) AS BIGINT),
                        CAST(1 + floor(0.5e0 + (41.474937e0 - pickup_lat) / 0.004491556e0) AS BIGINT)) AS pickup_cell,
         concat_ws('.', CAST(1 + floor(0.5e0 + (dropoff_long + 74.913585e0) / 0.005986e0) AS BIGINT),
                        CAST(1 + floor(0.5e0 + (41.474937e0 - dropoff_lat) / 0.004491556e0) AS BIGINT)) AS dropoff_cell
  FROM trips_raw
  WHERE pickup_long BETWEEN -74.916578e0 AND -73.120784e0
    AND dropoff_long BETWEEN -74.916578e0 AND -73.120784e0
    AND pickup_lat BETWEEN 40.129716e0 AND 41.477183e0
    AND dropoff_lat BETWEEN 40.129716e0 AND 41.477183e0
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([_TRIPS, *ctes]) + "\n"


def _message(template_before: str, x: str, template_after: str) -> str:
    scaled = f"CAST(floor({x} * 100e0 + 0.5e0) AS BIGINT)"
    return (
        f"'{template_before}' || CAST({scaled} // 100 AS VARCHAR) || '.' || "
        f"lpad(CAST({scaled} % 100 AS VARCHAR), 2, '0') || '{template_after}'"
    )


_ROUTES = """route_counts AS (
  SELECT pickup_cell, dropoff_cell, time_bucket(INTERVAL '30 minutes', pickup_dt) AS window_start,
         count(fare_amount) AS num_trips
  FROM trips GROUP BY ALL
)"""

_EMPTY = """drops AS (
  SELECT dropoff_cell, time_bucket(INTERVAL '15 minutes', dropoff_dt) AS b FROM trips
),
empty_taxis AS (
  SELECT dropoff_cell, window_start, window_start + INTERVAL '30 minutes' AS window_end,
         count(*) AS num_empty_taxis
  FROM (SELECT dropoff_cell, b AS window_start FROM drops
        UNION ALL
        SELECT dropoff_cell, b - INTERVAL '15 minutes' AS window_start FROM drops)
  GROUP BY ALL
)"""

_EMPTY_DISTINCT = """drops AS (
  SELECT dropoff_cell, medallion, time_bucket(INTERVAL '15 minutes', dropoff_dt) AS b FROM trips
),
empty_taxis AS (
  SELECT dropoff_cell, window_start, window_start + INTERVAL '30 minutes' AS window_end,
         count(DISTINCT medallion) AS num_empty_taxis
  FROM (SELECT dropoff_cell, medallion, b AS window_start FROM drops
        UNION ALL
        SELECT dropoff_cell, medallion, b - INTERVAL '15 minutes' AS window_start FROM drops)
  GROUP BY dropoff_cell, window_start
)"""

_PROFIT = """area_profit AS (
  SELECT pickup_cell, time_bucket(INTERVAL '15 minutes', pickup_dt) AS window_start,
         time_bucket(INTERVAL '15 minutes', pickup_dt) + INTERVAL '15 minutes' AS window_end,
         avg(fare_amount + tip_amount) AS area_profit
  FROM trips GROUP BY ALL
)"""

_PROFITABLE = """SELECT p.pickup_cell AS cell, p.window_end, p.area_profit, e.num_empty_taxis,
       p.area_profit / e.num_empty_taxis AS profitability
FROM area_profit p JOIN empty_taxis e
  ON p.pickup_cell = e.dropoff_cell AND p.window_end = e.window_end
WHERE e.num_empty_taxis > 0
ORDER BY profitability DESC, cell, window_end"""

_GAPS = """gaps AS (
  SELECT medallion, event_id, pickup_dt, prev_dropoff_dt,
         CAST(date_diff('second', prev_dropoff_dt, pickup_dt) AS INTEGER) AS gap_seconds
  FROM (SELECT medallion, event_id, pickup_dt,
               lag(dropoff_dt) OVER (PARTITION BY medallion ORDER BY pickup_dt, event_id) AS prev_dropoff_dt
        FROM trips)
  WHERE prev_dropoff_dt IS NOT NULL
)"""

_IDLE_AVG = """idle AS (
  SELECT medallion, time_bucket(INTERVAL '1 hour', pickup_dt) AS window_start,
         sum(CAST(gap_seconds AS DOUBLE)) / count(*) / 60e0 AS avg_idle_minutes
  FROM gaps WHERE gap_seconds > 0 GROUP BY ALL
)"""

_IDLE_COMPAT = """wrapped AS (
  SELECT medallion, pickup_dt,
         ((((date_diff('second', dropoff_dt, pickup_dt) % 86400) + 86400) % 86400) // 60) % 60 AS idle_minutes
  FROM trips
),
idle AS (
  SELECT medallion, time_bucket(INTERVAL '1 hour', pickup_dt) AS window_start,
         sum(CAST(idle_minutes AS DOUBLE)) / count(*) AS avg_idle_minutes
  FROM wrapped WHERE idle_minutes > 0 GROUP BY ALL
)"""

_IDLE_SELECT = (
    "SELECT medallion, window_start, avg_idle_minutes, "
    + _message("Idle time alert: ", "avg_idle_minutes", " minutes idle")
    + " AS alert_message\nFROM idle WHERE avg_idle_minutes > 10e0"
)

_TIPS = """driver_tips AS (
  SELECT medallion, time_bucket(INTERVAL '1 day', pickup_dt) AS day, sum(tip_amount) AS total_tip_amount
  FROM trips GROUP BY ALL
)"""

_BOX = """pickup_long BETWEEN -74.916578e0 AND -73.120784e0
       AND dropoff_long BETWEEN -74.916578e0 AND -73.120784e0
       AND pickup_lat BETWEEN 40.129716e0 AND 41.477183e0
       AND dropoff_lat BETWEEN 40.129716e0 AND 41.477183e0"""

# Lines 21 and 22 of every 50 have no field but the first, 23 no trip time, 24 no pickup time.
_NAMES = (
    "trip_distance pickup_long pickup_lat dropoff_long dropoff_lat fare_amount tip_amount total_amount dropoff_dt".split()
)
_PARSED = (
    """, parsed AS (
  SELECT event_id,
         CASE event_id % 50 WHEN 21 THEN '' WHEN 22 THEN 'a' ELSE medallion END AS medallion,
         CASE WHEN event_id % 50 IN (21, 22, 24) THEN NULL ELSE pickup_dt END AS pickup_dt,
         CASE WHEN event_id % 50 IN (21, 22, 23) THEN NULL ELSE trip_time END AS trip_time,
"""
    + "".join(f"         CASE WHEN event_id % 50 IN (21, 22) THEN NULL ELSE {c} END AS {c},\n" for c in _NAMES)
    + """         CASE event_id % 50 WHEN 21 THEN 'empty_line' WHEN 22 THEN 'too_few_fields'
              WHEN 23 THEN 'bad_field' WHEN 24 THEN 'bad_field' END AS reject_reason
  FROM trips_raw
)
"""
)

ORACLE_SQL: dict[str, str] = {
    "parse_trips": _with() + _PARSED + "SELECT * FROM parsed",
    "reject_counts": _with()
    + _PARSED
    + f"SELECT coalesce(reject_reason, CASE WHEN {_BOX} THEN 'accepted' ELSE 'outside_grid' END) AS outcome, count(*) AS num_lines\n"
    "FROM parsed GROUP BY ALL",
    "clean_trips": _with() + "SELECT * FROM trips",
    "route_counts": _with(_ROUTES) + "SELECT * FROM route_counts",
    "top_routes": _with(_ROUTES)
    + "SELECT * FROM route_counts ORDER BY num_trips DESC, window_start, pickup_cell, dropoff_cell LIMIT 10",
    "top_routes_per_window": _with(_ROUTES)
    + """SELECT *, CAST(row_number() OVER (PARTITION BY window_start
                              ORDER BY num_trips DESC, pickup_cell, dropoff_cell) AS INTEGER) AS "rank"
FROM route_counts QUALIFY "rank" <= 10""",
    "empty_taxis": _with(_EMPTY) + "SELECT * FROM empty_taxis",
    "area_profit": _with(_PROFIT) + "SELECT * FROM area_profit",
    "profitable_areas": _with(_EMPTY, _PROFIT) + _PROFITABLE,
    "profitable_areas_sql": _with(_EMPTY, _PROFIT) + _PROFITABLE,
    "profitable_areas_compat": _with(
        """sliced AS (SELECT *, time_bucket(INTERVAL '1 hour', pickup_dt) AS slice_start FROM trips)""",
        """e AS (
  SELECT slice_start, dropoff_cell, time_bucket(INTERVAL '30 minutes', dropoff_dt) AS dropoff_window_start,
         count(*) AS num_empty_taxis
  FROM sliced GROUP BY ALL
)""",
        """p AS (
  SELECT slice_start, pickup_cell, time_bucket(INTERVAL '15 minutes', pickup_dt) AS pickup_window_start,
         avg(fare_amount + tip_amount) AS area_profit
  FROM sliced GROUP BY ALL
)""",
    )
    + """SELECT e.slice_start, p.pickup_cell AS cell, e.dropoff_window_start, p.pickup_window_start,
       p.area_profit, e.num_empty_taxis, p.area_profit / e.num_empty_taxis AS profitability
FROM e JOIN p ON e.slice_start = p.slice_start AND e.dropoff_cell = p.pickup_cell
WHERE e.num_empty_taxis > 0""",
    "profitable_areas_distinct": _with(_EMPTY_DISTINCT, _PROFIT) + _PROFITABLE,
    "idle_gaps": _with(_GAPS) + "SELECT * FROM gaps",
    "idle_alerts": _with(_GAPS, _IDLE_AVG) + _IDLE_SELECT,
    "idle_compat": _with(_IDLE_COMPAT) + _IDLE_SELECT,
    "idle_alerts_sliding": _with(
        _GAPS,
        """idle AS (
  SELECT medallion, time_bucket(INTERVAL '5 minutes', pickup_dt) - to_minutes(CAST(5 * k AS BIGINT)) AS window_start,
         sum(CAST(gap_seconds AS DOUBLE)) / count(*) / 60e0 AS avg_idle_minutes
  FROM gaps, (SELECT unnest(range(12)) AS k) WHERE gap_seconds > 0 GROUP BY ALL
)""",
    )
    + _IDLE_SELECT,
    "idle_alert_stretches": _with(
        _GAPS,
        """changes AS (
  SELECT medallion, step, sum(total) AS total, sum(n) AS n FROM (
    SELECT medallion, epoch(pickup_dt)::BIGINT // 5 AS step, gap_seconds AS total, 1 AS n FROM gaps WHERE gap_seconds > 0
    UNION ALL
    SELECT medallion, epoch(pickup_dt)::BIGINT // 5 + 720, -gap_seconds, -1 FROM gaps WHERE gap_seconds > 0
  ) GROUP BY medallion, step
)""",
        """level AS (
  SELECT medallion, step, lead(step) OVER w - 1 AS until, sum(total) OVER w AS total, sum(n) OVER w AS n
  FROM changes WINDOW w AS (PARTITION BY medallion ORDER BY step)
)""",
        """mean AS (
  SELECT medallion, step, until, CAST(total AS DOUBLE) / n / 60e0 AS m FROM level WHERE n > 0
)""",
        """islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY medallion ORDER BY step) AS island FROM (
    SELECT *, CASE WHEN lag(until) OVER w = step - 1 AND lag(m) OVER w = m THEN 0 ELSE 1 END AS fresh
    FROM mean WHERE m > 10e0 WINDOW w AS (PARTITION BY medallion ORDER BY step)
  )
)""",
    )
    + """SELECT medallion, TIMESTAMP '1970-01-01' + to_seconds((min(step) - 719) * 5) AS first_window,
       TIMESTAMP '1970-01-01' + to_seconds((max(until) - 719) * 5) AS last_window, any_value(m) AS avg_idle_minutes
FROM islands GROUP BY medallion, island""",
    "cell_rendezvous": _with()
    + """SELECT d.medallion, d.dropoff_cell AS cell, d.event_id, d.dropoff_dt AS ddt, min(p.pickup_dt) AS pdt
FROM trips d JOIN trips p ON d.medallion = p.medallion AND d.dropoff_cell = p.pickup_cell
     AND p.pickup_dt >= d.dropoff_dt AND p.pickup_dt <= d.dropoff_dt + INTERVAL '1 hour'
GROUP BY ALL""",
    "cell_rendezvous_compat": _with(
        """d AS (
  SELECT medallion, dropoff_cell AS cell, min(dropoff_dt) AS ddt
  FROM trips GROUP BY medallion, dropoff_cell, time_bucket(INTERVAL '1 hour', dropoff_dt)
)""",
        """p AS (
  SELECT medallion, pickup_cell AS cell, min(pickup_dt) AS pdt
  FROM trips GROUP BY medallion, pickup_cell, time_bucket(INTERVAL '1 hour', pickup_dt)
)""",
    )
    + """SELECT d.medallion, d.cell, d.ddt, p.pdt
FROM d JOIN p ON d.medallion = p.medallion AND d.cell = p.cell
             AND p.pdt >= d.ddt AND p.pdt <= d.ddt + INTERVAL '1 hour'""",
    "congestion_alerts": _with(
        """seq AS (
  SELECT medallion, time_bucket(INTERVAL '1 day', pickup_dt) AS day, pickup_dt, event_id, pickup_cell,
         trip_time AS d,
         lag(trip_time, 1) OVER w AS b1,
         lead(trip_time, 1) OVER w AS a1,
         lead(trip_time, 2) OVER w AS a2,
         lead(trip_time, 3) OVER w AS a3
  FROM trips
  WINDOW w AS (PARTITION BY medallion, time_bucket(INTERVAL '1 day', pickup_dt) ORDER BY pickup_dt, event_id)
)""",
        """firsts AS (
  SELECT medallion, day, pickup_cell AS cell
  FROM seq
  WHERE d > b1 AND d > a1 AND a1 < a2 AND a2 < a3
  QUALIFY row_number() OVER (PARTITION BY medallion, day ORDER BY pickup_dt, event_id) = 1
)""",
    )
    + "SELECT medallion, day, cell, 'Alert, area ' || cell || ' is congested' AS alert_message FROM firsts",
    "congestion_compat": _with()
    + """SELECT DISTINCT medallion, time_bucket(INTERVAL '1 day', pickup_dt) AS day,
       'No congested Areas' AS alert_message
FROM trips""",
    "driver_tips": _with(_TIPS) + "SELECT * FROM driver_tips",
    "pleasant_drivers": _with(_TIPS)
    + "SELECT * FROM driver_tips ORDER BY total_tip_amount DESC, day, medallion LIMIT 10",
    "pleasant_drivers_per_day": _with(_TIPS)
    + """SELECT *, CAST(row_number() OVER (PARTITION BY day ORDER BY total_tip_amount DESC, medallion) AS INTEGER) AS "rank"
FROM driver_tips QUALIFY "rank" <= 10""",
}

ORACLE_SQL["top_routes_sql"] = ORACLE_SQL["top_routes"]
ORACLE_SQL["idle_compat_sql"] = ORACLE_SQL["idle_compat"]
ORACLE_SQL["pleasant_drivers_sql"] = ORACLE_SQL["pleasant_drivers"]
_CENTS = """cent_trips AS (
  SELECT * REPLACE (fare_amount + ((event_id * 53) % 89) * 0.01e0 AS fare_amount, tip_amount + ((event_id * 31) % 97) * 0.01e0 AS tip_amount)
  FROM trips
)"""
ORACLE_SQL["area_profit_cents"] = (
    _with(_CENTS)
    + """SELECT pickup_cell, time_bucket(INTERVAL '15 minutes', pickup_dt) AS window_start,
       time_bucket(INTERVAL '15 minutes', pickup_dt) + INTERVAL '15 minutes' AS window_end,
       CAST(sum(CAST(floor((fare_amount + tip_amount) * 100e0 + 0.5e0) AS BIGINT)) AS DOUBLE) / 100e0 / count(*) AS area_profit
FROM cent_trips GROUP BY ALL"""
)
ORACLE_SQL["pleasant_drivers_cents"] = (
    _with(_CENTS)
    + """SELECT medallion, time_bucket(INTERVAL '1 day', pickup_dt) AS day,
       CAST(sum(CAST(floor(tip_amount * 100e0 + 0.5e0) AS BIGINT)) AS DOUBLE) / 100e0 AS total_tip_amount
FROM cent_trips GROUP BY medallion, day ORDER BY total_tip_amount DESC, day, medallion LIMIT 10"""
)


# A streaming query reads the whole table and closes every window: the batch answer.
STREAM_ORACLE_SQL: dict[str, str] = {
    "stream_route_counts": ORACLE_SQL["route_counts"],
    "stream_top_routes": ORACLE_SQL["top_routes_per_window"],
    "stream_profitable_areas": ORACLE_SQL["profitable_areas"],
    "stream_profitable_areas_distinct": ORACLE_SQL["profitable_areas_distinct"],
    "stream_idle_alerts": ORACLE_SQL["idle_alerts"],
    "stream_idle_alerts_sliding": ORACLE_SQL["idle_alerts_sliding"],
    "stream_idle_compat": ORACLE_SQL["idle_compat"],
    "stream_congestion_alerts": ORACLE_SQL["congestion_alerts"],
    "stream_cell_rendezvous": ORACLE_SQL["cell_rendezvous"],
    "stream_cell_rendezvous_compat": ORACLE_SQL["cell_rendezvous_compat"],
    "stream_pleasant_drivers": ORACLE_SQL["pleasant_drivers_per_day"],
    "stream_top_routes_overall": ORACLE_SQL["top_routes"],
    "stream_pleasant_drivers_overall": ORACLE_SQL["pleasant_drivers"],
    "stream_reject_counts": ORACLE_SQL["reject_counts"],
}
