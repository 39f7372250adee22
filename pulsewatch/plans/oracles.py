"""DuckDB SQL for the registered queries, written independently of the Spark code.

``SHARED`` holds the adapters and joins that many queries start from. Every oracle is
prefixed with it; unused parts cost nothing. ``_oracle`` lists the columns that the
comparison rounds (d), widens to BIGINT (i) or prints as date (t) or time (s) text.
"""

from __future__ import annotations

from pulsewatch.operators import matches, planned

ORACLES: dict[str, str] = {}


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _case(column: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN {_q(k)} THEN {v}" for k, v in table.items())
    return f"CASE {column} {arms} ELSE {default} END"


def _double(x: float) -> str:
    return f"{x!r}e0"


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"12742e0 * asin(sqrt(least(1e0, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


_TEAMS = _list(team for teams in matches.GROUPS.values() for team in teams)
_STADIUMS = _list(matches.STADIUMS)

SHARED = f"""
geo AS (
  SELECT lpad(CAST(484530001000 + n_nationkey AS VARCHAR), 12, '0') AS geo_id,
         30.10e0 + n_nationkey * 0.0168e0 AS latitude_centroid,
         -97.94e0 + ((n_nationkey * 7) % 25) * 0.0156e0 AS longitude_centroid,
         1e0 + n_nationkey * 0.25e0 AS area_sq_km
  FROM nation),
calls AS (
  SELECT CAST(event_id AS VARCHAR) AS incident_number, ts AS response_datetime,
         CAST(ts AS DATE) AS response_date, hour(ts) AS response_hour,
         strftime(ts, '%a') AS response_day_of_week,
         CASE WHEN user_id % 5 < 4 THEN 'Priority ' || (user_id % 5) ELSE 'Priority X' END
           AS priority_level,
         CASE WHEN user_id % 5 < 4 THEN user_id % 5 ELSE 9 END AS priority_numeric,
         value * 60 AS response_time,
         CASE WHEN user_id % 7 < 6 THEN 'Type ' || (user_id % 7) END AS initial_problem_category,
         event_type AS final_problem_category,
         CASE WHEN user_id % 30 < 25
              THEN lpad(CAST(484530001000 + user_id % 30 AS VARCHAR), 12, '0')
              ELSE '484539999999' END AS geo_id
  FROM events),
enriched AS (
  SELECT c.*, g.latitude_centroid, g.longitude_centroid, g.area_sq_km
  FROM calls c LEFT JOIN geo g ON c.geo_id = g.geo_id),
festivals AS (
  SELECT s_suppkey AS event_id, s_name AS event_name,
         DATE '2024-01-01' + CAST(s_suppkey % 28 AS INTEGER) AS start_date,
         DATE '2024-01-01' + CAST(s_suppkey % 28 + s_suppkey % 3 AS INTEGER) AS end_date,
         30.101e0 + s_nationkey * 0.0168e0 AS event_lat,
         -97.94e0 + ((s_nationkey * 7) % 25) * 0.0156e0 AS event_lon,
         s_suppkey % 2 = 0 AS has_alcohol, s_suppkey % 3 = 0 AS has_amplified_sound
  FROM supplier),
near_calls AS (
  SELECT c.*, f.*, {_haversine('latitude_centroid', 'longitude_centroid', 'event_lat', 'event_lon')}
           AS distance_km
  FROM enriched c JOIN festivals f
    ON c.latitude_centroid IS NOT NULL
   AND c.response_date BETWEEN f.start_date AND f.end_date),
fact AS (
  SELECT incident_number, event_id, event_name, distance_km, response_datetime, priority_level,
         priority_numeric, latitude_centroid, longitude_centroid, geo_id,
         start_date AS event_start_date, end_date AS event_end_date,
         has_alcohol AS event_has_alcohol, has_amplified_sound AS event_has_amplified_sound,
         final_problem_category, response_time
  FROM near_calls
  WHERE response_datetime <= CAST(end_date AS TIMESTAMP) AND distance_km <= 1.5e0),
flagged AS (
  SELECT c.*, incident_number IN (SELECT incident_number FROM fact) AS is_festival_related
  FROM enriched c),
hours AS (
  SELECT datetime, date_diff('hour', TIMESTAMP '2024-01-01', datetime) AS h
  FROM (SELECT DISTINCT date_trunc('hour', ts) AS datetime FROM events)),
weather_raw AS (
  SELECT datetime, ((h * 37) % 400) / 10e0 - 5 AS temperature_c,
         CAST(30 + (h * 13) % 70 AS DOUBLE) AS humidity_pct,
         CASE WHEN h % 13 = 0 THEN NULL WHEN h % 11 = 0 THEN (h % 7) * 0.3e0 ELSE 0e0 END
           AS precipitation_mm,
         CASE WHEN h % 13 = 0 THEN NULL WHEN h % 11 = 0 THEN (h % 7) * 0.3e0 ELSE 0e0 END
           AS rain_mm,
         CASE WHEN h % 17 > 0 THEN [0, 1, 2, 3, 45, 51, 61, 71, 80, 95][h % 10 + 1] END
           AS weather_code,
         CAST((h * 7) % 50 AS DOUBLE) AS wind_speed_kmh,
         CAST((h * 7) % 50 + 10 AS DOUBLE) AS wind_gusts_kmh
  FROM hours),
weather AS (
  SELECT *, CAST(datetime AS DATE) AS date, hour(datetime) AS hour,
         strftime(datetime, '%A') AS day_of_week, month(datetime) AS month,
         year(datetime) AS year, temperature_c * 9 / 5 + 32 AS temperature_f,
         CASE WHEN weather_code IS NULL THEN 'Unknown' WHEN weather_code = 0 THEN 'Clear'
              WHEN weather_code IN (1, 2, 3) THEN 'Partly Cloudy'
              WHEN weather_code IN (45, 48) THEN 'Fog'
              WHEN weather_code IN (51, 53, 55, 56, 57) THEN 'Drizzle'
              WHEN weather_code IN (61, 63, 65, 66, 67) THEN 'Rain'
              WHEN weather_code IN (71, 73, 75, 77) THEN 'Snow'
              WHEN weather_code IN (80, 81, 82) THEN 'Rain Showers'
              WHEN weather_code IN (85, 86) THEN 'Snow Showers'
              WHEN weather_code IN (95, 96, 99) THEN 'Thunderstorm' ELSE 'Other' END
           AS weather_category,
         coalesce(precipitation_mm > 0.1e0, false) AS is_raining,
         CASE WHEN temperature_c * 9 / 5 + 32 < 32 THEN 'Freezing'
              WHEN temperature_c * 9 / 5 + 32 < 50 THEN 'Cold'
              WHEN temperature_c * 9 / 5 + 32 < 70 THEN 'Mild'
              WHEN temperature_c * 9 / 5 + 32 < 85 THEN 'Warm' ELSE 'Hot' END AS temp_category
  FROM weather_raw),
calls_weather AS (
  SELECT c.*, w.datetime AS join_hour, w.temperature_f, w.precipitation_mm, w.humidity_pct,
         w.weather_category, w.is_raining, w.temp_category
  FROM enriched c JOIN weather w ON date_trunc('hour', c.response_datetime) = w.datetime),
events_summary AS (
  SELECT event_id, event_name, count(*) AS incident_count, avg(priority_numeric) AS avg_priority,
         avg(distance_km) AS avg_distance_km, bool_or(event_has_alcohol) AS has_alcohol,
         bool_or(event_has_amplified_sound) AS has_amplified_sound
  FROM fact GROUP BY event_id, event_name),
top_type AS (
  SELECT event_id, final_problem_category AS top_incident_type
  FROM (SELECT event_id, final_problem_category,
               row_number() OVER (PARTITION BY event_id
                                  ORDER BY count(*) DESC, final_problem_category) AS r
        FROM fact GROUP BY event_id, final_problem_category)
  WHERE r = 1),
pivoted AS (
  SELECT event_id,
         count(*) FILTER (priority_level = 'Priority 0') AS count_priority_0,
         count(*) FILTER (priority_level = 'Priority 1') AS count_priority_1,
         count(*) FILTER (priority_level = 'Priority 2') AS count_priority_2,
         count(*) FILTER (priority_level = 'Priority 3') AS count_priority_3
  FROM fact GROUP BY event_id),
metrics AS (
  SELECT f.event_id, f.event_name, count(*) AS incident_count,
         avg(priority_numeric) AS avg_priority, min(priority_numeric) AS min_priority,
         avg(distance_km) AS avg_distance, avg(response_time) AS avg_response_time,
         bool_or(event_has_alcohol) AS has_alcohol,
         bool_or(event_has_amplified_sound) AS has_amplified_sound
  FROM fact f GROUP BY f.event_id, f.event_name),
scored AS (
  SELECT m.*, p.* EXCLUDE (event_id), t.top_incident_type,
         incident_count * 100e0 / (SELECT max(incident_count) FROM metrics) AS incident_score,
         CASE WHEN (SELECT max(count_priority_0) FROM pivoted) > 0
              THEN 4 * count_priority_0 + 3 * count_priority_1 + 2 * count_priority_2
                   + count_priority_3 ELSE 0 END AS priority_score,
         greatest(0e0, least(100e0, (1 - avg_distance / 1.5e0) * 100)) AS distance_score
  FROM metrics m JOIN pivoted p ON m.event_id = p.event_id
  JOIN top_type t ON m.event_id = t.event_id),
normed AS (
  SELECT *, CASE WHEN (SELECT max(priority_score) FROM scored) > 0
                 THEN priority_score * 100e0 / (SELECT max(priority_score) FROM scored)
                 ELSE 0e0 END AS priority_score_norm
  FROM scored),
risky AS (
  SELECT *, incident_score * 0.4e0 + priority_score_norm * 0.35e0 + distance_score * 0.15e0
            + CASE WHEN has_alcohol THEN 10 ELSE 0 END AS risk_score
  FROM normed),
risk AS (
  SELECT *, CASE WHEN risk_score >= 70 THEN 'HIGH' WHEN risk_score >= 40 THEN 'MEDIUM'
                 ELSE 'LOW' END AS risk_category
  FROM risky),
summary AS (
  SELECT f.event_id, f.event_name, f.has_alcohol, count(x.incident_number) AS incident_count,
         avg(c.priority_numeric) AS avg_priority
  FROM festivals f LEFT JOIN fact x ON f.event_id = x.event_id
  LEFT JOIN calls c ON x.incident_number = c.incident_number
  GROUP BY f.event_id, f.event_name, f.has_alcohol),
scores_v1 AS (
  SELECT event_id, event_name, incident_count, avg_priority,
         incident_count * 0.5e0 + (4 - coalesce(avg_priority, 2e0)) * 10
           + CASE WHEN has_alcohol THEN 10 ELSE 0 END AS risk_score,
         CASE WHEN incident_count * 0.5e0 + (4 - coalesce(avg_priority, 2e0)) * 10 > 50
                THEN 'HIGH'
              WHEN incident_count * 0.5e0 + (4 - coalesce(avg_priority, 2e0)) * 10 > 25
                THEN 'MEDIUM' ELSE 'LOW' END AS risk_category,
         has_alcohol
  FROM summary),
places AS (
  SELECT latitude_centroid AS latitude, longitude_centroid AS longitude,
         count(*) AS incident_count, avg(priority_numeric) AS avg_priority,
         avg(response_time) AS avg_response_time, avg(response_hour) AS avg_hour,
         ln(1 + count(*)) AS log_incidents,
         ln(1 + count(*)) * 0.5e0 + (4 - avg(priority_numeric)) * 0.3e0
           + avg(response_time) / 600 * 0.2e0 AS location_risk
  FROM enriched WHERE latitude_centroid IS NOT NULL
  GROUP BY latitude_centroid, longitude_centroid),
clustered AS (
  SELECT *, CAST(round((latitude - 30.10e0) / 0.0168e0) AS INTEGER) % 7 AS cluster FROM places),
clusters AS (
  SELECT cluster, round_even(avg(latitude), 2) AS center_lat,
         round_even(avg(longitude), 2) AS center_lon, sum(incident_count) AS total_incidents,
         round_even(avg(incident_count), 2) AS avg_incidents,
         round_even(avg(avg_priority), 2) AS avg_priority,
         round_even(avg(location_risk), 2) AS avg_risk
  FROM clustered GROUP BY cluster),
long_calls AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS incident_number, o_orderdate AS response_datetime,
         CASE WHEN left(o_orderpriority, 1) < '5'
              THEN CAST(left(o_orderpriority, 1) AS INTEGER) - 1 ELSE 9 END AS priority_numeric,
         o_totalprice / 100 AS response_time
  FROM orders),
long_daily AS (
  SELECT CAST(response_datetime AS DATE) AS date, count(*) AS call_count,
         avg(priority_numeric) AS avg_priority, avg(response_time) AS avg_response_time
  FROM long_calls GROUP BY 1),
long_weather AS (
  SELECT date, CAST(40 + (w * 13) % 50 AS DOUBLE) AS temp_avg_f,
         (w % 9) * 0.5e0 AS precipitation_total_mm, CAST(30 + (w * 7) % 60 AS DOUBLE)
           AS humidity_avg_pct
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
               date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS w FROM orders)),
calendar AS (
  SELECT *, isodow(date) - 1 AS day_of_week, month(date) AS month, day(date) AS day_of_month,
         CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         sin(2 * pi() * (isodow(date) - 1) / 7) AS dow_sin,
         cos(2 * pi() * (isodow(date) - 1) / 7) AS dow_cos,
         sin(2 * pi() * month(date) / 12) AS month_sin,
         cos(2 * pi() * month(date) / 12) AS month_cos
  FROM long_daily),
naive AS (
  SELECT * FROM (
    SELECT date, CAST(call_count AS DOUBLE) AS actual,
           CAST(lag(call_count) OVER (ORDER BY date) AS DOUBLE) AS predicted FROM long_daily)
  WHERE predicted IS NOT NULL),
permits AS (
  SELECT s_suppkey AS event_id, trim(s_name) AS event_name, s_suppkey AS s,
         CASE WHEN s_suppkey % 11 > 0
              THEN DATE '2024-01-01' + CAST(s_suppkey % 28 AS INTEGER) END AS start_date,
         CASE WHEN s_suppkey % 13 > 0
              THEN DATE '2024-01-01' + CAST(s_suppkey % 28 + s_suppkey % 3 AS INTEGER) END
           AS end_date,
         CASE WHEN s_suppkey % 7 > 0 THEN 30.101e0 + s_nationkey * 0.0168e0 END AS event_lat,
         CASE WHEN s_suppkey % 7 <> 1 THEN -97.94e0 + s_nationkey * 0.05e0 END AS event_lon,
         s_suppkey % 3 = 0 AS has_alcohol, s_suppkey % 5 IN (0, 1, 3) AS has_amplified_sound,
         s_suppkey % 4 >= 2 AS has_road_closure
  FROM supplier),
raw_calls AS (
  SELECT CAST(event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END AS VARCHAR)
           AS incident_number,
         CASE WHEN event_id % 4 > 0 THEN 'Call' END AS incident_type,
         CASE WHEN user_id % 6 < 5 THEN 'Priority ' || (user_id % 6) END AS priority_level,
         CASE WHEN event_id % 50 <> 7 THEN date_trunc('second', ts) END AS response_datetime,
         date_trunc('second', ts) AS call_closed_datetime, value * 60 AS response_time,
         CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN '000048453001'
              ELSE CAST(484530001000 + user_id % 30 AS VARCHAR) END AS geo_id,
         CASE WHEN user_id % 3 > 0 THEN event_type END AS final_problem_category,
         CASE WHEN user_id % 4 > 0 THEN 'N' END AS mental_health_flag,
         CAST(user_id % 9 AS VARCHAR) AS sector
  FROM events),
slots AS (
  SELECT incident_number, list_sort(['dow_' || response_day_of_week,
           'time_' || CASE WHEN response_hour <= 6 THEN 'Night' WHEN response_hour <= 12
                           THEN 'Morning' WHEN response_hour <= 18 THEN 'Afternoon'
                           ELSE 'Evening' END,
           'cat_' || final_problem_category]) AS items
  FROM calls WHERE response_hour > 0),
basket_calls AS (
  SELECT incident_number, ['Weather_' || weather_category, 'Temp_' || temp_category] AS sky,
         response_hour, response_day_of_week, priority_level, final_problem_category
  FROM calls_weather
  UNION ALL
  SELECT incident_number, CAST([] AS VARCHAR[]), response_hour, response_day_of_week,
         priority_level, final_problem_category
  FROM calls WHERE false),
full_baskets AS (
  SELECT incident_number, list_sort(sky || [
           CASE WHEN response_hour < 6 THEN 'Time_Night' WHEN response_hour < 12
                THEN 'Time_Morning' WHEN response_hour < 18 THEN 'Time_Afternoon'
                ELSE 'Time_Evening' END,
           CASE WHEN response_day_of_week IN ('Sat', 'Sun') THEN 'Weekend' ELSE 'Weekday' END,
           'Priority_' || replace(priority_level, ' ', ''),
           'Incident_' || split_part(trim(final_problem_category), ' ', 1)]) AS items
  FROM basket_calls),
plain_baskets AS (
  SELECT incident_number, list_sort([
           CASE WHEN response_hour < 6 THEN 'Time_Night' WHEN response_hour < 12
                THEN 'Time_Morning' WHEN response_hour < 18 THEN 'Time_Afternoon'
                ELSE 'Time_Evening' END,
           CASE WHEN response_day_of_week IN ('Sat', 'Sun') THEN 'Weekend' ELSE 'Weekday' END,
           'Priority_' || replace(priority_level, ' ', ''),
           'Incident_' || split_part(trim(final_problem_category), ' ', 1)]) AS items
  FROM calls),
planned_raw AS (
  SELECT o_orderkey AS event_id, 100 + o_custkey * 60 AS expected_attendance,
         o_orderkey % 2 = 1 AS has_alcohol, CAST(o_orderdate AS DATE) AS event_date,
         o_orderkey % 24 AS start_hour, isodow(o_orderdate) >= 6 AS is_weekend,
         {_list([*planned.ZONES, 'Elsewhere'])}[o_custkey % 7 + 1] AS location,
         {_list([*planned.WEATHER_FACTORS, 'Fog'])}[o_orderkey % 6 + 1] AS weather_condition,
         60 + o_orderkey % 45 AS temperature
  FROM orders),
planned_zone AS (
  SELECT *, {_case('location', {k: _q(v[0]) for k, v in planned.ZONES.items()}, "'LOW'")}
              AS zone_category,
         {_case('location', {k: _double(v[1]) for k, v in planned.ZONES.items()}, '30.30e0')}
              AS zone_lat,
         {_case('location', {k: _double(v[2]) for k, v in planned.ZONES.items()}, '-97.75e0')}
              AS zone_lon,
         {_case('weather_condition',
                {k: _double(v) for k, v in planned.WEATHER_FACTORS.items()}, '1e0')}
              AS weather_factor
  FROM planned_raw),
planned_count AS (
  SELECT *, CAST(floor(expected_attendance * 0.002e0
           * CASE WHEN has_alcohol THEN 1.315e0 ELSE 1e0 END
           * CASE WHEN is_weekend THEN 1.15e0 ELSE 1e0 END
           * CASE WHEN start_hour >= 20 OR start_hour <= 4 THEN 1.25e0 ELSE 1e0 END
           * CASE zone_category WHEN 'HIGH' THEN 1.4e0 WHEN 'MEDIUM' THEN 1.15e0 ELSE 1e0 END
           * weather_factor) AS BIGINT) AS predicted_incidents
  FROM planned_zone),
planned_scored AS (
  SELECT *, least(100e0, predicted_incidents / 50e0 * 0.4e0
           + CASE WHEN has_alcohol THEN 20 ELSE 0 END
           + CASE zone_category WHEN 'HIGH' THEN 20 WHEN 'MEDIUM' THEN 10 ELSE 0 END
           + CASE WHEN is_weekend THEN 10 ELSE 0 END
           + CASE WHEN start_hour >= 20 THEN 10 ELSE 0 END) AS risk_score
  FROM planned_count),
match_raw AS (
  SELECT o_orderkey AS match_id, {_list(matches.PHASES)}[o_orderkey % 6 + 1] AS match_type,
         {_STADIUMS}[o_custkey % 6 + 1] AS stadium,
         {_TEAMS}[o_orderkey % 24 + 1] AS team1,
         {_TEAMS}[(o_orderkey + 1 + o_custkey % 23) % 24 + 1] AS team2,
         [14, 17, 20, 21][o_orderkey % 4 + 1] AS match_hour, o_orderdate,
         10000 + (o_custkey * 37) % 35000 AS expected_attendance,
         5 + o_orderkey % 40 AS temperature,
         {_list(matches.WEATHER)}[o_custkey % 4 + 1] AS weather_condition,
         o_orderkey % 3 = 0 AS alcohol_zones
  FROM orders),
match_factors AS (
  SELECT *, {_case('stadium', {k: _q(v[0]) for k, v in matches.STADIUMS.items()}, 'NULL')} AS city,
         {_case('stadium', {k: v[1] for k, v in matches.STADIUMS.items()}, 'NULL')} AS capacity,
         {_case('stadium', {k: _double(v[4]) for k, v in matches.STADIUMS.items()}, 'NULL')}
           AS stadium_factor,
         {_case('match_type', {k: _double(v) for k, v in matches.PHASES.items()}, '1e0')}
           AS phase_factor,
         CASE WHEN match_hour >= 20 THEN 1.3e0 WHEN match_hour >= 17 THEN 1.1e0 ELSE 1e0 END
           AS time_factor,
         CASE {' '.join(
             f"WHEN (team1 = {_q(a)} AND team2 = {_q(b)}) OR (team1 = {_q(b)} AND team2 = {_q(a)})"
             f" THEN {_double(f)}" for a, b, f in matches.RIVALRIES)} ELSE 1e0 END
           AS rivalry_factor,
         CASE WHEN team1 = 'Morocco' OR team2 = 'Morocco' THEN 1.5e0 ELSE 1e0 END AS host_factor,
         CASE WHEN isodow(o_orderdate) >= 6 THEN 1.2e0 ELSE 1e0 END AS weekend_factor,
         {_case('weather_condition', {k: _double(v) for k, v in matches.WEATHER.items()}, '1e0')}
           AS weather_factor,
         CASE WHEN alcohol_zones THEN 1.4e0 ELSE 1e0 END AS alcohol_factor
  FROM match_raw),
match_total AS (
  SELECT *, expected_attendance / CAST(capacity AS DOUBLE) * 100 AS fill_rate,
         stadium_factor * phase_factor * time_factor * rivalry_factor * host_factor
           * weekend_factor * weather_factor * alcohol_factor
           * (expected_attendance / CAST(capacity AS DOUBLE) * 100 / 100) AS total_factor
  FROM match_factors),
match_scored AS (
  SELECT *, CAST(floor(15 * (expected_attendance / 10000e0) * total_factor) AS BIGINT)
              AS predicted_incidents,
         least(100e0, total_factor * 30) AS risk_score,
         CASE WHEN total_factor * 30 >= 70 THEN 'CRITIQUE' WHEN total_factor * 30 >= 50
              THEN 'ÉLEVÉ' WHEN total_factor * 30 >= 30 THEN 'MODÉRÉ' ELSE 'FAIBLE' END
           AS risk_category
  FROM match_total),
match_rows AS (
  SELECT o_orderkey AS match_id, strftime(o_orderdate, '%d/%m/%Y') AS date, o_orderdate,
         ['14:00', '17:00', '20:00', '21:00'][o_orderkey % 4 + 1] AS time,
         {_TEAMS}[o_orderkey % 24 + 1] AS team1,
         {_TEAMS}[(o_orderkey + 1 + o_custkey % 23) % 24 + 1] AS team2,
         CASE WHEN o_orderkey % 5 < 3 AND o_custkey % 5 > 0
              THEN (o_custkey % 4) || '-' || (o_orderkey % 3) END AS score,
         o_custkey % 4 AS g1, o_orderkey % 3 AS g2,
         ['Terminé', 'Terminé', 'En cours', 'À venir', 'À déterminer'][o_orderkey % 5 + 1]
           AS status,
         {_STADIUMS}[o_custkey % 6 + 1] AS stadium,
         {_list(v[0] for v in matches.STADIUMS.values())}[o_custkey % 6 + 1] AS city,
         ['Groupe A', 'Huitièmes', 'Quarts'][o_custkey % 3 + 1] AS phase
  FROM orders),
geo_update AS (
  SELECT lpad(CAST(484530001000 + n_nationkey * 2 AS VARCHAR), 12, '0') AS geo_id,
         31e0 + n_nationkey AS latitude_centroid, -97e0 - n_nationkey AS longitude_centroid,
         n_nationkey * 2.5e0 AS area_sq_km
  FROM nation WHERE n_nationkey % 2 = 0)
"""


def _oracle(name: str, body: str, d: str = "", i: str = "", t: str = "", s: str = "") -> None:
    parts = [
        f"CASE WHEN round({c} + 1e-9, 6) = 0 THEN 0e0 ELSE round({c} + 1e-9, 6) END AS {c}"
        for c in d.split()
    ]
    parts += [f"CAST({c} AS BIGINT) AS {c}" for c in i.split()]
    parts += [f"CAST({c} AS VARCHAR) AS {c}" for c in t.split()]
    parts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in s.split()]
    replace = f" REPLACE ({', '.join(parts)})" if parts else ""
    ctes = SHARED.rstrip()
    if body.lstrip().upper().startswith("WITH "):
        extra, body = body.lstrip()[5:].split("\n---\n")
        ctes = ctes + ",\n" + extra
    ORACLES[name] = f"WITH {ctes}\nSELECT *{replace} FROM (\n{body.strip()}\n)"


def _integral(f: str, low: str, high: str, steps: int = 4096) -> str:
    """Simpson's rule for ``f``, an expression of x, between two expressions of columns."""
    h = f"((({high}) - ({low})) / {steps}e0)"
    weight = f"CASE WHEN k = 0 OR k = {steps} THEN 1e0 WHEN k % 2 = 1 THEN 4e0 ELSE 2e0 END"
    point = f.replace("{x}", f"(({low}) + k * {h})")
    return f"({h} / 3e0 * list_sum(list_transform(range({steps + 1}), lambda k: {weight} * ({point}))))"


def _student(t: str, dof: str) -> str:
    """Two-sided p-value: with x = sqrt(dof) tan(a) the density is a power of cos(a).

    Forty deviations hold all of it that a double can tell.
    """
    power, wide = f"pow(cos({{x}}), {dof} - 1)", f"40e0 / sqrt({dof})"
    angle = f"atan(abs({t}) / sqrt({dof}))"
    tail = _integral(power, angle, f"least(pi() / 2, {angle} + {wide})")
    return f"({tail} / {_integral(power, '0e0', f'least(pi() / 2, {wide})')})"


def _starred(source: str) -> str:
    return f"""SELECT *, CASE WHEN p_value < 0.001 THEN '***' WHEN p_value < 0.01 THEN '**'
         WHEN p_value < 0.05 THEN '*' ELSE '' END AS stars FROM ({source})"""


# ---- sources ---------------------------------------------------------------------------------

_oracle("scan_parquet", "SELECT event_id, event_type, value FROM events", d="value", i="event_id")
_oracle(
    "date_range_of_calls",
    """SELECT min(response_datetime) AS min_date, max(response_datetime) AS max_date,
       year(min(response_datetime)) AS start_year, year(max(response_datetime)) AS end_year
       FROM calls""",
    i="start_year end_year", s="min_date max_date",
)
_oracle(
    "weather_from_json", "SELECT * FROM weather_raw",
    d="temperature_c humidity_pct precipitation_mm rain_mm wind_speed_kmh wind_gusts_kmh",
    i="weather_code", s="datetime",
)
_oracle(
    "match_results",
    """SELECT match_id, date, time, team1, team2, score, status, team1 || ' 10''' AS scorers,
       stadium, 1000 AS attendance,
       o_orderdate + CAST(left(time, 2) AS INTEGER) * INTERVAL 1 HOUR AS kickoff
       FROM match_rows""",
    i="match_id attendance", s="kickoff",
)
_oracle(
    "stored_standings",
    """SELECT phase AS group_name, team1 AS team, 1 AS played, 1 AS won, 0 AS drawn, 0 AS lost,
       2 AS gf, 0 AS ga, 2 AS gd, 3 AS points FROM match_rows""",
    i="played won drawn lost gf ga gd points",
)
_oracle(
    "union_chunks",
    """SELECT incident_number, response_hour, CASE WHEN response_hour >= 12 THEN geo_id END
       AS geo_id FROM calls""",
    i="response_hour",
)

# ---- cleaning --------------------------------------------------------------------------------

_oracle(
    "format_geo_id",
    """SELECT incident_number, strftime(call_closed_datetime, '%Y-%m-%d %H:%M:%S')
       AS call_closed_datetime, geo_id FROM raw_calls""",
)
_oracle("parse_dates", "SELECT event_id, start_date, end_date FROM permits",
        i="event_id", t="start_date end_date")
_oracle(
    "clean_calls",
    """SELECT incident_number, coalesce(incident_type, 'Unknown') AS incident_type, priority_level,
       CASE priority_level WHEN 'Priority 0' THEN 0 WHEN 'Priority 1' THEN 1
         WHEN 'Priority 2' THEN 2 WHEN 'Priority 3' THEN 3 ELSE 9 END AS priority_numeric,
       response_datetime, CAST(response_datetime AS DATE) AS response_date,
       strftime(response_datetime, '%Y-%m') AS response_month,
       year(response_datetime) AS response_year,
       strftime(response_datetime, '%a') AS response_day_of_week,
       hour(response_datetime) AS response_hour, response_time, call_closed_datetime, sector,
       geo_id, coalesce(final_problem_category, 'Unknown') AS final_problem_category,
       coalesce(mental_health_flag, 'Unknown') AS mental_health_flag
       FROM (SELECT *, row_number() OVER (PARTITION BY incident_number
               ORDER BY response_datetime NULLS LAST, response_time) AS r FROM raw_calls)
       WHERE r = 1""",
    d="response_time", i="priority_numeric response_year response_hour", t="response_date",
    s="response_datetime call_closed_datetime",
)
_oracle(
    "clean_events",
    """SELECT event_id, event_name, 'ACE' AS event_type,
       ['Active', 'Closed', 'Pending'][s % 3 + 1] AS status, start_date, end_date,
       date_diff('day', start_date, end_date) + 1 AS event_length_days,
       year(start_date) AS event_year, month(start_date) AS event_month, event_lat, event_lon,
       has_alcohol, has_amplified_sound, has_road_closure, 'Org' AS organizer,
       CASE s % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE 'Full' END AS road_closure
       FROM permits""",
    d="event_lat event_lon", i="event_id event_length_days event_year event_month",
    t="start_date end_date",
)
_oracle(
    "event_flags",
    "SELECT event_id, has_alcohol, has_amplified_sound, has_road_closure FROM permits",
    i="event_id",
)
_oracle(
    "event_coords",
    """SELECT event_id, event_lat, event_lon,
       coalesce(event_lat BETWEEN 29 AND 32 AND event_lon BETWEEN -99 AND -96, false) AS in_area
       FROM permits""",
    d="event_lat event_lon", i="event_id",
)
_oracle(
    "dim_geo_lookup",
    """SELECT CAST(484530001000 + n_nationkey AS VARCHAR) AS geo_id,
       30.10e0 + n_nationkey * 0.0168e0 AS latitude_centroid,
       -97.94e0 + n_nationkey * 0.0156e0 AS longitude_centroid,
       (n_nationkey + 1) * 1250000 / 1e6 AS area_sq_km
       FROM nation WHERE n_nationkey % 5 < 4""",
    d="latitude_centroid longitude_centroid area_sq_km",
)
_oracle(
    "dim_venue",
    """SELECT venue_id, name, latitude, longitude, address, city, state, country, category, poi_id,
       coalesce(nullif(trim(split_part(category, ',', 1)), ''), 'Unknown') AS primary_category
       FROM (SELECT *, row_number() OVER (PARTITION BY venue_id ORDER BY name, latitude, longitude)
               AS r
             FROM (SELECT CAST(p_partkey - CASE WHEN p_partkey % 20 = 19 THEN 1 ELSE 0 END
                     AS VARCHAR) AS venue_id, p_name || ' ' || p_partkey AS name,
                   CASE WHEN p_partkey % 10 > 0 THEN 30e0 + p_size * 0.01e0 END AS latitude,
                   -97.9e0 + p_size * 0.01e0 AS longitude,
                   CASE WHEN p_partkey % 3 > 0 THEN 'Main St' ELSE '' END AS address,
                   CASE WHEN p_partkey % 4 > 0 THEN 'Austin' ELSE '' END AS city,
                   'TX' AS state, ['US', 'MX', 'CA'][p_size % 3 + 1] AS country,
                   CASE p_partkey % 6 WHEN 0 THEN 'Unknown' WHEN 1 THEN ' ,x'
                     ELSE p_type || ' , ' || p_brand END AS category,
                   CAST(p_partkey AS VARCHAR) AS poi_id FROM part)
             WHERE latitude IS NOT NULL)
       WHERE r = 1""",
    d="latitude longitude",
)
_oracle(
    "dedupe_first",
    """SELECT geo_id, incident_number, response_datetime, response_time
       FROM (SELECT *, row_number() OVER (PARTITION BY geo_id
               ORDER BY response_datetime, incident_number) AS r FROM calls) WHERE r = 1""",
    d="response_time", s="response_datetime",
)
_oracle(
    "weather_features", "SELECT * FROM weather",
    d="temperature_c humidity_pct precipitation_mm rain_mm wind_speed_kmh wind_gusts_kmh "
      "temperature_f",
    i="weather_code hour month year", t="date", s="datetime",
)
_oracle(
    "weather_daily",
    """SELECT date, min(temperature_f) AS temp_min_f, max(temperature_f) AS temp_max_f,
       avg(temperature_f) AS temp_avg_f, sum(precipitation_mm) AS precipitation_total_mm,
       avg(humidity_pct) AS humidity_avg_pct, max(wind_speed_kmh) AS wind_max_kmh,
       bool_or(is_raining) AS had_rain FROM weather GROUP BY date""",
    d="temp_min_f temp_max_f temp_avg_f precipitation_total_mm humidity_avg_pct wind_max_kmh",
    t="date",
)
_oracle(
    "cyclic_features",
    """SELECT c.date, day_of_week, month, day_of_month, is_weekend, dow_sin, dow_cos, month_sin,
       month_cos, day_of_month % 24 AS hour, sin(2 * pi() * (day_of_month % 24) / 24) AS hour_sin,
       cos(2 * pi() * (day_of_month % 24) / 24) AS hour_cos
       FROM calendar c
       WHERE day_of_month % 24 IN (SELECT response_hour FROM calls)""",
    d="dow_sin dow_cos month_sin month_cos hour_sin hour_cos",
    i="day_of_week month day_of_month is_weekend hour", t="date",
)
_oracle(
    "haversine",
    f"""SELECT geo_id, {_haversine('latitude_centroid', 'longitude_centroid', '30.27e0',
                                   '-97.74e0')} AS distance_km FROM geo""",
    d="distance_km",
)
_oracle(
    "sample_n",
    """SELECT incident_number, response_time FROM calls
       ORDER BY md5(incident_number || '-42'), incident_number LIMIT 500""",
    d="response_time",
)

# ---- joins -----------------------------------------------------------------------------------

_oracle(
    "enrich_geo",
    """SELECT incident_number, geo_id, latitude_centroid, longitude_centroid, area_sq_km
       FROM enriched""",
    d="latitude_centroid longitude_centroid area_sq_km",
)
_oracle(
    "unmatched_geo",
    """SELECT geo_id, count(*) AS call_count FROM calls
       WHERE geo_id NOT IN (SELECT geo_id FROM geo)
       GROUP BY geo_id ORDER BY call_count DESC, geo_id LIMIT 10""",
)
_oracle(
    "geo_match_rate",
    """SELECT count(*) AS total, count(latitude_centroid) AS matched,
       count(latitude_centroid) * 100e0 / count(*) AS match_rate FROM enriched""",
    d="match_rate",
)
_FACT = dict(
    d="distance_km latitude_centroid longitude_centroid response_time",
    i="event_id priority_numeric", t="event_start_date event_end_date", s="response_datetime",
)
_oracle("festival_incidents", "SELECT * FROM fact", **_FACT)
_oracle("festival_incidents_shuffled", "SELECT incident_number, event_id, distance_km FROM fact",
        d="distance_km", i="event_id")
_oracle(
    "festival_incidents_day",
    """SELECT incident_number, event_id, distance_km, event_name,
       has_alcohol AS event_has_alcohol FROM near_calls WHERE distance_km <= 0.5e0""",
    d="distance_km", i="event_id",
)
_oracle(
    "events_in_range",
    """SELECT event_id, start_date, end_date FROM festivals
       WHERE CAST(end_date AS TIMESTAMP) >= (SELECT min(response_datetime) FROM calls)
         AND CAST(start_date AS TIMESTAMP) <= (SELECT max(response_datetime) FROM calls)""",
    i="event_id", t="start_date end_date",
)
_oracle(
    "calls_weather",
    """SELECT incident_number, join_hour, temperature_f, precipitation_mm, humidity_pct,
       weather_category, is_raining, temp_category FROM calls_weather""",
    d="temperature_f precipitation_mm humidity_pct", s="join_hour",
)
_oracle("calls_festival_flag", "SELECT incident_number, is_festival_related FROM flagged")
_oracle("distinct_ids", "SELECT DISTINCT incident_number FROM fact")
_NEAR = _haversine("latitude_centroid", "longitude_centroid", "30.27e0", "-97.74e0")
_oracle(
    "nearby_incidents",
    f"""SELECT incident_number, {_NEAR} * 1000 AS distance_m, priority_level, response_datetime
        FROM enriched WHERE latitude_centroid IS NOT NULL AND {_NEAR} <= 5""",
    d="distance_m", s="response_datetime",
)
_oracle(
    "nearby_batch",
    f"""SELECT point_id, incident_number, distance_km * 1000 AS distance_m
        FROM (SELECT g.geo_id AS point_id, e.incident_number, {_haversine(
            'e.latitude_centroid', 'e.longitude_centroid',
            '(g.latitude_centroid + 0.001e0)', 'g.longitude_centroid')} AS distance_km
              FROM enriched e, geo g WHERE e.latitude_centroid IS NOT NULL)
        WHERE distance_km <= 2.5""",
    d="distance_m",
)
_oracle(
    "fk_nullify",
    """SELECT incident_number, CASE WHEN geo_id IN (SELECT geo_id FROM geo) THEN geo_id END
       AS geo_id FROM calls""",
)

# ---- aggregations ----------------------------------------------------------------------------

_oracle("events_summary", "SELECT * FROM events_summary",
        d="avg_priority avg_distance_km", i="event_id")
_oracle("priority_pivot", "SELECT * FROM pivoted", i="event_id")
_oracle("top_incident_type", "SELECT event_id, top_incident_type FROM top_type", i="event_id")
_oracle(
    "festival_risk", "SELECT * FROM risk",
    d="avg_priority avg_distance avg_response_time incident_score distance_score "
      "priority_score_norm risk_score",
    i="event_id min_priority priority_score",
)
_oracle(
    "risk_filtered",
    """SELECT event_id, event_name, incident_count, risk_score, risk_category FROM risk
       WHERE risk_category IN ('HIGH', 'MEDIUM') AND has_alcohol""",
    d="risk_score", i="event_id",
)
_oracle(
    "top_festivals",
    """SELECT event_id, event_name, incident_count, risk_category FROM risk
       ORDER BY incident_count DESC, event_id LIMIT 10""",
    i="event_id",
)
_oracle("risk_distribution",
        "SELECT risk_category, count(*) AS event_count FROM risk GROUP BY risk_category")
_ACTIVITY = """count(*) AS incident_count, avg(priority_numeric) AS avg_priority,
       avg(response_time) AS avg_response_time"""
_oracle(
    "weather_rates",
    f"""SELECT *, incident_count / CAST(total_hours AS DOUBLE) AS incidents_per_hour
        FROM (SELECT weather_category, {_ACTIVITY} FROM calls_weather GROUP BY 1)
        JOIN (SELECT weather_category, count(*) AS total_hours FROM weather GROUP BY 1)
        USING (weather_category)""",
    d="avg_priority avg_response_time incidents_per_hour",
)
_oracle("temp_incidents",
        f"SELECT temp_category, {_ACTIVITY} FROM calls_weather GROUP BY temp_category",
        d="avg_priority avg_response_time")
_oracle("rain_comparison",
        f"SELECT is_raining, {_ACTIVITY} FROM calls_weather GROUP BY is_raining",
        d="avg_priority avg_response_time")
_HOURLY = """SELECT join_hour, count(*) AS incident_count, max(temperature_f) AS temperature_f,
       max(precipitation_mm) AS precipitation_mm, max(humidity_pct) AS humidity_pct
       FROM calls_weather GROUP BY join_hour"""
_oracle("hourly_weather", _HOURLY, d="temperature_f precipitation_mm humidity_pct", s="join_hour")
_CORRELATED = _starred(f"""SELECT *, {_student("r * sqrt((n - 2) / (1 - r * r))", "(n - 2)")} AS p_value FROM (
SELECT 'temperature' AS variable, count(temperature_f) AS n,
       corr(temperature_f, incident_count) AS r FROM hourly
UNION ALL SELECT 'precipitation', count(precipitation_mm),
       corr(precipitation_mm, incident_count) FROM hourly
UNION ALL SELECT 'humidity', count(humidity_pct), corr(humidity_pct, incident_count)
FROM hourly)""")
_oracle("weather_correlation", f"WITH hourly AS ({_HOURLY})\n---\n{_CORRELATED}", d="r p_value")


def _two_sided(rows: list[tuple[str, str]], source: str, flag: str) -> str:
    selects = [
        f"SELECT {n} AS position, {_q(name)} AS metric, CAST({expr.format(f=flag)} AS DOUBLE) AS a,"
        f" CAST({expr.format(f='NOT ' + flag)} AS DOUBLE) AS b FROM {source}"
        for n, (name, expr) in enumerate(rows, 1)
    ]
    return "\nUNION ALL ".join(selects)


_ALCOHOL = _two_sided(
    [
        ("Event Count", "count(*) FILTER ({f})"),
        ("Total Incidents", "sum(incident_count) FILTER ({f})"),
        ("Avg Incidents per Event", "avg(incident_count) FILTER ({f})"),
        ("Median Incidents", "median(incident_count) FILTER ({f})"),
        ("Max Incidents", "max(incident_count) FILTER ({f})"),
        ("Avg Priority (lower=urgent)", "avg(avg_priority) FILTER ({f})"),
        ("Avg Distance (km)", "avg(avg_distance_km) FILTER ({f})"),
    ],
    "events_summary",
    "has_alcohol",
)
_oracle(
    "alcohol_summary",
    f"""SELECT position, metric, a AS with_alcohol, b AS without_alcohol, a - b AS difference,
        round_even((a - b) / nullif(b, 0) * 100, 1) AS pct_difference FROM ({_ALCOHOL})""",
    d="with_alcohol without_alcohol difference pct_difference", i="position",
)
_oracle(
    "alcohol_types",
    """WITH ranked AS (
  SELECT event_has_alcohol, final_problem_category AS category, count(*) AS n,
         row_number() OVER (PARTITION BY event_has_alcohol
                            ORDER BY count(*) DESC, final_problem_category) AS r
  FROM fact GROUP BY 1, 2)
---
SELECT category, a.n AS alcohol_count, b.n AS no_alcohol_count
FROM (SELECT * FROM ranked WHERE event_has_alcohol AND r <= 10) a
FULL JOIN (SELECT * FROM ranked WHERE NOT event_has_alcohol AND r <= 10) b USING (category)""",
)
_oracle("alcohol_priority",
        """SELECT event_has_alcohol, priority_level, count(*) AS incident_count
           FROM fact GROUP BY 1, 2""")
_oracle(
    "alcohol_avg_diff",
    """SELECT avg(incident_count) FILTER (has_alcohol)
       - avg(incident_count) FILTER (NOT has_alcohol) AS avg_diff FROM events_summary""",
    d="avg_diff",
)
_RESPONSE = _two_sided(
    [
        ("Count", "count(*) FILTER ({f})"),
        ("Mean (sec)", "avg(response_time) FILTER ({f})"),
        ("Mean (min)", "avg(response_time) FILTER ({f}) / 60"),
        ("Median (sec)", "median(response_time) FILTER ({f})"),
        ("Median (min)", "median(response_time) FILTER ({f}) / 60"),
        ("Std Dev", "stddev_samp(response_time) FILTER ({f})"),
        ("25th Percentile", "quantile_cont(response_time, 0.25) FILTER ({f})"),
        ("75th Percentile", "quantile_cont(response_time, 0.75) FILTER ({f})"),
        ("Min (sec)", "min(response_time) FILTER ({f})"),
        ("Max (sec)", "max(response_time) FILTER ({f})"),
    ],
    "(SELECT * FROM flagged WHERE response_time < 7200)",
    "is_festival_related",
)
_oracle(
    "response_summary",
    f"SELECT position, metric, a AS festival, b AS non_festival FROM ({_RESPONSE})",
    d="festival non_festival", i="position",
)
_oracle(
    "response_by_priority",
    """SELECT is_festival_related, priority_level, avg(response_time) AS mean_time,
       count(response_time) AS count, median(response_time) AS median_time
       FROM flagged GROUP BY 1, 2""",
    d="mean_time median_time",
)
_oracle(
    "response_by_hour",
    """SELECT is_festival_related, response_hour, avg(response_time) AS mean_response_time
       FROM flagged GROUP BY 1, 2""",
    d="mean_response_time", i="response_hour",
)
_oracle("location_features", "SELECT * FROM places",
        d="latitude longitude avg_priority avg_response_time avg_hour log_incidents location_risk")
_oracle("daily_calls", "SELECT * FROM long_daily", d="avg_priority avg_response_time", t="date")
_oracle("monthly_calls",
        """SELECT strftime(response_datetime, '%Y-%m') AS month, count(*) AS call_count
           FROM long_calls GROUP BY 1""")
_oracle(
    "zone_heatmap",
    """SELECT latitude_centroid AS latitude, longitude_centroid AS longitude,
       count(*) AS incident_count, CASE WHEN count(*) > 50 THEN 'HIGH_RISK'
         WHEN count(*) > 20 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_zone
       FROM enriched WHERE latitude_centroid IS NOT NULL GROUP BY 1, 2""",
    d="latitude longitude",
)
_oracle(
    "risk_heatmap_30d",
    """SELECT latitude_centroid AS lat, longitude_centroid AS lon, count(*) AS incident_count,
       avg(priority_numeric) AS avg_priority, CASE WHEN count(*) > 100 THEN 'HIGH'
         WHEN count(*) > 50 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
       FROM enriched
       WHERE response_datetime >= (SELECT max(response_date) FROM calls) - INTERVAL 30 DAY
       GROUP BY 1, 2""",
    d="lat lon avg_priority",
)
_oracle("festival_summary", "SELECT * FROM summary", d="avg_priority", i="event_id")
_oracle("risk_scores_sql_v1", "SELECT * FROM scores_v1", d="avg_priority risk_score", i="event_id")
_oracle(
    "risk_scores_sql_v2",
    """SELECT event_id, event_name, incident_count, avg_priority,
       incident_count * 0.5e0 + (4 - coalesce(avg_priority, 2e0)) * 10 AS risk_score,
       CASE WHEN incident_count > 50 THEN 'HIGH' WHEN incident_count > 20 THEN 'MEDIUM'
            ELSE 'LOW' END AS risk_category, has_alcohol FROM summary""",
    d="avg_priority risk_score", i="event_id",
)
_oracle(
    "db_stats",
    """SELECT (SELECT count(*) FROM calls) AS total_911_calls,
       (SELECT count(*) FROM festivals) AS total_events,
       (SELECT count(*) FROM scores_v1) AS total_risk_scores,
       (SELECT count(*) FROM calls
        WHERE response_date = (SELECT max(response_date) FROM calls)) AS today_calls""",
)
_oracle(
    "daily_report",
    """SELECT '{"pipeline_name":"pulsewatch_daily","run_id":"run-1",'
         || '"generated_at":"2024-02-01T06:00:00.000","report_date":"2024-02-01",'
         || '"status":"SUCCESS"}' AS report_metadata,
       '{"call_records":0,"event_records":0,"call_records_processed":' || total || '}'
         AS data_processing,
       '{"total_911_calls":' || total || ',"total_events":' || (SELECT count(*) FROM festivals)
         || ',"total_risk_scores":' || (SELECT count(*) FROM scores_v1) || ',"today_calls":'
         || (SELECT count(*) FROM calls WHERE response_date = (SELECT max(response_date) FROM calls))
         || '}' AS database_stats,
       '{"association_rules":{"status":"COMPLETED","rules_discovered":24},'
         || '"clustering":{"status":"SKIPPED"},"forecasting":{"status":"SKIPPED"},'
         || '"risk_scoring":{"status":"COMPLETED","distribution":{'
         || (SELECT string_agg('"' || risk_category || '":' || n, ',' ORDER BY risk_category)
             FROM (SELECT risk_category, count(*) AS n FROM scores_v1 GROUP BY risk_category))
         || '}}}' AS ml_models
       FROM (SELECT count(*) AS total FROM calls)""",
)
for _name in ("risk_heatmap_30d", "zone_heatmap", "db_stats"):
    ORACLES[f"{_name.removesuffix('_30d')}_merged"] = ORACLES[_name]
_oracle(
    "overview_kpis",
    """SELECT (SELECT count(*) FROM calls) AS total_calls,
       (SELECT count(*) FROM fact) AS festival_incidents,
       (SELECT count(DISTINCT incident_number) FROM fact) AS unique_incidents,
       (SELECT count(DISTINCT event_id) FROM fact) AS unique_events,
       (SELECT count(*) FROM risk) AS analyzed_festivals,
       (SELECT count(*) FROM risk WHERE risk_category = 'HIGH') AS high_risk_festivals""",
)
_oracle("value_counts",
        "SELECT priority_level AS value, count(*) AS count FROM calls GROUP BY priority_level")
_oracle(
    "alcohol_by_year",
    """SELECT year(start_date) AS event_year, count(*) AS event_count FROM permits
       WHERE has_alcohol AND start_date IS NOT NULL GROUP BY 1""",
    i="event_year",
)
_oracle(
    "distance_stats",
    """SELECT min(distance_km) AS min_km, max(distance_km) AS max_km, avg(distance_km) AS mean_km,
       median(distance_km) AS median_km FROM fact""",
    d="min_km max_km mean_km median_km",
)


def _describe(columns: list[str], source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT {_q(c)} AS column_name, count({c}) AS count, avg({c}) AS mean,"
        f" stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE)"
        f" AS max, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,"
        f" quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,"
        f" quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75 FROM {source}"
        for c in columns
    )


_DESCRIBED = "mean std min max p25 p50 p75"
_oracle("describe_geo",
        _describe(["latitude_centroid", "longitude_centroid", "area_sq_km"], "geo"), d=_DESCRIBED)
_oracle("describe_calls", _describe(["response_time", "response_hour"], "calls"), d=_DESCRIBED)
_oracle(
    "null_profile",
    "\nUNION ALL ".join(
        f"SELECT {_q(c)} AS column_name, count(*) - count({e}) AS null_count,"
        f" (count(*) - count({e})) * 100e0 / count(*) AS null_pct FROM raw_calls"
        for c, e in [
            ("incident_number", "incident_number"), ("incident_type", "incident_type"),
            ("priority_level", "priority_level"), ("response_datetime", "1"),
            ("call_closed_datetime", "1"), ("response_time", "response_time"),
            ("geo_id", "geo_id"), ("final_problem_category", "final_problem_category"),
            ("mental_health_flag", "mental_health_flag"), ("sector", "sector"),
        ]
    ),
    d="null_pct",
)
_oracle(
    "schedule_stats",
    """SELECT count(*) AS total_matches, count(*) FILTER (status = 'Terminé') AS finished,
       count(*) FILTER (status = 'En cours') AS live,
       count(*) FILTER (status = 'À venir') AS upcoming,
       count(*) FILTER (status = 'À déterminer') AS undetermined,
       count(DISTINCT stadium) AS stadiums FROM match_rows""",
)
_oracle(
    "head_n",
    """SELECT incident_number, event_id, priority_level FROM fact
       ORDER BY incident_number, event_id LIMIT 1000""",
    i="event_id",
)

# ---- windows and series ----------------------------------------------------------------------


def _rolling(n: int, fn: str, end: str = "CURRENT ROW", back: int | None = None) -> str:
    back = n - 1 if back is None else back
    frame = f"(ORDER BY date ROWS BETWEEN {back} PRECEDING AND {end})"
    return (
        f"CASE WHEN count(call_count) OVER {frame} = {n} THEN {fn}(call_count) OVER {frame} END"
    )


_oracle(
    "daily_features",
    f"""SELECT * FROM (
  SELECT c.*, {', '.join(f'lag(call_count, {k}) OVER (ORDER BY date) AS call_count_lag_{k}'
                        for k in (1, 7, 14, 28))},
         {', '.join(f'{_rolling(n, fn)} AS call_count_rolling_{name}_{n}' for n in (7, 14, 30)
                    for fn, name in (('avg', 'mean'), ('stddev_samp', 'std')))}
  FROM calendar c) JOIN long_weather USING (date)
WHERE call_count_lag_28 IS NOT NULL AND call_count_rolling_mean_30 IS NOT NULL""",
    d="avg_priority avg_response_time dow_sin dow_cos month_sin month_cos "
      "call_count_rolling_mean_7 call_count_rolling_std_7 call_count_rolling_mean_14 "
      "call_count_rolling_std_14 call_count_rolling_mean_30 call_count_rolling_std_30 "
      "temp_avg_f precipitation_total_mm humidity_avg_pct",
    i="day_of_week month day_of_month is_weekend", t="date",
)
_oracle(
    "daily_features_filled",
    f"""SELECT date, call_count, lag(call_count, 1) OVER (ORDER BY date) AS call_count_lag_1,
       lag(call_count, 7) OVER (ORDER BY date) AS call_count_lag_7,
       {_rolling(7, 'avg', '1 PRECEDING', 7)} AS call_count_rolling_mean_7,
       {_rolling(7, 'stddev_samp', '1 PRECEDING', 7)} AS call_count_rolling_std_7
       FROM (SELECT g.date, coalesce(d.call_count, 0) AS call_count
             FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))
                     AS DATE) AS date FROM long_daily) g
             LEFT JOIN long_daily d ON g.date = d.date)""",
    d="call_count_rolling_mean_7 call_count_rolling_std_7", t="date",
)
_oracle(
    "forecast_split",
    """SELECT date, call_count, row_number() OVER (ORDER BY date)
       <= floor((SELECT count(*) FROM long_daily) * 0.8e0) AS is_train FROM long_daily""",
    t="date",
)
_WEEK = """recent AS (
  SELECT max(date) AS last_date, avg(call_count) AS avg_calls,
         max(call_count) FILTER (b = 1) AS lag1, max(call_count) FILTER (b = 7) AS lag7,
         max(call_count) FILTER (b = 14) AS lag14, max(call_count) FILTER (b = 28) AS lag28,
         avg(call_count) FILTER (b <= 7) AS mean7, avg(call_count) FILTER (b <= 14) AS mean14
  FROM (SELECT *, row_number() OVER (ORDER BY date DESC) AS b FROM long_daily)),
week AS (SELECT *, last_date + CAST(unnest([1, 2, 3, 4, 5, 6, 7]) AS INTEGER) AS date
         FROM recent)"""
_oracle(
    "forecast_inputs_7d",
    f"""WITH {_WEEK}
---
SELECT last_date, avg_calls, CAST(lag1 AS DOUBLE) AS call_count_lag_1,
       CAST(lag7 AS DOUBLE) AS call_count_lag_7, CAST(lag14 AS DOUBLE) AS call_count_lag_14,
       CAST(lag28 AS DOUBLE) AS call_count_lag_28, mean7 AS call_count_rolling_mean_7,
       mean14 AS call_count_rolling_mean_14, date, isodow(date) - 1 AS day_of_week,
       month(date) AS month, day(date) AS day_of_month,
       CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       sin(2 * pi() * (isodow(date) - 1) / 7) AS dow_sin,
       cos(2 * pi() * (isodow(date) - 1) / 7) AS dow_cos,
       sin(2 * pi() * month(date) / 12) AS month_sin,
       cos(2 * pi() * month(date) / 12) AS month_cos FROM week""",
    d="avg_calls call_count_lag_1 call_count_lag_7 call_count_lag_14 call_count_lag_28 "
      "call_count_rolling_mean_7 call_count_rolling_mean_14 dow_sin dow_cos month_sin month_cos",
    i="day_of_week month day_of_month is_weekend", t="last_date date",
)
_oracle(
    "forecast_7d_mean",
    f"""WITH {_WEEK}
---
SELECT date, CAST(floor(avg_calls) AS BIGINT) AS predicted_calls FROM week""",
    t="date",
)
_FEATURES = """day_of_week month is_weekend dow_sin dow_cos month_sin month_cos call_count_lag_1
call_count_lag_7 call_count_lag_14 call_count_rolling_mean_7 call_count_rolling_mean_14""".split()
_WEATHER_FEATURES = "temp_avg_f precipitation_total_mm humidity_avg_pct".split()


def _ridge(columns: list[str], source: str) -> str:
    """Ridge with a penalty of 1: normal equations of scaled training days, by elimination.

    Leaves ``scales`` and ``weights`` by column number, ``level`` and the ``scaled`` days.
    """
    p = len(columns)
    return f"""days AS (
  SELECT date, call_count, row_number() OVER (ORDER BY date) <= floor(count(*) OVER () * 0.8e0) AS is_train,
         [{", ".join(f"CAST({c} AS DOUBLE)" for c in columns)}] AS x
  FROM (
    SELECT c.*, {", ".join(f"lag(call_count, {k}) OVER (ORDER BY date) AS call_count_lag_{k}" for k in (1, 7, 14, 28))},
           {", ".join(f"{_rolling(n, 'avg')} AS call_count_rolling_mean_{n}" for n in (7, 14, 30))}
    FROM calendar c) {source}
  WHERE call_count_lag_28 IS NOT NULL AND call_count_rolling_mean_30 IS NOT NULL),
cells AS (
  SELECT date, is_train, call_count AS y, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM days),
scales AS (SELECT j, avg(v) AS mean, stddev_pop(v) AS sd FROM cells WHERE is_train GROUP BY j),
scaled AS (
  SELECT date, is_train, y, j, CASE WHEN sd > 0 THEN (v - mean) / sd ELSE 0e0 END AS z
  FROM cells JOIN scales USING (j)),
level AS (SELECT avg(call_count) AS y FROM days WHERE is_train),
equations AS (
  SELECT a.j AS i, b.j AS j, sum(a.z * b.z) + CASE WHEN a.j = b.j THEN 1e0 ELSE 0e0 END AS s
  FROM scaled a JOIN scaled b ON a.date = b.date WHERE a.is_train GROUP BY 1, 2
  UNION ALL
  SELECT j, {p + 1}, sum(z * (scaled.y - level.y)) FROM scaled, level WHERE is_train GROUP BY j),
solved AS (
  WITH RECURSIVE eliminated(k, m) AS (
    SELECT 1, list(r ORDER BY i) FROM (SELECT i, list(s ORDER BY j) AS r FROM equations GROUP BY i)
    UNION ALL
    SELECT k + 1, list_transform(m, lambda r, i: CASE
             WHEN i = k THEN list_transform(r, lambda v: v / r[k])
             ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END)
    FROM eliminated WHERE k <= {p})
  SELECT m FROM eliminated WHERE k = {p + 1}),
weights AS (SELECT j, m[j][{p + 1}] AS w FROM solved, (SELECT unnest(range(1, {p + 1})) AS j))"""


_oracle(
    "forecast_ridge",
    f"""WITH {_ridge(_FEATURES + _WEATHER_FEATURES, "JOIN long_weather USING (date)")}
---
SELECT date, any_value(CAST(scaled.y AS DOUBLE)) AS actual,
       any_value(level.y) + sum(z * w) AS predicted, 'ridge' AS model
FROM scaled JOIN weights USING (j), level WHERE NOT is_train GROUP BY date""",
    d="actual predicted", t="date",
)
_NEXT = """isodow(date) - 1, month(date), CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END,
  sin(2 * pi() * (isodow(date) - 1) / 7), cos(2 * pi() * (isodow(date) - 1) / 7),
  sin(2 * pi() * month(date) / 12), cos(2 * pi() * month(date) / 12),
  lag1, lag7, lag14, mean7, mean14"""
_oracle(
    "forecast_7d",
    f"""WITH {_ridge(_FEATURES, "")},
{_WEEK},
ahead AS (
  SELECT date, unnest(x) AS v, generate_subscripts(x, 1) AS j
  FROM (SELECT date, [{_NEXT}] AS x FROM week))
---
SELECT date, CAST(greatest(0, trunc(any_value(level.y)
         + sum(CASE WHEN sd > 0 THEN (v - mean) / sd ELSE 0e0 END * w))) AS BIGINT) AS predicted_calls
FROM ahead JOIN scales USING (j) JOIN weights USING (j), level GROUP BY date""",
    t="date",
)
_oracle(
    "forecast_metrics",
    """SELECT avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) ** 2)) AS rmse,
       avg(actual) AS avg_daily_calls FROM naive""",
    d="mae rmse avg_daily_calls",
)
_oracle(
    "residual_histogram",
    """SELECT CAST(least(29, floor((actual - predicted - lo) / ((hi - lo) / 30))) AS BIGINT) AS bin,
       count(*) AS days
       FROM naive, (SELECT min(actual - predicted) AS lo, max(actual - predicted) AS hi FROM naive)
       GROUP BY 1""",
)

# ---- statistics ------------------------------------------------------------------------------


def _ttest(source: str, flag: str, value: str, gate: int) -> str:
    tested = f"""SELECT n_yes, n_no, mean_yes, mean_no,
       CASE WHEN n_yes > {gate} AND n_no > {gate} THEN (mean_yes - mean_no)
         / sqrt(((n_yes - 1) * var_yes + (n_no - 1) * var_no) / (n_yes + n_no - 2)
                * (1e0 / n_yes + 1e0 / n_no)) END AS t_statistic,
       CASE WHEN n_yes > {gate} AND n_no > {gate} THEN n_yes + n_no - 2 END AS degrees_of_freedom
       FROM (SELECT count({value}) FILTER ({flag}) AS n_yes,
               count({value}) FILTER (NOT {flag}) AS n_no,
               avg({value}) FILTER ({flag}) AS mean_yes,
               avg({value}) FILTER (NOT {flag}) AS mean_no,
               var_samp({value}) FILTER ({flag}) AS var_yes,
               var_samp({value}) FILTER (NOT {flag}) AS var_no FROM {source})"""
    return _starred(f"SELECT *, {_student('t_statistic', 'degrees_of_freedom')} AS p_value FROM ({tested})")


_oracle("ttest_alcohol", _ttest("events_summary", "has_alcohol", "incident_count", 1),
        d="mean_yes mean_no t_statistic p_value", i="degrees_of_freedom")
_oracle(
    "ttest_response",
    _ttest("(SELECT * FROM flagged WHERE response_time < 7200)", "is_festival_related",
           "response_time", 10),
    d="mean_yes mean_no t_statistic p_value", i="degrees_of_freedom",
)


def _ranksum(source: str, flag: str, value: str) -> str:
    """U with its normal p-value; ties, which the tables have, rule out the exact one."""
    tested = f"""SELECT CASE WHEN count(*) FILTER (g) > 1 AND count(*) FILTER (NOT g) > 1
         THEN sum(rank) FILTER (g) - count(*) FILTER (g) * (count(*) FILTER (g) + 1) / 2e0 END
         AS u_statistic, count(*) FILTER (g) AS n_yes, count(*) FILTER (NOT g) AS n_no,
       (SELECT sum(CAST(n AS DOUBLE) ** 3 - n)
        FROM (SELECT count(*) AS n FROM {source} GROUP BY {value})) AS tie_sum
       FROM (SELECT {flag} AS g, rank() OVER (ORDER BY {value})
               + (count(*) OVER (PARTITION BY {value}) - 1) / 2e0 AS rank FROM {source})"""
    z = "((greatest(u_statistic, n_yes * n_no - u_statistic) - n_yes * n_no / 2e0 - 0.5e0) / spread)"
    tail = _integral("exp(-{x} * {x} / 2)", z, f"{z} + 40")
    return _starred(f"""SELECT * EXCLUDE (spread), CASE WHEN u_statistic IS NULL THEN NULL WHEN spread = 0 THEN 1e0
         ELSE least(1e0, 2 * {tail} / sqrt(2 * pi())) END AS p_value
       FROM (SELECT *, sqrt(n_yes * n_no / 12e0 * (n_yes + n_no + 1
               - tie_sum / ((n_yes + n_no) * (n_yes + n_no - 1e0)))) AS spread FROM ({tested}))""")


_oracle("mannwhitney", _ranksum("events_summary", "has_alcohol", "incident_count"),
        d="u_statistic tie_sum p_value")
_oracle("mannwhitney_response", _ranksum("calls", "priority_numeric <= 1", "response_time"),
        d="u_statistic tie_sum p_value")
_oracle(
    "significance",
    f"""WITH hourly AS ({_HOURLY})
---
SELECT 'ttest_alcohol' AS test, p_value, stars
FROM ({_ttest("events_summary", "has_alcohol", "incident_count", 1)})
UNION ALL SELECT 'mannwhitney_alcohol', p_value, stars
FROM ({_ranksum("events_summary", "has_alcohol", "incident_count")})
UNION ALL SELECT variable, p_value, stars FROM ({_CORRELATED})""",
    d="p_value",
)

# ---- mining ----------------------------------------------------------------------------------

_oracle("baskets", "SELECT incident_number, array_to_string(items, '|') AS items FROM full_baskets")
_oracle(
    "baskets_festival",
    """SELECT b.incident_number, array_to_string(list_sort(b.items
           || CASE WHEN f.incident_number IS NOT NULL THEN ['Festival_Related'] ELSE [] END
           || CASE WHEN f.alcohol THEN ['Alcohol_Event'] ELSE [] END), '|') AS items
       FROM full_baskets b LEFT JOIN (
           SELECT incident_number, bool_or(coalesce(event_has_alcohol, false)) AS alcohol FROM fact GROUP BY incident_number
       ) f ON f.incident_number = b.incident_number""",
)
_oracle("baskets_dag", "SELECT incident_number, array_to_string(items, '|') AS items FROM slots")


def _mined(baskets: str, support: float = 0.01) -> str:
    """Itemsets by counting all subsets, and rules from every split of an itemset."""
    return f"""distinct_baskets AS (SELECT items, count(*) AS c FROM {baskets} GROUP BY items),
exploded AS (
  SELECT list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items, c
  FROM (SELECT items, c, unnest(range(1, 1 << len(items))) AS m FROM distinct_baskets)),
itemsets AS (
  SELECT items, sum(c) AS n,
         sum(c) / CAST((SELECT count(*) FROM {baskets}) AS DOUBLE) AS support
  FROM exploded GROUP BY items
  HAVING sum(c) / CAST((SELECT count(*) FROM {baskets}) AS DOUBLE) >= {_double(support)}),
halves AS (
  SELECT support, list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS a,
         list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 0) AS b
  FROM (SELECT items, support, unnest(range(1, (1 << len(items)) - 1)) AS m FROM itemsets
        WHERE len(items) >= 2)),
mined AS (
  SELECT h.a, h.b, x.support AS antecedent_support, y.support AS consequent_support, h.support,
         h.support / x.support AS confidence, h.support / x.support / y.support AS lift,
         h.support - x.support * y.support AS leverage,
         CASE WHEN h.support < x.support
              THEN (1 - y.support) / (1 - h.support / x.support) END AS conviction
  FROM halves h JOIN itemsets x ON h.a = x.items JOIN itemsets y ON h.b = y.items)"""


_RULE = "support confidence lift"
_RULES = "antecedent_support consequent_support support confidence lift leverage conviction"
_oracle(
    "frequent_itemsets",
    f"""WITH {_mined('full_baskets')}
---
SELECT array_to_string(items, '|') AS items, n, support, len(items) AS length FROM itemsets""",
    d="support", i="n length",
)
_oracle(
    "rules",
    f"""WITH {_mined('full_baskets')}
---
SELECT array_to_string(a, '|') AS antecedents, array_to_string(b, '|') AS consequents,
       * EXCLUDE (a, b) FROM mined WHERE confidence >= 0.3e0""",
    d=_RULES,
)
_oracle(
    "rules_dag",
    f"""WITH {_mined('slots')}
---
SELECT array_to_string(a, ', ') AS antecedents, array_to_string(b, ', ') AS consequents,
       * EXCLUDE (a, b) FROM mined WHERE lift >= 1.2e0""",
    d=_RULES,
)
_oracle(
    "rules_incident",
    f"""WITH {_mined('full_baskets')}
---
SELECT array_to_string(a, '|') AS antecedents, array_to_string(b, '|') AS consequents, support,
       confidence, lift
FROM mined WHERE confidence >= 0.1e0 AND contains(array_to_string(b, '|'), 'Incident_')""",
    d=_RULE,
)
_oracle(
    "rules_filtered",
    f"""WITH {_mined('full_baskets')}
---
SELECT array_to_string(a, '|') AS antecedents, array_to_string(b, '|') AS consequents, support,
       confidence, lift
FROM mined WHERE confidence >= 0.4e0 AND lift >= 1 AND contains(array_to_string(a, '|'), 'Weather_')""",
    d=_RULE,
)
_oracle(
    "top_rules",
    f"""WITH {_mined('plain_baskets')}
---
SELECT left(array_to_string(a, ', '), 30) || ' → ' || left(array_to_string(b, ', '), 20) AS rule,
       support, confidence, lift
FROM mined WHERE confidence >= 0.3e0
ORDER BY lift DESC, support DESC, array_to_string(a, ', '), array_to_string(b, ', ') LIMIT 15""",
    d=_RULE,
)

# ---- models ----------------------------------------------------------------------------------

_oracle("cluster_stats", "SELECT * FROM clusters",
        d="center_lat center_lon avg_incidents avg_priority avg_risk", i="cluster total_incidents")
_oracle(
    "zone_labels",
    """SELECT c.latitude, c.longitude, c.cluster,
       CASE WHEN s.avg_risk >= (SELECT quantile_cont(avg_risk, 0.66) FROM clusters)
              THEN 'HIGH_RISK'
            WHEN s.avg_risk >= (SELECT quantile_cont(avg_risk, 0.33) FROM clusters)
              THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_zone
       FROM clustered c JOIN clusters s ON c.cluster = s.cluster""",
    d="latitude longitude", i="cluster",
)
_oracle(
    "top_categories",
    """SELECT incident_number,
       CASE WHEN v IN (SELECT v FROM (SELECT coalesce(initial_problem_category, 'Unknown') AS v
                                      FROM calls)
                       GROUP BY v ORDER BY count(*) DESC, v LIMIT 4) THEN v ELSE 'Other' END
         AS incident_category
       FROM (SELECT incident_number, coalesce(initial_problem_category, 'Unknown') AS v
             FROM calls)""",
)
_DAYNUM = "list_position(['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'], response_day_of_week) - 1"
_TIMES = f"""sin(2 * pi() * response_hour / 24) AS hour_sin,
       cos(2 * pi() * response_hour / 24) AS hour_cos, {_DAYNUM} AS day_num,
       CASE WHEN response_day_of_week IN ('Sat', 'Sun') THEN 1 ELSE 0 END AS is_weekend"""
_oracle(
    "knn_features",
    f"""SELECT incident_number, latitude_centroid, longitude_centroid, {_TIMES}, temperature_f,
       humidity_pct, precipitation_mm, priority_numeric,
       final_problem_category AS incident_category
       FROM calls_weather
       WHERE latitude_centroid IS NOT NULL AND precipitation_mm IS NOT NULL""",
    d="latitude_centroid longitude_centroid hour_sin hour_cos temperature_f humidity_pct "
      "precipitation_mm",
    i="day_num is_weekend priority_numeric",
)
_KNN_COLUMNS = (
    "latitude_centroid longitude_centroid hour_sin hour_cos day_num is_weekend temperature_f humidity_pct "
    "precipitation_mm priority_numeric"
).split()


def _knn() -> str:
    """All training rows against all test vectors, ranked by distance, then by key."""
    moments = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(_KNN_COLUMNS))
    scaled = ", ".join(
        f"(CAST({c} AS DOUBLE) - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END AS x{i}" for i, c in enumerate(_KNN_COLUMNS)
    )
    xs = ", ".join(f"x{i}" for i in range(len(_KNN_COLUMNS)))
    squares = " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(len(_KNN_COLUMNS)))
    same = " AND ".join(f"t.x{i} = v.x{i}" for i in range(len(_KNN_COLUMNS)))
    return f"""features AS (
  SELECT incident_number, latitude_centroid, longitude_centroid, {_TIMES}, temperature_f, humidity_pct,
         precipitation_mm, priority_numeric, final_problem_category AS label
  FROM calls_weather WHERE latitude_centroid IS NOT NULL AND precipitation_mm IS NOT NULL),
halves AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(incident_number || '-42'), incident_number)
            <= floor(count(*) OVER (PARTITION BY label) * 0.8e0) AS is_train FROM features),
moments AS (SELECT {moments} FROM halves WHERE is_train),
scaled AS MATERIALIZED (SELECT incident_number, label, is_train, {scaled} FROM halves, moments),
vectors AS (SELECT *, row_number() OVER () AS id FROM (SELECT DISTINCT {xs} FROM scaled WHERE NOT is_train)),
near AS (
  SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY d, incident_number) AS place
  FROM (SELECT b.id, a.label, a.incident_number, round({squares}, 9) AS d FROM scaled a, vectors b WHERE a.is_train)
  QUALIFY place <= 13),
votes AS (
  SELECT id, k, label, count(*) AS n FROM near JOIN (SELECT unnest([3, 5, 7, 9, 11, 13]) AS k) ON place <= k
  GROUP BY id, k, label),
elected AS (
  SELECT id, k, label AS prediction FROM votes
  QUALIFY row_number() OVER (PARTITION BY id, k ORDER BY n DESC, label) = 1),
predicted AS (
  SELECT t.incident_number, t.label, e.prediction, e.k
  FROM scaled t JOIN vectors v ON {same} JOIN elected e ON e.id = v.id WHERE NOT t.is_train),
accuracies AS (
  SELECT k, count(*) FILTER (label = prediction) / CAST(count(*) AS DOUBLE) AS accuracy FROM predicted GROUP BY k)"""


_oracle(
    "knn_classify",
    f"""WITH {_knn()}
---
SELECT incident_number, label, prediction, k FROM predicted
WHERE k = (SELECT k FROM accuracies ORDER BY accuracy DESC, k LIMIT 1)""",
    i="k",
)
_oracle("knn_accuracy", f"WITH {_knn()}\n---\nSELECT k, accuracy FROM accuracies", d="accuracy", i="k")
_oracle(
    "rules_retry",
    f"""WITH {_mined('slots', 0.005)}
---
SELECT array_to_string(a, '|') AS antecedents, array_to_string(b, '|') AS consequents, support, confidence, lift
FROM mined WHERE lift >= 1.2e0
  AND NOT EXISTS (SELECT 1 FROM itemsets WHERE support >= 0.9e0)""",
    d=_RULE,
)
_oracle(
    "priority_features",
    f"""SELECT incident_number, latitude_centroid, longitude_centroid, {_TIMES}, response_hour,
       temperature_f, humidity_pct, precipitation_mm,
       (SELECT count(DISTINCT coalesce(initial_problem_category, 'Unknown')) FROM calls_weather
        WHERE priority_numeric < 4
          AND coalesce(initial_problem_category, 'Unknown')
              < coalesce(c.initial_problem_category, 'Unknown')) AS category_encoded,
       priority_numeric AS priority_class
       FROM calls_weather c
       WHERE latitude_centroid IS NOT NULL AND precipitation_mm IS NOT NULL
         AND priority_numeric < 4""",
    d="latitude_centroid longitude_centroid hour_sin hour_cos temperature_f humidity_pct "
      "precipitation_mm",
    i="day_num is_weekend response_hour category_encoded priority_class",
)
_oracle(
    "stratified_split",
    """SELECT incident_number, final_problem_category,
       row_number() OVER (PARTITION BY final_problem_category
                          ORDER BY md5(incident_number || '-42'), incident_number)
       <= floor(count(*) OVER (PARTITION BY final_problem_category) * 0.8e0) AS is_train
       FROM calls""",
)
_oracle(
    "classification_report",
    """WITH pairs AS (SELECT priority_numeric AS label, response_hour % 5 AS guess FROM calls),
classes AS (SELECT label AS c FROM pairs UNION SELECT guess FROM pairs),
counted AS (
  SELECT c, (SELECT count(*) FROM pairs WHERE label = c) AS support,
         (SELECT count(*) FROM pairs WHERE guess = c) AS said,
         (SELECT count(*) FROM pairs WHERE label = c AND guess = c) AS hit FROM classes),
rated AS (
  SELECT *, CASE WHEN said > 0 THEN hit / CAST(said AS DOUBLE) ELSE 0 END AS p,
         CASE WHEN support > 0 THEN hit / CAST(support AS DOUBLE) ELSE 0 END AS r FROM counted),
report AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM rated)
---
SELECT CAST(c AS VARCHAR) AS class_name, p AS precision, r AS recall, f AS f1_score, support
FROM report
UNION ALL SELECT 'accuracy', sum(hit) / CAST(sum(support) AS DOUBLE), sum(hit) / CAST(sum(support)
  AS DOUBLE), sum(hit) / CAST(sum(support) AS DOUBLE), sum(support) FROM report
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM report
UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
  sum(f * support) / sum(support), sum(support) FROM report""",
    d="precision recall f1_score", i="support",
)

# ---- planned events and matches --------------------------------------------------------------

_oracle(
    "planned_event_risk",
    """SELECT event_id, start_hour, is_weekend, zone_category, zone_lat, zone_lon,
       predicted_incidents, risk_score, CASE WHEN risk_score >= 60 THEN 'HIGH'
         WHEN risk_score >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category FROM planned_scored""",
    d="zone_lat zone_lon risk_score", i="event_id start_hour",
)


def _mix(label: str, key: str, source: str, cases: list[tuple[str, dict[str, int]]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT {key}, {_q(name)} AS {label}, {pct} AS percentage FROM {source} WHERE {test}"
        for test, table in cases
        for name, pct in table.items()
    )


_oracle(
    "planned_priority_mix",
    _mix("priority_level", "event_id", "planned_scored", [
        ("has_alcohol AND is_weekend", planned.PRIORITY_MIX["alcohol_weekend"]),
        ("has_alcohol AND NOT is_weekend", planned.PRIORITY_MIX["alcohol"]),
        ("NOT has_alcohol", planned.PRIORITY_MIX["none"]),
    ]),
    i="event_id percentage",
)
_oracle(
    "planned_incident_mix",
    _mix("incident_type", "event_id", "planned_scored", [
        ("has_alcohol", planned.INCIDENT_MIX["alcohol"]),
        ("NOT has_alcohol", planned.INCIDENT_MIX["none"]),
    ]),
    i="event_id percentage",
)


def _alerts(texts: dict, key: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT {key}, {_q(texts[name][0])} AS alert, {_q(texts[name][1])} AS level,"
        f" {message} AS message, {_q('|'.join(texts[name][2]))} AS recommendations"
        f" FROM {source} WHERE {test}"
        for test, name, message in rules
    )


_oracle(
    "planned_alerts",
    _alerts(planned.ALERT_TEXTS, "event_id", "planned_scored", [
        ("has_alcohol", "alcohol", _q("Événement avec alcool - Risque +31.5% incidents")),
        ("zone_category = 'HIGH'", "zone",
         _q("Localisation Downtown - Zone historiquement à haut risque")),
        ("temperature > 90", "heat",
         "'Température élevée (' || temperature || '°F) - Risque de malaises'"),
        ("is_weekend AND start_hour >= 20", "night",
         _q("Horaire à risque élevé (weekend + soirée)")),
        ("weather_condition IN ('Thunderstorm', 'Rain')", "weather",
         "'Prévision: ' || weather_condition || ' - Plan intempéries'"),
        ("expected_attendance > 20000", "crowd",
         "format('{:,}', expected_attendance) || ' personnes attendues'"),
    ]),
    i="event_id",
)


def _part(value: str, ratio: float, least: int = 0) -> str:
    return f"greatest({least}, CAST(floor({value} * {_double(ratio)}) AS BIGINT))"


_oracle(
    "planned_staffing",
    f"""SELECT event_id, m AS medical_staff, s AS security_staff, {_part('m', 0.3, 1)} AS doctors,
       {_part('m', 0.5, 2)} AS nurses, {_part('m', 0.2, 2)} AS first_aiders,
       {_part('s', 0.3, 2)} AS police, greatest(2, expected_attendance // 3000) AS fixed_posts,
       {_part('predicted_incidents', 0.1, 1)} AS ambulances,
       greatest(1, expected_attendance // 5000) AS first_aid_points, m + s AS radios
       FROM (SELECT *, {_part('predicted_incidents', 0.3, 2)} AS m,
               {_part('predicted_incidents', 0.5, 4)} AS s FROM planned_scored)""",
    i="event_id medical_staff security_staff doctors nurses first_aiders police fixed_posts "
      "ambulances first_aid_points radios",
)
_oracle(
    "match_risk",
    """SELECT match_id, city, capacity, fill_rate, stadium_factor, phase_factor, time_factor,
       rivalry_factor, host_factor, weekend_factor, weather_factor, alcohol_factor, total_factor,
       predicted_incidents, risk_score, risk_category FROM match_scored""",
    d="fill_rate stadium_factor phase_factor time_factor rivalry_factor host_factor "
      "weekend_factor weather_factor alcohol_factor total_factor risk_score",
    i="match_id capacity",
)
_oracle(
    "match_staffing",
    f"""SELECT match_id, s AS security_staff, m AS medical_staff,
       {_part('predicted_incidents', 0.15, 3)} AS ambulances, {_part('s', 0.6)} AS private_agents,
       {_part('s', 0.3)} AS police, {_part('s', 0.1)} AS special_forces,
       greatest(8, expected_attendance // 5000) AS checkpoints, {_part('m', 0.2, 4)} AS doctors,
       {_part('m', 0.4, 8)} AS nurses, {_part('m', 0.4)} AS first_aiders,
       greatest(10, expected_attendance // 3000) AS gates,
       greatest(20, expected_attendance // 2000) AS cameras,
       CASE WHEN risk_score >= 50 THEN 3 ELSE 1 END AS drones
       FROM (SELECT *, CAST(floor(expected_attendance / 1000e0
               * CASE WHEN risk_category IN ('CRITIQUE', 'ÉLEVÉ') THEN 8 ELSE 5 END) AS BIGINT)
               AS s, CAST(floor(expected_attendance / 1000e0
               * CASE WHEN risk_category IN ('CRITIQUE', 'ÉLEVÉ') THEN 3 ELSE 2 END) AS BIGINT)
               AS m FROM match_scored)""",
    i="match_id security_staff medical_staff ambulances private_agents police special_forces "
      "checkpoints doctors nurses first_aiders gates cameras drones",
)
_oracle(
    "match_incident_mix",
    _mix("incident_type", "match_id", "match_scored", [
        ("rivalry_factor >= 1.5e0", matches.MATCH_INCIDENTS["tense"]),
        ("rivalry_factor < 1.5e0", matches.MATCH_INCIDENTS["calm"]),
    ]),
    i="match_id percentage",
)
_oracle(
    "match_alerts",
    _alerts(matches.MATCH_ALERTS, "match_id", "match_scored", [
        ("rivalry_factor >= 2", "rivalry",
         "'Match à haute tension: ' || team1 || ' vs ' || team2"),
        ("risk_category = 'CRITIQUE'", "critical",
         "'Score de risque: ' || CAST(round_even(risk_score, 0) AS INTEGER) || '/100'"),
        ("host_factor > 1", "host", _q("Affluence maximale et ferveur nationale attendues")),
        ("alcohol_zones", "alcohol", _q("Fan zones avec vente d'alcool actives")),
        ("match_type IN ('Finale', 'Demi-Finale')", "decisive",
         "match_type || ' - Enjeux maximaux'"),
        ("temperature >= 35", "heat", "'Température prévue: ' || temperature || '°C'"),
    ]),
    i="match_id",
)
_oracle(
    "schedule",
    """SELECT match_id, CASE status WHEN 'Terminé' THEN '✅' WHEN 'En cours' THEN '🔴 LIVE'
         WHEN 'À venir' THEN '⏰' ELSE '🔮' END AS icon,
       o_orderdate + CAST(left(time, 2) AS INTEGER) * INTERVAL 1 HOUR AS kickoff,
       CASE WHEN status = 'Terminé' AND score IS NOT NULL
              THEN team1 || ' **' || score || '** ' || team2
            WHEN status = 'En cours'
              THEN '🔴 ' || team1 || ' **' || coalesce(score, '0-0') || '** ' || team2
            ELSE team1 || ' vs ' || team2 END AS label, stadium, city, phase
       FROM match_rows WHERE phase IN ('Groupe A', 'Quarts') AND city IN ('Rabat', 'Fez')""",
    i="match_id", s="kickoff",
)
_GROUP_ROWS = ", ".join(
    f"({_q(g)}, {_q(team)})" for g, teams in matches.GROUPS.items() for team in teams
)
_oracle(
    "standings",
    f"""WITH sides AS (
  SELECT team1 AS team, g1 AS f, g2 AS a FROM match_rows
  WHERE status = 'Terminé' AND score IS NOT NULL
  UNION ALL SELECT team2, g2, g1 FROM match_rows WHERE status = 'Terminé' AND score IS NOT NULL)
---
SELECT group_name, t.team, count(f) AS played, count(*) FILTER (f > a) AS won,
       count(*) FILTER (f = a) AS drawn, count(*) FILTER (f < a) AS lost,
       coalesce(sum(f), 0) AS gf, coalesce(sum(a), 0) AS ga, coalesce(sum(f - a), 0) AS gd,
       3 * count(*) FILTER (f > a) + count(*) FILTER (f = a) AS points
FROM (VALUES {_GROUP_ROWS}) t(group_name, team) LEFT JOIN sides s ON t.team = s.team
GROUP BY group_name, t.team""",
    i="played won drawn lost gf ga gd points",
)
_oracle(
    "early_warning",
    """SELECT o_orderkey AS event_id, 0.30e0 * ((o_orderkey % 101) / 100e0)
       + 0.25e0 * ((o_orderkey % 11) / 10e0) + 0.20e0 * (o_orderkey % 2)
       + 0.15e0 * ((o_orderkey % 6) / 5e0) + 0.10e0 * ((o_orderkey % 25) / 24e0)
       AS warning_score FROM orders""",
    d="warning_score", i="event_id",
)

# ---- warehouse -------------------------------------------------------------------------------

_GEO = "latitude_centroid longitude_centroid area_sq_km"
_oracle(
    "upsert_geo",
    """SELECT * FROM geo_update
       UNION ALL SELECT * FROM geo WHERE geo_id NOT IN (SELECT geo_id FROM geo_update)""",
    d=_GEO,
)
_oracle(
    "upsert_partial",
    """SELECT incident_number,
       latitude_centroid + CASE WHEN response_hour >= 8 THEN 1 ELSE 0 END AS latitude_centroid,
       longitude_centroid - CASE WHEN response_hour >= 8 THEN 1 ELSE 0 END AS longitude_centroid,
       CASE WHEN response_hour >= 16 THEN 'changed' ELSE priority_level END AS priority_level
       FROM enriched""",
    d="latitude_centroid longitude_centroid",
)
_oracle(
    "insert_new",
    """SELECT * FROM geo
       UNION ALL SELECT * FROM geo_update WHERE geo_id NOT IN (SELECT geo_id FROM geo)""",
    d=_GEO,
)
_oracle(
    "load_fact_calls",
    """SELECT incident_number, response_datetime, response_date, response_hour,
       response_day_of_week, priority_level, priority_numeric, initial_problem_category,
       final_problem_category,
       CASE WHEN geo_id IN (SELECT geo_id FROM geo) THEN geo_id END AS geo_id,
       latitude_centroid, longitude_centroid FROM enriched""",
    d="latitude_centroid longitude_centroid", i="response_hour priority_numeric",
    t="response_date", s="response_datetime",
)
_oracle(
    "load_dim_event",
    """SELECT event_id, event_name, 'Festival' AS event_type, start_date, end_date, has_alcohol,
       has_amplified_sound FROM festivals""",
    i="event_id", t="start_date end_date",
)
_oracle("freshness",
        "SELECT count(*) AS db_count, max(response_datetime) AS last_load FROM calls",
        s="last_load")
_oracle(
    "rebuild_plan",
    """WITH files AS (
  SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'raw' ELSE 'transformed' END AS layer,
         CASE WHEN n_nationkey % 3 = 0 THEN '911' WHEN n_nationkey % 4 = 2 THEN 'event' END AS kind
  FROM nation)
---
SELECT 'extract_calls' AS task,
       bool_or(coalesce(layer = 'raw' AND kind = '911', false))
       AND NOT bool_or(coalesce(layer = 'enriched' AND kind = '911', false))
       AND ((SELECT count(*) FROM calls) < 100
            OR NOT bool_or(coalesce(layer = 'transformed' AND kind = '911', false))) AS is_due
FROM files
UNION ALL
SELECT 'extract_events', bool_or(coalesce(layer = 'raw' AND kind = 'event', false))
       AND NOT bool_or(coalesce(layer = 'transformed' AND kind = 'event', false)) FROM files""",
)
_oracle(
    "incremental_new",
    """SELECT incident_number, response_datetime FROM calls
       WHERE coalesce(response_date >= DATE '2024-01-25', true)
         AND incident_number NOT IN (SELECT incident_number FROM calls WHERE response_date < DATE '2024-01-25')""",
    s="response_datetime",
)
_oracle(
    "table_counts",
    """SELECT 'dim_geo' AS table_name, count(*) AS row_count FROM geo
       UNION ALL SELECT 'dim_event', count(*) FROM festivals
       UNION ALL SELECT 'fact_calls', count(*) FROM calls""",
)
_oracle(
    "pipeline_runs",
    """SELECT TIMESTAMP '2024-02-01' AS run_date, 'daily' AS dag_id, 'SUCCESS' AS status,
       count(*) AS records_processed FROM calls""",
    s="run_date",
)

# ---- quality and reports ---------------------------------------------------------------------

_oracle(
    "quality_checks",
    """SELECT 'not_empty' AS "check", CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed
       FROM enriched
       UNION ALL SELECT 'unique:incident_number', count(*) - count(DISTINCT incident_number),
         count(*) = count(DISTINCT incident_number) FROM enriched
       UNION ALL SELECT 'unique:geo_id', count(*) - count(DISTINCT geo_id),
         count(*) = count(DISTINCT geo_id) FROM enriched
       UNION ALL SELECT 'range:latitude_centroid',
         count(*) FILTER (latitude_centroid NOT BETWEEN 25 AND 37),
         count(*) FILTER (latitude_centroid NOT BETWEEN 25 AND 37) = 0 FROM enriched
       UNION ALL SELECT 'range:longitude_centroid',
         count(*) FILTER (longitude_centroid NOT BETWEEN -107 AND -93),
         count(*) FILTER (longitude_centroid NOT BETWEEN -107 AND -93) = 0 FROM enriched
       UNION ALL SELECT 'positive:area_sq_km', count(*) FILTER (area_sq_km <= 0),
         count(*) FILTER (area_sq_km <= 0) = 0 FROM enriched
       UNION ALL SELECT 'length:geo_id', count(*) FILTER (length(geo_id) <> 12),
         count(*) FILTER (length(geo_id) <> 12) = 0 FROM enriched
       UNION ALL SELECT 'required:incident_number', 0, true
       UNION ALL SELECT 'required:missing_column', 1, false
       UNION ALL SELECT 'dates:response_date',
         date_diff('day', min(response_date), max(response_date)), true FROM enriched
       UNION ALL SELECT 'filled:latitude_centroid',
         count(latitude_centroid) * 100e0 / count(*),
         count(latitude_centroid) * 100e0 / count(*) >= 50 FROM enriched""",
    d="value",
)
_oracle(
    "profile",
    "\nUNION ALL ".join(
        f"SELECT {_q(c)} AS column_name, count(*) - count({c}) AS null_count,"
        f" (count(*) - count({c})) * 100e0 / count(*) AS null_pct, {_q(kind)} AS data_type,"
        f" count(*) AS row_count, count(DISTINCT incident_number) AS distinct_keys,"
        f" (SELECT string_agg(coalesce(CAST({c} AS VARCHAR), 'null'), '|' ORDER BY incident_number) FROM (SELECT * FROM calls"
        f" ORDER BY md5(incident_number || '-42'), incident_number LIMIT 3)) AS samples FROM calls"
        for c, kind in [
            ("incident_number", "string"), ("response_datetime", "timestamp_ntz"),
            ("response_date", "date"), ("response_hour", "int"),
            ("response_day_of_week", "string"), ("priority_level", "string"),
            ("priority_numeric", "int"), ("response_time", "double"),
            ("initial_problem_category", "string"), ("final_problem_category", "string"),
            ("geo_id", "string"),
        ]
    ),
    d="null_pct",
)
_oracle(
    "pipeline_alerts",
    """WITH runs AS (
  SELECT count(*) AS n, count(*) FILTER (priority_numeric = 0) AS high,
         count(*) FILTER (final_problem_category = 'signup') AS rules
  FROM calls GROUP BY response_date)
---
SELECT 'WARNING' AS severity, 'DATA_VOLUME' AS type,
       'No 911 records were processed in this run' AS message,
       'Check the raw-data folder for source files' AS action_required FROM runs WHERE n = 0
UNION ALL SELECT 'INFO', 'LOW_VOLUME', 'Only ' || n || ' records processed (below normal)',
       'Review data source for completeness' FROM runs WHERE n > 0 AND n < 100
UNION ALL SELECT 'CRITICAL', 'HIGH_RISK_SPIKE', high || ' events classified as HIGH risk',
       'Review high-risk events and allocate resources' FROM runs WHERE high > 10
UNION ALL SELECT 'WARNING', 'ML_MODEL_FAILURE', 'No ML model produced results',
       'Check the stored models' FROM runs WHERE rules = 0""",
)
