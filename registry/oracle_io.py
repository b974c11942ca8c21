"""DuckDB SQL for sources, sinks and the stream."""

from __future__ import annotations

from registry.oracle_scalar import (
    DC, FLOAT_MEASURES, HOUR_NS, NS, PARSED, TC, WIND, as_float, climate, grid, rd, vapor,
)
from registry.oracle_storm_parts import storms

PER_DAY = (
    f"SELECT year(time) AS year, month(time) AS month, day(time) AS day, count(*)*{{times}} AS rows,"
    f" {rd('sum(sp)*{times}', 4)} AS sp, {rd('sum(tcc)*{times}', 4)} AS tcc FROM grid {{where}} GROUP BY 1, 2, 3"
)
BEARING = "(degrees(atan2(u10, v10)) + 180.0E0)"
FLAT = "CAST(0 AS BIGINT) AS number, CAST(0 AS BIGINT) AS step, 0.0E0 AS surface"
SPEED = f"sqrt({as_float('u10')}*{as_float('u10')} + {as_float('v10')}*{as_float('v10')})"
STREAM_COUNTS = grid("SELECT unnest(['files', 'table']) AS name, (SELECT count(*) FROM grid) AS rows")

ORACLES = {
    "src1_weather_scan": grid(
        f"SELECT {NS} AS time, latitude, longitude, {FLAT}, {NS} AS valid_time, {FLOAT_MEASURES} FROM grid"
    ),
    "src2_rain_scan": grid(
        f"SELECT {NS} - {HOUR_NS} AS time, latitude, longitude, {FLAT}, {NS} AS valid_time, {rd(as_float('tp'), 8)} AS tp FROM grid"
    ),
    "src3_one_year": climate(PER_DAY.format(times=1, where="WHERE year(time) = 2024")),
    "src4_derived_scan": grid(
        f"SELECT time, latitude, longitude, {rd(WIND, 5)} AS wind_speed, {rd(vapor(DC), 5)} AS vapor_pressure,"
        f" {rd(f'{vapor(DC)}/{vapor(TC)}*100.0E0', 5)} AS relative_humidity,"
        f" {rd(f'{TC} + 0.33E0*{vapor(DC)} - 0.70E0*{WIND} - 4.0E0', 5)} AS apparent_temperature,"
        f" {rd(f'sp/(287.05E0*({TC} + 273.15E0))', 5)} AS air_density,"
        f" {rd(f'CASE WHEN {BEARING} < 0 THEN {BEARING} + 360.0E0 ELSE {BEARING} END', 5)} AS wind_direction"
        " FROM grid WHERE tp IS NOT NULL AND latitude BETWEEN 8 AND 24 AND longitude BETWEEN 102 AND 112"
    ),
    "src5_times_as_text": grid("SELECT time, latitude, longitude, sp FROM grid"),
    "src6_table_range": grid(
        "SELECT time, latitude, longitude, sp, tcc FROM grid"
        " WHERE time BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-02 23:00:00'"
    ),
    "src6_clustered_range": grid(
        "SELECT time, latitude, longitude, sp, tcc FROM grid WHERE latitude BETWEEN 21.0 AND 22.0 AND longitude BETWEEN 103.0 AND 104.5"
        " AND time BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-02 23:00:00'"
    ),
    "src7_whole_dataset": climate(
        "SELECT time, latitude, longitude, sp, tcc, year(time) AS year, month(time) AS month, day(time) AS day FROM grid"
    ),
    "src8_message_source": grid("SELECT CAST(17 AS BIGINT) AS fields, count(*) AS messages FROM grid"),
    "src9_landed_days": climate(PER_DAY.format(times=1, where="")),
    "src9_landed_versions": climate(PER_DAY.format(times=1, where="WHERE day(time) % 2 = 0")),
    "src10_missing_hours": climate(
        """SELECT h.time FROM (SELECT unnest(generate_series(CAST(CAST(min(time) AS DATE) AS TIMESTAMP),
   CAST(CAST(max(time) AS DATE) AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS time FROM grid) h
 WHERE h.time NOT IN (SELECT time FROM grid)"""
    ),
    "snk1_repartitioned_files": grid(
        f"SELECT count(*) AS rows, CAST(49 AS BIGINT) AS files, {rd('sum(tp)', 6)} AS tp FROM grid WHERE tp IS NOT NULL"
    ),
    "snk2_day_folders": grid(
        f"SELECT year(time) AS year, month(time) AS month, day(time) AS day, count(*) AS rows, {rd(f'sum({WIND})', 5)} AS wind,"
        f" {rd(f'max(sp/(287.05E0*({TC} + 273.15E0)))', 5)} AS density FROM grid WHERE tp IS NOT NULL GROUP BY 1, 2, 3"
    ),
    "snk3_landing_twice": climate(PER_DAY.format(times=1, where="")),
    "snk3_landing_half_days": climate(PER_DAY.format(times=1, where="")),
    "snk3_landing_null_keys": climate(
        "SELECT year, month, day, count(*) AS rows, " + f"{rd('sum(sp)', 4)} AS sp, {rd('sum(tcc)', 4)} AS tcc FROM ("
        "SELECT year(time) AS year, month(time) AS month, day(time) AS day, sum(sp) AS sp, sum(tcc) AS tcc FROM grid"
        " GROUP BY time, CASE WHEN latitude < 23.0 THEN latitude END, longitude) GROUP BY 1, 2, 3"
    ),
    "snk3_landing_broken": climate(PER_DAY.format(times=1, where="")),
    "snk3_landing_raw": grid(PER_DAY.format(times=1, where="")),
    "snk3_landing_appended": climate(PER_DAY.format(times=2, where="")),
    "snk4_appended_table": storms(
        f"SELECT time, id, lon_storm, lat_storm, {rd('amp_storm', 4)} AS amp_storm,"
        f" {rd('max_wind_speed', 4)} AS max_wind_speed, {rd('area_storm', 4)} AS area_storm FROM hourly"
    ),
    "snk5_replaced_table": grid(
        f"SELECT CAST(time AS DATE) AS date, {rd('sum(tp)', 6)} AS total_precipitation FROM grid GROUP BY 1"
    ),
    "snk6_star_tables": grid(
        "SELECT 'fact_weather_measurements' AS name, count(*) AS rows FROM grid"
        " UNION ALL SELECT 'dim_time', count(DISTINCT time) FROM grid"
        " UNION ALL SELECT 'dim_location', count(DISTINCT (latitude, longitude)) FROM grid"
        " UNION ALL SELECT 'dim_weather_conditions', CAST(1 AS BIGINT)"
    ),
    "snk7_stream_to_files": PARSED,
    "snk8_stream_to_table": PARSED,
    "snk9_batches_with_counts": grid(
        "SELECT unnest(['files', 'table']) AS name, (SELECT count(*) FROM grid) AS rows, (SELECT count(*) FROM grid) AS reported"
    ),
    "snk9_new_checkpoint": grid(
        """SELECT day, count(*) AS files, count(*) AS "table" FROM (SELECT CAST(time AS DATE) AS day FROM grid
  UNION ALL SELECT CAST(time - INTERVAL 10 DAY AS DATE) FROM grid) GROUP BY day"""
    ),
    "snk10_published_messages": grid(
        "SELECT strftime(time, '%Y-%m-%d %H:%M:%S') || '_' || CAST(latitude AS VARCHAR) || '_' || CAST(longitude AS VARCHAR) AS key,"
        f" CAST(17 AS BIGINT) AS fields, {rd('t2m', 4)} AS t2m, {rd('tcc', 4)} AS tcc, sst IS NULL AS no_sst FROM grid"
    ),
    "str1_parsed_stream": grid(
        f"SELECT time, count(*) AS rows, count(sst) AS sst_known, {rd(f'max({SPEED})', 4)} AS max_wind FROM grid GROUP BY time"
    ),
    "str2_micro_batches_to_files": PARSED,
    "str3_second_query_to_table": PARSED,
    "str4_both_queries": STREAM_COUNTS,
    "str5_late_feed": grid(
        f"""SELECT day, count(*) AS rows, {rd('max(w)', 4)} AS max_wind FROM
 (SELECT CAST(time AS DATE) AS day, {SPEED} AS w FROM grid
  UNION ALL SELECT CAST(time - INTERVAL 10 DAY AS DATE), {SPEED} FROM grid) GROUP BY day"""
    ),
}
