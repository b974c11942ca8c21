"""DuckDB SQL for joins, aggregations and windows."""

from __future__ import annotations

from registry.oracle_scalar import (
    DC, LOCATION_KEY, NEXT_TO, NS, TC, WIND, climate, grid, humidity, rd,
)
from registry.oracle_storm_parts import CLIMATE_GRID, GOOD, MEASURED, chain, storms

POINT = "latitude = 22.0 AND longitude = 104.0 AND tp IS NOT NULL"
DAILY = f"""SELECT CAST(time AS DATE) AS day, max({TC}) AS hi, min({TC}) AS lo, max({TC}) - min({TC}) AS spread, sum(tp) AS rain
 FROM grid WHERE {POINT} AND year(time) = 2024 GROUP BY 1"""
MONTHLY = f"""SELECT strftime(day, '%Y-%m') AS month, max(hi) AS max_temperature, min(lo) AS min_temperature,
 max(spread) AS max_daily_difference, sum(rain) AS rain FROM ({DAILY}) GROUP BY 1"""
FOUND = """SELECT time, low_lon AS lon, low_lat AS lat, row_number() OVER (PARTITION BY time ORDER BY label) - 1 AS idx,
 count(*) OVER (PARTITION BY time) AS n FROM good"""
KM = """6371.0E0*acos(least(1.0E0, sin(radians({a}lat))*sin(radians({b}lat))
 + cos(radians({a}lon - {b}lon))*cos(radians({a}lat))*cos(radians({b}lat))))"""
BY_MONTH = "SELECT strftime(time, '%Y-%m') AS month, count(DISTINCT id) AS storms FROM hourly {where} GROUP BY 1"
MONTH_SHARE = f"SELECT month, rain*1000.0E0 AS rain FROM ({MONTHLY})"
DAY_SHARE = f"SELECT day, rain*1000.0E0 AS total_precipitation FROM ({DAILY}) WHERE strftime(day, '%Y-%m') = '2024-01'"
STAR_NAMES = {
    "u10": "u_wind", "v10": "v_wind", "d2m": "dewpoint_temp", "t2m": "air_temp", "msl": "mean_sea_level_pressure",
    "sst": "sea_surface_temp", "sp": "surface_pressure", "tcc": "total_cloud_cover",
}
POINTS = """pts AS (SELECT id, lon_storm AS lon, lat_storm AS lat, time,
   lag(lon_storm) OVER w AS plon, lag(lat_storm) OVER w AS plat FROM named WINDOW w AS (PARTITION BY id ORDER BY time))"""


def track_lengths(body: str) -> str:
    leg = KM.format(a="p.", b="p.p")
    ends = KM.format(a="a.", b="z.")
    return storms(
        f"""SELECT * FROM (WITH {POINTS},
   tot AS (SELECT id, count(*) AS points, coalesce(sum({leg}), 0.0E0) AS length_km, min(time) AS t0, max(time) AS t1 FROM pts p GROUP BY id),
   summary AS (SELECT t.id AS track_id, t.points, t.length_km, {ends} AS straight_km
     FROM tot t JOIN pts a ON a.id = t.id AND a.time = t.t0 JOIN pts z ON z.id = t.id AND z.time = t.t1)
   {body})"""
    )


ORACLES = {
    "joi1_rain_and_weather": grid(
        f"SELECT time, latitude, longitude, {rd(TC, 6)} AS t2m, {rd(DC, 6)} AS d2m, {rd('u10', 6)} AS u10,"
        f" {rd('v10', 6)} AS v10, sst, tcc, tp FROM grid WHERE tp IS NOT NULL"
    ),
    "joi2_star_read_back": grid(
        f"SELECT {NS} AS time_id, time, year(time) AS year, month(time) AS month, day(time) AS day, hour(time) AS hour,"
        f" {LOCATION_KEY} AS location_id, latitude, longitude, 'Unknown Region' AS region, 'Unknown' AS weather_type,"
        " 'Unknown' AS wind_category, 'Unknown' AS cloud_cover_category, "
        + ", ".join(f"{rd(c, 4)} AS {n}" for c, n in STAR_NAMES.items())
        + ", 0.0E0 AS cloud_ice_water_content, 0.0E0 AS cloud_liquid_water_content FROM grid"
    ),
    "joi3_drop_over_high_ground": chain(*GOOD)
    + f"""
SELECT time, lon, lat, count(*) OVER (PARTITION BY time) AS n FROM ({FOUND}) d WHERE NOT EXISTS (SELECT 1 FROM grid g
  WHERE (g.iy*97 + g.ix*53) % 1500 > 1000 AND g.latitude = round_even(d.lat*4, 0)/4 AND g.longitude = round_even(d.lon*4, 0)/4)""",
    "joi4_nearest_next": chain(*GOOD)
    + f""", found AS (SELECT * FROM ({FOUND})),
pairs AS (SELECT a.time, a.idx, b.idx AS next_idx, {KM.format(a='a.', b='b.')} AS km
  FROM found a JOIN found b ON b.time = a.time + INTERVAL 1 HOUR)
SELECT time, idx, next_idx, {rd('km', 3)} AS km FROM pairs WHERE km <= 80.0
QUALIFY row_number() OVER (PARTITION BY time, idx ORDER BY km, next_idx) = 1""",
    "joi5_all_months": storms(
        """SELECT m.month, coalesce(s.storms, 0) AS storms FROM
 (SELECT printf('%04d-%02d', y, i) AS month FROM (SELECT DISTINCT year(time) AS y FROM grid), range(1, 13) r(i)) m
 LEFT JOIN (SELECT strftime(time, '%Y-%m') AS month, count(DISTINCT id) AS storms FROM named GROUP BY 1) s USING (month)""",
        over=CLIMATE_GRID,
    ),
    "joi6_region_diameters": chain(*MEASURED)
    + f"\nSELECT time, label, {rd('extent_km', 4)} AS extent_km FROM extent",
    "agg1_daily_precipitation": grid(
        f"SELECT CAST(time AS DATE) AS date, {rd('sum(tp)', 6)} AS total_precipitation FROM grid GROUP BY 1 ORDER BY 1"
    ),
    "agg1_daily_precipitation_in_area": grid(
        f"SELECT CAST(time AS DATE) AS date, {rd('sum(tp)', 6)} AS total_precipitation FROM grid WHERE tp IS NOT NULL"
        " AND latitude BETWEEN 8 AND 24 AND longitude BETWEEN 102 AND 112 GROUP BY 1"
    ),
    "agg2_monthly_mean_temperature": climate(
        f"SELECT year(time) AS year, month(time) AS month, {rd('avg(t2m)', 6)} AS avg_temperature FROM grid GROUP BY 1, 2"
    ),
    "agg3_point_daily": climate(
        f"SELECT day, {rd('hi', 6)} AS max_temperature, {rd('lo', 6)} AS min_temperature,"
        f" {rd('rain', 6)} AS total_precipitation FROM ({DAILY}) WHERE strftime(day, '%Y-%m') = '2024-01'"
    ),
    "agg4_point_monthly": climate(
        f"SELECT month, {rd('max_temperature', 6)} AS max_temperature, {rd('min_temperature', 6)} AS min_temperature,"
        f" {rd('max_daily_difference', 6)} AS max_daily_difference, {rd('rain', 6)} AS rain FROM ({MONTHLY})"
    ),
    "agg5_storms_by_month": storms(BY_MONTH.format(where="WHERE id NOT LIKE '%-00'"), over=CLIMATE_GRID),
    "agg5_raw": storms(BY_MONTH.format(where=""), over=CLIMATE_GRID),
    "agg6_share_of_rain_by_month": climate(
        f"SELECT month, {rd('rain', 6)} AS rain, {rd('rain/sum(rain) OVER ()', 6)} AS share FROM ({MONTH_SHARE})"
    ),
    "agg6_share_of_rain_by_day": climate(
        f"SELECT day, {rd('total_precipitation', 6)} AS total_precipitation,"
        f" {rd('total_precipitation/sum(total_precipitation) OVER ()', 6)} AS share FROM ({DAY_SHARE})"
    ),
    "agg7_value_ticks": grid(
        f"SELECT {rd('low', 4)} AS low, {rd('high', 4)} AS high, i,"
        " CAST(floor(CASE WHEN i = 6 THEN high ELSE low + i*((high - low)/6.0E0) END) AS BIGINT) AS tick"
        " FROM (SELECT min(msl) AS low, max(msl) AS high FROM grid), range(0, 7) r(i)"
    ),
    "agg8_row_counts": grid(
        "SELECT 'weather' AS name, count(*) AS rows FROM grid UNION ALL SELECT 'rain', count(*) FROM grid"
        " UNION ALL SELECT 'known_rain', count(tp) FROM grid"
    ),
    "agg9_frame_means": grid(f"SELECT time, {rd('avg(sst)', 6)} AS mean, count(sst) AS known FROM grid GROUP BY time"),
    "agg10_track_lengths": track_lengths(
        f"SELECT track_id, points, {rd('length_km', 3)} AS length_km, {rd('straight_km', 3)} AS straight_km FROM summary"
    ),
    "win1_strong_wind_regions": grid(
        f"""SELECT time, latitude, longitude, {rd('wind_speed', 6)} AS wind_speed FROM (
 SELECT *, lag(latitude) OVER (ORDER BY time, longitude, latitude) AS prev_latitude,
   lag(longitude) OVER (ORDER BY time, latitude, longitude) AS prev_longitude
 FROM (SELECT time, latitude, longitude, {WIND} AS wind_speed FROM grid) WHERE wind_speed > 10)
 WHERE {NEXT_TO}"""
    ),
    "win2_storm_names": storms("SELECT time, id, lon_storm, lat_storm FROM named"),
    "win2_storm_names_close": storms("SELECT time, id, lon_storm, lat_storm FROM named", threshold=0.5),
    "win3_first_region": chain(*GOOD)
    + "\nSELECT time, label, n_cells FROM good QUALIFY row_number() OVER (PARTITION BY time ORDER BY label) = 1",
    "win4_frame_ordinal": climate("SELECT DISTINCT time, frame*18 AS ordinal FROM grid"),
    "win5_daily_segments": storms(
        """SELECT * FROM (SELECT time, lag(lon_storm) OVER w AS from_lon, lag(lat_storm) OVER w AS from_lat, lon_storm AS to_lon,
 lat_storm AS to_lat FROM hourly WINDOW w AS (PARTITION BY CAST(time AS DATE) ORDER BY time)) WHERE from_lon IS NOT NULL AND to_lon IS NOT NULL"""
    ),
    "src6_day_frames": grid(
        f"SELECT time AS valid_time, latitude, longitude, {rd(TC, 4)} AS temperature_celsius,"
        f" {rd(humidity(DC, TC), 4)} AS relative_humidity, {rd('msl', 4)} AS mean_sea_level_pressure,"
        f" {rd(WIND, 4)} AS wind_speed, {rd('sst - 273.15E0', 4)} AS sea_surface_temperature_celsius,"
        " sp AS surface_pressure, tcc AS total_cloud_cover, tp AS total_precipitation FROM grid WHERE tp IS NOT NULL"
        " AND time BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-02 23:00:00'"
    ),
    "grd1_completeness": grid(
        "SELECT time, count(*) AS rows, count(DISTINCT (iy, ix)) AS cells, count(DISTINCT (iy, ix)) = 300 AS complete,"
        " count(DISTINCT (iy, ix)) = 300 AND count(*) = 300 AS regular FROM grid GROUP BY time"
    ),
}
ORACLES["joi1_stored_alike"] = ORACLES["joi1_rain_and_weather"]
