"""DuckDB SQL for projections, filters, sorts and set operators."""

from __future__ import annotations

import math

from registry.fixture import DUCK_TIME, GRID_SQL

GRID = GRID_SQL.format(time=DUCK_TIME.format(step=1), orders="orders")
CLIMATE = GRID_SQL.format(time=DUCK_TIME.format(step=18), orders="orders")

TC = "(t2m - 273.15E0)"
DC = "(d2m - 273.15E0)"
WIND = "sqrt(u10*u10 + v10*v10)"
NS = "(epoch_us(time) * 1000)"
HOUR_NS = "3600000000000"
BEARING = "(degrees(atan2(u10, v10)) + 180.0E0)"
COS_TO_POINT = (
    "(sin(radians(latitude))*sin(radians(16.0E0))"
    " + cos(radians(longitude - 107.0E0))*cos(radians(latitude))*cos(radians(16.0E0)))"
)
LON_KM = f"({math.pi / 180.0 * 6371.0!r}*cos(radians(latitude)))"
AREA9 = f"(9*0.0625E0*111.325E0*{LON_KM})"
RATIO = "((tcc + 0.01E0)/1.02E0)"
ECC = f"({RATIO}*sqrt(1.0E0/({RATIO}*{RATIO}) - 1.0E0))"


def rd(expr: str, digits: int) -> str:
    """Rounded, with minus zero made plain zero."""
    return f"(round({expr}, {digits}) + 0.0E0)"


def vapor(c: str) -> str:
    return f"(6.11E0*pow(10.0E0, 7.5E0*{c}/({c} + 237.3E0)))"


def growth(c: str) -> str:
    return f"exp(17.625E0*{c}/({c} + 243.04E0))"


def humidity(d: str, t: str) -> str:
    return f"({growth(d)}/{growth(t)}*100.0E0)"


def grid(body: str) -> str:
    return f"WITH grid AS ({GRID})\n{body}"


def climate(body: str) -> str:
    return f"WITH grid AS ({CLIMATE})\n{body}"


def keyed(**columns: str) -> str:
    picked = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return grid(f"SELECT time, latitude, longitude, {picked} FROM grid")


def as_float(expr: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


MEASURES = {
    "u10": "u10", "v10": "v10", "d2m": "d2m", "t2m": "t2m", "msl": "msl", "sst": "sst",
    "sp": "sp", "tcc": "tcc", "tciw": "0.0E0", "tclw": "0.0E0",
}
FLOAT_MEASURES = ", ".join(f"{rd(as_float(e), 4)} AS {n}" for n, e in MEASURES.items())


def messages_from(source: str = "grid") -> str:
    """Observations after a trip through 32-bit text messages."""
    u, v = as_float("u10"), as_float("v10")
    speed = rd(f"sqrt({u}*{u} + {v}*{v})", 4)
    return (
        "SELECT time, latitude, longitude, CAST(0 AS BIGINT) AS number, '0 days 00:00:00' AS step,"
        f" 0.0E0 AS surface, time AS valid_time, {FLOAT_MEASURES}, {speed} AS wind_speed FROM {source}"
    )


PARSED = grid(messages_from())
DIMENSIONS = """SELECT DISTINCT {ns} AS time_id, time, year(time) AS year, month(time) AS month,
 day(time) AS day, hour(time) AS hour FROM grid"""
LOCATION_KEY = "CAST(latitude AS VARCHAR) || ',' || CAST(longitude AS VARCHAR)"
JOINED = f"""SELECT latitude, longitude, {NS} AS time, CAST(0 AS BIGINT) AS step, 0.0E0 AS surface,
 {rd('t2m', 4)} AS t2m, {rd('d2m', 4)} AS d2m, {rd('u10', 4)} AS u10, {rd('v10', 4)} AS v10, {rd('msl', 4)} AS msl,
 {rd('sst', 4)} AS sst, sp, {rd('tcc', 4)} AS tcc, 0.0E0 AS tciw, 0.0E0 AS tclw, tp FROM grid WHERE tp IS NOT NULL"""
PREVIOUS = """SELECT time, latitude, longitude,
 lag(latitude) OVER (ORDER BY time, longitude, latitude) AS prev_latitude,
 lag(longitude) OVER (ORDER BY time, latitude, longitude) AS prev_longitude FROM {source}"""
NEXT_TO = "longitude = prev_longitude + 0.25E0 OR latitude = prev_latitude + 0.25E0"

ORACLES = {
    "prj1_joined_projection": grid(JOINED),
    "prj2_epoch_to_timestamp": grid(
        f"SELECT {NS} - {HOUR_NS} AS time_ns, time - INTERVAL 1 HOUR AS time, time AS valid_time, latitude, longitude FROM grid"
    ),
    "prj3_kelvin_to_celsius": keyed(t2m=rd(TC, 6), d2m=rd(DC, 6)),
    "prj4_wind_speed": keyed(wind_speed=rd(WIND, 6)),
    "prj5_wind_direction_closed": keyed(
        wind_direction=rd(f"CASE WHEN {BEARING} < 0 THEN {BEARING} + 360.0E0 ELSE {BEARING} END", 6)
    ),
    "prj6_wind_direction": keyed(wind_direction=rd(f"{BEARING} - 360.0E0*floor({BEARING}/360.0E0)", 6)),
    "prj7_vapor_pressure": keyed(vapor_pressure=rd(vapor(DC), 6)),
    "prj8_saturation_vapor_pressure": keyed(saturation_vapor_pressure=rd(vapor(TC), 6)),
    "prj9_relative_humidity": keyed(relative_humidity=rd(f"{vapor(DC)}/{vapor(TC)}*100.0E0", 6)),
    "prj10_relative_humidity_exponential": grid(
        f"SELECT latitude, longitude, time AS valid_time, {rd(humidity(DC, TC), 6)} AS relative_humidity FROM grid"
    ),
    "prj10_temperature_and_humidity": grid(
        f"SELECT {rd(TC, 6)} AS temperature_celsius, {rd(humidity(DC, TC), 6)} AS relative_humidity FROM grid"
        " WHERE t2m IS NOT NULL AND d2m IS NOT NULL"
    ),
    "prj11_apparent_temperature": keyed(
        apparent_temperature=rd(f"{TC} + 0.33E0*{vapor(DC)} - 0.70E0*{WIND} - 4.00E0", 6)
    ),
    "prj12_air_density": keyed(air_density=rd(f"sp/(287.05E0*({TC} + 273.15E0))", 8)),
    "prj13_calendar_parts": climate(
        "SELECT time, latitude, longitude, year(time) AS year, month(time) AS month, day(time) AS day,"
        " hour(time) AS hour FROM grid"
    ),
    "prj14_calendar_texts": climate(
        "SELECT time, latitude, longitude, CAST(time AS DATE) AS date, strftime(time, '%Y-%m') AS month,"
        " strftime(time, '%Y') AS year FROM grid"
    ),
    "prj15_location_key": keyed(location_id=LOCATION_KEY),
    "prj16_row_ids": grid(
        "SELECT latitude, longitude, CAST(epoch(time) / 60 AS BIGINT) * 2147483648 + CAST((latitude + 90) * 100 AS BIGINT) * 65536"
        " + CAST((longitude + 180) * 100 AS BIGINT) AS id FROM grid"
    ),
    "prj17_fact_projection": grid(
        f"SELECT {NS} AS time_id, {LOCATION_KEY} AS location_id, {rd('u10', 4)} AS u_wind, {rd('v10', 4)} AS v_wind,"
        f" {rd('d2m', 4)} AS dewpoint_temp, {rd('t2m', 4)} AS air_temp, {rd('msl', 4)} AS mean_sea_level_pressure,"
        f" {rd('sst', 4)} AS sea_surface_temp, {rd('sp', 4)} AS surface_pressure, {rd('tcc', 4)} AS total_cloud_cover,"
        " 0.0E0 AS cloud_ice_water_content, 0.0E0 AS cloud_liquid_water_content FROM grid"
    ),
    "prj18_rain_millimetres": keyed(rain_mm=rd("tp*1000.0E0", 6)),
    "prj19_parse_messages": PARSED,
    "prj20_grid_index": keyed(
        iy="CAST(round((24.0E0 - latitude)/0.25E0) AS BIGINT)", ix="CAST(round((longitude - 102.0E0)/0.25E0) AS BIGINT)"
    ),
    "prj21_distance": keyed(km=rd(f"6371.0E0*acos({COS_TO_POINT})", 5)),
    "prj22_extent_distance": keyed(
        km=rd(f"CASE WHEN {COS_TO_POINT} < 1 THEN 6378.1E0*acos({COS_TO_POINT}) ELSE 0.0E0 END", 5)
    ),
    "prj23_planar_distance": keyed(degrees=rd("sqrt(pow(longitude - 107.0E0, 2) + pow(latitude - 16.0E0, 2))", 8)),
    "prj24_degree_lengths": keyed(lon_km=rd(LON_KM, 8), lat_km="111.325E0"),
    "prj25_shapes": keyed(
        diameter=rd(f"sqrt({AREA9}/pi())*2.0E0", 6),
        major_from_ratio=rd(f"sqrt({AREA9}/(pi()*{RATIO}))", 6),
        eccentricity=rd(ECC, 6),
        major_from_ecc=rd(f"sqrt({AREA9}/(pi()*sqrt(1.0E0 - {ECC}*{ECC})))", 6),
    ),
    "prj26_storm_name": keyed(id="printf('%s-%02d', strftime(time, '%Y'), frame)"),
    "prj27_nearest_quarter": keyed(
        tie="round_even((latitude + 0.125E0)*4.0E0, 0)/4.0E0", quarter="round_even((longitude + tcc)*4.0E0, 0)/4.0E0"
    ),
    "prj28_display_row": keyed(row="CAST(19 - iy AS BIGINT)"),
    "prj29_constant_labels": keyed(
        region="'Unknown Region'", weather_type="'Unknown'", wind_category="'Unknown'", cloud_cover_category="'Unknown'"
    ),
    "prj30_dashboard_table": grid(
        f"SELECT time AS valid_time, latitude, longitude, {rd(TC, 4)} AS temperature_celsius,"
        f" {rd(humidity(DC, TC), 4)} AS relative_humidity, {rd('msl', 4)} AS mean_sea_level_pressure,"
        f" {rd(WIND, 4)} AS wind_speed, {rd('sst - 273.15E0', 4)} AS sea_surface_temperature_celsius,"
        " sp AS surface_pressure, tcc AS total_cloud_cover, tp AS total_precipitation FROM grid WHERE tp IS NOT NULL"
    ),
    "flt1_known_rain": grid(f"SELECT {NS} AS valid_time, latitude, longitude, tp FROM grid WHERE tp IS NOT NULL"),
    "flt2_default_area": grid(
        f"SELECT time, latitude, longitude, {rd('t2m', 6)} AS t2m FROM grid"
        " WHERE latitude BETWEEN 8 AND 24 AND longitude BETWEEN 102 AND 112"
    ),
    "flt2_small_area": grid(
        f"SELECT time, latitude, longitude, {rd('t2m', 6)} AS t2m FROM grid"
        " WHERE latitude BETWEEN 20 AND 23 AND longitude BETWEEN 102.5 AND 105"
    ),
    "flt3_time_range": grid(
        "SELECT time, latitude, longitude, sp FROM grid"
        " WHERE time BETWEEN TIMESTAMP '2024-01-01 06:00:00' AND TIMESTAMP '2024-01-02 18:00:00'"
    ),
    "flt4_point_and_month": climate(
        f"SELECT time AS valid_time, latitude, longitude, {rd(TC, 6)} AS temperature_celsius FROM grid"
        " WHERE tp IS NOT NULL AND latitude = 22.0 AND longitude = 104.0 AND strftime(time, '%Y-%m') = '2024-01'"
    ),
    "flt5_known_temperatures": grid(
        f"SELECT {rd(TC, 6)} AS temperature_celsius, {rd(humidity('(sst - 273.15E0)', TC), 6)} AS relative_humidity"
        " FROM grid WHERE t2m IS NOT NULL AND sst IS NOT NULL"
    ),
    "flt6_strong_wind": grid(
        f"SELECT time, latitude, longitude, {rd('u10', 6)} AS u10, {rd('v10', 6)} AS v10, {rd(WIND, 6)} AS wind_speed"
        f" FROM grid WHERE {WIND} > 10"
    ),
    "flt7_next_to_previous": grid(
        f"SELECT * FROM ({PREVIOUS.format(source='grid')}) WHERE {NEXT_TO}"
    ),
    "srt1_raster_order": grid("SELECT time, latitude, longitude, sp FROM grid ORDER BY time, latitude DESC, longitude"),
    "srt2_report_order": grid(
        f"SELECT latitude, longitude, time AS valid_time, {rd(WIND, 6)} AS wind_speed,"
        f" {rd(f'{BEARING} - 360.0E0*floor({BEARING}/360.0E0)', 6)} AS wind_direction FROM grid"
        " ORDER BY valid_time, latitude, longitude"
    ),
    "srt3_preview": grid(
        "SELECT time, latitude, longitude, sp, tcc FROM grid ORDER BY time, latitude DESC, longitude LIMIT 10"
    ),
    "set1_time_dimension": grid(DIMENSIONS.format(ns=NS)),
    "set2_location_dimension": grid(
        f"SELECT DISTINCT {LOCATION_KEY} AS location_id, latitude, longitude, 'Unknown Region' AS region FROM grid"
    ),
    "set3_condition_dimension": grid(
        "SELECT DISTINCT 'Unknown' AS weather_type, 'Unknown' AS wind_category, 'Unknown' AS cloud_cover_category FROM grid"
    ),
    "set3_conditions_with_labels": grid(
        "SELECT 'Unknown' AS weather_type, 'Unknown' AS wind_category, CASE WHEN tcc < 0.3 THEN 'clear' WHEN tcc < 0.8 THEN 'cloudy'"
        " ELSE 'Unknown' END AS cloud_cover_category, count(*) AS facts FROM grid GROUP BY 3"
    ),
    "set4_union_of_pieces": grid("SELECT time, latitude, longitude, sp, tp FROM grid"),
}
