"""The storm chain in SQL: smoothing, regions by reachability, measures, hourly storms."""

from __future__ import annotations

from registry.oracle_scalar import CLIMATE, GRID

NY, NX = 20, 15

# Gaussian weights for sigma 0.8, reach 3.
_RAW = "(VALUES " + ", ".join(f"({k}, exp(-0.5E0*pow({k}/0.8E0, 2)))" for k in range(-3, 4)) + ") t(k, w)"


def _mirror(index: str, size: int) -> str:
    return f"CASE WHEN {index} < 0 THEN -({index}) - 1 WHEN {index} >= {size} THEN {2 * size - 1} - ({index}) ELSE {index} END"


SMOOTH = f"""
kern AS MATERIALIZED (SELECT k, w/(SELECT sum(w) FROM {_RAW}) AS w FROM {_RAW}),
sx AS MATERIALIZED (SELECT g.time, g.iy, g.ix, sum(q.w*n.msl) AS v
  FROM grid g CROSS JOIN kern q
  JOIN grid n ON n.time = g.time AND n.iy = g.iy AND n.ix = {_mirror('g.ix + q.k', NX)}
  GROUP BY g.time, g.iy, g.ix),
sm AS MATERIALIZED (SELECT g.time, g.iy, g.ix, sum(q.w*n.v) AS v
  FROM sx g CROSS JOIN kern q
  JOIN sx n ON n.time = g.time AND n.ix = g.ix AND n.iy = {_mirror('g.iy + q.k', NY)}
  GROUP BY g.time, g.iy, g.ix)"""


def label(field: str, mask: str, p: str = "") -> str:
    """Cells of `field` (time, iy, ix, v) that satisfy `mask`, with label and interior flag."""
    return f"""
{p}mask AS MATERIALIZED (SELECT time, iy, ix, iy*{NX} + ix AS cell, v FROM {field} WHERE {mask}),
{p}reach AS (SELECT time, cell, iy, ix, cell AS lab FROM {p}mask
  UNION SELECT m.time, m.cell, m.iy, m.ix, r.lab FROM {p}reach r JOIN {p}mask m
    ON m.time = r.time AND abs(m.iy - r.iy) + abs(m.ix - r.ix) = 1),
{p}lab AS MATERIALIZED (SELECT time, cell, min(lab) AS label FROM {p}reach GROUP BY time, cell),
{p}core AS MATERIALIZED (SELECT m.time, m.cell FROM {p}mask m JOIN {p}mask n
    ON n.time = m.time AND abs(m.iy - n.iy) + abs(m.ix - n.ix) = 1
  GROUP BY m.time, m.cell HAVING count(*) = 4),
{p}cells AS MATERIALIZED (SELECT m.time, m.iy, m.ix, m.cell, m.v, l.label, i.cell IS NOT NULL AS interior,
    24.0E0 - 0.25E0*m.iy AS lat, 102.0E0 + 0.25E0*m.ix AS lon, sqrt(g.u10*g.u10 + g.v10*g.v10) AS wind
  FROM {p}mask m JOIN {p}lab l USING (time, cell) LEFT JOIN {p}core i USING (time, cell)
  JOIN grid g ON g.time = m.time AND g.iy = m.iy AND g.ix = m.ix)"""


def measure(sign: int = 1, p: str = "") -> str:
    s = "" if sign > 0 else "-"
    return f"""
{p}ring AS MATERIALIZED (SELECT time, label, lat, lon FROM {p}cells WHERE NOT interior),
{p}extent AS MATERIALIZED (SELECT time, label, max(CASE WHEN c < 1 THEN 6378.1E0*acos(c) ELSE 0.0E0 END) AS extent_km
  FROM (SELECT a.time, a.label, sin(radians(a.lat))*sin(radians(b.lat))
      + cos(radians(a.lon - b.lon))*cos(radians(a.lat))*cos(radians(b.lat)) AS c
    FROM {p}ring a JOIN {p}ring b ON a.time = b.time AND a.label = b.label) GROUP BY time, label),
{p}regions AS MATERIALIZED (SELECT time, label, count(*) AS n_cells, count(*) FILTER (interior) AS n_interior,
    {s}min({s}v) FILTER (interior) AS amp_abs, {s}min({s}v) FILTER (NOT interior) AS ring_extremum,
    avg(v) FILTER (NOT interior) AS ring_mean,
    {s}(avg(v) FILTER (NOT interior)) - min({s}v) FILTER (interior) AS amp_rel,
    min({s}v) FILTER (interior) < min({s}v) FILTER (NOT interior) AS internal_extremum,
    greatest(0.0E0, max(wind) FILTER (interior)) AS max_wind,
    24.0E0 - 0.25E0*sum(iy*v)/sum(v) AS mass_lat, 102.0E0 + 0.25E0*sum(ix*v)/sum(v) AS mass_lon,
    avg(lat) FILTER (interior) AS interior_lat, arg_min(cell, ({s}v, cell)) AS low_cell
  FROM {p}cells GROUP BY time, label)"""


FRAME_MIN = f"""
frame_min AS MATERIALIZED (SELECT time, 24.0E0 - 0.25E0*iy AS lat, 102.0E0 + 0.25E0*ix AS lon FROM sm
  QUALIFY row_number() OVER (PARTITION BY time ORDER BY v, iy*{NX} + ix) = 1)"""


def accepted(
    npix_min: int = 9, amp: float = 100.0, d: float = 2500.0, p: str = "", extra: str = "", limit: str | None = None
) -> str:
    bound = limit or f"{d!r}"
    return f"""
{p}good AS MATERIALIZED (SELECT r.*, e.extent_km,
    24.0E0 - 0.25E0*(r.low_cell // {NX}) AS low_lat, 102.0E0 + 0.25E0*(r.low_cell % {NX}) AS low_lon
  FROM {p}regions r JOIN {p}extent e USING (time, label)
  WHERE n_interior > 0 AND n_cells BETWEEN {npix_min} AND 6000 AND amp_rel >= {amp!r} AND extent_km < {bound} {extra})"""


def area(cells: str, lat: str) -> str:
    return f"({cells}*0.0625E0*111.325E0*0.017453292519943295E0*6371.0E0*cos(radians({lat})))"


STORM_HOURS = f"""
storm_hours AS MATERIALIZED (SELECT s.time, s.label, f.lon AS lon_storm, f.lat AS lat_storm, s.amp_abs AS amp_storm,
    s.max_wind AS max_wind_speed, {area('s.n_cells', 'f.lat')} AS area_storm
  FROM good s JOIN frame_min f USING (time)
  QUALIFY row_number() OVER (PARTITION BY s.time ORDER BY s.label) = 1)"""


def named(threshold: float, prefix: str = "2022") -> str:
    return f"""
moved AS MATERIALIZED (SELECT *, lag(lon_storm) OVER w AS plon, lag(lat_storm) OVER w AS plat FROM storm_hours WINDOW w AS (ORDER BY time)),
named AS MATERIALIZED (SELECT time, printf('{prefix}-%02d', CAST(sum(CASE WHEN sqrt(pow(lon_storm - plon, 2) + pow(lat_storm - plat, 2)) < {threshold!r}
    THEN 0 ELSE 1 END) OVER (ORDER BY time) AS BIGINT)) AS id, label, lon_storm, lat_storm, amp_storm, max_wind_speed, area_storm FROM moved),
hourly AS MATERIALIZED (SELECT t.time, coalesce(n.id, '{prefix}-00') AS id, n.lon_storm, n.lat_storm, n.amp_storm, n.max_wind_speed, n.area_storm
  FROM (SELECT DISTINCT time FROM grid) t LEFT JOIN named n USING (time))"""


def chain(*parts: str, over: str = GRID) -> str:
    """WITH clause from the grid through the given steps."""
    return "WITH RECURSIVE grid AS MATERIALIZED (" + over + ")," + ",".join(parts)


BASE = (SMOOTH, label("sm", "v < 100000.0E0"))
MEASURED = (*BASE, measure())
GOOD = (*MEASURED, accepted(), FRAME_MIN)
HOURS = (*GOOD, STORM_HOURS)


def storms(body: str, threshold: float = 1.5, over: str = GRID) -> str:
    return chain(*HOURS, named(threshold), over=over) + "\n" + body


CLIMATE_GRID = CLIMATE
