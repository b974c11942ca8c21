"""DuckDB SQL for grid and track operators."""

from __future__ import annotations

from registry.oracle_report import FOUND, track_lengths
from registry.oracle_scalar import CLIMATE, GRID, WIND, grid, rd
from registry.oracle_storm_parts import (
    BASE, FRAME_MIN, GOOD, MEASURED, SMOOTH, STORM_HOURS, accepted, area, chain, label, measure, named, storms,
)
from registry.fixture import DUCK_TIME, GRID_SQL

YEARS = GRID_SQL.format(time=DUCK_TIME.format(step=500), orders="orders")
# Pressure is missing in some cells: it counts as the mean while frames are smoothed, and is missing again afterwards.
GAP = "(frame*7 + iy*15 + ix) % 41 = 0"
GAPPY = f"""SELECT * REPLACE (coalesce(CASE WHEN {GAP} THEN NULL ELSE msl END, avg(CASE WHEN {GAP} THEN NULL ELSE msl END)
  OVER (PARTITION BY time)) AS msl), {GAP} AS gap FROM ({GRID})"""
SMOOTH_GAPPY = SMOOTH.replace("sm AS MATERIALIZED", "filled AS MATERIALIZED") + """,
sm AS MATERIALIZED (SELECT s.time, s.iy, s.ix, CASE WHEN g.gap THEN NULL ELSE s.v END AS v FROM filled s JOIN grid g USING (time, iy, ix)),
gap_wind AS MATERIALIZED (SELECT time, max(sqrt(u10*u10 + v10*v10)) AS gap_wind FROM grid WHERE gap GROUP BY time)"""
GAPPY_GOOD = (
    SMOOTH_GAPPY, label("sm", "v < 100000.0E0"), measure(), accepted().replace("good AS MATERIALIZED", "found AS MATERIALIZED"), FRAME_MIN,
    """
good AS MATERIALIZED (SELECT f.* REPLACE (greatest(max_wind, coalesce(gap_wind, 0.0E0)) AS max_wind) FROM found f LEFT JOIN gap_wind USING (time))""",
)
# Around the globe, 24 degrees a column, the frames turned by eight columns; neighbours meet over the seam.
TURNED = f"SELECT * REPLACE ((ix + 8) % 15 AS ix) FROM ({GRID})"
CIRCLE = "least(abs({a}.ix - {b}.ix), 15 - abs({a}.ix - {b}.ix))"


def around(sql: str) -> str:
    for a, b in (("m", "r"), ("m", "n")):
        sql = sql.replace(f"abs({a}.ix - {b}.ix)", CIRCLE.format(a=a, b=b))
    return sql.replace("102.0E0 + 0.25E0*", "24.0E0*")


SEAM = (
    SMOOTH.split("sx AS")[0] + "sm AS" + SMOOTH.split("sm AS")[1].replace("g.time, g.iy, g.ix, sum(q.w*n.v)", "g.time, g.iy, g.ix, sum(q.w*n.msl)")
    .replace("FROM sx g", "FROM grid g").replace("JOIN sx n", "JOIN grid n"),
    around(label("sm", "v < 100000.0E0")), around(measure()), around(accepted(d=30000.0)),
)
UPSIDE_DOWN = UPSIDE_DOWN = f"SELECT * REPLACE (202600.0E0 - msl AS msl) FROM ({GRID})"
HIGH = (SMOOTH, label("sm", "v > 102600.0E0"), measure(sign=-1))
FILLED = """SELECT time, iy, ix, coalesce(sst, avg(sst) OVER (PARTITION BY time)) AS filled FROM grid"""
ONES = "string_agg(CASE WHEN c.interior THEN '1' ELSE '0' END, '{sep}' ORDER BY {order})"
MASKS = """SELECT s.time, s.label, g.iy*15 + g.ix AS cell, coalesce(c.interior, false) AS interior
 FROM good s JOIN grid g ON g.time = s.time
 LEFT JOIN cells c ON c.time = s.time AND c.label = s.label AND c.iy = g.iy AND c.ix = g.ix"""
TEXTS = f"""SELECT time, '(' || count(DISTINCT label) || ', 20, 15)_[' || {ONES.format(sep=', ', order='c.label, c.cell')} || ']' AS regions_storm
 FROM ({MASKS}) c GROUP BY time"""
MASKS_GAPPY = MASKS.replace("coalesce(c.interior, false)", "(coalesce(c.interior, false) OR g.gap)")
TEXTS_GAPPY = TEXTS.replace(MASKS, MASKS_GAPPY)
HOUR_COLUMNS = f"""time, id, lon_storm, lat_storm, {rd('amp_storm', 4)} AS amp_storm, {rd('max_wind_speed', 4)} AS max_wind_speed,
 {rd('area_storm', 4)} AS area_storm, regions_storm"""
KEEP = "points > 2.0 AND length_km >= 150.0 AND straight_km/nullif(length_km, 0) >= 0.3"


def good(select: str, **limits) -> str:
    return chain(*MEASURED, accepted(**limits), FRAME_MIN) + f"\nSELECT {select}"


def levels(tail: str) -> str:
    """Level after level, highest first; interiors found so far are left out of the next mask.

    The range's levels above the highest pressure add nothing (here 101300).
    """
    parts = ["raw AS MATERIALIZED (SELECT time, iy, ix, msl AS v FROM grid)"]
    done: list[str] = []
    for level in range(101200, 99199, -400):
        p = f"l{level}_"
        before = " AND NOT EXISTS (SELECT 1 FROM ({}) t WHERE t.time = raw.time AND t.iy = raw.iy AND t.ix = raw.ix)"
        gone = before.format(" UNION ALL ".join(f"SELECT * FROM {d}out" for d in done)) if done else ""
        parts += [
            label("raw", f"v < {level}.0E0{gone}", p),
            measure(p=p),
            accepted(d=300.0, p=p, extra="AND internal_extremum"),
            f"""
{p}out AS MATERIALIZED (SELECT c.time, c.iy, c.ix FROM {p}cells c JOIN {p}good s USING (time, label) WHERE c.interior)""",
        ]
        done.append(p)
    union = " UNION ALL ".join(f"SELECT {p[1:-1]}.0E0 AS level, * FROM {p}good" for p in done)
    outs = " UNION ALL ".join(f"SELECT * FROM {p}out" for p in done)
    return chain(*parts) + "\n" + tail.format(good=union, out=outs)


WRAPPED = " UNION ALL ".join(
    f"SELECT time, iy, ix + {shift} AS ix, ix*24.0E0 + {turn} AS longitude, {rd('msl', 4)} AS msl, {rd(WIND, 4)} AS wind"
    f" FROM grid{where}"
    for shift, turn, where in (
        (2, 0, ""),
        (-13, -360, " WHERE ix*24.0E0 >= 312"),
        (17, 360, " WHERE ix < 2"),
    )
)

ORACLES = {
    "grd1_whole_frames": grid(
        "SELECT time, count(*) AS n, string_agg(CAST(CAST(floor(msl) AS BIGINT) AS VARCHAR), ' ' ORDER BY iy, ix) AS frame"
        " FROM grid GROUP BY time"
    ),
    "grd2_point_series": grid(f"SELECT time, {rd('msl', 4)} AS msl FROM grid WHERE latitude = 22.0 AND longitude = 104.0"),
    "grd1_copies": grid(
        f"SELECT time, iy, ix, {rd('CASE WHEN c % 7 = 0 THEN msl - 5.0E0 WHEN c % 13 = 0 THEN NULL ELSE msl END', 4)} AS msl,"
        f" {rd('CASE WHEN c % 7 = 0 THEN -u10 WHEN c % 13 = 0 THEN NULL ELSE u10 END', 4)} AS u10 FROM (SELECT *, iy*15 + ix AS c FROM grid)"
    ),
    "grd3_filled": grid(f"SELECT time, iy, ix, {rd('filled', 6)} AS filled FROM ({FILLED})"),
    "grd3_smoothed_with_gaps": chain(
        "src AS MATERIALIZED (SELECT * FROM grid)",
        SMOOTH,
        over=f"SELECT time, iy, ix, sst, coalesce(sst, avg(sst) OVER (PARTITION BY time)) AS msl FROM ({GRID})",
    )
    + f"\nSELECT s.time, s.iy, s.ix, {rd('CASE WHEN g.sst IS NOT NULL THEN s.v END', 5)} AS sst FROM sm s JOIN src g USING (time, iy, ix)",
    "grd4_smoothed": chain(SMOOTH) + f"\nSELECT time, iy, ix, {rd('v', 3)} AS msl FROM sm",
    "grd5_masked": chain(SMOOTH) + "\nSELECT time, iy, ix FROM sm WHERE v < 100000",
    "grd5_masked_highs": chain(SMOOTH) + "\nSELECT time, iy, ix FROM sm WHERE v > 101000",
    "grd6_labels": chain(*BASE) + "\nSELECT time, cell, label FROM cells",
    "grd6_labels_in_tiles": chain(*BASE) + "\nSELECT time, cell, label FROM cells",
    "grd7_sizes": good("time, label, n_cells FROM good", npix_min=20),
    "grd8_interior": chain(*BASE) + "\nSELECT time, cell, interior FROM cells",
    "grd9_rings": chain(*MEASURED)
    + "\nSELECT time, label, n_interior, n_cells - n_interior AS n_ring FROM regions WHERE n_interior > 0",
    "grd10_internal_extremum": chain(*MEASURED)
    + f"\nSELECT time, label, {rd('amp_abs', 4)} AS inside, {rd('ring_extremum', 4)} AS ring, internal_extremum FROM regions",
    "grd10_required_for_highs": chain(*HIGH, accepted(extra="AND internal_extremum"), over=UPSIDE_DOWN)
    + f"\nSELECT time, label, n_cells, {rd('amp_abs', 4)} AS amp_abs, {rd('amp_rel', 4)} AS amp_rel,"
    " low_lon AS lon, low_lat AS lat FROM good",
    "grd11_amplitudes": good(
        f"time, label, {rd('ring_mean', 4)} AS ring_mean, {rd('amp_rel', 4)} AS amp_rel FROM good", amp=500.0
    ),
    "grd12_extents": good(f"time, label, {rd('extent_km', 4)} AS extent_km FROM good", d=150.0),
    "grd13_centers": good("s.time, s.label, f.lon, f.lat FROM good s JOIN frame_min f USING (time)"),
    "grd14_extremes": good(f"time, label, {rd('amp_abs', 4)} AS amp FROM good"),
    "grd15_areas": good(
        f"s.time, s.label, {rd(area('s.n_cells', 'f.lat'), 4)} AS area FROM good s JOIN frame_min f USING (time)"
    ),
    "grd16_interior_masks": chain(*GOOD)
    + f"\nSELECT time, label, {ONES.format(sep='', order='c.cell')} AS mask FROM ({MASKS}) c GROUP BY time, label",
    "grd16_masks_with_gaps": chain(*GAPPY_GOOD, over=GAPPY)
    + f"\nSELECT time, label, {ONES.format(sep='', order='c.cell')} AS mask FROM ({MASKS_GAPPY}) c GROUP BY time, label",
    "grd17_wind_with_gaps": chain(*GAPPY_GOOD, over=GAPPY) + f"\nSELECT time, label, {rd('max_wind', 6)} AS max_wind FROM good",
    "grd17_strongest_wind": good(f"time, label, {rd('max_wind', 6)} AS max_wind FROM good"),
    "grd18_mask_texts": chain(*GOOD) + "\n" + TEXTS,
    "grd19_wrapped_globe": grid(WRAPPED),
    "grd19_over_the_seam": chain(*SEAM, over=TURNED)
    + f"""
SELECT time, label, n_cells, {rd('amp_abs', 4)} AS amp_abs, {rd('amp_rel', 4)} AS amp_rel, {rd('extent_km', 3)} AS extent_km, low_lat AS lat,
 24.0E0*(low_cell % 15) AS lon FROM good""",
    "grd20_hours_with_gaps": chain(*GAPPY_GOOD, STORM_HOURS, named(1.5), over=GAPPY)
    + f"\nSELECT {HOUR_COLUMNS} FROM hourly LEFT JOIN ({TEXTS_GAPPY}) USING (time)",
    "grd20_hourly_storms": storms(f"SELECT {HOUR_COLUMNS} FROM hourly LEFT JOIN ({TEXTS}) USING (time)"),
    "grd21_levels": levels(
        "SELECT time, label, level, row_number() OVER (PARTITION BY time ORDER BY level DESC, label) - 1 AS idx, n_cells,"
        f" {rd('mass_lon', 3)} AS lon, {rd('mass_lat', 3)} AS lat, {rd('amp_abs', 3)} AS amp_abs,"
        f" {rd(area('n_cells', 'mass_lat'), 3)} AS area_km2 FROM ({{good}})"
    ),
    "grd21_cells_taken_out": levels("SELECT time, iy, ix FROM ({out})"),
    "grd22_centers_of_mass": good(f"time, label, {rd('mass_lon', 5)} AS lon, {rd('mass_lat', 5)} AS lat FROM good"),
    "grd23_region_minima": good("time, label, low_lon AS lon, low_lat AS lat FROM good"),
    "grd24_eccentricity_limit": good(
        f"time, label, {rd('extent_km', 4)} AS extent_km FROM good",
        limit=f"2.0E0*sqrt({area('n_cells', 'interior_lat')}/(pi()*sqrt(1.0E0 - 0.62E0*0.62E0)))",
    ),
    "grd25_storms_of_all_hours": storms(f"SELECT {HOUR_COLUMNS} FROM named JOIN ({TEXTS}) USING (time)"),
    "grd25_broken_run": storms(f"SELECT {HOUR_COLUMNS} FROM named JOIN ({TEXTS}) USING (time)"),
    "grd25_ids_by_year": storms(
        f"""SELECT time, strftime(first, '%Y') || printf('-%02d', dense_rank() OVER (PARTITION BY strftime(first, '%Y') ORDER BY first)) AS id, lon_storm, lat_storm,
 {rd('amp_storm', 4)} AS amp_storm, {rd('max_wind_speed', 4)} AS max_wind_speed, {rd('area_storm', 4)} AS area_storm
 FROM (SELECT *, min(time) OVER (PARTITION BY id) AS first FROM named)""",
        over=YEARS,
    ),
    "grd25_two_ranges": storms(f"SELECT {HOUR_COLUMNS} FROM named JOIN ({TEXTS}) USING (time)"),
    "trk1_detections": chain(*GOOD)
    + f"""
SELECT f.time, lon, lat, idx, n, 'cyclonic' AS type, {rd('amp_abs', 4)} AS amp, {rd('area', 4)} AS area FROM
 (SELECT *, amp_abs, {area('n_cells', 'low_lat')} AS area FROM good) s JOIN ({FOUND}) f ON f.time = s.time AND f.lon = s.low_lon AND f.lat = s.low_lat""",
    "trk1_half_hours": chain(*GOOD)
    + f"""
SELECT count(*) AS rows, count(*) AS nodes, count(DISTINCT time) AS steps, max(idx) AS last FROM ({FOUND})""",
    "trk4_lasting_tracks": track_lengths(
        f"SELECT track_id, points, {rd('length_km', 3)} AS length_km, {rd('straight_km', 3)} AS straight_km FROM summary WHERE {KEEP}"
    ),
    "trk4_stripped_points": track_lengths(
        f"SELECT id AS track_id, row_number() OVER (PARTITION BY id ORDER BY time) AS seq, time, lon, lat FROM pts"
        f" WHERE id IN (SELECT track_id FROM summary WHERE {KEEP})"
    ),
    "trk5_calendar": f"""WITH grid AS ({CLIMATE}),
 days AS (SELECT unnest(generate_series(CAST(min(time) AS DATE), CAST(max(time) AS DATE), INTERVAL 1 DAY))::DATE AS date FROM grid)
SELECT date - DATE '0001-01-01' + 1 AS ordinal, date, year(date) AS year, month(date) AS month, day(date) AS day,
 dayofyear(make_date(2012, month(date), day(date))) AS doy FROM days""",
}
