"""Greedy tracking in SQL: one recursion step per live track, then one per time step."""

from __future__ import annotations

from registry.oracle_report import FOUND
from registry.oracle_storm_parts import GOOD, chain

POINT = "STRUCT(track BIGINT, idx BIGINT, lon DOUBLE, lat DOUBLE)[]"
KM = """6371.0E0*acos(least(1.0E0, sin(radians(l.lat))*sin(radians(d.lat))
   + cos(radians(l.lon - d.lon))*cos(radians(l.lat))*cos(radians(d.lat))))"""

# A row of `run` is the state within a step: `live` tracks of the step before, the first `pos`
# of which have chosen; `free` detections; `picked` continuations. With all chosen, what is
# still free begins new tracks and the next step starts.
_TRACKED = f"""
found AS MATERIALIZED (SELECT *, date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', time) AS step FROM (detections)),
steps AS (SELECT unnest(range(min(step), max(step) + 1)) AS step FROM found),
dets AS MATERIALIZED (SELECT s.step,
    coalesce(list({{'idx': f.idx, 'lon': f.lon, 'lat': f.lat}} ORDER BY f.idx) FILTER (f.idx IS NOT NULL), []) AS ds
  FROM steps s LEFT JOIN found f USING (step) GROUP BY s.step),
run AS (
  SELECT step, CAST(0 AS BIGINT) AS pos, CAST([] AS {POINT}) AS live, ds AS free, CAST([] AS {POINT}) AS picked,
    CAST(0 AS BIGINT) AS next_track
  FROM dets WHERE step = (SELECT min(step) FROM dets)
  UNION ALL
  SELECT CASE WHEN choosing THEN s.step ELSE s.step + 1 END,
    CASE WHEN choosing THEN pos + 1 ELSE 0 END,
    CASE WHEN choosing THEN live ELSE ended END,
    CASE WHEN NOT choosing THEN d.ds WHEN best IS NULL THEN free ELSE list_filter(free, lambda x: x.idx <> best.idx) END,
    CASE WHEN NOT choosing THEN CAST([] AS {POINT}) WHEN best IS NULL THEN picked
      ELSE list_append(picked, {{'track': l.track, 'idx': best.idx, 'lon': best.lon, 'lat': best.lat}}) END,
    CASE WHEN choosing THEN next_track ELSE next_track + len(free) END
  FROM (SELECT *, pos < len(live) AS choosing,
      list_concat(picked, list_transform(free, lambda x, i: {{'track': next_track + i - 1, 'idx': x.idx, 'lon': x.lon, 'lat': x.lat}})) AS ended,
      (SELECT arg_min(d, ({KM}, d.idx)) FROM (SELECT unnest(free) AS d) WHERE {KM} <= reach_km) AS best
    FROM (SELECT *, live[pos + 1] AS l FROM run)) s
  LEFT JOIN dets d ON d.step = s.step + 1
  WHERE choosing OR d.step IS NOT NULL),
points AS MATERIALIZED (SELECT step, unnest(list_concat(picked, list_transform(free,
    lambda x, i: {{'track': next_track + i - 1, 'idx': x.idx, 'lon': x.lon, 'lat': x.lat}}))) AS p
  FROM run WHERE pos = len(live)),
tracks AS MATERIALIZED (SELECT p.track AS track_id, step, step - min(step) OVER (PARTITION BY p.track) AS seq,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(step AS INTEGER)) AS time, p.idx AS idx, p.lon AS lon, p.lat AS lat,
    min(step) OVER (PARTITION BY p.track) = (SELECT min(step) FROM found) AS exist_at_start
  FROM points)
"""

def tracked(reach_km: float, begin: str = chain(*GOOD) + ",", detections: str = FOUND) -> str:
    return begin + _TRACKED.replace("reach_km", repr(reach_km)).replace("detections", detections)


CROWD = """SELECT *, row_number() OVER (PARTITION BY time ORDER BY k) - 1 AS idx FROM (
 SELECT o_orderkey AS k, TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(o_orderkey % 8760 AS INTEGER)) AS time,
  105.0E0 + ((o_orderkey*7919) % 1500)/1000.0E0 AS lon, 15.0E0 + ((o_orderkey*104729) % 1500)/1000.0E0 AS lat FROM orders)"""


POINTS = "SELECT track_id, seq, time, idx, lon, lat, 'cyclonic' AS type, exist_at_start FROM tracks"

ORACLES = {
    "trk2_initial_tracks": tracked(80.0) + "SELECT track_id, time, lon, lat, exist_at_start FROM tracks WHERE seq = 0",
    "trk3_tracks": tracked(80.0) + POINTS,
    "trk3_crowded_year": tracked(80.0, "WITH RECURSIVE ", CROWD) + POINTS,
    "trk3_tracks_far_reach": tracked(400.0) + POINTS,
}
