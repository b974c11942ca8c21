"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. Every query is run to its last row: once to warm up, then three times, or until 15 seconds
are over, and the median counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gridgale.session import get_session  # noqa: E402
from registry import all_queries  # noqa: E402

HEADLINES = [
    "src6_day_frames", "src7_whole_dataset", "snk2_day_folders", "prj9_relative_humidity",
    "prj30_dashboard_table", "joi1_rain_and_weather", "joi2_star_read_back", "joi4_nearest_next",
    "agg1_daily_precipitation", "agg2_monthly_mean_temperature", "agg4_point_monthly",
    "agg5_storms_by_month", "win1_strong_wind_regions", "win2_storm_names", "grd1_completeness",
    "grd4_smoothed", "grd6_labels", "grd12_extents", "grd21_levels", "grd25_storms_of_all_hours",
    "grd1_copies", "trk3_tracks", "trk4_lasting_tracks", "str1_parsed_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    spent = {}
    for name in HEADLINES:
        run(name)
        runs = [run(name)]
        while len(runs) < 3 and sum(runs) < 15:
            runs.append(run(name))
        spent[name] = round(median(runs), 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(spent.values()), 3),
        "unit": "sec",
        "queries": spent,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
