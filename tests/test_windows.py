import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_of
from gridgale.operators import reports, windows

START = dt.datetime(2024, 1, 30)


def cells(spark, seed=1):
    rnd = random.Random(seed)
    rows = [
        (START + dt.timedelta(hours=t), 8 + 0.25 * y, 102 + 0.25 * x, rnd.uniform(-15, 15), rnd.uniform(-15, 15))
        for t in list(range(40)) + [2000, 2001]
        for y in range(5)
        for x in range(6)
        if rnd.random() < 0.8
    ]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "time timestamp_ntz, latitude double, longitude double, u10 double, v10 double")


def test_bucketed_lags_equal_global_lags(spark):
    df = windows.strong_wind(cells(spark))
    assert sorted(windows.previous_cells(df).collect(), key=str) == sorted(
        windows.previous_cells_one_task(df).collect(), key=str
    )


def test_a_quiet_hour_between_is_skipped(spark):
    df = cells(spark).where((F.hour("time") != 3) & (F.dayofmonth("time") != 31))
    assert sorted(windows.previous_cells(df).collect(), key=str) == sorted(
        windows.previous_cells_one_task(df).collect(), key=str
    )


def test_running_total_across_months(spark):
    df = windows.with_month(cells(spark).select("time").distinct()).withColumn("one", F.hour("time"))
    whole = Window.orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    want = {r["time"]: r["s"] for r in df.withColumn("s", F.sum("one").over(whole)).collect()}
    got = {r["time"]: r["s"] for r in windows.running_total(df, "one", "s", ["time"]).collect()}
    assert got == want


def hours(spark, centres):
    rows = [(START + dt.timedelta(hours=t), lon, lat) for t, lon, lat in centres]
    return spark.createDataFrame(rows, "time timestamp_ntz, lon_storm double, lat_storm double")


def test_quiet_hours_do_not_end_a_storm(spark):
    centres = [(0, 105.0, 15.0), (1, 105.5, 15.0), (90, 106.0, 15.0), (91, 109.0, 15.0), (92, 109.0, 16.4)]
    df = hours(spark, centres)
    names = lambda thr: [r["id"] for r in windows.name_storms(df, thr, "2022").orderBy("time").collect()]
    assert names(1.5) == ["2022-01", "2022-01", "2022-01", "2022-02", "2022-02"]
    assert names(1.0) == ["2022-01", "2022-01", "2022-01", "2022-02", "2022-03"]
    assert names(0.5) == ["2022-01", "2022-02", "2022-03", "2022-04", "2022-05"]


def test_segments_break_at_quiet_hours_and_midnight(spark):
    df = hours(spark, [(0, 1.0, 1.0), (1, 2.0, 2.0), (2, None, None), (3, 3.0, 3.0), (24, 4.0, 4.0), (25, 5.0, 5.0)])
    got = [(r["from_lon"], r["to_lon"]) for r in windows.daily_segments(df).orderBy("time").collect()]
    assert got == [(1.0, 2.0), (4.0, 5.0)]


def test_only_the_month_table_meets_in_one_task(spark):
    """The unpartitioned step works on one row per month, after two aggregations."""
    df = windows.strong_wind_regions(cells(spark))
    text = plan_of(df)
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    assert len(single) <= 1
    before = text[: text.index("SinglePartition")] if single else ""
    assert "_month" in before


def test_shares_of_each_pie(spark):
    df = spark.createDataFrame([("a", 2.0, 1), ("b", 6.0, 1), ("c", None, 1), ("d", 5.0, 2), ("e", 0.0, 3)], "m string, rain double, pie int")
    shares = {r["m"]: r["share"] for r in reports.share_of_rain(df, "rain", F.col("pie")).collect()}
    assert shares == {"a": 0.25, "b": 0.75, "c": None, "d": 1.0, "e": None}


def test_placeholder_counts_only_in_the_raw_form(spark):
    rows = [(START, "2024-00"), (START, "2024-01"), (START + dt.timedelta(hours=1), "2024-01"), (START + dt.timedelta(days=5), "2024-01")]
    df = spark.createDataFrame(rows, "time timestamp_ntz, id string")
    count = lambda d: {r["month"]: r["storms"] for r in d.collect()}
    assert count(reports.storms_by_month(df)) == {"2024-01": 1, "2024-02": 1}
    assert count(reports.storms_by_month(df, exclude_placeholder=False)) == {"2024-01": 2, "2024-02": 1}
