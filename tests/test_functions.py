import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridgale.functions import geo, keys, physics, times


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_wind_from_due_north(spark):
    u, v = F.lit(0.0), F.lit(-1.0)
    assert value(spark, physics.wind_direction_closed(u, v)) == 360.0
    assert value(spark, physics.wind_direction(u, v)) == 0.0


def test_saturated_air_is_at_100_percent(spark):
    t = F.lit(21.5)
    saturated = physics.relative_humidity(physics.vapor_pressure(t), physics.vapor_pressure(t))
    assert value(spark, saturated) == pytest.approx(100.0)
    assert value(spark, physics.relative_humidity_exponential(t, t)) == pytest.approx(100.0)


def test_quarter_degree_ties_go_to_even(spark):
    assert value(spark, geo.nearest_quarter(F.lit(8.125))) == 8.0
    assert value(spark, geo.nearest_quarter(F.lit(8.375))) == 8.5


@pytest.mark.parametrize("lat", [0.0, 13.37, 22.75, 89.99])
def test_identical_points_are_no_distance_apart(spark, lat):
    d = value(spark, geo.distance_km(F.lit(103.3), F.lit(lat), F.lit(103.3), F.lit(lat)))
    assert d == pytest.approx(0.0, abs=1e-3)


@pytest.mark.parametrize(
    "day,expected", [("2023-02-28", 59), ("2023-03-01", 61), ("2024-03-01", 61), ("2024-02-29", 60), ("1900-03-01", 61), ("2000-12-31", 366)]
)
def test_day_of_year_on_a_leap_baseline(spark, day, expected):
    assert value(spark, times.leap_day_of_year(F.lit(day).cast("date"))) == expected


def test_ordinal_matches_the_calendar(spark):
    for day in (dt.date(1, 1, 1), dt.date(2012, 2, 29), dt.date(2024, 10, 31)):
        assert value(spark, times.proleptic_ordinal(F.lit(day.isoformat()).cast("date"))) == day.toordinal()


@pytest.mark.parametrize("nanos", [0, 1704067200000000000, 1704067200000001999, -1500, 1730419199999999999])
def test_epoch_nanoseconds_are_exact(spark, nanos):
    got = value(spark, times.from_epoch_ns(F.lit(nanos).cast("long")))
    assert got == dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=nanos // 1000)


def test_missing_fields_keep_their_place(spark):
    text = value(spark, keys.message_value([F.lit(1), F.lit(None).cast("double"), F.lit("x")]))
    assert text == "1, nan, x"


def test_mask_text(spark):
    assert value(spark, keys.mask_text(F.array(F.lit(0), F.lit(1)), F.lit(1), 1, 2)) == "(1, 1, 2)_[0, 1]"


def test_row_ids_do_not_change(spark):
    ids = [value(spark, keys.row_id(F.lit(5), F.lit(1.5))) for _ in range(2)]
    assert ids[0] == ids[1]
