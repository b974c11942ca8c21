"""Thermodynamics and wind."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Physical constants of the formulas below.
KELVIN = 273.15
GAS_CONSTANT_DRY_AIR = 287.05
TETENS = {"e0": 6.11, "slope": 7.5, "offset": 237.3}
MAGNUS = {"slope": 17.625, "offset": 243.04}
APPARENT = {"vapor": 0.33, "wind": 0.70, "shift": 4.00}
MM_PER_M = 1000.0


def kelvin_to_celsius(kelvin: Column) -> Column:
    return kelvin - F.lit(KELVIN)


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def _bearing(u: Column, v: Column) -> Column:
    return F.degrees(F.atan2(u, v)) + F.lit(180.0)


def wind_direction(u: Column, v: Column) -> Column:
    """Degrees the wind comes from, in [0, 360)."""
    bearing = _bearing(u, v)
    return bearing - F.lit(360.0) * F.floor(bearing / F.lit(360.0))


def wind_direction_closed(u: Column, v: Column) -> Column:
    """As `wind_direction`, but due north stays 360: range [0, 360]."""
    bearing = _bearing(u, v)
    return F.when(bearing < 0, bearing + F.lit(360.0)).otherwise(bearing)


def vapor_pressure(celsius: Column) -> Column:
    """Over the dew point this is the actual pressure, over the temperature the saturated one."""
    exponent = F.lit(TETENS["slope"]) * celsius / (celsius + F.lit(TETENS["offset"]))
    return F.lit(TETENS["e0"]) * F.pow(F.lit(10.0), exponent)


def relative_humidity(vapor: Column, saturated: Column) -> Column:
    return vapor / saturated * F.lit(100.0)


def relative_humidity_exponential(dew_celsius: Column, celsius: Column) -> Column:
    """The exponential form; not numerically equal to `relative_humidity`."""

    def growth(c: Column) -> Column:
        return F.exp(F.lit(MAGNUS["slope"]) * c / (c + F.lit(MAGNUS["offset"])))

    return growth(dew_celsius) / growth(celsius) * F.lit(100.0)


def apparent_temperature(celsius: Column, vapor: Column, wind: Column) -> Column:
    return (
        celsius
        + F.lit(APPARENT["vapor"]) * vapor
        - F.lit(APPARENT["wind"]) * wind
        - F.lit(APPARENT["shift"])
    )


def air_density(surface_pressure: Column, celsius: Column) -> Column:
    return surface_pressure / (F.lit(GAS_CONSTANT_DRY_AIR) * (celsius + F.lit(KELVIN)))


def rain_millimetres(metres: Column) -> Column:
    return metres * F.lit(MM_PER_M)


def nan_to_null(value: Column) -> Column:
    """Spark orders NaN above every number, so missing values must be null."""
    return F.when(~F.isnan(value), value)
