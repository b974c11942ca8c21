"""Text keys, stable ids and the text form of observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridgale.schema import KEY_SEPARATOR, MESSAGE_SEPARATOR, MISSING_TEXT


def location_key(latitude: Column, longitude: Column) -> Column:
    return F.concat_ws(",", latitude.cast("string"), longitude.cast("string"))


def row_id(*parts: Column) -> Column:
    """An id that only depends on the row, so a rerun gives the same one."""
    return F.xxhash64(*parts)


def observation_id(time_ns: Column, latitude: Column, longitude: Column) -> Column:
    """Minute, latitude and longitude packed into one long: exact, and in their order.

    Takes whole minutes from 1970 for 4,000 years on and hundredths of a degree; anything
    finer is an error, since two rows could then share an id.
    """
    minute = F.call_function("div", time_ns, F.lit(60_000_000_000))
    north, east = (F.round((x + shift) * 100).cast("long") for x, shift in ((latitude, 90), (longitude, 180)))
    fits = (
        (F.pmod(time_ns, F.lit(60_000_000_000)) == 0) & minute.between(0, (1 << 31) - 1)
        & (F.abs((latitude + 90) * 100 - north) < 1e-6) & (F.abs((longitude + 180) * 100 - east) < 1e-6)
        & north.between(0, (1 << 15) - 1) & east.between(0, (1 << 16) - 1)
    )
    packed = F.shiftleft(minute, 31).bitwiseOR(F.shiftleft(north, 16)).bitwiseOR(east)
    return F.when(~fits, F.raise_error(F.lit("time or place too fine for an id")).cast("long")).otherwise(packed)


def storm_name(prefix: Column | str, number: Column) -> Column:
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.format_string("%s-%02d", prefix, number)


def message_key(time: Column, latitude: Column, longitude: Column) -> Column:
    return F.concat_ws(KEY_SEPARATOR, time, latitude.cast("string"), longitude.cast("string"))


def message_value(fields: Sequence[Column]) -> Column:
    """Fields in order; missing ones keep their place as text, since concat_ws drops nulls."""
    texts = [F.coalesce(f.cast("string"), F.lit(MISSING_TEXT)) for f in fields]
    return F.concat_ws(MESSAGE_SEPARATOR, *texts)


def mask_text(masks: Column, count: Column, ny: int, nx: int) -> Column:
    """`(n, ny, nx)_[0, 1, ...]` from the flattened 0/1 array of n stacked masks."""
    return F.concat(
        F.lit("("),
        count.cast("string"),
        F.lit(f", {ny}, {nx})_["),
        F.array_join(masks.cast("array<string>"), ", "),
        F.lit("]"),
    )
