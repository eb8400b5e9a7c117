"""Date, number, array and JSON column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_time_text(ts_utc: Column, zone: str = "America/Chicago", standard: str = "CST", daylight: str = "CDT",
                    standard_shift_hours: int = -6) -> Column:
    """A UTC wall-clock time as ``yyyy-MM-dd hh:mm AM ZZZ`` in ``zone``.

    The zone name follows from the shift, so the session time zone plays no part.
    """
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_utc)
    shift = F.timestamp_diff("HOUR", ts_utc, local)
    name = F.when(shift == standard_shift_hours, standard).otherwise(daylight)
    return F.concat_ws(" ", F.date_format(local, "yyyy-MM-dd hh:mm a"), name)


def parse_timestamp(c: Column, pattern: str | None = None) -> Column:
    """Text to a timestamp; null when it does not fit."""
    return F.try_to_timestamp(c, F.lit(pattern)) if pattern else F.try_to_timestamp(c)


def timestamp_text(ts: Column, missing: str = "-") -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(missing))


def previous_midnight(ts: Column) -> Column:
    """Midnight of the day before, as a wall-clock time."""
    return F.date_sub(ts.cast("date"), 1).cast("timestamp_ntz")


def money(c: Column, places: int = 2) -> Column:
    """Half-up rounding; differs from half-even only on exact ties."""
    return F.round(c, places)


def gain_or_loss(c: Column) -> Column:
    return F.when(c >= 0, "gain").otherwise("loss")


def even_only(arr: Column) -> Column:
    return F.filter(arr, lambda x: x % 2 == 0)


def zip_shortest(left: Column, right: Column) -> Column:
    """Pairs ``{a, b}`` up to the shorter length (``arrays_zip`` alone pads with null)."""
    n = F.least(F.size(left), F.size(right))
    return F.transform(
        F.slice(F.arrays_zip(left.alias("a"), right.alias("b")), F.lit(1), n),
        lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b")),
    )


def parse_json(c: Column, schema: str, corrupt: str | None = None) -> Column:
    options = {"mode": "PERMISSIVE"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    return F.from_json(c, schema, options)
