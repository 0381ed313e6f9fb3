"""Column expressions: binning, rounding, dates and traffic-light statuses.

All of them are built-in Spark expressions and stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

RED, YELLOW, GREEN, UNKNOWN = "red", "yellow", "green", "unknown"

# Worst first.
SEVERITY = {RED: 0, YELLOW: 1, GREEN: 2}


def floor_bin(value: Column, width: Column) -> Column:
    """Start of the bin of ``width`` that holds ``value``.

    Works from the exact remainder, so that fractional widths bin the same way
    as integral ones: 0.3 with width 0.1 falls into the bin that starts at
    0.2, because the doubles 0.3 and 0.1 leave a remainder just under 0.1.
    """
    remainder = value % width
    steps = F.rint((value - remainder) / width)
    return F.when(remainder < 0, steps - 1).otherwise(steps) * width


def by_name(key: Column, values: Mapping[str, float], default: float) -> Column:
    """Look ``key`` up in a small mapping, as a CASE over literals."""
    out: Column | None = None
    for name, value in values.items():
        branch = (key == F.lit(name), F.lit(float(value)))
        out = F.when(*branch) if out is None else out.when(*branch)
    return F.lit(float(default)) if out is None else out.otherwise(F.lit(float(default)))


def round_half_even(value: Column, decimals: int) -> Column:
    """Round by scaling, then to the nearest even integer on ties."""
    scale = float(10**decimals)
    return F.rint(value * scale) / scale


def iso_date(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def month_key(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM")


def month_start(value: Column) -> Column:
    return F.trunc(value, "MM")


def iso_timestamp(value: Column) -> Column:
    """ISO form of a timestamp, with microseconds only where there are any."""
    whole_second = F.date_format(value, "SSSSSS") == "000000"
    return F.when(whole_second, F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def log_timestamp(text: Column) -> Column:
    """The time of a log timestamp; null for text of another form."""
    has_form = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{1,6}$")
    return F.when(has_form, F.try_to_timestamp(text))


def iso_timestamp_or_text(text: Column) -> Column:
    """ISO form of a log timestamp; text of another form stays as it is."""
    return F.coalesce(iso_timestamp(log_timestamp(text)), text)


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def severity(status: Column) -> Column:
    """0 for red, 1 for yellow, 2 for green; null for anything else."""
    out: Column | None = None
    for name, rank in SEVERITY.items():
        out = F.when(status == name, rank) if out is None else out.when(status == name, rank)
    return out


def status_name(rank: Column, missing: str = UNKNOWN) -> Column:
    """The status of a severity; ``missing`` when there is none."""
    out: Column | None = None
    for name, value in SEVERITY.items():
        out = F.when(rank == value, name) if out is None else out.when(rank == value, name)
    return out.otherwise(F.lit(missing))


def traffic_light(red: Column, yellow: Column) -> Column:
    return F.when(red, RED).when(yellow, YELLOW).otherwise(GREEN)


def sorted_by(records: Column, field: str) -> Column:
    """Sort an array of records by one field; the others need not be orderable."""
    return F.array_sort(
        records,
        lambda a, b: F.when(a[field] < b[field], -1).when(a[field] > b[field], 1).otherwise(0),
    )
