"""Column expressions of the curated layer.

All are built-in Spark expressions, evaluated inside whole-stage codegen.
Raw inputs are converted with ``try_cast``: with ANSI mode on, a value that
does not fit becomes NULL (and the row is then rejected by validation)
instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripspark.schemas import MONEY

# Fixed values that must equal the reference's.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
UNKNOWN_DAY = "Unknown"
VALID_LICENSES = ["HV0002", "HV0003", "HV0004", "HV0005"]
FLAG_TRUE = "Y"
MAX_TRIP_MILES = 500
MAX_BASE_FARE = 10000


def ts(name: str) -> Column:
    """Raw column as TIMESTAMP (session time zone applies to NTZ input)."""
    return F.col(name).try_cast("timestamp")


def as_int(name: str) -> Column:
    """Raw column as INT; out-of-range values become NULL."""
    return F.col(name).try_cast("int")


def zero_if_null(name: str) -> Column:
    """Raw numeric as DOUBLE with NULL replaced by 0.0."""
    return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0))


def money(name: str) -> Column:
    """``coalesce(x, 0.0)`` as decimal(10,2) (HALF_UP)."""
    return zero_if_null(name).try_cast(MONEY)


def flag(name: str) -> Column:
    """E5: TRUE only for exactly 'Y'; NULL and anything else are FALSE."""
    return F.coalesce(F.col(name) == F.lit(FLAG_TRUE), F.lit(False))


def day_name(t: Column) -> Column:
    """English day name, 'Unknown' when the timestamp is NULL."""
    dow = F.dayofweek(t)
    out = F.when(dow == 1, F.lit(DAY_NAMES[0]))
    for i, name in enumerate(DAY_NAMES[1:], start=2):
        out = out.when(dow == i, F.lit(name))
    return out.otherwise(F.lit(UNKNOWN_DAY))


def weekend(t: Column) -> Column:
    """Sunday or Saturday; NULL timestamp is not a weekend."""
    return F.coalesce(F.dayofweek(t).isin(1, 7), F.lit(False))


def fare_sum(cbd: Column | None = None) -> Column:
    """Fare components summed as DOUBLE (left to right), not yet rounded."""
    total = zero_if_null("base_passenger_fare")
    for c in ("tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee"):
        total = total + zero_if_null(c)
    return total + (cbd if cbd is not None else F.lit(0.0))


def minutes(trip_time: Column) -> Column:
    """Trip seconds / 60 as decimal(10,2)."""
    return (trip_time / F.lit(60.0)).try_cast(MONEY)


def speed_mph(miles: Column, trip_time: Column) -> Column:
    """Miles per hour, NULL unless trip_time > 0 (division stays inside CASE)."""
    return F.when(trip_time > 0, miles / (trip_time / F.lit(3600.0))).try_cast(MONEY)
