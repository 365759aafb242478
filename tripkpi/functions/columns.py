"""Column expressions (projections and scalar functions).

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here calls Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripkpi import schemas as S

__all__ = [
    "duration_minutes", "parse_timestamp", "time_slot", "haversine_m", "birth_year", "gender",
    "year_of", "month_of", "period_year", "period_month", "distance_km", "rider_age",
    "age_group", "year_month_label", "share_pct",
]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def duration_minutes(raw: Column | str, divisor: float) -> Column:
    """Raw duration (seconds or milliseconds, any type) -> minutes, 2 decimals.

    ``try_cast`` turns junk into null instead of failing the job under ANSI.
    """
    return F.round(_c(raw).try_cast("double") / F.lit(float(divisor)), 2)


def parse_timestamp(raw: Column | str, fmt: str | None = None) -> Column:
    """Parse a zone-less text timestamp to TIMESTAMP_NTZ; unparseable -> null."""
    col = _c(raw)
    if fmt is None:
        return col.try_cast("timestamp_ntz")
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def time_slot(ts: Column | str) -> Column:
    """Six-hour slot label of a timestamp's hour; null timestamp -> 'Unknown'."""
    hour = F.hour(_c(ts))
    expr = None
    for i, label in enumerate(S.TIME_SLOTS):
        cond = (hour >= i * S.SLOT_HOURS) & (hour < (i + 1) * S.SLOT_HOURS)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(S.UNKNOWN_SLOT)


def haversine_m(lat1: Column | str, lon1: Column | str,
                lat2: Column | str, lon2: Column | str) -> Column:
    """Great-circle distance in metres, rounded to 2 decimals.

    One expression (no helper columns, so no clash with input column names);
    null in any coordinate gives null.
    """
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    c = 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))
    return F.round(c * F.lit(S.EARTH_RADIUS_M), 2)


def _unless_marker(raw: Column, *markers: str) -> Column:
    """Null for the dataset's missing-value markers, the raw value otherwise.

    The markers are tested before any ``try_cast``: a failing string cast
    takes Spark's exception path, which costs microseconds per row, and '\\N'
    fills a large share of some columns.
    """
    return F.when(~raw.isin(*markers), raw)


def birth_year(raw: Column | str) -> Column:
    """Birth year: null, '\\N', '0', junk -> null; keep only 1900..2020.

    The double step accepts '1980.0' (ANSI string->int would reject it).
    """
    year = _unless_marker(_c(raw).cast("string"), S.NULL_MARKER, S.BIRTH_YEAR_MISSING)
    year = year.try_cast("double").try_cast("int")
    return F.when(year.between(S.BIRTH_YEAR_MIN, S.BIRTH_YEAR_MAX), year).cast("int")


def gender(raw: Column | str) -> Column:
    """Gender code: null, '\\N', junk -> null; any integer kept (no range check)."""
    return _unless_marker(_c(raw).cast("string"), S.NULL_MARKER).try_cast("int")


def year_of(ts: Column | str) -> Column:
    return F.year(_c(ts)).cast("int")


def month_of(ts: Column | str) -> Column:
    return F.month(_c(ts)).cast("int")


def period_year(period: Column | str) -> Column:
    """yyyy from a 'yyyyMM' or 'yyyy' period key."""
    return F.substring(_c(period), 1, 4).try_cast("int")


def period_month(period: Column | str) -> Column:
    """MM from a 'yyyyMM' period key."""
    return F.substring(_c(period), 5, 2).try_cast("int")


def distance_km(metres: Column | str) -> Column:
    """Metres -> km, rounded per row (before any averaging)."""
    return F.round(_c(metres) / F.lit(1000.0), 2)


def rider_age(year: Column | str, birth: Column | str) -> Column:
    """Age in the trip's year; null when the birth year is unknown."""
    return (_c(year).cast("int") - _c(birth)).cast("int")


def age_group(age: Column | str) -> Column:
    """Age band label for ages in [10, 100]; null outside or when unknown."""
    a = _c(age)
    expr = None
    for label, upper in zip(S.AGE_GROUPS, S.AGE_GROUP_UPPER):
        expr = F.when(a < upper, label) if expr is None else expr.when(a < upper, label)
    expr = expr.otherwise(S.AGE_GROUPS[-1])
    return F.when(a.isNotNull() & a.between(S.AGE_MIN, S.AGE_MAX), expr)


def year_month_label(year: Column | str, month: Column | str) -> Column:
    """'yyyy-MM' label (zero-padded month)."""
    return F.format_string("%04d-%02d", _c(year), _c(month))


def share_pct(n: Column | str, total: Column | str) -> Column:
    """Percentage share, rounded to 2 decimals: (n / total) * 100."""
    return F.round((_c(n) / _c(total)) * F.lit(100.0), 2)
