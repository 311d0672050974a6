"""Event-time scalars.  All text times are UTC+8, whatever the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone and shape of every time string in the records.
ZONE = "+08:00"
ZONE_MS = 8 * 3600 * 1000
SHAPE = "0000-00-00 00:00:00"

DAY_MS = 86_400_000
YEAR_MS = 365 * DAY_MS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: Column | str, strict: bool = True) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC+8 to epoch milliseconds.

    ``strict`` fails the job on other text, null included; otherwise such text
    gives null.  The shape is checked apart, as Spark's cast takes more shapes;
    cast and check together are much faster than a pattern formatter.
    """
    text = _col(c)
    shaped = F.translate(text, "0123456789", "0" * 10) == SHAPE
    ms = F.unix_millis(F.when(shaped, F.concat(text, F.lit(ZONE))).try_cast("timestamp"))
    if not strict:
        return ms
    bad = F.raise_error(F.concat(F.lit("not a time: "), F.coalesce(text, F.lit("null"))))
    # never reached, the zero tells the optimizer that no null check is needed
    return F.coalesce(ms, bad.cast("bigint"), F.lit(0).cast("bigint"))


def text_of_millis(c: Column | str) -> Column:
    """Epoch milliseconds to text, by NTZ arithmetic so no session zone enters."""
    local = F.timestamp_add(
        "MILLISECOND", _col(c).cast("bigint") + F.lit(ZONE_MS), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    )
    return F.substring(local.cast("string"), 1, 19)


def format_epoch(c: Column | str, strict: bool = True) -> Column:
    """13 digits are milliseconds, 10 digits seconds; other lengths fail.

    With ``strict=False`` other lengths give null.
    """
    text = _col(c).cast("string")
    digits = F.length(text)
    other = F.raise_error(F.concat(F.lit("not an epoch of 10 or 13 digits: "), F.coalesce(text, F.lit("null"))))
    return (
        F.when(digits == 13, text_of_millis(text.cast("bigint")))
        .when(digits == 10, text_of_millis(text.cast("bigint") * 1000))
        .otherwise(other.cast("string") if strict else F.lit(None).cast("string"))
    )


def slot_of(ms: Column | str, width_ms: int, offset_ms: int = 0) -> Column:
    """Number of the ``width_ms`` slot holding ``ms``; exact for negative times."""
    shifted = _col(ms) + F.lit(offset_ms).cast("bigint")
    width = F.lit(width_ms).cast("bigint")
    return ((shifted - F.pmod(shifted, width)) / width).cast("bigint")


def day_slot(ms: Column | str) -> Column:
    """Number of the UTC+8 calendar day."""
    return slot_of(ms, DAY_MS, ZONE_MS)


def event_time(ms: Column | str) -> Column:
    """Epoch milliseconds as TIMESTAMP, the type watermarks and windows need."""
    return F.timestamp_millis(_col(ms))


def create_date(c: Column | str) -> Column:
    return _two_parts(c).getItem(0)


def create_hour(c: Column | str) -> Column:
    """Text before the first colon of the time part."""
    return F.split_part(_two_parts(c).getItem(1), F.lit(":"), F.lit(1))


def _two_parts(c: Column | str) -> Column:
    text = _col(c)
    parts = F.split(text, " ")
    fine = (F.size(parts) == 2) & (parts.getItem(1) != "")
    bad = F.raise_error(F.concat(F.lit("time format: "), F.coalesce(text, F.lit("null"))))
    return F.when(fine, parts).otherwise(bad.cast("array<string>"))


def age_years(birthday: Column | str, as_of_ms: Column | int) -> Column:
    """Whole 365-day years from ``birthday`` to ``as_of_ms``.

    The birthday may be a date or a date and time; anything else gives null.
    """
    text = _col(birthday)
    full = F.when(F.length(text) == 10, F.concat(text, F.lit(" 00:00:00"))).otherwise(text)
    now = as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("bigint")
    spent = now - parse_time(full, strict=False)
    # sign * floor(|x| / year): integer division truncates toward zero
    size = F.abs(spent)
    return (F.signum(spent) * ((size - F.pmod(size, F.lit(YEAR_MS))) / F.lit(YEAR_MS))).cast("int")
