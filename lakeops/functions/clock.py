"""Service-day clocks, durations and operating days."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _is_instant(ts: Column) -> Column:
    """Known while the plan is made, so only one branch is left of a choice by it."""
    return F.typeof(ts) == "timestamp"


def _clock_seconds(ts: Column) -> Column:
    """Seconds since 1970 as the clock shows them: no zone is involved, so no hour is skipped or repeated."""
    days = F.datediff(ts, F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def epoch_seconds(ts: Column) -> Column:
    """Seconds of an instant, or of a zone-less timestamp by its own clock."""
    return F.when(_is_instant(ts), F.unix_seconds(ts.cast("timestamp"))).otherwise(_clock_seconds(ts))


def epoch_micros(ts: Column) -> Column:
    fraction = (F.extract(F.lit("SECOND"), ts) % 1 * 1_000_000).cast("long")
    return F.when(_is_instant(ts), F.unix_micros(ts.cast("timestamp"))).otherwise(_clock_seconds(ts) * 1_000_000 + fraction)


def seconds_to_ntz(seconds: Column) -> Column:
    """The zone-less timestamp so many seconds after 1970 began."""
    days, rest = F.floor(seconds / 86400).cast("int"), F.pmod(seconds, F.lit(86400))
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), rest.cast("decimal(18,6)"))


def two_digits(number: Column) -> Column:
    """Zero-pad to two digits and keep longer numbers whole."""
    text = number.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def service_clock(ts: Column, service_day: Column, truncate_to_two: bool = False) -> Column:
    """OP-92: ``HH:MM`` where the hour keeps counting past 24 after the service day ends.

    ``truncate_to_two`` keeps only the last two digits of the hour, the way a
    fixed-width report column does.
    """
    hours = F.hour(ts) + F.datediff(ts, service_day) * 24
    hour_text = F.right(two_digits(hours), F.lit(2)) if truncate_to_two else two_digits(hours)
    return F.concat(hour_text, F.lit(":"), two_digits(F.minute(ts)))


def duration_seconds(start: Column, end: Column) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def duration_text(start: Column, end: Column, wrap: bool = False) -> Column:
    """OP-122: duration as ``HH:MM``; ``wrap`` folds it into a 24-hour clock.

    The clean form prints a negative duration with a leading minus.
    """
    seconds = duration_seconds(start, end)
    if wrap:
        seconds = F.pmod(seconds, F.lit(86400))
        sign = F.lit("")
    else:
        sign = F.when(seconds < 0, "-").otherwise("")
        seconds = F.abs(seconds)
    hours = F.floor(seconds / 3600).cast("long")
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("long")
    return F.concat(sign, two_digits(hours), F.lit(":"), two_digits(minutes))


def operating_day(ts: Column, cutoff_hour: int = 4) -> Column:
    """OP-123: rows before the cutoff belong to the previous day."""
    return F.to_date(ts - F.expr(f"INTERVAL {int(cutoff_hour)} HOUR"))


def operating_stamp(ts: Column, cutoff_hour: int = 4) -> Column:
    """The mixed variant of OP-123: night rows become midnight of the previous day."""
    return F.when(F.hour(ts) < cutoff_hour, F.date_add(ts, -1).cast("timestamp_ntz")).otherwise(
        ts.cast("timestamp_ntz")
    )


def actual_time(planned: Column, deviation_s: Column) -> Column:
    """OP-124: planned time plus a deviation in seconds."""
    return seconds_to_ntz(epoch_seconds(planned) + deviation_s)


def shift_end_seconds(start_s: Column, end_s: Column, cutoff_hour: int = 4) -> Column:
    """OP-125: an end before the cutoff hour belongs to the following day."""
    return F.when(F.floor(F.pmod(end_s, F.lit(86400)) / 3600) < cutoff_hour, end_s + 86400).otherwise(end_s)


def shift_span_hours(start_s: Column, end_s: Column, cutoff_hour: int = 4, digits: int = 2) -> Column:
    return F.round((shift_end_seconds(start_s, end_s, cutoff_hour) - start_s) / 3600, digits)


def time_of_day_text(value: Column, encoding: str) -> Column:
    """OP-59: ``HH:MM`` from float hours, seconds of the day, or text."""
    if encoding == "hours":
        minutes = F.round(value.cast("double") * 60).cast("long")
    elif encoding == "seconds":
        minutes = F.floor(value.cast("double") / 60).cast("long")
    elif encoding == "text":
        return F.substring(F.trim(value), 1, 5)
    else:
        raise ValueError(f"unknown time encoding: {encoding}")
    return F.concat(
        two_digits(F.floor(minutes / 60).cast("long")), F.lit(":"), two_digits(F.pmod(minutes, F.lit(60)))
    )


def from_epoch(value: Column, unit: str) -> Column:
    """Epoch milliseconds or nanoseconds to an instant."""
    if unit == "ms":
        return F.timestamp_millis(value)
    if unit == "us":
        return F.timestamp_micros(value)
    if unit == "ns":
        return F.timestamp_micros(F.call_function("div", value, F.lit(1000)))
    raise ValueError(f"unknown epoch unit: {unit}")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
