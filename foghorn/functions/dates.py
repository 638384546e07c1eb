"""Date expressions: window starts, lenient parsing, ages and month buckets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def as_of_lit(as_of: dt.datetime | str) -> Column:
    return F.lit(str(as_of)).cast("timestamp")


def window_start(
    as_of: dt.datetime | str, months: int | None = 12, since: str | None = None
) -> Column:
    """Explicit ISO start when given, else ``int(months * 30.5)`` days before ``as_of``."""
    if since:
        dt.datetime.fromisoformat(since)
        return F.lit(since).cast("timestamp")
    months = 12 if not months or months <= 0 else months
    return as_of_lit(as_of) - F.expr(f"INTERVAL {int(months * 30.5)} DAYS")


def parse_ts(c: Column) -> Column:
    """ISO text to timestamp, null when unreadable."""
    return F.try_to_timestamp(F.trim(c.cast("string")))


def first_ts(*cols: Column, default: Column) -> Column:
    """First readable value of several; a bare four-digit year means its first of January."""
    def one(c: Column) -> Column:
        text = F.trim(c.cast("string"))
        return F.when(
            text.rlike(r"^\d{4}$"), F.try_to_timestamp(F.concat(text, F.lit("-01-01")))
        ).otherwise(F.try_to_timestamp(text))

    return F.coalesce(*[one(c) for c in cols], default)


def membership_ts(c: Column, as_of: Column) -> Column:
    """Date-only text becomes midnight UTC; blank becomes ``as_of``; the rest is kept as text."""
    text = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return (
        F.when(text == "", F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit("T00:00:00Z")))
        .otherwise(text)
    )


def day_first_date(c: Column) -> Column:
    """Day-first list dates to ``yyyy-MM-dd`` text, blank when unreadable."""
    text = F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\s+", " "))
    parsed = F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd")),
        F.try_to_timestamp(text, F.lit("d/M/yyyy")),
        F.try_to_timestamp(text, F.lit("d-M-yyyy")),
        F.try_to_timestamp(text, F.lit("d.M.yyyy")),
        F.try_to_timestamp(text, F.lit("d MMM yyyy")),
        F.try_to_timestamp(text, F.lit("d MMMM yyyy")),
        F.try_to_timestamp(text, F.lit("d-MMM-yyyy")),
        F.try_to_timestamp(text, F.lit("MMM d, yyyy")),
        F.try_to_timestamp(text, F.lit("MMMM d, yyyy")),
    )
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.lit(""))


def join_year(c: Column) -> Column:
    text = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(text.rlike(r"^\d+$"), F.concat(text, F.lit("-01-01"))).otherwise("")


def epoch_millis(c: Column) -> Column:
    return F.timestamp_millis(c.try_cast("bigint"))


def compact_ts(c: Column) -> Column:
    """``yyyyMMddHHmmss``, also with the ``T``/``Z`` marks, else ISO."""
    text = F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), "[TZ]", "")
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")), parse_ts(c))


def url_date(url: Column) -> Column:
    """Date found in a ``/20yy/m/d/`` path."""
    pattern = r"/(20\d{2})/(\d{1,2})/(\d{1,2})/"
    parts = [F.regexp_extract(url, pattern, i) for i in (1, 2, 3)]
    return F.try_to_timestamp(F.concat_ws("-", *parts), F.lit("yyyy-M-d"))


def page_date(time_tag: Column, meta_tag: Column, url: Column) -> Column:
    return F.coalesce(parse_ts(time_tag), parse_ts(meta_tag), url_date(url))


def iso_z(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def month_start(c: Column) -> Column:
    return F.date_trunc("MONTH", c)


def age_days(as_of: Column, ts: Column) -> Column:
    """Fractional days, negative for future events."""
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))
    return micros / F.lit(86_400_000_000.0)
