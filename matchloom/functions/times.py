"""Epochs, cursors, seasons and retry-after headers. All instants are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchloom import values as V


def _to_seconds(whole: Column) -> Column:
    """BIGINT seconds; exact integer division of milliseconds."""
    thousand = F.lit(1000).cast("bigint")
    return F.when(whole > V.MILLIS_THRESHOLD, F.call_function("div", whole, thousand)).otherwise(whole)


def epoch_seconds(raw: Column) -> Column:
    """Strict digits (or BIGINT) to positive epoch seconds; milliseconds are divided."""
    text = raw.cast("string")
    number = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    seconds = _to_seconds(number)
    return F.when(seconds > 0, seconds)


def block_epoch(attribute: Column) -> Column:
    """Integral number (``"1700000000.0"`` counts) to epoch seconds."""
    number = attribute.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return _to_seconds(whole)


def popup_instant(content: Column) -> Column:
    """``YYYY-MM-DD HH:MM[:SS] UTC`` to a timestamp, else null."""
    text = F.btrim(content)
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss 'UTC'")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm 'UTC'")),
    )


def iso_utc(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_to_iso(seconds: Column) -> Column:
    return iso_utc(F.timestamp_seconds(seconds))


def iso_epoch(text: Column) -> Column:
    """ISO time with a zone and whole seconds to epoch seconds, else null."""
    shaped = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.0+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})$")
    return F.when(shaped, F.unix_timestamp(F.try_to_timestamp(text)))


def cursor_millis(raw: Column) -> Column:
    """History cursor in milliseconds; seconds are multiplied, junk is null."""
    text = raw.cast("string")
    number = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    return (
        F.when((number > 0) & (number < V.MILLIS_THRESHOLD), number * 1000)
        .when(number >= V.MILLIS_THRESHOLD, number)
    )


def page_in_window(cursor: Column, low: int | None, closed_season: bool = False) -> Column:
    """Does a history page still reach into the window? Pages without cursor always do."""
    if low is None:
        return F.lit(True)
    number = cursor.try_cast("bigint")
    seconds = _to_seconds(number)
    inside = seconds > low if closed_season else seconds >= low
    return F.when(cursor.isNull(), F.lit(True)).otherwise(F.coalesce(inside, F.lit(False)))


def in_window(seconds: Column, low: int | None, high: int | None) -> Column:
    """Half-open window. With no bound all pass; with one, a missing time fails."""
    if low is None and high is None:
        return F.lit(True)
    test = seconds.isNotNull()
    if low is not None:
        test = test & (seconds >= low)
    if high is not None:
        test = test & (seconds < high)
    return test


def latest_finished_season(instant: Column) -> Column:
    """Season closed at ``instant``: settlement is the month's first Monday, 09:00."""
    first = F.trunc(F.to_date(instant), "month")
    settlement = F.make_timestamp_ltz(
        F.year(first), F.month(first),
        F.dayofmonth(F.next_day(F.date_sub(first, 1), "MON")),
        F.lit(9), F.lit(0), F.lit(0).cast("decimal(16,6)"), F.lit("UTC"),
    )
    back = F.when(instant < settlement, F.lit(-2)).otherwise(F.lit(-1))
    return F.date_format(F.add_months(first, back), "yyyy-MM")


def season_list(latest: Column, months: int = 48) -> Column:
    """Season ids from ``latest`` backwards."""
    start = F.to_date(F.concat(latest, F.lit("-01")))
    return F.transform(
        F.sequence(F.lit(0), F.lit(months - 1)),
        lambda i: F.date_format(F.add_months(start, -i), "yyyy-MM"),
    )


def retry_after_seconds(header: Column, now: Column) -> Column:
    """Finite non-negative seconds, or an HTTP date relative to ``now``."""
    number = header.try_cast("double")
    undayed = F.regexp_replace(header, "^[A-Za-z]{3}, ", "")
    date = F.try_to_timestamp(undayed, F.lit("dd MMM yyyy HH:mm:ss 'GMT'"))
    finite = (number >= 0) & (number < float("inf")) & ~F.isnan(number)
    return (
        F.when(number.isNotNull(), F.when(finite, number))
        .when(date.isNotNull(), F.greatest(F.lit(0.0), (F.unix_timestamp(date) - F.unix_timestamp(now)).cast("double")))
    )


def campaign_start(date_text: Column) -> Column:
    """UTC midnight of an ISO date, in epoch seconds."""
    return F.unix_timestamp(F.try_to_timestamp(date_text, F.lit("yyyy-MM-dd")))


def heartbeat_phase(phase: Column, age_seconds: Column) -> Column:
    """A stale metrics file proves nothing about a running process."""
    lively = phase.isNull() | phase.isin("running", "initializing", "waiting_for_sources")
    return F.when((age_seconds > V.STALE_AFTER_SECONDS) & lively, F.lit("stale_unknown")).otherwise(phase)
