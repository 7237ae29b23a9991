"""Time functions. Reference time is always the explicit ``as_of`` column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom import lexicon as lx

MICROS_PER_HOUR = 3.6e9


def parse_iso(text: Column) -> Column:
    """ISO text to timestamp ('Z' and offsets allowed); null when unparsable."""
    return text.try_cast("timestamp")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def weekday(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def age_hours(ts: Column, as_of: Column) -> Column:
    micros = F.unix_micros(as_of) - F.unix_micros(ts)
    return F.coalesce(micros / F.lit(MICROS_PER_HOUR), F.lit(0.0))


def time_decay(ts: Column, as_of: Column, scale_hours: float = lx.DECAY_HOURS) -> Column:
    """exp(-age / scale); above 1 for rows later than ``as_of``."""
    micros = F.unix_micros(as_of) - F.unix_micros(ts)
    return F.exp(-(micros / F.lit(MICROS_PER_HOUR)) / F.lit(float(scale_hours)))


def is_recent(ts: Column, as_of: Column, hours: int = lx.RECENCY_HOURS) -> Column:
    """Bare column on the left, so that a literal ``as_of`` is pushed to the scan."""
    return ts >= as_of - F.make_dt_interval(hours=F.lit(hours))


def relative_time(text: Column, as_of: Column) -> Column:
    """'12s', '5m', '2h', '3d' before ``as_of``; units are tried in that order."""
    lowered = F.lower(text)

    def amount(unit: str) -> Column:
        return F.regexp_extract(lowered, rf"(\p{{Nd}}+){unit}", 1).try_cast("bigint")

    seconds = F.coalesce(
        amount("s"), amount("m") * 60, amount("h") * 3600, amount("d") * 86400
    )
    return F.timestamp_micros(F.unix_micros(as_of) - seconds * 1000000)


def market_session(
    ts: Column,
    open_hour: int = lx.MARKET_OPEN_HOUR,
    close_hour: int = lx.MARKET_CLOSE_HOUR,
    offset_hours: int = lx.MARKET_UTC_OFFSET_HOURS,
) -> Column:
    local = (F.hour(ts) + offset_hours) % 24
    return (
        F.when(local < open_hour, "PRE_MARKET")
        .when(local < close_hour, "MARKET_HOURS")
        .otherwise("AFTER_MARKET")
    )
