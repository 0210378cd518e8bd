"""Half-hour slots and calendar columns on zone-free timestamps.

A slot is the number of whole windows since 1970-01-01, an integer, so grouping and shifting
by one window is integer work and never touches the session time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velogrid.schemas import SLOT_MINUTES


def slot_of(ts: str, minutes: int = SLOT_MINUTES) -> Column:
    """Slot of the timestamp column ``ts``."""
    return F.expr(
        f"cast(floor((unix_date(to_date(`{ts}`)) * 1440 + hour(`{ts}`) * 60 + minute(`{ts}`)) / {minutes}) as int)"
    )


def slot_number(at: datetime, minutes: int = SLOT_MINUTES) -> int:
    """The slot of a given time."""
    return (at - datetime(1970, 1, 1)) // timedelta(minutes=minutes)


def slot_time(slot: int, minutes: int = SLOT_MINUTES) -> datetime:
    return datetime(1970, 1, 1) + timedelta(minutes=slot * minutes)


def slot_start(slot: str, minutes: int = SLOT_MINUTES) -> Column:
    """First instant of a slot column."""
    return F.expr(f"timestamp_ntz '1970-01-01 00:00:00' + make_dt_interval(0, 0, {slot} * {minutes})")


def floor_window(ts: str, minutes: int = SLOT_MINUTES) -> Column:
    """Start of the window that holds the timestamp."""
    whole = f"(unix_date(to_date(`{ts}`)) * 1440 + hour(`{ts}`) * 60 + minute(`{ts}`))"
    return slot_start(f"cast(floor({whole} / {minutes}) as int)", minutes)


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.selectExpr(
        "*",
        f"hour(`{ts}`) as hora",
        f"weekday(`{ts}`) as dia_semana",  # Monday = 0
        f"cast(weekday(`{ts}`) >= 5 as int) as es_fin_semana",
        f"month(`{ts}`) as mes",
        f"day(`{ts}`) as dia_mes",
        f"year(`{ts}`) as `año`",
    )
