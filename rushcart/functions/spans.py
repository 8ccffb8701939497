"""Durations are ``datetime.timedelta`` throughout the library."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F

MICROSECOND = timedelta(microseconds=1)


def text(span: timedelta) -> str:
    """The duration as Spark's ``window`` functions read it."""
    return f"{span // MICROSECOND} microseconds"


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 in the session's (UTC) time zone."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def window_start(ts: str, width: timedelta, slide: timedelta | None = None) -> Column:
    return F.window(ts, text(width), text(slide) if slide else None)["start"]
