"""Money, durations, time stamps and grades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import GRADES, LAST_GRADE


def call_cost(prompt: Column, completion: Column, price_in: Column, price_out: Column) -> Column:
    """US dollars of a call at prices per million tokens, to six places: exact millionths, then rounded."""
    exact = prompt * price_in.cast("decimal(12,4)") + completion * price_out.cast("decimal(12,4)")
    return F.round(exact, 0).cast("double") / 1e6


def cost_text(c: Column) -> Column:
    return F.when(c == 0, "$0.00").when(c < 0.01, F.format_string("$%.6f", c)).otherwise(F.format_string("$%.4f", c))


def runtime_text(seconds: Column) -> Column:
    """1.5s, 2m 3.0s, 1h 2m 3.0s."""
    hours, minutes = F.floor(seconds / 3600), F.floor((seconds % 3600) / 60)
    rest = F.format_string("%.1fs", seconds % 60)
    return (
        F.when(seconds < 60, F.format_string("%.1fs", seconds))
        .when(seconds < 3600, F.concat(F.floor(seconds / 60).cast("string"), F.lit("m "), rest))
        .otherwise(F.concat(hours.cast("string"), F.lit("h "), minutes.cast("string"), F.lit("m "), rest))
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from one ISO text to another; 0 where either is no time."""
    parse = lambda c: F.unix_micros(F.try_to_timestamp(c).cast("timestamp"))
    return F.coalesce((parse(end) - parse(start)) / 1e6, F.lit(0.0))


def file_stamp(ts: Column, millis: bool = False) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss_SSS" if millis else "yyyyMMdd_HHmmss")


def grade(score: Column, steps: list[tuple[float, str]] = GRADES, last: str = LAST_GRADE) -> Column:
    """The name of the first step a score reaches."""
    out = None
    for least, name in steps:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise(last)
