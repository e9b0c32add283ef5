"""Column expressions shared by the plans. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MICROSECONDS_AN_HOUR = 3_600_000_000


def order_value(qty="qty", unit_price="unit_price") -> Column:
    """Whole-number money: bigint times bigint, so sums are exact in any order."""
    return F.col(qty) * F.col(unit_price)


def stockout_flag(on_hand="on_hand_qty", qty="qty") -> Column:
    """Less on hand than ordered; null when either is unknown."""
    return F.col(on_hand) < F.col(qty)


def is_delivered(status="delivery_status") -> Column:
    return F.lower(F.col(status)) == "delivered"


def ratio(part: Column, whole: Column) -> Column:
    """Exact whole-number sums divided once, null when there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def epoch_seconds(ts: Column) -> Column:
    """Wall-clock seconds since 1970 of a zone-less time, whatever the session time zone."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))


def microseconds_between(start: str, end: str) -> Column:
    """Whole microseconds from start to end (zone-less times), exact in any session time zone."""

    def part(name: str) -> Column:
        return F.date_part(F.lit(name), F.col(end) - F.col(start))

    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("bigint")


def hours_between(start: str, end: str, places: int = 6) -> Column:
    return F.round(microseconds_between(start, end).cast("double") / MICROSECONDS_AN_HOUR, places)


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Adds the load time. Volatile, so it is put on when a table is written, not before."""
    return df.withColumn(name, F.current_timestamp())
