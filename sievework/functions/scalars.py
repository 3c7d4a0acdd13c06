"""Text to dates, times and numbers. Unreadable text becomes NULL, also under ANSI."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats the feeds use.
DAY = "dd/MM/yyyy"
DAY_MINUTE = "dd/MM/yyyy HH:mm"
DAY_SECOND = "dd/MM/yyyy HH:mm:ss"
WHOLE_NUMBER = r"^-?\d+$"
DAY_MINUTE_SHAPE = r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$"


def plausible(col: Column, fmt: str) -> Column:
    """A condition every readable text meets: right length, separators in place.

    A failed parse costs an exception, so hopeless text should not get that far. Only
    fixed-width formats are guarded; a year may have more digits than four.
    """
    if not re.fullmatch(r"(?:dd|MM|yyyy|HH|mm|ss|[ /:.-])+", fmt):
        return col.isNotNull()
    return col.like(re.sub(r"[dMHms]", "_", fmt).replace("yyyy", "____%"))


def moment(day: Column, time: Column, fmt: str = DAY_SECOND) -> Column:
    """Timestamp from a date text and a time text; NULL unless both are there and valid."""
    return timestamp_of(F.concat_ws(" ", day, time), fmt)


def timestamp_of(col: Column, fmt: str | None = DAY_MINUTE) -> Column:
    """Timestamp from one text column; without a format, from ISO text or a native value."""
    if fmt is None:
        return col.try_cast("timestamp")
    return F.when(plausible(col, fmt), F.try_to_timestamp(col, F.lit(fmt)))


def date_of(col: Column, fmt: str = DAY) -> Column:
    return F.when(plausible(col, fmt), F.try_to_date(col, fmt))


def whole(col: Column) -> Column:
    return col.try_cast("int")


def money(col: Column, precision: int = 12, scale: int = 2) -> Column:
    return col.try_cast(f"decimal({precision},{scale})")


def money_or_zero(col: Column, precision: int = 10, scale: int = 2) -> Column:
    """Unreadable or missing money counts as zero; the zero is typed, so the column stays decimal."""
    return F.coalesce(money(col, precision, scale), F.lit(0).cast(f"decimal({precision},{scale})"))


def load_time(run_at: dt.datetime) -> Column:
    """One literal per run: every target and every retry carries the same load time."""
    return F.lit(run_at).cast("timestamp")


def exact_mean(total: Column, count: Column) -> Column:
    """Mean of a sum held in cents, rounded once to cents, half away from zero.

    ``avg`` on decimals keeps four extra digits and rounds twice; whole-number division
    cannot.
    """
    cents = (F.abs(total).cast("decimal(30,2)") * F.lit(100)).cast("decimal(34,0)")
    n = count.cast("decimal(20,0)")
    up = F.call_function("div", cents * F.lit(2) + n, n * F.lit(2)).cast("decimal(20,0)")
    sign = F.when(total < 0, F.lit(-1)).otherwise(F.lit(1))
    return F.when(count > 0, (sign * up / F.lit(100)).cast("decimal(18,2)"))
