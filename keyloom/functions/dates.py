"""Calendar expressions: fiscal periods, Buddhist-era text, lenient parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyloom.functions.text import ColumnOrName, col

# The fiscal year starts in October; the Buddhist era is 543 years ahead; local time is
# UTC+7.
FISCAL_START_MONTH = 10
BUDDHIST_OFFSET = 543
LOCAL_OFFSET_HOURS = 7
LOCAL_ZONE = "Asia/Bangkok"


def fiscal_year(date: ColumnOrName, start_month: int = FISCAL_START_MONTH) -> Column:
    """The year in which the fiscal year of ``date`` ends."""
    date = col(date)
    return F.year(date) + (F.month(date) >= start_month).cast("int")


def fiscal_month_order(date: ColumnOrName, start_month: int = FISCAL_START_MONTH) -> Column:
    """1 for the first month of the fiscal year up to 12 for the last."""
    return F.pmod(F.month(col(date)) - start_month, F.lit(12)) + 1


def local_date_text(ts: ColumnOrName, calendar: str = "buddhist") -> Column:
    """``dd/MM/yyyy`` of a UTC timestamp in local time, with a Buddhist or an ISO year."""
    local = col(ts) + F.expr(f"interval {LOCAL_OFFSET_HOURS} hours")
    offset = {"buddhist": BUDDHIST_OFFSET, "iso": 0}[calendar]
    return F.concat(F.date_format(local, "dd/MM/"), (F.year(local) + offset).cast("string"))


def lenient_timestamp(c: ColumnOrName, formats: Sequence[str] = ()) -> Column:
    """The text as a timestamp, NULL where it is none; ``formats`` are tried in order first."""
    c = col(c)
    tries = [F.try_to_timestamp(c, F.lit(f)) for f in formats] + [F.try_to_timestamp(c)]
    return F.coalesce(*tries)


def ingestion_date(run_ts: ColumnOrName, zone: str = LOCAL_ZONE) -> Column:
    """Midnight of the run's local day, from the run's UTC timestamp."""
    return F.to_date(F.from_utc_timestamp(col(run_ts), zone)).cast("timestamp")
