"""Monthly usage rollup with fiscal periods and page costs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions.dates import FISCAL_START_MONTH
from keyloom.session import broadcast_limit, estimated_bytes

# Price per colour page and per grayscale page.
COLOR_PRICE = "4.82"
GRAY_PRICE = "0.48"


def price(text: str) -> Column:
    return F.lit(text).cast("decimal(3,2)")


def monthly_usage(
    log: DataFrame,
    users: DataFrame,
    user_key: str,
    log_keys: Sequence[str],
    user_keys: Sequence[str],
    color: str,
    total: str,
    day: str,
) -> DataFrame:
    """Pages and costs per user attributes, log attributes and month.

    ``log`` and ``users`` share the column ``user_key``; users are unique on it. If the users fit a
    broadcast, the log meets them unshuffled and is summed once. Otherwise it is summed per user and
    month before the join, so a user with a third of the log arrives as one row per month; the sums have the
    same types either way. A row where
    either page count is NULL adds nothing to the total of both.
    """
    year, month = "usage_calendar_year", "usage_calendar_month"
    sums = ("_color", "_gray", "_both")
    gray = F.col(total) - F.col(color)
    dated = log.select(
        user_key,
        *log_keys,
        F.year(day).alias(year),
        F.month(day).alias(month),
        F.col(color).alias("_color"),
        gray.alias("_gray"),
        (F.col(color) + gray).alias("_both"),
    )
    users = users.select(user_key, *user_keys)
    kind = dict(dated.agg(*[F.sum(c).alias(c) for c in sums]).dtypes)  # of one sum, also where a sum of sums is taken
    if estimated_bytes(users) > broadcast_limit(log.sparkSession):
        dated = dated.groupBy(user_key, *log_keys, year, month).agg(*[F.sum(c).alias(c) for c in sums])
    # Either the users are broadcast or no user has more rows than months and log keys: there is no hot key to look for.
    named = dated.join(users, user_key, "inner")
    pages = named.groupBy(*user_keys, *log_keys, year, month).agg(
        F.sum("_color").cast(kind["_color"]).alias("total_color_pages"),
        F.sum("_gray").cast(kind["_gray"]).alias("total_grayscale_pages"),
        F.sum("_both").cast(kind["_both"]).alias("total_pages"),
    )
    color_cost = F.col("total_color_pages") * price(COLOR_PRICE)
    gray_cost = F.col("total_grayscale_pages") * price(GRAY_PRICE)
    in_new_year = F.col(month) >= FISCAL_START_MONTH
    return pages.select(
        *user_keys,
        *log_keys,
        "total_color_pages",
        "total_grayscale_pages",
        "total_pages",
        color_cost.alias("total_cost_color_pages"),
        gray_cost.alias("total_cost_grayscale_pages"),
        (color_cost + gray_cost).alias("total_cost_pages"),
        year,
        month,
        (F.col(year) + in_new_year.cast("int")).alias("usage_budget_year"),
        (F.pmod(F.col(month) - FISCAL_START_MONTH, F.lit(12)) + 1).alias("usage_budget_month_order"),
    )


def closed_periods(usage: DataFrame, year: int, month: int) -> DataFrame:
    """Only months before the given one: an insert-only load never corrects a month loaded too early."""
    return usage.filter(F.col("usage_calendar_year") * 12 + F.col("usage_calendar_month") < year * 12 + month)
