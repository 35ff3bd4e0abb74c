"""Code maps, bands and the fill rules of the enrichment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions.text import ColumnOrName, col, is_blank


def code_map(c: ColumnOrName, labels: Mapping[str, object], default=None, first: Column | None = None) -> Column:
    """A code's label, ``default`` for any other code.

    ``first`` is a ready ``F.when`` chain whose cases beat the map.
    """
    c = col(c)
    chain = first
    for code, label in labels.items():
        chain = F.when(c == code, label) if chain is None else chain.when(c == code, label)
    return chain.otherwise(F.lit(default))


def band(
    c: ColumnOrName,
    ranges: Sequence[tuple[float | None, float, int]],
    above: tuple[float, int] | None = None,
    default: int = 1,
) -> Column:
    """The label of the closed range (low, high, label) that holds the value; a low of None is open.

    ``above`` is (bound, label) for all values greater than the bound. Values between ranges and NULL
    get the default.
    """
    c = col(c)
    cases = [((c <= high) if low is None else c.between(low, high), label) for low, high, label in ranges]
    if above:
        cases.append((c > above[0], above[1]))
    chain = F.when(*cases[0])
    for test, label in cases[1:]:
        chain = chain.when(test, label)
    return chain.otherwise(F.lit(default))


def fill_if_blank(df: DataFrame, target: str, value: ColumnOrName) -> DataFrame:
    """Give ``target`` the value where it is blank; add the column if the frame has none."""
    value = col(value)
    if target not in df.columns:
        return df.withColumn(target, value)
    return df.withColumn(target, F.when(is_blank(target), value).otherwise(F.col(target)))


def resolve_option(base: ColumnOrName, option: ColumnOrName) -> Column:
    """The free-text option where the base answer is blank or "other" and the option is filled."""
    base, option = col(base), col(option)
    asks = is_blank(base) | (F.lower(F.trim(base)) == "other")
    return F.when(asks & ~is_blank(option), option).otherwise(base)


def fill_null_from_sibling(df: DataFrame, target: str, sibling: str) -> DataFrame:
    """Fill NULLs (not blanks) of ``target`` from ``sibling`` and drop the sibling.

    Only if the frame has both columns; otherwise it is returned as it is.
    """
    if target not in df.columns or sibling not in df.columns:
        return df
    return df.withColumn(target, F.coalesce(F.col(target), F.col(sibling))).drop(sibling)


def any_of(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def all_of(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def fingerprint(columns: Sequence[ColumnOrName]) -> Column:
    """64 bits over the row's JSON text: unequal fingerprints prove a change, equal ones only suggest none."""
    return F.xxhash64(F.to_json(F.struct(*[col(c) for c in columns]), {"ignoreNullFields": "false"}))


def money(c: ColumnOrName) -> Column:
    """An amount as an exact decimal, so that sums do not depend on the order of rows."""
    return col(c).cast("decimal(18,2)")


def ratio(part: ColumnOrName, whole: ColumnOrName, digits: int = 4) -> Column:
    """Part of whole, rounded; 0 where the whole is 0."""
    whole = col(whole)
    return F.round(F.coalesce(col(part) / F.nullif(whole, F.lit(0)), F.lit(0.0)), digits)


def percent_text(share: ColumnOrName) -> Column:
    return F.format_string("%.1f%%", col(share) * F.lit(100.0))
