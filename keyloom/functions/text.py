"""Text and identifier cleaning as built-in column expressions (no Python row functions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The characters that may wrap an address, the address pattern, and the texts a data
# frame leaves behind for a missing value.
MAIL_WRAPPERS = "<>\"'()[]"
MAIL_PATTERN = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\z"
MISSING_TEXTS = ("None", "nan", "NaT")

# The Thai block.
THAI_RANGE = ("\u0e00", "\u0e7f")

# The characters Unicode and pandas-style stripping take for blanks.
BLANK_CODE_POINTS = (
    *range(0x09, 0x0E),
    *range(0x1C, 0x21),
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)
BLANKS = "".join(map(chr, BLANK_CODE_POINTS))


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_unicode(c: ColumnOrName) -> Column:
    """Trim every Unicode blank on both sides (``trim`` alone removes spaces only)."""
    return F.btrim(col(c), F.lit(BLANKS))


def is_blank(c: ColumnOrName) -> Column:
    """True for NULL, '' and text of blanks only; never NULL itself."""
    c = col(c)
    return c.isNull() | ~c.cast("string").rlike(r"(?U)[^\s\x1c-\x1f]")


def blank_to_null(c: ColumnOrName) -> Column:
    """NULL for blank text, otherwise the value as it was (not trimmed)."""
    c = col(c)
    return F.when(F.trim(c) != "", c)


def scrub_missing(c: ColumnOrName, markers: Sequence[str] = MISSING_TEXTS) -> Column:
    """NULL for the texts that stand for a missing value."""
    c = col(c)
    return F.when(~c.isin(*markers), c)


def clean_value(c: ColumnOrName) -> Column:
    """The value as it is written on load: no-break space and tab to space, trimmed, blank to NULL."""
    spaced = F.translate(col(c).cast("string"), "\u00a0\t", "  ")
    return F.nullif(F.trim(spaced), F.lit(""))


def norm(c: ColumnOrName) -> Column:
    """The form in which two values are compared: cleaned, lower case, '' for NULL."""
    return F.lower(F.coalesce(clean_value(c), F.lit("")))


def clean_digits(c: ColumnOrName) -> Column:
    """A numeric identifier without blanks and zero-width spaces; NULL if anything but digits stays."""
    compact = F.regexp_replace(col(c).cast("string"), r"(?U)[\s\x1c-\x1f\x{200B}]", "")
    return F.nullif(F.regexp_extract(compact, r"^[0-9]+\z", 0), F.lit(""))


def clean_id(c: ColumnOrName) -> Column:
    """An identifier that went through a spreadsheet: stripped, without a trailing '.0'.

    NULL, '' and the missing-value texts all become NULL.
    """
    text = F.regexp_replace(strip_unicode(col(c).cast("string")), r"\.0\z", "")
    return F.when((text != "") & ~text.isin(*MISSING_TEXTS), text)


def clean_email(c: ColumnOrName) -> Column:
    """The first address of a mail field, without wrapping characters; NULL if it is none.

    The words for "no value" (none, null, nan) are no addresses, so the pattern covers them.
    """
    first = strip_unicode(col(c).cast("string"))
    for separator in (",", ";", " "):
        first = strip_unicode(F.substring_index(first, separator, 1))
    first = F.btrim(first, F.lit(MAIL_WRAPPERS))
    return F.nullif(F.regexp_extract(first, MAIL_PATTERN, 0), F.lit(""))


def has_script(c: ColumnOrName, script: tuple[str, str] = THAI_RANGE) -> Column:
    """True if any character lies in the code point range; false for NULL."""
    low, high = script
    return F.coalesce(col(c).rlike(f"[{low}-{high}]"), F.lit(False))


def script_or(c: ColumnOrName, other: ColumnOrName, script: tuple[str, str] = THAI_RANGE) -> Column:
    """``c`` where it is written in the script, else ``other``."""
    return F.when(has_script(c, script), col(c)).otherwise(col(other))


def upper_or(c: ColumnOrName, other: ColumnOrName) -> Column:
    """Upper-case trimmed ``c``; where that is NULL or blank, ``other`` in the same form."""
    c, other = col(c), col(other)
    return F.upper(F.trim(F.when(F.trim(c) != "", c).otherwise(other)))


def capitalize(c: ColumnOrName) -> Column:
    """First letter upper, the rest lower, over the whole text (``initcap`` works per word)."""
    c = col(c)
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def bullets(columns: Sequence[ColumnOrName], limit: int | None = None) -> Column:
    """Flatten multi-line bullet texts of several columns into one comma-separated text.

    Every line loses outer blanks and a leading "- "; empty lines and lone dashes go; the result is
    whole unless ``limit`` names the width of the column it is written to. NULL if nothing remains.
    """
    joined = F.concat_ws("\n", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns])
    # Splitting at the line feed is enough: the carriage return before it is an outer blank.
    lines = F.transform(F.split(joined, "\n"), strip_unicode)
    items = F.transform(
        lines, lambda x: F.when(x.startswith("- "), strip_unicode(F.substr(x, F.lit(3)))).otherwise(x)
    )
    kept = F.filter(items, lambda item: ~item.isin("", "-"))
    flat = F.array_join(kept, ", ")
    return F.nullif(flat if limit is None else F.left(flat, F.lit(limit)), F.lit(""))


# Fixed value: text keys that differ in case or in trailing blanks only are one key.
CASELESS = "UTF8_LCASE_RTRIM"


def collated(c: ColumnOrName, collation: str = CASELESS) -> Column:
    """Text that compares, groups and joins under a collation; its value stays as it is."""
    return F.collate(col(c).cast("string"), collation)


def collation_key(c: ColumnOrName) -> Column:
    """Equal for texts that are equal under ``CASELESS``: for hashes, which look at the bytes."""
    return F.rtrim(F.lower(col(c).cast("string")))
