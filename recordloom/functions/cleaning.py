"""Cleaning rules as column expressions; every one runs inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode white space, the characters that text trimming removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Canonical borough labels and the spellings each one replaces.
BOROUGH_SPELLINGS = {
    "Manhattan": ("MANHATTAN", "NEW YORK COUNTY"),
    "Bronx": ("BRONX", "THE BRONX"),
    "Brooklyn": ("BROOKLYN", "KINGS COUNTY"),
    "Queens": ("QUEENS", "QUEEN", "QUEENS COUNTY"),
    "Staten Island": ("STATEN ISLAND", "RICHMOND COUNTY"),
}

# Markers for missing members.
CITYWIDE = "UNKNOWN or CITYWIDE"
UNKNOWN = "UNKNOWN"
MISSING_ZIP_TOKENS = ("N/A", "NA")
ANONYMOUS_ZIP = "Anonymous"
NO_ZIP = "99999"

# A bare DECIMAL is (10,0) here and would drop every decimal place of a coordinate.
NUMERIC = T.DecimalType(38, 9)


def trim_all(c: Column) -> Column:
    """Trim every kind of white space; the plain ``trim`` only strips spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def normalize_token(c: Column) -> Column:
    """Upper-case trimmed text, the form in which spellings and statuses are compared."""
    return F.upper(trim_all(c.cast("string")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_all(c.cast("string")), F.lit(""))


def clean_zip(c: Column) -> Column:
    """Keep postal codes of a known shape, as text; drop the rest.

    Shapes are judged on the text as given (untrimmed): any 5 or 9 characters, or
    ten that start like ``12345-6789``. The anonymous marker gets one spelling.
    """
    text = c.cast("string")
    token = normalize_token(c)
    size = F.length(text)
    anonymous = F.lit(ANONYMOUS_ZIP.upper())
    well_shaped = size.isin(5, 9) | ((size == 10) & text.rlike(r"^\d{5}-\d{4}"))
    special = token.isin(*MISSING_ZIP_TOKENS, anonymous)
    return F.when(special, F.when(token == anonymous, F.lit(ANONYMOUS_ZIP))).when(well_shaped, text)


def clean_borough(c: Column, default: str | None = None, spellings: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Replace known spellings by their canonical label; anything else becomes ``default``.

    One look into a constant map, so the text is trimmed and upper-cased only once.
    """
    labels = {spelling: label for label, group in (spellings or BOROUGH_SPELLINGS).items() for spelling in group}
    known = F.create_map(*[F.lit(text) for pair in labels.items() for text in pair])
    found = F.try_element_at(known, normalize_token(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def to_numeric(c: Column, strict: bool = True) -> Column:
    return c.cast(NUMERIC) if strict else c.try_cast(NUMERIC)


def zero_to_null(c: Column, strict: bool = True) -> Column:
    """A coordinate of exactly zero means it was not recorded."""
    return F.nullif(to_numeric(c, strict), F.lit(0).cast(NUMERIC))


def to_timestamp(c: Column, strict: bool = True) -> Column:
    return c.cast("timestamp") if strict else c.try_cast("timestamp")


def pad_clock(c: Column) -> Column:
    """``9:05`` becomes ``09:05``; ``\\z`` because ``$`` would also accept a trailing newline."""
    return F.when(c.rlike(r"^\d:\d{2}\z"), F.concat(F.lit("0"), c)).otherwise(c)


def date_and_clock(date: Column, clock: Column, strict: bool = True) -> Column:
    """One timestamp from a day and a clock text; without a clock there is no timestamp."""
    pattern = "yyyy-MM-dd HH:mm"
    day = date.cast("date") if strict else date.try_cast("date")
    text = F.concat(day.cast("string"), F.lit(" "), pad_clock(clock))
    return F.to_timestamp(text, pattern) if strict else F.try_to_timestamp(text, F.lit(pattern))


def known_borough(c: Column, null_is_unknown: bool = True) -> Column:
    """The borough as a dimension member: the city-wide label is the unknown member."""
    member = F.when(c == CITYWIDE, F.lit(UNKNOWN)).otherwise(c)
    return F.coalesce(member, F.lit(UNKNOWN)) if null_is_unknown else member


def known_zip(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNKNOWN))


def fill_zip(own: Column, derived: Column) -> Column:
    """The record's own code, else the derived one; the no-code sentinel is then dropped."""
    return F.nullif(F.coalesce(own, derived), F.lit(NO_ZIP))


def fill_borough(own: Column, derived: Column) -> Column:
    return F.coalesce(own, derived, F.lit(CITYWIDE))
