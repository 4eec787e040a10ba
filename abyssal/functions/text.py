"""String rules of the instrument logs: stripping, null tokens, numbers and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that mean "no value" (compared in upper case).
NULL_TOKENS = ("NA", "N/A", "NAN", "NULL", "")

_NUMBER = r"^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?|(?i:inf|infinity))$"
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?)?Z?$"


def _strip_any(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip(c: Column) -> Column:
    """Leading and trailing white space of any kind removed; text that begins and ends in visible ASCII is left without a search."""
    bare = F.substring(c, 1, 1).between("!", "~") & F.substring(c, -1, 1).between("!", "~")
    return F.when(bare, c).otherwise(_strip_any(c))


def without_bom(c: Column) -> Column:
    return F.regexp_replace(c, "^\ufeff", "")


def number(c: Column) -> Column:
    """Decimal number or null; never accepts the type suffixes Spark's own cast does."""
    s = strip(c)
    return F.when(s.rlike(_NUMBER), F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))


def nullable_number(c: Column) -> Column:
    """Number with the null tokens (`NULL_TOKENS`) read as null: none of them has the form of a number."""
    return number(c)


def whole_number(c: Column) -> Column:
    s = strip(c)
    return F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("bigint"))


def truncated(c: Column) -> Column:
    """Double to BIGINT towards zero; null where no BIGINT holds it."""
    return F.when(F.abs(c) < F.lit(9.2e18), c.cast("bigint"))


def iso_timestamp(c: Column) -> Column:
    """Zero-padded ISO date or time with an optional trailing Z, as naive UTC; anything else is null."""
    return _iso(strip(c))


def _iso(c: Column) -> Column:
    # The form is searched once. It holds one Z at most, and 26 characters hold a date, a time and six decimals: what follows is cut.
    return F.when(c.rlike(_ISO), F.substring(F.rtrim(c, F.lit("Z")), 1, 26).try_cast("timestamp_ntz"))


def iso_with_offset(c: Column) -> Column:
    """ISO time with or without an offset to naive UTC; blank or malformed is null."""
    s = F.regexp_replace(_strip_any(c), "Z$", "+00:00")
    offset = F.regexp_extract(s, r"[T ].*([+-]\d{2}:\d{2})$", 1)
    local = F.regexp_replace(s, r"([T ].*?)[+-]\d{2}:\d{2}$", "$1")
    minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 5, 2).try_cast("int")
    shift = F.when(offset == "", F.lit(0)).when(offset.startswith("-"), minutes).otherwise(-minutes)
    return F.timestamp_add("MINUTE", shift.cast("bigint"), _iso(_strip_any(local)))
