"""Number rules: the accepted spellings are Python's, the work is Spark's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import SPACE, strip

# Possessive groups: the engine repeats any other group by recursion, once per digit.
DIGITS = "[0-9]++(?:_[0-9]++)*+"
INTEGER = rf"^{SPACE}*[+-]?{DIGITS}{SPACE}*\z"
DECIMAL = (
    rf"^{SPACE}*[+-]?(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?{SPACE}*\z"
)
PLAIN = r"^[+-]?[0-9]++(?:\.[0-9]++)?+\z"  # as most cells are: nothing to take out before the cast
SHORT = r"^[0-9]{1,15}+\z"  # a whole number that a double holds exactly
SHORT_MINUTES = r"^[0-9]{1,15}+'?+\z"
SPECIAL = rf"(?i)^{SPACE}*[+-]?(?:inf|infinity|nan){SPACE}*\z"
MINUTES = rf"^{SPACE}*[0-9]+'{SPACE}*\z"


def _plain(value: Column) -> Column:
    return F.replace(strip(value), F.lit("_"), F.lit(""))


def _without(value: Column, mark: str) -> Column:
    return F.replace(value, F.lit(mark), F.lit(""))


def parse_float(value: Column) -> Column:
    """Double, or null where the text is no number. Java-only spellings (1d, 0x1p3) are none."""
    special = F.regexp_replace(strip(value), r"^[+-](?=[nN])", "")
    return (
        F.when(value.rlike(PLAIN), value.try_cast("double"))
        .when(value.rlike(DECIMAL), _plain(value).try_cast("double"))
        .when(value.rlike(SPECIAL), special.try_cast("double"))
    )


def parse_int(value: Column) -> Column:
    """Long, or null where the text is no whole number (``3.0`` is not one)."""
    return F.when(value.rlike(INTEGER), _plain(value).try_cast("bigint"))


def to_float(value: Column) -> Column:
    return parse_float(_without(value, ","))


def _short(value: Column, pattern: str, digits: Column) -> Column:
    """The start of a case: null stays null, and what most cells hold is cast without more ado."""
    return F.when(value.isNull(), F.lit(None).cast("bigint")).when(value.rlike(pattern), digits.try_cast("bigint"))


def to_int(value: Column) -> Column:
    """Through double, cut towards zero: ``3.7`` is 3.

    Not a number, infinite and out of range give null, as ``try_cast`` has it.
    """
    return _short(value, SHORT, value).otherwise(to_float(value).try_cast("bigint"))


def looks_like_minutes(value: Column) -> Column:
    return F.coalesce(value.rlike(MINUTES), F.lit(False))


def parse_minutes(value: Column) -> Column:
    bare = _without(value, "'")
    return _short(value, SHORT_MINUTES, bare).otherwise(to_float(bare).try_cast("bigint"))


def parse_stat(value: Column) -> Column:
    """A count cell: plain number or minute mark."""
    bare = _without(value, "'")
    return _short(value, SHORT_MINUTES, bare).otherwise(to_float(F.when(value.rlike(MINUTES), bare).otherwise(value)).try_cast("bigint"))
