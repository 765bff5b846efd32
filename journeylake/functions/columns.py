"""Null, parsing and arithmetic rules, each decided once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ..fixed_values import TRUTHY_FLAGS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def truthy(c: Column | str) -> Column:
    """Set flag in any accepted spelling; null and anything else are not set."""
    return F.coalesce(F.upper(F.trim(col(c))).isin(*TRUTHY_FLAGS), F.lit(False))


def is_true_text(c: Column | str) -> Column:
    """Exactly the word TRUE; null stays null."""
    return F.upper(F.trim(col(c))) == "TRUE"


# One expression rearranges every accepted shape to ISO order and reads the text once, so plans
# stay small where a date is used in filters and projections alike. Formatted parsing would raise
# and catch an exception inside Spark for every row in another form; a bare cast would accept a
# year alone and ignore what follows a date. The month table stands before the text, so that a
# back-reference turns a month's name into its number, and text of any other shape never casts.
_MONTHS = "jan01feb02mar03apr04may05jun06jul07aug08sep09oct10nov11dec12|"
_NUMBERED = r"(\d{4})-(\d{1,2})-(\d{1,2})|(\d\d)-(\d\d)-(\d{4})|(\d{1,2})/(\d{1,2})/(\d{4})"
_NAMED = r"(?:[a-z]{3}\d\d)*?(?<month>[a-z]{3})(\d\d)[a-z0-9]*\|(\d{1,2})-\k<month>-(\d{4})"
_CLOCK = r"(\d{1,2}:\d\d(?::\d\d(?:\.\d{1,9})?)?)(?: ?[ap]m)?(?: ?(?:z|utc|[+-]\d\d(?::?\d\d)?))?"
_SHAPES = rf"(?i)^(?:[a-z0-9]+\|(?:{_NUMBERED})|{_NAMED})(?:[ t]{_CLOCK})?$"
_DATE = "$1$6$9$13-$2$5$7$11-$3$4$8$12"


def _iso(c: Column | str, form: str) -> Column:
    return F.regexp_replace(F.concat(F.lit(_MONTHS), F.trim(col(c))), _SHAPES, form)


def lead_date(c: Column | str) -> Column:
    """The date of ISO, day-first, US or named-month text, with or without a time and an offset;
    null for any other shape and for days that don't exist."""
    return _iso(c, _DATE).try_cast("date")


def lead_timestamp(c: Column | str) -> Column:
    """Time text in the same forms, a twelve-hour clock included; a date alone is its midnight.
    An offset or ``Z`` is read and dropped: the result is the clock time that the text shows."""
    shown = F.trim(_iso(c, f"{_DATE} $14")).try_cast("timestamp_ntz")
    late = col(c).rlike(r"(?i)[ t](?:0?\d|1[01]):[^a-z]*pm")
    early = col(c).rlike(r"(?i)[ t]12:[^a-z]*am")
    return shown + F.make_dt_interval(hours=F.when(late, 12).when(early, -12).otherwise(0))


def event_timestamp(c: Column | str) -> Column:
    return lead_timestamp(c)


def rounded_int(c: Column | str) -> Column:
    """Number text to integer, rounding fractions; null when not a number."""
    return F.round(col(c).try_cast("double")).try_cast("int")


def date_in(c: Column | str, start: str, end: str) -> Column:
    """Inclusive range on a DATE column; a bare comparison, so it reaches the scan."""
    return col(c).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def day_in(c: Column | str, start: str, end: str) -> Column:
    """Inclusive day range on a TIMESTAMP column, written as a half-open range on the
    bare column so that the whole last day counts and the predicate is pushed down."""
    c = col(c)
    return (c >= F.lit(start).cast("timestamp_ntz")) & (
        c < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    )


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an integer."""
    c = col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def ratio(numerator: Column | str, denominator: Column | str, scale: float = 100.0) -> Column:
    """Double division that is null on a zero or null denominator."""
    return F.try_divide(col(numerator).cast("double") * F.lit(scale), col(denominator).cast("double"))


def pct(numerator: Column | str, denominator: Column | str, digits: int) -> Column:
    return F.round(ratio(numerator, denominator), digits)


def count_when(condition: Column) -> Column:
    return F.count_if(condition)


def event_counts(event_type: Column | str = "event_type", **names: str) -> list[Column]:
    """One conditional count per ``alias=EVENT_TYPE``."""
    return [F.count_if(col(event_type) == value).alias(name) for name, value in names.items()]


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def contains_folded(c: Column | str, text: str) -> Column:
    """Case-insensitive contains; ``text`` is data, never spliced into SQL."""
    return F.upper(col(c)).contains(text.upper())


def equals_folded(c: Column | str, text: str) -> Column:
    return F.upper(col(c)) == text.upper()
