"""Scalar helpers: Column to Column."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

GIB = 1024**3
GB = 1e9
MS_PER_MINUTE = 60_000.0
MS_PER_HOUR = 3_600_000.0


def filled(value: Column) -> Column:
    """null if the string is empty."""
    return F.nullif(value, F.lit(""))


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[filled(v) for v in values])


def text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def number(value: Column, default: float = 0) -> Column:
    return F.coalesce(value, F.lit(default))


@lru_cache(maxsize=1)
def blanks() -> str:
    """All characters that count as blank at the ends of a text."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


@lru_cache(maxsize=1)
def digits() -> tuple[str, str]:
    """The decimal digits of all scripts but the first, and what they stand for."""
    found = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(found), "".join(str(unicodedata.decimal(c)) for c in found)


def stripped(value: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.btrim(value, F.lit(blanks()))


#: Digits, single underscores between them allowed.
DIGITS = r"\d+(?:_\d+)*"
NUMBER = rf"^[+-]?(?:{DIGITS}\.?(?:{DIGITS})?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?$"
PLAIN = r"^[+-]?\d+(?:\.\d+)?$"


def parse_number(value: Column) -> Column:
    """The double that a text is, blanks around it aside; null if it is none.

    Digits of any script, with underscores between them, a point, an exponent; or a signed inf, infinity or nan in any case. Suffixes
    that a cast takes for a type (1d, 2f) make it no number.
    """
    in_ascii = value.rlike(r"^[\x00-\x7F]*$")
    own = F.when(in_ascii, F.btrim(value, F.lit(" \t\n\x0b\x0c\r"))).otherwise(stripped(value))  # the separators 1C to 1F count as blanks in other texts only
    ascii_ = F.when(in_ascii, own).otherwise(F.translate(own, *digits()))
    name = F.lower(ascii_)
    words = F.when(name.rlike(r"^\+?inf(?:inity)?$"), F.lit(float("inf"))).when(name.rlike(r"^-inf(?:inity)?$"), F.lit(float("-inf"))).when(name.rlike(r"^[+-]?nan$"), F.lit(float("nan")))
    full = F.when(ascii_.rlike(NUMBER), F.replace(ascii_, F.lit("_"), F.lit("")).try_cast("double")).otherwise(words)
    return F.when(value.rlike(PLAIN), value.try_cast("double")).otherwise(full)  # most are plain, and take one look


def safe_double(value: Column) -> Column:
    """The number in a string, 0.0 if there is none."""
    return F.coalesce(parse_number(value), F.lit(0.0))


def percent(value: Column) -> Column:
    """As safe_double, with percent signs behind the number allowed."""
    return F.when(value.rlike(PLAIN), value.try_cast("double")).otherwise(safe_double(F.rtrim(stripped(value), F.lit("%"))))


def rounded(value: Column, digits: int) -> Column:
    """Half to even of the number that the double is in binary, not of its shortest decimal form; null, infinite and NaN stay.

    value * 10^digits is taken with its rounding error, which two halves of each factor give exactly: only so a value just
    beside a tie is told from one on it.
    """
    x, scale = value.cast("double"), 10.0**digits
    product = x * scale
    floor = F.floor(product).cast("double")
    # only a product that lies on a tie needs its error: a function of a variable, short where rows don't need it
    tie = F.transform(F.array(x), lambda own: _of_tie(own, scale))[0]
    near = F.when(product - floor == 0.5, tie).otherwise(F.rint(product) + 0.0)  # no negative zero
    # the product may have been rounded up to a whole number: then it stands for one just below, and still rounds to it
    return F.when(F.abs(product) < 2.0**52, near / scale).otherwise(x)


def _of_tie(x: Column, scale: float) -> Column:
    """x * scale, whose double lies half way between two whole numbers, to the one that the exact product is nearer to, or the even one."""
    split = lambda c: (c * 134217729.0) - ((c * 134217729.0) - c)  # noqa: E731  the upper 26 bits
    high = split(scale)
    low, x_high = scale - high, split(x)
    x_low, product = x - x_high, x * scale
    error = ((x_high * high - product) + x_high * low + x_low * high) + x_low * low
    floor = F.floor(product).cast("double")
    above = (error > 0) | ((error == 0) & (floor % 2 != 0))
    return floor + F.when(above, 1.0).otherwise(0.0)


# ISO 8601 as far as it names a day: a calendar or week date, extended or basic, and, after any one character, a time with or without zone.
_DAY = r"(?:(\d{4})-(\d\d)-(\d\d)|(\d{4})(\d\d)(\d\d)|(\d{4})-W(\d\d)(?:-(\d)(?!\d))?|(\d{4})W(\d\d)(?:(\d)(?=(?!\d)|\d(?:\d\d)*(?!\d))|(?!\d(?!\d)|\d\d(?:\d\d)*(?!\d))))"
_CLOCK = r"(?:(\d\d)(?::(\d\d)(?::(\d\d))?)?(?:[.,](\d+))?|(\d\d)(\d\d)(\d\d)?(?:[.,](\d+))?)"
STAMP = rf"(?s)^{_DAY}(?:.{_CLOCK}(?:([+-]){_CLOCK})?)?$"
#: What the groups of STAMP stand for: the same field of either form in one place.
FIELDS = "$1$4,$2$5,$3$6,$7$10,$8$11,$9$12,$13$17,$14$18,$15$19,$16$20,$21,$22$26,$23$27,$24$28,$25$29"
COMMON = r"^(?!0000)\d{4}-\d\d-\d\d[T ]\d\d:[0-5]\d:[0-5]\d(?:\.\d{1,6})?"
DAY_MICROS = 86_400_000_000


def _week_day(year: Column, week: Column, day: Column) -> Column:
    """Days since 1970 of a day in an ISO week; null if the year has no such week."""
    monday = lambda y: F.unix_date(F.make_date(y, F.lit(1), F.lit(4))) - F.weekday(F.make_date(y, F.lit(1), F.lit(4)))  # noqa: E731  of the year's first week
    at = monday(year) + (week - 1) * 7
    return F.when(week.between(1, 53) & day.between(1, 7) & (at < monday(year + 1)), at + day - 1)


def _clock(hour: Column, minute: Column, second: Column, fraction: Column) -> Column:
    """Microseconds of a time of day; digits beyond them are cut."""
    return ((number(hour) * 60 + number(minute)) * 60 + number(second)).cast("long") * 1_000_000 + F.rpad(F.substring(text(fraction), 1, 6), 6, "0").cast("long")


def parse_timestamp(value: Column) -> Column:
    """ISO 8601 with a whole date, extended or basic, of a calendar or of weeks; without zone it is UTC. null if it is anything else.

    Neither a time alone nor a year or month alone is a stamp, whatever a cast would make of it; a fraction may follow any part of the time
    and is one of a second. What only slips of a parser take (a stray character before the zone, a fraction without point) is null too.
    """
    # most stamps are of one form, and take one look; others are left to a function of a variable, which adds next to nothing to the generated code
    other = let(value, _of_other_form)
    return F.when(value.rlike(COMMON + "Z$"), value.try_cast("timestamp")).when(value.rlike(COMMON + "$"), F.concat(value, F.lit("Z")).try_cast("timestamp")).otherwise(other)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then of a variable that holds the value, so that the plan names it and doesn't repeat how it is found."""
    return F.transform(F.array(value), then)[0]


def _of_other_form(value: Column) -> Column:
    own = F.when(value.endswith("Z"), F.concat(value.substr(F.lit(1), F.length(value) - 1), F.lit("+00:00"))).otherwise(value)
    # a text that is no stamp stays as it is: one look tells, as none has the fourteen commas of its fields
    read = lambda text: let(F.regexp_replace(text, STAMP, FIELDS), lambda found: F.when(found != text, let(F.split(found, ","), lambda fields: F.when(F.size(fields) == 15, _instant(fields)))))
    return let(own, read)


def _instant(fields: Column) -> Column:
    """The timestamp of the fields of a stamp."""
    part = [F.nullif(fields[i], F.lit("")).try_cast("int") for i in range(15)]
    hour, minute, second = part[6:9]
    calendar = F.unix_date(F.concat_ws("-", fields[0], fields[1], fields[2]).try_cast("date"))
    by_week = let(part[3], lambda year: F.when(year >= 1, _week_day(year, part[4], F.coalesce(part[5], F.lit(1)))))
    days = F.when(fields[0] != "", F.when(part[0] >= 1, calendar)).otherwise(by_week)
    zone = F.when(fields[10] == "", F.lit(0).cast("long")).otherwise(_clock(part[11], part[12], part[13], fields[14]))
    valid = (number(hour) < 24) & (number(minute) < 60) & (number(second) < 60)
    local = lambda day: day.cast("long") * DAY_MICROS + _clock(hour, minute, second, fields[9])
    instant = lambda day: let(zone, lambda z: F.when(z < DAY_MICROS, F.timestamp_micros(local(day) - F.when(fields[10] == "-", -z).otherwise(z))))
    return F.when(valid, let(days, lambda day: F.when(day.between(-719162, 2932896), instant(day))))


def duration_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds from start to end, both strings, of the seconds as a double; 0 if one is missing or the end comes first."""
    return gap_ms(parse_timestamp(start), parse_timestamp(end))


def gap_ms(start: Column, end: Column) -> Column:
    """duration_ms of stamps that are read already."""
    gap = F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1e6 * 1000)
    return F.greatest(F.coalesce(gap, F.lit(0)), F.lit(0)).cast("long")


def minutes(ms: Column) -> Column:
    return number(ms).cast("double") / MS_PER_MINUTE


def hours(ms: Column) -> Column:
    return number(ms).cast("double") / MS_PER_HOUR


def last_part(value: Column, separator: str) -> Column:
    """What follows the last separator."""
    return F.element_at(F.split(value, separator), -1)


def normalized_hash(value: Column) -> Column:
    """A task hash without slashes, its first 8 characters."""
    return F.substring(F.replace(text(value), F.lit("/"), F.lit("")), 1, 8)


def title_case(value: Column) -> Column:
    """A letter that follows no letter in upper case, all others in lower case."""
    parts = F.regexp_extract_all(F.lower(value), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(parts, F.initcap), "")


def positive_gap(upper: Column, lower: Column) -> Column:
    """upper - lower, 0 at least; null if either is null."""
    return F.when(upper.isNotNull() & lower.isNotNull(), F.greatest(upper - lower, F.lit(0.0)))


def booked_hours(capacity: Column, efficiency: Column, requested: Column) -> Column:
    """The share of the capacity in use by its scheduler, never more than it; without that, what was requested."""
    share = F.least(capacity, F.greatest(F.lit(0.0), capacity * efficiency / 100.0))
    return F.when(capacity.isNotNull() & efficiency.isNotNull(), share).when(requested.isNotNull(), F.greatest(requested, F.lit(0.0)))


def of_capacity(used: Column, capacity: Column) -> Column:
    """Percent of a positive capacity, else null."""
    return F.when(capacity > 0, used / capacity * 100.0)
