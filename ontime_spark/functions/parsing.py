"""Reading the text of one field. Nothing here throws: unreadable text becomes null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters up to the blank count as padding, control characters included.
PADDING = "".join(map(chr, range(0x21)))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once however often it is used.

    The expression stays out of the generated code, which suits long ones that few rows need.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_line(line: Column) -> Column:
    """Fields of one CSV line: split on commas outside quotes, quotes deleted.

    A comma separates when an even number of quotes follows it. Cutting the line at the quotes
    makes that a property of the whole piece between two quotes, so one pass is enough. A line
    never holds a line feed, which makes it a safe separator.
    """

    def mark(pieces: Column) -> Column:
        n = F.size(pieces)
        comma, feed = F.lit(","), F.lit("\n")
        return F.transform(
            pieces,
            lambda piece, i: F.when((n - i) % 2 == 1, F.replace(piece, comma, feed)).otherwise(piece),
        )

    return F.split(F.array_join(bind(F.split(line, '"', -1), mark), ""), "\n", -1)


def clean_text(c: Column) -> Column:
    """The text without padding. Its ends are looked at first: trimming many characters is slow, and rarely due."""
    tight = (F.ascii(c) > 32) & (F.ascii(F.right(c, F.lit(1))) > 32)
    return F.when(tight, c).otherwise(F.btrim(c, F.lit(PADDING)))


def optional_text(c: Column) -> Column:
    return F.nullif(clean_text(c), F.lit(""))


def parse_double(c: Column) -> Column:
    """Decimal text to double; empty or unreadable text is null.

    Spark also reads ``nan`` and ``inf`` in any case; only the spellings ``NaN`` and ``Infinity``
    are taken here. The spelling is looked at only when the value is not finite.
    """
    # Empty text is the common case and must not reach the cast, which fails by an exception.
    text = optional_text(c)
    value = text.try_cast("double")
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    loose = text.rlike("(?i)^[+-]?(nan|inf|infinity)$") & ~text.rlike("^[+-]?(NaN|Infinity)$")
    return F.when(odd & loose, F.lit(None).cast("double")).otherwise(value)


def parse_int(c: Column, strict: bool = True) -> Column:
    """Whole-number text to int; empty or unreadable text is null.

    With ``strict`` a decimal point makes the text unreadable. Without it ``1.00`` reads as 1,
    which is how the on-time file writes its 15-minute flags.
    """
    text = optional_text(c)
    if strict:
        return F.when(~F.contains(text, F.lit(".")), text.try_cast("int"))
    return text.try_cast("double").try_cast("int")


def parse_flag(c: Column) -> Column:
    return clean_text(c).isin("1.00", "1")


# Fixed value: how the file writes a date.
DATE_FORMAT = "M/d/yyyy hh:mm:ss a"


def parse_calendar_date(c: Column) -> Column:
    """Text in the file's date format to a date, for days the calendar has. Else null."""
    text = clean_text(c)
    upper = text.endswith("AM") | text.endswith("PM")  # the format alone takes any case
    return F.when(upper, F.to_date(F.try_to_timestamp(text, F.lit(DATE_FORMAT))))


def parse_flight_date(c: Column) -> Column:
    """As :func:`parse_calendar_date`, but a day up to 31 that its month lacks is its last day."""
    shape = r"^\d{1,9}/\d{1,9}/\d{4} (0[1-9]|1[0-2]):[0-5]\d:[0-5]\d [AP]M$"

    def from_numbers(n: Column) -> Column:
        month, day, year = (F.get(n, F.lit(i)) for i in range(3))
        possible = month.between(1, 12) & day.between(1, 31) & (year >= 1)
        first = F.make_date(F.when(possible, year), F.when(possible, month), F.lit(1))
        return bind(first, lambda d: F.least(F.date_add(d, day - 1), F.last_day(d)))

    def from_text(text: Column) -> Column:
        parts = F.split(F.substring_index(text, " ", 1), "/")
        numbers = F.transform(parts, lambda part: part.try_cast("int"))
        return F.when(text.rlike(shape), bind(numbers, from_numbers))

    return bind(clean_text(c), from_text)
