"""Column expressions that turn one CSV line into typed bar columns.

Everything is a built-in expression, so parsing stays inside whole-stage codegen
and the results do not depend on the session's ANSI or time zone settings.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

from tickloom.plans.methods import check_zone, method_of

# The first column name of a valid response header.
HEADER_NAMES = ("timestamp", "time")

# Blanks around a token are all characters up to and including the space.
_BLANK = r"[\x00-\x20]"
_BLANKS = "".join(chr(c) for c in range(0x21))
_HEADER_START = rf"({'|'.join(HEADER_NAMES)}){_BLANK}*(,|$)"
_HEADER_LINE = rf"^{_BLANK}*{_HEADER_START}"
_DATA_LINE = rf"^{_BLANK}*(?!{_HEADER_START})[^\x00-\x20]"

# The two datetime formats.
_DATE = r"^\d{4}-\d{2}-\d{2}"
_DATE_TIME = rf"{_DATE} ([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"

# The cast reads these spellings as non-finite; only exact ones count as numbers.
_NON_FINITE_WORD = rf"(?i)^{_BLANK}*[+-]?(inf|infinity|nan){_BLANK}*$"
_EXACT_NON_FINITE = rf"^{_BLANK}*[+-]?(Infinity|NaN){_BLANK}*$"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def is_filled(line: Column) -> Column:
    """True when the line has any character but blanks."""
    return F.coalesce(line.rlike(r"[^\x00-\x20]"), F.lit(False))


def is_header(line: Column) -> Column:
    return F.coalesce(line.rlike(_HEADER_LINE), F.lit(False))


def is_data(line: Column) -> Column:
    """True when the line is neither blank nor a header."""
    return F.coalesce(line.rlike(_DATA_LINE), F.lit(False))


def tokens(line: Column) -> Column:
    return F.split(line, ",", -1)


def token(parts: Column, position: int) -> Column:
    """The token as it stands, NULL when the line is too short."""
    return F.get(parts, F.lit(position))


def epoch_millis(text: Column, *, intraday: bool, zone: str) -> Column:
    """Epoch milliseconds of a local date or date-time in ``zone``; NULL if malformed.

    Date methods read the first ten characters, as some sources put a date-time there.
    """
    check_zone(zone)
    pattern = _DATE_TIME if intraday else _DATE
    # Trimming is by far the dearest step, so only padded tokens pay for it.
    text = F.when(text.rlike(pattern), text).otherwise(trimmed(text))
    day = F.unix_date(F.substring(text, 1, 10).try_cast("date")).cast("bigint")
    millis = day * 86_400_000
    if intraday:
        for start, unit in ((12, 3_600_000), (15, 60_000), (18, 1000)):
            millis = millis + F.substring(text, start, 2).try_cast("bigint") * unit
    if zone != "UTC":
        millis = F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(millis), zone))
    return F.when(text.rlike(pattern), millis)


# By how many minutes clocks go back.
_BACK = (30, 60, 120)


def second_millis(millis: Column, zone: str) -> Column:
    """The later instant with the same local time in ``zone``; NULL unless a clock change repeats it after ``millis``."""
    check_zone(zone)

    def local(at):
        return F.from_utc_timestamp(F.timestamp_millis(at), zone)

    return F.coalesce(*(
        F.when(local(millis + minutes * 60_000) == local(millis), millis + minutes * 60_000) for minutes in _BACK))


def number(text: Column) -> Column:
    """The token as a double; the cast ignores blanks around it."""
    value = text.try_cast("double")
    odd_word = (
        (F.isnan(value) | (F.abs(value) == float("inf")))
        & text.rlike(_NON_FINITE_WORD)
        & ~text.rlike(_EXACT_NON_FINITE)
    )
    return F.when(~odd_word, value)


def typed_columns(parts: Column, method: str, zone: str) -> list[Column]:
    """The method's columns by position; NULL where a token is missing or malformed."""
    spec = method_of(method)
    columns = []
    for position, field in enumerate(spec.schema):
        text = token(parts, position)
        if field.name == "timestamp":
            value = epoch_millis(text, intraday=spec.intraday, zone=zone)
        elif isinstance(field.dataType, DoubleType):
            value = number(text)
        else:
            value = text.try_cast("bigint")
        columns.append(value.alias(field.name))
    return columns


def reason_column(method: str) -> Column:
    """Why a parsed line is bad, from its first bad column; NULL for a good line.

    Reads the typed columns and ``tokens``, their number in the line.
    """
    found = [
        F.when(
            F.col(name).isNull(),
            F.when(F.col("tokens") <= position, f"missing {name}").otherwise(f"bad {name}"),
        )
        for position, name in enumerate(method_of(method).schema.names)
    ]
    return F.coalesce(*found)


def is_bad_line(line: Column, method: str, zone: str) -> Column:
    """True when any column of the line cannot be read."""
    bad = F.lit(False)
    for value in typed_columns(tokens(line), method, zone):
        bad = bad | value.isNull()
    return bad
