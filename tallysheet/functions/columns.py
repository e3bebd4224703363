from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tallysheet.schemas import AMOUNT, PERCENT

Name = Column | str


def _col(c: Name) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Name) -> Column:
    """Empty text counts as missing."""
    return F.nullif(_col(c), F.lit(""))


def to_whole(c: Name) -> Column:
    """Floating number to long, halves to the even neighbour (a plain cast would truncate)."""
    return F.rint(_col(c)).cast("long")


def fitted(c: Column, dtype: DataType, what: str, known: Column | None = None) -> Column:
    """``c`` cast to a narrower number. A value that does not fit stops the job, whatever the session's
    ANSI setting says; one that is not ``known`` (default: null) and cannot be cast is null."""
    # The cast, which is dear, is made once; only a null result is looked at again. Few words of code: Java runs
    # a generated method of more than 8,000 bytes slowly, and a row has many amounts.
    error = F.raise_error(F.format_string(f"{what} out of range: %s", c))
    return F.coalesce(c.try_cast(dtype), F.when(c.isNotNull() if known is None else known, error))


def to_amount(c: Name) -> Column:
    """Amount or quantity. Not a number counts as missing."""
    number = _col(c)
    # Not a number is greater than all numbers.
    return fitted(number, AMOUNT, "amount", number <= F.lit(float("inf")))


def month_key(ts: Name) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def compose_timestamp(day: Name, time: Name) -> Column:
    """Date plus time-of-day text. Null or malformed parts give null rather than an error."""
    text = F.concat(_col(day).cast("date").cast("string"), F.lit(" "), _col(time).cast("string"))
    return text.try_cast("timestamp_ntz")


def _ntz(value: datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def in_window(ts: Name, start: datetime | str, end: datetime | str, closed: str = "left") -> Column:
    """Time window predicate. ``closed='left'`` is half open, ``'both'`` includes the end."""
    ts = _col(ts)
    if closed == "left":
        return (ts >= _ntz(start)) & (ts < _ntz(end))
    if closed == "both":
        return ts.between(_ntz(start), _ntz(end))
    raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")


def discount_text(barrio: Name, pattern: str) -> Column:
    """The number in parentheses at the start of the text, as text; null when there is none."""
    return blank_to_null(F.regexp_extract(_col(barrio), pattern, 1))


def discount_number(text: Name) -> Column:
    """The text if it is a well-formed number."""
    text = _col(text)
    return F.when(text.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"), text)


def discount_percent(text: Name) -> Column:
    """Malformed numbers such as ``1.2.3`` give null, they do not fail the job. A well-formed one
    that does not fit does."""
    return fitted(discount_number(text), PERCENT, "discount")
