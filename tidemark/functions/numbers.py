"""Numbers out of text; whatever does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: the texts that count as a number, and those among them that say infinity.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
INFINITY_PATTERN = r"[nN]"
#: The letters that no decimal has.
LETTER_PATTERN = r"[A-DF-Za-df-z]"


def is_number(c: Column) -> Column:
    """True where the text is a number within the range of a double. A cast alone would also take
    `1.0d` and `nan`, and make an infinity of `1e999`."""
    written = c.cast("string")
    too_large = ~written.rlike(INFINITY_PATTERN) & (F.abs(written.try_cast("double")) == float("inf"))
    return written.rlike(NUMBER_PATTERN) & ~F.coalesce(too_large, F.lit(False))


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Decimal with half-up rounding to the scale; NULL if unparseable or too large.

    Text with a letter is not tried: each failed cast raises and catches an exception.
    """
    return F.when(~c.cast("string").rlike(LETTER_PATTERN), c.try_cast(f"decimal({precision},{scale})"))


def to_money(c: Column) -> Column:
    return to_decimal(c, 12, 2)


def to_whole(c: Column) -> Column:
    """Integer, with a fraction cut off however close it is to the next; `7.0` is 7, which a direct cast would refuse."""
    return c.try_cast("decimal(38,18)").try_cast("int")


def ratio(numerator: Column, denominator: Column, scale: int, width: int = 38) -> Column:
    """Exact decimal quotient, rounded half up; NULL for a zero denominator."""
    return F.round(numerator / F.nullif(denominator, F.lit(0)), scale).cast(f"decimal({width},{scale})")
