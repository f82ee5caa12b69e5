"""Text cleaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove all white space at both ends; Spark's own trim takes spaces only."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def is_blank(c: Column) -> Column:
    """True for NULL and for text of nothing but white space.

    Text with a printable ASCII character after its spaces, as most has, needs no stripping.
    """
    begin = F.ltrim(c)
    return c.isNull() | (~((begin >= "!") & (begin < "\x7f")) & (strip(c) == ""))


def title_case(c: Column) -> Column:
    """Upper-case each letter that follows a non-letter and lower-case the rest.

    Text of letters and spaces only, as most names are, needs no splitting.
    """
    words = F.split(F.lower(c), r"(?<=[^\p{L}])")
    joined = F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))), ""
    )
    return F.when(c.rlike(r"^[\p{L} ]*$"), F.initcap(c)).otherwise(joined)


def zero_fill(c: Column, width: int) -> Column:
    """Pad with zeros on the left, after a sign if there is one; longer text stays whole."""
    signed = c.rlike("^[+-]")
    padded = F.lpad(c, F.greatest(F.lit(width), F.length(c)), F.lit("0"))
    rest = c.substr(F.lit(2), F.length(c))
    after_sign = F.lpad(rest, F.greatest(F.lit(width - 1), F.length(rest)), F.lit("0"))
    return F.when(signed, F.concat(F.substring(c, 1, 1), after_sign)).otherwise(padded)


def null_if_in(c: Column, texts: Iterable[str]) -> Column:
    """NULL where the text is one of the given ones."""
    return F.when(~c.isin(list(texts)), c)


def mapped(c: Column, pairs: dict[str, str], default: str) -> Column:
    """Look a value up in a small fixed mapping."""
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), F.lit(default))
