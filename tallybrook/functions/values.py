"""Scalar expressions: masks, digests, labels, lenient parsing, usage percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_number(value: Column) -> Column:
    """Murmur3 mask of a value. Hides it from view only: small domains can be guessed back."""
    return F.hash(value)


def mask_salted(value: Column, salt: str) -> Column:
    """SHA-256 mask of a value behind a secret salt."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def digest_key(value: Column) -> Column:
    """MD5 digest in hexadecimal digits."""
    return F.md5(value.cast("binary"))


def joined(separator: str, *parts: Column) -> Column:
    """Concatenate with a separator. Null when a part is null, as with ``concat``."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(separator), part.cast("string")]
    return F.concat(*pieces[1:])


def number_label(value: Column) -> Column:
    """``No: 7`` for 7."""
    return F.format_string("No: %s", value)


def lenient(value: Column, as_type: str) -> Column:
    """Cast that gives null for a value that does not fit, also under ANSI rules."""
    return value.try_cast(as_type)


def field(line: Column, position: int, separator: str = ",") -> Column:
    """The n-th field of a delimited line, counted from 1; null when the line is too short.

    The separator is a regular expression, as in ``split``.
    """
    return F.try_element_at(F.split(line, separator), F.lit(position))


def usage_percent(total: Column, free: Column) -> Column:
    """Used share in per cent; null for a zero total."""
    return F.try_divide((total - free).cast("double"), total.cast("double")) * 100


def event_time(df, column: str) -> Column:
    """The column as an instant. Event-time operators refuse timestamps without a zone."""
    kind = df.schema[column].dataType.simpleString()
    return F.col(column).cast("timestamp") if kind == "timestamp_ntz" else F.col(column)
