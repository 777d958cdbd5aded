"""Name tokens (F3, F4) and typed parsing of change-file text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_token(name: Column | str, index: int, sep: str = " ") -> Column:
    """Token ``index`` (0-based) of ``split(name, sep)``; NULL when absent.

    ``get`` rather than ``getItem``: under ANSI mode ``getItem`` raises on a
    one-token name, ``get`` yields NULL.
    """
    c = F.col(name) if isinstance(name, str) else name
    return F.get(F.split(c, sep), index)


def to_date_safe(text: Column | str) -> Column:
    """Text -> DATE, time part cut; unparsable text gives NULL, the row stays."""
    c = F.col(text) if isinstance(text, str) else text
    return c.try_cast("date")


def to_timestamp_safe(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return c.try_cast("timestamp")


def to_int_safe(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return c.try_cast("int")


def to_price_decimal(text: Column | str) -> Column:
    """Price text -> DECIMAL(38,18): 20 digits before the point, 18 behind."""
    c = F.col(text) if isinstance(text, str) else text
    return c.try_cast("decimal(38,18)")


def price_text(text: Column | str) -> Column:
    """What the change hash sees of a price: the text as delivered, without
    outer blanks. No digit is cut, and unparsable prices differ as well."""
    c = F.col(text) if isinstance(text, str) else text
    return F.trim(c.cast("string"))


def round_price(dec: Column) -> Column:
    """Round a decimal price to 2 digits (half up) and hand it out as DOUBLE."""
    return F.round(dec, 2).cast("double")
