"""Text helpers for delimited data without quoting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_delimiters(text: Column, sep: str, replacement: str = " ") -> Column:
    """Replace the delimiter and line ends, which unquoted delimited text cannot carry.

    A NUL goes as well: it marks "no quote character" for the reader and would be taken as a quote.
    """
    for reserved in (sep, "\n", "\r", "\0"):
        text = F.replace(text, F.lit(reserved), F.lit(replacement))
    return text
