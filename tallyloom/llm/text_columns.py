"""Column expressions shared by the operators that run without Python workers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body or a
    lambda inside it refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    only_ascii = F.length(text) == F.octet_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` in the text in lower case (A-Z only)."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(pattern), F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it what no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
