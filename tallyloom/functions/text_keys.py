"""Keys under which two texts count as the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of blanks (space, tab, line feed, carriage return, form feed) that are not
# one space already; most blanks of a text are, and are left alone.
BLANKS = "[ \\t\\n\\r\\f]{2,}|[\\t\\n\\r\\f]"


def exact_key(text: str) -> Column:
    """Digest of the whole text, 32 bytes whatever the text's length."""
    return F.unhex(F.sha2(F.col(text), 256))


def folded_key(text: str) -> Column:
    """As :func:`exact_key`, ignoring case and runs of white space."""
    folded = F.lower(F.trim(F.regexp_replace(F.col(text), BLANKS, " ")))
    return F.unhex(F.sha2(folded, 256))
