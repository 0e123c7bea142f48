"""Match keys and checksums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space around an address.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def normalize_email(email: Column) -> Column:
    """Stripped and lower-cased address; null when it holds no ``@``."""
    text = F.lower(F.trim(email, F.lit(WHITE_SPACE)))
    return F.when(text.contains("@"), text)


def row_checksum(columns: Sequence[str | Column], length_prefixed: bool = False) -> Column:
    """SHA-256 over the ``|``-joined columns, null read as the empty string.

    ``length_prefixed`` writes each value's length before it, so that a ``|`` inside a value, or null
    against empty, cannot give two different rows the same text.
    """
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    if length_prefixed:
        parts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    else:
        parts = [F.coalesce(v, F.lit("")) for v in values]
    return F.sha2(F.concat_ws("|", *parts), 256)


def unified_id(key: Column) -> Column:
    """Surrogate id of a match key; the same key gives the same id in every run."""
    return F.sha2(key, 256)


def is_missing(key: Column) -> Column:
    """True for a null or an empty id."""
    return F.coalesce(key, F.lit("")) == ""
