"""Text, path, character-set and JSON column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the characters that count as white space, in code point order -----
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_whitespace(c: Column) -> Column:
    """Trim all leading and trailing white space (``F.trim`` only removes blanks)."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse_line_breaks(c: Column) -> Column:
    """Each run of carriage returns and newlines becomes one blank."""
    return F.regexp_replace(c, r"[\r\n]+", " ")


def tidy_text(c: Column) -> Column:
    return strip_whitespace(collapse_line_breaks(c))


def normalize_region(c: Column) -> Column:
    return F.lower(strip_whitespace(c))


def decode_key(c: Column) -> Column:
    """Decode a percent-encoded object key; undecodable keys stay as they are."""
    return F.coalesce(F.try_url_decode(c), c)


def decode_file_path(c: Column) -> Column:
    """Decode Spark's ``_metadata.file_path``, in which a plus sign is literal."""
    return decode_key(F.replace(c, F.lit("+"), F.lit("%2B")))


def region_from_path(c: Column) -> Column:
    """Value of the first ``region=`` path segment, else ``unknown``."""
    found = F.regexp_extract(c, r"(?:^|/)region=([^/]*)", 1)
    return F.when(found == "", F.lit("unknown")).otherwise(found)


def decode_bytes(c: Column) -> Column:
    """Bytes to text: UTF-8 where they are valid UTF-8, Latin-1 otherwise."""
    as_text = c.cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(F.decode(c, "ISO-8859-1"))


def parses_as_json(c: Column) -> Column:
    return F.try_parse_json(c).isNotNull()


def minify_json(c: Column) -> Column:
    """One-line rendering of a JSON document, non-ASCII kept; bad JSON gives NULL."""
    return F.to_json(F.try_parse_json(c))


def item_count(c: Column) -> Column:
    """Array length, 0 for a missing array."""
    return F.coalesce(F.array_size(c), F.lit(0))
