"""Text patterns. Written with explicit character classes so that every engine reads them alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: Unicode white space, word characters, the letters that stay ---
WS = r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
URL = rf"http[^{WS}]+"
MENTION = r"@[\p{L}\p{N}_]+"
NOT_KEPT = rf"[^a-záéíóúñü{WS}]+"
BLANKS = rf"[{WS}]+"
BLANK_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ------------------------------------------------------------------------------

# What most characters are is ruled out first: Java tries a long class part by part. The runs that match are the same.
_NOT_KEPT = rf"(?![a-z ]){NOT_KEPT}"
_BLANKS = rf"(?![!-~]){BLANKS}"


def strip(c: Column) -> Column:
    """Remove white space at both ends, Unicode kinds included."""
    return F.trim(c, F.lit(BLANK_CHARS))


def clean_text(c: Column) -> Column:
    """Lower case; drop links, mentions and everything but Spanish letters; squeeze blanks."""
    out = F.lower(c)
    for pattern in (URL, MENTION, _NOT_KEPT):
        out = F.regexp_replace(out, pattern, "")
    return F.trim(F.regexp_replace(out, _BLANKS, " "))


def tokens(c: Column, min_length: int = 1) -> Column:
    """White-space tokens of a text, in order."""
    parts = F.split(c, _BLANKS)
    return F.filter(parts, lambda t: F.length(t) >= min_length)
