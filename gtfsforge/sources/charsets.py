"""Legacy single-byte charsets without a Python UDF (M-1, A-3).

Feeds arrive as UTF-8, ISO-8859-15 or Windows-1252.  Spark's readers accept
ISO-8859-1 (Latin-1) everywhere, and Latin-1 maps every byte to the code
point of the same value, so a file read as Latin-1 loses nothing.  The two
legacy charsets differ from Latin-1 only in a few byte positions; those are
fixed with one ``translate`` (a JVM string function).  UTF-8 text read as
Latin-1 is re-decoded with ``encode``/``decode``.  The translation tables
are derived from Python's codecs, not written out.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

LATIN1 = "ISO-8859-1"
ALIASES = {"iso-8859-15": "iso8859_15", "iso8859-15": "iso8859_15", "latin-9": "iso8859_15", "latin9": "iso8859_15",
           "cp1252": "cp1252", "windows-1252": "cp1252", "utf-8": "utf-8", "utf8": "utf-8",
           "iso-8859-1": "latin-1", "latin-1": "latin-1", "latin1": "latin-1"}


@lru_cache(maxsize=None)
def translation(charset: str) -> tuple[str, str]:
    """(Latin-1 characters, replacement characters) for a single-byte charset."""
    codec = ALIASES.get(charset.lower(), charset.lower())
    src, dst = [], []
    for b in range(256):
        raw = bytes([b])
        try:
            ch = raw.decode(codec)
        except UnicodeDecodeError:
            continue
        lat = raw.decode("latin-1")
        if ch != lat:
            src.append(lat)
            dst.append(ch)
    return "".join(src), "".join(dst)


def decode_latin1_text(col: Column, charset: str) -> Column:
    """Text that was read as Latin-1 -> text in ``charset``; NULL where the bytes are malformed."""
    codec = ALIASES.get(charset.lower(), charset.lower())
    if codec == "latin-1":
        return col
    if codec == "utf-8":
        # bytes that are no UTF-8 give NULL, not an error
        return F.try_validate_utf8(F.encode(col, LATIN1).cast("string"))
    src, dst = translation(charset)
    return F.translate(col, src, dst) if src else col


def charset_of_owner(owner: str) -> str:
    """Feed charset by data owner (A-3)."""
    return "ISO-8859-15" if owner in OWNERS_LATIN9 else "UTF-8"


# ---- fixed values: owners that deliver ISO-8859-15 ----
OWNERS_LATIN9 = ("QBUZZ", "CXX", "EBS")
# ---- end of fixed values ----
