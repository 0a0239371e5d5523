"""String helpers shared by every contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a blank check ignores.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as a regular-expression class.
WHITESPACE_CLASS = "[" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "]"

MAX_ERROR_LENGTH = 512


def _is_printable_ascii(code: Column) -> Column:
    return code.between(33, 126)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only the ASCII blank.

    Text that starts and ends with a printable ASCII character, which is nearly
    all of it, skips the slow trim over a character set.
    """
    bare = _is_printable_ascii(F.ascii(text)) & _is_printable_ascii(F.ascii(F.right(text, F.lit(1))))
    return F.when(bare, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text; never null."""
    filled = _is_printable_ascii(F.ascii(F.ltrim(text)))
    return F.when(filled, False).otherwise(F.coalesce(F.btrim(text, F.lit(WHITESPACE)) == "", F.lit(True)))


def safe_segment(text: Column) -> Column:
    """True when the text may be used as one directory name."""
    return ~is_blank(text) & ~text.isin(".", "..") & ~text.contains("/") & ~text.contains("\\")


def safe_error(category: Column | str, component: str, operation: str, message: str) -> Column:
    """Render a failure from text we own; never from an exception or a row value."""
    if isinstance(category, str):
        category = F.lit(category)
    rendered = F.concat(
        F.lit("category="),
        category,
        F.lit(f" component={component} operation={operation} message={message}"),
    )
    return F.left(rendered, F.lit(MAX_ERROR_LENGTH))
