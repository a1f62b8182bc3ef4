"""Trimming, blank tests, normal forms, e-mail shapes and redaction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The Unicode White_Space characters. Plain ``trim`` strips the blank only.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The two accepted e-mail shapes. ``\z`` ends the text; ``$`` would let a newline pass.
EMAIL_STRICT = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"
EMAIL_LOOSE = r"^[^@\s]+@[^@\s]+\.[^@\s]+\z"

# What a redacted token looks like in a message.
BEARER_TOKEN = r"Bearer\s+[^'\"]+"
BEARER_REDACTED = "Bearer [REDACTED]"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    """The value as text without leading or trailing whitespace of any kind."""
    return F.btrim(col(value).cast("string"), F.lit(WHITESPACE))


def lower_trimmed(value: Column | str) -> Column:
    return F.lower(trimmed(value))


def upper_trimmed(value: Column | str) -> Column:
    return F.upper(trimmed(value))


def is_blank(value: Column | str) -> Column:
    """True for NULL and for text that is empty once trimmed; never NULL."""
    return col(value).isNull() | (trimmed(value) == "")


def filled(value: Column | str) -> Column:
    """The trimmed value, NULL when nothing is left."""
    return F.nullif(trimmed(value), F.lit(""))


def is_email(value: Column | str, strict: bool = True) -> Column:
    return col(value).rlike(EMAIL_STRICT if strict else EMAIL_LOOSE)


def redacted(value: Column | str) -> Column:
    """Bearer tokens in a message or log column replaced by a marker."""
    return F.regexp_replace(col(value), BEARER_TOKEN, BEARER_REDACTED)


def contact_name(email: Column | str, width: int = 80, default: str = "Unknown") -> Column:
    """The part before the first ``@``, cut to ``width`` characters; a default when it is empty."""
    local = F.substring(F.substring_index(col(email), "@", 1), 1, width)
    return F.coalesce(F.nullif(local, F.lit("")), F.lit(default))
