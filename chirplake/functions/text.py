"""Dates, tokens and mentions of a post.

A token is an unbroken run of ``@`` and ASCII word characters; a mention is a
token that begins with ``@`` followed by a word character. ``@a@b`` is one
mention, ``@@a`` and ``a@b`` are none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and patterns that define the results.
DATE_FORMAT = "MMM d HH:mm:ss zzz yyyy"
WEEKDAY_WIDTH = len("Mon ")
NOT_TOKEN = r"[^@\w]"
HANDLE = r"@\w+"
MENTION_TOKEN = r"^@\w"
# The look-behind comes after the literal @, so the matcher leaps from @ to @
# instead of testing it at each character.
MENTION_START = r"@(?<![@\w]@)\w"
MENTION = MENTION_START + r"[@\w]*"


def parse_post_date(date: Column) -> Column:
    """``Mon Apr 06 22:19:45 PDT 2009`` as a timestamp; NULL if it is no such date.

    The weekday is cut off: the strict parser has no letter for it, and it adds
    nothing to the instant.
    """
    return F.try_to_timestamp(F.substr(date, F.lit(WEEKDAY_WIDTH + 1)), F.lit(DATE_FORMAT))


def token_text(text: Column) -> Column:
    """Every character outside tokens replaced by one space."""
    return F.regexp_replace(text, NOT_TOKEN, " ")


def tokens(text: Column) -> Column:
    """The token text split at each single space, empty pieces included."""
    return F.split(token_text(text), " ")


def token_count(text: Column) -> Column:
    """Size of ``tokens`` without building them: one more than the signs that split."""
    return F.length(text) - F.length(F.regexp_replace(text, NOT_TOKEN, "")) + 1


def is_mention(token: Column) -> Column:
    return token.rlike(MENTION_TOKEN)


def mentions(text: Column) -> Column:
    """All mentions in order, repeats kept: the tokens that pass ``is_mention``.

    One matcher pass that never builds the other tokens.
    """
    return F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))


def has_mention(text: Column) -> Column:
    return text.rlike(MENTION_START)


def has_at_sign(text: Column) -> Column:
    return text.like("%@%")


def at_sign_flag(text: Column) -> Column:
    """1 if the text holds an ``@``, 0 if not or if there is no text."""
    return F.when(text.contains("@"), F.lit(1)).otherwise(F.lit(0))


def strip_mentions(text: Column) -> Column:
    """The text without ``@`` handles; spaces around them stay."""
    return F.regexp_replace(text, HANDLE, "")
