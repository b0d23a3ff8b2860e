"""Cleaning and validation of text fields."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# The rules that cleaned fields must follow.
EMAIL_RULE = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"
PHONE_RULE = r"^(\+91)?[6-9][0-9]{9}\z"
ALNUM = string.ascii_letters + string.digits  # A-Z, a-z, 0-9
WORD = ALNUM + "_"

# Every character with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def trim_whitespace(col: Column) -> Column:
    """Strip Unicode white space at both ends (Spark's plain ``trim`` strips blanks only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def valid_email(col: Column) -> Column:
    """The address in lower case, or NULL when it is malformed."""
    return F.when(col.rlike(EMAIL_RULE), F.lower(col))


def valid_phone(col: Column, normalize: bool = False) -> Column:
    """The number, or an empty string when it is missing or malformed.

    ``normalize`` drops blanks, dashes and brackets first, so that
    ``+91-9876543210`` is accepted as ``+919876543210``.
    """
    number = F.regexp_replace(col, r"[\s()-]", "") if normalize else col
    return F.when(number.rlike(PHONE_RULE), number).otherwise("")


def _translate(col: Column, of: Column, to: Column) -> Column:
    return F.call_function("translate", col, of, to)


def _others(col: Column, keep: str) -> Column:
    """The characters of a text that are not in ``keep``."""
    return _translate(col, F.lit(keep), F.lit(""))


def _strip(col: Column, keep: str) -> Column:
    """Drop the characters not in ``keep``: find them, then delete them.

    Two character maps; four times as fast as replacing a negated regular expression,
    which was nine tenths of the time of cleaning transactions.
    """
    return _translate(col, _others(col, keep), F.lit(""))


def strip_non_alnum(col: Column) -> Column:
    """Keep ASCII letters and digits."""
    return _strip(col, ALNUM)


def strip_non_word(col: Column) -> Column:
    """Keep ASCII letters, digits and underscores."""
    return _strip(col, WORD)


def blank_non_alnum(col: Column) -> Column:
    """Replace each other character by one blank; runs are not collapsed."""
    others = _others(col, ALNUM)
    return _translate(col, others, F.repeat(F.lit(" "), F.length(others)))


def same_word(col: Column, word: str) -> Column:
    """Equality that ignores case."""
    return F.upper(col) == F.lit(word.upper())
