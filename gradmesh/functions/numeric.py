"""Lenient text-to-number coercion, as the C library's ``strtof`` and ``atoi`` read text.

Both read the longest numeric prefix of a token and fall back to zero when there is none.
Spark's ``try_cast`` alone is stricter in some places and looser in others
(``try_cast('1d')`` is 1.0), so the prefix is cut with a regular expression first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted number syntax.
# Leading white space, optional sign, then a decimal with optional exponent,
# or inf / infinity / nan in any case. C hex floats are not accepted.
FLOAT_PREFIX = (
    r"^[ \t\n\r\f\x0B]*([+-]?(?:(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
    r"|(?i:inf(?:inity)?|nan)))"
)
INT_PREFIX = r"^[ \t\n\r\f\x0B]*([+-]?[0-9]+)"
# Token separators of the shard reader.
SEPARATORS = " \t\n"
# Tokens that are cast as they are, where that gives a number.
PLAIN = r"\A[0-9.+-]+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(token: Column | str) -> Column:
    """``strtof(token, NULL)``: the longest numeric prefix as DOUBLE, else 0.0.

    Tokens of digits, signs and points alone are cast directly; only what that can't read
    goes through the regular expression. A signed ``nan`` is NaN like an unsigned one.
    """
    token = _col(token)
    plain = F.when(token.rlike(PLAIN), token.try_cast("double"))
    prefix = F.regexp_extract(token, FLOAT_PREFIX, 1)
    read = F.when(F.lower(prefix).endswith("nan"), F.lit(float("nan"))).otherwise(prefix.try_cast("double"))
    return F.coalesce(plain, read, F.lit(0.0))


def lenient_int(text: Column | str) -> Column:
    """``atoi(text)``: the leading integer as BIGINT, else 0."""
    prefix = F.regexp_extract(_col(text), INT_PREFIX, 1)
    return F.coalesce(prefix.try_cast("bigint"), F.lit(0).cast("bigint"))


def tokens(value: Column | str) -> Column:
    """Split a line on runs of space / tab / line feed, with no empty tokens.

    By plain replacement and a one-character split, several times faster a line than regular
    expressions; it stays in generated code.
    """
    blanks = F.replace(F.replace(_col(value), F.lit("\t"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    return F.array_remove(F.split(blanks, " "), "")
