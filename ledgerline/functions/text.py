"""Text columns: trimming, null tokens, names, keyword rules and code parts."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed

# Every character that counts as white space in Unicode text, the non-breaking blank among them.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
BLANK = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not blanks only."""
    return F.btrim(c, F.lit(WHITESPACE))


def null_if_blank(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def null_tokens_to_null(c: Column, strict: bool = False) -> Column:
    """Blank cells and null tokens become null.

    By default a cell that merely *contains* a token is nulled too; ``strict``
    nulls only cells that are nothing but the token.
    """
    tokens = "|".join(fixed.NULL_TOKENS)
    pattern = rf"^{BLANK}*({tokens})?{BLANK}*$" if strict else rf"^{BLANK}*$|{tokens}"
    return F.when(c.rlike(pattern), None).otherwise(c)


def sheet_token(c: Column) -> Column:
    """Sheet name as a lower-case token with single underscores."""
    token = F.btrim(F.regexp_replace(c, "[^0-9a-zA-Z]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(F.lower(token), F.lit("")), F.lit(fixed.EMPTY_SHEET_NAME))


def drop_leading_parenthesis(c: Column) -> Column:
    return F.regexp_replace(c, r"^\([^)]*\)\s*", "")


def standardise(c: Column) -> Column:
    return F.upper(strip(c))


def has_prefix(c: Column, prefix: str) -> Column:
    """Prefix test that ignores case and treats null as empty."""
    return F.upper(F.coalesce(c, F.lit(""))).startswith(prefix.upper())


def is_subscription(product: Column, code: Column, prefix: str = fixed.SUBSCRIPTION_PREFIX) -> Column:
    words = "(?i)" + "|".join(fixed.SUBSCRIPTION_WORDS)
    return has_prefix(code, prefix) | F.coalesce(product, F.lit("")).rlike(words)


def holds(c: Column, words: str) -> Column:
    """``words`` joined by ``&`` all occur in ``c``."""
    return reduce(and_, [F.contains(c, F.lit(w)) for w in words.split("&")])


def service_family(product: Column) -> Column:
    """Family of a subscription product; the first keyword rule that holds wins."""
    name = F.lower(F.coalesce(product, F.lit("")))
    chain = F
    for label, options in fixed.FAMILY_RULES:
        chain = chain.when(reduce(or_, [holds(name, o) for o in options]), label)
    return chain.otherwise(fixed.DEFAULT_FAMILY)


def code_part(code: Column, position: int) -> Column:
    """Part of a dash-joined code, 1-based; missing or empty gives ``UNKNOWN``."""
    part = F.split_part(F.upper(F.coalesce(code, F.lit(""))), F.lit("-"), F.lit(position))
    return F.coalesce(F.nullif(part, F.lit("")), F.lit(fixed.UNKNOWN_PART))
