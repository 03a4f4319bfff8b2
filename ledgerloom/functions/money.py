"""Amounts: several text dialects, comparisons with tolerance, and business-number checks.

Each parser returns null for what it cannot read.  They differ where the sources differ: which signs
mean negative and which decorations are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the modulus-89 check of Australian business numbers.
ABN_WEIGHTS = (10, 1, 3, 5, 7, 9, 11, 13, 15, 17, 19)
_NUMERIC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _number(text: Column) -> Column:
    return F.when(text.rlike(_NUMERIC), text.try_cast("double"))


def _missing(c: Column, *words: str) -> Column:
    return c.isNull() | F.upper(F.trim(c)).isin("", *words)


def parse_signed(c: Column) -> Column:
    """``$€£`` and blanks go; a leading minus or an opening bracket makes it negative."""
    bare = F.regexp_replace(F.trim(c), r"[$€£\s]", "")
    negative = bare.startswith("-") | bare.startswith("(")
    value = _number(F.regexp_replace(F.regexp_replace(bare, r"^[-()]+|[-()]+$", ""), ",", ""))
    return F.when(~_missing(c, "NOT_FOUND"), F.when(negative, -value).otherwise(value))


def parse_bracketed(c: Column) -> Column:
    """``$``, commas and blanks go; only a closed pair of brackets makes it negative."""
    bare = F.regexp_replace(F.trim(c), r"[$,\s]", "")
    body = F.when(bare.startswith("(") & bare.endswith(")"), F.concat(F.lit("-"), F.substring(bare, F.lit(2), F.length(bare) - 2))).otherwise(bare)
    return F.when(~_missing(c, "NOT_FOUND", "N/A", "NONE", "NULL"), _number(body))


def parse_plain(c: Column) -> Column:
    """As ``parse_bracketed`` but brackets are not understood."""
    return F.when(~_missing(c, "NOT_FOUND", "N/A", "NONE", "NULL"), _number(F.regexp_replace(F.trim(c), r"[$,\s]", "")))


def parse_absolute(c: Column) -> Column:
    return F.abs(parse_plain(c))


def parse_ledger(c: Column) -> Column:
    """CR and DR marks, ``$``, commas and blanks go; what cannot be read is 0, signs are dropped."""
    bare = F.regexp_replace(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"CR|DR", ""), r"[$,\s()]", "")
    return F.coalesce(F.abs(_number(bare)), F.lit(0.0))


def parse_digits(c: Column) -> Column:
    """Only digits, dots and minus signs are read."""
    return _number(F.regexp_replace(c, r"[^0-9.\-]", ""))


def money_equal(a: Column, b: Column, tolerance: float = 0.01) -> Column:
    """Within a share of the expected value ``b``, or an absolute amount where that is zero; inclusive."""
    return F.abs(a - b) <= F.when(b != 0, F.abs(b * tolerance)).otherwise(F.lit(tolerance))


def pct_diff(a: Column, b: Column) -> Column:
    """|a - b| over the larger magnitude; 0 if both are 0."""
    most = F.greatest(F.abs(a), F.abs(b))
    return F.when(most == 0, F.lit(0.0)).otherwise(F.abs(a - b) / most)


def all_agree(values: Column, tolerance: float) -> Column:
    """Whether the non-null values of an array agree with the first of them (fewer than two do)."""
    some = F.filter(values, lambda v: v.isNotNull())
    return (F.size(some) < 2) | F.forall(some, lambda v: pct_diff(F.get(some, F.lit(0)), v) <= tolerance)


def normal_id(c: Column) -> Column:
    """An identifier without white space; empty for null."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", "")


def abn_valid(c: Column) -> Column:
    """Eleven digits whose weighted sum, with one off the first digit, is divisible by 89."""
    digits = normal_id(c)
    total = sum((F.substring(digits, i + 1, 1).try_cast("int") - (1 if i == 0 else 0)) * w for i, w in enumerate(ABN_WEIGHTS))
    return F.coalesce(digits.rlike("^[0-9]{11}$") & (total % 89 == 0), F.lit(False))


def canonical_abn(statement: Column, trust_return: Column, schedule: Column) -> Column:
    """Of the valid numbers one that two sources share, else the first by preference; without a valid one the first that is not empty."""
    order = [normal_id(c) for c in (statement, trust_return, schedule)]
    seen = [normal_id(c) for c in (trust_return, statement, schedule)]
    ok = [F.when(abn_valid(c), c) for c in order]
    a, b, c = (F.when(abn_valid(x), x) for x in seen)
    majority = F.when((a == b) | (a == c), a).when(b == c, b)
    return F.coalesce(majority, *ok, *(F.nullif(x, F.lit("")) for x in order), F.lit(""))


def debit_text(c: Column) -> Column:
    """Negative amounts as ``-$x``, others as ``$x``; the missing mark stays."""
    bare = F.regexp_replace(F.trim(c), r"[$()\s-]", "")
    negative = F.trim(c).startswith("-") | F.trim(c).startswith("(")
    return F.when(_missing(c, "NOT_FOUND"), F.lit("NOT_FOUND")).otherwise(F.concat(F.when(negative, F.lit("-$")).otherwise(F.lit("$")), bare))


def parse_unsigned(c: Column) -> Column:
    """The magnitude; a closed pair of brackets is understood."""
    bare = F.regexp_replace(F.trim(c), r"[$,\s]", "")
    body = F.when(bare.startswith("(") & bare.endswith(")"), F.substring(bare, F.lit(2), F.length(bare) - 2)).otherwise(bare)
    return F.when(~_missing(c, "NOT_FOUND"), F.abs(_number(body)))


def amount_list(c: Column) -> Column:
    """The amounts of a pipe list; what cannot be read is left out."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), parse_unsigned), lambda x: x.isNotNull())


def dollars(x: Column) -> Column:
    """``$`` and two decimals (half up: amounts have no more than two)."""
    return F.concat(F.lit("$"), x.cast("decimal(18,2)").cast("string"))


def is_negative_text(c: Column) -> Column:
    """A leading minus, or brackets around it."""
    t = F.trim(c)
    return F.coalesce(t.startswith("-") | (t.startswith("(") & t.endswith(")")), F.lit(False))
