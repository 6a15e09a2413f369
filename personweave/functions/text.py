"""Column expressions for cleaning and normalising text. All are built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_email(c: Column) -> Column:
    return F.lower(F.trim(c))


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def title_case(c: Column) -> Column:
    return F.initcap(F.trim(c))


def after_first_blank(c: Column) -> Column:
    """Text after the first blank; the whole text if there is none."""
    return F.substr(c, F.position(F.lit(" "), c) + 1)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normal_email(c: Column) -> Column:
    """Lower case without the `+tag` part."""
    return blank_to_null(F.regexp_replace(clean_email(c), r"\+[^@]*@", "@"))


def normal_phone(c: Column) -> Column:
    """Digits without a leading country code 1."""
    digits = digits_only(c)
    national = (F.length(digits) == 11) & digits.startswith("1")
    return blank_to_null(F.when(national, F.substr(digits, F.lit(2))).otherwise(digits))


def normal_generic(c: Column) -> Column:
    return blank_to_null(F.trim(F.regexp_replace(F.lower(c), r"\s+", " ")))


def normal_name(c: Column) -> Column:
    """Lower case letters, digits and single blanks."""
    return normal_generic(F.regexp_replace(c, r"[^\p{L}\p{N}\s]", ""))
