"""Names, e-mail addresses and phone numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopstrata import fixed_values as fixed


def plain_name(name: Column) -> Column:
    """Name without one leading title and one trailing suffix."""
    untitled = F.regexp_replace(F.trim(name), fixed.HONORIFIC_PREFIX, "")
    return F.regexp_replace(untitled, fixed.NAME_SUFFIX, "")


def name_parts(clean_name: Column) -> dict[str, Column]:
    """First word, and everything after the first space (NULL for one word)."""
    first_space = F.instr(clean_name, " ")
    return {
        "first_name": F.substring_index(clean_name, " ", 1),
        "last_name": F.when(
            first_space > 0,
            F.substr(clean_name, first_space + F.lit(1)),
        ),
    }


def email_parts(email: Column) -> dict[str, Column]:
    return {
        "is_valid_email": F.rlike(email, F.lit(fixed.EMAIL)),
        # NULL without an "@"; the ANSI element_at would raise there.
        "email_domain": F.lower(F.try_element_at(F.split(email, "@"), F.lit(2))),
    }


def without_extension(phone: Column) -> Column:
    """Drop a trailing ``x12`` and then a trailing ``ext. 12``."""
    bare = F.trim(F.regexp_replace(phone, fixed.X_EXTENSION, ""))
    return F.trim(F.regexp_replace(bare, fixed.WORD_EXTENSION, ""))


def phone_parts(phone: Column) -> dict[str, Column]:
    code = F.regexp_extract(phone, fixed.COUNTRY_PREFIX, 1)
    return {
        "phone_country_code": F.concat(F.lit("+"), F.nullif(code, F.lit(""))),
        "has_country_code": F.rlike(phone, F.lit(fixed.COUNTRY_PREFIX)),
        "phone_number_clean": F.regexp_replace(
            F.regexp_replace(phone, fixed.PHONE_PREFIXES, ""),
            fixed.EXTENSION_OR_PUNCTUATION,
            "",
        ),
    }
