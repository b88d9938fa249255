"""Number kinds in JSON text.

A VARIANT keeps whole numbers, decimals and doubles apart, and ``parse_json`` picks the kind from
how a number is written. Stores differ in the kind they hand out, so before parsing, the numbers of
a JSON text are rewritten: with an exponent (``7`` -> ``7e0``) a number parses as a double. This
reaches any nesting depth in one pass of a regular expression, inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INT64_MAX = 9223372036854775807

# What is passed over: anything but strings and numbers, whole strings, numbers with an exponent.
# Possessive quantifiers keep the match linear and free of recursion on long texts.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_EXPONENT_NUMBER = r"-?\d++(?:\.\d++)?[eE][+-]?\d++"


def _outside_int64() -> str:
    """Digit runs above the signed 64-bit limit, written from the limit digit by digit."""
    digits = str(INT64_MAX)
    cases = [rf"[1-9]\d{{{len(digits)},}}"]
    for i, d in enumerate(digits):
        if d < "9":
            cases.append(f"{digits[:i]}[{int(d) + 1}-9]\\d{{{len(digits) - i - 1}}}(?!\\d)")
    return "|".join(cases)


def _rewrite(json_text: Column, number: str, keep: str | None = None) -> Column:
    passed = [r'[^"0-9-]++', _STRING, _EXPONENT_NUMBER] + ([keep] if keep else [])
    pattern = rf"(?s)\G((?:{'|'.join(passed)})*+)({number})(?![0-9.eE])"
    return F.regexp_replace(json_text, pattern, "$1$2e0")


def numbers_to_double(json_text: Column) -> Column:
    """Every number becomes a double, as after a round trip through generic JSON."""
    return _rewrite(json_text, r"-?\d++(?:\.\d++)?+")


def typed_numbers(json_text: Column) -> Column:
    """Whole numbers that fit 64 bits stay whole, all other numbers become doubles."""
    too_big = _outside_int64()
    small = rf"-?(?!{too_big})\d++(?![0-9.eE])"
    return _rewrite(json_text, rf"-?(?:\d++\.\d++|(?:{too_big}))", keep=small)
