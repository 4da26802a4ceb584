"""Masks for personal data in displayed comments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateia.functions.text import WHITESPACE

_LOCAL = r"a-zA-Z0-9._%+-"

# What is masked and the tag that replaces it, in this order. \p{Nd} and
# the whitespace class are the Unicode digits and spaces. An address may start only
# where its run of characters starts or where the previous match ended, and the run
# never gives characters back: matches stay the same, long runs cost linear time.
_ADDRESSES = [
    (r"https?://[!$-_a-z]+", "[URL]"),
    (rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}", "[EMAIL]"),
    (r"@[a-zA-Z0-9_]+", "[MENÇÃO]"),
]
_STRICT_NUMBERS = [
    (rf"\(\p{{Nd}}{{2}}\)[{WHITESPACE}]*\p{{Nd}}{{4,5}}-\p{{Nd}}{{4}}", "[TELEFONE]"),
    (rf"\p{{Nd}}{{2}}[{WHITESPACE}]*\p{{Nd}}{{4,5}}-\p{{Nd}}{{4}}", "[TELEFONE]"),
    (r"\p{Nd}{3}\.\p{Nd}{3}\.\p{Nd}{3}-\p{Nd}{2}", "[CPF]"),
]
_LOOSE_NUMBERS = [
    (rf"\(?(?:\p{{Nd}}{{2}})?[{WHITESPACE}]?9?\p{{Nd}}{{4}}-?\p{{Nd}}{{4}}", "[TELEFONE]"),
]

# A part that no match of the group can lack. Most texts have none and skip the group.
_STRICT_PART = r"\p{Nd}{3}-\p{Nd}{2}"
_LOOSE_PART = r"\p{Nd}{4}-?\p{Nd}{4}"


def _mask_where(needed: Column, text: Column, rules: list[tuple[str, str]]) -> Column:
    masked = reduce(lambda done, rule: F.regexp_replace(done, *rule), rules, text)
    return F.when(needed, masked).otherwise(text)


def _anonymize(text: Column, part: str, numbers: list[tuple[str, str]]) -> Column:
    """Mask addresses, then numbers.

    The necessary parts are looked for in the original text: tags hold neither
    digits nor '@', so masking never creates a part that was not there.
    """
    filled = F.coalesce(text, F.lit(""))
    with_address = filled.contains("@") | filled.contains("://")
    return _mask_where(filled.rlike(part), _mask_where(with_address, filled, _ADDRESSES), numbers)


def anonymize_strict(text: Column) -> Column:
    """URL, e-mail, mention, formatted phone and tax id masks; NULL gives ''."""
    return _anonymize(text, _STRICT_PART, _STRICT_NUMBERS)


def anonymize_loose(text: Column) -> Column:
    """URL, e-mail, mention and any phone-like digit run; tax ids stay; NULL gives ''."""
    return _anonymize(text, _LOOSE_PART, _LOOSE_NUMBERS)
