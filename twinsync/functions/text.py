"""Spelled digits and payment-card numbers in text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words read as digits.
DIGIT_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")

# Word characters and digits of any script.
_WORD = r"[\p{L}\p{N}_]"
_DIGIT = r"\p{Nd}"
_START, _END = rf"(?<!{_WORD})", rf"(?!{_WORD})"

# The card formats, tried in this order: 13 to 16 digits with blanks or hyphens between
# them, 13 to 19 digits that start with 4, and six groups of four.
CARD_FORMATS = (
    rf"(?:{_DIGIT}[ -]*?){{13,16}}",
    rf"4{_DIGIT}{{12,18}}",
    rf"(?:{_DIGIT}{{4}}[- ]?){{5}}{_DIGIT}{{4}}",
)
MASK = "[REDACTED]"
_CARDS = rf"(?={_DIGIT}){_START}(?:{'|'.join(CARD_FORMATS)}){_END}"


def _spellings(word: str) -> tuple[str, str, str]:
    return word, word.upper(), word.capitalize()


def _one_word(word: str) -> str:
    """A digit word in one of its spellings.  The letters come first: they rule out most positions."""
    return rf"(?i:{word})(?<={'|'.join(_spellings(word))})(?<!{_WORD}.{{{len(word)}}}){_END}"


def _any_word() -> str:
    """Any digit word: its first letter, a word start before it, then the rest of the word."""
    rest: dict[str, list[str]] = {}
    for word in DIGIT_WORDS:
        for spelling in _spellings(word):
            rest.setdefault(spelling[0], []).append(spelling[1:])
    tails = "|".join(rf"(?<={first})(?:{'|'.join(tail)})" for first, tail in rest.items())
    return rf"[{''.join(rest)}](?<!{_WORD}.)(?:{tails}){_END}"


def digit_words(text: Column) -> Column:
    """Whole words zero to nine, in lower, upper or title case, become digits.

    One search per digit, and only in texts where a first search finds any digit word.
    """
    replaced = reduce(
        lambda c, digit: F.regexp_replace(c, _one_word(DIGIT_WORDS[digit]), str(digit)), range(len(DIGIT_WORDS)), text
    )
    return F.when(text.rlike(_any_word()), replaced).otherwise(text)


def redact_cards(text: Column) -> Column:
    """Card numbers become ``[REDACTED]``."""
    return F.regexp_replace(text, _CARDS, MASK)


def redact_text(text: Column) -> Column:
    """Spelled digits first, then card numbers, so that spelled numbers are masked as well."""
    return redact_cards(digit_words(text))
