"""Text cleaning and tokenizing as column expressions.

Everything here runs inside the JVM on one row at a time, so it never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyrank.functions import entities

# The stopword list.
STOPWORDS = (
    "i", "me", "my", "a", "an", "the", "and", "or", "but", "are",
    "is", "was", "to", "of", "in", "it", "its", "this", "that",
    "for", "on", "at", "be", "by", "as", "up", "do", "so", "if", "s",
)

TOKENIZERS = ("normalize", "whitespace")

# A tag never spans a line feed. The class form is used because Java's "." also stops at
# other line terminators.
_TAG_OR_NBSP = r"<[^>\n]*>|&nbsp;"

_NOT_ALNUM = "[^a-z0-9]+"

# The characters Python's str.split() treats as whitespace.
_WHITESPACE = (
    r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _text(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.lit(""))


def html_unescape(col: Column | str) -> Column:
    """Replace HTML character references."""
    return entities.unescape(_text(col))


def strip_tags(col: Column | str) -> Column:
    return F.regexp_replace(_text(col), _TAG_OR_NBSP, " ")


def is_kept(token: Column) -> Column:
    """True for a token that is neither empty nor a stopword."""
    return (token != "") & ~token.isin(*STOPWORDS)


def raw_tokens(col: Column | str) -> Column:
    """Lower-case alphanumeric tokens, stopwords removed, order and repeats kept."""
    return F.filter(F.split(F.lower(_text(col)), _NOT_ALNUM), is_kept)


def whitespace_tokens(col: Column | str) -> Column:
    """Lower-case tokens split on whitespace only: punctuation and stopwords stay."""
    return F.filter(F.split(F.lower(_text(col)), _WHITESPACE), lambda t: t != "")


def tokens(col: Column | str, tokenizer: str = "normalize") -> Column:
    if tokenizer == "normalize":
        return raw_tokens(col)
    if tokenizer == "whitespace":
        return whitespace_tokens(col)
    raise ValueError(f"unknown tokenizer {tokenizer!r}, expected one of {TOKENIZERS}")


def join_tokens(col: Column | str) -> Column:
    return F.array_join(col, " ")


def normalized_text(col: Column | str) -> Column:
    """The tokens of ``raw_tokens`` joined by one space."""
    return join_tokens(raw_tokens(col))


def clean_text(col: Column | str, unescape: bool = True) -> Column:
    """Unescape HTML, strip tags, then normalize; returns one string per row."""
    text = html_unescape(col) if unescape else _text(col)
    return normalized_text(strip_tags(text))
