"""HTML character references as column expressions, with the rules of HTML 5.

A text is split at ``&``. What follows each one is looked at by itself: a number becomes its
character, a name with its semicolon is looked up whole, and otherwise the longest name that
may stand without a semicolon is replaced. The tables of names and of special numbers are
those of Python's standard library, read from there.
"""

from __future__ import annotations

import html
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_CLOSED = {name: text for name, text in html5.items() if name.endswith(";")}
_OPEN = {name: text for name, text in html5.items() if not name.endswith(";")}

_DECIMAL = "^#([0-9]+);?"
_HEX = "^#[xX]([0-9a-fA-F]+);?"
_NAMED = "^([A-Za-z][A-Za-z0-9]{0,30};)"
_PREFIX = "^(" + "|".join(sorted(_OPEN, key=len, reverse=True)) + ")"

# Code points of one byte, of which some stand for others, and the noncharacters of HTML 5.
_SPECIAL = {n: html.unescape(f"&#{n};") for n in range(0xA0)}
_SPECIAL |= {n: "" for n in range(0xFDD0, 0xFDF0)}
_SPECIAL |= {plane << 16 | low: "" for plane in range(17) for low in (0xFFFE, 0xFFFF)}


def _sql(value) -> str:
    if isinstance(value, dict):
        return "map(" + ", ".join(f"{_sql(k)}, {_sql(v)}" for k, v in value.items()) + ")"
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _by_first(pairs: dict[str, str]) -> dict[str, dict[str, str]]:
    """The table in parts by first letter, since a map is searched from its start."""
    parts: dict[str, dict[str, str]] = {}
    for key, text in pairs.items():
        parts.setdefault(key[0], {})[key] = text
    return parts


# As SQL text a table is one call to build and is folded into one literal.
_CLOSED_SQL, _OPEN_SQL = _sql(_by_first(_CLOSED)), _sql(_by_first(_OPEN))
_SPECIAL_SQL = _sql(_SPECIAL)


def _lookup(table: str, name: Column) -> Column:
    return F.expr(table)[F.left(name, F.lit(1))][name]


def _from_number(number: Column) -> Column:
    """The character of a code point; beyond Unicode and for surrogates the replacement."""
    packed = F.unhex(F.lpad(F.hex(number), 8, "0"))
    wrong = (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    special = F.expr(_SPECIAL_SQL)[number]
    return F.when(wrong, F.lit("�")).otherwise(
        F.coalesce(special, F.decode(packed, "UTF-32"))
    )


def _digits(part: Column, pattern: str, longest: int) -> Column:
    """The digits of a number without leading zeros; too many stand for a number too large."""
    digits = F.regexp_replace(F.regexp_extract(part, pattern, 1), "^0+", "")
    return F.when(F.length(digits) > longest, F.lit("9" * longest)).otherwise(digits)


def _replace(part: Column) -> Column:
    decimal = F.regexp_extract(part, _DECIMAL, 0)
    hexadecimal = F.regexp_extract(part, _HEX, 0)
    named = F.regexp_extract(part, _NAMED, 1)
    prefix = F.regexp_extract(part, _PREFIX, 1)

    def rest(found: Column) -> Column:
        return F.substring(part, F.length(found) + 1, F.length(part))

    number = F.concat(F.lit("0"), _digits(part, _DECIMAL, 8)).cast("int")
    hex_number = F.conv(F.concat(F.lit("0"), _digits(part, _HEX, 7)), 16, 10).cast("int")
    whole = F.when(named != "", _lookup(_CLOSED_SQL, named))
    return (
        F.when(decimal != "", F.concat(_from_number(number), rest(decimal)))
        .when(hexadecimal != "", F.concat(_from_number(hex_number), rest(hexadecimal)))
        .when(whole.isNotNull(), F.concat(whole, rest(named)))
        .when(prefix != "", F.concat(_lookup(_OPEN_SQL, prefix), rest(prefix)))
        .otherwise(F.concat(F.lit("&"), part))
    )


def unescape(text: Column) -> Column:
    """``text`` with its character references replaced, as ``html.unescape`` does."""
    parts = F.split(text, "&", -1)
    first = F.element_at(parts, 1)
    rest = F.transform(F.slice(parts, 2, F.size(parts)), _replace)
    return F.when(F.contains(text, F.lit("&")), F.concat(first, F.array_join(rest, ""))).otherwise(
        text
    )
