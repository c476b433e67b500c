"""Text expressions: cleaning, blank test, normalising, message building."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Everything up to U+0020 is trimmed from a field.
_TRIMMED = "".join(chr(code) for code in range(0x21))
_FIRST_NOT_TRIMMED = "!"  # U+0021

# White space beyond that, which is not trimmed but leaves a field blank.
_WIDE_SPACE = (
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a"
    "\u2028\u2029\u205f\u3000"
)


def clean(text: Column) -> Column:
    """Field as the rules see it: trimmed, and never NULL.

    Rules that compare a NULL evaluate to NULL, and a NULL predicate drops the
    row from *both* halves of a split, so missing text becomes ``''`` here once.

    Most fields need no trimming; comparing their first and last character
    tells so at a fraction of the cost of trimming by a set of characters.
    """
    last = F.substring(text, -1, 1)
    padded = (text < _FIRST_NOT_TRIMMED) | (last < _FIRST_NOT_TRIMMED)
    return F.coalesce(
        F.when(padded, F.btrim(text, F.lit(_TRIMMED))).otherwise(text), F.lit("")
    )


def is_blank(cleaned: Column) -> Column:
    """Whether a ``clean`` field is empty or nothing but white space."""
    wide = (cleaned >= _WIDE_SPACE[0]) & (
        F.btrim(cleaned, F.lit(_TRIMMED + _WIDE_SPACE)) == ""
    )
    return (cleaned == "") | wide


def normalise(cleaned: Column) -> Column:
    """Category or key part of a ``clean`` field: trimmed, lower case, not NULL."""
    return F.lower(cleaned)


def message(template: str, *values: Column) -> Column:
    """``template`` with each ``{}`` replaced by a column; one ``concat``."""
    literals = template.split("{}")
    if len(literals) != len(values) + 1:
        raise ValueError(f"{template!r} takes {len(literals) - 1} values, got {len(values)}")
    parts: list[Column] = []
    for position, literal in enumerate(literals):
        if literal:
            parts.append(F.lit(literal))
        if position < len(values):
            parts.append(F.coalesce(values[position].cast("string"), F.lit("null")))
    return F.concat(*parts)


def render_row(label: str, fields: dict[str, str]) -> Column:
    """A row as text, ``Label(name=value, ...)``, for the reject log."""
    template = ", ".join(f"{name}={{}}" for name in fields)
    return message(f"{label}({template})", *[F.col(column) for column in fields.values()])


def truncate(text: Column, width: int) -> Column:
    return F.substring(text, 1, width)
