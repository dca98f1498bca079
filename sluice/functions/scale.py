"""The compact "scale" text ``(q,v;q,v)``: a small table inside one cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def build_scale(*groups: Sequence[Column]) -> Column:
    """One text from groups of columns; null when any member is null."""
    parts: list[Column] = [F.lit("(")]
    for g, members in enumerate(groups):
        for m, member in enumerate(members):
            if m:
                parts.append(F.lit(","))
            elif g:
                parts.append(F.lit(";"))
            parts.append(member.cast("string"))
    return F.concat(*parts, F.lit(")"))


def _split(text: Column, separator: str) -> Column:
    """Members of a text.  Trailing empty members do not count, so a text of
    separators only has none; an empty text is one empty member."""
    kept = F.rtrim(text, F.lit(separator))
    none = F.array().cast("array<string>")
    return F.when((kept == "") & (text != ""), none).otherwise(F.split(kept, separator))


def _table(text: Column) -> Column:
    """The text as an array of segments, each an array of members.

    Only a text with an empty member at some end needs the careful split.
    """
    body = F.substring(text, F.lit(2), F.length(text) - 2)
    ragged = body.endswith(",") | body.endswith(";") | body.contains(",;")
    careful = F.transform(_split(body, ";"), lambda segment: _split(segment, ","))
    plain = F.transform(F.split(body, ";"), lambda segment: F.split(segment, ","))
    return F.when(ragged, careful).otherwise(plain)


def parse_scale(text: Column, children: Sequence[str]) -> Column:
    """Array of structs with the named children.  Missing members are null,
    surplus members are ignored, null text gives a null array."""

    def group(members: Column) -> Column:
        return F.struct(*[F.get(members, F.lit(k)).alias(name) for k, name in enumerate(children)])

    return F.transform(_table(text), group)


def missing_members(text: Column, width: int) -> Column:
    """How many children a text lacks over all its segments."""
    gaps = F.transform(_table(text), lambda m: F.greatest(F.lit(width) - F.size(m), F.lit(0)))
    return F.aggregate(gaps, F.lit(0), lambda total, n: total + n)
