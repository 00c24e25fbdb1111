"""Cut a markdown body into its named sections, as one column expression.

A heading of level 1 or 2 outside a code fence opens a section that ends at the
next such heading; deeper headings belong to the text. Sections with an unknown
name are dropped, and of a repeated section the last non-empty one counts.

Fences follow the markdown rules: a fence is closed only by a line with the same
mark, at least as long and with nothing after it; an unclosed one runs to the
end of the body.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeflow.functions.text import WHITESPACE, built_once, heading_name, let, strip

# Normalised heading -> section.
SECTIONS = {
    "sintoma": "symptom",
    "evidencia": "evidence",
    "causa provavel": "cause",
    "proximo passo": "next_step",
}

_WS = f"[{re.escape(WHITESPACE)}]"
_BLANK = f"[{re.escape(WHITESPACE.replace(chr(10), ''))}]"
HEADING = rf"^{_WS}{{0,3}}#{{1,2}}{_WS}+(.+?){_WS}*$"
# A fence, its information (without a backtick behind backticks), and all up to the line that closes it or the end.
_FENCED = (
    r" {0,3}(?<run>(?<mark>[`~])\k<mark>{2,}+)(?:(?<=`)[^`\n]*+|(?<=~)[^\n]*+)(?=\n|\z)"
    rf"(?s:.*?)(?:\n {{0,3}}\k<run>\k<mark>*+{_BLANK}*+(?=\n|\z)|\z)"
)
BLOCK = rf"\G({_FENCED}|[^\n]*)(?:\n|\z)"


def section_of(heading: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in SECTIONS.items() for x in pair])
    return F.try_element_at(lookup, heading_name(heading))


def blocks(body: Column) -> Column:
    """The lines of a body, each fenced block as one entry; joined by line feeds they are the body.

    One pass of a regular expression, so no state is carried from line to line.
    """
    return F.regexp_extract_all(body, F.lit(BLOCK), 1)


def headings(body_blocks: Column) -> Column:
    """`array<struct<at: int, name: string>>` of level 1-2 headings among the blocks; a fenced block is none."""
    found = F.transform(
        body_blocks,
        lambda b, i: F.when(
            b.rlike(HEADING), F.struct(i.alias("at"), F.regexp_extract(b, HEADING, 1).alias("name"))
        ),
    )
    return F.array_compact(found)


@built_once
def sections(body: str) -> Column:
    """`array<struct<section, text>>`, at most one entry per known section."""

    def between(bs: Column, heads: Column) -> Column:
        def cut(h: Column, i: Column) -> Column:
            end = F.coalesce(F.get(heads, i + 1)["at"], F.size(bs))
            text = strip(F.array_join(F.slice(bs, h["at"] + 2, end - h["at"] - 1), "\n"))
            return F.struct(section_of(h["name"]).alias("section"), text.alias("text"))

        cuts = F.filter(
            F.transform(heads, cut), lambda c: c["section"].isNotNull() & (c["text"] != "")
        )

        def last_of(found: Column, section: str) -> Column:
            return F.try_element_at(F.filter(found, lambda c: c["section"] == section), F.lit(-1))

        def last(found: Column) -> Column:
            return F.array_compact(F.array(*[last_of(found, s) for s in SECTIONS.values()]))

        return let(cuts, last)

    return let(blocks(F.col(body)), lambda bs: let(headings(bs), lambda heads: between(bs, heads)))
