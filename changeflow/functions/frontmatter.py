"""Front matter and body of a markdown document, as one column expression.

The front matter is kept as an array of `(key, is_list, vals)` in file order. A
repeated key occurs repeatedly; look-ups take the last one. Rules that are easy
to get wrong:

* it exists only if the first line is `---`; without a closing `---` it runs to
  the end of the file and the body is empty;
* a line starting with `- ` is a list item even if it holds a colon, and counts
  only below a key with an empty value;
* a line with neither an item mark nor a colon is ignored and closes nothing;
* `key: []` is an empty list that takes no items.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeflow.functions.text import (
    ENTRY_MARK,
    RARE_BREAK,
    WHITESPACE,
    built_once,
    from_index,
    let,
    plain_breaks,
    split_literal,
    strip,
    unquote,
)

RULE = "---"
ITEM = "- "

_ENTRY = "struct<key:string,is_list:boolean,vals:array<string>>"


def _entry(chunk: Column) -> Column:
    """One key line followed by its item lines -> one entry."""

    def build(parts: Column) -> Column:
        head = F.get(parts, F.lit(0))
        colon = F.instr(head, ":")
        key = strip(F.substring(head, F.lit(1), colon - 1))
        items = F.transform(from_index(parts, 2), lambda p: unquote(F.substring(p, F.lit(3), F.length(p))))

        def with_value(value: Column) -> Column:
            vals = (
                F.when(value == "", items)
                .when(value == "[]", F.array().cast("array<string>"))
                .otherwise(F.array(unquote(value)))
            )
            return F.struct(
                key.alias("key"), value.isin("", "[]").alias("is_list"), vals.alias("vals")
            )

        return let(strip(F.substring(head, colon + 1, F.length(head))), with_value)

    return let(F.split(chunk, "\n"), build).cast(_ENTRY)


def _entries(stripped: Column) -> Column:
    """Trimmed front matter lines -> entries.

    Key lines are prefixed with a mark no line can hold, item lines with a line
    feed. Joining and cutting at the mark then groups items under their key.
    """
    kept = F.filter(stripped, lambda l: F.startswith(l, F.lit(ITEM)) | F.contains(l, F.lit(":")))
    marked = F.transform(
        kept,
        lambda l: F.when(F.startswith(l, F.lit(ITEM)), F.concat(F.lit("\n"), l)).otherwise(
            F.concat(F.lit(ENTRY_MARK), l)
        ),
    )
    # The piece before the first mark holds items that belong to no key.
    chunks = from_index(split_literal(F.array_join(marked, ""), ENTRY_MARK), 2)
    return F.transform(chunks, _entry)


# White space inside a line, and the header up to and including its closing
# rule. The reluctant `??` lets an empty header end at the very next line.
_WS = "[" + "".join(c for c in WHITESPACE if not re.match(f"\n|{RARE_BREAK}", c)) + "]*"
_OPENED = rf"\A{_WS}---{_WS}(?:\n|\z)"
_CLOSED = rf"(?s)\A{_WS}---{_WS}\n(?:.*?\n)??{_WS}---{_WS}(?:\n|\z)"
_FROM_HEADING = rf"(?dms)^{_WS}#.*"


def _fields(head: Column) -> Column:
    """Header text, rules included -> entries."""

    def between(trimmed: Column) -> Column:
        close = F.array_position(from_index(trimmed, 2), RULE).cast("int")
        end = F.when(close > 0, close - 1).otherwise(F.size(trimmed))
        return _entries(F.slice(trimmed, F.lit(2), end))

    return let(F.transform(F.split(head, "\n"), strip), between)


def _body(rest: Column) -> Column:
    """From the first heading line on; everything if there is none."""
    headed = F.regexp_extract(rest, _FROM_HEADING, 0)
    return let(headed, lambda h: strip(F.when(h != "", h).otherwise(rest)))


@built_once
def parse_document(content: str) -> Column:
    """`struct<fm: array<entry>, body: string>` of the named text column.

    Only the header is cut into lines; the body is found with one pattern, so a
    long text is scanned but never taken apart here.
    """

    def split_at(text: Column, header: Column) -> Column:
        closed, opened = header != "", text.rlike(_OPENED)
        head = F.when(closed, header).when(opened, text).otherwise("")
        rest = (
            F.when(closed, F.substring(text, F.length(header) + 1, F.length(text)))
            .when(opened, "")
            .otherwise(text)
        )
        return F.struct(_fields(head).alias("fm"), let(rest, _body).alias("body"))

    return let(
        plain_breaks(F.col(content)),
        lambda text: let(F.regexp_extract(text, _CLOSED, 0), lambda header: split_at(text, header)),
    )


def value(fm: Column, key: str) -> Column:
    """The last entry of a key, null where the key is absent."""
    return F.try_element_at(F.filter(fm, lambda e: e["key"] == key), F.lit(-1))


def text(entry: Column) -> Column:
    """The text of a scalar entry; null for lists and absent keys."""
    return F.when(~entry["is_list"], F.get(entry["vals"], F.lit(0)))


def last_wins(fm: Column) -> Column:
    """Entries with only the last occurrence of each key, sorted by key."""

    def keep_last(ordered: Column) -> Column:
        follower = lambda i: F.get(ordered, i + 1)["key"]
        return F.filter(ordered, lambda e, i: ~e["key"].eqNullSafe(follower(i)))

    numbered = F.transform(
        fm, lambda e, i: F.struct(e["key"].alias("key"), i.alias("pos"), e["is_list"].alias("is_list"), e["vals"].alias("vals"))
    )
    return let(F.array_sort(numbered), keep_last)
