"""Pack paragraphs into chunks of bounded length, as one column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeflow.functions.text import built_once, split_literal, strip

SIZE, OVERLAP, SEPARATOR = 1000, 150, "\n\n"


#: Characters that Unicode never assigns: one that the text does not hold stands between paragraphs.
MARKS = ("\uFDD0", "\uFDD1")


@built_once
def chunks(text: str, size: int = SIZE, overlap: int = OVERLAP, separator: str = SEPARATOR) -> Column:
    """`array<string>` of chunks.

    Paragraphs are trimmed, empty ones dropped, and packed greedily, joined by
    a blank line, while the chunk stays within `size` characters. A paragraph
    longer than `size` becomes windows of `size` characters, each `size -
    overlap` after the one before, and is never merged with its neighbours.

    The most paragraphs that fit are the longest stretch of the joined text
    that ends where a paragraph does, so one pass of a regular expression cuts
    all chunks, in time linear in the text. Of texts that hold one of two code
    points that are not characters the other joins the paragraphs; in a text
    with both the second one counts as a blank line.
    """
    paragraphs = F.filter(F.transform(split_literal(F.col(text), separator), strip), lambda p: p != "")
    # One pass over the paragraph: look ahead `size` characters, move on by the
    # step. Cutting with substring would count from the start for every window.
    window = rf"(?s)(?=(.{{1,{size}}})).{{1,{size - overlap}}}"

    def packed(mark: str) -> Column:
        joined, joint = F.array_join(paragraphs, mark * 2), F.lit(mark * 2)
        stretch = rf"(?s)\G(?:{mark}{mark})?(.{{1,{size}}}(?={mark}{mark}|\z)|[^{mark}]++)"

        def cut(piece: Column) -> Column:
            whole = F.array(F.replace(piece, joint, F.lit("\n\n")))
            return F.when(F.length(piece) > size, F.regexp_extract_all(piece, F.lit(window), 1)).otherwise(whole)

        return F.flatten(F.transform(F.regexp_extract_all(joined, F.lit(stretch), 1), cut))

    return F.when(F.contains(F.col(text), F.lit(MARKS[0])), packed(MARKS[1])).otherwise(packed(MARKS[0]))
