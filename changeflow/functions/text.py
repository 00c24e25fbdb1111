"""Text column helpers: trimming, line splitting, quoting, heading names.

All of them are built-in expressions, so parsing stays inside the JVM and adds
no shuffle. Two rules hold throughout:

* white space means what Unicode says, not only the space character;
* a lambda must never mention an expensive outer expression, because it would
  be evaluated again for every element. `let` binds such a value once.
"""

from __future__ import annotations

import functools
import operator
import re
import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Separators besides the line feed that can end a text line. None of them
# occurs inside a line, which makes ENTRY_MARK safe as a joiner for lines.
RARE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
RARE_BREAK = f"[{RARE_BREAKS}]"
ENTRY_MARK = "\x1e"

QUOTE, BACKSLASH = '"', "\\"


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Keep the expression built for given column names and parameters.

    A parser is hundreds of expression nodes; building one costs more than
    planning it.
    """
    return functools.lru_cache(maxsize=None)(build)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated exactly once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unpacked(struct: Column) -> Column:
    """Generator for the fields of a struct, computed once per row.

    A select would let Spark copy the expression into every filter and column
    that uses a field of it. Nothing is pushed below a generator.
    """
    return F.inline(F.array(struct))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITESPACE))


def plain_breaks(text: Column) -> Column:
    """The text with a line feed for every kind of line break.

    Bytes are searched for each break first: a pattern would decode the whole text and try its class at every character.
    """
    rare = F.regexp_replace(text, f"\r\n|{RARE_BREAK}", "\n")
    found = functools.reduce(operator.or_, [F.contains(text, F.lit(b)) for b in RARE_BREAKS])
    return F.when(found, rare).otherwise(text)


def normalise_newlines(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


def split_literal(text: Column, separator: str) -> Column:
    """Split on the separator as it stands, not as a pattern."""
    return F.split(text, re.escape(separator))


def from_index(items: Column, start: int) -> Column:
    """The array from 1-based `start` to its end, without evaluating it twice."""
    return F.slice(items, F.lit(start), F.lit(1 << 30))


def unescape(text: Column) -> Column:
    r"""Undo `\\ \" \n \t \r` in one left-to-right pass; other pairs stay.

    Cutting at every doubled backslash first leaves pieces in which no
    backslash is escaped, so the remaining pairs cannot be misread.
    """

    def piece(part: Column) -> Column:
        for mark, char in ((QUOTE, QUOTE), ("n", "\n"), ("t", "\t"), ("r", "\r")):
            part = F.replace(part, F.lit(BACKSLASH + mark), F.lit(char))
        return part

    parts = split_literal(text, BACKSLASH * 2)
    return F.when(
        F.contains(text, F.lit(BACKSLASH)), F.array_join(F.transform(parts, piece), BACKSLASH)
    ).otherwise(text)


def unquote(text: Column) -> Column:
    """Strip, then drop one pair of outer double quotes and unescape inside."""

    def inner(s: Column) -> Column:
        quoted = (F.length(s) >= 2) & F.startswith(s, F.lit(QUOTE)) & F.endswith(s, F.lit(QUOTE))
        return F.when(quoted, unescape(F.substring(s, F.lit(2), F.length(s) - 2))).otherwise(s)

    return let(strip(text), inner)


def quote(text: Column) -> Column:
    """Inverse of `unquote`. The backslash has to be doubled first."""
    for char, mark in ((BACKSLASH, BACKSLASH), (QUOTE, QUOTE), ("\n", "n"), ("\t", "t"), ("\r", "r")):
        text = F.replace(text, F.lit(char), F.lit(BACKSLASH + mark))
    return F.concat(F.lit(QUOTE), text, F.lit(QUOTE))


def _decompositions() -> tuple[dict[str, str], dict[str, str]]:
    """What compatibility decomposition, marks removed, makes of single characters: one letter, or none or several."""
    one, several = {}, {}
    for code in [*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1)]:
        char = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if plain != char and not (0xAC00 <= code <= 0xD7A3 or unicodedata.category(char) == "Mn"):
            (one if len(plain) == 1 else several)[char] = plain
    return one, several


_ONE, _SEVERAL = _decompositions()
_HANGUL = (0x1100, 0x1161, 0x11A7)  # first jamo of each kind; syllables are composed of them by rule
_SYLLABLE = r"[\x{AC00}-\x{D7A3}]"


def _syllable(char: Column) -> Column:
    """The two or three jamo of a Hangul syllable."""
    n = F.conv(F.hex(F.encode(char, "UTF-16BE")), 16, 10).cast("int") - 0xAC00
    lead, vowel, tail = (F.floor(n / 588), F.floor(n % 588 / 28), n % 28)

    def jamo(first: int, step: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(F.lit(first) + step.cast("int")), 4, "0")), "UTF-16BE")

    l, v, t = _HANGUL
    return F.concat(jamo(l, lead), jamo(v, vowel), F.when(tail > 0, jamo(t, tail)).otherwise(""))


def _expanded(text: Column) -> Column:
    """Characters that decompose into several letters, such as ligatures, letter by letter."""
    # One literal that Spark folds into a map; a call per entry would make every plan slow to build.
    table = F.str_to_map(F.lit("\x02".join(f"{c}\x01{v}" for c, v in _SEVERAL.items())), F.lit("\x02"), F.lit("\x01"))

    def letters(c: Column) -> Column:
        plain = c.rlike(r"[\x00-\x7F]")
        syllable = (c >= chr(0xAC00)) & (c <= chr(0xD7A3))
        return F.when(plain, c).when(syllable, _syllable(c)).otherwise(F.coalesce(F.try_element_at(table, c), c))

    return F.array_join(F.transform(F.split(text, ""), letters), "")


@functools.cache
def _singles() -> tuple[str, str]:
    return "".join(_ONE), "".join(_ONE.values())


def without_accents(text: Column) -> Column:
    """Compatibility decomposition without marks: accents go, ligatures and styled letters become plain ones."""

    def mapped(value: Column) -> Column:
        return F.translate(value, *_singles())

    def whole(unmarked: Column, plain: Column) -> Column:
        # By look-ups: a class of so many characters would be tried one by one at each character.
        several = text.rlike(_SYLLABLE) | (F.translate(text, "".join(_SEVERAL), "") != text)
        # A character of several letters is in no map of single ones, so it is still there: ASCII is done.
        done = F.length(plain) == F.octet_length(plain)
        return F.when(done, plain).when(several, mapped(_expanded(unmarked))).otherwise(plain)

    # Most headings are ASCII, and hardly any needs more than a character map.
    unmarked = F.regexp_replace(text, r"\p{Mn}+", "")
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(
        let(unmarked, lambda u: let(mapped(u), lambda plain: whole(u, plain)))
    )


def heading_name(text: Column, plain: Callable[[Column], Column] = without_accents) -> Column:
    """Heading text for lookup: no accents or case, one trailing `s` off each word.

    `plain` is a parameter so that a full decomposition can be plugged in.
    """
    ws = f"[{re.escape(WHITESPACE)}]+"
    words = F.split(strip(F.lower(plain(text))), ws)
    return F.array_join(
        F.transform(F.filter(words, lambda w: w != ""), lambda w: F.regexp_replace(w, "s$", "")), " "
    )
