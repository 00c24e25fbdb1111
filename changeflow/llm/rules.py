"""Quality rules, line first: bad lines go, then documents that lost too much. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed by the contract: white space, symbol characters, the words of a window, base limits.
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50

#: Phrases of page furniture, in lower case.
BOILERPLATE = (
    "javascript", "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "sign in", "log in", "click here", "read more", "subscribe", "share this", "back to top", "lorem ipsum",
    "datenschutzerklärung", "nutzungsbedingungen", "alle rechte vorbehalten", "hier klicken", "weiterlesen",
    "nach oben", "newsletter abonnieren", "impressum",
    "politique de confidentialité", "conditions d'utilisation", "tous droits réservés", "cliquez ici", "lire la suite",
    "haut de page", "s'abonner", "mentions légales",
    "política de privacidad", "política de cookies", "términos de uso", "todos los derechos reservados",
    "haga clic aquí", "leer más", "iniciar sesión", "aviso legal",
)
MARKS = r"[!?]{2}|[#*$%&]{2}"
BOILERPLATE_WORDS = 25  # longer lines that hold a phrase are prose about it

#: Of a document's word characters, the share that must stand in lines that pass. Set from the quality labels: of
#: documents that hold the base rules, good ones keep 0.93 or more and bad ones 0.6 or less; this is the middle.
KEPT_SHARE = 0.75


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once per row, also where `body` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def from_second(items: Column, start: int = 2) -> Column:
    return F.slice(items, F.lit(start), F.lit(1 << 30))


def words(text: Column) -> Column:
    """Words between ASCII white space; none for null and blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def repeated_words(items: Column) -> Column:
    """How many words stand in a window of three that occurs twice or more, first occurrences included.

    Windows are hashed and sorted with their positions, so equal ones are
    neighbours; the positions of those are sorted and each adds up to three
    words it does not share with the next one. n log n for any text.
    """

    def covered(positions: Column) -> Column:
        gaps = F.zip_with(
            positions, from_second(positions), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda n, gap: n + gap)

    def twins(ordered: Column) -> Column:
        def twin(x: Column, at: Column) -> Column:
            before, after = (F.get(ordered, at + step)["h"] for step in (-1, 1))
            return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

        return F.array_sort(F.transform(F.filter(ordered, twin), lambda x: x["i"]))

    def windows(w: Column) -> Column:
        two = F.zip_with(w, from_second(w), lambda a, b: F.xxhash64(a, b))
        three = F.zip_with(two, from_second(w, 3), lambda h, c: F.xxhash64(h, c))
        # The last two entries have no third word.
        return F.slice(three, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))

    def counted(hashed: Column) -> Column:
        placed = F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        found = let(F.sort_array(placed), lambda s: let(twins(s), covered))
        # Most texts repeat no window; to see that takes no sort.
        return F.when(F.size(F.array_distinct(hashed)) == F.size(hashed), F.lit(0).cast("long")).otherwise(found)

    return F.when(F.size(items) < 4, F.lit(0).cast("long")).otherwise(let(windows(items), counted))


def line_passes(line: Column) -> Column:
    """Punctuation, navigation and boilerplate rules on one line that holds a word.

    * punctuation: of the visible characters, at most a tenth are symbols, and
      at most one word in four ends in a doubled or symbol mark;
    * navigation: no list of short items between bars, arrows or bullets;
    * boilerplate: no short line with a phrase of page furniture;
    * shouting: no long line without a lower-case letter that has upper-case ones;
    * stuttering: at least a quarter of the words of a long line differ.
    """
    # What one look at the line rules out is not counted word by word.
    visible = F.length(F.regexp_replace(line, SPACE, F.lit("")))
    symbols = F.length(F.regexp_replace(line, r"[^#*$%&<>{}\\^~=_]", F.lit("")))
    symbolic = line.rlike(r"[#*$%&<>{}\\^~=_]") & (10 * symbols > visible)

    def by_words(w: Column) -> Column:
        n = F.size(w)
        marked = F.size(F.filter(w, lambda x: F.substring(x, -2, 2).rlike(MARKS)))
        bars = F.size(F.filter(w, lambda x: x.isin("|", "»", "›", "•", ">", ">>", "/")))
        navigation = line.rlike(r"[|»›•>/]") & let(bars, lambda b: (b >= 3) & (n <= 4 * b))
        stutter = (n >= 12) & (4 * F.size(F.array_distinct(w)) < n)

        def by_case(lower: Column) -> Column:
            phrase = F.lit(False)
            for p in BOILERPLATE:
                phrase = phrase | F.contains(lower, F.lit(p))
            shouting = (n >= 8) & (line != lower) & (line == F.upper(line))
            return ((n <= BOILERPLATE_WORDS) & phrase) | shouting

        return ~(symbolic | (line.rlike(MARKS) & (4 * marked > n)) | navigation | let(F.lower(line), by_case) | stutter)

    return let(words(line), by_words)


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the counts of the base rules, `clean_text` and the verdict `kept`.

    Null texts count as empty: no words, `base_failed`, an empty `clean_text`.
    `clean_text` holds the lines that pass, in order; `kept` says that the base
    rules hold and that those lines have at least `KEPT_SHARE` of the word
    characters. Every row gives a row; existing columns of these names are
    replaced. A projection: nothing is shuffled, whole texts are read.
    """
    added = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text", "kept",
    )
    # Own columns are numbered while the rules run, so no name of theirs can clash with a step's.
    own = docs.select("*", F.col(text).alias("_text")).toDF(*[f"_{i}" for i in range(len(docs.columns))], "_text")
    body = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # Arrays are made in a step of their own and used more than once behind it, so they are made once.
    out = own.withColumns({"_words": words(F.col("_text")), "_lines": lines})
    out = out.withColumn("_good", F.filter("_lines", line_passes))
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")),
            "clean_text": F.array_join("_good", "\n"),
            "_left": F.length(F.regexp_replace(F.array_join("_good", ""), SPACE, F.lit(""))),
        }
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    enough = F.col("_left") >= KEPT_SHARE * F.col("word_chars")
    out = out.withColumns({"base_failed": failed, "kept": ~failed & enough})
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns) if c not in added], *added)
