"""Scalar text expressions (all JVM-side built-ins, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recsift.functions.stopwords import ENGLISH

# Fixed values that must equal the reference's behaviour:
#   genre separator "|", year pattern "(dddd)" at the very end of a title,
#   tokens = runs of two or more letters, digits or underscores (lower-cased),
#   liked threshold 4.0, genome relevance threshold 0.5 (strict).
GENRE_SEPARATOR = "|"
YEAR_PATTERN = r".*\((\d{4})\)$"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def split_genres(raw: Column) -> Column:
    """``'A|B'`` -> ``['A', 'B']``."""
    return F.split(raw, r"\|")


def year_from_title(title: Column) -> Column:
    """Trailing ``(dddd)`` as INT, else NULL (a trailing blank gives NULL)."""
    return F.when(title.rlike(YEAR_PATTERN),
                  F.regexp_extract(title, YEAR_PATTERN, 1).cast("int"))


def join_words(arr: Column) -> Column:
    """List joined by blanks; NULL elements skipped, NULL list -> ''."""
    return F.coalesce(F.array_join(arr, " "), F.lit(""))


def concat_blank(*cols: Column) -> Column:
    """Pieces joined by single blanks, NULL pieces skipped."""
    return F.concat_ws(" ", *cols)


def tokens(text: Column) -> Column:
    """Lower-cased tokens of two or more word characters, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def english_stop_words() -> tuple[str, ...]:
    """Spark ML's default English stop-word list, held as text (no JVM needed)."""
    return ENGLISH


def contains_ci(text: Column, needle: str, regex: bool = False) -> Column:
    """Case-insensitive literal containment (or regex when asked)."""
    if regex:
        # Case-insensitive flag rather than lower-casing the pattern, which
        # would change escapes such as \D or \S.
        return text.rlike("(?i)" + needle)
    return F.lower(text).contains(needle.lower())
