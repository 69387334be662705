"""String functions with the behaviour of Python's own (F-1 to F-5, E-1)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(s: Column) -> Column:
    """Cut white space of any kind from both ends."""
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def capitalize(s: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.left(s, F.lit(1))), F.lower(F.substr(s, F.lit(2))))


def first_char(s: Column) -> Column:
    """First character, NULL for an empty string."""
    return F.nullif(F.left(s, F.lit(1)), F.lit(""))


def title_case(s: Column) -> Column:
    """Upper-case every letter that follows a non-letter (``O'Neil``), as a JVM expression."""
    runs = F.regexp_extract_all(s, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, capitalize), "")


def is_palindrome(s: Column) -> Column:
    """Letters and digits only, case ignored; an empty text counts."""
    clean = F.lower(F.regexp_replace(s, r"[^\p{L}\p{N}]", ""))
    return clean == F.reverse(clean)


def keep_chars(s: Column, chars: str) -> Column:
    """Only the characters of the given set, in order."""
    return F.regexp_replace(s, "[^" + "".join("\\" + c if c in "\\]^-[&" else c for c in chars) + "]", "")


def person_line(name: Column, age: Column, grade: Column, city: Column) -> Column:
    """``name (age) - Grade g - city``."""
    return F.format_string("%s (%s) - Grade %s - %s", name, age.cast("string"), grade, city)
