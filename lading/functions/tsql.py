"""Column helpers that follow SQL Server's string rules where Spark's differ.

Each takes and returns Columns made of built-in functions, so everything stays
inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_BINARY = "UTF8_BINARY"
_LOWERCASE = "UTF8_LCASE"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_blank(*parts: Column | str) -> Column:
    """Concatenation in which NULL counts as the empty string."""
    return F.concat(*[F.coalesce(col(p), F.lit("")) for p in parts])


def trimmed_length(c: Column | str) -> Column:
    """Length without trailing spaces."""
    return F.length(F.rtrim(col(c)))


def has_digit(c: Column | str) -> Column:
    return F.rlike(col(c), F.lit("[0-9]"))


def drop_padding_zero(c: Column | str) -> Column:
    """Delete the first ``0`` that stands before another digit ("COLOMBO 03" -> "COLOMBO 3")."""
    text = col(c)
    without = F.regexp_replace(text, "(?s)^(.*?)0([0-9])", "$1$2")
    return F.when(F.contains(text, F.lit("0")), without).otherwise(text)


def drop_trailing_comma(c: Column | str) -> Column:
    """Without one trailing comma; the empty string becomes NULL."""
    text = col(c)
    shorter = F.substr(text, F.lit(1), F.length(text) - 1)
    return F.when(F.endswith(text, F.lit(",")), shorter).when(text != "", text)


def delete_chars(c: Column | str, chars: str) -> Column:
    # One replace per character works on the bytes and beats a translation table.
    text = col(c)
    for char in chars:
        text = F.replace(text, F.lit(char))
    return text


def replace_all(
    c: Column | str, search: Column | str, by: Column | str, case_sensitive: bool = True
) -> Column:
    """Replace every occurrence; an empty ``search`` changes nothing.

    Strings given as ``search`` and ``by`` are literals.
    """
    search = F.lit(search) if isinstance(search, str) else search
    by = F.lit(by) if isinstance(by, str) else by
    if case_sensitive:
        return F.replace(col(c), search, by)
    folded = F.replace(
        F.collate(col(c), _LOWERCASE), F.collate(search, _LOWERCASE), F.collate(by, _LOWERCASE)
    )
    return F.collate(folded, _BINARY)


def equals(c: Column | str, value: str, case_sensitive: bool = True) -> Column:
    """Equality with a literal, ignoring trailing spaces.

    In the case-sensitive form the redundant prefix test is what Parquet can
    evaluate on its row-group statistics.
    """
    if case_sensitive:
        return F.startswith(col(c), F.lit(value)) & (F.rtrim(col(c)) == F.lit(value))
    return F.lower(F.rtrim(col(c))) == F.lit(value.lower())


def is_one_of(c: Column | str, values: tuple[str, ...], case_sensitive: bool = True) -> Column:
    matches = [equals(c, value, case_sensitive) for value in values]
    return reduce(lambda a, b: a | b, matches)


def last_part(c: Column | str, separator: str = ",") -> Column:
    """From the last separator to the end, separator included (input must contain it)."""
    return F.concat(F.lit(separator), F.substring_index(col(c), separator, -1))


def head_word(c: Column | str) -> Column:
    """Trimmed text before the first space; empty when there is no space."""
    return F.trim(F.substr(col(c), F.lit(1), F.locate(" ", col(c))))


def tail_words(c: Column | str) -> Column:
    """Trimmed text after the first space; everything when there is no space."""
    # Spark reads start position 0 as 1, which is the wanted "no space" case.
    return F.trim(F.substr(col(c), F.locate(" ", col(c))))
