"""String helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_replace(text: Column | str, pattern: str, replacement: str) -> Column:
    """Replace only the first match (Spark's ``regexp_replace`` replaces all)."""
    return F.regexp_replace(_col(text), f"(?s)^(?<head>.*?){pattern}", "${head}" + replacement)


def replace_all_text(text: Column | str, old: str, new: str = "") -> Column:
    """Literal replacement of every occurrence."""
    return F.replace(_col(text), F.lit(old), F.lit(new))


def capital(letter: Column) -> Column:
    """Upper case of one letter, always one letter ('ß' is 'ẞ', not 'SS')."""
    upper = F.upper(letter)
    return F.when(F.length(upper) > F.length(letter), F.translate(letter, "ß", "ẞ")).otherwise(upper)


def title_case(text: Column | str) -> Column:
    """Lower-case, then capitalise each space-separated word."""
    words = F.split(F.lower(_col(text)), " ")
    titled = F.transform(words, lambda w: F.concat(capital(F.substring(w, 1, 1)), F.substr(w, F.lit(2))))
    return F.array_join(titled, " ")


def blank_to_null(text: Column | str, longest_blank: int) -> Column:
    """NULL for text of at most ``longest_blank`` characters."""
    text = _col(text)
    return F.when(F.length(text) > longest_blank, text)


def canonical(text: Column | str, mapping: Mapping[str, str]) -> Column:
    """Translate known values, keep the others."""
    text = _col(text)
    out = None
    for old, new in mapping.items():
        branch = (text == old, F.lit(new))
        out = F.when(*branch) if out is None else out.when(*branch)
    return text if out is None else out.otherwise(text)
