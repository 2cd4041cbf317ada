"""Text cleaning for identifiers, names and addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "missing" once a table has been written out as text.
MISSING_WORDS = ("nan", "nat", "none")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_left(c: Column | str, width: int, fill: str = "0") -> Column:
    """Pad to ``width``; longer text is left alone (``lpad`` alone would cut it)."""
    text = _col(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, fill)).otherwise(text)


def drop_spaces(c: Column | str) -> Column:
    return F.translate(_col(c), " ", "")


def normalize_id(c: Column | str) -> Column:
    """Identifier without its punctuation, so that two sources can be matched."""
    return F.translate(_col(c), "-.", "")


def build_key(parts: Sequence[tuple[Column | str, int]]) -> Column:
    """One key from zero-padded parts; missing as soon as one part is missing."""
    return drop_spaces(F.concat(*[pad_left(c, width) for c, width in parts]))


def title_case(c: Column | str) -> Column:
    """Capitalise after every non-letter, not only after blanks."""
    runs = F.regexp_extract_all(_col(c), F.lit(r"([\p{L}]+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def first_token(c: Column | str) -> Column:
    return F.split(F.btrim(_col(c), F.lit(" \t\r\n")), r"\s+")[0]


def contains_any(c: Column | str, markers: Sequence[str]) -> Column:
    """1 if the lower-cased text holds any marker, else 0; missing text gives 0."""
    lowered = F.lower(_col(c))
    hit = F.lit(False)
    for marker in markers:
        hit = hit | F.contains(lowered, F.lit(marker))
    return F.coalesce(hit, F.lit(False)).cast("int")


def mentions(c: Column | str, word: str) -> Column:
    """Case-insensitive containment; missing text does not mention anything."""
    return F.coalesce(F.contains(F.lower(_col(c)), F.lit(word.lower())), F.lit(False))


def clean_missing(c: Column | str) -> Column:
    text = _col(c)
    return F.when(~F.lower(text).isin(*MISSING_WORDS), text)


def id_part(c: Column | str, position: int, separator: str = "-") -> Column:
    """The ``position``-th part (from 1) of a separated identifier."""
    return F.split_part(_col(c), F.lit(separator), F.lit(position))
