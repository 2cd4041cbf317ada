"""Owner rules: business names, same owner, good sale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow.functions.text import contains_any

# Lower-case name endings that mark a company.
BUSINESS_MARKERS = (" inc", " llc", " ltd")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_business(owner: Column | str, markers: Sequence[str] = BUSINESS_MARKERS) -> Column:
    return contains_any(owner, markers)


def _words(name: Column, min_length: int) -> Column:
    return F.filter(F.split(name, r"\s+"), lambda word: F.length(word) >= min_length)


def same_owner(
    owner: Column | str, previous: Column | str, before_previous: Column | str, min_word: int = 4
) -> Column:
    """1 if the owner looks like the one before, or like the one before that.

    The test is not symmetric: the owner before the previous one may be contained in the current name,
    but not the other way round. A missing earlier owner never matches.
    """
    cur, prev, prev2 = (F.lower(_col(c)) for c in (owner, previous, before_previous))
    cur_words = _words(cur, min_word)
    like_previous = (
        F.contains(prev, cur) | F.contains(cur, prev) | F.arrays_overlap(cur_words, _words(prev, min_word))
    )
    like_earlier = F.contains(cur, prev2) | F.arrays_overlap(cur_words, _words(prev2, min_word))
    both_known = cur.isNotNull() & prev.isNotNull()
    return F.when(both_known & (like_previous | F.coalesce(like_earlier, F.lit(False))), 1).otherwise(0)


def good_sale(same: Column | str, price: Column | str) -> Column:
    """1 if ownership really changed and the price, when known, is positive."""
    value = _col(price)
    return F.when((_col(same) == 0) & (value.isNull() | (value > 0)), 1).otherwise(0)
