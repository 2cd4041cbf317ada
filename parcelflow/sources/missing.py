"""Texts that stand for a missing value in landed files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default missing-value texts of the usual CSV readers.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

BLANKS = " \t\r\n"


def known_text(c: Column) -> Column:
    """The text, or NULL if it stands for a missing value."""
    return F.when(~c.isin(*MISSING_TEXTS), c)
