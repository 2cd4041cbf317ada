"""Fixed-width text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.sources.delimited import typed
from parcelflow.sources.layouts import ENCODING, Field
from parcelflow.sources.missing import BLANKS

LINE = "line"


#: Encodings of one byte a character. Others are cut as UTF-32, which has four for each.
ONE_BYTE = ("ISO-8859-1", "US-ASCII")


def cut_fields(
    df: DataFrame, line: str, layout: Sequence[Field], columns: Sequence[str] | None = None, encoding: str = "UTF-32"
) -> DataFrame:
    """One column per field of the layout. Fields that are not selected later are never cut.

    The line is cut as bytes of an encoding in which every character has the same size, so that a field begins at a
    known byte and nobody counts characters. ``encoding`` must hold all characters of the line. A byte order mark at the start of a field is left out. Texts are cut in one
    projection and typed in the next, because a type is made of a text that is looked at several times.
    """
    encoding, size = (encoding, 1) if encoding in ONE_BYTE else ("UTF-32", 4)
    chosen = [f for f in layout if columns is None or f.name in columns]

    def text(field: Field) -> Column:
        if field.width == 0:
            return F.lit(None).cast("string").alias(field.name)
        cut = F.decode(F.substring("_bytes", (field.start - 1) * size + 1, field.width * size), encoding)
        return F.btrim(F.trim(cut), F.lit(BLANKS)).alias(field.name)  # spaces first, which is quicker

    texts = df.select(F.encode(line, encoding).alias("_bytes")).select(*[text(f) for f in chosen])
    return texts.select(*[typed(F.col(f"`{f.name}`"), f.type).alias(f.name) for f in chosen])


def read_lines(spark: SparkSession, path: str | list[str], encoding: str = ENCODING) -> DataFrame:
    """Whole lines in the given encoding, blanks and quotes untouched.

    Reads CSV with a separator that text files do not hold, because the plain text reader cannot decode
    anything but UTF-8. Files stay splittable.
    """
    options = {
        "sep": "\x01",
        "quote": "",
        "escape": "",
        "encoding": encoding,
        "header": False,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "maxCharsPerColumn": -1,
    }
    return spark.read.options(**options).schema(f"{LINE} string").csv(path)


def read_fixed_width(
    spark: SparkSession,
    path: str | list[str],
    layout: Sequence[Field],
    encoding: str = ENCODING,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    return cut_fields(read_lines(spark, path, encoding), LINE, layout, columns, encoding)
