"""Written tables in the shared folder, rows packed out of the way of working columns, numbering without one task."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.checkpoints import ensure_checkpoint_dir

#: Text that a task cuts into words at a time; a longer single text is taken whole.
PIECE_BYTES = 4 << 20
#: Stands for a missing id where ids are compared: after all others.
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the one that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder.

    A lost executor costs its tasks and nothing that was written before. The table stays until the folder of
    ``spark.checkpoint.dir`` is emptied, because frames that read it may be used at any later time.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_id(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST_ID))


def mapped(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``function`` over the Arrow batches of ``df``; each makes any number of batches."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(over, schema)


def slices_for(rows: int) -> int:
    """A power of two near the square root: neither the slices nor the rows of one grow with the table alone."""
    return 1 << max(0, math.ceil(math.log2(max(1.0, math.sqrt(rows)))))


def running(df: DataFrame, group: Sequence[str], spread: Column, order: Sequence[str], weight: Column, name: str) -> DataFrame:
    """Add the sum of ``weight`` over the rows before each row of its group, as ``name``.

    ``spread`` is an even 64-bit hash of a row; a group is ordered by its top bits and then by ``order``. The slices
    that the top bits name are summed first, so a window holds one slice and never a whole group, and the window over
    slices holds one row for each slice of a group. ``df`` is read twice: hand in a written table. The columns of
    ``group`` must not be null.
    """
    slices = slices_for(df.count())
    bits = int(math.log2(slices))
    sliced = df.withColumn("_slice", F.shiftrightunsigned(spread, 64 - bits) if bits else F.lit(0).cast("long"))
    keys = [*group, "_slice"]
    inside = sliced.groupBy(*keys).agg(F.sum(weight).alias("_inside"))
    earlier = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    before = inside.select(*keys, F.coalesce(F.sum("_inside").over(earlier), F.lit(0)).cast("long").alias("_before"))
    here = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    total = F.col("_before") + F.coalesce(F.sum(weight).over(here), F.lit(0)).cast("long")
    return sliced.join(before, keys).withColumn(name, total).drop("_before", "_slice")
