"""Gapless numbers within groups of any size, without a task per group."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PART = "_part"


def number_rows(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Number the rows of each group from 0, without gaps, in a column ``name``.

    ``rows`` has a column ``_part`` that splits every group into pieces that one
    task can sort; the writing task's number does. It must be a written table:
    a row has to keep its piece when a lost task runs again. Null is a group. The numbers follow
    the piece and then ``order``. Only one count per group and piece is summed
    over a whole group. ``_part`` is dropped.
    """
    piece = [*group, PART]
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*piece)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            *[F.col(c).alias(f"_of_{c}") for c in piece],
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in piece))
    within = F.row_number().over(Window.partitionBy(*piece).orderBy(*order)) - 1
    return (
        rows.withColumn("_within", within)
        .join(offsets, same)
        .withColumn(name, (F.col("_before") + F.col("_within")).cast("bigint"))
        .drop(PART, "_before", "_within", *[f"_of_{c}" for c in piece])
    )
