"""Writers for results and for lookup requests."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweather.operators.keys import distinct_names


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a Parquet directory, optionally laid out by columns for later pruning."""
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by or None)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Comma-separated files with a header; an existing target is an error by default.

    Spark's writer defaults apply: white space at the edges of a field is
    dropped, null is an empty field and an empty text is ``""``.
    """
    df.write.csv(path, header=True, mode=mode)


def write_unique_names(df: DataFrame, path: str, column: str = "festival_nom") -> None:
    """Distinct names of an event table, as CSV."""
    write_csv(distinct_names(df, column), path)


def export_address_batches(
    addresses: DataFrame, path: str, column: str = "full_address", batch_size: int = 1000
) -> None:
    """Addresses to resolve, as one-column CSV files of at most ``batch_size`` rows each."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    (
        addresses.select(F.col(column).alias("address"))
        .write.option("maxRecordsPerFile", batch_size)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path, header=True)
    )


def preview(df: DataFrame, order_by: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in a fixed order. A top-n: no full sort, nothing on the driver."""
    return df.orderBy(*order_by).limit(n)
