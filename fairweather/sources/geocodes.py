"""Landed answers of a batch geocoder."""

from pyspark.sql import DataFrame, SparkSession


def read_geocode_results(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated answers with a header, all text.

    Expected columns: the address that was asked for (``full_address``), then
    ``latitude, longitude, result_score, result_status``. The address has to be
    in the file: it is what the answers are joined on.
    """
    return spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
