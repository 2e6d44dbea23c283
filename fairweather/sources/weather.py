"""Daily weather files."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def read_weather_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Semicolon-separated weather with a header, as text (see ``parse_weather`` for numbers).

    Columns differ between files, and a CSV scan takes its columns from one
    header, so give each group of like files its own path: the groups are
    united by column name.
    """
    reader = spark.read.option("header", True).option("sep", ";").option("encoding", "UTF-8")
    return union_weather([reader.csv(path) for path in paths])


def union_weather(frames: list[DataFrame]) -> DataFrame:
    """Union by name: absent columns become null, columns keep the order they first appear in."""
    if not frames:
        raise ValueError("no weather to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
