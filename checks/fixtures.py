"""The input shapes of the library, derived by Spark from the provided tables.

``FIXTURES.md`` specifies the four views; ``oracles.py`` holds the same
specification as DuckDB SQL, written apart from this.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

AS_OF = dt.datetime(2026, 12, 1)

# The most line items, about, that a task groups: they are nearly as many station days.
ROWS_PER_TASK = 250_000


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table. Its schema is inferred once per process: each inference is a job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").join(
        # 25 rows at every scale
        F.broadcast(table(spark, sf_dir, "nation")),
        F.col("c_nationkey") == F.col("n_nationkey"),
    )
    postal_code = (F.lit(10000) + F.col("c_nationkey")).cast("string")
    return customers.withColumn(
        "postal_code", F.when(F.col("c_custkey") % 10 != 0, postal_code)
    )


def declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "dd-MM-yyyy")
    events = table(spark, sf_dir, "orders").join(
        _customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")
    )
    return events.select(
        key.alias("event_id"),
        F.col("o_orderpriority").alias("festival_nom"),
        F.concat(F.lit("SALLE "), F.col("c_mktsegment")).alias("lieu_nom"),
        F.when(key % 50 == 0, F.lit("null"))
        .when(key % 51 != 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
        .alias("lieu_adresse"),
        F.col("postal_code").alias("lieu_code_postal"),
        F.col("n_name").alias("lieu_ville"),
        F.when(key % 53 != 0, F.col("n_regionkey").cast("string")).alias("lieu_departement_code"),
        F.when(key % 54 == 0, F.lit("bad-date"))
        .when(key % 55 != 0, day)
        .alias("declaration_date_representation"),
    )


def _hundredths(number: Column) -> Column:
    """0..999 as text ``d.dd``."""
    return F.format_string("%d.%02d", (number / 100).cast("bigint"), number % 100)


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _customers(spark, sf_dir).select(
        F.concat_ws(", ", "c_name", "postal_code", "n_name").alias("full_address"),
        F.when(key % 20 == 0, F.lit("not-found")).otherwise(F.lit("ok")).alias("result_status"),
        _hundredths((key * 37) % 1000).alias("latitude"),
        _hundredths((key * 91) % 1000).alias("longitude"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    opened = F.date_add(F.lit("1995-01-01").cast("date"), ((key * 97) % 900).cast("int"))
    morning = F.when(key % 2 == 0, F.lit(" 00:00:00")).otherwise(F.lit(" 06:00:00"))
    closed = F.concat(F.date_add(opened, 1500).cast("string"), F.lit(" 00:00:00"))
    suppliers = table(spark, sf_dir, "supplier").join(
        F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return suppliers.select(
        F.lpad(key.cast("string"), 8, "0").alias("id"),
        F.col("n_regionkey").cast("string").alias("departement"),
        key.alias("list_pos"),
        (((key * 53) % 1000) / 100).alias("lat"),
        F.when(key % 13 != 0, ((key * 29) % 1000) / 100).alias("lon"),
        F.when(key % 7 == 0, F.lit(False)).when(key % 5 != 0, F.lit(True)).alias("poste_ouvert"),
        F.concat(opened.cast("string"), morning).alias("date_debut"),
        F.when(key % 3 == 0, F.lit("")).when(key % 4 != 0, closed).alias("date_fin"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    # Few line items share a station and day, so grouping them where they are read keeps
    # nearly every row of a split in memory, and so do the merged partitions of a shuffle.
    # The footers of the files tell how many there are.
    tasks = max(spark.sparkContext.defaultParallelism, -(-items.count() // ROWS_PER_TASK))
    per_day = (
        items.repartition(tasks, "l_suppkey", "l_shipdate")
        .groupBy("l_suppkey", "l_shipdate")
        .agg(F.max("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n"))
    )
    return per_day.select(
        F.lpad(F.col("l_suppkey").cast("string"), 8, "0").alias("poste"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("jour"),
        F.concat(F.col("quantity").cast("int").cast("string"), F.lit(",5")).alias("rr"),
        F.lit("1").alias("QRR"),
        F.when(F.col("l_suppkey") % 4 == 0, F.lit("NA"))
        .otherwise(F.concat(F.col("n").cast("string"), F.lit(",25")))
        .alias("tn"),
        F.lit(None).cast("string").alias("vide"),
    )
