"""Weather station lists and station information, landed as JSON."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The fields of a station, and of the validity entries of a station.
STATION_FIELDS = "id string, nom string, lat double, lon double, posteOuvert boolean"
VALIDITY_FIELDS = "dateDebut string, dateFin string"


def unwrap_station_json(text: Column) -> Column:
    """JSON text of a station list to an array of stations.

    Takes both ``{"data": [...]}`` and a bare list; anything else gives null.
    """
    wrapped = F.from_json(text, f"data array<struct<{_nested(STATION_FIELDS)}>>")["data"]
    bare = F.from_json(text, f"array<struct<{_nested(STATION_FIELDS)}>>")
    return F.when(text.rlike(r"^\s*\["), bare).otherwise(wrapped)


def _nested(fields: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (f.split() for f in fields.split(", ")))


def read_station_list(spark: SparkSession, path: str, *, by_parameter: bool = False) -> DataFrame:
    """Stations from JSON documents, stored as ``departement=<code>/…/<file>``.

    ``list_pos`` is the position in the list of the department, which decides
    between stations at the same distance: a list may be answered in several
    documents, and goes on from one to the next in order of their paths. With
    ``by_parameter`` the lists are stored as ``departement=<code>/parametre=<name>/…``,
    each with the stations that measure the parameter (a null one for all
    stations), and the result tells the ``parametre``.

    Only the sizes of the documents meet by department; the documents are what
    Spark distributes. Filters on department and parameter prune the folders.
    """
    lists = ["departement", *(["parametre"] if by_parameter else [])]
    schema = ", ".join(f"{name} string" for name in ["value", *lists])
    documents = (
        spark.read.schema(schema)
        .text(path, wholetext=True)
        .select(*lists, F.col("_metadata.file_path").alias("file"), unwrap_station_json(F.col("value")).alias("listed"))
    )
    earlier = Window.partitionBy(*lists).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = documents.select(*lists, "file", F.greatest(F.size("listed"), F.lit(0)).alias("size"))
    offsets = sizes.select("departement", "file", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    return (
        documents.join(offsets, ["departement", "file"])
        .select(*lists, "offset", F.posexplode("listed").alias("place", "station"))
        .select(
            F.col("station.id").alias("id"),
            "departement",
            (F.col("offset") + F.col("place")).cast("bigint").alias("list_pos"),
            F.col("station.lat").alias("lat"),
            F.col("station.lon").alias("lon"),
            F.col("station.posteOuvert").alias("poste_ouvert"),
            *lists[1:],
        )
    )


def first_station_info(information: Column) -> Column:
    """First entry of a station's information list; null when the list is empty."""
    return F.get(information, 0)


def read_station_info(spark: SparkSession, path: str) -> DataFrame:
    """Validity of stations from JSON lines ``{"id": ..., "information": [{...}, ...]}``.

    Only the first entry counts. The dates stay text: see ``parse_validity``.
    """
    landed = spark.read.schema(
        f"id string, information array<struct<{_nested(VALIDITY_FIELDS)}>>"
    ).json(path)
    first = first_station_info(F.col("information"))
    return landed.where(first.isNotNull()).select(
        "id", first["dateDebut"].alias("date_debut"), first["dateFin"].alias("date_fin")
    )
