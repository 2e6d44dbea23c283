"""One registered query per operator: ``name -> (spark, sf_dir) -> DataFrame``."""

import datetime as dt
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from fairweather import functions as fn
from fairweather import plans, sources
from fairweather.operators import filters as flt
from fairweather.operators import geocoding as geo
from fairweather.operators import keys as key
from fairweather.operators import skew
from fairweather.operators import stations as st
from fairweather.operators import weather as wx
from fairweather.session import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# --- steps that several queries share -------------------------------------------------


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return key.with_address_key(flt.filter_valid_address(fx.declarations(spark, sf)))


def _with_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    return geo.join_coordinates(
        _valid(spark, sf), geo.coordinates_by_address(fx.gazetteer(spark, sf))
    )


def _located(spark: SparkSession, sf: str) -> DataFrame:
    return flt.rename_day(flt.filter_located(_with_coordinates(spark, sf)))


def _typed(located: DataFrame) -> DataFrame:
    """Located events with the typed department and day that lookups use."""
    return located.withColumns(
        {
            "departement": fn.department_key(F.col("lieu_departement_code")),
            "day": fn.parse_day(F.col("day_representation")),
        }
    )


def _counted(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct places and days with their events; written out, because they are read several times."""
    return materialize(skew.count_keys(_typed(_located(spark, sf)), st.PLACE_DAY), "place-days")


def _place_days(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(spark, sf).drop(skew.N_ROWS)


def _found(spark: SparkSession, sf: str) -> DataFrame:
    return st.nearest_station(_place_days(spark, sf), fx.stations(spark, sf), fx.AS_OF)


def _looked_up(place_days: DataFrame, sf: str) -> DataFrame:
    """Weather by place and day, values read."""
    spark = place_days.sparkSession
    found = materialize(st.nearest_station(place_days, fx.stations(spark, sf), fx.AS_OF), "found")
    weather = wx.weather_lookup(found, fx.weather(spark, sf), days=wx.asked_days(found))
    return wx.parse_weather(weather, values=["rr", "QRR", "tn", "vide"])


def _observed(spark: SparkSession, sf: str) -> DataFrame:
    return _looked_up(_place_days(spark, sf), sf)


def _iso(column: str) -> Column:
    return fn.format_day(F.col(column)).alias(column)


# --- sources --------------------------------------------------------------------------


def _landed_declarations(spark: SparkSession, sf: str) -> str:
    """The declarations view as a semicolon-separated file."""
    path = scratch_path(spark, "declarations")
    fx.declarations(spark, sf).write.csv(
        path, header=True, sep=";", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


def _landed_weather(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "weather")
    fx.weather(spark, sf).write.csv(path, header=True, sep=";")
    return path


def _station_documents(stations: DataFrame) -> DataFrame:
    """Station lists as JSON documents of at most 1000 numbers; every second one is wrapped."""
    entry = F.struct(
        "id",
        "lat",
        "lon",
        F.col("poste_ouvert").alias("posteOuvert"),
    )
    page = F.floor(F.col("list_pos") / 1000)
    return (
        stations.groupBy("departement", page.alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("list_pos", entry.alias("entry")))).alias("page_rows"))
        .withColumn("listed", F.to_json(F.col("page_rows.entry")))
        .select(
            "departement",
            F.format_string("%05d", "page").alias("page"),
            F.when(
                F.pmod(F.col("page") + F.col("departement").cast("int"), F.lit(2)) == 0,
                F.concat(F.lit('{"data": '), F.col("listed"), F.lit("}")),
            )
            .otherwise(F.col("listed"))
            .alias("value"),
        )
    )


@register
def read_declarations(spark: SparkSession, sf: str) -> DataFrame:
    return sources.read_declarations(spark, _landed_declarations(spark, sf))


@register
def apply_declared_types(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("event_id")
    wide = fx.declarations(spark, sf).select(
        "event_id",
        "festival_nom",
        "lieu_departement_code",
        F.when(number % 11 == 0, F.lit("2A004"))
        .otherwise((number % 90000).cast("string"))
        .alias("festival_code_postal"),
        F.when(number % 7 == 0, F.lit("inconnu"))
        .otherwise((number + 10**13).cast("string"))
        .alias("lieu_siret"),
        F.when(number % 3 == 0, F.lit("true"))
        .when(number % 3 == 1, F.lit("false"))
        .otherwise(F.lit("peut-etre"))
        .alias("declaration_gestionnaires_multiples"),
    )
    return sources.apply_declared_types(wide)


@register
def read_geocode_results(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "geocodes")
    fx.gazetteer(spark, sf).withColumn("result_score", F.lit("0.9")).write.csv(path, header=True)
    return sources.read_geocode_results(spark, path)


@register
def read_station_list(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "station-lists")
    # one document per file, as it was answered
    _station_documents(fx.stations(spark, sf)).write.partitionBy("departement", "page").option(
        "maxRecordsPerFile", 1
    ).text(path)
    return sources.read_station_list(spark, path)


@register
def read_station_info(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "station-information")
    first = F.struct(F.col("date_debut").alias("dateDebut"), F.col("date_fin").alias("dateFin"))
    older = F.struct(F.lit("1900-01-01 00:00:00").alias("dateDebut"), F.lit("").alias("dateFin"))
    none = F.array().cast("array<struct<dateDebut: string, dateFin: string>>")
    # an empty information list for every eleventh station
    fx.stations(spark, sf).select(
        "id",
        F.when(F.col("list_pos") % 11 == 0, none).otherwise(F.array(first, older)).alias("information"),
    ).write.option("ignoreNullFields", False).json(path)
    return sources.read_station_info(spark, path)


@register
def read_weather_csv(spark: SparkSession, sf: str) -> DataFrame:
    return sources.read_weather_csv(spark, _landed_weather(spark, sf))


# --- projections, filters, predicates -------------------------------------------------


@register
def filter_equals(spark: SparkSession, sf: str) -> DataFrame:
    chosen = flt.filter_equals(
        fx.declarations(spark, sf), {"festival_nom": "1-URGENT", "lieu_departement_code": 1}
    )
    return chosen.select("event_id", "lieu_ville")


@register
def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return flt.project_columns(fx.declarations(spark, sf), ["event_id", "lieu_nom", "lieu_ville"])


@register
def project_required(spark: SparkSession, sf: str) -> DataFrame:
    return flt.project_required(fx.declarations(spark, sf), ["event_id", "lieu_ville"])


@register
def filter_valid_address(spark: SparkSession, sf: str) -> DataFrame:
    return flt.filter_valid_address(fx.declarations(spark, sf)).select(
        "event_id", "lieu_adresse", "lieu_code_postal", "lieu_ville"
    )


@register
def filter_located(spark: SparkSession, sf: str) -> DataFrame:
    return flt.filter_located(_with_coordinates(spark, sf)).select(
        "event_id", "latitude", "longitude", "lieu_departement_code"
    )


@register
def filter_open_stations(spark: SparkSession, sf: str) -> DataFrame:
    return st.filter_open_stations(fx.stations(spark, sf)).select("id", "poste_ouvert")


@register
def filter_usable_stations(spark: SparkSession, sf: str) -> DataFrame:
    return st.filter_usable_stations(fx.stations(spark, sf)).select("id", "lat", "lon")


@register
def filter_geocode_ok(spark: SparkSession, sf: str) -> DataFrame:
    return geo.filter_geocode_ok(fx.gazetteer(spark, sf))


@register
def stations_by_department(spark: SparkSession, sf: str) -> DataFrame:
    """The stations that measure a parameter, from lists landed by parameter."""
    path, every = scratch_path(spark, "station-lists"), fx.stations(spark, sf)
    lists = {None: every, "precipitation": every.where("list_pos % 2 = 0"), "vent": every.where("list_pos % 3 = 0")}
    for parameter, stations in lists.items():
        documents = _station_documents(stations).withColumn("parametre", F.lit(parameter).cast("string"))
        by_list = documents.write.mode("append").partitionBy("departement", "parametre", "page")
        by_list.option("maxRecordsPerFile", 1).text(path)
    landed = sources.read_station_list(spark, path, by_parameter=True)
    chosen = st.stations_by_department(landed, 2, "precipitation")
    return chosen.select("id", "departement", "list_pos", "lat", "lon")


@register
def weather_for_day(spark: SparkSession, sf: str) -> DataFrame:
    return wx.weather_for_day(fx.weather(spark, sf), "00000001", dt.date(1997, 1, 31))


@register
def rename_day(spark: SparkSession, sf: str) -> DataFrame:
    return flt.rename_day(fx.declarations(spark, sf)).select("event_id", "day_representation")


@register
def clean_keys(spark: SparkSession, sf: str) -> DataFrame:
    number, name = F.col("event_id"), F.col("lieu_nom")
    edged = (
        F.when(number % 17 == 0, F.lit(" \t "))
        .when(number % 19 != 0, F.concat(F.lit("\t  "), name, F.lit("  \n")))
    )
    return key.clean_keys(fx.declarations(spark, sf).select("event_id", edged.alias("name")), "name")


# --- joins ----------------------------------------------------------------------------


@register
def join_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    return _with_coordinates(spark, sf).select("event_id", "lieu_adresse", "latitude", "longitude")


@register
def join_geocode_by_position(spark: SparkSession, sf: str) -> DataFrame:
    """Requests in batches of 1000, answers that stop ten short of the end of a batch."""
    customers = fx.table(spark, sf, "customer").select("c_custkey", "c_name")
    number = F.col("c_custkey")
    requests = customers.select(
        F.floor(number / 1000).alias("batch_id"), (number % 1000).alias("pos"), "c_name"
    )
    hundredths = ((F.col("c_custkey") * 37) % 1000 / 100).cast("string")
    answers = customers.where(number % 1000 < 990).select(
        F.floor(number / 1000).alias("batch_id"),
        (number % 1000).alias("pos"),
        F.when(number % 7 == 0, F.lit("error")).otherwise(F.lit("ok")).alias("result_status"),
        hundredths.alias("latitude"),
        F.lit("1.5").alias("longitude"),
    )
    return geo.join_geocode_by_position(requests, answers)


@register
def nearest_station(spark: SparkSession, sf: str) -> DataFrame:
    return _found(spark, sf).withColumn("day", _iso("day"))


@register
def station_valid_on_day(spark: SparkSession, sf: str) -> DataFrame:
    days = fx.declarations(spark, sf).select(
        fn.department_key(F.col("lieu_departement_code")).alias("departement"),
        fn.parse_day(F.col(flt.DAY_COLUMN)).alias("day"),
    )
    return st.station_valid_on_day(days, fx.stations(spark, sf), fx.AS_OF).withColumns(
        {"first_day": _iso("first_day"), "last_day": _iso("last_day")}
    )


@register
def weather_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One lookup per distinct station and day."""
    station_days = materialize(_found(spark, sf).select("station_id", "day").distinct(), "station-days")
    found = wx.weather_lookup(station_days, fx.weather(spark, sf), days=wx.asked_days(station_days))
    return found.withColumn("day", _iso("day"))


@register
def join_weather_back(spark: SparkSession, sf: str) -> DataFrame:
    counted = _counted(spark, sf)
    back = wx.join_weather_back(
        _typed(_located(spark, sf)), _looked_up(counted.drop(skew.N_ROWS), sf), key_counts=counted
    )
    return back.select(
        "event_id", "latitude", "longitude", "lieu_departement_code", "day_representation",
        "rr", "tn", "station_id",
    )


@register
def no_weather_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """The join back with no weather at all: every event, with null from the right."""
    located = _typed(_located(spark, sf))
    keys = located.select(*st.PLACE_DAY).distinct().withColumn("station_id", F.lit("1"))
    no_weather = wx.weather_lookup(keys, fx.weather(spark, sf).limit(0))
    back = wx.join_weather_back(located, wx.tag_weather(no_weather))
    return back.select("event_id", "latitude", "longitude", "station_id")


# --- aggregations, distinct, top-k ----------------------------------------------------


@register
def distinct_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return key.distinct_addresses(_valid(spark, sf))


@register
def distinct_combinations(spark: SparkSession, sf: str) -> DataFrame:
    return key.distinct_combinations(_located(spark, sf))


@register
def distinct_festival_names(spark: SparkSession, sf: str) -> DataFrame:
    return key.distinct_names(fx.declarations(spark, sf))


def _geocoded(spark: SparkSession, sf: str) -> DataFrame:
    addresses = key.distinct_addresses(_valid(spark, sf))
    return geo.geocode_addresses(addresses, fx.gazetteer(spark, sf))


@register
def geocode_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return geo.geocode_completeness(_geocoded(spark, sf))


@register
def null_column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return wx.null_column_profile(fx.weather(spark, sf).withColumn("tn", fn.null_tokens(F.col("tn"))))


@register
def missing_examples(spark: SparkSession, sf: str) -> DataFrame:
    return geo.missing_examples(_geocoded(spark, sf))


@register
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return sources.preview(fx.declarations(spark, sf), ["event_id"], 20)


@register
def first_station_info(spark: SparkSession, sf: str) -> DataFrame:
    """First of the entries of each department and opening day, in list order."""
    information = F.array(
        F.struct(F.col("date_debut").alias("dateDebut"), F.col("date_fin").alias("dateFin")),
        F.struct(F.lit("1900-01-01 00:00:00").alias("dateDebut"), F.lit("").alias("dateFin")),
    )
    first = sources.first_station_info(
        F.when(F.col("list_pos") % 11 != 0, information).otherwise(F.slice(information, 1, 0))
    )
    return fx.stations(spark, sf).select(
        "id", first["dateDebut"].alias("date_debut"), first["dateFin"].alias("date_fin")
    )


# --- set operations -------------------------------------------------------------------


@register
def union_weather(spark: SparkSession, sf: str) -> DataFrame:
    weather = fx.weather(spark, sf)
    odd = F.col("poste").cast("bigint") % 2 == 1
    return sources.union_weather(
        [weather.where(odd).select("poste", "jour", "rr"), weather.where(~odd).select("poste", "jour", "tn")]
    )


# --- scalar expressions ---------------------------------------------------------------


@register
def address_key(spark: SparkSession, sf: str) -> DataFrame:
    return key.with_address_key(fx.declarations(spark, sf)).select("event_id", "full_address")


@register
def combination_key(spark: SparkSession, sf: str) -> DataFrame:
    return _located(spark, sf).select(
        "event_id",
        fn.combination_key(
            F.col("latitude"),
            F.col("longitude"),
            F.col("lieu_departement_code"),
            F.col("day_representation"),
        ).alias("station_key"),
    )


@register
def parse_day(spark: SparkSession, sf: str) -> DataFrame:
    day = fn.parse_day(F.col(flt.DAY_COLUMN))
    return fx.declarations(spark, sf).select("event_id", fn.format_day(day).alias("day"))


@register
def format_day(spark: SparkSession, sf: str) -> DataFrame:
    first, last = fn.day_bounds(F.col("o_orderdate").cast("date"))
    return fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        fn.format_day(F.col("o_orderdate")).alias("day"),
        first.alias("first_second"),
        last.alias("last_second"),
    )


@register
def parse_validity(spark: SparkSession, sf: str) -> DataFrame:
    start, end = fn.parse_validity(F.col("date_debut"), F.col("date_fin"), fx.AS_OF)
    stamp = "yyyy-MM-dd HH:mm:ss"
    return fx.stations(spark, sf).select(
        "id",
        F.date_format(start, stamp).alias("valid_from"),
        F.date_format(end, stamp).alias("valid_to"),
    )


@register
def degree_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Distance of every station from the middle of its department's square."""
    distance = fn.degree_distance(F.col("lat"), F.col("lon"), F.lit(5.25), F.lit(4.75))
    return fx.stations(spark, sf).select("id", distance.alias("distance"))


@register
def parse_decimal_comma(spark: SparkSession, sf: str) -> DataFrame:
    return fx.weather(spark, sf).select(
        "poste", "jour", fn.parse_decimal_comma(F.col("rr")).alias("rr")
    )


@register
def null_tokens(spark: SparkSession, sf: str) -> DataFrame:
    tokens = F.array(*[F.lit(t) for t in fn.NULL_TOKENS])
    number = F.col("event_id") % (2 * len(fn.NULL_TOKENS))
    cell = F.coalesce(F.get(tokens, number.cast("int")), F.col("lieu_nom"))
    return fx.declarations(spark, sf).select("event_id", fn.null_tokens(cell).alias("cell"))


@register
def unwrap_station_json(spark: SparkSession, sf: str) -> DataFrame:
    documents = _station_documents(fx.stations(spark, sf))
    stations = documents.select(
        "departement", F.inline(sources.unwrap_station_json(F.col("value")))
    )
    return stations.select("departement", "id", "lat", "lon", F.col("posteOuvert").alias("poste_ouvert"))


# --- table shaping for weather and geocoding ------------------------------------------


@register
def parse_weather(spark: SparkSession, sf: str) -> DataFrame:
    return wx.parse_weather(fx.weather(spark, sf))


@register
def drop_null_columns(spark: SparkSession, sf: str) -> DataFrame:
    return wx.drop_null_columns(wx.parse_weather(fx.weather(spark, sf)))


@register
def drop_quality_columns(spark: SparkSession, sf: str) -> DataFrame:
    return wx.drop_quality_columns(fx.weather(spark, sf))


@register
def tag_weather(spark: SparkSession, sf: str) -> DataFrame:
    return wx.tag_weather(_observed(spark, sf)).select(
        "station_key", "station_id", "jour", "rr", "tn"
    )


@register
def skip_empty_weather(spark: SparkSession, sf: str) -> DataFrame:
    return wx.skip_empty_weather(_place_days(spark, sf), _observed(spark, sf)).withColumn(
        "day", _iso("day")
    )


@register
def batch_keys(spark: SparkSession, sf: str) -> DataFrame:
    batches = geo.batch_keys(key.distinct_addresses(_valid(spark, sf)), "full_address")
    return batches.agg(
        F.sum("batch_rows").alias("total_keys"), (F.max("batch_rows") <= 1000).alias("within_limit")
    )


@register
def lookup_in_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A resolver that reads the customer number out of the address."""

    def resolve(batch: pd.DataFrame) -> pd.DataFrame:
        number = batch["full_address"].str.extract(r"#(\d+)")[0].astype("int64")
        return pd.DataFrame(
            {"latitude": number * 37 % 1000 / 100, "longitude": number * 91 % 1000 / 100}
        ).where(number % 20 != 0)

    return geo.lookup_in_batches(key.distinct_addresses(_valid(spark, sf)), resolve)


@register
def geocode_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return _geocoded(spark, sf)


@register
def require_complete_geocoding(spark: SparkSession, sf: str) -> DataFrame:
    """Strict geocoding refuses the input for the missing addresses and accepts it without them.

    The rows are what it counts.
    """
    geocoded = _geocoded(spark, sf)
    refused = False
    try:
        geo.require_complete_geocoding(geocoded)
    except geo.IncompleteGeocoding:
        refused = True
    geo.require_complete_geocoding(geocoded.where(F.col("latitude").isNotNull()))
    return geo.geocode_completeness(geocoded).withColumn("refused", F.lit(refused))


# --- sinks ----------------------------------------------------------------------------


@register
def write_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "events-parquet")
    sources.write_parquet(fx.declarations(spark, sf), path)
    # the second write replaces the first
    sources.write_parquet(fx.declarations(spark, sf), path)
    return spark.read.parquet(path)


@register
def write_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "events-csv")
    sources.write_csv(_valid(spark, sf), path)
    return spark.read.csv(path, header=True).select("event_id", "lieu_adresse", "full_address")


@register
def write_unique_names(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "names")
    sources.write_unique_names(fx.declarations(spark, sf), path)
    return spark.read.csv(path, header=True)


@register
def export_address_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Rows read back, and whether every file stayed within the batch size."""
    path = scratch_path(spark, "address-batches")
    sources.export_address_batches(key.distinct_addresses(_valid(spark, sf)), path)
    landed = spark.read.csv(path, header=True).withColumn("file", F.input_file_name())
    per_file = landed.groupBy("file").agg(F.count("address").alias("n"))
    return per_file.agg(
        F.sum("n").alias("addresses"), (F.max("n") <= 1000).alias("within_limit")
    )


# --- composed pipelines ---------------------------------------------------------------


@register
def enrich_events_with_weather(spark: SparkSession, sf: str) -> DataFrame:
    return plans.enrich_events_with_weather(
        fx.declarations(spark, sf),
        fx.gazetteer(spark, sf),
        fx.stations(spark, sf),
        fx.weather(spark, sf),
        as_of=fx.AS_OF,
        columns=["event_id", *flt.DEFAULT_COLUMNS],
        strict=False,
    )


@register
def extract_declarations(spark: SparkSession, sf: str) -> DataFrame:
    return plans.extract_declarations(
        spark,
        _landed_declarations(spark, sf),
        filters={"lieu_departement_code": 3},
        columns=["event_id", "festival_nom", "lieu_ville", "declaration_date_representation"],
    )


@register
def prepare_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """How many declarations each of the distinct addresses has."""
    keyed, addresses = plans.prepare_addresses(fx.declarations(spark, sf))
    counts = keyed.groupBy("full_address").agg(F.count(F.lit(1)).alias("declarations"))
    return addresses.join(counts, "full_address")


@register
def station_day_weather(spark: SparkSession, sf: str) -> DataFrame:
    landed = sources.read_weather_csv(spark, _landed_weather(spark, sf))
    return plans.station_day_weather(landed, _found(spark, sf))


@register
def weather_per_event_day(spark: SparkSession, sf: str) -> DataFrame:
    """Events that last one to three days."""
    first = fn.parse_day(F.col(flt.DAY_COLUMN))
    enriched = plans.weather_per_event_day(
        fx.declarations(spark, sf),
        fx.gazetteer(spark, sf),
        fx.stations(spark, sf),
        fx.weather(spark, sf),
        last_day=F.date_add(first, (F.col("event_id") % 3).cast("int")),
        as_of=fx.AS_OF,
        columns=["event_id"],
        strict=False,
    )
    return enriched.select(
        "event_id", _iso("weather_day"), "latitude", "longitude", "rr", "tn", "station_id"
    )
