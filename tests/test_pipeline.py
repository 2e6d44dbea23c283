"""The composed dataflows: output shape, reference quirks, files, and the plan."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fairweather import build_session, enrich_files, plans
from fairweather.operators import filters as flt
from fairweather.operators import geocoding as geo
from fairweather.operators.weather import drop_null_columns
from fairweather.plans import enrichment
from fairweather.plans.enrichment import covered_days
from fairweather.session import Scratch

AS_OF = dt.datetime(2026, 12, 1)

DECLARED = "id int, festival_nom string, lieu_adresse string, lieu_code_postal string, lieu_ville string, " \
    "lieu_departement_code string, declaration_date_representation string"
STATIONS = (
    "id string, departement string, list_pos bigint, lat double, lon double, "
    "poste_ouvert boolean, date_debut string, date_fin string"
)


@pytest.fixture
def tables(spark):
    declarations = spark.createDataFrame(
        [
            (1, "a", " 1 rue ", "31000", "T", "31", "01-06-2024"),
            (1, "a", " 1 rue ", "31000", "T", "31", "01-06-2024"),  # repeated
            (2, "a", "1 rue", "31000", "T", " 031", "1-6-2024"),  # the same place and day
            (3, "b", "1 rue", "31000", "T", "31", "2024-06-01"),  # no such day
            (4, "b", "1 rue", "31000", "T", "31", None),
            (5, "b", "1 rue", "31000", "T", None, "01-06-2024"),  # no department
            (6, "b", "null", "31000", "T", "31", "01-06-2024"),
            (7, "b", "2 rue\t", None, "T", "2A", "01-06-2024"),  # a Corsican department
            (8, "b", "3 rue", None, "T", "31", "01-06-2024"),  # not in the gazetteer
            (9, "b", "1 rue", "31000", "T", "31", "02-06-2024"),  # a station, but no weather
        ],
        DECLARED,
    )
    gazetteer = spark.createDataFrame(
        [("1 rue, 31000, T", "ok", "1.0", "2.0"), (" 2 rue\t, T", "ok", "9.0", "9.0")],
        "full_address string, result_status string, latitude string, longitude string",
    )
    stations = spark.createDataFrame(
        [
            ("031", "31", 0, 1.0, 2.5, True, "2000-01-01 00:00:00", ""),
            ("2A1", "2A", 0, 9.0, 9.5, True, "2000-01-01 00:00:00", None),
        ],
        STATIONS,
    )
    weather = spark.createDataFrame(
        [
            ("031", "20240601", "1,5", "1", "NA"), ("031", "20240601", "2,5", "1", "x"),
            ("2A1", "20240601", "0", "1", "NA"), ("31", "20240602", "9", "1", "NA"),
        ],
        "poste string, jour string, rr string, QRR string, vide string",
    )
    return declarations, gazetteer, stations, weather


EXPECTED = sorted(
    [
        (1, 1.0, 2.0, "031", "20240601", rr, None, 31) for rr in (1.5, 2.5, 1.5, 2.5)
    ]
    + [(2, 1.0, 2.0, "031", "20240601", rr, None, 31) for rr in (1.5, 2.5)]
    + [(i, 1.0, 2.0, None, None, None, None, None) for i in (3, 4, 9)]
    # a station id that is no number has no numeric form
    + [(7, 9.0, 9.0, "2A1", "20240601", 0.0, None, None)],
    key=repr,
)


def result(df):
    columns = ["id", "latitude", "longitude", "poste", "jour", "rr", "vide", "station_id"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("rows_per_task", [1, 2, 1_000_000])
def test_enrichment(tables, rows_per_task):
    df = plans.enrich_events_with_weather(
        *tables, as_of=AS_OF, columns=["id", "festival_nom"], strict=False, rows_per_task=rows_per_task
    )
    assert df.columns == [
        "id", "festival_nom", "lieu_adresse", "lieu_code_postal", "lieu_ville", "lieu_departement_code",
        "day_representation", "latitude", "longitude", "poste", "jour", "rr", "vide", "station_id",
    ]
    assert dict(df.dtypes)["station_id"] == "bigint" and dict(df.dtypes)["rr"] == "double"
    assert result(df) == EXPECTED


def test_filters_come_before_the_projection(tables):
    df = plans.enrich_events_with_weather(
        *tables, as_of=AS_OF, filters={"festival_nom": "a", "id": 2}, columns=["lieu_ville"], strict=False
    )
    assert "festival_nom" not in df.columns
    assert df.count() == 2


def test_strict_geocoding_checks_addresses_without_a_department(tables):
    declarations, *rest = tables
    lost = declarations.sparkSession.createDataFrame([(9, "a", "9 rue", None, "T", None, "01-06-2024")], DECLARED)
    known = declarations.where("id <> 8")
    with pytest.raises(geo.IncompleteGeocoding, match="^1 of 3 addresses .*: 9 rue, T$"):
        plans.enrich_events_with_weather(known.unionByName(lost), *rest, as_of=AS_OF, columns=["id"])
    nowhere = known.where("id <> 6").withColumn("lieu_departement_code", F.lit(None).cast("string"))
    assert plans.enrich_events_with_weather(nowhere, *rest, as_of=AS_OF, columns=["id"]).collect() == []


def test_strict_geocoding_is_the_default(tables):
    with pytest.raises(geo.IncompleteGeocoding, match="^1 of 3 addresses .*: 3 rue, T$"):
        plans.enrich_events_with_weather(*tables, as_of=AS_OF, columns=["id"])
    with pytest.raises(geo.IncompleteGeocoding, match="nothing to geocode"):
        plans.enrich_events_with_weather(
            *tables, as_of=AS_OF, columns=["id"], filters={"festival_nom": "none"}
        )
    declarations, *rest = tables
    df = plans.enrich_events_with_weather(declarations.where("id <> 8"), *rest, as_of=AS_OF, columns=["id"])
    assert result(df) == EXPECTED


def test_empty_input_and_no_weather(tables):
    declarations, gazetteer, stations, weather = tables
    options = {"as_of": AS_OF, "columns": ["id"], "strict": False}
    empty = plans.enrich_events_with_weather(declarations.where("false"), gazetteer, stations, weather, **options)
    assert empty.count() == 0 and empty.columns[-1] == "station_id"
    none = plans.enrich_events_with_weather(declarations, gazetteer, stations, weather.where("false"), **options)
    assert none.dtypes == empty.dtypes
    assert [tuple(r) for r in none.select("id", "station_id").orderBy("id").collect()] == [
        (i, None) for i in (1, 1, 2, 3, 4, 7, 9)
    ]


def test_a_row_per_day_of_the_period(tables):
    declarations, *rest = tables
    df = plans.weather_per_event_day(
        declarations.where("id in (1, 3, 9)").distinct(), *rest,
        last_day=F.when(F.col("id") == 1, F.lit("2024-06-02").cast("date")).otherwise(F.lit("2024-01-01").cast("date")),
        as_of=AS_OF, columns=["id"],
    )
    got = sorted((tuple(r) for r in df.select("id", "weather_day", "rr", "station_id").collect()), key=repr)
    first, second = dt.date(2024, 6, 1), dt.date(2024, 6, 2)
    assert got == [
        (1, first, 1.5, 31), (1, first, 2.5, 31), (1, second, None, None), (3, None, None, None),
        (9, second, None, None),
    ]


def test_from_landed_files(spark, tmp_path):
    def land(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    declarations = land(
        "d.csv",
        "festival_nom;lieu_departement_code;lieu_adresse;lieu_code_postal;lieu_ville;declaration_date_representation\n"
        "Été;31;1 rue;31000;T;01-06-2024\nHiver;31;1 rue;31000;T;01-12-2024\n",
    )
    geocodes = land("g.csv", 'full_address,latitude,longitude,result_score,result_status\n"1 rue, 31000, T",1.0,2.0,0.9,ok\n')
    land("lists/departement=31/a.json", json.dumps({"data": [{"id": "07", "lat": 1.0, "lon": 2.0, "posteOuvert": True}]}))
    information = land("i.json", json.dumps({"id": "07", "information": [{"dateDebut": "2000-01-01 00:00:00", "dateFin": ""}]}))
    weather = land("w.csv", "poste;jour;rr;QRR\n07;20240601;3,25;1\n")
    df = enrich_files(
        spark, declarations=declarations, geocodes=geocodes, station_lists=str(tmp_path / "lists"),
        station_information=information, weather=[weather], as_of=AS_OF,
        columns=["festival_nom"], filters={"lieu_departement_code": 31},
    )
    assert sorted(tuple(r) for r in df.select("festival_nom", "rr", "station_id").collect()) == [
        ("Hiver", None, None), ("Été", 3.25, 7)
    ]
    assert "QRR" not in df.columns


def test_extraction_without_filters_keeps_everything(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("a;b\n1;x\n")
    assert plans.extract_declarations(spark, str(path)).columns == ["a", "b"]
    assert plans.extract_declarations(spark, str(path), {"b": "x"}, ["a"]).columns == ["a"]


def wide_shuffles(plan, column):
    """Exchanges of the events that carry this column of theirs."""
    lines = plan.splitlines()
    return sum(
        1
        for i, line in enumerate(lines)
        if "Exchange hashpartitioning(_address" in line and any(column in x for x in lines[i + 1 : i + 3])
    )


@pytest.fixture(params=["true", "false"], ids=["adaptive", "static"])
def no_broadcast(spark, request):
    """Tables that no plan broadcasts by their size."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": request.param}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("rows_per_task", [1, 1_000_000], ids=["hot keys", "no hot keys"])
def test_the_wide_rows_are_shuffled_once(no_broadcast, tables, rows_per_task):
    declarations, *rest = tables
    df = plans.enrich_events_with_weather(
        declarations, *rest, as_of=AS_OF, columns=["id", "festival_nom"], strict=False, rows_per_task=rows_per_task
    )
    # the festival name is only in the branch of the events: one exchange carries it
    planned = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in planned and "Cartesian" not in planned
    assert wide_shuffles(planned, "festival_nom") == 1
    assert result(df) == EXPECTED
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    final = execution.executedPlan().toString().split("Initial Plan")[0]
    assert wide_shuffles(final, "festival_nom") == 1
    assert ("_key_hash" in planned) == (rows_per_task == 1)


@pytest.mark.parametrize("rows_per_task", [1, 1_000_000], ids=["hot keys", "no hot keys"])
def test_periods_are_expanded_after_the_wide_rows_are_shuffled(no_broadcast, tables, rows_per_task):
    declarations, *rest = tables
    df = plans.weather_per_event_day(
        declarations, *rest, last_day=F.lit("2024-06-03").cast("date"), as_of=AS_OF, columns=["id", "festival_nom"],
        strict=False, rows_per_task=rows_per_task,
    )
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert wide_shuffles(plan, "festival_nom") == 1
    # no day of a period is made below a wide row
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "festival_nom" in line]
    assert not [i for i in scans if "Generate" in lines[i]]


def test_periods_that_overlap_are_looked_up_once(spark):
    rows = [
        (1.0, 2.0, "31", 10, 12), (1.0, 2.0, "31", 11, 15), (1.0, 2.0, "31", 10, 10), (1.0, 2.0, "31", 16, 16),
        (1.0, 2.0, "31", 30, 31), (1.0, 2.0, "32", 30, 30), (5.0, 2.0, "31", 12, 12), (5.0, 2.0, "31", 12, 12),
    ]
    periods = spark.createDataFrame(rows, "latitude double, longitude double, departement string, first int, last int")
    days = covered_days(periods)
    assert days.columns == ["latitude", "longitude", "departement", "day"]
    got = sorted((r.latitude, r.departement, (r.day - dt.date(1970, 1, 1)).days) for r in days.collect())
    assert got == sorted([(1.0, "31", d) for d in (*range(10, 17), 30, 31)] + [(1.0, "32", 30), (5.0, "31", 12)])


def test_periods_of_one_address_that_differ(tables):
    declarations, *rest = tables
    spark = declarations.sparkSession
    one = [(i, "a", "1 rue", "31000", "T", "31", day) for i, day in enumerate(["31-05-2024", "01-06-2024", "01-06-2024", "bad"])]
    events = spark.createDataFrame(one, DECLARED)
    ends = F.when(F.col("id") == 0, F.lit("2024-06-02")).when(F.col("id") == 1, F.lit("2024-06-01"))
    for rows_per_task in (1, 1000):
        df = plans.weather_per_event_day(
            events, *rest, last_day=ends.cast("date"), as_of=AS_OF, columns=["id"], rows_per_task=rows_per_task
        )
        got = sorted(str((r.id, str(r.weather_day), r.rr)) for r in df.collect())
        without = [(0, "2024-05-31", None), (0, "2024-06-02", None), (3, "None", None)]
        assert got == sorted(map(str, [*without, *((i, "2024-06-01", rr) for i in (0, 1, 2) for rr in (1.5, 2.5))]))


class Jobs:
    """How many jobs a block of code runs."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.group = f"counted-{id(self)}"
        self.spark.sparkContext.setJobGroup(self.group, "")
        return self

    def __exit__(self, *_):
        self.spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        # jobs are counted as the listeners hear of them
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.count = len(self.spark.sparkContext.statusTracker().getJobIdsForGroup(self.group))


def test_the_strict_check_adds_no_job(spark, tables, monkeypatch):
    declarations, *rest = tables
    asked = []
    monkeypatch.setattr(enrichment, "require_complete_geocoding", lambda frame: asked.append(frame.count()))
    known = declarations.where("id <> 8")
    plans.enrich_events_with_weather(known, *rest, as_of=AS_OF, columns=["id"])
    assert not asked  # the write of the groups has told
    plans.enrich_events_with_weather(declarations, *rest, as_of=AS_OF, columns=["id"])
    plans.enrich_events_with_weather(declarations.where("false"), *rest, as_of=AS_OF, columns=["id"])
    assert asked == [3, 0]


def test_strict_mode_is_one_job(spark):
    geocoded = spark.createDataFrame([(f"k{n}", 1.0 if n % 2 else None) for n in range(50)], "full_address string, latitude double")
    for frame, fails in ((geocoded, True), (geocoded.where("latitude = 1.0"), False), (geocoded.limit(0), True)):
        # one partition less to plan: the shuffle of the aggregate is not a job of its own
        with Jobs(spark) as jobs:
            try:
                geo.require_complete_geocoding(frame)
                failed = False
            except geo.IncompleteGeocoding:
                failed = True
        completeness = frame.transform(geo.geocode_completeness)
        with Jobs(spark) as counted:
            completeness.collect()
        assert failed == fails and jobs.count <= counted.count


def test_fetched_weather_is_not_read_to_learn_its_empty_columns(spark, tables, monkeypatch):
    *_, weather = tables
    station_days = spark.createDataFrame([("031", dt.date(2024, 6, 1)), ("031", dt.date(2024, 6, 1))], "station_id string, day date")
    told = []

    def drop(df, counts=None):
        told.append(counts)
        return drop_null_columns(df, counts)

    monkeypatch.setattr(enrichment, "drop_null_columns", drop)
    scratch = Scratch(spark)
    found = plans.station_day_weather(weather, station_days, scratch=scratch)
    assert found.columns == ["poste", "jour", "rr"] and found.count() == 2 and len(scratch.paths) == 1
    assert list(told[0].values()) == [2, 2, 2, 0]


def test_intermediate_tables_can_be_removed(spark, tables, tmp_path):
    scratch = Scratch(spark)
    df = plans.enrich_events_with_weather(*tables, as_of=AS_OF, columns=["id"], strict=False, scratch=scratch)
    df.write.parquet(str(tmp_path / "result"))
    paths = list(scratch.paths)
    scratch.remove()
    assert paths and not scratch.paths and not any(Path(p.removeprefix("file:")).exists() for p in paths)
    assert spark.read.parquet(str(tmp_path / "result")).count() == len(EXPECTED)


def test_column_pruning_reaches_the_first_pass(spark, tmp_path, tables):
    path = str(tmp_path / "declarations")
    tables[0].withColumn("unused", F.lit("x")).write.parquet(path)
    df = flt.project_required(spark.read.parquet(path), ["festival_nom"])
    assert "unused" not in df._jdf.queryExecution().executedPlan().toString()


def test_an_active_session_is_reused(spark):
    assert build_session("other").sparkContext is spark.sparkContext
