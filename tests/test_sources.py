"""Readers and writers on small landed files."""

import json

import pytest
from pyspark.sql import functions as F

from fairweather import sources
from fairweather.operators.stations import join_station_info, stations_by_department


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_declarations_are_text_named_by_the_header(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text('lieu_ville;lieu_siret;festival_nom\n"Saint; Denis";12 ; été\n"";;x\n', encoding="utf-8")
    df = sources.read_declarations(spark, str(path))
    assert df.dtypes == [("lieu_ville", "string"), ("lieu_siret", "string"), ("festival_nom", "string")]
    assert rows(df, "*") == [("Saint; Denis", "12 ", " été"), (None, None, "x")]
    typed = sources.apply_declared_types(df)
    assert typed.dtypes[1] == ("lieu_siret", "bigint")
    assert rows(typed, "lieu_siret") == [(12,), (None,)]


def test_there_are_48_declared_fields():
    kinds = list(sources.DECLARED_TYPES.values())
    assert [kinds.count(k) for k in ("string", "int", "bigint", "boolean")] == [34, 12, 1, 1]


def test_bad_values_become_null(spark):
    df = spark.createDataFrame([("2A", "oui", "x"), ("31", "yes", None)],
                               "lieu_departement_code string, declaration_gestionnaires_multiples string, autre string")
    assert rows(sources.apply_declared_types(df), "*") == [(None, None, "x"), (31, True, None)]


def test_station_lists_wrapped_and_bare(spark, tmp_path):
    stations = [{"id": 1001, "lat": 1.5, "lon": 2, "posteOuvert": False, "alt": 3},
                {"id": "01002", "lat": None, "lon": 2.5}]
    for code, document in {"01": {"data": stations}, "2A": stations, "3": [], "4": {"data": []}, "5": {"x": 1}}.items():
        folder = tmp_path / f"departement={code}"
        folder.mkdir()
        # pretty-printed: a document spans lines
        (folder / "list.json").write_text(json.dumps(document, indent=1))
    df = sources.read_station_list(spark, str(tmp_path))
    expected = [(0, "1001", 1.5, 2.0, False), (1, "01002", None, 2.5, None)]
    assert sorted(rows(df, "departement", "list_pos", "id", "lat", "lon", "poste_ouvert")) == [
        (code, *row) for code in ("01", "2A") for row in expected
    ]


def land(folder, name, stations, wrapped=False):
    folder.mkdir(parents=True, exist_ok=True)
    listed = [{"id": s, "lat": 1.0, "lon": 2.0} for s in stations]
    (folder / name).write_text(json.dumps({"data": listed} if wrapped else listed))


def test_a_list_goes_on_from_one_document_to_the_next(spark, tmp_path):
    land(tmp_path / "departement=01", "a.json", ["x", "y"])
    land(tmp_path / "departement=01", "b.json", [], wrapped=True)
    land(tmp_path / "departement=01", "c.json", ["z"], wrapped=True)
    (tmp_path / "departement=01" / "d.json").write_text("not json")
    land(tmp_path / "departement=01", "e.json", ["w", "v"])
    land(tmp_path / "departement=2A", "c.json", ["u"])
    df = sources.read_station_list(spark, str(tmp_path))
    assert sorted(rows(df, "departement", "list_pos", "id")) == [
        ("01", 0, "x"), ("01", 1, "y"), ("01", 2, "z"), ("01", 3, "w"), ("01", 4, "v"), ("2A", 0, "u")
    ]


def test_only_the_lists_of_a_department_and_parameter_are_read(spark, tmp_path):
    for code in ("1", "2"):
        for parameter, stations in {"rr": "ac", "tn": "b", "__HIVE_DEFAULT_PARTITION__": "abc"}.items():
            folder = tmp_path / f"departement={code}" / f"parametre={parameter}"
            land(folder, "1.json", [f"{code}{s}" for s in stations])
            land(folder, "2.json", [f"{code}{s}{s}" for s in stations])
    listed = sources.read_station_list(spark, str(tmp_path), by_parameter=True)
    chosen = stations_by_department(listed, 2, "rr")
    assert sorted(rows(chosen, "list_pos", "id", "parametre")) == [(0, "2a", "rr"), (1, "2c", "rr"), (2, "2aa", "rr"), (3, "2cc", "rr")]
    every = stations_by_department(listed, 2)
    assert [r[1] for r in sorted(rows(every, "list_pos", "id"))] == ["2a", "2b", "2c", "2aa", "2bb", "2cc"]
    # of the documents those of the one list, of their sizes those of the department
    assert files_read(chosen) == [2, 6]


def files_read(df):
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.executedPlan().collectLeaves() if "Adaptive" in plan.getClass().getName() else plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sorted(s.selectedPartitions().totalNumberOfFiles() for s in scans if "FileSourceScan" in s.getClass().getName())


def test_first_information_counts_and_stations_without_any_drop_out(spark, tmp_path):
    lines = [
        {"id": "1", "information": [{"dateDebut": "2000-01-01 00:00:00", "dateFin": ""}, {"dateDebut": "1900-01-01 00:00:00"}]},
        {"id": "2", "information": []}, {"id": "3"},
        {"id": "4", "information": [{"dateDebut": None, "dateFin": None}]},
    ]
    path = tmp_path / "info.json"
    path.write_text("\n".join(map(json.dumps, lines)))
    information = sources.read_station_info(spark, str(path))
    assert sorted(rows(information, "*")) == [("1", "2000-01-01 00:00:00", ""), ("4", None, None)]
    listed = spark.createDataFrame([("1", "31"), ("2", "31"), ("5", "31")], "id string, departement string")
    assert rows(join_station_info(listed, information), "id", "date_fin") == [("1", "")]


def test_weather_files_with_different_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("poste;jour;rr\n1;20240101;1,5\n")
    (tmp_path / "b.csv").write_text("poste;tn;jour\n2;-3,0;20240101\n2;-3,0;20240101\n")
    df = sources.read_weather_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))
    assert df.columns == ["poste", "jour", "rr", "tn"]
    assert sorted(rows(df, "*"), key=repr) == [
        ("1", "20240101", "1,5", None), ("2", "20240101", None, "-3,0"), ("2", "20240101", None, "-3,0")
    ]
    with pytest.raises(ValueError, match="no weather"):
        sources.union_weather([])


def test_csv_refuses_to_overwrite_and_parquet_replaces(spark, tmp_path):
    df = spark.range(3).withColumn("festival_nom", F.lit("n"))
    csv, parquet = str(tmp_path / "csv"), str(tmp_path / "parquet")
    sources.write_unique_names(df, csv)
    assert rows(spark.read.csv(csv, header=True), "*") == [("n",)]
    with pytest.raises(Exception, match="(?i)already exists"):
        sources.write_csv(df, csv)
    sources.write_parquet(df, parquet)
    sources.write_parquet(df.limit(1), parquet, partition_by=["festival_nom"])
    assert spark.read.parquet(parquet).count() == 1


def test_address_batches_are_bounded_and_keep_white_space(spark, tmp_path):
    path = str(tmp_path / "batches")
    addresses = spark.range(250, numPartitions=1).select(F.concat(F.lit(" a, "), "id").alias("full_address"))
    sources.export_address_batches(addresses, path, batch_size=100)
    landed = spark.read.csv(path, header=True).withColumn("f", F.input_file_name())
    assert sorted(r["count"] for r in landed.groupBy("f").count().collect()) == [50, 100, 100]
    assert landed.where("address like ' a, %'").count() == 250
    with pytest.raises(ValueError, match="positive"):
        sources.export_address_batches(addresses, path, batch_size=0)
