"""The weather view groups line items in tasks whose size does not grow with the table."""

import datetime as dt

from pyspark.sql import functions as F

from checks import fixtures as fx

ITEMS = "l_suppkey bigint, l_shipdate timestamp_ntz, l_quantity double"


def test_no_task_groups_more_line_items_than_a_few_of_its_share(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "ROWS_PER_TASK", 100, raising=False)
    first = dt.datetime(1995, 1, 1)
    rows = [(n % 500, first + dt.timedelta(days=n // 500), float(n % 50)) for n in range(5000)]
    # keys that are null or come again make one row each
    rows += [(None, first, 1.0), (None, first, 7.0), (3, None, 2.0), (3, first, 60.0)]
    spark.createDataFrame(rows, ITEMS).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")

    weather = fx.weather(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    sizes = [sum(r.task == task for r in weather) for task in {r.task for r in weather}]
    assert len(sizes) > 25 and max(sizes) < 400

    assert len(weather) == 5002
    by_key = {(r.poste, r.jour): (r.rr, r.tn) for r in weather}
    assert by_key[None, "19950101"] == ("7,5", "2,25")
    assert by_key["00000003", None] == ("2,5", "1,25")
    assert by_key["00000003", "19950101"] == ("60,5", "2,25")
    assert by_key["00000004", "19950102"] == ("4,5", "NA")
