"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Each query runs once to warm the JVM up, then once
timed, from building the plan to the last row (written to Spark's ``noop``
sink, so that every column is computed). Nothing is cached between the two.
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from fairweather import build_session  # noqa: E402

HEADLINE = [
    "enrich_events_with_weather",
    "weather_per_event_day",
    "nearest_station",
    "join_coordinates",
    "join_weather_back",
    "weather_lookup",
    "station_day_weather",
    "distinct_combinations",
    "geocode_addresses",
    "lookup_in_batches",
    "parse_weather",
    "extract_declarations",
    "write_parquet",
]


def run(query, spark, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(QUERIES[name], spark, sf_dir)
        times[name] = run(QUERIES[name], spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
