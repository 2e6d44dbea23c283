"""From address keys to coordinates: by joining a gazetteer or through a batched resolver."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairweather.functions.text import clean_key, parse_number
from fairweather.operators.keys import clean_keys
from fairweather.operators.skew import ROWS_PER_TASK, HotKeys, salted_join, sketch_hot_keys

BATCH_SIZE = 1000

Resolver = Callable[[pd.DataFrame], pd.DataFrame]


# How many keys without coordinates an error names.
EXAMPLES = 10


class IncompleteGeocoding(ValueError):
    """Some address keys have no coordinates, or there are no keys at all.

    ``missing`` of ``total`` keys have none; ``examples`` are the first of them.
    """

    def __init__(self, missing: int, total: int, examples: list[str]):
        self.missing, self.total, self.examples = missing, total, list(examples)
        if not total:
            text = "nothing to geocode: no event has a usable address"
        else:
            named = "; ".join(self.examples)
            text = f"{missing} of {total} addresses could not be located, first of all: {named}"
        super().__init__(text)


def _accepted(status: Column, latitude: Column, longitude: Column) -> Column:
    # an exact zero in either coordinate is what the geocoder answers for "unknown"
    return (status == "ok") & (latitude != 0) & (longitude != 0)


def filter_geocode_ok(answers: DataFrame) -> DataFrame:
    """Text coordinates to doubles; both null unless the answer is ``ok`` and both are non-zero."""
    latitude, longitude = parse_number(F.col("latitude")), parse_number(F.col("longitude"))
    ok = _accepted(F.col("result_status"), latitude, longitude)
    return answers.withColumns(
        {"latitude": F.when(ok, latitude), "longitude": F.when(ok, longitude)}
    )


def coordinates_by_address(gazetteer: DataFrame) -> DataFrame:
    """One row per clean address with accepted coordinates (columns as in the geocode answers).

    Raw addresses may strip to one key: the smallest accepted pair is kept, so
    that a join on the key never multiplies events.
    """
    pair = F.struct("latitude", "longitude")
    return (
        clean_keys(filter_geocode_ok(gazetteer), "full_address")
        .where(F.col("latitude").isNotNull())
        .groupBy("full_address")
        .agg(F.min(pair).alias("pair"))
        .select("full_address", "pair.latitude", "pair.longitude")
    )


def join_coordinates(
    events: DataFrame,
    coordinates: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
    *,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left join of coordinates on ``full_address``, which is dropped afterwards.

    Addresses that more than ``rows_per_task`` events share are split, and events
    without an address are spread. Which addresses these are is found by a job
    over the addresses alone; pass ``hot`` if it is known (``[]`` for none).
    """
    keyed = events.withColumn("full_address", clean_key(F.col("full_address")))
    if hot is None:
        hot = sketch_hot_keys(keyed.where(F.col("full_address").isNotNull()), ["full_address"], rows_per_task)
    joined = salted_join(keyed, coordinates, ["full_address"], "left", hot=hot, rows_per_task=rows_per_task)
    return joined.drop("full_address")


def join_geocode_by_position(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Match answers to requests by ``(batch_id, pos)``; a short answer leaves the tail null."""
    answers = filter_geocode_ok(answers).select("batch_id", "pos", "latitude", "longitude")
    return requests.join(answers, ["batch_id", "pos"], "left")


def _check_batch_size(batch_size: int) -> None:
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")


def _map_batches(
    keys: DataFrame, each: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch_size: int
) -> DataFrame:
    """Apply ``each`` to frames of at most ``batch_size`` rows, cut from the Arrow batches."""

    # nested, so that it travels to the executors by value
    def cut_and_apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                yield each(frame.iloc[start : start + batch_size].reset_index(drop=True))

    return keys.mapInPandas(cut_and_apply, schema)


def batch_keys(keys: DataFrame, column: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Size of every batch of at most ``batch_size`` clean keys. Batches form within partitions."""
    _check_batch_size(batch_size)

    def size(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"batch_rows": [len(batch)]})

    cleaned = clean_keys(keys.select(column), column)
    return _map_batches(cleaned, size, "batch_rows bigint", batch_size)


def lookup_in_batches(
    keys: DataFrame, resolver: Resolver, column: str = "full_address", batch_size: int = BATCH_SIZE
) -> DataFrame:
    """Resolve clean keys on the executors, ``batch_size`` at a time.

    ``resolver`` gets a frame with the key column and returns ``latitude`` and
    ``longitude`` row by row in the same order; if it returns fewer rows, the
    rest stay null. Give distinct keys: each row is one lookup.
    """
    _check_batch_size(batch_size)

    def resolve(batch: pd.DataFrame) -> pd.DataFrame:
        found = resolver(batch)[["latitude", "longitude"]].reset_index(drop=True)
        return batch.join(found.astype("float64"))

    schema = f"`{column}` string, latitude double, longitude double"
    return _map_batches(clean_keys(keys.select(column), column), resolve, schema, batch_size)


def geocode_addresses(addresses: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Coordinates of distinct addresses: ``(full_address, latitude, longitude)``, null if unknown."""
    keys = clean_keys(addresses.select("full_address"), "full_address").distinct()
    return keys.join(coordinates_by_address(gazetteer), "full_address", "left")


def geocode_completeness(geocoded: DataFrame) -> DataFrame:
    """One row: how many keys there are and how many of them have no coordinates."""
    return geocoded.agg(
        F.count(F.lit(1)).alias("total_keys"),
        F.count_if(F.col("latitude").isNull()).alias("missing_keys"),
    )


def missing_examples(geocoded: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """The first ``n`` keys without coordinates, in key order."""
    return geocoded.where(F.col("latitude").isNull()).select("full_address").orderBy(
        "full_address"
    ).limit(n)


def completeness_with_examples(geocoded: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """:func:`geocode_completeness` with the column ``examples``: the first ``n`` missing keys.

    One pass: every partition sorts its own keys and gives its first ones to the
    aggregate, so at most ``n`` keys of each partition meet in one task.
    """
    missing = F.col("latitude").isNull()
    ordered = geocoded.select("full_address", "latitude").sortWithinPartitions(~missing, "full_address")
    # the lower bits of this id count the rows of a partition
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = F.when(missing & (F.col("_place") < n), F.col("full_address"))
    return ordered.withColumn("_place", place).agg(
        F.count(F.lit(1)).alias("total_keys"),
        F.count_if(missing).alias("missing_keys"),
        F.slice(F.array_sort(F.collect_list(first)), 1, n).alias("examples"),
    )


def require_complete_geocoding(geocoded: DataFrame) -> None:
    """Raise :class:`IncompleteGeocoding` unless there is a key and every key has coordinates.

    This runs one job; only two counts and at most ten keys reach the driver.
    """
    found = completeness_with_examples(geocoded).first()
    if not found["total_keys"] or found["missing_keys"]:
        raise IncompleteGeocoding(found["missing_keys"], found["total_keys"], found["examples"])
