"""Equi-joins that survive a key holding a large share of the left side.

Which keys are hot is known from a mergeable sketch of the frequent ones. It
rides on a write where there is one (:func:`frequent_keys` is an aggregate that
``Scratch.observe_write`` takes), or comes from a pass over the key columns alone
(:func:`sketch_hot_keys`), or exactly from a written table of counts
(:func:`counted_hot_keys`). Each gives at most ``MOST_HOT`` keys, told by their
hash: a table of some kilobytes that is always broadcast.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
N_ROWS = "_n_rows"
# The most keys that are split; a sketch of this many counters finds every key that
# has more than rows / (0.75 * TRACKED) of the rows, and most others.
MOST_HOT, TRACKED = 4096, 131_072
_HASH, _SALTS, _SALT = "_key_hash", "_n_salts", "_salt"
# Rows of an outer join whose key is null match nothing; this spreads them.
_NULL_KEY_SALTS = 1024

# Hashes of hot keys and how many rows each has, about.
HotKeys = list[tuple[int, int]]


def count_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """Rows per key; partial counts are taken before the shuffle."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias(N_ROWS))


def key_hash(on: Iterable[str | Column]) -> Column:
    return F.xxhash64(*on)


def frequent_keys(on: Iterable[str | Column]) -> Column:
    """An aggregate: the most frequent keys by hash, with counts that are never too low."""
    hashed = key_hash(on).alias(_HASH)
    return F.call_function("approx_top_k", hashed, F.lit(MOST_HOT), F.lit(TRACKED))


def above(frequent: list | None, rows_per_task: int) -> HotKeys:
    """Those of a result of :func:`frequent_keys` that have more than ``rows_per_task`` rows."""
    return [(item["item"], item["count"]) for item in frequent or [] if item["count"] > rows_per_task]


def sketch_hot_keys(df: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK) -> HotKeys:
    """Hot keys of a frame, by a job that computes nothing but its keys and shuffles only sketches."""
    return above(df.agg(frequent_keys(on).alias("frequent")).first()["frequent"], rows_per_task)


def counted_hot_keys(
    counts: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK, *, largest: int | None = None
) -> HotKeys:
    """Hot keys of a written table of keys with their counts (``_n_rows``), the largest first.

    ``largest`` is the greatest count, where it is known: no job runs if it is
    not above ``rows_per_task``.
    """
    if largest is not None and largest <= rows_per_task:
        return []
    hot = counts.where(F.col(N_ROWS) > rows_per_task).select(key_hash(on).alias(_HASH), N_ROWS)
    return [tuple(row) for row in hot.orderBy(F.desc(N_ROWS), _HASH).limit(MOST_HOT).collect()]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    *,
    hot: HotKeys = (),
    spread: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join on ``on`` (inner or left), with hot keys of the left side split over several tasks.

    A key of ``hot`` gets ``ceil(rows / rows_per_task)`` salts: its left rows are
    dealt out over the salts and its right rows are repeated once per salt. All
    other keys join as usual, and every row is joined exactly once. Keys are
    told by a hash: one that shares its hash with a hot key is split too. The
    left side is shuffled once, with and without adaptive execution, because the
    hot keys are few and broadcast. Left rows with a null key are spread in an
    outer join.

    ``spread`` deals out the rows of a hot key. The default is a hash of the
    row and of its input partition, which does not change when a lost task runs
    again, whatever the left side is clustered by; a table with rows that repeat
    within a partition can give a column that tells them apart.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left joins, not {how!r}")
    rest = [c for c in right.columns if c not in on]
    if not hot and how == "inner":
        return left.join(right, on).select(*left.columns, *rest)
    if spread is None:
        hashed = [f.name for f in left.schema if "map<" not in f.dataType.simpleString()]
        spread = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{name}`") for name in hashed])

    salts = {}
    for key, rows in hot:
        salts[key] = max(salts.get(key, 1), -(-rows // rows_per_task))

    def with_salts(side: DataFrame) -> DataFrame:
        if not salts:
            return side.withColumn(_SALTS, F.lit(1))
        few = left.sparkSession.createDataFrame(list(salts.items()), f"{_HASH} bigint, {_SALTS} int")
        hashed = side.withColumn(_HASH, key_hash(on)).join(F.broadcast(few), _HASH, "left")
        return hashed.withColumn(_SALTS, F.coalesce(F.col(_SALTS), F.lit(1))).drop(_HASH)

    salt = F.when(F.col(_SALTS) > 1, F.pmod(spread, F.col(_SALTS))).otherwise(0)
    if how == "left":
        null_key = F.lit(False)
        for column in on:
            null_key = null_key | F.col(column).isNull()
        salt = F.when(null_key, F.pmod(spread, F.lit(_NULL_KEY_SALTS))).otherwise(salt)
    salted_left = with_salts(left).select(*left.columns, salt.cast("int").alias(_SALT))
    salted_right = with_salts(right).select(
        *right.columns, F.explode(F.sequence(F.lit(0), F.col(_SALTS) - 1)).alias(_SALT)
    )
    return salted_left.join(salted_right, [*on, _SALT], how).select(*left.columns, *rest)
