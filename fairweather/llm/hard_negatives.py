"""Hard negatives by inner product, from cover trees over norm-augmented candidates.

Candidates of a label are dealt over shards, and every shard is indexed by a
cover tree that is written once. An anchor searches the trees of its own label
for its positives and then those of all other labels for negatives, whose
product has to lie in a window set by that of the positive. What the trees find
is exact, and so are the whole-number products.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairweather.llm.covertree import CoverTree
from fairweather.session import Scratch

# About so many candidates in one tree, and so many anchors that search it in one task.
SHARD, ANCHORS = 8192, 2048
# Components are whole numbers of this part of one.
UNIT = 256
# A product of two vectors is at most the greater of their squared lengths.
_MOST_SQUARE = 2.0**62

SPACE = ["label", "dim"]


def _read(embeddings: DataFrame, key: str, vector: str, label: Column, anchor: Column) -> DataFrame:
    """``(vec, label, anchor, dim, raw)`` of the rows that take part."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, dims, raws = [], [], []
            for row, values in enumerate(batch.column(3).to_pylist()):
                if values is None or None in values:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    whole = np.floor(UNIT * np.array(values, np.float64))
                    square = float(whole @ whole)
                if square < _MOST_SQUARE:
                    kept.append(row)
                    dims.append(len(values))
                    raws.append(whole.astype("<i8").tobytes())
            rows = pa.array(kept, pa.int64())
            columns = [batch.column(n).take(rows) for n in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(dims, pa.int32()), pa.array(raws, pa.binary())],
                ["vec", "label", "anchor", "dim", "raw"],
            )

    kind = embeddings.schema[key].dataType.simpleString()
    chosen = embeddings.select(
        F.col(key).alias("vec"),
        label.cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("values"),
    ).where("label IS NOT NULL")
    return chosen.mapInArrow(read, f"vec {kind}, label bigint, anchor boolean, dim int, raw binary")


def _vectors(raws: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), "<i8").reshape(len(raws), dim)


def _build(group: pa.Table) -> pa.Table:
    """The tree of a shard, its rows in order of key and row: equal products go by this order."""
    group = group.sort_by([("vec", "ascending"), ("row", "ascending")])  # nulls last
    tree = CoverTree(_vectors(group.column("raw").to_pylist(), group.column("dim")[0].as_py()))
    first = [group.column(c).slice(0, 1) for c in (*SPACE, "shard")]
    rows = group.column("row").to_numpy().astype("<i8").tobytes()
    keys = group.column("vec").combine_chunks()
    arrays = [*first, pa.array([tree.to_bytes()]), pa.array([rows]), pa.array([keys.to_pylist()], pa.list_(keys.type))]
    return pa.table(arrays, [*SPACE, "shard", "tree", "rows", "keys"])


def window_of(score: int, low_percent: int, high_percent: int) -> tuple[int, int]:
    """Whole numbers between two shares of a score."""
    return -(-score * low_percent // 100), score * high_percent // 100


def _searched(trees: DataFrame, anchors: DataFrame, blocks: int, most: int, shares: tuple[int, int] | None) -> DataFrame:
    """``(anchor, bound, row, vec, score)``: the first ``most`` rows for each anchor, bound and tree.

    ``anchors (label, dim, shard, block, row, raw, bounds)`` tell which trees they
    search. A bound is the score that ``shares`` of it make the window of;
    without shares there is one open window, and the anchor itself is left out.
    """

    def search(group: pa.Table) -> pa.Table:
        found: dict[str, list] = {"anchor": [], "bound": [], "row": [], "vec": [], "score": []}
        is_tree = group.column("tree").is_valid()
        asked, trees = group.filter(group.column("tree").is_null()), group.filter(is_tree)
        kind = group.schema.field("keys").type.value_type
        if trees.num_rows and asked.num_rows:
            tree = CoverTree.from_bytes(trees.column("tree")[0].as_py())
            rows = np.frombuffer(trees.column("rows")[0].as_py(), "<i8")
            keys = trees.column("keys")[0].as_py()
            queries = _vectors(asked.column("raw").to_pylist(), asked.column("dim")[0].as_py())
            for query, row, bounds in zip(
                queries, asked.column("row").to_pylist(), asked.column("bounds").to_pylist(), strict=True
            ):
                windows, skip = [(None, None)], -1
                if shares:
                    windows = [window_of(bound, *shares) for bound in bounds]
                else:
                    bounds = [None]
                    skip = int(np.append(np.flatnonzero(rows == row), -1)[0])
                for bound, (at, scores) in zip(bounds, tree.search(query, windows, most, skip), strict=True):
                    found["anchor"] += [row] * len(at)
                    found["bound"] += [bound] * len(at)
                    found["row"] += rows[at].tolist()
                    found["vec"] += [keys[n] for n in at]
                    found["score"] += scores.tolist()
        kinds = [pa.int64(), pa.int64(), pa.int64(), kind, pa.int64()]
        return pa.table([pa.array(v, k) for v, k in zip(found.values(), kinds, strict=True)], list(found))

    every_block = trees.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    together = every_block.unionByName(anchors, allowMissingColumns=True)
    kind = trees.schema["keys"].dataType.elementType.simpleString()
    schema = f"anchor bigint, bound bigint, row bigint, vec {kind}, score bigint"
    return together.groupBy(*SPACE, "shard", "block").applyInArrow(search, schema)


def _first(rows: DataFrame, group: list[str], most: int) -> DataFrame:
    """The first rows of each group, numbered from 1. Every tree has sent its first ones only."""
    order = [F.col("score").desc(), F.col("vec").asc_nulls_last(), "row"]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(
        F.col("rank") <= most
    )


def mine(
    embeddings: DataFrame,
    scratch: Scratch,
    *,
    is_anchor: Column,
    label: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    A score is the inner product of components ``floor(256 * x)`` with the
    anchor. The positives of an anchor are its ``positives`` best other rows of
    its label. Negatives are rows of other labels with a score between
    ``low_percent`` and ``high_percent`` of the positive's; the best
    ``negatives`` are returned. Equal scores go by key, null last.

    Rows with a null label, a null vector, or a null or non-finite component
    take no part, and neither do vectors whose squared length reaches 2^62:
    their products are no bigints. Vectors of different lengths have no
    product. Rows that repeat are rows of their own. Without anchors, positives
    or negatives there are no rows.
    """
    placed = _read(embeddings, key, vector, label, is_anchor).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.materialize(placed, "vectors")
    spaces = rows.groupBy(*SPACE).agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("shards"))
    shard = F.pmod(F.xxhash64("row"), F.col("shards")).cast("int").alias("shard")
    dealt = rows.join(spaces, SPACE).select(*SPACE, shard, "vec", "row", "raw")
    kind = rows.schema["vec"].dataType.simpleString()
    schema = f"label bigint, dim int, shard int, tree binary, rows binary, keys array<{kind}>"
    trees = scratch.materialize(dealt.groupBy(*SPACE, "shard").applyInArrow(_build, schema), "trees")

    all_anchors = rows.where("anchor")
    blocks = max(1, -(-all_anchors.count() // ANCHORS))
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    asking = all_anchors.select(*SPACE, block, "row", "raw")
    # a key of the joins below has one block of anchors
    targets = spaces.select(
        *SPACE,
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    none = F.lit(None).cast("array<bigint>").alias("bounds")
    same_label = asking.join(targets, [*SPACE, "block"]).select(*SPACE, "shard", "block", "row", "raw", none)
    near = _searched(trees, same_label, blocks, positives, None)
    ranked = _first(near, ["anchor"], positives)
    chosen = scratch.materialize(
        ranked.select("anchor", F.col("vec").alias("positive_id"), F.col("row").alias("positive"), "score"), "positives"
    )

    bounds = chosen.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_set("score")).alias("bounds"))
    others = targets.withColumnRenamed("label", "other")
    other_label = (
        asking.join(bounds, "row")
        .join(others, ["dim", "block"])
        .where(F.col("label") != F.col("other"))
        .select(F.col("other").alias("label"), "dim", "shard", "block", "row", "raw", "bounds")
    )
    far = _searched(trees, other_label, blocks, negatives, (low_percent, high_percent))
    best = _first(far, ["anchor", "bound"], negatives).select(
        "anchor", F.col("bound").alias("score"), "rank", F.col("vec").alias("negative_id"), F.col("score").alias("negative_score")
    )
    names = all_anchors.select(F.col("row").alias("anchor"), F.col("vec").alias("anchor_id"))
    return (
        chosen.join(best, ["anchor", "score"])
        .join(names, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")
    )
