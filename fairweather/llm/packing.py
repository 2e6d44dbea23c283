"""Best-fit decreasing packing of token sequences.

The longest pieces go first, each into the open bin with the least room that
still holds it; a segment tree over the remaining capacities finds that bin in
logarithmic time. Pieces of one length are alike and bins with the same room
are alike, so the packing is decided for the counts of the lengths, in runs,
and is the same as one piece at a time over all rows. Only these counts (at
most one per length up to the capacity) reach the driver. The pieces are then
numbered within their length and look their place up.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweather.llm.ranking import PART, number_rows
from fairweather.llm.tokens import ColumnEncoder
from fairweather.session import Scratch


class CapacityTree:
    """Which remaining capacities have open bins; finds the least one that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = np.zeros(2 * self.leaves, np.int64)

    def add(self, room: int, bins: int) -> None:
        at = self.leaves + room
        while at:
            self.open[at] += bins
            at //= 2

    def tightest(self, need: int) -> int | None:
        at = self.leaves + need
        # up to the first subtree on the right that has an open bin, then down to its left end
        while not self.open[at]:
            while at & 1:
                at //= 2
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_decreasing(
    counts: dict[int, int], capacity: int
) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for ``counts`` pieces per length: ``(how many bins, [(length, pieces of it), ...])``."""
    tree = CapacityTree(capacity)
    alike: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(bins: int, room: int, contents: list[tuple[int, int]]) -> None:
        if bins:
            alike.setdefault(room, []).append((bins, contents))
            tree.add(room, bins)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                # as many new bins as it takes
                each = capacity // length
                bins, contents, room = -(-left // each), [], capacity
            else:
                bins, contents = alike[room].pop()
                tree.add(room, -bins)
                each = room // length
            full = min(bins, left // each)
            put(full, room - each * length, [*contents, (length, each)])
            left -= full * each
            if left and full < bins:
                put(1, room - left * length, [*contents, (length, left)])
                full, left = full + 1, 0
            if contents:
                put(bins - full, room, contents)
    return [group for groups in alike.values() for group in groups]


def _places(plan: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, ...]]:
    """Runs of places per length: first and last number, pieces per bin, first bin, first offset."""
    rows, taken, first_bin = [], {}, 0
    for bins, contents in plan:
        offset = 0
        for length, each in contents:
            first = taken.get(length, 0)
            taken[length] = first + bins * each
            rows.append((length, first, taken[length] - 1, each, first_bin, offset))
            offset += length * each
        first_bin += bins
    return rows


def pack(pieces: DataFrame, length: str, order: list[str], capacity: int, scratch: Scratch) -> DataFrame:
    """Pieces with the ``sequence_id`` they are packed into and their ``offset`` in it.

    ``length`` names a whole-number column with 1 to ``capacity``; pieces whose
    length is null or outside get null. Sequences are numbered from 0 and filled
    from offset 0 without gaps. ``order`` makes equal lengths take their places
    in a fixed order within what one task wrote.
    """
    spark = pieces.sparkSession
    written = scratch.materialize(pieces.withColumn(PART, F.spark_partition_id()), "pieces")
    fits = F.col(length).between(1, capacity)
    counts = {
        row[0]: row[1] for row in written.where(fits).groupBy(length).count().collect()
    }
    places = spark.createDataFrame(
        _places(best_fit_decreasing(counts, capacity)),
        "_length int, _first long, _last long, _each long, _bin long, _offset long",
    )
    numbered = number_rows(written, [length], order, "_number")
    here = (F.col(length) == F.col("_length")) & F.col("_number").between(F.col("_first"), F.col("_last"))
    nth = F.col("_number") - F.col("_first")
    # bounded by the capacity, not by the data: a few runs for each length
    return numbered.join(F.broadcast(places), here, "left").select(
        *pieces.columns,
        (F.col("_bin") + F.floor(nth / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_each") * F.col(length)).alias("offset"),
    )


PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(
    documents: DataFrame,
    tokenizer: str,
    pattern: str,
    capacity: int,
    end_id: int,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` token ids, each document closed by ``end_id``.

    Longer documents are cut into pieces of ``capacity`` ids; the first piece
    takes what is over. A null or empty text is the end id alone. The ids are
    told by their checksum; encode the rows of a sequence again to write it.
    ``pattern`` splits texts before the merges, as the tokenizer file does.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ColumnEncoder(tokenizer, pattern)
        end = np.asarray([end_id], "<u4").tobytes()
        size = 4 * capacity
        for batch in batches:
            rows, found = [], {"piece": [], "start": [], "length": [], "ids_crc32": []}
            for row, body in enumerate(encode(batch.column(1))):
                ids = body + end
                first = len(ids) % size or size
                bounds = [0, *range(first, len(ids), size), len(ids)] if first < len(ids) else [0, len(ids)]
                for n, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append(row)
                    found["piece"].append(n)
                    found["start"].append(a // 4)
                    found["length"].append((b - a) // 4)
                    found["ids_crc32"].append(zlib.crc32(ids[a:b]))
            keys = batch.column(0).take(pa.array(rows, pa.int64()))
            columns = [pa.array(v, pa.int32() if k == "piece" else pa.int64()) for k, v in found.items()]
            yield pa.RecordBatch.from_arrays([keys, *columns], [key, *found])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(cut, f"`{key}` {kind}, {PIECES}")
