"""Packing by powers of two: documents are split into pieces of binary length.

A document of ``n`` tokens becomes as many pieces of the longest length as it
holds and then one piece for every binary digit of the rest, longest first.
Pieces of one length make a bucket; each is a sequence by itself, full to its
last token, so no sequence crosses documents and nothing is padded. A batch
takes sequences of one bucket.
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

PIECES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def binary_lengths(tokens: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``tokens`` tokens: powers of two up to ``longest``, descending."""
    rest = tokens % longest
    digits = [1 << d for d in reversed(range(longest.bit_length())) if rest >> d & 1]
    return [longest] * (tokens // longest) + digits


def binary_pieces(
    documents: DataFrame,
    tokenizer: str,
    pattern: str,
    longest: int,
    end_id: int,
    text: str = "text",
    key: str = "doc_id",
    ids: bool = False,
) -> DataFrame:
    """Documents as pieces of binary length, each document closed by ``end_id``.

    ``longest`` is a power of two. A null or empty text is the end id alone. The
    ids are told by their checksum; ``ids`` adds them as an array. Rows that
    repeat are cut each; the other columns of ``documents`` are not looked at.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ColumnEncoder(tokenizer, pattern)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            rows, found, values = [], {name: [] for name in names}, []
            for row, body in enumerate(encode(batch.column(1))):
                own = body + end
                start = 0
                for length in binary_lengths(len(own) // 4, longest):
                    piece = own[4 * start : 4 * (start + length)]
                    rows.append(row)
                    found["start"].append(start)
                    found["length"].append(length)
                    found["ids_crc32"].append(zlib.crc32(piece))
                    found["doc_tokens"].append(len(own) // 4)
                    if ids:
                        values.append(np.frombuffer(piece, "<u4").astype(np.int64))
                    start += length
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(v, pa.int64()) for v in found.values()]
            if ids:
                columns.append(pa.array(values, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, [key, *names, *(["ids"] if ids else [])])

    names = ["start", "length", "ids_crc32", "doc_tokens"]
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {PIECES}" + (", ids array<bigint>" if ids else "")
    return documents.select(key, text).mapInArrow(cut, schema)


def bucket(pieces: DataFrame, order: list[str], scratch: Scratch, length: str = "length") -> DataFrame:
    """Pieces as sequences: ``sequence_id`` and ``offset`` (0), and ``bucket_row`` within its length.

    Sequences are numbered from 0 without gaps, the shortest bucket first, and
    so are the rows of a bucket; ``order`` fixes the numbers within what one task
    wrote. A bucket may hold any share of the pieces: it is numbered in parts.
    Only one count for each length reaches the driver; there are as many lengths
    as binary digits in the longest piece. A null length is a bucket too.
    """
    written = scratch.materialize(pieces.withColumn(PART, F.spark_partition_id()), "pieces")
    first = F.lit(0)
    before = 0
    for row in sorted(written.groupBy(length).count().collect(), key=lambda r: (r[0] is not None, r[0])):
        first = F.when(F.col(length).eqNullSafe(row[0]), before).otherwise(first)
        before += row[1]
    numbered = number_rows(written, [length], order, "bucket_row")
    return numbered.select(
        *pieces.columns,
        (first + F.col("bucket_row")).cast("bigint").alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        "bucket_row",
    )
