"""Quality rules: word rules per text, and lines that recur across the documents of a host.

Lines are normalised and hashed; for each host and line the distinct documents
that hold it are counted. Lines above the limit are removed, and a document that
is depleted by that is rejected.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairweather.llm.tokens import batch_slices
from fairweather.session import Scratch

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """Limits of the rules.

    A line is removed where more than ``max_share`` of the documents of its host
    hold it, and more than ``min_documents`` of them do. A document is depleted
    with fewer than ``min_words`` words left or less than ``min_left`` of its
    words. With ``count_texts`` documents of the same text count as one, so that a
    group of copies does not condemn its own lines.
    """

    min_words: int = 10
    max_repeated_percent: int = 20
    max_share: float = 0.1
    min_documents: int = 20
    min_left: float = 0.2
    count_texts: bool = False


def repeated_words(ids: np.ndarray) -> int:
    """How many of the words stand in a window of five that occurs twice or more."""
    if len(ids) <= WINDOW:
        return 0
    pairs = np.unique(ids[:-1] * (ids.max() + 1) + ids[1:], return_inverse=True)[1]
    fours = np.unique(pairs[:-2] * (pairs.max() + 1) + pairs[2:], return_inverse=True)[1]
    windows = fours[:-1] * (ids.max() + 1) + ids[4:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[which] > 1)
    if not len(again):
        return 0
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def word_statistics(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines and repeated words of a text.

    Words are what stands between the six ASCII white space characters.
    """
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    codes = {w: n for n, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    lines = [line for line in raw.split(b"\n") if not line.isspace() and line]
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, SPACE))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids),
    )


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_LINES = "array<struct<number: int, words: int, hash: binary>>"


def _measured(documents: DataFrame, text: str, host: str, keep: list[str]) -> DataFrame:
    """One pass over the texts: statistics and hashed lines."""
    line_type = pa.list_(
        pa.struct([("number", pa.int32()), ("words", pa.int32()), ("hash", pa.binary())])
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batch_slices(batches, 0):
            statistics, lines, hashes = [], [], []
            for value in batch.column(0).to_pylist():
                value = value or ""
                statistics.append(word_statistics(value))
                hashes.append(xxh3_128_digest(value.encode("utf-8", "surrogatepass")))
                found = []
                for number, line in enumerate(value.lower().encode("utf-8", "surrogatepass").split(b"\n")):
                    if words := line.split():
                        found.append((number, len(words), xxh3_128_digest(b" ".join(words))))
                lines.append([{"number": n, "words": w, "hash": h} for n, w, h in found])
            table = [pa.array(v, pa.int64()) for v in zip(*statistics, strict=True)]
            table += [pa.array(hashes, pa.binary()), pa.array(lines, line_type)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *table], [*batch.schema.names[1:], *STATISTICS, "_text", "_lines"]
            )

    inputs = documents.select(
        F.col(text).alias("_whole"), F.col(host).alias("_host"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    )
    kinds = [f"k{i} {documents.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    host_kind = documents.schema[host].dataType.simpleString()
    schema = ", ".join(
        [f"_host {host_kind}", *kinds, *[f"{s} bigint" for s in STATISTICS], "_text binary", f"_lines {_LINES}"]
    )
    return inputs.mapInArrow(measure, schema)


def judge(
    documents: DataFrame,
    scratch: Scratch,
    *,
    keep: list[str],
    text: str = "text",
    host: str = "source",
    rules: Rules = Rules(),
    into: str | None = None,
) -> DataFrame:
    """The columns ``keep`` of each document with its statistics and verdict.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``,
    ``base_failed`` (too few words, or too many repeated ones), ``removed_lines``
    (numbers of lines above the limit of the host, from 0) and ``kept``; ``into``
    puts them into one struct of that name, beside columns of any names. A null
    text has no words and fails. Repeated rows are documents of their own.
    Documents without a host share one.

    A line counts once for a document. Counting takes one shuffle of hashes,
    pre-aggregated by host and line; counting texts takes one more, by host,
    line and text. Nothing is broadcast by hint.
    """
    measured = _measured(documents, text, host, keep).withColumn("_row", F.monotonically_increasing_id())
    rows = scratch.materialize(measured, "measured")
    host_key = F.coalesce(F.concat(F.lit("h"), F.col("_host").cast("string")), F.lit("")).alias("_host")
    counted = F.count_distinct("_text") if rules.count_texts else F.count(F.lit(1))

    documents_of = rows.select(host_key, "_text").groupBy("_host").agg(counted.alias("_documents"))
    held = F.explode(F.array_distinct("_lines.hash")).alias("hash")
    holding = rows.select(host_key, "_text", held).groupBy("_host", "hash").agg(counted.alias("_holding"))
    limit = F.greatest(F.lit(rules.min_documents), rules.max_share * F.col("_documents"))
    frequent = scratch.materialize(
        holding.where(F.col("_holding") > rules.min_documents)
        .join(documents_of, "_host")
        .where(F.col("_holding") > limit)
        .select("_host", "hash"),
        "frequent-lines",
    )
    lines = rows.select(host_key, "_row", F.explode("_lines").alias("_line")).select("_host", "_row", "_line.*")
    removed = (
        lines.join(frequent, ["_host", "hash"])
        .groupBy("_row")
        .agg(F.sum("words").alias("_gone"), F.array_sort(F.collect_list("number")).alias("_removed"))
    )

    n_words, left = F.col("n_words"), F.col("n_words") - F.coalesce(F.col("_gone"), F.lit(0))
    base_failed = (n_words < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeated_percent * n_words
    )
    depleted = (left < rules.min_words) | (left < rules.min_left * n_words)
    found = [
        *map(F.col, STATISTICS),
        base_failed.alias("base_failed"),
        F.coalesce("_removed", F.array().cast("array<int>")).alias("removed_lines"),
        (~base_failed & ~depleted).alias("kept"),
    ]
    return rows.join(removed, "_row", "left").select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        *(found if into is None else [F.struct(*found).alias(into)]),
    )


def without_lines(text: Column, removed_lines: Column) -> Column:
    """A text without the lines of these numbers."""
    rest = F.filter(F.split(text, "\n"), lambda _, n: ~F.array_contains(removed_lines, n))
    return F.when(F.size(removed_lines) > 0, F.array_join(rest, "\n")).otherwise(text)
