"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the product of its
letters' vectors, each permuted by its place; a text is the sum of its trigrams'
vectors, and so is, over all training texts, a language's prototype. A text
gets the language whose prototype has the largest cosine.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweather.llm.tokens import batch_slices

DIMENSIONS = 1024
UNKNOWN = "und"
# Texts learnt per language, about: more are thinned by a hash of the text.
TEXTS_PER_LANGUAGE = 20_000
# Languages that are thinned, those with most texts; others are learnt as a whole.
THINNED = 10_000
_BLOCK = 4096


class Letters:
    """Vectors of letters, made from the code point alone, and the sums of texts."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.row_of: dict[int, int] = {}
        self.kept = np.zeros((0, dimensions), np.int8)

    def _rows(self, points: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(points, return_inverse=True)
        new = [p for p in distinct.tolist() if p not in self.row_of]
        if new:
            made = [np.random.default_rng(p).integers(0, 2, self.dimensions, np.int8) * 2 - 1 for p in new]
            self.row_of.update(zip(new, range(len(self.kept), len(self.kept) + len(new)), strict=True))
            self.kept = np.concatenate([self.kept, np.asarray(made, np.int8)])
        return np.fromiter(map(self.row_of.__getitem__, distinct.tolist()), np.int64)[back]

    def bundle(self, text: str | None) -> np.ndarray | None:
        """The sum of a text's trigram vectors; none if the text has no letter.

        Letters are lower-cased; what stands between words counts as one space.
        """
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
        distinct, back = np.unique(points, return_inverse=True)
        is_letter = np.fromiter((chr(p).isalpha() for p in distinct.tolist()), bool, len(distinct))[back]
        if not is_letter.any():
            return None
        points = np.concatenate([[32], np.where(is_letter, points, 32), [32]]).astype(np.int64)
        points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
        rows = self._rows(points)
        size = len(self.row_of)
        grams, counts = np.unique((rows[:-2] * size + rows[1:-1]) * size + rows[2:], return_counts=True)
        total = np.zeros(self.dimensions, np.float64)
        for start in range(0, len(grams), _BLOCK):
            g = grams[start : start + _BLOCK]
            bound = np.roll(self.kept[g // (size * size)], 2, axis=1)
            bound *= np.roll(self.kept[g // size % size], 1, axis=1)
            bound *= self.kept[g % size]
            total += counts[start : start + _BLOCK].astype(np.float32) @ bound.astype(np.float32)
        return total


@dataclass(frozen=True)
class Profiles:
    """Languages and their prototypes, scaled to length one."""

    languages: list[str]
    prototypes: np.ndarray


def learn(documents: DataFrame, text: str = "text", language: str = "lang") -> Profiles:
    """Prototypes of the languages of labelled texts.

    Every task sums its texts per language and dimension; only the sums meet, and
    reach the driver: 8 kB a language. Each text counts with length one, whatever
    its size. Of a language with more than about ``TEXTS_PER_LANGUAGE`` texts a
    part chosen by a hash is learnt.
    """
    labelled = documents.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(language).cast("string").alias("language")
    )
    # a text is drawn by its place in 2^20, of which a language with many texts wants a part
    counts = labelled.groupBy("language").agg(F.count(F.lit(1)).alias("texts"))
    many = counts.where(F.col("texts") > TEXTS_PER_LANGUAGE).orderBy(F.desc("texts"), "language")
    thinned = [(row["language"], TEXTS_PER_LANGUAGE / row["texts"] * (1 << 20)) for row in many.limit(THINNED).collect()]
    drawn = labelled
    if thinned:
        # at most THINNED short rows
        wanted = documents.sparkSession.createDataFrame(thinned, "language string, wanted double")
        place = F.pmod(F.xxhash64("text"), F.lit(1 << 20))
        drawn = labelled.join(F.broadcast(wanted), "language", "left").where(
            F.col("wanted").isNull() | (place < F.col("wanted"))
        )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = Letters(), {}
        for batch in batch_slices(batches, 0):
            for value, label in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                vector = letters.bundle(value)
                if vector is not None:
                    length = np.linalg.norm(vector) or 1.0
                    sums[label] = sums.get(label, 0.0) + vector / length
        for label, vector in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "language": [label] * len(vector),
                    "dimension": np.arange(len(vector), dtype=np.int32),
                    "value": vector,
                }
            )

    sums = (
        drawn.select("text", "language")
        .mapInArrow(add_up, "language string, dimension int, value double")
        .groupBy("language", "dimension")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    if sums.empty:
        return Profiles([], np.zeros((0, DIMENSIONS)))
    table = sums.pivot(index="language", columns="dimension", values="value").sort_index()
    prototypes = table.to_numpy()
    lengths = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return Profiles([str(name) for name in table.index], prototypes / np.where(lengths > 0, lengths, 1))


def predict(
    documents: DataFrame,
    profiles: Profiles,
    text: str = "text",
    names: tuple[str, str, str] = ("lang_pred", "score", "margin"),
) -> DataFrame:
    """Documents with ``lang_pred``, ``score``, the cosine with its prototype (0 to 1), and ``margin``.

    The margin is the score less that of the second language, or less 0 where
    there is one language. A text that is null or has no letters gets ``und``, 0
    and 0; so does every text where nothing was learnt. Equal cosines go to the
    first language by name. ``names`` names the new columns, so that they can
    stand beside any others.
    """
    columns = documents.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batch_slices(batches, columns.index(text)):
            languages, scores, margins = [], [], []
            for value in batch.column(columns.index(text)).to_pylist():
                vector = letters.bundle(value) if profiles.languages else None
                language, best, second = UNKNOWN, 0.0, 0.0
                if vector is not None:
                    cosines = profiles.prototypes @ vector / (np.linalg.norm(vector) or 1.0)
                    language = profiles.languages[int(np.argmax(cosines))]
                    second, best = np.clip(np.sort(np.append(cosines, 0.0))[-2:], 0.0, 1.0)
                languages.append(language)
                scores.append(float(best))
                margins.append(float(best - second))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())],
                [*columns, *names],
            )

    new = [value.alias(name) for value, name in zip((F.lit(""), F.lit(0.0), F.lit(0.0)), names, strict=True)]
    return documents.mapInArrow(score, documents.select("*", *new).schema)
