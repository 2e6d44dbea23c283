"""Licence scans: TF-IDF cosine of notices to templates, inheritance along folders.

The passages of a file are its lines that speak of a licence or of copyright,
the paragraphs with such a line (a header), and a licence file as a whole. A
passage is compared with the templates by the cosine of sparse TF-IDF vectors.
A file without a licence of its own inherits that of the licence file in its
folder or in the nearest folder above.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairweather.llm.license_texts import TEMPLATES
from fairweather.session import Scratch

# Lines with one of these, in lower case, are passages; the last as words by themselves.
_MARKS = ("licenc", "licens", "copyright", "spdx", "permission is hereby", "creative commons", "public domain")
_SHORT_MARK = re.compile(r"\bcc[- ]by\b")
# A path whose last part starts so is a licence file.
_LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"
_TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_BLANK_LINE = re.compile(r"\n[ \t\r]*\n")
LEAST_COSINE = 0.75
# What a task remembers: answers for so many passages, none longer than this.
_KNOWN, _KNOWN_CHARS = 50_000, 400


def _speaks(lowered: str) -> bool:
    return any(mark in lowered for mark in _MARKS) or _SHORT_MARK.search(lowered) is not None


def passages(text: str, is_license_file: bool) -> Iterator[str]:
    """The passages of a text, whole, wherever they stand."""
    if _speaks(text.lower()):
        for paragraph in _BLANK_LINE.split(text):
            lines = paragraph.split("\n")
            found = [line for line in lines if _speaks(line.lower())]
            yield from found
            if found and len(lines) > 1:
                yield " ".join(lines)
    if is_license_file:
        yield text.replace("\n", " ")


class TemplateIndex:
    """Templates as unit vectors, a row for every term; answers with the most similar licence."""

    def __init__(self, templates: dict[str, list[str]], least: float):
        texts = [(name, Counter(_TERM.findall(text.lower()))) for name, own in templates.items() for text in own]
        holding = Counter(term for _, terms in texts for term in terms)
        self.names, self.least = np.array([name for name, _ in texts]), least
        self.place = {term: n for n, term in enumerate(holding)}
        self.idf = np.array([math.log((1 + len(texts)) / (1 + n)) + 1 for n in holding.values()])
        # a term that no template has weighs as if it were in none
        self.unknown = math.log(1 + len(texts)) + 1
        self.weights = np.zeros((len(holding), len(texts)))
        for n, (_, terms) in enumerate(texts):
            rows = [self.place[t] for t in terms]
            own = np.array(list(terms.values())) * self.idf[rows]
            self.weights[rows, n] = own / np.linalg.norm(own)
        self.known: dict[str, tuple[float, str] | None] = {}

    def best(self, passage: str) -> tuple[float, str] | None:
        """The greatest cosine, negative, and its licence; the first by name of those with the same."""
        if passage in self.known:
            return self.known[passage]
        found = self._compare(Counter(_TERM.findall(passage.lower())))
        if len(passage) <= _KNOWN_CHARS:
            if len(self.known) >= _KNOWN:
                self.known.clear()
            self.known[passage] = found
        return found

    def _compare(self, terms: Counter) -> tuple[float, str] | None:
        rows = [self.place[t] for t in terms if t in self.place]
        if not rows:
            return None
        own = np.array([n for t, n in terms.items() if t in self.place]) * self.idf[rows]
        others = sum(n * n for t, n in terms.items() if t not in self.place)
        length = math.sqrt(float(own @ own) + others * self.unknown**2)
        # rounded, so that the order of the sums does not decide
        cosine = np.round(own @ self.weights[rows] / length, 9)
        name = min(self.names[cosine == cosine.max()])
        return (-float(cosine.max()), str(name)) if cosine.max() >= self.least else None


def match_templates(
    files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = LEAST_COSINE
) -> DataFrame:
    """``files (key, path, is_license, text)`` with ``license, cosine`` in place of the text.

    Of several passages the most similar counts, of equal ones the first licence
    by name; both are null where none reaches ``least``. A file is compared where
    it is read: nothing is shuffled, and a task holds the terms of one passage.
    The templates travel with the function.
    """

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(templates, least)
        for batch in batches:
            best = [
                min(filter(None, map(index.best, passages(text or "", is_file))), default=(None, None))
                for is_file, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            licenses = pa.array([name for _, name in best], pa.string())
            cosines = pa.array([None if c is None else -c for c, _ in best], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], licenses, cosines], names)

    names = ["key", "path", "is_license", "license", "cosine"]
    kind = files.schema["key"].dataType.simpleString()
    schema = f"key {kind}, path string, is_license boolean, license string, cosine double"
    return files.select("key", "path", "is_license", "text").mapInArrow(match, schema)


def _folder(path: Column) -> Column:
    return F.when(path.isNotNull(), F.regexp_extract(path, r"^(.*)/[^/]*$", 1))


def scan(
    files: DataFrame,
    scratch: Scratch,
    *,
    key: str = "doc_id",
    path: str = "path",
    text: str = "text",
    templates: dict[str, list[str]] = TEMPLATES,
    least: float = LEAST_COSINE,
) -> DataFrame:
    """``(key, path, license, cosine, found_in)`` of every file.

    ``found_in`` is the path of the file itself or of the licence file that it
    inherits from; all three are null without a licence. Of several passages
    the most similar counts. Files without a path have no folder and inherit
    nothing. Licence files pass on what they hold; several in a folder, the
    most similar. Rows that repeat are judged each.
    """
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    is_license = F.coalesce(name.rlike(_LICENSE_FILE), F.lit(False))
    rows = files.select(F.col(key).alias("key"), F.col(path).alias("path"), F.col(text).alias("text"))
    matched = match_templates(rows.withColumn("is_license", is_license), templates, least)
    judged = scratch.materialize(matched.withColumn("folder", _folder(F.col("path"))), "judged")
    passed_on = (
        judged.where("is_license AND license IS NOT NULL")
        .groupBy("folder")
        .agg(F.min(F.struct((-F.col("cosine")).alias("away"), "license", "path")).alias("given"))
        .withColumnRenamed("folder", "above")
    )
    # every folder asks the folders above it, itself included, by joining on their paths
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    inherited = (
        judged.where("license IS NULL AND folder IS NOT NULL")
        .select("folder")
        .distinct()
        .select("folder", F.explode(F.array_distinct(above)).alias("above"))
        .join(passed_on, "above")
        .groupBy("folder")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "given")).alias("nearest"))
        .select("folder", "nearest.given")
    )
    has_own = F.col("license").isNotNull()
    return judged.join(inherited, "folder", "left").select(
        F.col("key").alias(key),
        "path",
        F.coalesce("license", "given.license").alias("license"),
        F.when(has_own, F.col("cosine")).otherwise(-F.col("given.away")).alias("cosine"),
        F.when(has_own, F.col("path")).otherwise(F.col("given.path")).alias("found_in"),
    )
