"""The corpus pipeline: language, quality, near copies, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; all but the last
return the columns of documents. ``run`` writes every stage's result to the
scratch folder and reads it again as the next one's documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairweather.llm import jaccard, language, line_frequency, packing
from fairweather.session import Scratch

# Near copies: five words and a similarity of 0.8.
NEAR = jaccard.Threshold(percent=80, words=5)
# A text of so many letters with a lower cosine is in none of the languages: texts of
# this length in one of them score 0.2 or more, in a language that was not learnt 0.13
# or less. Fewer letters are too few to tell.
ENOUGH_LETTERS, LEAST_LANGUAGE_SCORE = 40, 0.16
# A declared language is replaced by the predicted one if that leads by so much.
SURE_MARGIN = 0.2


def _free_names(docs: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of the documents has."""
    taken = {c.lower() for c in docs.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that ``lang`` names; they get its name where it is missing.

    Documents without letters go, and so do those of ``ENOUGH_LETTERS`` letters
    or more that are unlike every language. A ``lang`` that the prediction
    contradicts is replaced where it is sure (``SURE_MARGIN``), and stands
    otherwise. Where no document has a language there is nothing to reject by,
    and all stay.
    """
    profiles = language.learn(docs)
    if not profiles.languages:
        return docs
    predicted, score, margin = names = _free_names(docs, "lang_pred", "score", "margin")
    judged = language.predict(docs, profiles, names=tuple(names))
    # looked at for low scores only
    letters = F.length(F.regexp_replace("text", r"\P{L}+", ""))
    known = (F.col(score) >= LEAST_LANGUAGE_SCORE) | (letters < ENOUGH_LETTERS)
    kept = judged.where((F.col(predicted) != language.UNKNOWN) & known)
    sure = F.col("lang").isNull() | (F.col(margin) >= SURE_MARGIN)
    return kept.withColumn("lang", F.when(sure, F.col(predicted)).otherwise(F.col("lang"))).select(*docs.columns)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that are frequent in their source."""
    (verdict,) = _free_names(docs, "verdict")
    judged = line_frequency.judge(docs, Scratch(spark), keep=docs.columns, into=verdict)
    removed = F.col(f"{verdict}.removed_lines")
    text = line_frequency.without_lines(F.col("text"), removed)
    cleaned = {"text": text, "n_chars": F.when(F.size(removed) > 0, F.char_length(text)).otherwise(F.col("n_chars"))}
    return judged.where(F.col(f"{verdict}.kept")).withColumns(cleaned).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near copies connect, the one with the least id; a null id stays."""
    work, scratch = Scratch(spark), Scratch(spark)
    groups = jaccard.similar_groups(docs.select("doc_id", "text"), work, threshold=NEAR)
    gone = scratch.materialize(groups.where("doc_id <> component_id").select("doc_id").distinct(), "copies")
    work.remove()
    left = docs.join(gone, "doc_id", "left_anti")
    # rows that repeat an id are copies too
    rows, kept = _free_names(docs, "rows", "kept")
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias(rows)).where(F.col("doc_id").isNotNull() & (F.col(rows) > 1))
    if repeated.isEmpty():
        return left.select(*docs.columns)
    again = left.join(repeated.select("doc_id"), "doc_id", "left_semi")
    others = [c for c in docs.columns if c != "doc_id"]
    once = again.groupBy("doc_id").agg(F.min(F.struct(*others)).alias(kept))
    return (
        left.join(repeated.select("doc_id"), "doc_id", "left_anti")
        .select(*docs.columns)
        .unionByName(once.select("doc_id", *[F.col(f"{kept}.{c}").alias(c) for c in others]))
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left, as pieces packed into sequences of 1024 tokens."""
    pieces = packing.token_pieces(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, 1024, 2
    )
    return packing.pack(pieces, "length", ["doc_id", "piece", "ids_crc32"], 1024, Scratch(spark))


STAGES = [
    ("language identification", identify_language),
    ("quality rules", apply_quality_rules),
    ("near copies", keep_one_of_each_group),
    ("packing", pack_sequences),
]
# Shingle hashes, profiles and tokens are beyond SQL: see tests/llm/test_corpus_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; of the stages between only the last input stays."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        following = scratch.materialize(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            scratch.remove(docs)
        docs = following
    return docs
