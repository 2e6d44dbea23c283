"""Awkward documents, and the queries run over small folders of tables."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

from fairweather.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        StructField("_part", StringType()),
        StructField("language", StringType()),
    ]
)
LONG = " ".join(f"word{n % 977} of\n" for n in range(30_000))
ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "a",
    "one two three",
    "one two three four",
    "\\ <|end|> </s>[INST]     \x1c x",
    "<|endoftext|>  <|endoftext|>",
    "é" * 3000,
    "同じ 文 。\n同じ 文 。",
    "same line here\nsame line here\n\nsame line here",
    LONG,
    LONG + " end",
    LONG,
    "don't  stop\r\n\r\nDON'T it's 12345 ³½ ",
    " ".join(["tick tock"] * 40),
]


def documents(spark, folder, texts=ODD_TEXTS, rows=None):
    """A folder with a documents table of these texts, twice over, with nulls everywhere."""
    if rows is None:
        rows = [
            (None if n == 3 else n, t, None if n % 5 == 0 else "en", None if n % 4 == 0 else "s", None, "p", "l")
            for n, t in enumerate([*texts, *texts])
        ]
        rows += rows[5:7]
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return rows


def run(spark, name, folder):
    return [r.asDict() for r in QUERIES[name](spark, str(folder)).collect()]


def table(spark, folder, name="documents"):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()]
