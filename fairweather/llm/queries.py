"""One registered query per operator: ``opN_<name> -> (spark, sf_dir) -> DataFrame``."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairweather.llm import (
    bpe,
    chat,
    decomposition,
    hard_negatives,
    jaccard,
    language,
    licenses,
    line_frequency,
    neighbours,
    packing,
    phrases,
    quality,
    sharding,
)
from fairweather.session import Scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op10_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over the sixteen shards of the standard tree."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        sharding.shard_of(F.col("doc_id"), sharding.standard_tree(17)).alias("grown_shard"),
    )
    return sharding.shard_rows(rows, "doc_id", sharding.standard_tree(16), Scratch(spark))


@register
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    pieces = packing.token_pieces(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        1024,
        2,
    )
    return packing.pack(pieces, "length", ["doc_id", "piece", "ids_crc32"], 1024, Scratch(spark))


@register
def op9_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word rules of all documents, and lines that are frequent within a source."""
    return line_frequency.judge(_table(spark, sf_dir, "documents"), Scratch(spark), keep=["doc_id"])


def _held_out() -> Column:
    """A quarter of the documents by a checksum of their id; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


@register
def op4_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learnt from three quarters of them."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language.learn(documents.where(~_held_out()))
    return language.predict(documents.select("doc_id", "text"), profiles).select(
        "doc_id", _held_out().alias("held_out"), "lang_pred", "score"
    )


# Comes as a JSON record of another layout than the table.
_ODD_CONVERSATION = (
    '{"id": -7, "messages": [{"role": "user", "content": "</s>[INST] ok [/INST]"},'
    ' {"role": "assistant", "content": "</s>[INST] ok [/INST]"}]}'
)


@register
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and what reading them back gives."""
    rows = chat.records_of_rows(_table(spark, sf_dir, "conversations"))
    odd = spark.range(1).select(F.parse_json(F.lit(_ODD_CONVERSATION)).alias("record"))
    conversations = chat.turns_of_variants(rows.unionByName(odd), "record")
    read = chat.format_turns(conversations).select(
        "conv_id",
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss_text(F.col("segments")).alias("loss"),
    )
    turn_text = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turn_text, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLES["op2_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped AS (
    SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
           + len(regexp_extract_all(text, '<(\||/?s>|</?SYS>>)|\[/?INST\]'))
           + length(role) + length(role) - length(replace(role, '\', ''))
           + len(regexp_extract_all(role, '<(\||/?s>|</?SYS>>)|\[/?INST\]'))
           + length('<|start|><|text|><|end|>') + 1 AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


@register
def op8_set_relation_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents with a Jaccard similarity of 0.85 of four-word shingles."""
    return jaccard.similar_groups(_table(spark, sf_dir, "documents"), Scratch(spark))


@register
def op5_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the ranks of a vocabulary for many languages, and decoded."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_and_decode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@register
def op6_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents, learnt from the labelled ones in three quarters of them."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    trees = quality.learn(documents.where(~_held_out()).join(labels, "doc_id"))
    return quality.predict(documents, trees).select(
        "doc_id",
        _held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@register
def op7_small_world_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all embeddings of a label."""
    return neighbours.near_duplicates(_table(spark, sf_dir, "embeddings"), Scratch(spark))


@register
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, laid out as files of their source.

    Folders hold sixteen documents and sixteen folders each, by id; the first
    document of a folder is its licence file.
    """
    doc_id = F.col("doc_id")
    name = F.when(doc_id % 16 == 0, F.lit("LICENSE")).otherwise(F.concat(doc_id.cast("string"), F.lit(".txt")))
    folders = [F.floor(doc_id / 256).cast("string"), F.floor(doc_id / 16).cast("string")]
    path = F.when(doc_id.isNotNull(), F.concat_ws("/", "source", *folders, name))
    files = _table(spark, sf_dir, "documents").select("doc_id", "text", path.alias("path"))
    return licenses.scan(files, Scratch(spark))


@register
def op13_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in pieces of binary length up to 1024 tokens, each a sequence."""
    pieces = decomposition.binary_pieces(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        1024,
        0,
    )
    return decomposition.bucket(pieces, ["doc_id", "start", "ids_crc32"], Scratch(spark))


@register
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two to four words of every language."""
    return phrases.collocations(_table(spark, sf_dir, "documents"), Scratch(spark))


ORACLES["op12_phrase_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), grams AS (
    SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
    FROM worded, (VALUES (1), (2), (3), (4)) sizes(k) WHERE len(w) >= k
), f AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1
), scored AS (
    SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
           (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score
    FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.cut], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')
), least AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
    SELECT lang, part, max(a) AS longer FROM (
        SELECT lang, f AS a, unnest(flatten([
            [array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') FOR i IN range(1, k - s + 2)] FOR s IN range(2, k)
        ])) AS part
        FROM f WHERE k > 2
    ) GROUP BY lang, part
), kept AS (
    SELECT least.* FROM least LEFT JOIN inside ON inside.lang = least.lang AND part = phrase
    WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


@register
def op11_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every hundredth embedding; every seventh changes its label first."""
    vec_id = F.col("vec_id")
    label = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    embeddings = _table(spark, sf_dir, "embeddings")
    return hard_negatives.mine(embeddings, Scratch(spark), is_anchor=vec_id % 100 == 0, label=label)


ORACLES["op11_cover_tree_negatives"] = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS v, row_number() OVER () AS row
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, a.row AS anchor, b.vec_id, b.row, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON len(a.v) = len(b.v) AND a.row <> b.row
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, row) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.vec_id NULLS LAST, n.row) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""
