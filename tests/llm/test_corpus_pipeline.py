import struct
import sys
import zlib
from collections import Counter
from pathlib import Path

import cases
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from test_jaccard import groups  # noqa: E402
from test_line_frequency import verdicts  # noqa: E402
from test_packing import plain_best_fit  # noqa: E402


@pytest.mark.parametrize("odd", [True, False])
def test_every_stage_against_brute_force_on_its_own_input(spark, tmp_path, odd):
    folder = cases.SF
    if odd:
        cases.documents(spark, folder := tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs.collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(folder)).write.parquet(f"{tmp_path}/stage{number}")
        columns, docs = docs.columns, spark.read.parquet(f"{tmp_path}/stage{number}")
        seen.append(docs.collect())
        assert number == 3 or docs.columns == columns
    given, spoken, clean, single, packed = seen

    def apart_from_language(rows):
        return Counter(tuple(v for k, v in r.asDict().items() if k != "lang") for r in rows)

    with_letters = [r for r in given if any(c.isalpha() for c in r["text"] or "")]
    assert apart_from_language(spoken) <= apart_from_language(with_letters)
    assert len(spoken) >= (0.9 if odd else 0.99) * len(with_letters) and all(r["lang"] for r in spoken)

    wanted = Counter()
    for (doc, *_, gone, kept), n in verdicts([(r["doc_id"], r["text"], r["source"]) for r in spoken]).items():
        if kept:
            wanted[doc] += n
    assert Counter(r["doc_id"] for r in clean) == wanted
    before = {(r["doc_id"], r["text"]) for r in spoken}
    assert all((r["doc_id"], r["text"]) in before or r["n_chars"] == len(r["text"]) for r in clean)

    keyed = [(r["doc_id"], r["text"]) for r in clean if r["doc_id"] is not None]
    kept = {doc for doc, _, component in groups(dict(keyed).items(), 80, 5) if doc == component}
    assert Counter(r["doc_id"] for r in single if r["doc_id"] is not None) == Counter(kept)
    assert Counter(r for r in single if r["doc_id"] is None) == Counter(r for r in clean if r["doc_id"] is None)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = Counter()
    for r in single:
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2]
        lengths[(r["doc_id"], len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))] += len(ids) <= 1024
    assert Counter((r["doc_id"], r["length"], r["ids_crc32"]) for r in packed if r["length"] == r["start"] + r["length"] and lengths[(r["doc_id"], r["length"], r["ids_crc32"])]) == +lengths
    assert len({r["sequence_id"] for r in packed}) == len(plain_best_fit([r["length"] for r in packed], 1024))


# Texts in languages that no document declares, and texts in none.
FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "qzxv kwjq vvkz xqqj zzwk jxkq vqzj wkxz qjvk xzqw kkvj zqxj wvkq jzxq kvwz qxjk zvqw jkxz qwvk xjzq",
]
SILENT = [None, "", " \n", "12 34 -- 56 : 78 ..... ### 90", "!?" * 50]


def test_the_language_stage_rejects_what_is_in_no_language(spark, tmp_path):
    given = spark.read.parquet(f"{cases.SF}/documents.parquet")
    rows = [tuple(r) for r in given.where("text rlike '[a-z]'").collect()]
    english = next(r[1] for r in rows if r[2] == "en" and 400 < len(r[1]) < 2000)
    planted = [(10_000 + n, t, "en" if n % 2 else None, "s", 1) for n, t in enumerate([*FOREIGN, *SILENT])]
    planted += [(20_000, english, None, "s", 1), (20_001, english, "fr", "s", 1), (20_002, "Avec.", "fr", "s", 1)]
    docs = spark.createDataFrame([*rows, *planted], given.schema)
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert set(kept) >= {r[0] for r in rows}, "clean documents stay"
    assert not [doc for doc in kept if 10_000 <= doc < 20_000], "foreign and silent ones go"
    # a missing language is filled in, a wrong one replaced; a short text is left as declared
    assert (kept[20_000], kept[20_001], kept[20_002]) == ("en", "en", "fr")
    assert all(kept[r[0]] == r[2] for r in rows if r[2] is not None and len(r[1]) > 200)


INNER_NAMES = (
    "score Lang_Pred margin _score verdict kept rows n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed"
    " removed_lines language label texts draw _row _host _text _lines _part sig packed leader component component_id"
    " n_shingles piece start length ids_crc32 sequence_id offset hash number k0 k1"
).split()


def test_columns_of_any_name_pass_through_all_stages(spark, tmp_path):
    given = spark.read.parquet(f"{cases.SF}/documents.parquet").limit(60)
    docs = given.select("*", *[F.concat(F.lit(f"{n}-"), "doc_id").alias(name) for n, name in enumerate(INNER_NAMES)])
    docs = docs.unionByName(docs.limit(3))  # and rows that repeat
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"{tmp_path}/stage{number}")
        result = spark.read.parquet(f"{tmp_path}/stage{number}")
        if number < 3:
            assert result.columns == docs.columns
            for row in result.collect():
                assert [row[name] for name in INNER_NAMES] == [f"{n}-{row['doc_id']}" for n in range(len(INNER_NAMES))]
        docs = result
    assert docs.count() > 30


def test_intermediate_tables_of_the_run_are_removed(spark, tmp_path):
    rows = corpus_pipeline.run(spark, cases.SF)
    assert rows.count()
    stages = [p for p in Path(spark.conf.get("spark.checkpoint.dir")).glob("stage-*")]
    (last,) = {Path(f.removeprefix("file://")).parent for f in rows.inputFiles()}
    assert last in stages and not [p for p in stages if p != last and any(q in p.name for q in ("stage-0", "stage-1"))]


def test_run_applies_the_stages(spark, tmp_path):
    rows = corpus_pipeline.run(spark, cases.SF).collect()
    assert rows and {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())
    cases.documents(spark, tmp_path, rows=[])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
