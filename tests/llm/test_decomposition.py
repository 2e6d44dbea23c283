import struct
import zlib
from collections import Counter

import cases
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fairweather.llm import decomposition, tokens
from fairweather.session import Scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("longest", [1, 8, 1024])
def test_lengths_are_the_binary_digits(longest):
    for n in range(1, 3000):
        lengths = decomposition.binary_lengths(n, longest)
        assert sum(lengths) == n
        assert lengths == sorted(lengths, reverse=True)
        short = [k for k in lengths if k < longest]
        assert len(set(short)) == len(short) and all(k.bit_count() == 1 and k <= longest for k in lengths)


def test_a_length_that_is_no_power_is_refused(spark):
    with pytest.raises(ValueError):
        decomposition.binary_pieces(spark.createDataFrame([(1, "a")], "doc_id int, text string"), PATH, "", 1000, 0)


@pytest.mark.parametrize("odd", [True, False])
def test_pieces_cover_every_document(spark, tmp_path, odd):
    folder = cases.SF
    if odd:
        cases.documents(spark, folder := tmp_path)
    tokenizer = Tokenizer.from_file(PATH)
    wanted = Counter()
    for doc, text, *_ in cases.table(spark, folder):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        while at < len(ids):
            size = 1024
            while size > len(ids) - at:
                size //= 2
            crc = zlib.crc32(struct.pack(f"<{size}I", *ids[at : at + size]))
            wanted[(doc, at, size, crc, len(ids), 0)] += 1
            at += size
    rows = cases.run(spark, "op13_power_of_two_packing", folder)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset"]
    assert Counter(tuple(r[n] for n in names) for r in rows) == wanted
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    for length in {r["length"] for r in rows}:
        bucket = [r for r in rows if r["length"] == length]
        assert sorted(r["bucket_row"] for r in bucket) == list(range(len(bucket)))
        numbers = [r["sequence_id"] for r in bucket]
        assert max(numbers) - min(numbers) == len(bucket) - 1


def test_ids_and_clashing_names(spark):
    text = "one two three four five six seven"
    rows = spark.createDataFrame([(7, text, 1, 2)], "doc_id int, text string, bucket_row int, _part int")
    pieces = decomposition.binary_pieces(rows, PATH, public_tokenizers.PATTERN, 4, 0, ids=True)
    found = decomposition.bucket(pieces, ["start"], Scratch(spark)).orderBy("start").collect()
    ids = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert [i for r in found for i in r["ids"]] == [*ids, 0]


def test_null_lengths_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, 4), (3, None), (4, 2)], "id int, length long")
    found = {r["id"]: r["sequence_id"] for r in decomposition.bucket(rows, ["id"], Scratch(spark)).collect()}
    assert {found[1], found[3]} == {0, 1} and (found[4], found[2]) == (2, 3)
    cases.documents(spark, tmp_path, rows=[])
    assert cases.run(spark, "op13_power_of_two_packing", tmp_path) == []


@pytest.mark.parametrize("slice_bytes", [16, 200, 4 << 20])
def test_columns_are_encoded_as_texts_one_by_one(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(tokens, "SLICE_BYTES", slice_bytes)
    texts = [r[0] for r in spark.read.parquet(f"{cases.SF}/documents.parquet").select("text").limit(60).collect()]
    texts += [*cases.ODD_TEXTS, " a", "a ", "  a  b", "a \n b", "　x 　x"]
    one = tokens.file_encoder(PATH, public_tokenizers.PATTERN)
    encode = tokens.ColumnEncoder(PATH, public_tokenizers.PATTERN)
    assert list(encode(pa.array(texts))) == [one(t or "") for t in texts]
    assert list(encode(pa.array(texts).slice(7, 9))) == [one(t or "") for t in texts[7:16]]
    assert list(encode(pa.array([], pa.string()))) == []
