import random
import struct
import zlib
from collections import Counter, defaultdict

import cases
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fairweather.llm import packing, tokens
from fairweather.session import Scratch


def plain_best_fit(lengths, capacity):
    """Number of bins of one-by-one best-fit decreasing."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [(room, n) for n, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting)[1]] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_runs_give_the_bins_of_one_by_one_packing(seed):
    draw = random.Random(seed)
    capacity = draw.choice([1, 7, 64, 100])
    lengths = [draw.randint(1, capacity) for _ in range(draw.randint(0, 300))]
    plan = packing.best_fit_decreasing(Counter(lengths), capacity)
    rooms = [capacity - sum(k * n for k, n in contents) for bins, contents in plan for _ in range(bins)]
    assert sorted(rooms) == plain_best_fit(lengths, capacity)
    placed = Counter()
    for bins, contents in plan:
        for length, each in contents:
            placed[length] += bins * each
    assert placed == Counter(lengths)


@pytest.mark.parametrize("odd", [True, False])
def test_pieces_and_places(spark, tmp_path, odd):
    folder = cases.SF
    if odd:
        cases.documents(spark, folder := tmp_path)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = Counter()
    for doc, text, *_ in cases.table(spark, folder):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        if len(ids) <= 1024:
            cuts = [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))
            wanted[(doc, piece, a, b - a, crc)] += 1
    rows = cases.run(spark, "op1_best_fit_packing", folder)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(r[n] for n in names) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) == len(plain_best_fit([r["length"] for r in rows], 1024))


def test_pieces_that_cannot_be_packed_keep_no_place(spark):
    rows = spark.createDataFrame([(1, None), (2, 0), (3, 11), (4, 10), (5, 3)], "id int, length long")
    packed = packing.pack(rows, "length", ["id"], 10, Scratch(spark)).collect()
    assert {r["id"]: r["offset"] for r in packed} == {1: None, 2: None, 3: None, 4: 0, 5: 0}


def test_an_empty_table(spark, tmp_path):
    cases.documents(spark, tmp_path, rows=[])
    assert cases.run(spark, "op1_best_fit_packing", tmp_path) == []


def test_ids_by_chunk_are_the_ids_of_the_whole_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    draw = random.Random(5)
    parts = [" ", "  ", "\n", "a", "don't", "<|endoftext|>", " ", "\x1c", "9", "é", "!?", "\t"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 14))) for _ in range(2000)]
    # every token of the vocabulary that is text by itself
    texts += [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size())]
    whole = [struct.pack(f"<{len(i)}I", *i) for i in (tokenizer.encode(t, add_special_tokens=False).ids for t in texts)]
    assert list(map(tokens.file_encoder(path, public_tokenizers.PATTERN), texts)) == whole
    assert all("".join(tokens.chunks(t)) == t for t in texts)
