import base64
import hashlib
import random
import struct
from collections import Counter

import cases
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from fairweather.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("odd", [True, False])
def test_the_query_gives_the_library_s_ids_and_the_text_back(spark, tmp_path, library, odd):
    folder = cases.SF
    if odd:
        cases.documents(spark, folder := tmp_path)
    wanted = Counter()
    for doc, text, *_ in cases.table(spark, folder):
        ids = library.encode_ordinary(text or "")
        raw = struct.pack(f"<{len(ids)}I", *ids)
        back = hashlib.sha256((text or "").encode()).hexdigest()
        wanted[(doc, len(ids), hashlib.sha256(raw).hexdigest(), back)] += 1
    rows = cases.run(spark, "op5_recursive_bpe", folder)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(tuple(r[n] for n in names) for r in rows) == wanted


def test_words_of_any_bytes(library, monkeypatch):
    monkeypatch.setattr(bpe, "QUERY_ROWS", 2000)
    own = bpe.RecursiveBpe(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    draw = random.Random(1)
    parts = [" ", "  ", "\n", "\r\n", "a", "aa", "they're", "'s", "S", "<|endoftext|>", "　", "\x1c", "\x85", "9", "½", "é", "é", "!?", "\t", "​", "𝔘", "ß", "\x00"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 14))) for _ in range(1500)]
    texts += [chr(n) + "a " + chr(n) for n in range(0x3000) if not 0xD800 <= n < 0xE000]
    monkeypatch.setattr(bpe, "SLICE_BYTES", 4000)
    found, decoded = zip(*own.texts(pa.array(texts)))
    assert list(decoded) == [t.encode() for t in texts]
    assert [list(struct.unpack(f"<{len(f) // 4}I", f)) for f in found] == [library.encode_ordinary(t) for t in texts]
    assert [d.decode() for d in own.decode(found)] == texts


def ids(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def one_by_one(word, ranks):
    """Contracts the leftmost pair of the least rank until there is none."""
    parts = [word[n : n + 1] for n in range(len(word))]
    while True:
        best = min(((ranks[a + b], n) for n, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


@pytest.mark.parametrize("seed", range(6))
def test_many_pairs_in_a_step_are_the_pairs_one_by_one(monkeypatch, seed):
    """Vocabularies in no order of training, where a merge makes room for a lower rank."""
    monkeypatch.setattr(bpe, "LONG_WORD", 0)
    draw = random.Random(seed)
    letters = b"abc" if seed % 2 else b"ab"
    tokens = {bytes(draw.choices(letters, k=draw.randint(2, 5))) for _ in range(40)}
    order = [bytes([n]) for n in range(256)] + draw.sample(sorted(tokens), len(tokens))
    ranks = {token: n for n, token in enumerate(order)}
    own = bpe.RecursiveBpe(ranks, r".+")
    words = [bytes(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(300)] + [b"a" * 101, b"ab" * 77]
    assert [ids(f) for f in own.words(words)] == [[ranks[w]] if w in ranks else one_by_one(w, ranks) for w in words]


@pytest.mark.parametrize("kind", ["one letter", "letters", "base64", "two scripts"])
def test_a_long_word_ends(library, kind):
    draw = random.Random(4)
    word = {
        "one letter": "a" * 100_000,
        "letters": "".join(draw.choices("etaoinshrdlu", k=20_000)),
        "base64": base64.b64encode(draw.randbytes(75_000)).decode().replace("+", "x").replace("/", "y"),
        "two scripts": "".join(draw.choices("abcdefghijéüßжщя中文字", k=20_000)),
    }[kind]
    own = bpe.RecursiveBpe(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    (found, decoded), = own.texts(pa.array([word]))
    assert ids(found) == library.encode_ordinary(word) and decoded == word.encode()


def test_a_vocabulary_that_is_too_large_is_refused():
    ranks = {bytes([n]): n for n in range(256)} | {b"ab": 1 << 18}
    with pytest.raises(ValueError, match="too large"):
        bpe.merge_tables(ranks)


def test_ids_are_returned_and_other_columns_left_alone(spark, library):
    frame = spark.createDataFrame([(1, "one  two", 5), (2, None, 6)], "doc_id int, text string, n_tokens int")
    found = bpe.encode_and_decode(frame, RANKS, public_tokenizers.PATTERN, ids=True).orderBy("doc_id").collect()
    assert [r["ids"] for r in found] == [library.encode_ordinary("one  two"), []]


def test_an_empty_table(spark, tmp_path):
    cases.documents(spark, tmp_path, rows=[])
    assert cases.run(spark, "op5_recursive_bpe", tmp_path) == []


def test_short_words_of_a_length_share_small_queries(library, monkeypatch):
    own = bpe.RecursiveBpe(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "SHORT_ROWS", 400)
    asked, register = [], own.db.register

    class Database:
        def register(self, name, table):
            if name == "start":
                asked.append(Counter(table.column("word").to_pylist()))
            return register(name, table)

        def __getattr__(self, name):
            return getattr(type(own.db_itself), name).__get__(own.db_itself)

    own.db_itself, own.db = own.db, Database()
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdeé", k=draw.randint(2, 20))) for _ in range(200)]
    found = own.words([w.encode() for w in words])
    assert [ids(f) for f in found] == [library.encode_ordinary(w) for w in words]
    lengths = [n for query in asked for _, n in sorted(query.items())]
    assert lengths == sorted(lengths) and max(q.total() for q in asked) <= 100 and len(asked) > 10
