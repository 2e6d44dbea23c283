import random
import re
from collections import Counter

import cases
import pytest

from fairweather.llm import jaccard
from fairweather.llm.components import connected_components
from fairweather.session import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, words=4):
    found = WORD.findall((text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def least_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def groups(rows, percent=85, words=4):
    """(doc, size, component) of rows (doc, text) with distinct ids, by comparing all pairs."""
    sets = {doc: shingle_set(text, words) for doc, text in rows}
    docs = sorted(d for d in sets if sets[d])
    links = []
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if 100 * small >= percent * large:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (small + large - common):
                    links.append((a, b))
    component = least_reachable(sets, links)
    return Counter((d, len(s), component[d]) for d, s in sets.items())


def found(spark, rows, **threshold):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    result = jaccard.similar_groups(frame, Scratch(spark), threshold=jaccard.Threshold(**threshold))
    return Counter(map(tuple, result.collect()))


def test_the_query(spark):
    rows = [(r[0], r[1]) for r in cases.table(spark, cases.SF)]
    assert Counter(
        (r["doc_id"], r["n_shingles"], r["component_id"])
        for r in cases.run(spark, "op8_set_relation_jaccard", cases.SF)
    ) == groups(rows)


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        at = draw.randrange(len(words))
        words[at : at + draw.choice([0, 1, 1, 2])] = [f"new{draw.random()}"] * draw.choice([0, 1, 1])
    return words


@pytest.mark.parametrize("seed", range(2))
def test_chains_families_and_passages_around_the_threshold(spark, seed, monkeypatch):
    draw = random.Random(seed)
    # few sets make a frequent shingle here, so that the order matters
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    # and lists are cut in chunks
    monkeypatch.setattr(jaccard, "LONG_LIST", [3, 8192][seed])
    monkeypatch.setattr(jaccard, "MEET_SALTS", [2, 32][seed])
    passage = [f"p{n}" for n in range(60)]
    rows = []
    for family in range(25):
        words = [f"w{family}x{draw.randrange(500)}" for _ in range(draw.choice([3, 5, 12, 60, 150, 300]))]
        for _ in range(draw.choice([1, 2, 5, 25])):
            words = edited(draw, words, draw.choice([0, 1, 1, 2, 4])) if len(words) > 6 else words
            text = [*words, *passage] if draw.random() < 0.3 else words
            rows.append(" ".join(text))
    rows = list(enumerate(rows))
    draw.shuffle(rows)
    assert found(spark, rows) == groups(rows)
    assert found(spark, rows, percent=60, words=2) == groups(rows, 60, 2)


def test_odd_texts(spark, tmp_path):
    texts = [t for t in cases.ODD_TEXTS for _ in range(2)] + ["One TWO three", "É a b c", "é a b c"]
    rows = list(enumerate(texts))
    assert found(spark, rows) == groups(rows)
    # repeated rows and null keys
    twice = [*rows, *rows, (None, "one two three"), (None, "nobody else says this")]
    result = found(spark, twice)
    assert all(result[row] == 2 for row in groups(rows))
    assert result[(None, 1, 4 * 2)] == 1 and result[(None, 1, None)] == 1
    cases.documents(spark, tmp_path, rows=[])
    assert cases.run(spark, "op8_set_relation_jaccard", tmp_path) == []


def test_answers_are_derived_for_a_large_group_of_near_copies(spark):
    draw = random.Random(3)
    base = [f"b{n}" for n in range(300)]
    rows = [(n, " ".join(edited(draw, base, 1))) for n in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark)
    threshold = jaccard.Threshold()
    sets = jaccard._described(frame, "doc_id", "text", 4).select("sig", "n", "least").dropDuplicates(["sig"])
    texts = jaccard._packed_texts(frame, "text", 4)
    frequent, _ = jaccard._frequent(texts, threshold)
    sets = scratch.materialize(sets.join(jaccard._rare(texts, frequent, threshold), "sig"), "sets")
    led = jaccard._with_leaders(sets, texts, threshold, scratch)
    assert led.select("leader").distinct().count() < 20
    assert found(spark, rows) == groups(rows)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(draw.choice([0, 120, 260]))]
    links += [(n, n + 1) for n in range(1000, 1060)] + [(2000, n) for n in range(2000, 2050)]
    frame = spark.createDataFrame(links, "a long, b long")
    components = dict(map(tuple, connected_components(frame, Scratch(spark)).collect()))
    assert components == least_reachable({n for link in links for n in link}, links)
