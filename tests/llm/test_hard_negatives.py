import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fairweather.llm import hard_negatives
from fairweather.llm.covertree import CoverTree
from fairweather.llm.queries import ORACLES, QUERIES
from fairweather.session import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int, vec int, raw string, row long"


def expected(rows, positives=5, negatives=10):
    """The contract's rows for (vec_id, values, label), comparing each anchor with everything."""
    usable = []
    for n, (key, values, label) in enumerate(rows):
        if label is None or values is None or any(x is None or not math.isfinite(x) for x in values):
            continue
        if key is not None and key % 7 == 0:
            label = (label + 1) % 10
        usable.append((key, n, label, [math.floor(256 * x) for x in values]))
    found = Counter()
    for key, n, label, own in usable:
        if key is None or key % 100:
            continue
        scored = [
            (-sum(a * b for a, b in zip(own, v)), other is None, other or 0, m, other, c)
            for other, m, c, v in usable
            if m != n and len(v) == len(own)
        ]
        scored.sort(key=lambda r: r[:4])
        for p in [r for r in scored if r[5] == label][:positives]:
            inside = [r for r in scored if r[5] != label and -30 * p[0] <= -100 * r[0] <= -90 * p[0]]
            for rank, r in enumerate(inside[:negatives], 1):
                found[key, p[4], rank, r[4], -p[0], -r[0]] += 1
    return found


def mined(frame, spark, **options):
    key = F.col("vec_id")
    label = F.when(key % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(frame, Scratch(spark), is_anchor=key % 100 == 0, label=label, **options)
    return Counter(tuple(r) for r in found.collect())


@pytest.mark.parametrize("kind", ["random", "clustered", "copies", "one", "zero", "large"])
def test_a_tree_finds_what_comparing_finds(kind):
    draw = np.random.default_rng(3)
    vectors = {
        "random": draw.integers(-90, 90, (900, 16)),
        "clustered": draw.integers(-900, 900, (20, 6))[draw.integers(0, 20, 900)] + draw.integers(-9, 9, (900, 6)),
        "copies": draw.integers(-5, 5, (9, 8))[draw.integers(0, 9, 700)],
        "one": draw.integers(-5, 5, (1, 3)),
        "zero": np.zeros((60, 4), int),
        "large": draw.integers(-(2**28), 2**28, (300, 5)),
    }[kind]
    tree = CoverTree.from_bytes(CoverTree(vectors).to_bytes())
    assert sorted(tree.members) == list(range(len(vectors)))
    for query in vectors[:25]:
        scores = vectors @ query
        middle = int(np.median(scores))
        windows = [(None, None), (middle, None), (None, middle), (middle, int(scores.max()) - 1), (5, 4)]
        for (low, high), (rows, found) in zip(windows, tree.search(query, windows, 7, skip=3)):
            inside = (scores >= (low if low is not None else scores.min())) & (scores <= (high if high is not None else scores.max()))
            inside[3:4] = False
            wanted = np.flatnonzero(inside)
            wanted = wanted[np.lexsort((wanted, -scores[wanted]))][:7]
            assert rows.tolist() == wanted.tolist() and found.tolist() == scores[wanted].tolist()


def test_nodes_cover_what_is_below_and_siblings_are_apart():
    draw = np.random.default_rng(5)
    tree = CoverTree(draw.integers(-90, 90, (1500, 4)))
    points = tree._augmented()

    def below(node):
        a, b = tree.start[node], tree.end[node]
        return tree.members[a:b] if tree.leaf[node] else np.concatenate([below(n) for n in range(a, b)])

    for node in range(len(tree.centre)):
        away = np.linalg.norm(points[below(node)] - points[tree.centre[node]], axis=1)
        assert away.max() <= tree.radius[node] + 1e-6
        if not tree.leaf[node]:
            children = range(tree.start[node], tree.end[node])
            assert tree.centre[node] in tree.centre[list(children)]
            centres = points[tree.centre[list(children)]]
            gaps = np.linalg.norm(centres[:, None] - centres[None], axis=2)
            np.fill_diagonal(gaps, np.inf)
            # nets: no two centres within what a child may cover
            assert gaps.min() > tree.radius[list(children)].max() - 1e-6


def test_a_descent_leaves_nodes_out():
    draw = np.random.default_rng(1)
    vectors = draw.integers(-900, 900, (50, 6))[draw.integers(0, 50, 5000)] + draw.integers(-9, 9, (5000, 6))
    tree, opened = CoverTree(vectors), []
    products = tree.products
    tree.products = lambda rows, query: opened.append(len(rows)) or products(rows, query)
    tree.search(vectors[0], [(None, None)], 5)
    assert sum(opened) < 1000


@pytest.mark.parametrize("shard,anchors", [(8192, 2048), (40, 3)])
def test_odd_vectors_repeats_and_shards(spark, monkeypatch, tmp_path, shard, anchors):
    monkeypatch.setattr(hard_negatives, "SHARD", shard)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    draw = np.random.default_rng(2)
    rows = [(n, draw.normal(size=4).round(2).tolist(), int(draw.integers(0, 4))) for n in range(0, 700, 2)]
    rows += [(n, rows[5][1], 1) for n in range(1001, 1060)]  # copies: equal scores go by key
    rows += [(100, rows[3][1], 2), (100, rows[3][1], 2), (None, rows[5][1], 1), (None, [1.0] * 4, 2)]
    rows += [(1100, [1.0] * 4, None), (1200, None, 1), (1300, [1.0, None, 1.0, 1.0], 1)]
    rows += [(1400, [float("nan")] * 4, 1), (1500, [float("inf")] * 4, 1), (1600, [0.0] * 4, 1), (1700, [], 1), (1800, [], 2)]
    rows += [(1900, [1.0, 2.0], 1), (1901, [1.5, 2.0], 1), (1902, [0.5, 1.0], 3), (2000, [1e30] * 4, 1)]
    frame = spark.createDataFrame([(*r, 1, "r", 7) for r in rows], SCHEMA)
    single = [(k, v and [None if x is None else float(np.float32(x)) for x in v], c) for k, v, c in rows if k != 2000]
    assert mined(frame, spark) == expected(single)
    if shard > 100:
        assert mined(frame, spark, positives=2, negatives=3) == expected(single, 2, 3)
        frame.limit(0).write.parquet(f"{tmp_path}/embeddings.parquet")
        assert QUERIES["op11_cover_tree_negatives"](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_the_query_and_its_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    result = QUERIES["op11_cover_tree_negatives"](spark, folder)
    found = Counter(tuple(r) for r in result.collect())
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert found == expected(rows) and found
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert Counter(duck.execute(ORACLES["op11_cover_tree_negatives"]).fetchall()) == found
    assert result.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
