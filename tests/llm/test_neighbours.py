import math
from collections import Counter

import cases
import numpy as np
import pytest

from fairweather.llm import neighbours
from fairweather.llm.queries import QUERIES
from fairweather.session import Scratch


def expected(rows, threshold=0.93):
    """(vec_id, n_links, component_id, kept) of rows (vec_id, values, label), by comparing all pairs."""
    usable = [
        n
        for n, (_, v, label) in enumerate(rows)
        if label is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)
    ]
    root = list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    links = [0] * len(rows)
    for label in {rows[n][2] for n in usable}:
        group = [n for n in usable if rows[n][2] == label]
        for size in {len(rows[n][1]) for n in group}:
            same = [n for n in group if len(rows[n][1]) == size]
            vectors = np.array([rows[n][1] for n in same], float)
            vectors /= np.abs(vectors).max(axis=1, keepdims=True)
            vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
            close = vectors @ vectors.T >= threshold
            for i, j in zip(*np.nonzero(close)):
                if i != j:
                    links[same[i]] += 1
                    a, b = find(same[i]), find(same[j])
                    root[max(a, b)] = min(a, b)
    least = {}
    for n, (key, _, _) in enumerate(rows):
        if key is not None:
            least[find(n)] = min(key, least.get(find(n), key))
    return [(key, links[n], least.get(find(n)), key == least.get(find(n))) for n, (key, _, _) in enumerate(rows)]


def recall(found, rows):
    """Share of the true links that were found; nothing may be found beyond them."""
    true, got = Counter(), Counter()
    for key, links, *_ in expected(rows):
        true[key] += links
    for r in found:
        got[r["vec_id"]] += r["n_links"]
    assert all(got[k] <= true[k] for k in true)
    return sum(got.values()) / sum(true.values()) if true.total() else 1.0


def plant(rows, draw, pairs):
    """Some vectors again, turned to cosines around the threshold, and groups of near copies."""
    found, key = list(rows), max(r[0] for r in rows) + 1
    for n in range(pairs):
        _, values, label = rows[n * 7 % len(rows)]
        for cosine in (0.999, 0.94, 0.931, 0.929, 0.9):
            own = np.array(values) / np.linalg.norm(values)
            noise = draw.normal(size=len(own))
            noise -= (noise @ own) * own
            turned = cosine * own + np.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise)
            found.append((key, [float(np.float32(x)) for x in turned], label))
            key += 1
    return found


@pytest.mark.parametrize("sf,pairs", [("sf0.001", 0), ("sf0.001", 30), ("sf0.1", 100)])
def test_the_query_finds_planted_links(spark, tmp_path, sf, pairs):
    given = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = plant([(r["vec_id"], r["embedding"], r["label"]) for r in given.collect()], np.random.default_rng(pairs), pairs)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = cases.run(spark, "op7_small_world_neighbours", tmp_path)
    assert len(found) == len(rows)
    assert sum(r["n_links"] for r in found) > 2 * pairs or not pairs
    assert recall(found, rows) > 0.99
    components = {r["vec_id"]: (r["component_id"], r["kept"]) for r in found}
    wanted = {key: (component, kept) for key, _, component, kept in expected(rows)}
    assert sum(components[k] == wanted[k] for k in wanted) > 0.99 * len(rows)
    assert all(r["audit_recall"] >= 0.98 for r in found)


def test_shards_copies_and_odd_vectors(spark, monkeypatch, tmp_path):
    # functions travel by value, and so do these limits
    monkeypatch.setattr(neighbours, "SHARD", 60)
    monkeypatch.setattr(neighbours, "QUERIES", 100)
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 8))
    rows = [(n, (centres[n % 40] + draw.normal(size=8) * 0.2).tolist(), n % 2) for n in range(400)]
    rows += [(n + 400, rows[n % 7][1], rows[n % 7][2]) for n in range(60)]
    rows += [(500, [1.0] * 8, None), (501, None, 1), (502, [0.0] * 8, 1), (503, [1.0] * 7 + [None], 1)]
    rows += [(504, [float("nan")] * 8, 1), (505, [float("inf")] + [1.0] * 7, 1), (506, [], 1)]
    rows += [(507, [1.0, 2.0], 1), (508, [1e30, 2e30], 1), (None, [1.0, 2.0], 1), (509, [2.0, 4.1], 1)]
    rows += [(510, [5.0], 7), (510, [5.0], 7)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    single = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for k, v, c in rows]
    found = neighbours.near_duplicates(frame, Scratch(spark)).collect()
    assert recall(found, single) > 0.99
    exact = {r for r in expected(single) if r[0] is None or r[0] >= 500}
    assert {tuple(r)[:4] for r in found if r[0] is None or r[0] >= 500} == exact
    assert {r["audit_recall"] is None for r in found if r["vec_id"] == 500} == {True}
    frame.limit(0).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op7_small_world_neighbours"](spark, str(tmp_path)).collect() == []


def test_beams_and_links_reach_a_whole_group():
    draw = np.random.default_rng(0)
    vectors = np.concatenate([draw.normal(size=(900, 16)), draw.normal(size=16) + draw.normal(size=(300, 16)) * 0.05])
    close = neighbours.unit(vectors) @ neighbours.unit(vectors).T >= 0.93
    found = dict(neighbours.links_to_shard(vectors, vectors, 0.93))
    missed = sum(len(np.setdiff1d(np.flatnonzero(close[n]), found[n])) for n in range(len(vectors)))
    assert missed <= 0.01 * close.sum()
    assert all(close[n][found[n]].all() for n in range(len(vectors)))


def test_an_audit_asks_what_has_links_and_widens(monkeypatch):
    draw = np.random.default_rng(0)
    vectors = draw.normal(size=(1500, 48))
    audit = neighbours.Audit()
    assert all(len(near) == 1 for _, near in neighbours.links_to_shard(vectors, vectors, 0.93, audit))
    # no vector but the own one is near, and still the audit has links to look for
    assert audit.true >= neighbours.AUDITED // 2 and audit.recall >= neighbours.RECALL

    widths = []
    within = neighbours.Graph.within

    def short_sighted(self, queries, least, width):
        widths.append(width)
        found = within(self, queries, least, width)
        return found if width >= 4 * neighbours.BEAM else [f[:0] for f in found]

    monkeypatch.setattr(neighbours.Graph, "within", short_sighted)
    audit = neighbours.Audit()
    list(neighbours.links_to_shard(vectors[:300], vectors[:300], 0.93, audit))
    assert audit.width == 4 * neighbours.BEAM and set(widths) == {neighbours.BEAM * k for k in (1, 2, 4)}
