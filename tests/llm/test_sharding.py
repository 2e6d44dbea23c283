import math
import struct
import zlib
from collections import Counter, defaultdict

import cases
import pytest
from xxhash import xxh64

from fairweather.llm import sharding


def uniform(key, name):
    seed = 42 if key is None else xxh64(struct.pack("<q", key), seed=42).intdigest()
    return ((xxh64(name.encode(), seed=seed).intdigest() >> 12) + 0.5) / 2**52


def expected(key, n_shards):
    node, path = sharding.standard_tree(n_shards), ""
    while isinstance(node, dict):
        draws = []
        for child, below in node.items():
            name = f"{path}/{child}" if path else str(child)
            draws.append((-math.log(uniform(key, name)) / sharding._weight(below), name, below))
        _, path, node = min(draws, key=lambda d: d[:2])
    return int(path.split("/")[-1])


@pytest.mark.parametrize("odd", [True, False])
def test_shards_follow_the_draws_and_slots_have_no_gaps(spark, tmp_path, odd):
    folder = cases.SF
    if odd:
        cases.documents(spark, folder := tmp_path)
    given = Counter((r[0], r[1]) for r in cases.table(spark, folder))
    rows = cases.run(spark, "op10_hash_tree_sharding", folder)
    found, slots = Counter(), defaultdict(list)
    sizes = Counter()
    for (doc, text), n in given.items():
        raw = (text or "").encode()
        sizes[(doc, len(raw) + 1, zlib.crc32(raw))] += n
    for r in rows:
        found[(r["doc_id"], r["size"], r["text_crc32"])] += 1
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key"
        assert r["shard"] == expected(r["doc_id"], 16)
        assert r["grown_shard"] in (r["shard"], 16)
        assert r["grown_shard"] == expected(r["doc_id"], 17)
    assert found == sizes
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_every_step_of_growth_moves_rows_only_into_the_new_shard(spark):
    keys = spark.range(4000)
    before = None
    for n in range(12, 20):
        placed = {r[0]: r[1] for r in keys.select("id", sharding.shard_of(keys.id, sharding.standard_tree(n))).collect()}
        counts = Counter(placed.values())
        assert set(counts) == set(range(n))
        assert max(counts.values()) < 2 * 4000 / n
        if before and n > 16:
            assert all(placed[k] in (before[k], n - 1) for k in placed)
        before = placed


def test_movement_stays_in_the_subtrees_whose_weight_changes(spark):
    keys = spark.range(3000)
    tree = {"a": {"r": {0: 1.0, 1: 1.0}, "q": {2: 1.0}}, "b": {"r": {3: 2.0}}}
    heavier = {"a": {"r": {0: 1.0, 1: 1.0}, "q": {2: 1.0}}, "b": {"r": {3: 4.0}}}
    pairs = keys.select(sharding.shard_of(keys.id, tree), sharding.shard_of(keys.id, heavier)).collect()
    assert all(b in (a, 3) for a, b in pairs) and any(a != b for a, b in pairs)
    assert abs(sum(a == 3 for a, _ in pairs) / 3000 - 2 / 5) < 0.05
    without = {"a": {"r": {0: 1.0, 1: 1.0}, "q": {2: 1.0}}, "b": {"r": {3: 0.0}}}
    assert all(s != 3 for (s,) in keys.select(sharding.shard_of(keys.id, without)).collect())
    with pytest.raises(ValueError):
        sharding.shard_of(keys.id, {"a": {"r": {0: 0.0}}})
    with pytest.raises(ValueError):
        sharding.shard_of(keys.id, {"a": {"r": {0: -1.0, 1: 2.0}}})


def test_an_empty_table_has_no_shards(spark, tmp_path):
    cases.documents(spark, tmp_path, rows=[])
    assert cases.run(spark, "op10_hash_tree_sharding", tmp_path) == []
