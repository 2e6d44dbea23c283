import zlib

import cases
import numpy as np
import pytest

from fairweather.llm import quality


def held_out(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 4 == 2


def test_accuracy_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r[0]: r[1] for r in cases.table(spark, folder, "labels")}
    found = cases.run(spark, "op6_boosted_quality", folder)
    assert len(found) == 1000
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in found)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in found)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]
    assert len(judged) > 60 and np.mean([p == q for p, q in judged]) > 0.93


def walk(trees, row):
    total = trees.base
    for node in trees.roots:
        while trees.child[node] != node:
            node = trees.child[node] + (row[trees.feature[node]] > trees.limit[node])
        total += trees.value[node]
    return 1 / (1 + np.exp(-total))


def test_arrays_walk_like_trees_and_learn():
    draw = np.random.default_rng(0)
    features = draw.normal(size=(3000, len(quality.FEATURES)))
    features[:, 3] = features[:, 3].round()
    labels = ((features[:, 3] > 0) ^ (features[:, 5] > 0.5)).astype(float)
    trees = quality.fit(features[:2000], labels[:2000])
    scores = trees.score(features[2000:])
    assert np.allclose(scores[:50], [walk(trees, r) for r in features[2000:2050]])
    assert ((scores > 0.5) == labels[2000:]).mean() > 0.97


@pytest.mark.parametrize("labels", [[], [1.0] * 5, [0.0] * 5])
def test_one_class_or_none_gives_a_constant(labels):
    trees = quality.fit(np.zeros((len(labels), len(quality.FEATURES))), np.array(labels))
    scores = trees.score(np.zeros((3, len(quality.FEATURES))))
    assert np.allclose(scores, (sum(labels) + 1) / (len(labels) + 2))


def test_odd_texts(spark, tmp_path):
    given = cases.documents(spark, tmp_path)
    labels = [(g[0], n % 3 if n % 4 else None, 0) for n, g in enumerate(given)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = cases.run(spark, "op6_boosted_quality", tmp_path)
    assert len(found) == len(given) and all(0 <= r["score"] <= 1 for r in found)
    assert all(len(quality.document_statistics(t)) == len(quality.FEATURES) for t in cases.ODD_TEXTS)
    assert len({r["score"] for r in found if r["doc_id"] in (0, 1)}) == 1


def plain_tree(rows, binned, cuts, gradient, curvature, depth, settings):
    """One tree, split by split: (feature, limit, left, right) or a value."""
    s = settings.smoothing
    g, h = gradient[rows].sum(), curvature[rows].sum()
    best = (1e-9, None)
    for f in range(binned.shape[1]) if depth < settings.depth else ():
        for b in range(len(cuts[f])):
            left = rows[binned[rows, f] <= b]
            lg, lh = gradient[left].sum(), curvature[left].sum()
            if lh < settings.least_rows or h - lh < settings.least_rows:
                continue
            gain = lg**2 / (lh + s) + (g - lg) ** 2 / (h - lh + s) - g**2 / (h + s)
            if gain > best[0] + 1e-9:
                best = (gain, (f, b))
    if best[1] is None:
        return settings.rate * g / (h + s)
    f, b = best[1]
    sides = [rows[binned[rows, f] <= b], rows[binned[rows, f] > b]]
    return (f, b, *[plain_tree(side, binned, cuts, gradient, curvature, depth + 1, settings) for side in sides])


def plain_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2 + (row[tree[0]] > tree[1])]
    return tree


def test_trees_against_splitting_one_by_one():
    draw = np.random.default_rng(4)
    features = draw.normal(size=(400, 4)).round(1)
    labels = ((features[:, 1] > 0.2) ^ (features[:, 2] > 0)).astype(float)
    labels[draw.random(400) < 0.1] = 1
    settings = quality.Settings(trees=4, depth=2)
    trees = quality.fit(features, labels, settings)
    bins = np.linspace(0, 1, quality.BINS + 1)[1:-1]
    cuts = [np.unique(np.quantile(features[:, f], bins)) for f in range(4)]
    binned = np.stack([np.searchsorted(c, features[:, f]) for f, c in enumerate(cuts)], axis=1)
    positive = (labels.sum() + 1) / (len(labels) + 2)
    raw = np.full(400, np.log(positive / (1 - positive)))
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-raw))
        tree = plain_tree(np.arange(400), binned, cuts, labels - p, p * (1 - p), 0, settings)
        raw += [plain_value(tree, row) for row in binned]
    assert np.allclose(trees.score(features), 1 / (1 + np.exp(-raw)))


def test_a_text_that_repeats_is_a_part_of_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "TRAINING_ROWS", 200)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda features, labels, settings: seen.append((len(labels), labels.mean())))
    same = spark.range(4000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'the one text', concat('text ', id)) AS text", "int(id % 2) AS quality")
    quality.learn(same)
    assert 120 < seen[0][0] < 300 and 0.35 < seen[0][1] < 0.65
    # rows that no column tells apart
    quality.learn(same.selectExpr("'the one text' AS text", "1 AS quality"))
    assert seen[1][0] <= 400


def test_an_empty_table(spark, tmp_path):
    cases.documents(spark, tmp_path, rows=[])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cases.run(spark, "op6_boosted_quality", tmp_path) == []
