import zlib
from collections import Counter

import cases
import numpy as np

from fairweather.llm import language


def held_out(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 4 == 2


def test_accuracy_on_held_out_documents(spark):
    rows = {r[0]: r for r in cases.table(spark, "/root/testdata/sf0.01")}
    found = cases.run(spark, "op4_hyperdimensional_language", "/root/testdata/sf0.01")
    assert len(found) == len(rows)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in found)
    judged = [r["lang_pred"] == rows[r["doc_id"]][2] for r in found if r["held_out"] and rows[r["doc_id"]][2]]
    assert len(judged) > 150 and sum(judged) / len(judged) > 0.98


def test_odd_texts(spark, tmp_path):
    given = cases.documents(spark, tmp_path)
    found = cases.run(spark, "op4_hyperdimensional_language", tmp_path)
    assert Counter(r["doc_id"] for r in found) == Counter(g[0] for g in given)
    silent = {g[0] for g in given if not any(c.isalpha() for c in g[1] or "")} - {None}
    for r in found:
        if r["doc_id"] is not None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0) if r["doc_id"] in silent else r["lang_pred"] == "en"


def test_nothing_to_learn_from(spark, tmp_path):
    cases.documents(spark, tmp_path, rows=[(1, "some words", None, "s", 1, None, None)])
    (row,) = cases.run(spark, "op4_hyperdimensional_language", tmp_path)
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    (tmp_path / "none").mkdir()
    cases.documents(spark, tmp_path / "none", rows=[])
    assert cases.run(spark, "op4_hyperdimensional_language", tmp_path / "none") == []


def test_bundles_are_sums_of_bound_letters():
    letters = language.Letters(64)
    total = letters.bundle("Ab c!")

    def vector(char):
        return letters.kept[letters.row_of[ord(char)]].astype(int)

    padded = " ab c "
    wanted = sum(
        np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c) for a, b, c in zip(padded, padded[1:], padded[2:])
    )
    assert (total == wanted).all()
    assert (language.Letters(64).bundle("c ab") == language.Letters(64).bundle("C  --\n ab")).all()


def plain_vector(text, row_of, kept):
    """The sum of the trigrams' vectors, letter by letter."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = f" {' '.join(letters.split(' '))} "
    while "  " in padded:
        padded = padded.replace("  ", " ")
    total = np.zeros(kept.shape[1])
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        x, y, z = (kept[row_of[ord(ch)]].astype(float) for ch in (a, b, c))
        total += np.roll(x, 2) * np.roll(y, 1) * z
    return total


def test_predictions_against_comparing_one_by_one(spark):
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").collect() if len(r["text"] or "") < 3000]
    texts = [(t, c) for t, c in rows if c is not None and any(x.isalpha() for x in t or "")]
    letters = language.Letters()
    for t, _ in texts:
        letters.bundle(t)
    unit, sums = [], {}
    for t, c in texts[:80]:
        v = plain_vector(t, letters.row_of, letters.kept)
        unit.append(v / np.linalg.norm(v))
        sums[c] = sums.get(c, 0) + unit[-1]
    frame = spark.createDataFrame([(n, t, c, 0.5) for n, (t, c) in enumerate(texts[:80])], "n int, text string, lang string, score double")
    profiles = language.learn(frame)
    assert profiles.languages == sorted(sums)
    for name, prototype in zip(profiles.languages, profiles.prototypes):
        assert np.allclose(prototype, sums[name] / np.linalg.norm(sums[name]))
    found = language.predict(frame, profiles, names=("own", "sure", "by")).orderBy("n").collect()
    for r, v in zip(found, unit):
        cosines = sorted((float(v @ p), -k) for k, p in enumerate(profiles.prototypes))
        assert r["own"] == profiles.languages[-cosines[-1][1]] and abs(r["sure"] - cosines[-1][0]) < 1e-9
        assert abs(r["by"] - (cosines[-1][0] - max(0, cosines[-2][0]))) < 1e-9 and r["score"] == 0.5


def test_equal_cosines_go_to_the_first_language_by_name(spark):
    same = [(1, "the very same text", "zz"), (2, "the very same text", "aa")]
    frame = spark.createDataFrame(same, "n int, text string, lang string")
    profiles = language.learn(frame)
    assert {r["lang_pred"] for r in language.predict(frame, profiles).collect()} == {"aa"}
    assert {r["margin"] for r in language.predict(frame, profiles).collect()} == {0.0}


def test_many_languages_are_learnt(spark):
    frame = spark.range(1500).selectExpr("concat('w', id, ' q') AS text", "concat('l', id) AS lang")
    assert len(language.learn(frame).languages) == 1500
