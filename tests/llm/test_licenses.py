import math
import re
from collections import Counter

import cases
import pytest

from fairweather.llm import licenses
from fairweather.llm.license_texts import TEMPLATES
from fairweather.session import Scratch


def vector(text, idf, unknown):
    counts = Counter(re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", text.lower()))
    return {t: n * idf.get(t, unknown) for t, n in counts.items()}


def cosines(passage):
    """Cosine of a passage with every template, written apart from the library."""
    texts = [(name, text) for name, own in TEMPLATES.items() for text in own]
    holding = Counter(t for _, text in texts for t in set(re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", text.lower())))
    idf = {t: math.log((1 + len(texts)) / (1 + n)) + 1 for t, n in holding.items()}
    unknown = math.log(1 + len(texts)) + 1
    own = vector(passage, idf, unknown)
    length = math.hypot(*own.values())
    for name, text in texts:
        other = vector(text, idf, unknown)
        product = sum(w * other.get(t, 0) for t, w in own.items())
        if product:
            yield -round(product / length / math.hypot(*other.values()), 9), name


def says(line):
    words = r"licenc|licens|copyright|spdx|permission is hereby|creative commons|public domain|\bcc[- ]by\b"
    return re.search(words, line.lower())


def expected(rows):
    """(key, path, license, cosine, found_in) of rows (key, path, text), folder by folder."""
    own, given = [], {}
    for _, path, text in rows:
        name = (path or "").split("/")[-1]
        is_file = re.match(r"(?i)(licen[cs]e|copying|unlicense|notice)([._-].*)?$", name)
        found = [x for x in (text or "").split("\n") if says(x)]
        found += [" ".join(p.split("\n")) for p in re.split(r"\n[ \t\r]*\n", text or "") if any(map(says, p.split("\n")))]
        found += [(text or "").replace("\n", " ")] if is_file and path is not None else []
        best = min((c for passage in set(found) for c in cosines(passage) if c[0] <= -0.75), default=None)
        own.append(best)
        if is_file and best:
            folder = path.rpartition("/")[0]
            given[folder] = min(given.get(folder, (1,)), (*best, path))
    result = []
    for (key, path, _), best in zip(rows, own):
        answer = (best[1], -best[0], path) if best else None
        if not answer and path is not None:
            parts = path.split("/")[:-1]
            for n in range(len(parts), -1, -1):
                if (folder := "/".join(parts[:n])) in given:
                    answer = (given[folder][1], -given[folder][0], given[folder][2])
                    break
        result.append((key, path, *(answer or (None, None, None))))
    return result


def rounded(rows):
    return Counter((a, b, c, None if d is None else round(d, 6), e) for a, b, c, d, e in rows)


MIT = "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software"


@pytest.mark.parametrize("empty", [True, False])
def test_files_inherit_from_the_nearest_folder(spark, empty):
    rows = [
        (1, "a/LICENSE", MIT),
        (2, "a/b/c/x.py", "print()"),
        (3, "a/b/y.py", "# Licensed under the Apache License, Version 2.0.\nprint()"),
        (4, "a/b/COPYING.txt", "nothing of the kind"),
        (5, "a/b/d/LICENCE.md", "This work is licensed under the GNU General Public License, version 3."),
        (6, "a/b/d/e/f/z", None),
        (7, "ab/x", ""),
        (8, None, "Released under the MIT License."),
        (9, None, "none"),
        (10, "LICENSE", "Licensed under CC BY-NC 4.0."),
        (11, "top", "t"),
        (12, "a/b/d/NOTICE", "Licensed under CC BY 4.0."),
        (13, "q/r", cases.LONG + "\nSPDX-License-Identifier: MIT\n" + cases.LONG),
        (14, "q/s", "this licence is of an unknown and quite different sort altogether"),
        (14, "q/s", "this licence is of an unknown and quite different sort altogether"),
    ]
    rows = [] if empty else rows
    frame = spark.createDataFrame(rows, "doc_id int, path string, text string").repartition(3)
    found = licenses.scan(frame, Scratch(spark)).collect()
    assert rounded(map(tuple, found)) == rounded(expected(rows))
    if rows:
        by_key = {r["doc_id"]: r["license"] for r in found}
        assert [by_key[n] for n in (1, 2, 3, 4, 6, 7, 8, 9, 11, 13, 14)] == [
            "MIT", "MIT", "Apache-2.0", "MIT", "CC-BY-4.0", "CC-BY-NC-4.0",
            "MIT", None, "CC-BY-NC-4.0", "MIT", "CC-BY-NC-4.0",
        ]


def test_the_query(spark, tmp_path):
    found = cases.run(spark, "op3_license_scan", cases.SF)
    texts = {r[0]: r[1] for r in cases.table(spark, cases.SF)}
    assert rounded(tuple(r.values()) for r in found) == rounded(expected([(r["doc_id"], r["path"], texts[r["doc_id"]]) for r in found]))
    assert len({r["license"] for r in found}) > 3
    cases.documents(spark, tmp_path, rows=[])
    assert cases.run(spark, "op3_license_scan", tmp_path) == []


def license_file(name, text):
    """A licence file as it is found: with a copyright line, and broken in lines."""
    words = f"Copyright (c) 2019 Some Person and others. All rights reserved. {text}".split()
    return "\n".join(" ".join(words[n : n + 11]) for n in range(0, len(words), 11))


def test_whole_licence_files_are_told_apart(spark):
    whole = {name: max(own, key=len) for name, own in TEMPLATES.items() if len(max(own, key=len)) > 400}
    assert {"BSD-2-Clause", "BSD-3-Clause", "MIT", "ISC", "Zlib", "Apache-2.0"} <= set(whole)
    rows = [(n, f"{name}/LICENSE", license_file(name, text)) for n, (name, text) in enumerate(whole.items())]
    # the body in a header of a source file, without a title
    rows += [(n + 100, f"src/{name}.py", license_file(name, text) + "\n\nimport this\n") for n, (name, text) in enumerate(whole.items())]
    frame = spark.createDataFrame(rows, "doc_id int, path string, text string")
    found = {r["doc_id"]: r["license"] for r in licenses.scan(frame, Scratch(spark)).collect()}
    assert found == {n + k: name for n, name in enumerate(whole) for k in (0, 100)}


def test_equal_cosines_go_by_name_and_repeats_are_judged_each(spark):
    templates = {"b": ["licence of sorts"], "a": ["licence of sorts"], "c": ["another licence"]}
    rows = [(1, "x/y", "licence of sorts"), (1, "x/y", "licence of sorts"), (2, "x/LICENSE", "of licence sorts"), (3, "x/z", "")]
    frame = spark.createDataFrame([(*r, "k", 1.0) for r in rows], "doc_id int, path string, text string, license string, cosine double")
    found = licenses.scan(frame, Scratch(spark), templates=templates, least=0.9).collect()
    assert sorted((r["doc_id"], r["license"], r["found_in"]) for r in found) == [
        (1, "a", "x/y"), (1, "a", "x/y"), (2, "a", "x/LICENSE"), (3, "a", "x/LICENSE"),
    ]


def test_a_long_licence_file_is_held_once(spark):
    text = cases.LONG * 10 + "\nSPDX-License-Identifier: MIT\n" + cases.LONG * 10
    frame = spark.createDataFrame([(1, "a/LICENSE", text), (2, "a/b", "x")], "doc_id int, path string, text string")
    found = licenses.scan(frame, Scratch(spark))
    assert {r["license"] for r in found.collect()} == {"MIT"}
    # nothing but paths, names and numbers is shuffled
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "Scan parquet" in plan
