import re
from collections import Counter, defaultdict

import cases
import pyarrow as pa
import pytest

from fairweather.llm import line_frequency as lf
from fairweather.llm import tokens
from fairweather.session import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    again = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again)


def normal(line):
    return " ".join(WORD.findall(line.lower()))


def verdicts(rows, rules=lf.Rules()):
    """(doc, source, text) -> statistics, base_failed, removed line numbers, kept."""
    holding, documents = defaultdict(set), defaultdict(set)
    for n, (_, text, source) in enumerate(rows):
        document = (text or "") if rules.count_texts else n
        documents[source].add(document)
        for line in (text or "").split("\n"):
            if normal(line):
                holding[(source, normal(line))].add(document)
    found = []
    for doc, text, source in rows:
        s = statistics(text)
        failed = s[0] < rules.min_words or 100 * s[4] > rules.max_repeated_percent * s[0]
        limit = max(rules.min_documents, rules.max_share * len(documents[source]))
        gone = [
            (n, len(WORD.findall(x)))
            for n, x in enumerate((text or "").lower().split("\n"))
            if normal(x) and len(holding[(source, normal(x))]) > limit
        ]
        left = s[0] - sum(w for _, w in gone)
        kept = not failed and left >= rules.min_words and left >= rules.min_left * s[0]
        found.append((doc, *s, failed, tuple(n for n, _ in gone), kept))
    return Counter(found)


def judged(spark, frame, rules=lf.Rules()):
    rows = lf.judge(frame, Scratch(spark), keep=["doc_id"], rules=rules).collect()
    return Counter(
        (r["doc_id"], *[r[s] for s in lf.STATISTICS], r["base_failed"], tuple(r["removed_lines"]), r["kept"])
        for r in rows
    )


@pytest.mark.parametrize("rules", [lf.Rules(), lf.Rules(min_documents=1, max_share=0.02), lf.Rules(min_documents=1, max_share=0.02, count_texts=True)])
@pytest.mark.parametrize("odd", [True, False])
def test_verdicts(spark, tmp_path, odd, rules):
    folder = cases.SF
    if odd:
        cases.documents(spark, folder := tmp_path)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in frame.collect()]
    assert judged(spark, frame, rules) == verdicts(rows, rules)


def test_frequent_lines_go_and_depleted_documents_are_rejected(spark):
    own = "\n".join(" ".join(f"w{n}x{k}" for k in range(12)) for n in range(3))
    rows = [(n, f"Shared  Line of\twords\n{own.replace('w', f'v{n}')}", "h") for n in range(60)]
    rows += [(100, "shared line of words\n" * 6 + "and some seven other words stand here alone", "h")]
    rows += [(101, f"shared line of words\n{own}", "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rules = lf.Rules(max_repeated_percent=1000)
    assert judged(spark, frame, rules) == verdicts(rows, rules)
    found = {r["doc_id"]: r for r in lf.judge(frame, Scratch(spark), keep=["doc_id", "text"], rules=rules).collect()}
    assert found[5]["removed_lines"] == [0] and found[5]["kept"]
    assert not found[100]["kept"] and found[101]["removed_lines"] == []
    table = spark.createDataFrame([found[5]])
    text = table.select(lf.without_lines(table.text, table.removed_lines)).first()[0]
    assert text == found[5]["text"].split("\n", 1)[1]


def test_copies_are_documents_unless_texts_are_counted(spark):
    page = "\n".join(" ".join(f"c{n}x{k}" for k in range(9)) for n in range(3))
    rows = [(n, page, "h") for n in range(40)]
    rows += [(100 + n, " ".join(f"o{n}x{k}" for k in range(30)), "h") for n in range(60)]
    frame = spark.createDataFrame([(*r, "k", 5) for r in rows], "doc_id long, text string, source string, kept string, n_words int")
    for count_texts in (False, True):
        rules = lf.Rules(count_texts=count_texts)
        assert judged(spark, frame, rules) == verdicts(rows, rules)
        found = lf.judge(frame, Scratch(spark), keep=frame.columns, rules=rules, into="verdict").collect()
        assert {r["doc_id"] for r in found if not r["verdict"]["kept"]} == (set() if count_texts else set(range(40)))
        assert {(r["kept"], r["n_words"]) for r in found} == {("k", 5)}


def test_the_query(spark, tmp_path):
    rows = cases.run(spark, "op9_line_frequency_rules", cases.SF)
    assert len(rows) == 200 and sum(r["kept"] for r in rows) > 140
    cases.documents(spark, tmp_path, rows=[])
    assert cases.run(spark, "op9_line_frequency_rules", tmp_path) == []


def test_a_batch_is_measured_in_parts_of_few_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "s", "text")], "doc_id int, source string, text string")
    measures, real = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda frame, f, schema: measures.append(f) or real(frame, f, schema))
    lf._measured(docs, "text", "source", ["doc_id"])
    texts = [None, "", "a b c\n" * 400_000, *["some words " * 1000] * 300, "d"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts, pa.string()), pa.array(["s"] * len(texts)), pa.array(range(len(texts)), pa.int32())],
        ["_whole", "_host", "k0"],
    )
    parts = list(measures[0](iter([batch.slice(0, 0), batch])))
    assert [n for p in parts for n in p.column("k0").to_pylist()] == list(range(len(texts)))
    assert [n for p in parts for n in p.column("n_words").to_pylist()] == [len((t or "").split()) for t in texts]
    sizes = [sum(len(texts[n] or "") for n in p.column("k0").to_pylist()) for p in parts]
    assert all(size <= tokens.BATCH_BYTES or p.num_rows == 1 for size, p in zip(sizes, parts, strict=True))
