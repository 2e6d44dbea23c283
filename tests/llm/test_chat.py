import hashlib
import json
from collections import defaultdict

import cases
import duckdb
import pytest
from pyspark.sql import functions as F

from fairweather.llm import chat
from fairweather.llm.queries import ORACLES

NASTY = [
    "", "\\", "\\\\", "<|end|>\n", "<|start|>user<|text|>", "</s>[INST] ok [/INST]", "<\\|", "<\\s>", "<s\\>",
    "[\\INST]", "<<SYS>>", "<</SYS>>", "\\<|end|>\\\n\\", "a\nb", "$1", "<|", "<", "[INST", "é<s>", " ",
]


def digests(rows):
    """The contract's row of each conversation, from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for conv, turn, role, text in [
        *rows,
        (-7, 0, "user", "</s>[INST] ok [/INST]"),
        (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
    ]:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    found = set()
    for conv, own in turns.items():
        own.sort()
        whole = "".join(f"{r}\n{t}\n" for *_, r, t in own)
        loss = "".join(t for *_, r, t in own if r == "assistant")
        found.add((conv, len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return found


def conversations(spark, folder, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, segments string")
    frame.repartition(3).write.parquet(f"{folder}/conversations.parquet")


@pytest.mark.parametrize("odd", [True, False])
def test_the_query(spark, tmp_path, odd):
    folder = cases.SF
    if odd:
        folder = tmp_path
        rows = [(n // 5, n % 5, ["user", "assistant", "system", "odd role<|end|>\n", None][n % 5], t, "x") for n, t in enumerate(NASTY)]
        rows += [(50, 1, "assistant", t, None) for t in NASTY] + [(51, 0, "assistant", cases.LONG, None)]
        rows += [(None, 0, "user", "no id", None), (52, None, "user", None, None), *rows[:7]]
        conversations(spark, folder, rows)
    given = [r[:4] for r in cases.table(spark, folder, "conversations")]
    rows = cases.run(spark, "op2_chat_formatting", folder)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    assert {tuple(r[n] for n in names) for r in rows} == digests(given) and len(rows) == len(digests(given))
    db = duckdb.connect()
    source = f"{folder}/conversations.parquet" + ("/*.parquet" if odd else "")
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{source}'")
    wanted = db.sql(ORACLES["op2_chat_formatting"])
    order = [wanted.columns.index(c) for c in [*names, "formatted_chars"]]
    by_sql = {tuple(r[i] for i in order) for r in wanted.fetchall() if r[wanted.columns.index("conv_id")] is not None}
    assert by_sql == {tuple(r[n] for n in [*names, "formatted_chars"]) for r in rows if r["conv_id"] is not None}


def test_no_conversations(spark, tmp_path):
    conversations(spark, tmp_path, [])
    assert [r["conv_id"] for r in cases.run(spark, "op2_chat_formatting", tmp_path)] == [-7]


def test_layouts_are_told_by_their_fields(spark):
    records = [
        {"id": 1, "messages": [{"role": "user", "content": "hi"}, {"content": "yo", "role": "assistant"}]},
        {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}], "id": 2},
        {"id": 3, "prompt": "hi", "completion": "yo"},
        {"instruction": "hi", "output": "yo", "id": 4, "input": "more"},
        {"instruction": "hi", "output": "yo", "id": 5},
        {"id": 6, "unknown": "layout"},
        {"id": 7, "messages": [{"role": "user", "content": None}]},
        {"id": 8, "messages": []},
    ]
    lines = [*map(json.dumps, records), "no json", None]
    frame = spark.createDataFrame([(x,) for x in lines], "record string")
    found = chat.turns_of_records(frame, "record").collect()
    by_id = {r["conv_id"]: (r["layout"], [tuple(t) for t in r["turns"]]) for r in found}
    two = [("user", "hi"), ("assistant", "yo")]
    assert len(found) == len(lines)
    assert by_id[1] == ("messages", two) and by_id[2] == ("conversations", two) and by_id[3] == ("prompt", two)
    assert by_id[4] == ("instruction", [two[0], ("user", "more"), two[1]]) and by_id[5] == ("instruction only", two)
    # nothing is lost where no layout fits
    assert by_id[6] == (None, [("record", json.dumps(records[5]))])
    assert by_id[7] == ("messages", [("user", "")]) and by_id[8] == ("messages", [])
    rest = [(r["layout"], [tuple(t) for t in r["turns"]]) for r in found if r["conv_id"] is None]
    assert sorted(rest, key=str) == [(None, [("record", "no json")]), (None, [])]


def test_three_layouts_in_one_table(spark):
    records = [
        {"meta": {"id": 1, "more": [1]}, "data": {"messages": [
            {"author": {"role": "human", "name": "x"}, "content": {"text": "hi", "parts": [{"a": 1}]}},
            {"author": {"role": "bot"}, "content": {"text": "yo"}},
        ]}},
        {"prompt": "hi", "id": 2, "completion": "yo", "source": {"url": "u"}},
        {"mood": 3, "turns": [{"turn": 1, "role": "assistant", "text": "yo"}, {"turn": 0, "role": "user", "text": "hi"}], "conv_id": 3},
        {"conv_id": 4, "turns": [{"turn": 1, "role": "assistant", "text": "yo"}, {"turn": 0, "role": "user", "text": "hi"}]},
        {"id": 5, "prompt": "hi", "messages": [{"role": "user", "content": "hi"}]},
        {"deep": [[{"x": {"y": [{"z": "lost?"}]}}]], "conv_id": 6},
        {"id": "text", "prompt": "hi", "completion": "yo"},
        [1, 2],
    ]
    frame = spark.createDataFrame([(json.dumps(r), 1, "x") for r in records], "record string, conv_id int, turns string")
    found = {r["conv_id"]: r for r in chat.turns_of_records(frame, "record").collect() if r["conv_id"] is not None}
    two = [("user", "hi"), ("assistant", "yo")]
    turns = {n: [tuple(t) for t in r["turns"]] for n, r in found.items()}
    assert turns[1] == turns[2] == turns[3] == turns[4] == two
    assert [found[n]["layout"] for n in (1, 2, 3, 4, 5, 6)] == ["nested messages", "prompt", "turn rows", "turn rows", None, None]
    # two layouts at once are none, and are kept as they are
    for n in (5, 6):
        (role, text), = turns[n]
        assert role == "record" and json.loads(text) == records[n - 1]
    keyless = [r for r in chat.turns_of_records(frame, "record").collect() if r["conv_id"] is None]
    assert sorted(str(r["layout"]) for r in keyless) == ["None", "prompt"]
    back = chat.format_turns(chat.turns_of_records(frame, "record")).select("turns", chat.read_turns(F.col("formatted")).alias("back"))
    assert all(r["turns"] == r["back"] for r in back.collect())


def paths_of(value, prefix=""):
    """Nested field paths, written apart from the library."""
    if isinstance(value, dict) and value:
        dot = f"{prefix}." if prefix else ""
        return {p for k, v in value.items() for p in paths_of(v, dot + (k if k.isidentifier() else "`" + k.replace("`", "``") + "`"))}
    if isinstance(value, list):
        return {p for v in value for p in paths_of(v, f"{prefix}[]")} or {f"{prefix}[]"}
    return {prefix}


def test_paths_at_any_depth(spark):
    deep = {"z": 1}
    for n in range(60):
        deep = {f"k{n}": [deep]} if n % 3 else {f"k{n}": deep, f"also{n}": None}
    records = [
        {}, {"a": 1}, {"a": {}}, {"a": []}, {"a": [[], []]}, {"a": [[{"b": 1}], [{"c": 2.5}]]}, deep,
        {"a b": 1, "x: y": {"q<": ["s"]}, "t`k": True, "comma, x": {"OBJECT<": [{"ARRAY<": None}]}, "O": "OBJECT<a: STRING>"},
        {"n": 10**30, "d": 1.25, "e": 1e300, "u": "é"}, "text", 5, [1], [], [{"a": [{"b": {"c": 1}}]}],
    ]
    frame = spark.createDataFrame([(n, json.dumps(r)) for n, r in enumerate(records)], "n int, j string")
    found = frame.select("n", chat.record_paths(F.parse_json("j")).alias("paths")).collect()
    assert {r["n"]: set(r["paths"]) for r in found} == {n: paths_of(r) for n, r in enumerate(records)}


def test_rows_become_records_of_their_layout(spark):
    rows = [(1, 2, "assistant", "b", "x"), (1, None, None, "a", "y"), (None, 0, "user", None, "z"), (2, 1, "user", "c" * (20 << 20), "")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, turns string")
    found = chat.turns_of_variants(chat.records_of_rows(table), "record").collect()
    by_id = {r["conv_id"]: (r["layout"], [tuple(t) for t in r["turns"]]) for r in found}
    assert by_id[1] == ("turn rows", [("", "a"), ("assistant", "b")])
    assert by_id[None] == ("turn rows", [("user", "")])
    assert by_id[2][0] == "turn rows" and len(by_id[2][1][0][1]) == 20 << 20
    plan = chat.turns_of_variants(chat.records_of_rows(table), "record")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.split("Scan")[0]


def test_texts_come_back_and_segments_join(spark):
    turns = [[("user", a), ("assistant", b)] for a in NASTY for b in NASTY]
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(turns)], f"id int, turns {chat.TURNS}")
    formatted = chat.format_turns(frame)
    rows = formatted.select(
        "turns", chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss_text(F.col("segments")).alias("loss"),
        "formatted", chat.escape(F.col("turns")[0]["text"]).alias("escaped"),
    ).collect()
    for r in rows:
        assert r["back"] == r["turns"] and r["loss"] == r["turns"][1]["text"]
        for control in ["<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]:
            assert control not in r["escaped"]
