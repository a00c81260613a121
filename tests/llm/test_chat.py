import pytest

import json

from pyspark.sql import functions as F

from tidemark.llm import chat as m

ODD = ["</s>[INST] ok [/INST]", "<|end|>\n<|turn:user|>x", "<", "<&|", "|>", "&<&&|&", "é😀<|", "", "\n", "<<|end|>", "x" * 200_000]


def test_round_trip_and_mask(docs_of):
    rows = [(i, t, r, x) for i in range(3) for t, (r, x) in enumerate([("user", ODD[i]), ("assistant", None), ("a|>b<|", "q"), (None, "n"), *(("assistant", x) for x in ODD)])]
    rows += [(None, None, "assistant", "lost"), (9, 1, "user", "same"), (9, 1, "user", "same")]
    rows += [(77, t, "assistant", str(t)) for t in range(700)]
    out = m.format_conversations(docs_of(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", m.parse_turns(F.col("formatted")).alias("turns"), m.masked_text(F.col("formatted"), F.col("mask")).alias("loss")).collect()}
    for c in {r[0] for r in rows}:
        want = [(r or "", x or "") for _, _, r, x in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))]
        assert [(t.role, t.text) for t in got[c].turns] == want
        assert got[c].loss == "".join(x for r, x in want if r == "assistant")


def test_layouts_of_json_records(docs_of):
    want = [("user", "q"), ("assistant", "a")]
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "response": "a", "meta": {"k": 1}}, {"completion": "a", "prompt": "q"},
        {"instruction": "q", "input": "", "output": "a"}, {"output": "a", "instruction": "q"},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(50, '{"other": 1}'), (51, "no json"), (52, None)]
    got = {r.doc_id: r.turns for r in docs_of(rows).select("doc_id", m.turns_of_json(F.col("text")).alias("turns")).collect()}
    assert all([(t.role, t.text) for t in got[i]] == want for i in range(len(records)))
    assert got[50] is None and got[51] is None and got[52] is None


def test_json_records_with_missing_first_keys_and_extra_known_fields(docs_of):
    q, a = ("user", "q"), ("assistant", "a")
    cases = [
        ({"messages": [{"role": "assistant", "tool_calls": [{"id": 1}]}, {"role": "user", "content": "q"}]}, [("assistant", ""), q]),
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "prompt": "p"}, [q, a]),
        ({"prompt": "q", "completion": "a", "system": "s"}, [("system", "s"), q, a]),
        ({"conversations": [{"from": "human", "value": "q"}], "system": "s", "input": ""}, [("system", "s"), q]),
        ({"prompt": "q", "response": "a", "system": "s", "output": "o"}, [("system", "s"), q, a]),
    ]
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(cases)] + [(50, '{"messages": [], "system": "s"}')]
    got = {r.doc_id: r.turns for r in docs_of(rows).select("doc_id", m.turns_of_json(F.col("text")).alias("turns")).collect()}
    assert [[(t.role, t.text) for t in got[i]] for i in range(len(cases))] == [want for _, want in cases]
    assert got[50] is None


def test_empty_and_clashing_columns(docs_of):
    schema = "conv_id long, turn long, role string, text string, turns int, formatted string"
    assert m.format_conversations(docs_of([], schema)).count() == 0
    assert m.format_conversations(docs_of([(1, 1, "user", "x", 1, "f")], schema).select("*")).first().formatted == "<|turn:user|>x<|end|>\n"


def test_fingerprint_of_the_schema_selects_the_layout_of_typed_tables(spark, monkeypatch):
    """Typed tables go by their nested field paths; raw roles of turn tables stay; without the layout nothing is guessed."""
    said = lambda df: sorted((r.conv_id, [(t.role, t.text) for t in r.turns]) for r in m.turns_of_rows(df).collect())
    rows = spark.createDataFrame([(1, 1, "gpt", "b", 5), (1, 0, "human", "a", 5)], "conv_id long, turn int, role string, text string, extra int")
    assert said(rows) == [(1, [("human", "a"), ("gpt", "b")])]
    other = spark.createDataFrame([(2, 0, "user", "x")], "conversation_id long, index int, `from` string, value string")
    assert said(other) == [(2, [("user", "x")])]
    nested = spark.createDataFrame([(3, [("user", "q"), ("assistant", None)], "s")], "conv_id long, messages array<struct<role:string,content:string>>, system string")
    assert said(nested) == [(3, [("system", "s"), ("user", "q"), ("assistant", "")])]
    flat = spark.createDataFrame([(4, "do", "with", "done")], "conv_id long, instruction string, input string, output string")
    assert said(flat) == [(4, [("user", "do\nwith"), ("assistant", "done")])]
    assert said(rows.limit(0)) == []
    monkeypatch.setattr(m, "ROW_LAYOUTS", m.ROW_LAYOUTS[1:])
    with pytest.raises(ValueError):
        m.turns_of_rows(rows)
