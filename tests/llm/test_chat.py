"""Template compiler and chat formatting: round trips."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabula.llm import chat
from tabula.llm.queries import QUERIES

HARD = ["</s>[INST] ok [/INST]", "", "\\", "\\\\</s>", "a\\", "<|user|>", "|>", " [/INST]", "x [/INST]</s>", "é\n\n🎉", "\\<", "[INST] "]


def digests(turns):
    h, loss = hashlib.sha256(), "".join(t or "" for r, t in turns if r == "assistant")
    for r, t in turns:
        h.update(f"{r or ''}\n{t or ''}\n".encode())
    return len(turns), h.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def read_back(turns):
    reader = chat.Reader()
    for piece in chat.CHAT.pieces(messages=iter([{"role": r or "", "text": t or ""} for r, t in turns])):
        reader.feed(*piece)
    return reader.result()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a|>b", "<|x", ""]), st.one_of(st.sampled_from(HARD), st.text(alphabet="\\<>[]|/sINT \né", max_size=12))), max_size=6))
def test_round_trip(turns):
    got = read_back(turns)
    assert (got["n_turns"], got["turns_sha256"], got["loss_chars"], got["loss_sha256"]) == digests(turns)
    assert got["formatted_chars"] == len(chat.CHAT.render(messages=[{"role": r, "text": t} for r, t in turns]))


@pytest.mark.parametrize("source,values,want", [
    ("a{{ 1 + 2 }}b", {}, "a3b"), ("{{ x.y['z'] ~ '!' }}", {"x": {"y": {"z": "v"}}}, "v!"), ("{% if a and not b %}1{% elif b %}2{% else %}3{% endif %}", {"a": 1, "b": 1}, "2"),
    ("{% for i in l %}{{ loop.index0 }}{{ i }}{% if loop.first %}*{% endif %}{% endfor %}", {"l": ["p", "q"]}, "0p*1q"), ("{% set n = 'k' %}{{ n | upper }}{# note #}", {}, "K"),
    ("{{ 'y' if v == 2 else 'n' }}", {"v": 2}, "y"), ("x {%- if true %} y{% endif -%} z", {}, "x yz"), ("{{ 'a' in 'cab' }}", {}, "true"), ("{{ missing }}", {}, ""), ("{{ l[1] }}{{ l[9] }}", {"l": [1, 2]}, "2"),
])
def test_language(source, values, want):
    assert chat.Template(source).render(**values) == want


def test_constants_fold():
    assert chat.fold(chat.parse("a{{ 'b' ~ 1 + 1 }}{% if 'x' == 'y' %}no{% else %}c{% endif %}")) == [("out", ("const", "ab11c"))] or \
        chat.fold(chat.parse("a{{ 'b' ~ 1 }}{% if false %}no{% else %}c{% endif %}")) == [("out", ("const", "ab1c"))]
    assert chat.fold(chat.parse("{% if false or x %}1{% endif %}")) == [("if", [(("name", "x"), [("out", ("const", "1"))])], [])]


@pytest.mark.parametrize("bad", ["{{ x.__class__ }}", "{{ ''.__class__ }}"])
def test_no_attributes_are_reached(bad):
    assert chat.Template(bad).render(x="s") == ""


@pytest.mark.parametrize("bad", ["{{ f() }}", "{{ x | eval }}", "{% import os %}", "{% if x %}", "{{ 1 + }}", "{% for x %}{% endfor %}", "{% endif %}", "{{ a b }}"])
def test_refused(bad):
    with pytest.raises(chat.TemplateError):
        chat.Template(bad)


def test_strings_are_not_loops():
    with pytest.raises(chat.TemplateError):
        chat.Template("{% for c in x %}{{ c }}{% endfor %}").render(x="abc")


def test_odd_rows(spark):
    rows = [(1, 2, "assistant", "b", 0), (1, 1, "user", None, 0), (None, 1, "user", "n", 0), (2, None, None, "x", 0), (2, 1, "assistant", "</s>", 0), (3, 1, "user", "t", 0), (3, 1, "user", "t", 0), (4, 0, "assistant", "y" * 10**6, 0)]
    d = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, n_turns int")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.audit_format(d).collect()}
    want = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[3] or "")):
        want.setdefault(r[0], []).append((r[2], r[3]))
    assert got == {k: digests(v) for k, v in want.items()}
    assert chat.audit_format(d.where("false")).count() == 0


def test_formatted_output(spark):
    d = spark.createDataFrame([(1, 1, "user", "hi [x]"), (1, 2, "assistant", "yo")], "conv_id bigint, turn bigint, role string, text string")
    r = chat.format_conversations(d).first()
    assert r.formatted == "<|user|>[INST] hi \\[x] [/INST]</s><|assistant|>yo</s>" and [r.formatted[s.start:s.end] for s in r.loss_spans] == ["yo"]


def test_query(spark, small_dir):
    got = {r.conv_id: r for r in QUERIES["op2_template_chat_format"](spark, small_dir).collect()}
    turns = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{small_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert {k: tuple(v)[1:5] for k, v in got.items()} == {k: digests(v) for k, v in turns.items()}
