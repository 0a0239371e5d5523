from __future__ import annotations

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from replaykit.llm import chat_template as chat
from replaykit.llm import packing

from .corpora import documents, edited, empty, prose, texts

NASTY = ["</s>[INST] ok [/INST]", chat.END, chat.TURN + "user" + chat.SAYS, "\\l \\\\ <", "{{ m }} {% if %}", "", "é漢😀\n\t", "x" * 100_000]


def test_round_trip(spark):
    rows = [(c, t, ("user", "assistant", "system", chat.SAYS)[(c + t) % 4], NASTY[(c * 3 + t) % len(NASTY)]) for c in range(20) for t in range(c % 7 + 1)]
    rows += [(50, None, None, None), (50, 1, "assistant", None), (51, 2, "b", "y"), (51, 2, "a", "x"), (None, 0, "user", "no id")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'z' AS formatted")
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    whole = {r.conv_id: r for r in chat.formatted(df).collect()}
    assert set(got) == {r[0] for r in rows} == set(whole)
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1], x[2] or "", x[3] or ""))
        turns = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own)
        loss = "".join(text or "" for _, _, role, text in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        text = whole[conv].formatted
        assert r.formatted_chars == len(text)
        assert "".join(chat.unescape(text[a:b]) for a, b in whole[conv].loss_spans) == loss
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digests(none).count() == 0


def test_parts_of_any_size_read_the_same(monkeypatch):
    import pandas as pd

    rows = [(1, ("user", "assistant", chat.SAYS)[i % 3], NASTY[i % len(NASTY)]) for i in range(24)] + [(2, "assistant", "a")]
    frame = pd.DataFrame(rows, columns=["conv_id", "role", "text"])
    seen = []
    for size in (1, 7, 1000, 1 << 30):
        monkeypatch.setattr(chat, "PART_CHARS", size)
        seen.append(pd.concat(chat._digest(chat.DEFAULT_TEMPLATE)(iter([frame[:5], frame[5:]]))).values.tolist())
    assert len(seen[0]) == 2 and all(x == seen[0] for x in seen)


def test_loss_is_cut_from_the_text_by_spans_alone():
    text = chat.TURN + "assistant" + chat.SAYS + chat.escape("a<b") + chat.END
    at = len(chat.TURN + "assistant" + chat.SAYS)
    back = chat.ReadBack()
    back.feed(text, [(at, len(text) - len(chat.END))])
    assert (back.n_turns, back.loss_chars, back.loss.hexdigest()) == (1, 3, hashlib.sha256(b"a<b").hexdigest())
    with pytest.raises(ValueError, match="outside"):
        back.feed("x", [(0, 1)])


def render(template, messages=(), **scope):
    out = []
    chat._sequence(chat.fold_body(chat.parse(template)))({"messages": messages, **scope}, lambda text, masked: out.append((text, masked)), False)
    return out


@pytest.mark.parametrize(
    ("template", "text"),
    [
        ("{{ 'a' ~ 1 ~ \"b\" }}", "a1b"), ("{% if 1 == 2 %}x{% elif 'a' in 'cat' %}y{% else %}z{% endif %}", "y"),
        ("{% if not v.on and true %}off{% else %}on{% endif %}", "off"), ("{{ v['name'] | upper }}{{ v.name | length }}", "BOB3"),
        ("{% for x in v.all %}[{{ x }}]{% endfor %}", "[1][2]"), ("{% if v.none or (1 != 1) %}x{% endif %}.", "."), ("{{ 'it\\'s' }}", "it's"),
    ],
)
def test_template_language(template, text):
    scope = {"v": {"on": False, "name": "bob", "all": [1, 2], "none": None}}
    assert "".join(t for t, _ in render(template, **scope)) == text


@pytest.mark.parametrize("template", ["{{ a( }}", "{{ m.__class__ }}", "{% for x %}", "{% if 1 %}", "{{ 1 | system }}", "{% import os %}", "{{ }}", "{{ nothing }}"])
def test_templates_outside_the_language_fail(template):
    with pytest.raises(chat.TemplateError):
        render(template, m="text")


def test_constants_are_folded():
    tree = chat.fold_body(chat.parse("a{{ 'b' | upper }}{% if 1 == 1 %}c{% else %}d{% endif %}{% if false %}e{% endif %}{{ m }}"))
    assert tree == (chat.Output(chat.Const("aBc")), chat.Output(chat.Name("m")))


def test_generation_marks_what_the_model_says():
    assert render("x{% generation %}{{ 'y' }}{{ m }}{% endgeneration %}z", m="!") == [("x", False), ("y", True), ("!", True), ("z", False)]


def run_stages(spark, df, tmp_path):
    seen = [df]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, seen[-1], "unused").write.parquet(path)
        seen.append(spark.read.parquet(path))
    return seen


def test_pipeline_stages_take_effect(spark, tmp_path):
    passage = prose(500, 80)
    good = [prose(n, 200) for n in range(300, 320)]
    near = [edited(good[0], 1, 0.01), good[1]]
    shared = [prose(400 + n, 90) + "\n" + passage + "\n" + prose(450 + n, 90) for n in range(3)]
    junk = ["short text", "spam " * 300, " ".join(w + "##%" for w in prose(9, 200).split())]
    df = documents(spark, items=good + near + shared + junk).where("doc_id IS NOT NULL").dropDuplicates()
    _, kept, single, cut, mixed, packed = run_stages(spark, df, tmp_path)
    assert all(x.columns == df.columns for x in (kept, single, cut, mixed))
    assert {r.text for r in kept.collect()} == {*good, *near, *shared}
    left = {r.text for r in single.collect()}
    assert left == {*good, *shared}
    after = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    assert len(after) == len(left) and all(n == len(t) for t, n in after.values())
    assert not any(passage[:250] in t for t, _ in after.values()) and {*good} <= {t for t, _ in after.values()}
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= set(after)
    assert Counter(r.doc_id for r in packed.where("piece = 0").collect()) == copies


def test_pipeline_on_edge_cases_and_empty_tables(spark, tmp_path):
    seen = run_stages(spark, documents(spark, extra=True, items=[*texts(), *[prose(n, 100) for n in range(5)]]), tmp_path / "edge")
    assert seen[-1].count() >= seen[-2].count() > 0 and seen[1].columns == seen[0].columns
    assert run_stages(spark, empty(spark), tmp_path / "none")[-1].count() == 0


def test_pipeline_keeps_columns_and_different_texts_of_one_id(spark, tmp_path):
    """Columns named like those that the stages use come through unchanged; unrelated texts under one doc_id both stay."""
    names = ["row", "_id", "_own", "own_id", "own_digest", "cut_id", "kept", "copy", "shuffle_key", "text_digest"]
    rows = [(n, prose(700 + n, 200), "en", "s", 0) for n in range(25)] + [(1, prose(900, 200), "en", "s", 0)]
    rows += [(50, edited(rows[2][1], 3, 0.01), "en", "s", 0), rows[3]]
    df = spark.createDataFrame([(*r, *[f"{c}-{i}" for c in names]) for i, r in enumerate(rows)], "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in names))
    _, kept, single, cut, mixed, _ = run_stages(spark, df, tmp_path)
    assert all(x.columns == df.columns for x in (kept, single, cut, mixed))
    assert {(r.doc_id, r.text) for r in single.collect()} == {(r[0], r[1]) for r in rows if r[0] != 50} and single.count() == 26
    values = {tuple(r[c] for c in names) for r in df.collect()}
    assert all(tuple(r[c] for c in names) in values for r in mixed.collect()) and mixed.count() > 0


def test_every_query_is_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert packing.CAPACITY == 2048
