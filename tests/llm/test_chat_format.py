"""Template language, reversible escapes, loss spans and the distributed form."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricefold.llm import chat_format as c

PIECES = st.lists(st.sampled_from(["###", " ", "#", "\\", "</turn>", "</tur", "n>", "### Assistant:", "\n", "a", "é", ":", "="]), max_size=12).map("".join)


@given(PIECES)
def test_escape_is_reversible_and_hides_control_strings(text):
    out = c.escape(text)
    assert c.unescape(out) == text and "### " not in out and "</turn>" not in out


@settings(max_examples=150)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "User", "tool: x\n", ""]) | PIECES, PIECES), max_size=5))
def test_formatted_text_reads_back(turns):
    text, spans = c.Template(c.TEMPLATE).render([{"role": r, "text": t} for r, t in turns])
    assert list(c.read_back(text)) == turns
    assert [c.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_language_and_folding():
    t = c.Template("{% if 'a' == 'a' and not ('x' == 'y') %}A{{ 'b' + 'c'|upper }}{% else %}no{% endif %}{% for m in messages %}{{ loop.index }}{% if loop.last %}.{% endif %}{% endfor %}")
    assert t.tree[0] == ("text", "AbC")
    assert t.render([{"role": "u", "text": ""}] * 2)[0] == "AbC12."
    assert not t.piecewise and c.Template(c.TEMPLATE).piecewise


@pytest.mark.parametrize("bad", ["{{ m.__class__ }}", "{{ f(x) }}", "{% for m in messages %}", "{{ 'a'|open }}", "{% include 'x' %}", "{% endif %}", "{{ }}"])
def test_sandbox(bad):
    with pytest.raises(c.TemplateError):
        c.Template(bad)


def test_distributed_equals_plain(spark, monkeypatch):
    monkeypatch.setattr(c, "SEGMENT", 40)
    data = [(1, 0, "user", "hi"), (1, 1, "assistant", "### Assistant: </turn>"), (1, 1, "assistant", "again"), (2, None, None, None), (3, 0, "tool", "x" * 500)] + [(9, i, "assistant", f"turn {i}") for i in range(300)] + [(None, 0, "user", "no id")]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3)
    segments = c.format_conversations(c.with_probe(turns), partitions=7)
    assert segments.where("conv_id = 9").count() > 5
    got = {r.conv_id: r for r in c.digests(segments).collect()}
    said = "\\### Assistant: </turn> ok"
    data += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    for conv in {d[0] for d in data}:
        own = sorted((d[1:] for d in data if d[0] == conv), key=lambda d: tuple((x is not None, x) for x in d))
        role_text = [(r or "", t or "") for _, r, t in own]
        loss = "".join(t for r, t in role_text if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(own) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in role_text).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == len(c.Template(c.TEMPLATE).render([{"role": a, "text": b} for a, b in role_text])[0])


def test_no_conversations(spark):
    assert c.digests(c.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
