import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demand_engine.llm.chat import CONTROLS, Node, PROBE_TEXT, TemplateError, chat_report, compile_template, escape, fold, format_conversations, parse, unescape


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([*CONTROLS, "\\", "\\n", "<", "[", "\n", "\\l"]), st.text(max_size=4))).map("".join))
def test_escaping_comes_back_and_leaves_no_control(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


def test_language():
    def say(template, **variables):
        return compile_template(template)(variables)[0]

    assert say("a{{ 1 + 2 * 3 }}{{ 'x' ~ 4 // 3 }}") == "a7x1"
    assert say("{% for x in xs %}{{ loop.index }}{{ x.k }}{% if not loop.last %},{% endif %}{% endfor %}", xs=[{"k": "a"}, {"k": "b"}]) == "1a,2b"
    assert say("{% if a == 1 %}one{% elif a == 2 %}two{% elif a %}some{% else %}none{% endif %}", a=2) == "two"
    assert say("{% if a == 1 %}one{% elif a == 2 %}two{% else %}none{% endif %}", a=0) == "none"
    assert say("{% set b = a | upper %}{{ b[0] }}{{ missing }}{{ b.__class__ }}", a="xy") == "X"
    assert say("{{ 'y' if a in 'abc' and (true or none) else 'n' }}", a="b") == "y"
    assert say("{{ '\\n' }}|{{ \"a'b\" }}") == "\n|a'b"
    assert compile_template("ab{% generation %}c{{ x }}{% endgeneration %}d")({"x": "é"}) == ("abcéd", [(2, 4)])


def test_constants_are_folded():
    assert fold(parse("a{{ 1 + 1 }}{% if 2 > 1 %}b{% else %}c{% endif %}{{ 'x' | upper }}")) == Node("body", None, (Node("constant", "a2bX"),))
    assert compile_template("{% if a %}{{ 1 // 0 }}{% endif %}")({})[0] == ""


@pytest.mark.parametrize("bad", ["{{ f(x) }}", "{{ x | import }}", "{% for x in y %}", "{% endif %}", "{% else %}", "{{ 1 + }}", "{% include 'x' %}", "{{ @ }}", "{% if a %}{% endfor %}"])
def test_what_is_not_in_the_language(bad):
    with pytest.raises(TemplateError):
        compile_template(bad)


def test_report_of_odd_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (3, None, "assistant", "\\<|im_end|>\n"), (3, 0, "a\nb", "é" * 50_000), (3, 0, "a\nb", "é" * 50_000), (None, 5, "assistant", ""), (None, 4, "assistant", "[INST]")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, messages string")
    got = {r.conv_id: r for r in chat_report(df).collect()}
    order = {-1: [("user", PROBE_TEXT), ("assistant", PROBE_TEXT)]}
    for c in (1, 2, 3, None):
        own = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c)
        order[c] = [(r, t) for _, _, r, t in own]
    assert set(got) == set(order)
    for c, turns in order.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_report(df.limit(0)).count() == 1
    assert format_conversations(df.limit(0)).count() == 0
