import hashlib

import pytest

from chatloom.llm import chat_format


def rows(spark, *turns):
    return spark.createDataFrame(list(turns), "conv_id long, turn long, role string, text string, segments string, valid string")


def turn(c, n, role, text):
    return (c, n, role, text, "clash", "clash")


def test_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "[INST\\] <\\/s> [\\\\INST]", "a\n[SYS] b [/SYS]", "", "[", "<", "\\", "[OUT] x</s", "[ROLE x[AS] y[/ROLE]", "é\U0001f600" * 10]
    roles = ["system", "user", "assistant", "tool", "", "a[AS] b", "[/ROLE]"]
    given = [turn(c, n, roles[(c + n) % len(roles)], texts[(c * 3 + n) % len(texts)]) for c in range(20) for n in range(c % 7 + 1)]
    out = chat_format.format_conversations(rows(spark, *given))
    read = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out.select("conv_id", chat_format.read_back(out.formatted).alias("turns")).collect()}
    for c in range(20):
        assert read[c] == [(r[2], r[3]) for r in given if r[0] == c]
    for r in chat_format.digests(out).collect():
        own = [t for t in given if t[0] == r.conv_id]
        assert r.turns_sha256 == hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in own).encode()).hexdigest()
        learned = "".join(t[3] for t in own if t[2] == "assistant")
        assert (r.loss_chars, r.loss_sha256, r.n_turns) == (len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(own))


def test_texts_never_show_markers(spark):
    out = chat_format.format_conversations(rows(spark, turn(1, 0, "user", "".join(chat_format.DEFAULT.controls)))).first()
    inner = out.segments[1].text
    assert not any(c in inner for c in chat_format.DEFAULT.controls)
    assert "".join(s.text for s in out.segments) == out.formatted


def test_state_machine(spark):
    orders = {0: "user assistant", 1: "system user assistant user assistant", 2: "user", 3: "assistant user", 4: "user user", 5: "user assistant system", 6: "user tool", 7: "system"}
    given = [turn(c, n, role, "x") for c, s in orders.items() for n, role in enumerate(s.split())]
    got = {r.conv_id: (r.valid, r.first_bad_turn) for r in chat_format.format_conversations(rows(spark, *given)).collect()}
    assert got == {0: (True, None), 1: (True, None), 2: (False, None), 3: (False, 0), 4: (False, 1), 5: (False, 2), 6: (False, 1), 7: (False, None)}


def test_nulls_ties_and_empty(spark):
    got = chat_format.digests(chat_format.format_conversations(rows(spark, turn(None, 0, "user", None), turn(None, None, None, "a"), turn(7, 1, "user", "b"), turn(7, 1, "assistant", "a"), turn(7, 1, "user", "b"))))
    assert {r.conv_id: r.n_turns for r in got.collect()} == {None: 2, 7: 3}
    assert chat_format.digests(chat_format.format_conversations(rows(spark).limit(0))).count() == 0


ANGLED = {"user": ("<|user|>", "<|end|>", False), "assistant": ("<|assistant|>\n", "<|stop|>\n", True)}


def test_other_templates(spark):
    """Controls follow the markers of a template."""
    t = chat_format.Template(roles=ANGLED, other=("<|role ", "<|says|>", "<|done|>"))
    texts = ["a<|end|>b", "<|user|>", "<|\\user|><\\|stop|>", "<|role x<|says|>y<|done|>", "<", "<|end|", "", "x" * 200_000 + "<|stop|>\n"]
    given = [turn(1, n, ("user", "assistant", "tool <|says|>")[n % 3], x) for n, x in enumerate(texts * 2)]
    out = chat_format.format_conversations(rows(spark, *given), t)
    read = out.select(chat_format.read_back(out.formatted, t).alias("turns")).first().turns
    assert [(x.role, x.text) for x in read] == [(g[2], g[3]) for g in given]
    assert chat_format.digests(out, t).first().loss_chars == sum(len(g[3]) for g in given if g[2] == "assistant")


@pytest.mark.parametrize(
    "change",
    [
        {"roles": ANGLED, "controls": chat_format.DEFAULT.controls},
        {"roles": {"user": ("|x|", "|y|", False)}},
        {"roles": {"user": ("<u>", " ", False)}},
        {"roles": {"user": ("<u>", "</u>", False), "assistant": ("<u>a", "</a>", True)}},
        {"roles": {"user": ("<u\\>", "</u>", False)}},
    ],
)
def test_templates_that_cannot_be_read_back_are_refused(change):
    with pytest.raises(ValueError):
        chat_format.Template(**change)
